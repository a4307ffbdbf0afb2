"""The pipeline against brute-force versions of its stages."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from medallion.llm import mixing, quality
from medallion.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm.fixtures import awkward, awkward_rows, fixture_dir
from tests.llm.test_decontamination import brute as leaks
from tests.llm.test_signature_join import brute as groups


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "ngram_jaccard_join", "benchmark_decontamination", "source_mixing", "token_output"]


def test_run_matches_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    decided = quality.classify(docs, table(spark, SF_SMALL, "labels")).where("kept").select("doc_id")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.join(decided, "doc_id", "left_semi").collect())
    first = {c for _, _, c in groups(rows)}
    rows = [r for r in rows if r[0] in first]
    items = [(r["item_id"], r["text"]) for r in table(spark, SF_SMALL, "benchmark").collect()]
    bad = {d for d, _, _ in leaks(rows, items)}
    rows = [r for r in rows if r[0] not in bad]
    left = docs.where(docs.doc_id.isin([r[0] for r in rows]))
    sampled = {r["doc_id"] for r in mixing.mix(left).where("sampled").collect()}
    rows = [r for r in rows if r[0] in sampled]
    encode = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode
    want, start = [], 0
    for doc_id, text in rows:
        ids = np.array([*encode(text, add_special_tokens=False).ids, 2], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = corpus_pipeline.run(spark, SF_SMALL).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, got.collect())) == want and len(want) > 30


def test_awkward_rows_go_through_every_stage(spark, tmp_path):
    items = spark.createDataFrame([(1, "a passage that none of these documents has in it")], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    sf = fixture_dir(spark, tmp_path, benchmark=items, labels=labels)
    docs = awkward(spark)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{sf}/stage{k}")
        docs = spark.read.parquet(f"{sf}/stage{k}")
    assert 0 < docs.count() < len(awkward_rows())
    nothing = awkward(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, sf).count() == 0
