"""op5 and op10 against the tokenizers library on whole texts."""

import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from medallion.llm import token_counts, token_files
from medallion.llm.encoding import ChunkEncoder, pieces
from tests.llm.fixtures import awkward, awkward_rows, empty

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
ENCODERS = {p: ChunkEncoder(p, list, kept=50) for p in (BYTE, WORD)}
WHOLE = {p: Tokenizer.from_file(p) for p in (BYTE, WORD)}
ALPHABET = "abAB zZ éÉñß ,.'s!|<>-_09\n\t\x0b\x85  ́ͅ文—Σςİ"


def same(path, text):
    got = [i for v in ENCODERS[path].values(text) for i in v]
    assert got == WHOLE[path].encode(text, add_special_tokens=False).ids, repr(text)


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(ALPHABET), max_size=60))
def test_chunks_put_together_are_the_text(text):
    for path in (BYTE, WORD):
        same(path, text)


def test_special_strings_contractions_and_long_texts():
    for text in ["a<|endoftext|> b", "The<|ENDOFTEXT|>, x", "<|startoftext|>Hi", "it's we'll DON'T 'a' x's!'s",
                 "word " * 3000, "a" * 5000, " " * 500, "É, é! ﬁ «É» áb 각"]:
        for path in (BYTE, WORD):
            same(path, text)


def test_pieces_cut_before_white_space():
    text = ("ab  c\n" * 50) + "x" * 40
    assert "".join(pieces(text, 16)) == text and len(list(pieces(text, 16))) > 5
    assert all(p[0] in " \n" for p in list(pieces(text, 16))[1:])


def test_counts_and_cache(spark, tmp_path):
    cache, rows = str(tmp_path / "cache"), awkward_rows()
    want = sorted(((r[0] is None, r[0] or 0), len((r[1] or "").encode()), len(WHOLE[BYTE].encode(r[1] or "").ids)) for r in rows)
    for _ in range(2):  # the second run finds every count stored
        got = token_counts.count_tokens(awkward(spark), BYTE, cache).collect()
        assert sorted(((r[0] is None, r[0] or 0), r[1], r[2]) for r in got) == want
        stored = spark.read.parquet(cache)
        assert stored.count() == len({r[1] or "" for r in rows}) == stored.select("content").distinct().count()
    more = awkward(spark).limit(0).union(spark.createDataFrame([(99, "new text", "en", "s", 8, 0, "", 0, "", "", 0, "")], awkward(spark).schema))
    assert token_counts.count_tokens(more, BYTE, cache).first()["n_tokens"] == len(WHOLE[BYTE].encode("new text").ids)
    assert spark.read.parquet(cache).count() == len({r[1] or "" for r in rows}) + 1
    assert token_counts.count_tokens(empty(spark), BYTE, cache).count() == 0


def test_files_round_trip(spark, tmp_path):
    folder = str(tmp_path / "files")
    docs = awkward(spark).repartition(5)
    manifest = token_files.write_ids(docs, WORD, folder)
    got = token_files.read_index(manifest, folder).collect()
    key = lambda d: (d is not None, d or 0)
    texts = sorted(awkward_rows(), key=lambda r: key(r[0]))
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])] == [r[0] for r in texts]
    start = 0
    ordered = sorted(got, key=lambda r: r["start"])
    for r, row in zip(ordered, texts):
        ids = np.array([*WHOLE[WORD].encode(row[1] or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    for m in manifest.collect():  # the plain files, as another reader would map them
        ids = np.memmap(f"{folder}/{m['name']}.bin", "<u2", "r")
        offsets = np.memmap(f"{folder}/{m['name']}.idx", "<i8", "r")
        assert len(ids) == m["n_ids"] == offsets[-1] and len(offsets) == m["n_docs"] + 1


def test_no_documents(spark, tmp_path):
    assert token_files.write_and_read(empty(spark), WORD, str(tmp_path / "none")).count() == 0


def test_a_vocabulary_beyond_16_bits():
    assert token_files.width(1 << 16) == "<u2" and token_files.width((1 << 16) + 1) == "<u4"
