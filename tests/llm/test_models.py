"""op3, op6 and op9 against plain versions of their methods."""

import numpy as np
import pandas as pd
import pytest

from medallion.llm import mixing, quality, secret_forest
from medallion.llm.common import table
from tests.llm.fixtures import awkward, awkward_rows, empty

SF = "/root/testdata/sf0.01"


# ------------------------------------------------------------------- quality


def test_posteriors_match_a_plain_computation(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = quality.classify(docs, labels).toPandas().merge(docs.select("doc_id", "source", "lang").toPandas(), on="doc_id")
    p, n, mean = got.evidence, len(got), got.evidence.mean()
    host, path = got.groupby("source").evidence, got.groupby(["source", "lang"]).evidence

    def strength(sums, counts, prior):
        v = mean * (1 - mean)
        spread = max(0.0, ((counts * (sums / counts - prior) ** 2).sum() - v * len(sums)) / n)
        return min(1e6, max(1.0, v / spread - 1)) if spread else 1e6

    a = strength(host.sum(), host.count(), mean)
    b = strength(path.sum(), path.count(), (host.sum() / host.count()).reindex(path.sum().index.get_level_values(0)).to_numpy())
    h = (a * mean + host.transform("sum") - p) / (a + host.transform("count") - 1)
    q = (b * h + path.transform("sum") - p) / (b + path.transform("count") - 1)
    logit = lambda x: np.log(x / (1 - x))
    assert np.allclose(got.host_posterior, h) and np.allclose(got.path_posterior, q)
    assert np.allclose(got.score, logit(p) + logit(q) - logit(mean)) and (got.kept == (got.score >= 0)).all()


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    seen = labels.where("doc_id % 3 <> 0")
    got = quality.classify(docs, seen).join(labels.where("doc_id % 3 = 0"), "doc_id").toPandas()
    assert len(got) > 100 and (got.kept == (got.quality == 1)).mean() > 0.97
    assert got[got.quality == 1].kept.mean() > 0.98


def test_a_bad_site_counts_against_its_documents(spark):
    rows = [(n, f"s{n % 2}", "en", 0.9 if n % 2 else 0.2) for n in range(400)] + [(900, "s0", "en", 0.6), (901, "s1", "en", 0.6), (902, "new", "en", 0.6)]
    frame = spark.createDataFrame(rows, "doc_id long, host string, path string, p double")
    from pyspark.sql import functions as F

    out = {r["doc_id"]: r["_q_score"] for r in quality.score(frame, "host", "path", F.col("p"), quality.fit_sites(frame)).collect()}
    assert out[900] < out[902] < out[901]


def test_quality_over_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1), (2, 1), (13, 0), (13, 1), (None, 0), (99, 0), (3, None), (7, 0)], "doc_id long, quality int")
    out = quality.classify(awkward(spark), labels).toPandas()
    assert len(out) == len(awkward_rows()) and out.score.notna().all()
    kept = quality.keep(awkward(spark), labels)
    assert kept.columns == awkward(spark).columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == sorted(out[out.kept].doc_id.fillna(-1).astype(int))
    for few in (labels.limit(0), labels.where("quality = 1")):
        assert quality.keep(awkward(spark), few).count() == len(awkward_rows())
    assert quality.classify(empty(spark), labels).count() == quality.keep(empty(spark), labels).count() == 0


# -------------------------------------------------------------------- mixing


def test_rake_matches_a_plain_computation(spark):
    rng = np.random.default_rng(3)
    rows = [(f"s{a}", f"l{b}", f"t{c}", int(rng.integers(1, 5000))) for a in range(6) for b in range(3) for c in range(4) if rng.random() < 0.8]
    frame = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    targets = {"lang": {"l0": 0.5, "l1": 0.3, "l2": 0.2}}
    got = mixing.rake(frame, targets).toPandas().sort_values(list(mixing.AXES))
    cells = pd.DataFrame(rows, columns=["source", "lang", "topic", "tokens"]).sort_values(list(mixing.AXES)).reset_index(drop=True)
    w = cells.tokens / cells.tokens.sum()
    for _ in range(200):
        for a in mixing.AXES:
            t = cells.groupby(a).tokens.sum() ** mixing.ALPHA
            share = pd.Series(targets[a]) if a in targets else t / t.sum()
            w = w * cells[a].map(share) / w.groupby(cells[a]).transform("sum")
    assert np.allclose(got.weight, w, atol=1e-3)
    for a in mixing.AXES:
        assert abs(got.groupby(a).weight.sum() - w.groupby(cells[a]).sum()).max() < 2e-4


def test_rake_plans_stay_small(spark, monkeypatch):
    """Each raking step is planned alone: one sum and one join."""
    joins, keep = [], mixing.written
    monkeypatch.setattr(mixing, "written", lambda frame, name: (
        joins.append(frame._jdf.queryExecution().analyzed().toString().count("Join ")), keep(frame, name))[1])
    rows = [(s, la, t, 10 + i * j * k) for i, s in enumerate("abcd") for j, la in enumerate("xyz") for k, t in enumerate("pq")]
    mixing.rake(spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")).collect()
    assert joins[:3] == [0, 0, 0] and joins[3] == 3  # the shares, then the cells with them
    assert len(joins) >= 7 and set(joins[4:]) == {1}


def test_mix_of_all_documents(spark):
    docs = table(spark, SF, "documents")
    out = mixing.mix(docs).toPandas()
    assert len(out) == docs.count() and out.probability.between(0, 1).all()
    assert (out.tokens * out.probability).sum() / out.tokens.sum() == pytest.approx(mixing.BUDGET, abs=0.01)
    words = docs.toPandas().set_index("doc_id").text.map(lambda t: len(t.split()))
    assert (out.set_index("doc_id").tokens.sort_index() == words.sort_index()).all()
    kept = mixing.sample(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == set(out[out.sampled].doc_id)


def test_mixing_over_awkward_rows(spark):
    out = mixing.mix(awkward(spark)).toPandas()
    assert len(out) == len(awkward_rows()) and (out[out.tokens == 0].probability == 0).all()
    kept = mixing.sample(awkward(spark))
    assert kept.columns == awkward(spark).columns and kept.count() == out.sampled.sum()
    half = mixing.mix(awkward(spark), {"lang": {"en": 1.0, "zz": 1.0}}).toPandas()
    assert (half[half.lang != "en"].probability == 0).all() and half[half.lang == "en"].probability.max() > 0
    assert mixing.mix(empty(spark)).count() == mixing.sample(empty(spark)).count() == 0


# ------------------------------------------------------------------- secrets


def test_secrets_held_out(spark):
    docs = table(spark, SF, "documents")
    found = secret_forest.findings(docs, secret_forest.dictionary(docs)).persist()
    labels = secret_forest.labelled(found).withColumnRenamed("secret", "want")
    half = labels.where("start % 2 = 0").withColumnRenamed("want", "secret")
    out = secret_forest.scan(docs, half).join(labels.where("start % 2 = 1"), ["doc_id", "start"]).toPandas()
    found.unpersist()
    assert len(out) > 20 and (out.secret == (out.want == 1)).mean() > 0.97


def test_secrets_in_whole_texts(spark):
    import re

    docs = table(spark, SF, "documents")
    out = secret_forest.scan(docs).toPandas()
    want = sum(len(re.findall(r'(?i)token = "[0-9a-f]{40}"', r["text"])) for r in docs.collect())
    assert out.secret.sum() == want > 5 and (out[~out.secret].probability < 0.5).all()


SECRET = "9f8e7d6c5b4a39281706f5e4d3c2b1a09f8e7d6c"


@pytest.mark.parametrize("text, name, value", [
    (f"API_KEY={SECRET}", "api_key", SECRET),
    (f"export AWS_KEY_2={SECRET} # x", "aws_key_2", SECRET),
    (f"token:{SECRET}\nname:x", "token", SECRET),
    (f"see http://a.example/x?user=me&token={SECRET}&page=2", "token", SECRET),
    (f"http://a.example/x?token={SECRET}#top", "token", SECRET),
    (f'{{"clientSecret": "{SECRET}"}}', "clientsecret", SECRET),
    (f"Authorization: Bearer {SECRET}", "authorization", SECRET),
    ("DB_PASSWORD=Tr0ub4dor&3!#x%y next", "db_password", "Tr0ub4dor&3!#x%y"),
    ("password: hunter2", "password", "hunter2"),
    ('passwd = "correct horse battery"', "passwd", "correct horse battery"),
    ("secret=AbCdEfGhIjKlMnOpQrSt.", "secret", "AbCdEfGhIjKlMnOpQrSt"),
    (f"digest={SECRET}", "digest", SECRET),
    (f"config:token={SECRET}", "token", SECRET),
    ("zzz AbCdEfGhIjKlMnOpQrSt zzz", None, "AbCdEfGhIjKlMnOpQrSt"),
    ("at ab:cd:ef:12:34:56:78 now", None, "ab:cd:ef:12:34:56:78"),
])
def test_candidates_are_values_alone(text, name, value):
    at = text.index(value)
    found = [(s, v) for s, v in secret_forest.candidates(text) if s < at + len(value) and s + len(v) > at]
    assert found == [(at, value)] and all(text[s : s + len(v)] == v for s, v in secret_forest.candidates(text))
    assert secret_forest.assigned_name(text, text.index(value)) == name
    features = dict(zip(secret_forest.FEATURES, secret_forest.describe(text, text.index(value), value, "", frozenset(), frozenset())))
    assert features["assigned"] == (name is not None) and features["credential_near"] == (name not in (None, "digest"))


def test_assigned_secrets_without_blanks_are_found(spark):
    import hashlib

    docs = table(spark, SF, "documents").select("doc_id", "text", "source")
    forms = ["API_KEY={}", "token:{}", "http://a.example/x?token={}&p=1"]
    values = [hashlib.sha1(b"%d" % n).hexdigest() for n in range(30)]
    rows = [(10**6 + n, "some words then " + forms[n % 3].format(v), "src") for n, v in enumerate(values)]
    added = spark.createDataFrame(rows, docs.schema)
    out = secret_forest.scan(docs.union(added)).where("doc_id >= 1000000 AND secret").toPandas()
    got = {rows[d - 10**6][1][s : s + n] for d, s, n in zip(out.doc_id, out.start, out.length)}
    assert len(out) == 30 and got == set(values)


def test_secrets_over_awkward_rows(spark):
    out = secret_forest.scan(awkward(spark)).toPandas()
    assert set(out.doc_id) <= {11} and len(out) == 1 and out.length[0] == 40
    assert secret_forest.scan(empty(spark)).count() == 0
    assert secret_forest.dictionary(empty(spark)) == []
