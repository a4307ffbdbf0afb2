"""op13 against brute force: recall, exact scores, order, copies, awkward rows."""

import math

import numpy as np

from medallion.llm import graph_search as gs
from medallion.llm.common import table
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<double>, label int, print string, shard string, ids long"


def brute(rows, every, k):
    """{query_id: [(score, vec_id)]} over usable rows."""
    usable = {}
    for vec_id, e in rows:
        if vec_id is not None and e and all(v is not None and math.isfinite(v) for v in e) and any(e):
            usable.setdefault(vec_id, e)
    out = {}
    for q, e in usable.items():
        if q % every == 0:
            near = [(math.sqrt(sum((a - b) * (a - b) for a, b in zip(e, f))), i) for i, f in usable.items() if i != q and len(f) == len(e)]
            out[q] = sorted(near)[:k]
    return out


def found(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, want):
    hits = sum(len({i for _, i in got.get(q, [])} & {i for _, i in near}) for q, near in want.items())
    return hits / sum(len(near) for near in want.values())


def check(got, want, rows, least):
    assert {q for q, near in want.items() if near} == set(got) and recall(got, want) >= least
    vectors = {i: e for i, e in rows if i is not None and e}
    for q, near in got.items():
        assert near == sorted(near) and len(near) == len(want[q]) and len({i for _, i in near}) == len(near)
        for score, i in near:
            assert math.isclose(score, math.dist(vectors[q], vectors[i]), rel_tol=1e-12, abs_tol=1e-12)


def test_query_recall(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, SF_SMALL, "embeddings").collect()]
    got = found(gs.query(spark, SF_SMALL))
    check(got, brute(rows, gs.EVERY, gs.K), rows, 0.99)


def test_many_shards_and_packs(spark, monkeypatch):
    monkeypatch.setattr(gs, "PACK", 8)
    monkeypatch.setattr(gs, "PACKS", 2)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 24))
    x = centres[rng.integers(0, 40, 2500)] + rng.normal(size=(2500, 24)) * 0.15
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    usable = gs.usable(frame)
    queries = usable.where("vec_id % 50 = 0").selectExpr("vec_id AS query_id", "embedding")
    index = gs.build_index(usable, 10, 300)
    assert index.count() == 9 and index.agg({"n": "sum"}).first()[0] == 2500
    check(found(gs.search(index, queries, 10)), brute(rows, 50, 10), rows, 0.97)


def test_copies_and_ties(spark):
    """A vector on a third of all rows: the smallest ids come back, in order."""
    rng = np.random.default_rng(4)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else rng.normal(size=3).tolist()) for i in range(900)]
    got = found(gs.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 30))
    want = brute(rows, 30, 10)
    assert got == want and got[0] == [(0.0, i) for i in range(3, 33, 3)] and got[30][0] == (0.0, 0)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (10, [1.0, 0.5]), (3, [1e200, -1e200]), (4, None), (5, []), (6, [0.0, 0.0]), (20, [nan, 1.0]),
        (8, [None, 1.0]), (9, [inf, 1.0]), (None, [1.0, 0.0]), (30, [1.0, 0.0, 0.0]), (-10, [-1.0, 0.0]), (40, None), (11, [1.0, 0.0, 2.0]),
    ]
    frame = spark.createDataFrame([(i, e, 1, "p", "s", 9) for i, e in rows], SCHEMA)
    got, want = found(gs.nearest_neighbours(frame, 10)), brute(rows, 10, 10)
    assert got == {q: near for q, near in want.items() if near} and set(got) == {0, 10, -10, 30}
    assert gs.nearest_neighbours(frame.limit(0), 10).count() == 0
    alone = gs.nearest_neighbours(spark.createDataFrame([(100, [1.0])], "vec_id long, embedding array<double>"))
    assert alone.count() == 0 and alone.columns == ["query_id", "rank", "vec_id", "score"]
