"""The queries that SQL can express, against their SQL, and the guard."""

import builtins
import importlib
import sys

import pytest

from medallion.llm.registry import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.fixtures import fixture_dir
from tools.compare import canonical, duck



def rows_of(frame):
    return canonical(frame.columns, [tuple(r) for r in frame.collect()])


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    rel = duck(SF_SMALL).execute(ORACLE_SQL[name])
    assert rows_of(QUERIES[name](spark, SF_SMALL)) == canonical([d[0] for d in rel.description], rel.fetchall())


def test_line_templates_over_awkward_rows(spark, tmp_path):
    from medallion.llm import line_templates

    shared = "Licensed under the terms of version 2.0 by Example Inc and its many friends all over the world"
    other = shared.replace("2.0", "3.1").replace("friends", "partners")
    rows = [(1, f"one\n{shared}\nx y z u v"), (2, f"two\n{other}"), (3, f"{shared}\n{shared}"), (4, None), (5, ""),
            (6, "\n\n"), (None, shared), (7, "x y z u v\nten to twelve words are in this line here, no more"), (7, "x y z u v"),
            (8, "1 2 3 4 5 6"), (9, "6 5 4 3 2 1"), (10, "1 2 3 4 5 6"), (11, "w " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"] or -1, r["text"], r["n_lines"], r["n_dropped"]) for r in line_templates.drop_recurring(docs).collect()),
                 key=lambda r: (r[0], r[1] or ""))
    assert got == sorted([
        (1, rows[0][1], 3, 0), (2, "two", 2, 1), (3, "", 2, 2), (4, None, 0, 0), (5, "", 0, 0), (6, "\n\n", 3, 0), (-1, shared, 1, 0),
        (7, "ten to twelve words are in this line here, no more", 2, 1), (7, "", 1, 1),
        (8, rows[9][1], 1, 0), (9, rows[10][1], 1, 0), (10, "", 1, 1), (11, rows[12][1], 1, 0),
    ], key=lambda r: (r[0], r[1] or ""))
    assert line_templates.drop_recurring(docs.limit(0)).count() == 0


def test_short_recurring_lines_are_dropped(spark):
    from medallion.llm import line_templates

    short = "All rights reserved."
    rows = [(1, f"{short}\nfirst\n\n12"), (2, f"second\n{short}\n\n13"), (3, f"{short}\n12\nMenu"), (4, "Menu")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["n_dropped"]) for r in line_templates.drop_recurring(docs).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("second\n\n13", 1), 3: ("Menu", 2), 4: ("", 1)}
    assert all(r["n_dropped"] == 0 for r in line_templates.drop_recurring(docs, 5).collect())


def test_url_filter_over_awkward_rows(spark):
    from datetime import datetime as D

    from medallion.llm import url_filter

    captures = spark.createDataFrame([
        (1, "http://a.b.example.com/x/y", D(2024, 1, 5)), (2, "http://A.B.example.com.:80/", D(2024, 1, 10)),
        (3, "http://b.example.com", D(2024, 2, 5)), (4, None, D(2024, 1, 5)), (5, "not a url", D(2024, 1, 5)),
        (6, "https://b.example.com/ok/z", D(2024, 1, 5)), (7, "http://b.example.com/", None), (1, "http://a.b.example.com/x/y", D(2024, 1, 5)),
    ], "page_id long, url string, fetched timestamp")
    entries = spark.createDataFrame([
        ("l1", "block", "b.example.com", "add", D(2024, 1, 1)), ("l1", "block", "b.example.com", "add", D(2024, 1, 1)),
        ("l1", "block", "b.example.com", "drop", D(2024, 1, 10)), ("l1", "block", "b.example.com", "add", D(2024, 2, 1)),
        ("l2", "allow", "b.example.com/ok", "add", D(2023, 1, 1)), ("l3", "block", None, "add", D(2024, 1, 1)),
        ("l4", "block", "example.com", "add", D(2024, 1, 3)), ("l4", "block", "example.com", "drop", D(2024, 1, 3)),
    ], "list string, kind string, pattern string, action string, at timestamp")
    for buckets in (1, 3, 64):
        got = {(r["page_id"], r["blocked"], tuple(r["blocked_by"]), tuple(r["allowed_by"]))
               for r in url_filter.filter_captures(captures, entries, buckets).collect()}
        assert got == {(1, True, ("l1",), ()), (2, False, (), ()), (3, True, ("l1",), ()), (4, False, (), ()),
                       (5, False, (), ()), (6, False, ("l1",), ("l2",)), (7, False, (), ())}
    assert url_filter.filter_captures(captures, entries.limit(0)).where("blocked").count() == 0
    assert url_filter.filter_captures(captures.limit(0), entries).count() == 0


def test_url_filter_reads_real_urls(spark):
    """User names, deeper paths, times within one second, clashing columns, a
    very long URL."""
    from datetime import datetime as D

    from medallion.llm import url_filter

    at = D(2024, 1, 5, 12, 0, 0)
    long_url = "http://ok.example/" + "x/" * 20_000
    captures = spark.createDataFrame([
        (1, "http://user@evil.example/", at, "x", 1), (2, "http://user:p%40ss@evil.example:80/a", at, "x", 1), (3, "http://a@b@evil.example/", at, "x", 1),
        (4, "http://ok.example/a/b/c", at, "x", 1), (5, "http://ok.example/a/bc", at, "x", 1), (6, "http://ok.example/a/b", at, "x", 1),
        (7, "http://ok.example/a/b/", at, "x", 1), (8, "http://ok.example/x?u=http://me@evil.example/", at, "x", 1), (9, long_url, at, "x", 1),
        (10, "http://soon.example/", at, "x", 1), (11, "http://soon.example/", D(2024, 1, 5, 12, 0, 0, 500_000), "x", 1),
    ], "page_id long, url string, fetched timestamp, pattern string, bucket int")
    entries = spark.createDataFrame([
        ("l", "block", "evil.example", "add", D(2024, 1, 1)), ("l", "block", "ok.example/a/b", "add", D(2024, 1, 1)),
        ("l", "block", "soon.example", "drop", D(2024, 1, 5, 12, 0, 0, 100_000)), ("l", "block", "soon.example", "add", D(2024, 1, 5, 12, 0, 0, 400_000)),
    ], "list string, kind string, pattern string, action string, at timestamp")
    for buckets in (1, 64):
        got = {r["page_id"] for r in url_filter.filter_captures(captures, entries, buckets).where("blocked").collect()}
        assert got == {1, 2, 3, 4, 6, 7, 11}


def test_embeddings_over_awkward_rows(spark, tmp_path, monkeypatch):
    import numpy as np

    from medallion.llm import embedding_pq, oracles

    monkeypatch.setattr(embedding_pq, "CHUNK", 32)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(30, 16))
    rows = [(n, (base[n % 30] + rng.normal(size=16) * (0.03 if n % 4 else 0.0)).tolist(), n % 3 if n % 11 else None) for n in range(400)]
    hot = (base[0] * 2).tolist()
    rows += [(1000 + n, hot, 0) for n in range(150)]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 16, 1), (2003, [float("nan")] * 16, 1), (2004, [None] + [1.0] * 15, 1),
             (2005, [float("inf")] * 16, 1), (2006, base[1].tolist() + [0.0], 1), (2007, [3.0], 1), (2008, [4.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    path = fixture_dir(spark, tmp_path, embeddings=frame)
    got = rows_of(embedding_pq.near_duplicates(frame))
    con = duck(SF_SMALL)
    con.execute(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{path}/embeddings.parquet/*.parquet'")
    rel = con.execute(oracles.EMBEDDINGS)
    assert got == canonical([d[0] for d in rel.description], rel.fetchall())
    assert embedding_pq.near_duplicates(frame.limit(0)).count() == 0


def test_entry_works_without_the_subpackage(monkeypatch):
    real = builtins.__import__

    def without(name, *args, **kwargs):
        if name == "corpus_pipeline" or name.startswith("medallion.llm"):
            raise ImportError(name)
        return real(name, *args, **kwargs)

    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("medallion.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)
    monkeypatch.setattr(builtins, "__import__", without)
    entry = importlib.import_module("__spark_entry__")
    assert "sales_mart" in entry.queries() and not any(q.startswith("op") for q in entry.queries())
    assert set(entry.oracle_sql()) == set(entry.queries())
    monkeypatch.undo()
    sys.modules.pop("__spark_entry__", None)
    assert {q.split("_")[0] for q in importlib.import_module("__spark_entry__").queries()} >= {"pipeline", *(f"op{n}" for n in range(1, 11))}


