"""op12 against a plain Merkle tree in memory."""

import zlib
from hashlib import sha256

import pytest

from medallion.llm import merkle_manifest as mm
from medallion.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm.fixtures import awkward, awkward_rows, empty, fixture_dir


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    fields = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return h(*fields)


def tree(nodes):
    """(root, proofs): each proof lists (left siblings, right siblings)."""
    proofs, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for p, at in zip(proofs, where):
            lo = at // 3 * 3
            p.append((nodes[lo:at], nodes[at + 1 : lo + 3]))
        nodes = [h(*nodes[k : k + 3]) for k in range(0, len(nodes), 3)]
        where = [at // 3 for at in where]
    return nodes[0], proofs


def brute(docs):
    """The query's rows, sorted, from (doc_id, text, lang, source, n_chars) rows."""
    sources = {}
    for row in docs:
        sources.setdefault(row[3], []).append((row[0], leaf_of(*row), row))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        sources[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[s] = tree([r[1] for r in sources[s]])
    root, above = tree([trees[s][0] for s in names]) if names else (None, [])
    out = []
    for s, upper in zip(names, above):
        for (doc_id, leaf, row), proof in zip(sources[s], trees[s][1]):
            proof = proof + upper
            text = row[1]
            if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
                text = text.replace("\n", "")
            now = leaf_of(row[0], text, *row[2:5])
            for left, right in proof:
                now = h(*left, now, *right)
            out.append((doc_id, leaf, trees[s][0], root, h(*[d for left, right in proof for d in left + right]), now, now == root))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def rows_of(frame):
    assert frame.columns == COLUMNS
    return sorted(map(tuple, frame.collect()), key=str)


def plain(frame):
    return [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in frame.collect()]


@pytest.mark.parametrize("height", [1, 2, mm.HEIGHT])
def test_query_equals_the_plain_tree(spark, monkeypatch, height):
    monkeypatch.setattr(mm, "HEIGHT", height)
    want = brute(plain(table(spark, SF_SMALL, "documents")))
    assert rows_of(mm.query(spark, SF_SMALL)) == want
    assert {r[6] for r in want} == {True, False}


def test_awkward_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(mm, "HEIGHT", 1)
    got = rows_of(mm.query(spark, fixture_dir(spark, tmp_path)))
    assert got == brute([r[:5] for r in awkward_rows()]) and len(got) == len(awkward_rows())


def test_empty_lone_and_equal_rows(spark, tmp_path, monkeypatch):
    assert rows_of(mm.query(spark, fixture_dir(spark, tmp_path / "none", empty(spark)))) == []
    schema = awkward(spark).schema
    one = spark.createDataFrame(awkward_rows()[:1], schema)
    got = rows_of(mm.query(spark, fixture_dir(spark, tmp_path / "one", one)))
    assert got == brute([awkward_rows()[0][:5]]) and got[0][1] == got[0][2] == got[0][3]
    monkeypatch.setattr(mm, "HEIGHT", 2)
    equal = spark.createDataFrame([awkward_rows()[1]] * 40 + [awkward_rows()[7]] * 4, schema).repartition(7)
    assert rows_of(mm.query(spark, fixture_dir(spark, tmp_path / "equal", equal))) == brute([awkward_rows()[1][:5]] * 40 + [awkward_rows()[7][:5]] * 4)


def test_many_sources_and_one_hot_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(mm, "HEIGHT", 2)
    rows = [(k * 7 % 211, f"text {k}\nline", "en", "hot" if k % 3 == 0 else f"s{k}", k) for k in range(211)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert rows_of(mm.query(spark, fixture_dir(spark, tmp_path, docs))) == brute(rows)


def test_proofs_can_be_checked_by_hand(spark):
    docs = spark.createDataFrame([(k, f"t{k}", "en", "a", 2) for k in range(7)], "doc_id long, text string, lang string, source string, n_chars long")
    for r in mm.manifest(docs).collect():
        now = r["leaf"]
        for step in r["proof"].split(";"):
            left, right = step.split(":")
            now = h(left, now, right)
        assert now == r["root"] == r["subroot"] and r["found"] == r["leaf"]
