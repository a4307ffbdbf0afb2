"""op8 against brute force over all pairs."""

import random
import re

import numpy as np
import pytest

from medallion.llm import signature_join as sj
from tests.llm.fixtures import awkward, awkward_rows, empty


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x20\x09-\x0d]+", low)


def shingles(text):
    w = words(text)
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    """{doc_id: (n_shingles, component)} by all pairs."""
    sets = [(r[0], shingles(r[1])) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, s) in enumerate(sets):
        if d is not None and s:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d is None, d or 0), len(s), least.get(find(i), d) if s else d) for i, (d, s) in enumerate(sets))


def spark_rows(frame):
    return sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["n_shingles"], r["component_id"]) for r in frame.collect())


def near_copies(rng, groups=12, most=14):
    vocabulary = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 8, 40, 90, 160]))]
        for _ in range(rng.randint(1, most)):
            text = base[:]
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((n, " ".join(text)))
            n += 1
    return rows


def test_awkward_rows(spark):
    assert spark_rows(sj.jaccard_components(awkward(spark))) == brute(awkward_rows())


@pytest.mark.parametrize("chunk", [512, 6])
def test_near_copies_with_and_without_hot_keys(spark, monkeypatch, chunk):
    monkeypatch.setattr(sj, "CHUNK", chunk)
    rows = near_copies(random.Random(chunk))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert spark_rows(sj.jaccard_components(docs)) == brute(rows)


def test_a_large_group_and_a_common_passage(spark, monkeypatch):
    monkeypatch.setattr(sj, "CHUNK", 16)
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(900)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for n in range(150):
        text = base[:]
        for _ in range(rng.randint(1, 3)):
            text[rng.randrange(120)] = f"edit{n}"
        rows.append((n, " ".join(text)))
    rows += [(1000 + n, " ".join(passage + [rng.choice(vocabulary) for _ in range(90)])) for n in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert spark_rows(sj.jaccard_components(docs)) == brute(rows)


def test_empty_table(spark):
    assert sj.jaccard_components(empty(spark)).count() == 0


def test_keep_one_of_each_group(spark):
    kept = sj.keep_one(awkward(spark))
    assert kept.columns == awkward(spark).columns
    ids = [r["doc_id"] for r in kept.collect()]
    want = {c for (null, _), _, c in brute([r for r in awkward_rows() if r[0] is not None])}
    assert sorted(ids) == sorted(want)  # the row without doc_id is a copy of row 1


def test_tree_keeps_every_pair_that_links():
    rng = np.random.default_rng(2)
    pool = np.unique(rng.integers(0, 1 << 63, 500, np.uint64))
    sets = []
    for _ in range(120):
        base = rng.choice(pool, rng.integers(1, 200), replace=False)
        sets.append(np.unique(base))
        sets.append(np.unique(np.concatenate([base[: max(1, len(base) - 3)], rng.integers(0, 1 << 63, 2, np.uint64)])))
    sets.sort(key=len)
    bits, excess = zip(*map(sj.bitmap, sets))
    array = np.frombuffer(b"".join(bits), np.uint64).reshape(len(sets), -1)
    found = {(a, b) for i, j in sj.candidate_pairs(np.array([len(s) for s in sets]), np.array(excess), array)
             for a, b in zip(i.tolist(), j.tolist())}
    n = 0
    for b in range(len(sets)):
        for a in range(b):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                n += 1
                assert (a, b) in found
    assert n > 50 and len(found) < len(sets) * (len(sets) - 1) // 4


def test_keep_one_loses_no_text(spark):
    """Rows are told apart by doc_id and text; copies without doc_id go too."""
    p, q = "the first text has some words in it that others share", "a second text that nothing else in this table holds at all"
    rows = [(1, p), (2, p), (2, q), (None, p), (None, p), (3, None), (4, ""), (4, ""), (None, "alone and without any number at all here"), (5, q)]
    got = sj.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [(1, p), (2, q), (3, None), (4, ""), (None, rows[8][1])], key=repr)


def test_components_of_links_in_two_parts(spark):
    from medallion.llm.common import components, merged_components

    rng = random.Random(6)
    links = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)] + [(5, 5)]
    frame = lambda rows: spark.createDataFrame(rows, "a long, b long")
    for cut in (0, 40, 91):
        got = merged_components(components(frame(links[:cut])), frame(links[cut:]))
        want = components(frame(links))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
