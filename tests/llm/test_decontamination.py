"""op2 against exact edit distance of every item to every document."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from medallion.llm import decontamination as dc
from medallion.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm.fixtures import awkward, awkward_rows, empty

ITEMS = "item_id long, text string"


def masks_of(words):
    masks = {}
    for k, w in enumerate(words):
        masks[w] = masks.get(w, 0) | 1 << k
    return masks


def plain_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        before, row = row, [i]
        for j, t in enumerate(text, 1):
            row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (p != t)))
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=70), st.lists(st.integers(1, 5), max_size=40))
def test_bit_parallel_distance(pattern, text):
    assert dc.edit_distance(masks_of(pattern), len(pattern), text) == plain_distance(pattern, text)


def brute(docs, items):
    """(doc_id, item_id, edits) of every leak, each document read in full."""
    found = set()
    for item_id, item in items:
        words = dc.words_of(item)
        if not words:
            continue
        masks, most = masks_of(words), int(dc.MAX_EDITS * len(words))
        for doc_id, text in docs:
            edits = dc.edit_distance(masks, len(words), dc.words_of(text))
            if edits <= most:
                found.add((doc_id, item_id, edits))
    return found


def test_query_finds_what_brute_force_finds(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF_SMALL, "documents").collect()]
    items = [(r["item_id"], r["text"]) for r in table(spark, SF_SMALL, "benchmark").collect()]
    got = {(r["doc_id"], r["item_id"], r["edits"]) for r in dc.query(spark, SF_SMALL).collect()}
    assert got == brute(docs, items) and got


def test_edited_passages_are_found(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)] + ["the", "of", "and"] * 40
    items = [(n, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(6, 70)))) for n in range(60)]
    rows, planted = [], 0
    for n, (_, text) in enumerate(items):
        words = text.split()
        for _ in range(int(0.1 * len(words))):
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice([[], ["new"], [words[at], "more"]])
        around = [rng.choice(vocabulary) for _ in range(80)]
        rows.append((n, " ".join(around[:40] + words + around[40:]).upper() if n % 2 else ", ".join(words)))
    got = {(r["doc_id"], r["item_id"]) for r in dc.find_leaks(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, ITEMS)).collect()}
    want = {(d, i) for d, i, _ in brute(rows, items)}
    planted = {(n, n) for n in range(60)}
    assert got <= want and len(want - got) <= 1 and len(planted - got) <= 1


def bitmap_of(codes):
    """The bitmap that the operator has Spark build."""
    bits = 22
    data = np.zeros(1 << (bits - 3), np.uint8)
    for place in (codes >> np.uint64(64 - bits), codes & np.uint64((1 << bits) - 1)):
        np.bitwise_or.at(data, place >> np.uint64(3), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))
    return dc.Bitmap(bits, data.tobytes())


def search(docs, items):
    """(doc_id, item_id) of the passages that share a code with an item and
    hold it: the operator's steps without Spark."""
    hashes, of_code, reach = dc._Hashes(), {}, {}
    words = {i: hashes.of(dc.words_of(text)) for i, text in items}
    whole, owner, other = dc.codes_of(list(words.values()))
    every = [whole, other]
    for c, k in zip(whole.tolist(), owner.tolist()):
        of_code.setdefault(c, set()).add(list(words)[k])
    for w in words.values():
        for lo, hi in dc.windows_of(len(w)):
            reach[dc.class_of(hi - lo)] = max(len(w), reach.get(dc.class_of(hi - lo), 0))
    found = set()
    for k, _, text, codes in dc.passages_in([t for _, t in docs], bitmap_of(np.concatenate(every)), reach, hashes):
        for i in set().union(*(of_code.get(c, set()) for c in codes.tolist())):
            edits = dc.edit_distance(masks_of(words[i].tolist()), len(words[i]), text.tolist())
            if edits <= int(dc.MAX_EDITS * len(words[i])):
                found.add((docs[k][0], i))
    return found


def edited(rng, words, at):
    """The words with one edit at each place: left out, replaced or put in."""
    out = []
    for k, w in enumerate(words):
        out += [w] if k not in at else rng.choice([[], [f"new{k}"], [f"new{k}", w]])
    return out


def test_recall_at_every_length_and_place_of_edits():
    """At the most edits allowed, wherever they are, at least 0.99 is found;
    unedited leaks always."""
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(4000)] + ["the", "of", "and"] * 100
    for n in [1, 2, 3, 4, 5, 6, 7, 8, 10, 13, 16, 20, 24, 28, 32, 33, 40, 50, 59, 70, 200]:
        items = [(k, " ".join(rng.choice(vocabulary) for _ in range(n))) for k in range(25)]
        most, docs, whole = int(dc.MAX_EDITS * n), [], set()
        for _, text in items:
            words = text.split()
            for at in ((), range(most), range(n - most, n), *(rng.sample(range(n), most) for _ in range(4))):
                passage = edited(rng, words, set(at))
                around = [rng.choice(vocabulary) for _ in range(40)]
                if not at:
                    whole.add(len(docs))
                docs.append((len(docs), " ".join(around[:20] + passage + around[20:])))
        got, want = search(docs, items), {(d, i) for d, i, _ in brute(docs, items)}
        planted = {(d, d // 7) for d, _ in docs}
        assert got <= want and len(planted & want - got) <= 0.01 * len(planted), (n, len(planted & want - got))
        assert {(d, d // 7) for d in whole} <= got


def test_walks_skip_what_leaves_the_window():
    hashes = dc._Hashes()
    for n in range(1, 80):
        ids = hashes.of([f"w{k}".encode() for k in range(n)])
        whole, owner, other = dc.codes_of([ids])
        classes = {dc.class_of(hi - lo) for lo, hi in dc.windows_of(n)}
        assert len(dc.windows_of(n)) <= len(whole) == len(owner) <= sum(map(dc.repetitions, classes)) * len(dc.windows_of(n))
        assert len(other) >= n and not owner.any()


def test_awkward_rows(spark):
    items = spark.createDataFrame(
        [(1, awkward_rows()[0][1]), (2, None), (3, ""), (4, "one zebra"), (5, "!?"), (None, "while many other animals look on"), (1, awkward_rows()[0][1])], ITEMS)
    want = {(d, i, 0) for d in (1, 2, 3, None, 12) for i in (1, None)}
    got = dc.find_leaks(awkward(spark), items).collect()
    assert {(r["doc_id"], r["item_id"], r["edits"]) for r in got} == want
    clean = dc.drop_leaks(awkward(spark), items)
    assert clean.columns == awkward(spark).columns
    assert sorted(r["doc_id"] for r in clean.collect()) == [4, 5, 6, 7, 8, 9, 10, 11, 13]
    none = spark.createDataFrame([], ITEMS)
    assert dc.find_leaks(awkward(spark), none).count() == 0 and dc.drop_leaks(awkward(spark), none).count() == len(awkward_rows())
    assert dc.find_leaks(empty(spark), items).count() == 0


def test_short_items_match_exactly(spark):
    items = spark.createDataFrame([(1, "quiet zebra"), (2, "Zebra"), (3, "five short words in all")], ITEMS)
    docs = spark.createDataFrame(
        [(1, "a quiet, ZEBRA"), (2, "quiet as a zebra"), (3, "zebras"), (4, "five short words in all"), (5, "four short words in all"),
         (6, "zebra " * 3000)], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["start_word"], r["edits"]) for r in dc.find_leaks(docs, items).collect()}
    assert {g for g in got if g[1] != 3} == {(1, 1, 1, 0), (1, 2, 2, 0), (2, 2, 3, 0), (6, 2, 0, 0)}
    assert {(d, e) for d, i, _, e in got if i == 3} == {(4, 0), (5, 1)}


def test_hot_item_and_repeated_rows(spark):
    """One item in a third of all rows, and rows that repeat: each row once."""
    item = "seven brown foxes wrote a letter about the harbour in winter"
    docs = [(n % 90, f"{item} {n % 90}" if n % 3 == 0 else f"something else number {n % 90}") for n in range(180)]
    rows = dc.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(8, item), (9, item)], ITEMS)).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in rows) == sorted((d, i) for d, t in docs if t.startswith(item) for i in (8, 9))
