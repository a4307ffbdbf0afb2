"""Benchmark decontamination by the CGK embedding and bit-sampling LSH.

A text is its lower-cased words. An item counts as leaked with at most
``MAX_EDITS`` edits per word of it, k in all. The CGK embedding reads words by
a random walk: step j emits the word under the pointer, and a bit drawn for
(step, word) says whether the pointer moves on. Sequences a few edits apart fall
back into step, so edit distance becomes Hamming distance between walks.
Each repetition draws its own bits and samples ``SAMPLED`` steps of the walk over
the whole window; equal samples make a candidate.

Windows have the item's length. An item of more than ``WINDOW`` words is cut
into windows of nearly equal length, one of which has at most its share of the
edits. Lengths fall into classes; a class takes as many repetitions as a recall
of 0.995 asks for at the most edits allowed (``repetitions``; tests measure it
at every length). An unedited window agrees in every repetition, so exact leaks
are never missed; items of fewer than five words allow no edit and are matched
exactly.

The jobs: the items' samples are written by code, with a bitmap of at most
2 ** ``MOST_BITS`` bits over them, the one thing that tasks are sent. Walks start
at every word of every document around which enough of an item's words and
neighbours stand to leave only the edits allowed, and go on only while their
samples are in the bitmap; where one is sampled to the end, the words around are written as a
passage with the codes found in it. Passages meet items in a join on the code,
and each pair once is verified by exact word edit distance (bit-parallel, free
ends, words by their 64-bit hashes). Items are never on the driver, documents
never shuffled; many items or passages under one code are rows of that join,
which AQE splits.

Defined results: items with null text or without words are not searched for;
null or empty documents hold no leak; repeated rows are treated alike; equal
items are each reported; empty tables give empty results; extra columns pass
through ``drop_leaks`` untouched. ``start_word`` is where the first best
alignment ends less the item's words.
"""

from __future__ import annotations

import hashlib
import math
import random
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.common import table, written
from medallion.operators.sizing import ONE_SIDE_LIMIT, observe_profile, small_side

MAX_EDITS = 0.2
SAMPLED = 4
WINDOW = 32
CLASSES = [1, 2, 3, 4, 5, 6, 8, 10, 12, 16, 20, 24, 28, WINDOW + 1]
BITS_PER_CODE = 64
MOST_BITS = 28
TOGETHER = 500
HITS = "doc_id long, item_id long, start_word long, n_words long, edits long"

_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_TO_SPACE = bytes.maketrans(_PUNCTUATION, b" " * len(_PUNCTUATION))
_WORD, _PAIR = np.uint64(1), np.uint64(2)  # what the bitmap's entries of words and of neighbours start from


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_TO_SPACE).split()


class _Hashes(dict):
    """64-bit hashes of words; 0 is kept for no word."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word) or 1
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def best_match(masks: dict[int, int], length: int, text: list[int]) -> tuple[int, int]:
    """(edits, end): least edit distance between a pattern (bit masks by word)
    and any stretch of ``text``, and where the first such stretch ends: Myers'
    bit-parallel column update."""
    full, high = (1 << length) - 1, 1 << (length - 1)
    up, down, score = full, 0, length
    best, end = score, 0
    for at, w in enumerate(text, 1):
        eq = masks.get(w, 0)
        x = eq | down
        d = (((eq & up) + up) ^ up) | eq
        h_up = (down | ~(d | up)) & full
        h_down = up & d
        if h_up & high:
            score += 1
        elif h_down & high:
            score -= 1
        h_up, h_down = (h_up << 1) & full, (h_down << 1) & full
        up, down = (h_down | ~(x | h_up)) & full, h_up & x
        if score < best:
            best, end = score, at
    return best, end


def edit_distance(masks: dict[int, int], length: int, text: list[int]) -> int:
    return best_match(masks, length, text)[0]


def _mix(code: np.ndarray, token: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (code + token + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def class_of(n: int) -> int:
    """The class of windows of n words: the least length in it."""
    return max(c for c in CLASSES if c <= n)


def repetitions(length: int) -> int:
    """Repetitions of a class. At 0.2 edits a word, anywhere in the window, one
    repetition finds it with probability 0.3 (5 words) to 0.16 (28 words) or
    more; with these numbers of them fewer than 1 in 200 windows are missed."""
    if int(MAX_EDITS * (length + 1)) == 0:
        return 1
    return max(48, 3 * length)


def steps(length: int, repetition: int) -> list[int]:
    """The sampled steps. A walk takes two steps a word on average; the first
    repetition's steps cannot leave the shortest window of the class."""
    span = length if repetition == 0 else 2 * length
    return sorted(random.Random(f"{length}/{repetition}").sample(range(span), min(SAMPLED, span)))


def walk(ids: np.ndarray, start: np.ndarray, length: int, repetition: int, going_on: Callable) -> tuple[np.ndarray, np.ndarray]:
    """(index into ``start``, code) of the walks sampled to the end.
    ``going_on(code, index, pointer)`` gives, after each sampled step, the
    places of the walks to go on with."""
    seed = _mix(np.uint64([length]), np.uint64(1000 + repetition))
    turns = _mix(seed, ids)  # bit j of a word: whether step j goes on from it
    index, at, code = np.arange(len(start)), start, np.repeat(seed, len(start))
    taken = steps(length, repetition)
    for j in range(taken[-1] + 1):
        if j in taken:
            code = _mix(code, ids[at])
            keep = going_on(code, index, at)
            index, at, code = index[keep], at[keep], code[keep]
            if not len(index):
                break
        at = at + ((turns[at] >> np.uint64(j)) & np.uint64(1)).view(np.int64)
    return index, code


def around(ids: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The words that walks from ``start`` (ascending) can reach, without those
    between, and the places of the starts among them."""
    first = np.flatnonzero(np.diff(start, prepend=-1 - 2 * length) > 2 * length)
    last = np.append(first[1:], len(start)) - 1
    size = start[last] + 2 * length + 1 - start[first]
    moved = start[first] - (np.cumsum(size) - size)
    return ids[np.arange(size.sum()) + np.repeat(moved, size)], start - np.repeat(moved, last - first + 1)


def windows_of(n: int) -> list[tuple[int, int]]:
    """(from, to) of the windows of an item of n words."""
    parts = -(-n // WINDOW)
    return [(i * n // parts, (i + 1) * n // parts) for i in range(parts)]


def codes_of(items: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, index of the item of each, other codes): the walks sampled to
    the end; and what comes on the way there, single words and neighbours."""
    ids = np.concatenate([x for w in items for x in (w, np.zeros(1, np.uint64))] + [np.zeros(2 * WINDOW + 1, np.uint64)])
    begin = np.cumsum([0] + [len(w) + 1 for w in items])
    spans = [(begin[k] + lo, begin[k] + hi, k) for k, w in enumerate(items) for lo, hi in windows_of(len(w))]
    whole, owner, other = [], [], [_mix(_WORD, ids), _neighbours(ids)]
    for length in {class_of(hi - lo) for lo, hi, _ in spans}:
        here = np.array([s for s in spans if class_of(s[1] - s[0]) == length])

        def inside(code, index, at):
            keep = np.flatnonzero(at < here[index, 1])  # a walk that left its window has no sample
            other.append(code[keep])
            return keep

        for repetition in range(repetitions(length)):
            index, code = walk(ids, here[:, 0], length, repetition, inside)
            whole.append(code)
            owner.append(here[index, 2])
    return np.concatenate(whole), np.concatenate(owner), np.unique(np.concatenate(other))


def _neighbours(ids: np.ndarray) -> np.ndarray:
    """The codes of each two neighbouring words."""
    return _mix(_mix(_PAIR, ids[:-1]), ids[1:])


class Bitmap:
    """Which codes there are among the items (two bits a code)."""

    def __init__(self, bits: int, data: bytes):
        self.bits, self.data = bits, np.frombuffer(data, np.uint8)

    def _has(self, place: np.ndarray) -> np.ndarray:
        return (self.data[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1

    def places(self, code: np.ndarray) -> np.ndarray:
        """Indexes of the codes that may be there."""
        first = np.flatnonzero(self._has(code >> np.uint64(64 - self.bits)))
        return first[np.flatnonzero(self._has(code[first] & np.uint64((1 << self.bits) - 1)))]


def passages_in(texts: list[str | None], bitmap: Bitmap, reach: dict[int, int], hashes: _Hashes) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(text index, first word, words, codes) of every stretch with candidates.
    ``reach``: the words of the longest item, by class of its windows."""
    parts = [hashes.of(words_of(t)) for t in texts]
    ends = np.cumsum([len(p) + 1 for p in parts])
    ids = np.concatenate([x for p in parts for x in (p, np.zeros(1, np.uint64))] + [np.zeros(2 * WINDOW + 1, np.uint64)])
    known = np.zeros(len(ids), bool)
    known[bitmap.places(_mix(_WORD, ids))] = True
    known &= ids != 0
    pairs = np.zeros(len(ids), bool)
    pairs[bitmap.places(_neighbours(ids))] = True
    pairs[:-1] &= known[:-1] & known[1:]
    words_before, pairs_before = (np.concatenate([[0], np.cumsum(x)]) for x in (known, pairs))
    everywhere = np.arange(ends[-1])
    found = []
    for length, longest in reach.items():
        # an edit takes at most one word and two pairs of neighbours from a window
        sizes = range(length, CLASSES[CLASSES.index(length) + 1])
        edits = [int(MAX_EDITS * (n + 1)) for n in sizes]
        least_words = min(n - k for n, k in zip(sizes, edits))
        least_pairs = min(n - 1 - 2 * k for n, k in zip(sizes, edits))
        low, high = np.maximum(everywhere - edits[-1], 0), np.minimum(everywhere + sizes[-1] + edits[-1], len(ids))
        start = np.flatnonzero(
            (pairs_before[high] - pairs_before[low] >= least_pairs) & (words_before[high] - words_before[low] >= least_words))
        if not len(start):
            continue
        near, places = around(ids, start, length)
        for repetition in range(repetitions(length)):
            index, code = walk(near, places, length, repetition, lambda code, index, at: bitmap.places(code))
            if len(index):
                found.append((start[index], code, np.full(len(index), int(longest * (1 + MAX_EDITS)) + 2)))
    if not found:
        return
    at, code, margin = (np.concatenate(c) for c in zip(*found))
    order = np.argsort(at, kind="stable")
    at, code, margin = at[order], code[order], margin[order]
    which = np.searchsorted(ends, at, side="right")
    low = np.maximum(at - margin, np.where(which > 0, ends[which - 1], 0))
    high = np.minimum(at + margin, ends[which] - 1)
    lo = 0
    while lo < len(at):  # hits of one text whose surroundings overlap are one passage
        hi, a, b = lo + 1, low[lo], high[lo]
        while hi < len(at) and which[hi] == which[lo] and low[hi] <= b:
            a, b, hi = min(a, low[hi]), max(b, high[hi]), hi + 1
        yield int(which[lo]), int(a - (ends[which[lo] - 1] if which[lo] else 0)), ids[a:b], np.unique(code[lo:hi])
        lo = hi


def _items(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(item_id, item) of every item, and (item, words) of the different ones;
    ``item`` is a digest of the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            rows = []
            for item_id, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
                words = words_of(text)
                if words:
                    rows.append((item_id, hashlib.blake2b(b" ".join(words), digest_size=16).digest(), hashes.of(words).tobytes()))
            columns = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.binary()))], ["item_id", "item", "words"])

    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    rows = written(rows.mapInArrow(run, "item_id long, item binary, words binary"), "items")
    return rows.select("item_id", "item"), written(rows.groupBy("item").agg(F.first("words").alias("words")), "item_words")


def _codes(items: DataFrame) -> DataFrame:
    """(code, item): every code of every item, and with a null item all else
    that the bitmap holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(lo, TOGETHER)
                whole, owner, other = codes_of([np.frombuffer(w, np.uint64) for w in part.column("words").to_pylist()])
                item = part.column("item").take(pa.array(owner, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(whole.view(np.int64)), item], ["code", "item"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(other.view(np.int64)), pa.nulls(len(other), pa.binary())], ["code", "item"])

    return written(items.repartition("item").mapInArrow(run, "code long, item binary"), "item_codes")


def _bitmap(codes: DataFrame) -> Bitmap:
    """The bitmap over all codes; its size has a bound, whatever their number."""
    n = codes.agg(F.approx_count_distinct("code")).first()[0]
    bits = max(15, min(MOST_BITS, math.ceil(math.log2(BITS_PER_CODE * max(1, n)))))
    mask = (1 << bits) - 1
    place = F.explode(F.array(F.shiftrightunsigned("code", 64 - bits) + 1, F.col("code").bitwiseAND(F.lit(mask)) + 1))
    pieces = codes.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    data = bytearray(1 << (bits - 3))
    for row in pieces.toLocalIterator():
        data[(row["b"] - 1) * 4096 : row["b"] * 4096] = row["bits"]
    return Bitmap(bits, bytes(data))


def _reach(items: DataFrame) -> dict[int, int]:
    """The words of the longest item, by class of its windows."""
    n = (F.octet_length("words") / 8).cast("long")
    parts = F.ceil(n / F.lit(WINDOW))
    least = F.floor(n / parts)
    out: dict[int, int] = {}
    for row in items.select(n.alias("n"), least.alias("l"), F.ceil(n / parts).alias("h")).groupBy("l", "h").agg(F.max("n").alias("n")).collect():
        for length in (class_of(row["l"]), class_of(row["h"])):
            out[length] = max(out.get(length, 0), row["n"])
    return dict(sorted(out.items()))


def _leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_row, doc_id, text_key, item_id, start_word, n_words, edits): each
    leaked item of each row once."""
    item_ids, items = _items(benchmark)
    codes = _codes(items)
    bitmap, reach = _bitmap(codes), _reach(items)

    def searching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, done, first = _Hashes(), 0, TaskContext.get().partitionId() << 40
        names = ["passage", "doc_row", "doc_id", "text_key", "low", "text_words", "codes"]
        made = 0
        for batch in batches:
            for lo in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(lo, TOGETHER)
                hits = list(passages_in(part.column("text").to_pylist(), bitmap, reach, hashes))
                at = pa.array([h[0] for h in hits], pa.int64())
                yield pa.RecordBatch.from_arrays([
                    pa.array(range(first + made, first + made + len(hits)), pa.int64()),
                    pa.array([first + done + h[0] for h in hits], pa.int64()),
                    part.column("doc_id").take(at), part.column("text_key").take(at),
                    pa.array([h[1] for h in hits], pa.int64()),
                    pa.array([h[2].tobytes() for h in hits], pa.binary()),
                    pa.array([h[3].view(np.int64) for h in hits], pa.list_(pa.int64())),
                ], names)
                done, made = done + part.num_rows, made + len(hits)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    passages = written(texts.mapInArrow(
        searching, "passage long, doc_row long, doc_id long, text_key long, low long, text_words binary, codes array<long>"), "passages")

    def verifying(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_row", "doc_id", "text_key", "item", "start_word", "n_words", "edits"]
        for batch in batches:
            kept, rest = [], []
            columns = (batch.column(c).to_pylist() for c in ("words", "text_words", "low"))
            for k, (words, text, low) in enumerate(zip(*columns)):
                words, text = np.frombuffer(words, np.uint64).tolist(), np.frombuffer(text, np.uint64).tolist()
                masks: dict[int, int] = defaultdict(int)
                for i, w in enumerate(words):
                    masks[w] |= 1 << i
                most = int(MAX_EDITS * len(words))
                if sum(map(masks.__contains__, text)) < len(words) - most:
                    continue  # each word without a partner is an edit
                edits, end = best_match(masks, len(words), text)
                if edits <= most:
                    kept.append(k)
                    rest.append((low + max(0, end - len(words)), len(words), edits))
            at = pa.array(kept, pa.int64())
            numbers = [pa.array(c, pa.int64()) for c in (list(zip(*rest)) or [()] * 3)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in names[:4]), *numbers], names)

    wanted = codes.where("item IS NOT NULL").withColumnRenamed("code", "item_code")
    seen = passages.select("passage", F.explode("codes").alias("code"))
    pairs = seen.join(wanted, F.col("code") == F.col("item_code")).select("passage", "item").distinct()
    pairs = pairs.join(items, "item").join(passages.drop("codes"), "passage").select(
        "doc_row", "doc_id", "text_key", "item", "words", "text_words", "low")
    hits = pairs.mapInArrow(
        verifying, "doc_row long, doc_id long, text_key long, item binary, start_word long, n_words long, edits long")
    best = hits.groupBy("doc_row", "doc_id", "text_key", "item", "n_words").agg(F.min(F.struct("edits", "start_word")).alias("best"))
    return best.join(item_ids, "item").select("doc_row", "doc_id", "text_key", "item_id", "best.start_word", "n_words", "best.edits")


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, edits): every leaked item of
    every document."""
    return _leaks(docs, benchmark).select("doc_id", "item_id", "start_word", "n_words", "edits")


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no leaked item."""
    leaked = _leaks(docs, benchmark).select(F.col("doc_id").alias("_leaked_id"), F.col("text_key").alias("_leaked_key")).distinct()
    observed, profile = observe_profile(leaked)
    leaked = written(observed, "leaked")
    side = small_side(leaked, profile().fits(leaked, leaked.columns, ONE_SIDE_LIMIT))
    same = docs["doc_id"].cast("long").eqNullSafe(side["_leaked_id"]) & (F.xxhash64(docs["text"]) == side["_leaked_key"])
    return docs.join(side, same, "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
