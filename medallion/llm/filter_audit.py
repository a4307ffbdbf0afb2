"""Interaction audit of corpus filters, with duplicates found by radix text tries.

Five filters (the fixed rules under ``failures``, and E: the text of a smaller
doc_id) are applied in every order; per source and order the audit says what each
step removes, what it would have removed alone, and each filter's Shapley share.

* **Local tries.** A task inserts the texts it reads into a compressed trie whose
  terminals hold the least doc_id. A row whose id is not the least of its
  terminal fails E whatever other tasks hold, so it leaves without its text. What
  is left is one row per terminal and trie, so a text that a third of all rows
  share is shuffled once per ``TRIE_BYTES`` of texts, not once per row.
* **Adaptive prefixes.** Every local trie reports the prefixes that part it into
  about ``POINTS`` equal shares, each as long as the trie needs to tell it from
  its neighbours. Their sorted running weights over all tries give the bounds of
  ranges of about equal bytes; a prefix that many texts share is
  parted further down. The bounds are the only list that reaches the driver: one
  per ``RANGE_BYTES`` of distinct text (a million for 64 TB).
* **Range tries.** A task holds the trie of one range. A row that loses its
  terminal to a smaller id, or comes after it, is emitted as a duplicate at once,
  so a terminal never holds more than one id's rows. The trie is traversed for the
  rest.
* **Masks.** A document is reduced to five bits, joined with its labels and
  counted: at most 32 counts per source, from which all 120 orders follow.

Defined results: null texts are empty texts, null sources the empty part; rows
without doc_id never fail E and make no other row fail it; repeated rows of one
doc_id and text do not fail E for each other; a doc_id with several labels has
quality or is toxic if one says so; an empty table has no parts; extra columns
are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medallion.llm.common import table, written

# The filters' letters; a filter's bit is its place here.
FILTERS = "ABCDE"
DUPLICATE = 1 << FILTERS.index("E")

TRIE_BYTES = 32 << 20
TRIE_ROWS = 100_000
POINTS = 64
RANGE_BYTES = 64 << 20
SMALLEST_RANGE = 1 << 20

_UPPER = bytes(range(65, 91))
_MARKED = re.compile(rb"[#$%&*|]")
DECIDED, FIRST, POINT = 0, 1, 2
LOCAL = "kind int, doc_id long, part string, mask int, n long, text binary, parts array<struct<part:string,n:long>>"
ROWS = "doc_id long, part string, mask int, n long"


def failures(text: str, raw: bytes) -> int:
    """The filters other than E that a text fails, as bits."""
    words = raw.split()  # ASCII only: space, \t..\r
    upper = len(raw) - len(raw.translate(None, _UPPER))
    fails = (len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * upper > 5 * len(text), _MARKED.search(raw) is not None)
    return sum(1 << k for k, fail in enumerate(fails) if fail)


# ------------------------------------------------------------------------ trie


class Node:
    __slots__ = ("edge", "children", "held")

    def __init__(self, edge: bytes):
        self.edge, self.children, self.held = edge, {}, None


class Trie:
    """A compressed trie; ``held`` of a terminal is its owner's."""

    def __init__(self):
        self.root = Node(b"")

    def terminal(self, key: bytes) -> Node:
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = Node(key[at:])
                return child
            edge = child.edge
            if key.startswith(edge, at):
                node, at = child, at + len(edge)
                continue
            lo, hi = 1, len(edge) - 1  # the first byte agrees, the whole edge does not
            while lo < hi:
                mid = (lo + hi + 1) // 2
                lo, hi = (mid, hi) if key.startswith(edge[:mid], at) else (lo, mid - 1)
            branch = node.children[edge[0]] = Node(edge[:lo])
            branch.children[edge[lo]], child.edge = child, edge[lo:]
            node, at = branch, at + lo
        return node

    def walk(self) -> Iterator[tuple[bytes, Node]]:
        """(path above, node) of every node, parents first; no recursion."""
        stack = [(b"", self.root)]
        while stack:
            path, node = stack.pop()
            yield path, node
            below = path + node.edge if node.children else b""
            stack += [(below, child) for child in node.children.values()]

    def shares(self, most: int) -> Iterator[tuple[bytes, int]]:
        """(prefix, bytes of texts under it): subtrees of at most a ``most``-th
        of the trie's texts, or single texts."""
        order = list(self.walk())
        weight = {}
        for path, node in reversed(order):
            own = len(path) + len(node.edge) + 1 if node.held is not None else 0
            weight[id(node)] = own + sum(weight[id(c)] for c in node.children.values())
        limit = weight[id(self.root)] // most
        stack = [(b"", self.root)]
        while stack:
            path, node = stack.pop()
            if weight[id(node)] <= limit or not node.children:
                yield path + node.edge[:8], weight[id(node)]
                continue
            below = path + node.edge
            if node.held is not None:
                yield below, len(below) + 1
            stack += [(below, child) for child in node.children.values()]


# ----------------------------------------------------------------------- tasks


class _Out:
    """Rows of one schema, given out in batches."""

    def __init__(self, schema: pa.Schema, most_bytes: int = 4 << 20):
        self.schema, self.rows, self.bytes, self.most = schema, [], 0, most_bytes

    def add(self, row: tuple, size: int = 64) -> None:
        self.rows.append(row)
        self.bytes += size

    def full(self) -> bool:
        return self.bytes >= self.most

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * len(self.schema)
        self.rows, self.bytes = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema)


_PARTS = pa.list_(pa.struct([("part", pa.string()), ("n", pa.int64())]))
_LOCAL = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("n", pa.int64()),
                    ("text", pa.binary()), ("parts", _PARTS)])
_ROWS = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("n", pa.int64())])


def _local(trie_bytes: int, trie_rows: int):
    """Rows decided by a task's tries, the first row of every terminal, and
    the tries' shares."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, rows, size, out = Trie(), 0, 0, _Out(_LOCAL)
        for batch in batches:
            for doc_id, part, value in zip(batch.column("doc_id").to_pylist(), batch.column("part").to_pylist(), batch.column("text")):
                text = value.as_py() or ""
                raw = text.encode()
                if doc_id is None:
                    out.add((DECIDED, None, part, failures(text, raw), 1, None, None))
                    if out.full():
                        yield out.take()
                    continue
                node = trie.terminal(raw)
                if node.held is None:
                    node.held = (failures(text, raw), {})
                    size += len(raw)
                members = node.held[1]
                members[doc_id, part] = members.get((doc_id, part), 0) + 1
                rows += 1
                if size >= trie_bytes or rows >= trie_rows:
                    yield from _emptied(trie, out)
                    trie, rows, size = Trie(), 0, 0
        if rows:
            yield from _emptied(trie, out)
        if out.rows:
            yield out.take()

    return run


def _emptied(trie: Trie, out: _Out) -> Iterator[pa.RecordBatch]:
    """What a local trie has found, in traversal order."""
    for path, node in trie.walk():
        if node.held is None:
            continue
        mask, members = node.held
        first = min(doc_id for doc_id, _ in members)
        parts = []
        for (doc_id, part), n in members.items():
            if doc_id > first:
                out.add((DECIDED, doc_id, part, mask | DUPLICATE, n, None, None))
            else:
                parts.append({"part": part, "n": n})
        key = path + node.edge
        out.add((FIRST, first, None, mask, None, key, parts), 64 + len(key))
        if out.full():
            yield out.take()
    for prefix, weight in trie.shares(POINTS):
        out.add((POINT, None, None, None, weight, prefix, None), 64 + len(prefix))
    yield out.take()


def _ranged(bounds: list[bytes]):
    """The first rows with the range that their text lies in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [bisect_right(bounds, t.as_buffer().to_pybytes()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), *batch.columns], ["range", *batch.schema.names])

    return run


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, part, mask, n) of the first rows, from a trie per range."""
    out, trie, now = _Out(_ROWS), Trie(), None

    def emit(doc_id: int, parts: dict, mask: int) -> None:
        for part, n in parts.items():
            out.add((doc_id, part, mask, n))

    def flush() -> Iterator[pa.RecordBatch]:
        for _, node in trie.walk():
            if node.held is not None:
                emit(*node.held)
            if out.full():
                yield out.take()

    for batch in batches:
        at = batch.column("range").to_pylist()
        for k, text in enumerate(batch.column("text")):
            if at[k] != now:
                yield from flush()
                trie, now = Trie(), at[k]
            doc_id, mask = batch.column("doc_id")[k].as_py(), batch.column("mask")[k].as_py()
            parts = {p["part"]: p["n"] for p in batch.column("parts")[k].as_py()}
            node = trie.terminal(text.as_py())
            if node.held is None:
                node.held = (doc_id, parts, mask)
            elif doc_id > node.held[0]:
                emit(doc_id, parts, mask | DUPLICATE)
            elif doc_id < node.held[0]:
                emit(node.held[0], node.held[1], mask | DUPLICATE)
                node.held = (doc_id, parts, mask)
            else:
                for part, n in parts.items():
                    node.held[1][part] = node.held[1].get(part, 0) + n
            if out.full():
                yield out.take()
    yield from flush()
    yield out.take()


# ----------------------------------------------------------------------- masks


def range_bounds(points: DataFrame, partitions: int) -> list[bytes]:
    """The texts at which a new range begins: at every equal share of the
    points' running weight in the order of their prefixes."""
    total = points.agg(F.sum("n")).first()[0] or 0
    ranges = max(-(-total // RANGE_BYTES), min(partitions, -(-total // SMALLEST_RANGE)))
    if ranges <= 1:
        return []
    ordered = written(points.groupBy("text").agg(F.sum("n").alias("n")).repartitionByRange("text")
                      .withColumn("part", F.spark_partition_id()), "audit_points")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    base = ordered.groupBy("part").agg(F.sum("n").alias("_all")).select("part", F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("text").rowsBetween(Window.unboundedPreceding, -1)
    run = ordered.withColumn("_before", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(F.broadcast(base), "part")
    share = F.floor((F.col("base") + F.col("_before")) * ranges / total)
    firsts = run.groupBy(share.alias("share")).agg(F.min("text").alias("text")).where("share > 0").collect()
    return sorted({bytes(r["text"]) for r in firsts})


def masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, n): how many rows of that doc_id and source fail
    the filters of that mask."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"), "text")
    local = written(rows.mapInArrow(_local(TRIE_BYTES, TRIE_ROWS), LOCAL), "audit_local")
    bounds = range_bounds(local.where(F.col("kind") == POINT).select("text", "n"), int(spark.conf.get("spark.sql.shuffle.partitions")))
    firsts = local.where(F.col("kind") == FIRST).select("doc_id", "mask", "text", "parts")
    ranged = firsts.mapInArrow(_ranged(bounds), "range long, doc_id long, mask int, text binary, parts array<struct<part:string,n:long>>")
    resolved = ranged.repartition(len(bounds) + 1, "range").sortWithinPartitions("range").mapInArrow(_resolve, ROWS)
    return local.where(F.col("kind") == DECIDED).select("doc_id", "part", "mask", "n").unionByName(resolved)


def counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents, and those labelled so."""
    rows = written(masks(docs), "audit_masks")
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    # a doc_id on very many rows is few rows by then, and rows without one need no join
    each = rows.where("doc_id IS NOT NULL").groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    labelled = each.join(written(known, "audit_labels"), "doc_id", "left")
    rest = rows.where("doc_id IS NULL").withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    return labelled.unionByName(rest).groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"))


AUDIT = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()),
                   *[(c, pa.int64()) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]])


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """600 rows per part from its counts by mask."""
    steps = [("".join(o), k + 1, 1 << FILTERS.index(o[k]), sum(1 << FILTERS.index(f) for f in o[:k]))
             for o in permutations(FILTERS) for k in range(len(FILTERS))]
    bit, before = np.array([s[2] for s in steps]), np.array([s[3] for s in steps])
    mask = np.arange(1 << len(FILTERS))
    fails, earlier = (mask & bit[:, None]) > 0, (mask & before[:, None]) > 0
    removed = fails & ~earlier
    alone = mask == bit[:, None]
    for batch in batches:
        for row in batch.to_pylist():
            n, good, toxic = np.zeros((3, len(mask)), np.int64)
            for c in row["counts"]:
                n[c["mask"]], good[c["mask"]], toxic[c["mask"]] = c["n"], c["good"], c["toxic"]
            out = removed @ n
            shares = {b: out[bit == b].sum() for b in set(bit.tolist())}
            columns = [(~fails & ~earlier) @ n, out, (fails & earlier) @ n, alone @ n, removed @ good, removed @ toxic,
                       np.array([shares[b] for b in bit.tolist()])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["part"]] * len(steps)), pa.array([s[0] for s in steps]), pa.array([s[1] for s in steps], pa.int32()),
                 *[pa.array(c, pa.int64()) for c in columns]], schema=AUDIT)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per source, order of the filters and step."""
    by_part = counts(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))
    return by_part.mapInArrow(_orders, "part string, filter_order string, step int, kept long, removed long, redundant long, "
                                       "unique_fails long, good_lost long, toxic_lost long, shapley long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
