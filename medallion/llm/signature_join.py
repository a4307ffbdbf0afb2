"""Exact Jaccard self-join of documents on word shingles, by signature trees.

Every document is the set of its distinct five-word shingles (64-bit hashes;
a shorter text is one shingle, a text without words has none). Documents with
the same set are one *node* from the start, so copies cost nothing further.

* **Blocks.** Sets that link share one of their smallest hashes: a set of n has
  ``n - ceil(0.8 n) + 1`` prefix hashes, of which the 24 smallest are keys. Up to
  115 shingles that is the whole prefix and the guarantee is absolute; above,
  a link is missed with probability at most 0.2 ** 24 (1.7e-17), less than what
  64-bit hashes leave open anyway. Keys of one node only are dropped.
* **Trees.** Inside a block, nodes are sorted by size and packed into a tree; a
  tree node holds the OR of its members' 1024-bit token bitmaps, their size
  range and the largest number of shingles that share a bit. Two trees are
  walked together level by level; a pair of tree nodes is dropped when the
  sizes are too far apart or the largest possible overlap, ``popcount(a & b)``
  plus the smaller excess, is below what the threshold needs.
* **Hot keys.** A key of more than ``CHUNK`` nodes is split into chunks by size
  class and hash; each pair of chunks whose sizes can link is a block of its
  own, so no task holds more than two chunks at a time and no pair is left out.
* **Verification.** Walk 1 uses bitmaps only and marks the nodes that have a
  candidate. Sets are built for those alone. Each node is first compared in one
  of its blocks; then the blocks that still hold different components are
  compared, skipping pairs that are connected already, with exact sets. What is
  returned is a spanning forest of the links, never all pairs of a group.

Defined results: null or empty texts have no shingles and link with nothing
(their component is their own doc_id); repeated rows give repeated rows of one
component; rows without doc_id take part and get the smallest doc_id of their
component (null if there is none); an empty table gives an empty result; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.common import components, merged_components, table, written

WORDS = 5
KEYS = 24
BITS = 1024
CHUNK = 4096
LEAF = 16
FANOUT = 8

SKETCH = (
    "doc_id long, handle long, n_shingles long, excess int, node binary, keys array<long>, bits binary"
)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    words = (text or "").encode().lower().split()  # ASCII only: A-Z; space, \t..\r
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), len(words))], np.uint64)
    digest = xxhash.xxh64_intdigest
    w = np.fromiter((digest(x) for x in words), np.uint64, len(words))
    n = len(w) - WORDS + 1
    h = w[:n].copy()
    for k in range(1, WORDS):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        h += w[k : k + n]
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    return np.unique(h)


def bitmap(s: np.ndarray) -> tuple[bytes, int]:
    """Token bitmap of a set, and how many elements share a bit with another."""
    on = np.zeros(BITS, np.uint8)
    on[(s >> np.uint64(20)) & np.uint64(BITS - 1)] = 1
    return np.packbits(on).tobytes(), len(s) - int(on.sum())


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 2000):
            part = batch.slice(lo, 2000)
            n, excess, node, keys, bits = [], [], [], [], []
            for t in part.column("text"):
                s = shingle_set(t.as_py())
                b, e = bitmap(s)
                take = min(KEYS, len(s) - -(-4 * len(s) // 5) + 1) if len(s) else 0
                n.append(len(s))
                excess.append(e)
                node.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                keys.append(s[:take].view(np.int64))
                bits.append(b)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), part.column("handle"), pa.array(n, pa.int64()), pa.array(excess, pa.int32()),
                    pa.array(node, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(bits, pa.binary()),
                ],
                ["doc_id", "handle", "n_shingles", "excess", "node", "keys", "bits"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 1000):
            node, n, excess, bits, shingles = [], [], [], [], []
            for t in batch.column("text").slice(lo, 1000):
                s = shingle_set(t.as_py())
                if len(s):
                    b, e = bitmap(s)
                    node.append(xxhash.xxh3_128_digest(s.tobytes()))
                    n.append(len(s))
                    excess.append(e)
                    bits.append(b)
                    shingles.append(s.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(node, pa.binary()), pa.array(n, pa.int64()), pa.array(excess, pa.int32()),
                 pa.array(bits, pa.binary()), pa.array(shingles, pa.binary())],
                ["node", "n_shingles", "excess", "bits", "shingles"],
            )


# --------------------------------------------------------------- signature tree


def candidate_pairs(sizes: np.ndarray, excess: np.ndarray, bits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j), i < j, of a block that may link; ``sizes`` ascending.

    Level-by-level dual traversal of the block's tree against itself."""
    levels = [(sizes, sizes, excess, bits)]
    step = LEAF
    while len(levels[-1][0]) > 1:
        lo, hi, ex, b = levels[-1]
        at = np.arange(0, len(lo), step)
        levels.append((lo[at], np.maximum.reduceat(hi, at), np.maximum.reduceat(ex, at), np.bitwise_or.reduceat(b, at)))
        step = FANOUT
    i = j = np.zeros(1, np.int64)
    yield from _descend(levels, len(levels) - 1, i, j)


def _descend(levels: list, at: int, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """From surviving pairs of one level to those of the level below; wide
    frontiers are taken a slice at a time."""
    if at == 0:
        yield i, j
        return
    fan = LEAF if at == 1 else FANOUT
    lo, hi, ex, bits = levels[at - 1]
    grid = np.arange(fan)
    for s in range(0, len(i), 512):
        a = (i[s : s + 512, None, None] * fan + grid[:, None]) + 0 * grid
        b = (j[s : s + 512, None, None] * fan + grid) + 0 * grid[:, None]
        a, b = a.ravel(), b.ravel()
        keep = (a < len(lo)) & (b < len(lo)) & ((a < b) if at == 1 else (a <= b))
        a, b = a[keep], b[keep]
        keep = 5 * hi[a] >= 4 * lo[b]  # b is never the smaller
        a, b = a[keep], b[keep]
        for t in range(0, len(a), 1 << 16):
            x, y = a[t : t + (1 << 16)], b[t : t + (1 << 16)]
            most = np.bitwise_count(bits[x] & bits[y]).sum(axis=1, dtype=np.int64) + np.minimum(ex[x], ex[y])
            most = np.minimum(most, np.minimum(hi[x], hi[y]))
            keep = 9 * most >= 4 * (lo[x] + lo[y])
            if keep.any():
                yield from _descend(levels, at - 1, x[keep], y[keep])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The runs of equal ``block`` in a sorted stream, each sorted by size."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        ids = batch.column("block").to_numpy(zero_copy_only=False)
        if not len(ids):
            continue
        cuts = np.flatnonzero(np.diff(ids)) + 1
        edges = [0, *cuts.tolist(), len(ids)]
        for k, (lo, hi) in enumerate(zip(edges, edges[1:])):
            if held and held[-1].column("block")[0].as_py() != int(ids[lo]):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def _signature(block: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    n = block.column("n_shingles").to_numpy()
    order = np.argsort(n, kind="stable")
    block = block.take(order) if (np.diff(n) < 0).any() else block
    bits = np.frombuffer(b"".join(block.column("bits").to_pylist()), np.uint64).reshape(len(n), -1)
    return block, block.column("n_shingles").to_numpy(), block.column("excess").to_numpy().astype(np.int64), bits


def _assigned(keys: list[np.ndarray], key: np.uint64, i: int, j: int) -> bool:
    """Whether a block's key is the smallest that two nodes share: of the
    blocks both are in, exactly one compares them."""
    both = np.intersect1d(keys[i], keys[j], assume_unique=True)
    return bool(len(both)) and both[0] == key


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, key, side, node) of nodes with a candidate partner in the block.
    Where rows tell their component and keys, a partner is one of another
    component that this block is the one to compare with."""
    names = ["block", "key", "side", "node"]
    held: list[pa.Table] = []
    rows = 0

    def flush():
        table = pa.concat_tables(held).combine_chunks()
        held.clear()
        return table.to_batches()

    for block in _blocks(batches):
        if block.num_rows < 2:
            continue
        block, sizes, excess, bits = _signature(block)
        side = block.column("side").to_numpy()
        again = "component" in block.column_names
        if again:
            component = np.unique(np.array(block.column("component").to_pylist(), object), return_inverse=True)[1]
            keys = [np.array(k, np.int64).view(np.uint64) for k in block.column("keys").to_pylist()]
            key = np.int64(block.column("key")[0].as_py()).view(np.uint64)
        marked = np.zeros(len(sizes), bool)
        for i, j in candidate_pairs(sizes, excess, bits):
            keep = (side[i] != side[j]) | (side[i] == 2)
            if again:
                keep &= component[i] != component[j]
            i, j = i[keep], j[keep]
            if again:
                for x, y in zip(i.tolist(), j.tolist()):
                    if not (marked[x] and marked[y]) and _assigned(keys, key, x, y):
                        marked[x] = marked[y] = True
            else:
                marked[i] = marked[j] = True
        if marked.any():
            held.append(block.select(names).filter(pa.array(marked)))
            rows += held[-1].num_rows
            if rows > 20_000:
                yield from flush()
                rows = 0
    if held:
        yield from flush()


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b): a spanning forest of the exact links of each block. ``component``
    is what is known to be connected before."""
    out: list[tuple[bytes, bytes]] = []

    def flush():
        batch = pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.binary())], ["a", "b"]
        )
        out.clear()
        return batch

    for block in _blocks(batches):
        if block.num_rows < 2:
            continue
        block, sizes, excess, bits = _signature(block)
        nodes = block.column("node").to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in block.column("shingles").to_pylist()]
        first: dict[bytes, int] = {}
        root = [first.setdefault(c, k) for k, c in enumerate(block.column("component").to_pylist())]

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for i, j in candidate_pairs(sizes, excess, bits):
            for x, y in zip(i.tolist(), j.tolist()):
                p, q = find(x), find(y)
                if p == q:
                    continue
                both = int(np.isin(sets[x], sets[y], assume_unique=True, kind="sort").sum())
                if 100 * both >= 80 * (len(sets[x]) + len(sets[y]) - both):
                    root[p] = q
                    out.append((nodes[x], nodes[y]))
        if len(out) > 20_000:
            yield flush()
    yield flush()


# ------------------------------------------------------------------------- join


def _in_blocks(rows: DataFrame) -> DataFrame:
    return rows.repartition("block").sortWithinPartitions("block")


def _block_rows(nodes: DataFrame) -> DataFrame:
    """(block, key, side, node): every node in the blocks of its keys. Keys of
    one node make none; keys of many nodes make a block for each pair of chunks,
    of which side 0 meets side 1 (side 2: one chunk, all meet)."""
    rows = nodes.select("node", F.explode("keys").alias("key"))
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = rows.join(counts, "key")
    small = shared.where(F.col("df") <= CHUNK).select(F.xxhash64("key").alias("block"), "key", F.lit(2).alias("side"), "node")

    # size classes a factor of 0.8 wide: only equal and neighbouring classes link
    size_class = F.floor(F.log(F.col("n_shingles").cast("double")) / F.log(F.lit(1.25)))
    large = shared.where(F.col("df") > CHUNK).join(nodes.select("node", "n_shingles"), "node")
    large = written(large.select("key", "node", size_class.alias("cls")), "hot_keys")
    parts = large.groupBy("key", "cls").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("parts"))
    near = parts.select("key", F.explode(F.array(F.col("cls") - 1, F.col("cls"), F.col("cls") + 1)).alias("cls"),
                        F.col("cls").alias("other"), F.col("parts").alias("other_parts"))
    # one row per class: its own number of chunks, and those of the classes it can link with
    plan = parts.join(near.groupBy("key", "cls").agg(F.collect_list(F.struct("other", "other_parts")).alias("others")),
                      ["key", "cls"])
    chunked = (
        large.join(plan, ["key", "cls"])
        .withColumn("sub", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .select("key", "node", "cls", "sub", F.explode("others").alias("o"))
        .select("key", "node", "cls", "sub", F.col("o.other").alias("other"),
                F.explode(F.sequence(F.lit(0), F.col("o.other_parts") - 1)).alias("other_sub"))
    )
    own, other = F.struct(F.col("cls").alias("c"), F.col("sub").alias("s")), F.struct(
        F.col("other").alias("c"), F.col("other_sub").alias("s"))
    side = F.when(own < other, 0).when(own > other, 1).otherwise(2)
    return small.union(
        chunked.select(F.xxhash64("key", F.least(own, other), F.greatest(own, other)).alias("block"), "key", side.alias("side"), "node")
    )


def link_components(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sketches, joined): one sketch row per row of ``docs``, and the component
    (its smallest node) of every node that has a link."""
    handled = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text")).alias("handle"),
        "text",
    )
    sketches = written(handled.mapInArrow(_sketch, SKETCH), "sketches")
    nodes = written(
        sketches.where("node IS NOT NULL").groupBy("node").agg(
            F.min("handle").alias("handle"),
            *[F.first(c).alias(c) for c in ("n_shingles", "excess", "keys", "bits")],  # equal for equal nodes
        ),
        "nodes",
    )
    signature = nodes.select("node", "n_shingles", "excess", "bits")
    blocks = _block_rows(nodes.select("node", "n_shingles", "keys")).join(signature, "node")
    mark = "block long, key long, side int, node binary"
    marked = written(_in_blocks(blocks).mapInArrow(_mark, mark), "marked")

    wanted = nodes.join(marked.select("node").distinct(), "node", "left_semi").select("handle")
    texts = handled.join(wanted, "handle", "left_semi").dropDuplicates(["handle", "text"]).select("text")
    sets = written(texts.mapInArrow(_sets, "node binary, n_shingles long, excess int, bits binary, shingles binary"), "sets")

    verified = "a binary, b binary"
    first = marked.groupBy("node").agg(F.min("block").alias("block"))
    own = first.join(sets, "node").withColumn("component", F.col("node"))
    links = written(_in_blocks(own).mapInArrow(_verify, verified), "links_first")

    joined = written(components(links), "joined")
    known = marked.join(joined, "node", "left").select("block", "key", "side", "node", F.coalesce("component", "node").alias("component"))
    open_blocks = known.groupBy("block").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    unsettled = known.join(open_blocks.select("block"), "block", "left_semi").join(
        nodes.select("node", "n_shingles", "excess", "bits", "keys"), "node")
    unsettled = written(_in_blocks(unsettled).mapInArrow(_mark, mark), "unsettled")
    rest = unsettled.select("block", "node").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    more = written(_in_blocks(rest.join(sets, "node")).mapInArrow(_verify, verified), "links_rest")
    return sketches, merged_components(joined, more)


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    sketches, joined = link_components(docs)
    member = sketches.select("doc_id", "n_shingles", "node").join(joined, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "node").alias("component")
    )
    least = member.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    least = written(least, "least")  # a plain side, so that AQE can split a hot component's rows
    return member.join(least, "component", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` of each component: the one of the smallest doc_id
    (rows without come last). A row is its doc_id and text, so texts that share a
    doc_id are told apart, rows without doc_id take part, and repeated rows are
    one."""
    row = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").isNull(), "text")
    named = written(docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("doc_id")), "rows").distinct()
    joined = jaccard_components(docs.select(row.alias("doc_id"), "text")).select(F.col("doc_id").alias("row"), "component_id").distinct()
    first = F.min_by("row", F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    kept = joined.join(named, "row").groupBy("component_id").agg(first.alias("_kept_row"))
    return docs.withColumn("_kept_row", row).join(kept.select("_kept_row"), "_kept_row", "left_semi").dropDuplicates(["_kept_row"]).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
