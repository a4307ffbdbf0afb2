"""Approximate nearest neighbours by a navigable small-world graph per shard.

Nearness is Euclidean distance in double precision. Equal vectors are one
*point*, which carries the smallest ``K + 1`` of their ids (more can never be
among ``K`` nearest), so a vector that a third of all rows share costs one node
and cannot fill its neighbours' link lists.

* **Shards.** Points are dealt by hash to shards of about ``SHARD`` points (less
  for wide vectors, ``SHARD_BYTES``). Every point is indexed.
* **Graph.** A point's top layer is drawn from a seeded generator; points are
  numbered from the highest layer down, so layer l is the first ``sizes[l]``
  points. Each is inserted by a beam search of width ``BUILD`` and linked to
  diverse neighbours: a candidate nearer to a chosen neighbour than to the point
  is taken last. Full lists are thinned by the same rule.
* **Flat arrays.** A finished graph is one row of a written table: vectors, link
  starts and links are plain arrays (little-endian bytes), no objects.
* **Search.** Queries travel in packs. A *cell* is one shard and up to
  ``PACKS`` packs, so neither a shard's searches nor a query's shards pile up in
  one task. A beam search of width ``SEARCH`` descends the layers; the distances
  returned are recomputed on the original vectors.
* **Merge.** Each cell returns at most ``K`` rows a query; the nearest of them all
  stay (the limit is applied before the shuffle as well).

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and rows without vec_id, neither ask nor answer; vectors of
another dimension are no candidates; a vec_id on several rows counts once, with
the vector of the smallest digest; ties go to the smaller vec_id; a query with
fewer than ``K`` candidates returns them all; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush, heapreplace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medallion.llm.common import table, written

K = 10
EVERY = 100
SHARD = 8192
SHARD_BYTES = 32 << 20
LINKS = 16
BUILD = 64
SEARCH = 128
PACK = 256
PACKS = 16

INDEX = "dim int, shard int, n int, sizes array<int>, vectors binary, starts binary, links binary, ids array<array<long>>"
FOUND = "query_id long, vec_id long, score double"


# ----------------------------------------------------------------------- graph


class Layer:
    """One layer while it is built: link lists in the rows of an array."""

    def __init__(self, n: int, most: int):
        self.most = most
        self.links = np.zeros((n, most + most // 2), np.int32)
        self.count = np.zeros(n, np.int32)

    def of(self, node: int) -> np.ndarray:
        return self.links[node, : self.count[node]]

    def put(self, node: int, others: np.ndarray) -> None:
        self.links[node, : len(others)] = others
        self.count[node] = len(others)


def beam(x: np.ndarray, q: np.ndarray, of, entry: list[tuple[float, int]], width: int, seen: np.ndarray, stamp: int) -> list[tuple[float, int]]:
    """The up to ``width`` nearest nodes found from ``entry``, nearest first.
    ``seen`` holds the stamp of the last search that met a node."""
    ahead, best = list(entry), [(-d, n) for d, n in entry]
    heapify(ahead)
    heapify(best)
    seen[[n for _, n in entry]] = stamp
    while ahead:
        d, node = heappop(ahead)
        if d > -best[0][0] and len(best) >= width:
            break
        near = of(node)
        near = near[seen[near] != stamp]
        if not len(near):
            continue
        seen[near] = stamp
        gap = x[near] - q
        gap = np.einsum("ij,ij->i", gap, gap)
        if len(best) >= width:
            keep = gap < -best[0][0]
            near, gap = near[keep], gap[keep]
        for d, node in zip(gap.tolist(), near.tolist()):
            if len(best) < width:
                heappush(best, (-d, node))
            elif d < -best[0][0]:
                heapreplace(best, (-d, node))
            else:
                continue
            heappush(ahead, (d, node))
    return sorted((-d, n) for d, n in best)


def diverse(x: np.ndarray, nodes: np.ndarray, gaps: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of ``nodes`` (nearest first): those nearer to the point
    than to any chosen before them, then the nearest of the others."""
    if len(nodes) <= most:
        return nodes
    some = x[nodes]
    chosen, hidden = [], np.zeros(len(nodes), bool)
    for k in range(len(nodes)):
        if not hidden[k]:
            chosen.append(k)
            if len(chosen) == most:
                break
            apart = some - some[k]
            hidden |= np.einsum("ij,ij->i", apart, apart) < gaps
    if len(chosen) < most:
        taken = np.zeros(len(nodes), bool)
        taken[chosen] = True
        chosen += np.flatnonzero(~taken)[: most - len(chosen)].tolist()
    return nodes[chosen]


def build(x: np.ndarray, seed: int = 7) -> tuple[np.ndarray, list[int], np.ndarray, np.ndarray]:
    """(order, sizes, starts, links): the points' new numbers, the number of
    points of each layer, and where each layer's link lists start."""
    n = len(x)
    tops = np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(LINKS)).astype(int)
    order = np.argsort(-tops, kind="stable")
    sizes = [int((tops >= level).sum()) for level in range(tops.max() + 1)]
    tops, y = tops[order], x[order]
    layers = [Layer(size, 2 * LINKS if level == 0 else LINKS) for level, size in enumerate(sizes)]
    seen, stamp = np.zeros(n, np.int32), 0
    for node in range(1, n):
        gap = y[node] - y[0]
        entry = [(float(gap @ gap), 0)]
        for level in range(len(layers) - 1, -1, -1):
            layer, stamp = layers[level], stamp + 1
            inside = level <= tops[node]
            entry = beam(y, y[node], layer.of, entry, BUILD if inside else 1, seen, stamp)
            if not inside:
                continue
            gaps, near = np.array([d for d, _ in entry]), np.array([k for _, k in entry], np.int32)
            chosen = diverse(y, near, gaps, LINKS)
            layer.put(node, chosen)
            for other in chosen.tolist():
                count = layer.count[other]
                if count < layer.links.shape[1]:
                    layer.links[other, count] = node
                    layer.count[other] = count + 1
                    continue
                mine = np.append(layer.of(other), np.int32(node))
                apart = y[mine] - y[other]
                apart = np.einsum("ij,ij->i", apart, apart)
                by = np.argsort(apart, kind="stable")
                layer.put(other, diverse(y, mine[by], apart[by], layer.most))
    counts = np.concatenate([layer.count for layer in layers])
    starts = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts, dtype=np.int64)])
    links = np.concatenate([layer.of(k) for layer in layers for k in range(len(layer.count))] or [np.zeros(0, np.int32)])
    return order, sizes, starts, links


class Graph:
    """A shard's graph over its flat arrays."""

    def __init__(self, row: dict):
        self.x = np.frombuffer(row["vectors"], "<f8").reshape(row["n"], row["dim"])
        self.starts, self.links = np.frombuffer(row["starts"], "<i8"), np.frombuffer(row["links"], "<i4")
        self.ids, self.sizes = row["ids"], row["sizes"]
        self.seen, self.stamp = np.zeros(row["n"], np.int32), 0

    def near(self, q: np.ndarray, k: int, width: int) -> Iterator[tuple[float, int]]:
        """(distance, node) of the k nearest nodes found; equal distances are
        ordered by the smallest id."""
        gap = self.x[0] - q
        entry = [(float(gap @ gap), 0)]
        base = sum(self.sizes)
        for level in range(len(self.sizes) - 1, -1, -1):
            base -= self.sizes[level]
            self.stamp += 1
            starts = self.starts[base : base + self.sizes[level] + 1]

            def of(node: int, starts=starts) -> np.ndarray:
                return self.links[starts[node] : starts[node + 1]]

            entry = beam(self.x, q, of, entry, width if level == 0 else 1, self.seen, self.stamp)
        nodes = [n for _, n in entry]
        exact = np.sqrt(((self.x[nodes] - q) ** 2).sum(axis=1)).tolist()
        yield from sorted(zip(exact, nodes), key=lambda found: (found[0], self.ids[found[1]][0]))[:k]


# ----------------------------------------------------------------------- tasks


def _stack(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One index row per run of equal ``block`` in the sorted stream."""
    from medallion.llm.signature_join import _blocks

    np.seterr(over="ignore")
    for block in _blocks(batches):
        block = block.combine_chunks()
        x = _stack(block.column("embedding").chunk(0))
        order, sizes, starts, links = build(x)
        ids = block.column("ids").take(pa.array(order))
        yield pa.RecordBatch.from_pylist(
            [{"dim": x.shape[1], "shard": block.column("shard")[0].as_py(), "n": len(x), "sizes": sizes,
              "vectors": x[order].astype("<f8").tobytes(), "starts": starts.astype("<i8").tobytes(),
              "links": links.astype("<i4").tobytes(), "ids": ids.to_pylist()}],
            pa.schema([("dim", pa.int32()), ("shard", pa.int32()), ("n", pa.int32()), ("sizes", pa.list_(pa.int32())),
                       ("vectors", pa.binary()), ("starts", pa.binary()), ("links", pa.binary()),
                       ("ids", pa.list_(pa.list_(pa.int64())))]))


def _search(k: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")  # components near the largest double: an infinite distance
        graph = None
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                if row.column("asks")[0].as_py() is None:
                    graph = Graph(row.select(["dim", "n", "sizes", "vectors", "starts", "links", "ids"]).to_pylist()[0])
                    continue
                asks = row.column("asks").flatten()
                out = []
                for query_id, q in zip(asks.field("query_id").to_pylist(), _stack(asks.field("embedding"))):
                    own = []
                    for score, node in graph.near(q, k + 1, width):
                        own += [(score, i) for i in graph.ids[node] if i != query_id]
                    out += [(query_id, i, score) for score, i in sorted(own)[:k]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
                     pa.array([r[2] for r in out], pa.float64())], ["query_id", "vec_id", "score"])

    return run


# ------------------------------------------------------------------------ index


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding, print) of the rows that take part; one per vec_id."""
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    fit = plain.vec_id.isNotNull() & (F.size("embedding") > 0) & finite & F.exists("embedding", lambda v: v != 0)
    marked = written(plain.where(fit).withColumn("print", F.unhex(F.sha2(F.concat_ws(",", "embedding"), 256))), "ann_vectors")
    first = marked.groupBy(F.col("vec_id").alias("_id")).agg(F.min("print").alias("_print"))
    return marked.join(first, (F.col("vec_id") == F.col("_id")) & (F.col("print") == F.col("_print")), "left_semi")


def points_of(rows: DataFrame, k: int) -> DataFrame:
    """(print, embedding, dim, ids): the distinct vectors, each with the
    smallest k + 1 ids that have it. The window's limit runs before its shuffle."""
    by = Window.partitionBy("print").orderBy("vec_id")
    ids = rows.select("print", "vec_id").distinct().withColumn("_rank", F.row_number().over(by)).where(F.col("_rank") <= k + 1)
    ids = ids.groupBy("print").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    one = rows.groupBy("print").agg(F.first("embedding").alias("embedding"))
    return one.join(ids, "print").withColumn("dim", F.size("embedding"))


def build_index(rows: DataFrame, k: int = K, shard: int = SHARD) -> DataFrame:
    """The written index: one row of flat arrays per shard."""
    points = written(points_of(rows, k), "ann_points")
    sizes = {r["dim"]: r["count"] for r in points.groupBy("dim").count().collect()}  # one row per dimension in use
    if not sizes:
        return rows.sparkSession.createDataFrame([], INDEX)
    shards = {dim: -(-n // max(1, min(shard, SHARD_BYTES // (8 * dim)))) for dim, n in sizes.items()}
    per = F.element_at(F.create_map(*[F.lit(v) for pair in shards.items() for v in pair]), F.col("dim"))
    dealt = points.withColumn("shard", F.pmod(F.xxhash64("print"), per).cast("int")).withColumn("block", F.xxhash64("dim", "shard"))
    # a number of partitions is given, so that shards are not merged into few tasks by their bytes
    dealt = dealt.repartitionByRange(2 * sum(shards.values()), "block").sortWithinPartitions("block", "print")
    return written(dealt.select("block", "shard", "embedding", "ids").mapInArrow(_build, INDEX), "ann_index")


def search(index: DataFrame, queries: DataFrame, k: int = K, width: int = SEARCH) -> DataFrame:
    """(query_id, rank, vec_id, score) for ``queries`` (query_id, embedding)."""
    spark = queries.sparkSession
    queries = written(queries.select("query_id", "embedding", F.size("embedding").alias("dim")), "ann_queries")
    asked = {r["dim"]: r["count"] for r in queries.groupBy("dim").count().collect()}
    held = {r["dim"]: r["shards"] for r in index.groupBy("dim").agg((F.max("shard") + 1).alias("shards")).collect()}
    dims = sorted(set(asked) & set(held))
    if not dims:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    packs = {d: -(-asked[d] // PACK) for d in dims}
    groups = {d: -(-packs[d] // PACKS) for d in dims}

    def of(counts: dict) -> F.Column:
        return F.element_at(F.create_map(*[F.lit(v) for d in dims for v in (d, counts[d])]), F.col("dim"))

    known = F.col("dim").isin(dims)
    asks = queries.where(known).groupBy("dim", F.pmod(F.xxhash64("query_id"), of(packs)).cast("int").alias("pack")).agg(
        F.collect_list(F.struct("query_id", "embedding")).alias("asks"))  # about PACK each
    asks = asks.select("dim", F.floor(F.col("pack") / PACKS).cast("int").alias("group"), "asks",
                       F.explode(F.sequence(F.lit(0), of(held) - 1)).alias("shard"))
    graphs = index.where(known).withColumn("group", F.explode(F.sequence(F.lit(0), of(groups) - 1)))
    rows = graphs.unionByName(asks, allowMissingColumns=True).withColumn("cell", F.xxhash64("dim", "shard", "group"))
    cells = sum(held[d] * groups[d] for d in dims)
    rows = rows.repartitionByRange(2 * cells, "cell").sortWithinPartitions("cell", F.col("asks").isNotNull())
    found = written(rows.select("dim", "n", "sizes", "vectors", "starts", "links", "ids", "asks")
                    .mapInArrow(_search(k, width), FOUND), "ann_found")
    nearest = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(vectors: DataFrame, every: int = EVERY, k: int = K) -> DataFrame:
    """The k nearest other vectors of every row whose vec_id ``every`` divides."""
    rows = usable(vectors)
    queries = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "embedding").dropDuplicates(["query_id"])
    return search(build_index(rows, k), queries, k)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))
