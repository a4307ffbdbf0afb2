"""Embedding near-duplicates by product quantisation over inverted lists.

Vectors are scaled to length 1; cosine >= 0.98 is then a distance of at most
r = 0.2. Equal vectors of a label are one *point* from the start.

* **Index.** Coarse centroids and, for the residuals, ``SUBSPACES`` codebooks
  are fitted on at most ``SAMPLE`` points (the smallest hashes). Every point is
  indexed: its nearest centroid's list, its code, and the distance between the
  point and what the code stands for (its coding error).
* **Sufficient probes.** A point probes each list that a vector within r could
  lie in. The nearest such vector is at least as far as the plane between the
  two centroids, so list j needs a probe only when ``d_j^2 - d_own^2 <= 2 r
  |c_j - c_own|``. No link is lost to probing.
* **Table lookup.** In a list, the distance from a query to a member's code is
  summed from a table of subspace distances; members farther than r plus their
  coding error cannot link (triangle inequality) and are passed over.
* **Rerank.** The rest are compared by exact cosine in double precision, on the
  values as given.

Lists are split by label, and hot ones further: a task compares at most
``CHUNK`` members with ``CHUNK`` queries. It returns a count per query and a
spanning forest, never the pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, vectors without label or vec_id, and vectors of different
dimension link with nothing; a vec_id on several equal rows counts once; an
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections import namedtuple
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.common import components, table, written

THRESHOLD = 0.98
SAMPLE = 20_000
SUBSPACES = 8
CODES = 64
MOST_LISTS = 1024
CHUNK = 1024
SLACK = 1e-6  # far above what rounding can move a distance by

Index = namedtuple("Index", "centroids gaps codebooks")


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = _distances(x, c).argmin(axis=1)
        n = np.bincount(near, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances."""
    return np.maximum(0.0, (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1))


def _spans(dim: int) -> list[slice]:
    edges = np.linspace(0, dim, min(SUBSPACES, dim) + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


def fit_index(sample: np.ndarray, points: int, seed: int = 5) -> Index:
    rng = np.random.default_rng(seed)
    lists = int(min(MOST_LISTS, max(1, round(points ** 0.5 / 2)), len(sample)))
    c = _kmeans(sample, lists, rng)
    rest = sample - c[_distances(sample, c).argmin(axis=1)]
    books = [_kmeans(rest[:, s], CODES, rng) for s in _spans(sample.shape[1])]
    return Index(c, np.sqrt(_distances(c, c)), books)


def _unit(raw: np.ndarray) -> np.ndarray:
    return raw / np.sqrt((raw * raw).sum(axis=1))[:, None]


def _stack(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _assign(indexes: dict[int, Index], radius: float):
    """A row per point and probed list; ``own`` marks the list it is kept in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                for lo in range(0, part.num_rows, 2048):
                    some = part.slice(lo, 2048)
                    x = _unit(_stack(some.column("embedding")))
                    ix = indexes[int(dim)]
                    d = _distances(x, ix.centroids)
                    own = d.argmin(axis=1)
                    reach = d - d[np.arange(len(x)), own][:, None] <= 2 * radius * ix.gaps[own] + SLACK
                    at, lists = np.nonzero(reach)
                    yield pa.RecordBatch.from_arrays(
                        [*[some.column(c).take(pa.array(at)) for c in ("point", "label", "dim", "copies", "embedding")],
                         pa.array(lists, pa.int32()), pa.array(lists == own[at])],
                        ["point", "label", "dim", "copies", "embedding", "list", "own"],
                    )

    return run


def _encode(x: np.ndarray, base: np.ndarray, ix: Index) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the residuals, and their coding errors."""
    rest = x - base
    codes, left = [], np.zeros(len(x))
    for s, book in zip(_spans(x.shape[1]), ix.codebooks):
        d = _distances(rest[:, s], book)
        codes.append(d.argmin(axis=1))
        left += d.min(axis=1)
    return np.stack(codes, axis=1), np.sqrt(left)


def _compare(indexes: dict[int, Index], radius: float, threshold: float):
    """Per block: link counts of its queries, and a spanning forest."""

    def block_links(block: pa.Table) -> tuple[list, list]:
        ix = indexes[block.column("dim")[0].as_py()]
        member = block.column("member").to_numpy()
        point, copies = block.column("point").to_numpy(), block.column("copies").to_numpy()
        raw = _stack(block.column("embedding").combine_chunks())
        q, m = np.flatnonzero(~member), np.flatnonzero(member)
        if not len(q) or not len(m):
            return [], []
        x, norm = _unit(raw), np.sqrt((raw * raw).sum(axis=1))
        base = ix.centroids[block.column("list")[0].as_py()]
        codes, error = _encode(x[m], base, ix)
        nodes, where = np.unique(point, return_inverse=True)
        group = np.arange(len(nodes))
        counts, forest = [], []
        for lo in range(0, len(q), 64):
            some = q[lo : lo + 64]
            d = np.zeros((len(some), len(m)))
            for k, (s, book) in enumerate(zip(_spans(x.shape[1]), ix.codebooks)):
                d += _distances(x[some, s] - base[s], book)[:, codes[:, k]]
            maybe = np.sqrt(d) <= radius + error + SLACK
            a, b = np.nonzero(maybe & (point[some][:, None] != point[m]))
            keep = np.zeros(len(a), bool)
            for t in range(0, len(a), 8192):
                u, v = some[a[t : t + 8192]], m[b[t : t + 8192]]
                keep[t : t + 8192] = np.einsum("ij,ij->i", raw[u], raw[v]) / (norm[u] * norm[v]) >= threshold
            a, b = a[keep], b[keep]
            sums = np.bincount(a, weights=copies[m[b]], minlength=len(some))
            counts += [(point[some[k]], int(sums[k])) for k in np.flatnonzero(sums)]
            for k in np.unique(a):
                mine, others = where[some[k]], where[m[b[a == k]]]
                groups, first = np.unique(group[others], return_index=True)
                new = groups != group[mine]
                if new.any():
                    forest += [(int(nodes[mine]), int(nodes[o])) for o in others[first[new]]]
                    group[np.isin(group, groups)] = group[mine]
        return counts, forest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from medallion.llm.signature_join import _blocks

        for block in _blocks(batches):
            counts, forest = block_links(block)
            yield pa.RecordBatch.from_arrays(
                [pa.array([c[0] for c in counts] + [f[0] for f in forest], pa.int64()),
                 pa.array([None] * len(counts) + [f[1] for f in forest], pa.int64()),
                 pa.array([c[1] for c in counts] + [0] * len(forest), pa.int64())],
                ["a", "b", "links"],
            )

    return run


def _split(rows: DataFrame) -> DataFrame:
    """Members and queries of each list, dealt to blocks of bounded size."""
    where = ["label", "dim", "list"]
    sizes = rows.groupBy(*where).agg(
        F.ceil(F.count_if("own") / CHUNK).cast("int").alias("ms"), F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("qs")
    ).where("ms > 0")
    dealt = rows.join(sizes, where)
    spot = F.xxhash64("point")
    queries = dealt.select(
        *rows.columns, F.lit(False).alias("member"), F.pmod(spot, F.col("qs")).cast("int").alias("q"),
        F.explode(F.sequence(F.lit(0), F.col("ms") - 1)).alias("m"))
    members = dealt.where("own").select(
        *rows.columns, F.lit(True).alias("member"), F.explode(F.sequence(F.lit(0), F.col("qs") - 1)).alias("q"),
        F.pmod(spot, F.col("ms")).cast("int").alias("m"))
    return queries.unionByName(members).select(
        F.xxhash64(*where, "q", "m").alias("block"), "point", "dim", "copies", "embedding", "list", "member")


def near_links(vectors: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, counts, forest): every row of ``vectors`` with its ``point``
    (null if it cannot link), the links of each point to other points' vectors,
    and a spanning forest of the links."""
    radius = float(np.sqrt(2 - 2 * threshold))
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"),
                           F.col("label").cast("long").alias("label"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    square = F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v * v)
    fit = plain.vec_id.isNotNull() & plain.label.isNotNull() & plain.embedding.isNotNull() & (F.size("embedding") > 0) & finite
    rows = written(plain.withColumn("print", F.when(fit & (square > 0) & (square < float("inf")),
                                    F.unhex(F.sha2(F.concat_ws(",", F.col("label"), "embedding"), 256)))), "vectors")
    ids = rows.where("print IS NOT NULL").groupBy("print").agg(
        F.min("vec_id").alias("point"), F.count_distinct("vec_id").alias("copies"))
    one = rows.where("print IS NOT NULL").join(ids.select("print", "point", "copies"), "print").where("vec_id = point")
    points = written(one.groupBy("print").agg(
        F.first("point").alias("point"), F.first("copies").alias("copies"), F.first("label").alias("label"),
        F.first("embedding").alias("embedding")).withColumn("dim", F.size("embedding")), "points")
    indexes = {}
    for row in points.groupBy("dim").count().collect():  # one row per dimension in use
        some = points.where(F.col("dim") == row["dim"]).orderBy(F.xxhash64("point")).limit(SAMPLE).select("embedding")
        x = _unit(_stack(some.toArrow().column("embedding").combine_chunks()))
        indexes[row["dim"]] = fit_index(x, row["count"])
    probes = written(points.select("point", "label", "dim", "copies", "embedding").mapInArrow(
        _assign(indexes, radius),
        "point long, label long, dim int, copies long, embedding array<double>, list int, own boolean"), "probes")
    blocks = _split(probes).repartition("block").sortWithinPartitions("block")
    found = written(blocks.mapInArrow(_compare(indexes, radius, threshold), "a long, b long, links long"), "pq_links")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("point")).agg(F.sum("links").alias("links"))
    per_print = points.select("print", "point", "copies").join(counts, "point", "left").select(
        "print", F.col("point").alias("point"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    return rows.select("vec_id", "print"), per_print, found.where("b IS NOT NULL").select("a", "b")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``."""
    rows, counts, forest = near_links(vectors, threshold)
    joined = components(forest)
    known = counts.join(joined, counts["point"] == joined["node"], "left").select(
        "print", "links", F.coalesce("component", "point").alias("component"))
    return rows.join(known, "print", "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
