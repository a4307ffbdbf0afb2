"""Uniqueness of a key over all partitions of a table, without reading them.

Each staged partition carries an index of its keys in its own folder (so a
replaced partition takes its index with it):

* **keys**: every distinct value with its number of rows, in folders by
  ``pmod(xxhash64(key), BUCKETS)``;
* **filter**: a blocked Bloom filter over them. A key belongs to one block of
  2^15 bits (4 KB) and sets ``PROBES`` bits there; a partition has as many
  blocks (a power of two) as give each of its keys ``BITS`` bits. Built and probed
  with Spark's bitmap functions: blocks are grouped rows, never one large value.

A new partition's keys are probed against the blocks of all others. What is left
- the repeats and about one in a hundred of the rest - is compared exactly with the
key files of the partitions and buckets it points to. No data file of an older
partition is opened, and most of their key files are not either.

NULL keys repeat nothing. Keys are compared by their value, whatever their
hashes are. Two writers that check at the same time do not see each other's
partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.operators import manifest as mf
from medallion.operators.checks import unique
from medallion.operators.publish import partition_folders, stage_partition

FOLDER = "_keys"
BUCKETS = 16
BITS = 12
PROBES = 6
BLOCK = 1 << 15  # bits of the bitmaps that Spark's bitmap functions make


def key_folder(folder: str, column: str) -> str:
    return f"{folder}/{FOLDER}/{column}"


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("block")), blocks)


def _bits(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(k)), F.lit(BLOCK)) for k in range(PROBES)]


def _id(folder: str) -> str:
    return folder.rstrip("/").rsplit("/", 1)[-1]


def index_keys(spark: SparkSession, folder: str, frame: DataFrame, column: str) -> DataFrame:
    """Write the index of ``frame``'s ``column`` under ``folder``; returns the
    keys (id, key, n, bucket) as read back."""
    at, name = key_folder(folder, column), F.lit(_id(folder))
    counted = frame.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    # counted map-side first, so a hot key is one row per task before any shuffle
    placed = counted.select(name.alias("id"), "key", "n", F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).cast("int").alias("bucket"))
    placed.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{at}/keys")
    keys = read_keys(spark, folder, column, placed.schema)
    distinct = keys.count()
    blocks = 1
    while blocks * BLOCK < distinct * BITS:
        blocks *= 2
    bits = keys.select(_block(F.col("key"), F.lit(blocks)).alias("block"), F.explode(F.array(*_bits(F.col("key")))).alias("bit"))
    bitmaps = bits.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    bitmaps.select(name.alias("id"), F.lit(blocks).cast("long").alias("blocks"), "block", "bitmap").write.parquet(f"{at}/filter")
    return keys


def read_keys(spark: SparkSession, folder: str, column: str, schema) -> DataFrame:
    """(id, key, n, bucket) of the index of a data folder."""
    return spark.read.schema(schema).parquet(f"{key_folder(folder, column)}/keys")


def possible_repeats(spark: SparkSession, keys: DataFrame, folders: Sequence[str], column: str) -> DataFrame:
    """(key, n, bucket, id) of keys that a folder's filter does not rule out."""
    filters = spark.read.schema("id string, blocks long, block long, bitmap binary").parquet(
        *[f"{key_folder(f, column)}/filter" for f in folders])
    sizes = [r[0] for r in filters.select("blocks").distinct().collect()]  # powers of two
    if not sizes:
        return keys.where(F.lit(False)).select("key", "n", "bucket", "id")
    probes = keys.select("key", "n", "bucket", F.explode(F.array(*[F.lit(s) for s in sizes])).alias("blocks"))
    probes = probes.withColumn("block", _block(F.col("key"), F.col("blocks")))
    hits = probes.join(filters, ["blocks", "block"])
    for bit in _bits(F.col("key")):
        # bit k of a bitmap is bit k % 8 of its byte k / 8
        byte = F.conv(F.hex(F.substring("bitmap", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        hits = hits.where(F.floor(byte / F.pow(F.lit(2), bit % 8)) % 2 == 1)
    return hits.select("key", "n", "bucket", "id")


def repeated_keys(spark: SparkSession, table: str, column: str, folder: str, partition: str) -> DataFrame:
    """(key, n, partition, n_there): keys of a staged folder, to be published as
    ``partition``, that other partitions of the table hold as well, with their
    rows here and there. All partitions must have been staged with the column's
    index (``stage_unique``)."""
    others = {_id(f): (p, f) for p, f in partition_folders(spark, table).items() if p != partition}
    kind = spark.table(table).schema[column].dataType.simpleString()
    schema, out = f"id string, key {kind}, n long, bucket int", f"key {kind}, n long, partition string, n_there long"
    if not others:
        return spark.createDataFrame([], out)
    missing = [p for p, f in others.values() if not mf.exists(spark, key_folder(f, column))]
    if missing:
        raise ValueError(f"partitions of {table} without an index of {column}: {', '.join(sorted(missing))}")
    mine = read_keys(spark, folder, column, schema)
    maybe = possible_repeats(spark, mine, sorted(f for _, f in others.values()), column)
    found = maybe.select("id", "bucket").distinct().collect()  # partitions x buckets at most
    if not found:
        return spark.createDataFrame([], out)
    paths = []
    for name in sorted({r["id"] for r in found}):
        at = f"{key_folder(others[name][1], column)}/keys"
        wanted = {f"bucket={r['bucket']}" for r in found if r["id"] == name}
        paths += [f"{at}/{b}" for b in mf.children(spark, at) if b in wanted]
    if not paths:
        return spark.createDataFrame([], out)
    theirs = spark.read.schema(f"id string, key {kind}, n long").parquet(*paths)
    names = spark.createDataFrame([(i, p) for i, (p, _) in sorted(others.items())], "id string, partition string")  # one row per partition
    both = maybe.join(theirs.select("id", "key", F.col("n").alias("n_there")), ["id", "key"])
    return both.join(F.broadcast(names), "id").select("key", "n", "partition", "n_there")


def stage_unique(
    spark: SparkSession, table: str, frame: DataFrame, partition: str, column: str
) -> tuple[str, DataFrame, dict]:
    """Stage a partition with its key index and check that the key is unique
    over the whole table as it would be: (folder, staged frame, result row).

    Counted as unexpected are the rows of this partition whose key occurs again,
    in it or in another one."""
    folder, staged = stage_partition(spark, table, frame, partition)
    keys = index_keys(spark, folder, staged, column)
    elsewhere = repeated_keys(spark, table, column, folder, partition).select("key").distinct().withColumn("_again", F.lit(True))
    counted = keys.join(elsewhere, "key", "left").agg(
        F.sum(F.when((F.col("n") > 1) | F.col("_again"), F.col("n"))).alias("bad")).first()
    bad = int(counted["bad"] or 0)
    rule = unique(column)
    return folder, staged, {
        "dataset": table.split(".")[-1], "rule": rule.name, "column": column, "element_count": staged.count(),
        "unexpected_count": bad, "success": bad == 0,
    }
