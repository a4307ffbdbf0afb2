"""Keys that must be unique over all partitions of a table."""

import random

import pytest

from medallion.operators import keys
from medallion.operators.publish import partition_folders, publish_partition, replace_partition

SCHEMA = "order_id STRING, customer_id BIGINT, item_id STRING, item_name STRING, delivered_on TIMESTAMP_NTZ, datetime_order_placed TIMESTAMP_NTZ"


def orders(spark, ids):
    return spark.createDataFrame([(i, 1, "i", "n", None, None) for i in ids], SCHEMA)


def run(spark, table, partition, ids):
    folder, _, result = keys.stage_unique(spark, table, orders(spark, ids), partition, "order_id")
    again = keys.repeated_keys(spark, table, "order_id", folder, partition)
    found = sorted((r["key"], r["n"], r["partition"], r["n_there"]) for r in again.collect())
    publish_partition(spark, table, partition, folder)
    return (result["element_count"], result["unexpected_count"], result["success"]), found


def test_repeats_between_runs(spark, lake):
    t = f"{lake.db}.orders"
    assert run(spark, t, "p1", ["a", "b", "c", None, None]) == ((5, 0, True), [])
    assert run(spark, t, "p2", ["d", "e", "e", None]) == ((4, 2, False), [])
    assert run(spark, t, "p3", ["a", "x", "e", "e", "y"]) == ((5, 3, False), [("a", 1, "p1", 1), ("e", 2, "p2", 2)])
    # a partition replaced by itself is not compared with what it replaces
    assert run(spark, t, "p3", ["x", "y"]) == ((2, 0, True), [])
    assert run(spark, t, "p4", ["a", "x"]) == ((2, 2, False), [("a", 1, "p1", 1), ("x", 1, "p3", 1)])
    assert run(spark, t, "p5", []) == ((0, 0, True), [])
    assert run(spark, t, "p6", ["z"]) == ((1, 0, True), [])


def test_older_data_files_are_not_read(spark, lake):
    t = f"{lake.db}.orders"
    run(spark, t, "p1", [f"k{n}" for n in range(300)])
    folder, staged, _ = keys.stage_unique(spark, t, orders(spark, ["k7", "new"]), "p2", "order_id")
    again = keys.repeated_keys(spark, t, "order_id", folder, "p2")
    assert [r["key"] for r in again.collect()] == ["k7"]
    read = again.inputFiles()
    assert read and all(f"/{keys.FOLDER}/order_id/" in f for f in read)
    old = partition_folders(spark, t)["p1"].split("/")[-1]
    buckets = {f.split("bucket=")[1].split("/")[0] for f in read if old in f and "/keys/" in f}
    assert 1 <= len(buckets) <= 3 < keys.BUCKETS  # the repeat's, and at most a few false ones


def test_filters_rule_out_what_is_not_there(spark, lake):
    rng = random.Random(1)
    known = [f"k{rng.randrange(10 ** 9)}" for _ in range(20_000)]
    folder = f"{lake.path}/filters"
    index = keys.index_keys(spark, folder, orders(spark, known), "order_id")
    assert index.count() == len(set(known))
    fresh = [f"n{n}" for n in range(20_000)]
    asked = keys.index_keys(spark, f"{lake.path}/asked", orders(spark, [*fresh, *known[:500]]), "order_id")
    hits = {r["key"] for r in keys.possible_repeats(spark, asked, [folder], "order_id").collect()}
    assert set(known[:500]) <= hits and len(hits - set(known)) < 0.03 * len(fresh)
    blocks = spark.read.parquet(f"{keys.key_folder(folder, 'order_id')}/filter")
    assert blocks.count() == blocks.first()["blocks"] == 8


def test_partitions_without_an_index_are_named(spark, lake):
    t = f"{lake.db}.orders"
    replace_partition(spark, t, orders(spark, ["a"]), "p1")
    with pytest.raises(ValueError, match="p1"):
        keys.stage_unique(spark, t, orders(spark, ["b"]), "p2", "order_id")
