"""Shapes of physical plans that matter at scale."""

import re

from pyspark.sql import functions as F

from medallion.operators.latest import latest_partition, newest_partition
from medallion.operators.lookup import lookup_current
from medallion.operators.mart import sales_mart
from medallion.operators.publish import replace_partition
from medallion.operators.scd2 import scd2_changes


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def scans_of(frame, column):
    """File scans that read a column (plan strings cut long locations, not schemas)."""
    return [r for r in plan_of(frame).split("\n") if "FileScan" in r and re.search(rf"ReadSchema: struct<.*\b{column}:", r)]


def lines_below(plan, pattern):
    """The lines of the subtree under the first line matching ``pattern``."""
    rows = plan.split("\n")
    at = next(k for k, r in enumerate(rows) if re.search(pattern, r))
    depth = len(re.match(r"[ :+\-]*", rows[at])[0])
    out = []
    for r in rows[at + 1 :]:
        if len(re.match(r"[ :+\-]*", r)[0]) <= depth:
            break
        out.append(r)
    return out


def dim(spark, tmp_path):
    rows = spark.range(5000).select(
        "id", F.md5(F.col("id").cast("string")).alias("customer_sur_id"), *[F.lit("x").alias(c) for c in ("first_name", "last_name", "state_id")],
        F.lit("2020-01-01").cast("timestamp_ntz").alias("datetime_created"), F.lit("2020-01-01").cast("timestamp_ntz").alias("datetime_updated"),
        (F.col("id") % 5 > 0).alias("current"), F.lit("2020-01-01").cast("timestamp_ntz").alias("valid_from"))
    rows.write.mode("overwrite").parquet(f"{tmp_path}/dim")
    return spark.read.parquet(f"{tmp_path}/dim")


def test_dimension_is_reduced_before_any_exchange(spark, tmp_path):
    d = dim(spark, tmp_path)
    d.drop("current", "valid_from").limit(10).withColumn("datetime_updated", F.lit("2021-01-01").cast("timestamp_ntz")) \
        .write.parquet(f"{tmp_path}/src")
    plan = plan_of(scd2_changes(spark.read.parquet(f"{tmp_path}/src"), d, broadcast_ids=True))
    semi = lines_below(plan, r"BroadcastHashJoin .*LeftSemi")
    scan = next(k for k, r in enumerate(semi) if "FileScan" in r and "customer_sur_id" in r)  # the dimension's
    assert not any(re.search(r"- Exchange", r) for r in semi[: scan + 1])


def test_lookup_scans_the_fact_once(spark, tmp_path):
    d = dim(spark, tmp_path)
    spark.range(100).select(F.col("id").alias("customer_id")).write.parquet(f"{tmp_path}/fact")
    joined = lookup_current(spark.read.parquet(f"{tmp_path}/fact"), d, broadcast=True)
    assert len(scans_of(joined, "customer_id")) == 1 and not re.search(r"- Exchange", plan_of(joined))


def test_mart_counts_before_a_shuffle_join(spark, tmp_path):
    fact = spark.range(100).select(F.col("id").cast("string").alias("customer_sur_id"), F.lit("2020-01-01").cast("timestamp_ntz").alias("delivered_on"))
    plan = sales_mart(fact, dim(spark, tmp_path), broadcast=False)._jdf.queryExecution().optimizedPlan().toString()
    join = lines_below(plan, r"Join LeftOuter")
    assert any("Aggregate [customer_sur_id" in r for r in join)


def test_newest_partition_skips_older_files_and_empty_ones(spark, lake):
    t = f"{lake.db}.orders"
    frame = spark.createDataFrame([("o1", 1, "i", "car", None, None)], "order_id STRING, customer_id BIGINT, item_id STRING, "
                                  "item_name STRING, delivered_on TIMESTAMP_NTZ, datetime_order_placed TIMESTAMP_NTZ")
    assert newest_partition(spark, t) is None and latest_partition(spark, t).count() == 0
    replace_partition(spark, t, frame, "p1")
    replace_partition(spark, t, frame, "p2")
    replace_partition(spark, t, frame.limit(0), "p3")
    assert newest_partition(spark, t) == "p2"
    newest = latest_partition(spark, t)
    assert newest.count() == 1 and len(newest.inputFiles()) == len(spark.table(t).where("partition = 'p2'").inputFiles())
