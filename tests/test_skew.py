"""Hot keys and NULL-heavy keys: results are whole and equal to plain joins,
on both the broadcast and the shuffle path."""

import pytest
from pyspark.sql import functions as F

from medallion.operators.checks import check_frame, unique
from medallion.operators.lookup import lookup_current
from medallion.operators.mart import sales_mart
from medallion.operators.scd2 import current_rows, scd2_changes, scd2_changes_three_joins
from medallion.operators.sizing import SizeProfile, small_side

N = 3000


@pytest.fixture()
def no_auto_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _facts(spark):
    # a third NULL keys, a third one hot key, a third spread over 100 keys
    return spark.range(N).select(
        F.col("id").cast("string").alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit(None).cast("bigint"))
        .when(F.col("id") % 3 == 1, F.lit(7).cast("bigint"))
        .otherwise(F.col("id") % 100)
        .alias("customer_id"),
        F.timestamp_seconds(F.lit(86400) * (F.col("id") % 5)).cast("timestamp_ntz").alias("delivered_on"),
    )


def _dim(spark):
    return spark.range(100).select(
        F.col("id"),
        F.md5(F.col("id").cast("string")).alias("customer_sur_id"),
        F.concat(F.lit("S"), (F.col("id") % 7).cast("string")).alias("state_id"),
        F.lit(True).alias("current"),
    )


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("broadcast", [True, False])
def test_lookup_hot_and_null_keys(spark, no_auto_broadcast, broadcast):
    facts, dim = _facts(spark), _dim(spark)
    got = lookup_current(facts, dim, broadcast=broadcast)
    cur = current_rows(dim).select(F.col("id").alias("_k"), "customer_sur_id")
    plain = facts.join(cur, facts.customer_id == cur._k, "left").drop("_k")
    assert got.count() == N
    assert _rows(got) == _rows(plain)


@pytest.mark.parametrize("broadcast", [True, False])
def test_mart_hot_key(spark, no_auto_broadcast, broadcast):
    facts, dim = _facts(spark), _dim(spark)
    fct = lookup_current(facts, dim, broadcast=broadcast)
    mart = sales_mart(fct, dim, broadcast=broadcast)
    assert mart.agg(F.sum("num_orders")).first()[0] == N  # every order counted once
    nulls = mart.where("state_id IS NULL").agg(F.sum("num_orders")).first()[0]
    assert nulls == N // 3  # the NULL-key orders


def test_scd2_null_heavy_source(spark, no_auto_broadcast):
    src = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(None).cast("bigint")).otherwise(F.col("id") % 50).alias("id"),
        F.lit("f").alias("first_name"),
        F.lit("l").alias("last_name"),
        F.lit("S").alias("state_id"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("datetime_created"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).cast("timestamp_ntz").alias("datetime_updated"),
    ).withColumn("customer_sur_id", F.md5(F.concat(F.col("id").cast("string"), F.col("datetime_updated").cast("string"))))
    dim = spark.range(50).select(
        F.col("id"),
        F.md5(F.col("id").cast("string")).alias("customer_sur_id"),
        F.lit("f").alias("first_name"), F.lit("l").alias("last_name"), F.lit("S").alias("state_id"),
        F.lit("2023-01-01").cast("timestamp_ntz").alias("datetime_created"),
        F.lit("2023-06-01").cast("timestamp_ntz").alias("datetime_updated"),
        F.lit(True).alias("current"),
        F.lit("2023-06-01").cast("timestamp_ntz").alias("valid_from"),
        F.lit("2099-01-01 12:00:00").cast("timestamp_ntz").alias("valid_to"),
    )
    one = scd2_changes(src, dim)
    assert _rows(one) == _rows(scd2_changes_three_joins(src, dim))
    # every source row opens a version (NULL ids too); each match closes one
    opened = one.where("current").count()
    assert opened == N
    assert one.where("NOT current").count() == N - N // 3


def test_unique_check_hot_value(spark):
    frame = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("v")
    )
    (row,) = check_frame(frame, [unique("v")], "d").collect()
    assert (row["element_count"], row["unexpected_count"]) == (N, N // 3)


def test_large_sides_are_shuffled_not_sent_through_the_driver(spark):
    rows = 400_000  # 14 MB hashed; the planner alone would broadcast both sides
    assert not SizeProfile(rows, {}, ["id"]).fits(spark.range(1), ["id"])
    assert SizeProfile(1000, {}, ["id"]).fits(spark.range(1), ["id"])
    ids = spark.range(rows)
    dim = ids.selectExpr("id", "id AS customer_sur_id", "'s' AS state_id", "true AS current")
    fact = spark.range(10).selectExpr("id AS customer_id", "timestamp_ntz'2024-01-01' AS delivered_on")
    fct = lookup_current(fact, dim)
    joins = [fact.join(small_side(ids, None), F.col("customer_id") == F.col("id"), "left_semi"), fct, sales_mart(fct, dim)]
    for frame in joins:
        assert "BroadcastExchange" not in frame._jdf.queryExecution().executedPlan().toString()
    assert [(r["state_id"], r["num_orders"]) for r in joins[-1].collect()] == [("s", 10)]
