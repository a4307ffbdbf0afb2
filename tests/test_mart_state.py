"""The mart over all runs, kept by differences, against counting all facts."""

import random

import pytest
from pyspark.sql import functions as F

from medallion.operators import publish
from medallion.operators.mart import sales_mart
from medallion.operators.mart_state import update_mart
from medallion.plans.ddl import create_tables

DIM = "customer_sur_id string, state_id string, current boolean"
FACT = "customer_sur_id string, delivered_on timestamp_ntz"


@pytest.fixture()
def tables(spark, lake):
    create_tables(spark, lake.path, lake.db, ("mart_key_counts", "mart_totals"))
    return lake.t("mart_key_counts"), lake.t("mart_totals")


def cells(frame):
    return sorted(((str(r["deliver_date"]), r["state_id"] or "", r["num_orders"]) for r in frame.collect()))


def test_random_runs(spark, lake, tables):
    """Facts come, runs are made again, keys open, close, move and come back."""
    from datetime import datetime, timedelta

    rng = random.Random(4)
    dim, facts, stored = {}, {}, f"{lake.path}/dims"
    spark.createDataFrame([], DIM).write.parquet(f"{stored}/0")
    for n, run in enumerate(("r1", "r2", "r3", "r2", "r4", "r1"), 1):
        changed = {f"k{rng.randrange(12)}": (rng.choice(["A", "B", None]), rng.random() < 0.7) for _ in range(6)}
        dim.update(changed)
        spark.createDataFrame([(k, *v) for k, v in dim.items()], DIM).write.parquet(f"{stored}/{n}")
        facts[run] = [(rng.choice([f"k{rng.randrange(14)}", None]), datetime(2020, 1, 1) + timedelta(rng.randrange(4)))
                      for _ in range(rng.choice([0, 30, 60]))]
        before, after = (spark.read.schema(DIM).parquet(f"{stored}/{k}") for k in (n - 1, n))
        changes = spark.createDataFrame([(k, *v) for k, v in changed.items()], DIM)
        got = update_mart(spark, lake.path, *tables, spark.createDataFrame(facts[run], FACT), changes, before, after, run)
        every = [f for rows in facts.values() for f in rows]
        want = sales_mart(spark.createDataFrame(every, FACT), after)
        assert cells(got) == cells(want) == cells(publish.published(spark, tables[1]))
        assert {r["num_orders"] > 0 for r in got.collect()} <= {True}


def test_older_facts_are_not_scanned(spark, lake, tables):
    day = F.lit("2020-01-01").cast("timestamp_ntz").alias("delivered_on")
    for n in (1, 2):
        spark.range(50).select(F.concat(F.lit("k"), F.col("id")).alias("customer_sur_id"), day).write.parquet(f"{lake.path}/facts/{n}")
        facts = spark.read.parquet(f"{lake.path}/facts/{n}")
        dims = [spark.createDataFrame([("k1", s, True)], DIM) for s in ("A", "B")]
        if n == 2:
            publish.mf.remove(spark, f"{lake.path}/facts/1")  # the first run's facts are out of reach
        got = update_mart(spark, lake.path, *tables, facts, dims[1], dims[0] if n == 2 else dims[1].limit(0), dims[n - 1], f"r{n}")
    assert cells(got) == [("2020-01-01", "", 98), ("2020-01-01", "B", 2)]
