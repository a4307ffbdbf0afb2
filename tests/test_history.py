"""SCD2 histories: late versions, several versions of an id in a batch."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from medallion.functions.columns import OPEN_END, with_surrogate_key
from medallion.operators import history
from medallion.operators.history import scd2_versions, with_next
from medallion.operators.publish import published, upsert
from tests.conftest import ts

SRC = "id BIGINT, first_name STRING, last_name STRING, state_id STRING, datetime_created TIMESTAMP_NTZ, datetime_updated TIMESTAMP_NTZ"
COLUMNS = ["id", "first_name", "datetime_updated", "current", "valid_from", "valid_to"]
DAY = datetime(2020, 1, 1)
END = ts(OPEN_END)


def batch(spark, rows):
    """(id, day, name) rows as a keyed batch."""
    rows = [(i, name, "x", "s", DAY, None if day is None else DAY + timedelta(day)) for i, day, name in rows]
    return with_surrogate_key(spark.createDataFrame(rows, SRC))


def apply(spark, lake, batches, late_rows):
    table = f"{lake.db}.dim_customer"
    for n, rows in enumerate(batches):
        changes = scd2_versions(batch(spark, rows), spark.table(table), late_rows=late_rows)
        upsert(spark, table, changes.withColumn("partition", F.lit(f"p{n}")), ["customer_sur_id"])
    return published(spark, table)


def plain(batches, late_rows):
    """The history in memory: {(id, day): name} and its intervals."""
    known = {}
    for rows in batches:
        newest = {}
        for i, day in known:
            newest[i] = max(newest.get(i, day), day)
        now = {}
        for i, day, name in rows:
            if late_rows == "drop" and i in newest and day < newest[i]:
                continue
            now[i, day] = max(now.get((i, day), name), name)
        known.update(now)
    out = []
    for (i, day), name in known.items():
        later = [d for j, d in known if j == i and d > day]
        until = DAY + timedelta(min(later)) if later else None
        at = DAY + timedelta(day)
        out.append((i, name, until or at, until is None, at, until or END))
    return sorted(out)


def rows_of(frame):
    return sorted(tuple(r) for r in frame.select(*COLUMNS).collect())


@pytest.mark.parametrize("late_rows", ["splice", "drop"])
def test_late_and_repeated_versions(spark, lake, late_rows):
    batches = [
        [(1, 10, "a"), (2, 10, "a"), (3, 5, "a"), (3, 7, "b"), (3, 9, "c"), (3, 9, "c")],
        [(1, 5, "late"), (2, 20, "b"), (2, 15, "ooo"), (3, 8, "late"), (4, 1, "new"), (1, 10, "renamed")],
        [(1, 5, "late2"), (1, 7, "later"), (2, 20, "b")],
    ]
    got = apply(spark, lake, batches, late_rows)
    assert rows_of(got) == plain(batches, late_rows)
    assert got.where("current").groupBy("id").count().where("count <> 1").isEmpty()
    other = got.select(*[F.col(c).alias(f"o_{c}") for c in ("id", "valid_from", "valid_to")])
    overlap = got.join(other, (F.col("id") == F.col("o_id")) & (F.col("valid_from") < F.col("o_valid_from")) & (F.col("valid_to") > F.col("o_valid_from")))
    assert overlap.isEmpty()


def test_a_batch_again_changes_nothing(spark, lake):
    rows = [(1, 3, "a"), (1, 5, "b"), (2, 4, "c")]
    apply(spark, lake, [rows], "splice")
    again = scd2_versions(batch(spark, rows), spark.table(f"{lake.db}.dim_customer"))
    assert again.isEmpty()


def test_rows_without_id_or_version_stay_open(spark, lake):
    got = scd2_versions(batch(spark, [(None, 3, "a"), (1, None, "b"), (1, 4, "c")]), spark.table(f"{lake.db}.dim_customer")).collect()
    assert sorted((r["id"] or 0, r["first_name"], r["current"], r["valid_to"]) for r in got) == [
        (0, "a", True, END), (1, "b", True, END), (1, "c", True, END)]
    with pytest.raises(ValueError):
        scd2_versions(batch(spark, []), spark.table(f"{lake.db}.dim_customer"), late_rows="keep")
    assert scd2_versions(batch(spark, []), spark.table(f"{lake.db}.dim_customer")).isEmpty()


def test_history_left_by_kept_late_rows_is_mended(spark, lake):
    """Two current rows of an id, as scd2_changes leaves them, become one chain."""
    from medallion.operators.scd2 import scd2_changes

    table = f"{lake.db}.dim_customer"
    for n, rows in enumerate([[(1, 10, "b")], [(1, 4, "a")]]):
        changes = scd2_changes(batch(spark, rows), spark.table(table))
        upsert(spark, table, changes.withColumn("partition", F.lit(f"p{n}")), ["customer_sur_id"])
    assert spark.table(table).where("current").count() == 2
    changes = scd2_versions(batch(spark, [(1, 12, "c")]), spark.table(table))
    upsert(spark, table, changes.withColumn("partition", F.lit("p2")), ["customer_sur_id"])
    assert rows_of(published(spark, table)) == plain([[(1, 4, "a"), (1, 10, "b"), (1, 12, "c")]], "splice")


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.tuples(st.integers(1, 4), st.integers(0, 12), st.sampled_from("abc")), min_size=1, max_size=12), min_size=1, max_size=3),
       st.sampled_from(["splice", "drop"]))
def test_random_batches(spark, batches, late_rows):
    import uuid

    from medallion.plans.queries import Lake

    lake = Lake(spark, "h" + uuid.uuid4().hex[:6], ("dim_customer",))
    assert rows_of(apply(spark, lake, batches, late_rows)) == plain(batches, late_rows)


def test_next_version_over_partitions(spark):
    """One id with most of the rows spans partitions; so do its neighbours."""
    rows = [(0, n) for n in range(2000)] + [(n % 40 + 1, n) for n in range(400)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = with_next(spark.createDataFrame(rows, "k long, o long").repartition(5), "k", "o", "up").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    by = {}
    for k, o in rows:
        by.setdefault(k, []).append(o)
    want = [(k, o, nxt) for k, os in by.items() for o, nxt in zip(sorted(os), [*sorted(os)[1:], None])]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert history.LATE_ROWS == ("splice", "drop")


def test_etl_with_spliced_late_rows(spark, lake):
    from medallion.plans.sales import SalesMartETL
    from medallion.sources.testdata import batch_source
    from tests.conftest import SF_SMALL

    for n, cut in enumerate((None, "1996-01-01")):
        SalesMartETL(spark, lake.path, lake.db, batch_source(SF_SMALL, cut), late_rows="splice").run(f"2024-01-0{n + 1}-00-00-00")
    dim = spark.table(f"{lake.db}.dim_customer")
    assert dim.where("current").count() == dim.select("id").distinct().count() < dim.count()
    with pytest.raises(ValueError):
        SalesMartETL(spark, lake.path, lake.db, late_rows="what")
