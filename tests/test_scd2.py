"""SCD2 change detection on toy rows, and one join == three joins."""

from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from medallion.functions.columns import OPEN_END, surrogate_key, with_surrogate_key
from medallion.operators.scd2 import (
    scd2_changes,
    scd2_changes_three_joins,
    scd2_closures,
    scd2_net_new,
    scd2_new_versions,
)
from tests.conftest import ts

SRC_SCHEMA = (
    "id BIGINT, first_name STRING, last_name STRING, state_id STRING, "
    "datetime_created TIMESTAMP_NTZ, datetime_updated TIMESTAMP_NTZ"
)
DIM_SCHEMA = (
    "id BIGINT, customer_sur_id STRING, first_name STRING, last_name STRING, state_id STRING, "
    "datetime_created TIMESTAMP_NTZ, datetime_updated TIMESTAMP_NTZ, current BOOLEAN, "
    "valid_from TIMESTAMP_NTZ, valid_to TIMESTAMP_NTZ"
)


def _dim(spark, rows):
    """rows: (id, v, updated) all current, valid from updated."""
    src = spark.createDataFrame(
        [(i, v, "x", "S", ts(u), ts(u)) for i, v, u in rows], SRC_SCHEMA
    )
    return with_surrogate_key(src).selectExpr(
        "id", "customer_sur_id", "first_name", "last_name", "state_id", "datetime_created",
        "datetime_updated", "true AS current", "datetime_updated AS valid_from",
        f"timestamp_ntz'{OPEN_END}' AS valid_to",
    )


def _source(spark, rows):
    return with_surrogate_key(
        spark.createDataFrame([(i, v, "x", "S", ts(u), ts(u)) for i, v, u in rows], SRC_SCHEMA)
    )


def _toy(spark):
    dim = _dim(spark, [(1, "a", "2024-01-01"), (2, "b", "2024-01-01"), (3, "c", "2024-03-01")])
    source = _source(
        spark,
        [
            (1, "A", "2024-02-01"),  # changed
            (2, "b", "2024-01-01"),  # unchanged
            (3, "old", "2024-02-01"),  # late
            (4, "n", "2024-02-01"),  # new
            (5, "nul", None),  # NULL version
        ],
    )
    return source, dim


def test_toy_batch(spark):
    source, dim = _toy(spark)
    rows = scd2_changes(source, dim).collect()
    assert len(rows) == 6
    opened = [r for r in rows if r["current"]]
    closed = [r for r in rows if not r["current"]]
    assert sorted(r["first_name"] for r in opened) == ["A", "b", "n", "nul", "old"]
    assert all(r["valid_to"] == datetime.fromisoformat(OPEN_END) for r in opened)
    assert all(r["valid_from"] == r["datetime_updated"] for r in opened)
    (c,) = closed
    assert (c["id"], c["first_name"]) == (1, "a")
    assert c["datetime_updated"] == ts("2024-02-01")  # taken from the new row
    assert c["valid_from"] == ts("2024-01-01")  # kept from the old row
    assert c["valid_to"] == ts("2024-02-01")
    # the closed row keeps the old surrogate key
    old_key = dim.where("id = 1").first()["customer_sur_id"]
    assert c["customer_sur_id"] == old_key


def test_toy_parts(spark):
    source, dim = _toy(spark)
    assert sorted(r["id"] for r in scd2_net_new(source, dim).collect()) == [2, 3, 4, 5]
    assert [r["id"] for r in scd2_new_versions(source, dim).collect()] == [1]
    assert [r["first_name"] for r in scd2_closures(source, dim).collect()] == ["a"]


def test_one_join_equals_three_joins_toy(spark):
    source, dim = _toy(spark)
    one, three = scd2_changes(source, dim), scd2_changes_three_joins(source, dim)
    assert one.exceptAll(three).count() == 0 and three.exceptAll(one).count() == 0


def test_null_keys_in_source(spark):
    source = _source(spark, [(None, "z", "2024-05-01"), (7, "q", None)])
    dim = _dim(spark, [(7, "p", "2024-01-01")])
    rows = scd2_changes(source, dim).collect()
    assert len(rows) == 2 and all(r["current"] for r in rows)
    assert all(r["customer_sur_id"] is None for r in rows)  # NULL in -> NULL key


def test_repeated_source_rows_for_two_open_versions(spark):
    # an id with two older current rows: the new version is emitted once per
    # match and both old rows are closed
    dim = _dim(spark, [(1, "a", "2024-01-01"), (1, "b", "2024-01-15")])
    source = _source(spark, [(1, "c", "2024-02-01")])
    rows = scd2_changes(source, dim).collect()
    assert len(rows) == 4
    assert sum(r["current"] for r in rows) == 2


def test_surrogate_key_text(spark):
    row = spark.sql(
        "SELECT md5('71995-06-30 00:00:00') AS expected, "
        "CAST(7 AS BIGINT) AS id, timestamp_ntz'1995-06-30 00:00:00' AS datetime_updated"
    ).select("expected", surrogate_key().alias("key")).first()
    assert row["key"] == row["expected"]


versions = st.sampled_from(["2024-01-01", "2024-02-01", "2024-03-01", None])
ids = st.sampled_from([1, 2, 3, None])


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    dim_rows=st.lists(st.tuples(st.sampled_from([1, 2, 3]), st.sampled_from("abc"), versions.filter(bool)), max_size=5),
    src_rows=st.lists(st.tuples(ids, st.sampled_from("abcd"), versions), max_size=5),
)
def test_one_join_equals_three_joins_property(spark, dim_rows, src_rows):
    dim = _dim(spark, dim_rows)
    source = _source(spark, src_rows)
    one, three = scd2_changes(source, dim), scd2_changes_three_joins(source, dim)
    assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, three.collect()), key=repr)


