"""Data checks: rule semantics, observed metrics, the gate."""

import pytest

from medallion.operators.checks import (
    InvalidDataError,
    check_datasets,
    check_frame,
    gate,
    not_null,
    observe_not_null,
    unique,
)


def _frame(spark):
    return spark.createDataFrame(
        [(1, "a"), (2, "a"), (3, None), (None, None), (5, "b")], "id BIGINT, s STRING"
    )


def test_not_null_and_unique(spark):
    res = {(r["rule"], r["column"]): r for r in check_frame(
        _frame(spark), [not_null("id"), not_null("s"), unique("s"), unique("id")], "d"
    ).collect()}
    nn_id = res[("expect_column_values_to_not_be_null", "id")]
    assert (nn_id["element_count"], nn_id["unexpected_count"], nn_id["success"]) == (5, 1, False)
    nn_s = res[("expect_column_values_to_not_be_null", "s")]
    assert nn_s["unexpected_count"] == 2
    u_s = res[("expect_column_values_to_be_unique", "s")]
    # NULLs ignored; both rows of the repeated "a" are unexpected
    assert (u_s["element_count"], u_s["unexpected_count"], u_s["success"]) == (5, 2, False)
    u_id = res[("expect_column_values_to_be_unique", "id")]
    assert (u_id["unexpected_count"], u_id["success"]) == (0, True)


def test_empty_frame_passes(spark):
    empty = spark.createDataFrame([], "id BIGINT")
    rows = check_frame(empty, [not_null("id"), unique("id")], "e").collect()
    assert all(r["success"] and r["element_count"] == 0 for r in rows)


def test_observed_not_null_matches_job(spark):
    from medallion.session import scratch_path

    frame = _frame(spark)
    observed, results = observe_not_null(frame, [not_null("id"), not_null("s"), unique("s")], "d")
    observed.write.parquet(scratch_path(spark, "tests"))
    got = {r["column"]: (r["element_count"], r["unexpected_count"]) for r in results()}
    job = {r["column"]: (r["element_count"], r["unexpected_count"])
           for r in check_frame(frame, [not_null("id"), not_null("s")], "d").collect()}
    assert got == job == {"id": (5, 1), "s": (5, 2)}


def test_gate_raises_first_failed_in_order(spark):
    frames = {"x": _frame(spark), "y": _frame(spark)}
    results = check_datasets(frames, {"x": [unique("id")], "y": [not_null("id")]}).collect()
    with pytest.raises(InvalidDataError, match="checks of y"):
        gate(results, ["x", "y"])
    results = check_datasets(frames, {"x": [not_null("s")], "y": [not_null("id")]}).collect()
    with pytest.raises(InvalidDataError, match="checks of x"):
        gate(results, ["x", "y"])
    assert gate(check_datasets(frames, {"x": [unique("id")]}).collect(), ["x", "y"])


def test_unique_hashed_matches_direct(spark):
    from pyspark.sql import functions as F

    texts = ["alpha", "beta", "alpha", None, "", "", "gamma" * 1000, "gamma" * 1000, "delta"]
    frame = spark.createDataFrame([(t,) for t in texts], "s STRING")
    (row,) = check_frame(frame, [unique("s")], "d").collect()
    # repeated: alpha x2, '' x2, long text x2 -> 6 rows; NULL ignored
    assert (row["element_count"], row["unexpected_count"], row["success"]) == (9, 6, False)
    ints = frame.select(F.length("s").alias("n"))  # a fixed-width column takes the direct path
    (row,) = check_frame(ints, [unique("n")], "d").collect()
    # lengths: 5, 4, 5, NULL, 0, 0, 5000, 5000, 5 -> 5 x3, 0 x2, 5000 x2 repeat
    assert row["unexpected_count"] == 7


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.sampled_from(["", "a", "b", "ab", "ba", "x" * 300])), max_size=25))
def test_unique_hashed_equals_exact_count(spark, values):
    from collections import Counter

    frame = spark.createDataFrame([(v,) for v in values], "s STRING")
    (row,) = check_frame(frame, [unique("s")], "d").collect()
    counts = Counter(v for v in values if v is not None)
    assert row["element_count"] == len(values)
    assert row["unexpected_count"] == sum(c for c in counts.values() if c > 1)
