"""Declared data checks, their result rows, and the publish gate.

A rule passes only with zero unexpected rows. ``not_null`` counts NULLs;
``unique`` ignores NULLs and counts every row of a repeated value. All
not-null rules of a dataset share one aggregation; each unique rule is one
``groupBy`` whose map-side partial aggregation collapses a hot value before
the shuffle. For variable-length values (texts) that groupBy is on a 64-bit
hash and the length instead of the value, so whole texts are not shuffled;
only rows whose (hash, length) repeats are grouped again by the exact value.
Only the result rows (one per rule) reach the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType


class InvalidDataError(Exception):
    """A dataset failed its checks; nothing of its layer was published."""


@dataclass(frozen=True)
class Rule:
    kind: str  # "not_null" or "unique"
    column: str

    @property
    def name(self) -> str:
        return {
            "not_null": "expect_column_values_to_not_be_null",
            "unique": "expect_column_values_to_be_unique",
        }[self.kind]


def not_null(column: str) -> Rule:
    return Rule("not_null", column)


def unique(column: str) -> Rule:
    return Rule("unique", column)


# The suites of the sales ETL (suite name = dataset name).
SALES_SUITES: dict[str, tuple[Rule, ...]] = {
    "customer": (not_null("id"),),
    "orders": (unique("order_id"),),
    "dim_customer": (not_null("id"),),
    "fct_orders": (unique("order_id"),),
    "sales_mart": (not_null("state_id"),),
}

RESULT_SCHEMA = (
    "dataset STRING, rule STRING, `column` STRING, element_count BIGINT, "
    "unexpected_count BIGINT, success BOOLEAN"
)


def _result(dataset: str, rule: Rule, element_count, unexpected_count) -> list:
    unexpected = F.coalesce(unexpected_count, F.lit(0)).cast("bigint")
    return [
        F.lit(dataset).alias("dataset"),
        F.lit(rule.name).alias("rule"),
        F.lit(rule.column).alias("column"),
        F.coalesce(element_count, F.lit(0)).cast("bigint").alias("element_count"),
        unexpected.alias("unexpected_count"),
        (unexpected == 0).alias("success"),
    ]


def _unique_hashed(frame: DataFrame, rule: Rule, dataset: str) -> DataFrame:
    """Exact unique check for variable-length values, shuffling hashes.

    Equal values have equal (xxhash64, byte length), so a value that repeats
    lies in a (hash, length) group of two or more rows; rows of singleton
    groups are unique. Phase 1 groups by (hash, length) and writes only the
    repeated groups (16 bytes each) to the shared folder; the total row count
    and the number of repeated groups are observed by that write. Phase 2
    regroups by exact value only the rows of repeated groups: the candidate
    set is broadcast when its observed size fits, so texts are not shuffled
    unless they are candidates. Runs phase 1 when called.
    """
    from medallion.operators.sizing import SizeProfile, small_side
    from medallion.session import scratch_path

    v = F.col(rule.column)
    # Both keys are non-NULL expressions (NULLs get length -1): no filter is
    # inferred below the aggregate.
    keyed = frame.select(
        v.alias("_v"), F.xxhash64(v).alias("_h"), F.coalesce(F.octet_length(v), F.lit(-1)).alias("_l")
    )
    per_hash = keyed.groupBy("_h", "_l").agg(F.count(F.lit(1)).alias("_c"))
    obs = Observation(f"unique_{uuid.uuid4().hex[:8]}")
    observed = per_hash.observe(
        obs, F.sum("_c").alias("_all"), F.count_if(F.col("_c") > 1).alias("_groups")
    )
    spark = frame.sparkSession
    path = scratch_path(spark, "checks")
    observed.where(F.col("_c") > 1).select("_h", "_l").write.parquet(path)
    total, groups = int(obs.get["_all"] or 0), int(obs.get["_groups"] or 0)
    candidates = spark.read.schema("_h BIGINT, _l INT").parquet(path)
    fits = SizeProfile(groups, {}, ["_h", "_l"]).fits(frame, ["_h", "_l"])
    exact = (
        keyed.where(F.col("_v").isNotNull())
        .join(small_side(candidates, fits), ["_h", "_l"], "left_semi")
        .groupBy("_v")
        .agg(F.count(F.lit(1)).alias("_c"))
        .where(F.col("_c") > 1)
    )
    return exact.agg(*_result(dataset, rule, F.lit(total), F.sum("_c")))


def check_frame(frame: DataFrame, rules: Sequence[Rule], dataset: str) -> DataFrame:
    """One result row per rule, computed by Spark."""
    parts: list[DataFrame] = []
    nn = [r for r in rules if r.kind == "not_null"]
    if nn:
        counts = frame.agg(
            F.count(F.lit(1)).alias("_n"),
            *[F.count_if(F.col(r.column).isNull()).alias(f"_u{i}") for i, r in enumerate(nn)],
        )
        rows = F.array(*[F.struct(*_result(dataset, r, F.col("_n"), F.col(f"_u{i}"))) for i, r in enumerate(nn)])
        parts.append(counts.select(F.explode(rows).alias("_r")).select("_r.*"))
    types = dict((f.name, f.dataType) for f in frame.schema.fields)
    for r in rules:
        if r.kind == "unique":
            if isinstance(types.get(r.column), (StringType, BinaryType)):
                parts.append(_unique_hashed(frame, r, dataset))
                continue
            per_value = frame.groupBy(F.col(r.column).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
            repeated = F.when(F.col("_v").isNotNull() & (F.col("_c") > 1), F.col("_c"))
            parts.append(per_value.agg(*_result(dataset, r, F.sum("_c"), F.sum(repeated))))
        elif r.kind != "not_null":
            raise ValueError(f"unknown rule {r.kind!r}")
    if not parts:
        return frame.sparkSession.createDataFrame([], RESULT_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def observe_not_null(frame: DataFrame, rules: Sequence[Rule], dataset: str):
    """Attach the not-null rules to ``frame`` as observed metrics.

    Returns (observed frame, results) where ``results()`` gives the result
    rows once an action (the staging write) has run on the observed frame.
    The counts are computed by that action itself: no second scan.
    """
    nn = [r for r in rules if r.kind == "not_null"]
    if not nn:
        return frame, lambda: []
    obs = Observation(f"checks_{dataset}_{uuid.uuid4().hex[:8]}")
    observed = frame.observe(
        obs,
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(r.column).isNull()).alias(f"_u{i}") for i, r in enumerate(nn)],
    )

    def results() -> list[dict]:
        m = obs.get
        return [
            {
                "dataset": dataset,
                "rule": r.name,
                "column": r.column,
                "element_count": int(m["_n"]),
                "unexpected_count": int(m[f"_u{i}"]),
                "success": int(m[f"_u{i}"]) == 0,
            }
            for i, r in enumerate(nn)
        ]

    return observed, results


def profile_and_check(frame: DataFrame, rules: Sequence[Rule], dataset: str, columns: Sequence[str], where=None):
    """One pass over ``frame``: the size profile of ``columns`` (of the rows
    ``where`` holds for, default all) and the results of the not-null rules,
    over all rows. Returns (profile, results)."""
    from medallion.operators.sizing import profile_exprs, profile_from

    nn = [r for r in rules if r.kind == "not_null"]
    exprs, var = profile_exprs(frame.select(*columns), where)
    exprs += [F.count(F.lit(1)).alias("_all")]
    exprs += [F.count_if(F.col(r.column).isNull()).alias(f"_u{i}") for i, r in enumerate(nn)]
    row = frame.agg(*exprs).first()
    results = [
        {
            "dataset": dataset,
            "rule": r.name,
            "column": r.column,
            "element_count": int(row["_all"]),
            "unexpected_count": int(row[f"_u{i}"]),
            "success": int(row[f"_u{i}"]) == 0,
        }
        for i, r in enumerate(nn)
    ]
    return profile_from(row, var, list(columns)), results


def check_datasets(
    frames: Mapping[str, DataFrame], suites: Mapping[str, Sequence[Rule]]
) -> DataFrame:
    """Results of each dataset's suite (datasets without a suite: none)."""
    parts = [check_frame(f, suites[name], name) for name, f in frames.items() if suites.get(name)]
    if not parts:
        spark = SparkSession.getActiveSession()
        return spark.createDataFrame([], RESULT_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def gate(results: Sequence, order: Sequence[str]) -> bool:
    """Raise for the first dataset, in ``order``, with a failed rule."""
    failed = {r["dataset"] for r in results if not r["success"]}
    for name in order:
        if name in failed:
            raise InvalidDataError(
                f"checks of {name} failed, nothing of its layer is published (rows in the results table)"
            )
    return True


def result_row(run_id: str | None, r, checked_at: datetime | None = None) -> tuple:
    return (
        run_id, r["dataset"], r["rule"], r["column"], r["element_count"],
        r["unexpected_count"], r["success"], checked_at or datetime.now(timezone.utc),
    )


def append_results(
    spark: SparkSession, table: str, results: Sequence, run_id: str | None
) -> None:
    """Append result rows (already collected, one per rule) to ``table``."""
    if not results:
        return
    checked_at = datetime.now(timezone.utc)
    rows = [result_row(run_id, r, checked_at) for r in results]
    write_result_rows(spark, table, rows)


RESULT_TABLE_SCHEMA = "run_id STRING, " + RESULT_SCHEMA + ", checked_at TIMESTAMP"


def write_result_rows(spark: SparkSession, table: str, rows: Sequence[tuple]) -> None:
    if rows:
        # one row per rule: one file per append
        spark.createDataFrame(list(rows), RESULT_TABLE_SCHEMA).coalesce(1).write.insertInto(table)
