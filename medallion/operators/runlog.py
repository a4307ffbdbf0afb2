"""Run log: one row per logged step of a run, appended to a table.

Rows are buffered in the driver (a handful per run). They are appended when
the run starts, before the body of each layer, and when the run ends or fails,
so a driver that dies leaves the rows up to the layer it was in.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

RUN_LOG_SCHEMA = "run_id STRING, pipeline_id STRING, run_params STRING, ts_inserted TIMESTAMP"


def describe(value):
    """A JSON-friendly stand-in for a logged argument."""
    from medallion.model import Dataset

    if isinstance(value, Dataset):
        return value.name
    if isinstance(value, DataFrame):
        return "DataFrame"
    if isinstance(value, Mapping):
        return sorted(describe(k) for k in value)
    if isinstance(value, (list, tuple)):
        return [describe(v) for v in value]
    if value is None or isinstance(value, (str, int, float, bool)):
        return value
    return str(value)


class RunLog:
    def __init__(self, spark: SparkSession, table: str):
        self.spark = spark
        self.table = table
        self.rows: list[tuple] = []

    def record(self, run_id: str | None, pipeline_id: str | None, params: dict) -> None:
        text = json.dumps(params, sort_keys=True, default=str)
        self.rows.append((run_id, pipeline_id, text, datetime.now(timezone.utc)))

    def flush(self) -> None:
        if self.rows:
            # a handful of rows: one file per flush, not one per default slice
            self.spark.createDataFrame(self.rows, RUN_LOG_SCHEMA).coalesce(1).write.insertInto(self.table)
            self.rows = []


def logged(func):
    """Record a call (function name, run partition, described arguments)
    before the body runs. The method's first argument is the run context."""
    return _logged(func, flush=False)


def logged_layer(func):
    """As ``logged``, and the rows are on storage before the body runs."""
    return _logged(func, flush=True)


def _logged(func, flush: bool):

    @functools.wraps(func)
    def wrapper(self, ctx, *args, **kwargs):
        params = {"function": func.__name__, "partition": ctx.partition}
        if args:
            params["args"] = [describe(a) for a in args]
        for k, v in kwargs.items():
            params[k] = describe(v)
        ctx.log.record(ctx.run_id, ctx.pipeline_id, params)
        if flush:
            ctx.log.flush()
        return func(self, ctx, *args, **kwargs)

    return wrapper


def read_log(spark: SparkSession, table: str, limit: int) -> DataFrame:
    """The last ``limit`` rows of the log, newest first (rows written at the
    same instant by their parameters)."""
    from pyspark.sql import functions as F

    return spark.table(table).orderBy(F.desc("ts_inserted"), F.desc("run_params")).limit(limit)
