"""The layered ETL template: bronze, silver, gold; each built, staged,
checked and published before the next layer starts.

Per layer:

1. ``bronze`` / ``silver`` / ``gold`` build lazy frames (``Dataset``s);
2. ``stage`` writes each frame once under its table's home folder (the
   datasets of a layer side by side), and the layer hands on frames over
   those files (never recomputing a plan);
3. ``validate`` gathers the suites' results (most of them observed by the
   staging writes) and raises ``InvalidDataError`` on the first failed
   dataset;
4. ``publish`` commits the staged folders of all the layer's tables; a run
   that dies halfway is finished by the next one.

Check results are appended before the gate may raise; run-log rows before each
layer's body and when the run ends or fails.

A failed check stops the run with nothing of that layer published. The
surrogate keys, joins and aggregates all run as Spark jobs; the driver only
sees check result rows and run-log rows.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from medallion.model import DEFAULT_DATABASE, Dataset, Publish
from medallion.operators.checks import (
    check_datasets,
    gate,
    observe_not_null,
    result_row,
    write_result_rows,
)
from medallion.operators.publish import (
    partition_columns,
    publish_partition,
    publish_upsert,
    replacement,
    stage_partition,
    stage_upsert,
    table_home,
    upsert_change,
)
from medallion.operators.layer import finish_layers, publish_layer
from medallion.operators.profiles import PartProfiles, null_results
from medallion.operators.runlog import RunLog, logged
from medallion.operators.sizing import observe_profile


@dataclass
class RunContext:
    run_id: str
    pipeline_id: str
    partition: str
    log: RunLog
    results: list = field(default_factory=list)  # check result rows not yet appended


def publish_datasets(
    spark: SparkSession, datasets: Mapping[str, Dataset], partition: str
) -> dict[str, Dataset]:
    """Publish datasets directly, without checks: each is stamped with
    ``partition`` (and ``etl_inserted`` where its table has it), then replaces
    that partition or is upserted on its keys; ``Publish.SKIP`` ones are left
    alone. Returns the datasets with frames over the published files."""
    if not partition:
        raise ValueError("a partition is required")
    out = {}
    for name, ds in datasets.items():
        if ds.publish is Publish.REPLACE_PARTITION:
            path, frame = stage_partition(spark, ds.table, ds.frame, partition)
            publish_partition(spark, ds.table, partition, path)
            out[name] = ds.with_frame(frame, path)
        elif ds.publish is Publish.UPSERT:
            staged = stage_upsert(
                spark, ds.table, ds.frame.withColumn("partition", F.lit(partition)), ds.keys,
                sort_within=ds.sort_within,
            )
            publish_upsert(spark, ds.table, staged)
            out[name] = ds.with_frame(staged.frame, staged.path or "")
        else:
            out[name] = ds
    return out


def check_required_inputs(inputs: Mapping[str, Dataset], required: Sequence[str]) -> None:
    missing = [name for name in required if name not in inputs]
    if missing:
        raise ValueError(f"missing inputs: {', '.join(missing)} (given: {', '.join(sorted(inputs)) or 'none'})")


class LayeredETL(ABC):
    pipeline_id = "etl"
    # columns whose size bounds later broadcast decisions, per upserted dataset
    profile_columns: dict[str, list[str]] = {}
    # of which rows, as a SQL condition (default: all)
    profile_rows: dict[str, str] = {}

    def __init__(
        self,
        spark: SparkSession,
        storage_path: str,
        database: str = DEFAULT_DATABASE,
        suites: Mapping | None = None,
        metadata_database: str | None = None,
    ):
        self.spark = spark
        if not storage_path:
            raise ValueError("a storage path is required")
        self.storage_path = storage_path.rstrip("/")
        self.database = database
        self.suites = dict(suites or {})
        self.metadata_database = metadata_database or database

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    @property
    def run_log_table(self) -> str:
        return f"{self.metadata_database}.run_metadata"

    @property
    def results_table(self) -> str:
        return f"{self.metadata_database}.dq_results"

    # ----------------------------------------------------------- the layers

    @abstractmethod
    def bronze(self, ctx: RunContext) -> dict[str, Dataset]: ...

    @abstractmethod
    def silver(self, ctx: RunContext, inputs: Mapping[str, Dataset]) -> dict[str, Dataset]: ...

    @abstractmethod
    def gold(self, ctx: RunContext, inputs: Mapping[str, Dataset]) -> dict[str, Dataset]: ...

    # ------------------------------------------------ stage, check, publish

    def stage(self, ctx: RunContext, ds: Dataset) -> Dataset:
        """Write ``ds`` once; return it with a frame over the written files.

        When the written rows are the dataset's whole new content (a
        partition, or a whole new table version) its not-null rules ride on
        the write as observed metrics; their result rows are kept on the
        returned dataset. A partitioned upsert writes only the touched
        partitions; its not-null rules and the size profile of the new
        version (over ``profile_columns``) come from the profiles of those
        partitions and the known ones of all others.
        """
        if ds.staged is not None or ds.publish is Publish.SKIP:
            return ds
        resolved, profiled = [], []

        def observe(frame):
            observed, results = observe_not_null(frame, self.suites.get(ds.name, ()), ds.name)
            resolved.append(results)
            observed, profile = observe_profile(observed)
            profiled.append(profile)
            return observed

        if ds.publish is Publish.REPLACE_PARTITION:
            path, frame = stage_partition(
                self.spark, ds.table, ds.frame, ctx.partition, transform=observe
            )
            ds = replace(ds, profile=profiled[0]())
        else:
            source = ds.frame.withColumn("partition", F.lit(ctx.partition))
            whole = not partition_columns(self.spark, ds.table)
            rules = self.suites.get(ds.name, ())
            nulls = tuple(r.column for r in rules if r.kind == "not_null")
            spec = PartProfiles(tuple(self.profile_columns.get(ds.name, nulls)), nulls, self.profile_rows.get(ds.name))
            staged = stage_upsert(
                self.spark, ds.table, source, ds.keys,
                transform=observe if whole else None, sort_within=ds.sort_within, profile=spec,
            )
            path, frame = staged.path or "", staged.frame
            profile = staged.profile
            if not whole:
                results = null_results(staged.parts_profile, rules, ds.name) if staged.parts_profile else []
                resolved.append(lambda: results)
            ds = replace(ds, profile=profile, version=staged)
        return ds.with_frame(frame, path, tuple(resolved[0]() if resolved else ()))

    @logged
    def validate(self, ctx: RunContext, datasets: Mapping[str, Dataset]) -> bool:
        """Gate a layer: results observed by the staging writes, plus one job
        for the remaining rules (unique rules; not-null rules of partial
        writes) over the datasets' new content."""
        results = [r for ds in datasets.values() for r in ds.observed]
        remaining = {}
        for name, ds in datasets.items():
            done = {(r["rule"], r["column"]) for r in ds.observed}
            remaining[name] = tuple(
                r for r in self.suites.get(name, ()) if (r.name, r.column) not in done
            )
        frames = {n: d.frame for n, d in datasets.items() if remaining[n]}
        if frames:
            results += check_datasets(frames, remaining).collect()
        ctx.results.extend(result_row(ctx.run_id, r) for r in results)
        self._write_results(ctx)
        for name in datasets:  # all rules of a dataset count the same rows
            rows = next((r["element_count"] for r in results if r["dataset"] == name), None)
            ctx.log.record(ctx.run_id, ctx.pipeline_id, {
                "function": "staged", "partition": ctx.partition, "dataset": name, "rows": rows})
        return gate(results, list(datasets))

    def _write_results(self, ctx: RunContext) -> None:
        write_result_rows(self.spark, self.results_table, ctx.results)
        ctx.results = []

    def publish(self, ctx: RunContext, datasets: Mapping[str, Dataset]) -> None:
        """All tables of the layer, or none (``operators.layer``)."""
        changes = []
        for ds in datasets.values():
            if ds.publish is Publish.REPLACE_PARTITION:
                changes.append(replacement(self.spark, ds.table, ctx.partition, ds.staged))
            elif ds.publish is Publish.UPSERT:
                changes.append(upsert_change(self.spark, ds.table, ds.version))
        publish_layer(self.spark, self.storage_path, [c for c in changes if c is not None])

    def _layer(self, ctx: RunContext, built: Mapping[str, Dataset]) -> dict[str, Dataset]:
        # The datasets of a layer do not depend on each other: their staging
        # jobs are submitted from separate threads and run side by side.
        pending = {n: ds for n, ds in built.items() if ds.staged is None and ds.publish is not Publish.SKIP}
        staged = dict(built)
        if len(pending) > 1:
            with ThreadPoolExecutor(max_workers=len(pending)) as pool:
                futures = {n: pool.submit(self.stage, ctx, ds) for n, ds in pending.items()}
                staged.update({n: f.result() for n, f in futures.items()})
        else:
            staged.update({n: self.stage(ctx, ds) for n, ds in pending.items()})
        self.validate(ctx, staged)
        self.publish(ctx, staged)
        return staged

    # ------------------------------------------------------------------ run

    def run(self, partition: str, run_id: str | None = None) -> dict[str, Dataset]:
        """Run all layers for one partition; returns the published datasets."""
        if not partition:
            raise ValueError("a partition is required")
        run_id = run_id or f"{self.pipeline_id}_{partition}_{datetime.now():%Y-%m-%d-%H-%M-%S}"
        ctx = RunContext(run_id, self.pipeline_id, partition, RunLog(self.spark, self.run_log_table))
        self._check_homes()
        finish_layers(self.spark, self.storage_path)
        published: dict[str, Dataset] = {}
        status = {"function": "run", "partition": partition}
        ctx.log.record(run_id, self.pipeline_id, {**status, "status": "started"})
        ctx.log.flush()
        try:
            bronze = self._layer(ctx, self.bronze(ctx))
            silver = self._layer(ctx, self.silver(ctx, bronze))
            gold = self._layer(ctx, self.gold(ctx, silver))
            published.update(bronze, **silver, **gold)
            ctx.log.record(run_id, self.pipeline_id, {**status, "status": "succeeded"})
        except Exception as exc:
            ctx.log.record(
                run_id, self.pipeline_id, {**status, "status": "failed", "error": type(exc).__name__}
            )
            try:  # what cannot be recorded is noted on the error that stopped the run
                self._write_results(ctx)
                ctx.log.flush()
            except Exception as second:
                exc.add_note(f"the run log could not be written: {type(second).__name__}: {second}")
            raise
        ctx.log.flush()
        return published

    def _check_homes(self) -> None:
        """The tables written to must live under the storage path."""
        home = table_home(self.spark, self.run_log_table)
        if not f"{home}/".startswith(f"{self.storage_path}/"):
            raise ValueError(f"{self.run_log_table} is stored at {home}, not under {self.storage_path}")
