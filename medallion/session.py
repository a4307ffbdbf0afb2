"""Session settings the library relies on, and the shared folder it writes to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session running these jobs should carry. AQE re-plans joins at
# run time: it turns a join into a broadcast only when the measured size of a
# side is under the threshold, and splits skewed shuffle partitions (a hot key
# holding a large share of the rows) into several tasks.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = "local[*]",
    shuffle_partitions: int | None = 8,
    app_name: str = "medallion",
    extra: dict[str, str] | None = None,
    enable_hive: bool = False,
) -> SparkSession:
    """Build (or get) a session with the library's defaults. ``master`` and
    ``shuffle_partitions`` may be None: then the submitting command decides.
    ``enable_hive`` asks for the Hive catalog, so that separate jobs share
    their tables."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if enable_hive:
        builder = builder.enableHiveSupport()
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the session's checkpoint directory.

    On a cluster ``spark.checkpoint.dir`` must name shared storage; it is read
    from the session. Only a local session without one gets a fresh temporary
    folder (tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError(
                "spark.checkpoint.dir must name a folder shared by the cluster"
            )
        configured = tempfile.mkdtemp(prefix="medallion-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared folder."""
    return "/".join([shared_dir(spark), *parts, uuid.uuid4().hex[:12]])


def sql_str(value: str) -> str:
    """Quote a value as a Spark SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
