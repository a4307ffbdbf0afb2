"""A task that fails and is retried: observed check counts, size profiles
and published rows are counted once (separate process: own task-retry
setting)."""

import json
import os
import subprocess
import sys

SCRIPT = r'''
import json, sys, uuid
sys.path.insert(0, sys.argv[1])
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from medallion.operators.checks import not_null, observe_not_null
from medallion.operators.sizing import observe_profile
from medallion.operators.publish import replace_partition
from medallion.session import shared_dir

spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
spark.sparkContext.setLogLevel("OFF")

@F.udf("boolean")
def flaky(v):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and v == 501:
        raise RuntimeError("injected task failure")
    return True

rows = (spark.range(1000).repartition(2)
        .select(F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.col("id")).alias("v"))
        .where(flaky(F.coalesce(F.col("v"), F.lit(-1)))))
base = shared_dir(spark) + "/resilience/" + uuid.uuid4().hex
observed, results = observe_not_null(rows, [not_null("v")], "d")
observed, profile = observe_profile(observed)
observed.write.parquet(base + "/out")
r = results()[0]
db = "res_" + uuid.uuid4().hex[:8]
spark.sql(f"CREATE DATABASE {db} LOCATION '{base}/db'")
spark.sql(f"CREATE TABLE {db}.t (v BIGINT, partition STRING) USING parquet PARTITIONED BY (partition) LOCATION '{base}/t'")
replace_partition(spark, f"{db}.t", rows, "p")
tracker = spark.sparkContext.statusTracker()
failed = 0
for job in tracker.getJobIdsForGroup(None):
    info = tracker.getJobInfo(job)
    for sid in (info.stageIds if info else []):
        st = tracker.getStageInfo(sid)
        failed += st.numFailedTasks if st else 0
print(json.dumps({"element_count": r["element_count"], "unexpected": r["unexpected_count"],
                  "profile_rows": profile().rows, "written": spark.read.parquet(base + "/out").count(),
                  "published": spark.table(f"{db}.t").count(), "failed_tasks": failed}))
'''


def test_retried_task_is_counted_once():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT, root], capture_output=True, text=True, timeout=600
    )
    last = [line for line in out.stdout.splitlines() if line.startswith("{")]
    assert last, out.stderr[-3000:]
    got = json.loads(last[-1])
    failed = got.pop("failed_tasks")
    assert got == {"element_count": 1000, "unexpected": 100, "profile_rows": 1000,
                   "written": 1000, "published": 1000}
    assert failed >= 2  # the injected failure really happened, in both writes
