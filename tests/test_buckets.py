"""Bucketed upserts: only the buckets of a batch are searched and rewritten."""

import random

import pytest
from pyspark.sql import functions as F

from medallion.operators import publish
from medallion.operators.profiles import PartProfiles, profile_parts
from medallion.plans.ddl import create_table

COLUMNS = (("k", "STRING"), ("v", "BIGINT"), ("partition", "STRING"))
SCHEMA = "k STRING, v BIGINT, partition STRING"


def bucketed(spark, lake, name, buckets=8):
    create_table(spark, lake.db, name, COLUMNS, True, lake.path, ("k",), buckets)
    return f"{lake.db}.{name}"


def rows_of(spark, table):
    return sorted(map(tuple, publish.published(spark, table).collect()), key=repr)


def bucket(spark, key, buckets=8):
    return spark.createDataFrame([(key,)], "k STRING").select(publish.bucket_of(["k"], buckets)).first()[0]


def files_of(frame):
    return {f.split("/")[-3] for f in frame.inputFiles()}


def test_key_scan_opens_touched_buckets_only(spark, lake):
    t = bucketed(spark, lake, "scan")
    publish.upsert(spark, t, spark.createDataFrame([(f"k{n}", n, "p1") for n in range(200)], SCHEMA), ["k"])
    meta = publish._settled(spark, t)
    assert len(files_of(spark.table(t))) == 8
    received = {f"{bucket(spark, k)}/p2" for k in ("k3", "k7")}
    scan = publish.searched(spark, t, meta, received)
    assert files_of(scan) == {f"key_bucket={r.split('/')[0]}" for r in received}
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(key_bucket" in plan or "PartitionFilters: [key_bucket" in plan


def test_other_buckets_keep_their_folders(spark, lake):
    t = bucketed(spark, lake, "keep")
    publish.upsert(spark, t, spark.createDataFrame([(f"k{n}", n, "p1") for n in range(100)], SCHEMA), ["k"])
    before = publish.partition_folders(spark, t)
    staged = publish.upsert(spark, t, spark.createDataFrame([("k5", -5, "p2"), ("new", 1, "p2")], SCHEMA), ["k"])
    after = publish.partition_folders(spark, t)
    mine = {bucket(spark, "k5"), bucket(spark, "new")}
    assert {p for p in before if before[p] != after.get(p)} == {f"{bucket(spark, 'k5')}/p1"}
    assert {p for p, _ in staged.parts} == {f"{b}/p2" for b in mine} | {f"{bucket(spark, 'k5')}/p1"}
    want = [(f"k{n}", n, "p1") for n in range(100) if n != 5] + [("k5", -5, "p2"), ("new", 1, "p2")]
    assert rows_of(spark, t) == sorted(want, key=repr)
    assert sorted(map(tuple, staged.frame.drop(publish.BUCKET).collect()), key=repr) == rows_of(spark, t)


@pytest.mark.parametrize("buckets", [1, 3])
def test_same_rows_as_without_buckets(spark, lake, buckets):
    rng = random.Random(buckets)
    t = bucketed(spark, lake, f"same{buckets}", buckets)
    plain, nulls = {}, []
    for run in ("p1", "p2", "p3", "p2"):
        keys = rng.sample(range(40), 15)
        batch = [(f"k{n}", rng.randrange(1000), run) for n in keys] + [(None, rng.randrange(9), run)]
        publish.upsert(spark, t, spark.createDataFrame(batch, SCHEMA), ["k"])
        plain.update({b[0]: b for b in batch[:-1]})
        nulls.append(batch[-1])
    assert rows_of(spark, t) == sorted([*plain.values(), *nulls], key=repr)


def test_null_keys_spread_and_repeats_are_refused(spark, lake):
    t = bucketed(spark, lake, "nulls")
    publish.upsert(spark, t, spark.createDataFrame([(None, n, "p1") for n in range(200)], SCHEMA), ["k"])
    assert len(files_of(spark.table(t))) == 8
    publish.upsert(spark, t, spark.createDataFrame([("a", 1, "p1")], SCHEMA), ["k"])
    with pytest.raises(publish.DuplicateKeyError):
        publish.upsert(spark, t, spark.createDataFrame([("a", 1, "p2"), ("a", 2, "p2")], SCHEMA), ["k"])
    with pytest.raises(ValueError, match="bucketed by"):
        publish.upsert(spark, t, spark.createDataFrame([("a", 1, "p2")], SCHEMA), ["v"])
    with pytest.raises(ValueError, match="non-empty"):
        publish.upsert(spark, t, spark.createDataFrame([("a", 1, None)], SCHEMA), ["k"])


def test_dropped_and_made_again_finds_its_buckets(spark, lake):
    t = bucketed(spark, lake, "again")
    publish.upsert(spark, t, spark.createDataFrame([(f"k{n}", n, "p1") for n in range(30)], SCHEMA), ["k"])
    publish.upsert(spark, t, spark.createDataFrame([("k1", -1, "p 2/x=y")], SCHEMA), ["k"])
    before = rows_of(spark, t)
    spark.sql(f"DROP TABLE {t}")
    bucketed(spark, lake, "again")
    assert rows_of(spark, t) == before and len(before) == 30


def test_profiles_are_merged_not_recounted(spark, lake):
    t = bucketed(spark, lake, "profiles")
    spec = PartProfiles(("k", "v"), ("v",), "v >= 0 OR v IS NULL")
    for run, lo in (("p1", 0), ("p2", 90), ("p3", 95)):
        batch = [(f"key{n}", None if n % 10 == 0 else (n if n % 3 else -n), run) for n in range(lo, lo + 100)]
        staged = publish.upsert(spark, t, spark.createDataFrame(batch, SCHEMA), ["k"], profile=spec)
        assert staged.parts_profile == profile_parts(spark.table(t), publish._settled(spark, t).part(), spec)
    total = staged.parts_profile
    assert total.all_rows() == 195 and total.null_count("v") == 20
    row = spark.table(t).where("v >= 0 OR v IS NULL").agg(F.count("*"), F.sum(F.octet_length("k"))).first()
    assert (total.total().rows, total.total().var_bytes["k"]) == tuple(row)
    # an upsert that does not ask for profiles ends the chain; the next one counts afresh
    publish.upsert(spark, t, spark.createDataFrame([("key1", 1, "p4")], SCHEMA), ["k"])
    staged = publish.upsert(spark, t, spark.createDataFrame([("key2", 1, "p5")], SCHEMA), ["k"], profile=spec)
    assert staged.parts_profile == profile_parts(spark.table(t), publish._settled(spark, t).part(), spec)


def test_profile_reads_only_the_files_just_written(spark, lake, monkeypatch):
    t = bucketed(spark, lake, "reads")
    spec = PartProfiles(("k",))
    publish.upsert(spark, t, spark.createDataFrame([(f"k{n}", n, "p1") for n in range(100)], SCHEMA), ["k"], profile=spec)
    seen = []
    real = profile_parts

    def watched(frame, part, what):
        seen.append(files_of(frame))
        return real(frame, part, what)

    monkeypatch.setattr(publish, "profile_parts", watched)
    publish.upsert(spark, t, spark.createDataFrame([("k5", 0, "p2")], SCHEMA), ["k"], profile=spec)
    assert seen == [{f"key_bucket={bucket(spark, 'k5')}"}]
