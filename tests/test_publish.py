"""Partition replace and upsert on catalog tables."""

import pytest
from pyspark.sql import functions as F

from medallion.operators.publish import (
    DuplicateKeyError,
    publish_upsert,
    replace_partition,
    stage_snapshot,
    upsert,
)
from medallion.session import sql_str


def _kv_table(spark, lake, name, partitioned=False):
    spark.sql(
        f"CREATE TABLE {lake.db}.{name} (k STRING, v BIGINT"
        + (", partition STRING) USING parquet PARTITIONED BY (partition)" if partitioned else ") USING parquet")
        + f" LOCATION {sql_str(lake.path + '/' + name)}"
    )
    return f"{lake.db}.{name}"


def _rows(spark, table, cols="k, v"):
    return sorted(map(tuple, spark.sql(f"SELECT {cols} FROM {table}").collect()), key=repr)


def test_replace_partition_keeps_others_and_replaces(spark, lake):
    t = _kv_table(spark, lake, "kv", partitioned=True)
    df = lambda rows: spark.createDataFrame(rows, "k STRING, v BIGINT")
    replace_partition(spark, t, df([("a", 1), ("b", 2)]), "p1")
    replace_partition(spark, t, df([("c", 3)]), "p2")
    replace_partition(spark, t, df([("d", 4)]), "p2")  # replaced, not appended
    assert _rows(spark, t, "k, v, partition") == [("a", 1, "p1"), ("b", 2, "p1"), ("d", 4, "p2")]
    replace_partition(spark, t, df([("d", 4)]), "p2")  # rerun: same content
    assert _rows(spark, t, "k, v, partition") == [("a", 1, "p1"), ("b", 2, "p1"), ("d", 4, "p2")]


def test_replace_partition_with_empty_input_empties_it(spark, lake):
    t = _kv_table(spark, lake, "kv2", partitioned=True)
    replace_partition(spark, t, spark.createDataFrame([("a", 1)], "k STRING, v BIGINT"), "p1")
    replace_partition(spark, t, spark.createDataFrame([], "k STRING, v BIGINT"), "p1")
    assert _rows(spark, t) == []


def test_replace_partition_needs_partition(spark, lake):
    t = _kv_table(spark, lake, "kv3", partitioned=True)
    with pytest.raises(ValueError):
        replace_partition(spark, t, spark.createDataFrame([("a", 1)], "k STRING, v BIGINT"), None)


def test_upsert_toy_with_null_keys(spark, lake):
    t = _kv_table(spark, lake, "up")
    upsert(spark, t, spark.createDataFrame([("k1", 1), ("k2", 2), (None, 9)], "k STRING, v BIGINT"), ["k"])
    upsert(spark, t, spark.createDataFrame([("k2", 20), ("k3", 30), (None, 99)], "k STRING, v BIGINT"), ["k"])
    assert _rows(spark, t) == sorted([("k1", 1), ("k2", 20), ("k3", 30), (None, 9), (None, 99)], key=repr)


def test_upsert_projects_source_to_target_columns(spark, lake):
    t = _kv_table(spark, lake, "up2")
    src = spark.createDataFrame([("a", 1, "extra")], "k STRING, v BIGINT, junk STRING").withColumn(
        "etl_inserted", F.current_timestamp()
    )
    upsert(spark, t, src, ["k"])
    assert spark.table(t).columns == ["k", "v"]
    assert _rows(spark, t) == [("a", 1)]


def test_upsert_duplicate_source_keys(spark, lake):
    t = _kv_table(spark, lake, "up3")
    upsert(spark, t, spark.createDataFrame([("a", 1)], "k STRING, v BIGINT"), ["k"])
    with pytest.raises(DuplicateKeyError):
        upsert(spark, t, spark.createDataFrame([("a", 2), ("a", 3)], "k STRING, v BIGINT"), ["k"])
    assert _rows(spark, t) == [("a", 1)]  # nothing published
    # repeated keys that match no target row are inserted, as a merge does
    upsert(spark, t, spark.createDataFrame([("b", 2), ("b", 3)], "k STRING, v BIGINT"), ["k"])
    assert _rows(spark, t) == [("a", 1), ("b", 2), ("b", 3)]


def test_upsert_idempotent_rerun(spark, lake):
    t = _kv_table(spark, lake, "up4")
    src = spark.createDataFrame([("a", 1), ("b", 2)], "k STRING, v BIGINT")
    upsert(spark, t, src, ["k"])
    upsert(spark, t, src, ["k"])
    assert _rows(spark, t) == [("a", 1), ("b", 2)]


def test_frame_resolved_before_publish_reads_old_version(spark, lake):
    t = _kv_table(spark, lake, "up5")
    upsert(spark, t, spark.createDataFrame([("a", 1)], "k STRING, v BIGINT"), ["k"])
    before = spark.table(t)
    staged = stage_snapshot(spark, t, spark.createDataFrame([("a", 5)], "k STRING, v BIGINT"), ["k"])
    assert _rows(spark, t) == [("a", 1)]  # staged, not yet published
    publish_upsert(spark, t, staged)
    assert [tuple(r) for r in before.collect()] == [("a", 1)]
    assert _rows(spark, t) == [("a", 5)]


def _part_location(spark, table, value):
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION (partition = '{value}')").collect()
    return {r["col_name"]: r["data_type"] for r in rows}["Location"]


def test_partitioned_upsert_rewrites_touched_partitions_only(spark, lake):
    t = _kv_table(spark, lake, "pu", partitioned=True)
    df = lambda rows: spark.createDataFrame(rows, "k STRING, v BIGINT, partition STRING")
    upsert(spark, t, df([("a", 1, "p1"), ("b", 2, "p1"), ("c", 3, "p1"), (None, 0, "p1")]), ["k"])
    staged = upsert(spark, t, df([("a", 10, "p2"), (None, 5, "p2")]), ["k"])
    assert dict(staged.parts) == {"p1": True, "p2": True}
    assert _rows(spark, t, "k, v, partition") == sorted(
        [("b", 2, "p1"), ("c", 3, "p1"), (None, 0, "p1"), ("a", 10, "p2"), (None, 5, "p2")], key=repr
    )
    p1, p2 = _part_location(spark, t, "p1"), _part_location(spark, t, "p2")
    staged = upsert(spark, t, df([("d", 4, "p3")]), ["k"])  # matches nothing
    assert staged.parts == (("p3", True),)
    assert (_part_location(spark, t, "p1"), _part_location(spark, t, "p2")) == (p1, p2)
    # the frame of the new version equals the published table
    assert sorted(map(tuple, staged.frame.collect()), key=repr) == _rows(spark, t, "k, v, partition")


def test_partitioned_upsert_drops_emptied_partition(spark, lake):
    t = _kv_table(spark, lake, "pu2", partitioned=True)
    df = lambda rows: spark.createDataFrame(rows, "k STRING, v BIGINT, partition STRING")
    upsert(spark, t, df([("a", 1, "p1"), ("b", 2, "p1")]), ["k"])
    staged = upsert(spark, t, df([("a", 3, "p2"), ("b", 4, "p2")]), ["k"])
    assert dict(staged.parts) == {"p1": False, "p2": True}
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {t}").collect()] == ["partition=p2"]
    assert _rows(spark, t, "k, v, partition") == [("a", 3, "p2"), ("b", 4, "p2")]
    # rerun of the same run partition replaces it in place
    upsert(spark, t, df([("a", 3, "p2"), ("b", 4, "p2")]), ["k"])
    assert _rows(spark, t, "k, v, partition") == [("a", 3, "p2"), ("b", 4, "p2")]


def test_partitioned_upsert_duplicates_and_null_partition(spark, lake):
    t = _kv_table(spark, lake, "pu3", partitioned=True)
    df = lambda rows: spark.createDataFrame(rows, "k STRING, v BIGINT, partition STRING")
    upsert(spark, t, df([("a", 1, "p1")]), ["k"])
    with pytest.raises(DuplicateKeyError):
        upsert(spark, t, df([("a", 2, "p2"), ("a", 3, "p2")]), ["k"])
    with pytest.raises(ValueError):
        upsert(spark, t, df([("z", 2, None)]), ["k"])
    assert _rows(spark, t, "k, v, partition") == [("a", 1, "p1")]


def test_partitioned_upsert_shuffle_path(spark, lake):
    # keys too large to broadcast (limit 0): the rebalanced shuffle path
    t = _kv_table(spark, lake, "pu4", partitioned=True)
    df = lambda rows: spark.createDataFrame(rows, "k STRING, v BIGINT, partition STRING")
    spark.conf.set("spark.medallion.broadcastMaxBytes", "0")
    try:
        upsert(spark, t, df([("a", 1, "p1"), ("b", 2, "p1"), ("c", 3, "p2")]), ["k"])
        staged = upsert(spark, t, df([("a", 10, "p3"), ("c", 30, "p3")]), ["k"])
    finally:
        spark.conf.unset("spark.medallion.broadcastMaxBytes")
    assert dict(staged.parts) == {"p1": True, "p2": False, "p3": True}
    assert _rows(spark, t, "k, v, partition") == [("a", 10, "p3"), ("b", 2, "p1"), ("c", 30, "p3")]


def test_partitioned_upsert_escaped_partition_values(spark, lake):
    t = _kv_table(spark, lake, "pu5", partitioned=True)
    df = lambda rows: spark.createDataFrame(rows, "k STRING, v BIGINT, partition STRING")
    odd = "2024-01-01 10:00:00 #1/a=b% it's"
    upsert(spark, t, df([("a", 1, "p1"), ("b", 2, "p1")]), ["k"])
    staged = upsert(spark, t, df([("a", 5, odd)]), ["k"])
    assert dict(staged.parts) == {"p1": True, odd: True}
    assert _rows(spark, t, "k, v, partition") == [("a", 5, odd), ("b", 2, "p1")]
    replace_partition(spark, t, spark.createDataFrame([("z", 9)], "k STRING, v BIGINT"), odd)
    assert _rows(spark, t, "k, v, partition") == [("b", 2, "p1"), ("z", 9, odd)]


# ------------------------------------------------- crashes, conflicts, re-creation


def _df(spark, rows):
    return spark.createDataFrame(rows, "k STRING, v BIGINT, partition STRING")


def _stopped_publish(spark, table, source, calls):
    """An upsert whose writer dies after the commit and ``calls`` of the
    partitions' catalog calls."""
    from medallion.operators import manifest as mf, publish

    publish.commit(spark, publish.upsert_change(spark, table, publish.stage_upsert(spark, table, source, ["k"])))
    meta = publish._Meta(spark, table)
    changed = mf.read_manifest(spark, meta.home, meta.version)["changed"]
    publish._apply(spark, table, meta, [tuple(c) for c in changed[:calls]])


@pytest.mark.parametrize("calls", [0, 1, 2, 3])
def test_stopped_publish_loses_nothing_and_is_finished(spark, lake, calls):
    from medallion.operators.publish import finish_publish

    t = _kv_table(spark, lake, f"crash{calls}", partitioned=True)
    upsert(spark, t, _df(spark, [("a", 1, "p1"), ("b", 2, "p1"), ("c", 3, "p2")]), ["k"])
    new = _df(spark, [("a", 10, "p3"), ("c", 30, "p3")])  # p3 filled, p1 shrunk, p2 emptied
    _stopped_publish(spark, t, new, calls)
    seen = {k for k, _ in _rows(spark, t)}
    assert seen == {"a", "b", "c"}  # rows may show twice, none is gone
    from medallion.operators.publish import read_version

    now = sorted(map(tuple, read_version(spark, t).collect()), key=repr)  # neither doubled nor missing
    assert now == [("a", 10, "p3"), ("b", 2, "p1"), ("c", 30, "p3")]
    assert read_version(spark, t, keep=lambda p: p == "p1").collect() == [("b", 2, "p1")]
    assert finish_publish(spark, t) and not finish_publish(spark, t)
    want = [("a", 10, "p3"), ("b", 2, "p1"), ("c", 30, "p3")]
    assert _rows(spark, t, "k, v, partition") == want
    upsert(spark, t, new, ["k"])
    assert _rows(spark, t, "k, v, partition") == want


def test_catalog_several_versions_behind_catches_up(spark, lake):
    from medallion.operators import publish

    t = _kv_table(spark, lake, "behind", partitioned=True)
    other = f"{lake.db}.behind_elsewhere"  # another catalog's table over the same home
    upsert(spark, t, _df(spark, [("a", 1, "p1"), ("b", 2, "p2")]), ["k"])
    spark.sql(f"CREATE TABLE {other} (k STRING, v BIGINT, partition STRING) USING parquet PARTITIONED BY (partition) "
              f"LOCATION {sql_str(publish.table_home(spark, t))}")
    publish.reattach(spark, other)
    assert _rows(spark, other, "k, v, partition") == _rows(spark, t, "k, v, partition")
    upsert(spark, t, _df(spark, [("b", 20, "p3")]), ["k"])  # p2 goes
    upsert(spark, t, _df(spark, [("c", 30, "p4")]), ["k"])
    assert publish.finish_publish(spark, other)
    assert _rows(spark, other, "k, v, partition") == [("a", 1, "p1"), ("b", 20, "p3"), ("c", 30, "p4")]
    upsert(spark, other, _df(spark, [("c", 31, "p4")]), ["k"])  # and the first one sees this
    publish.finish_publish(spark, t)
    assert _rows(spark, t, "k, v, partition") == [("a", 1, "p1"), ("b", 20, "p3"), ("c", 31, "p4")]


def test_publish_between_check_and_commit_is_not_lost(spark, lake, monkeypatch):
    """The second writer publishes after the first one has checked the version
    and before it commits: the first is refused, and nothing accepted is deleted."""
    from medallion.operators import manifest as mf, publish

    t = _kv_table(spark, lake, "race", partitioned=True)
    upsert(spark, t, _df(spark, [("k0", 0, "p0")]), ["k"])
    one = publish.stage_upsert(spark, t, _df(spark, [("k1", 1, "p1")]), ["k"])
    two = publish.stage_upsert(spark, t, _df(spark, [("k2", 2, "p2")]), ["k"])
    create, raced = mf.create_manifest, []

    def late(*args):
        if not raced:
            raced.append(True)
            publish.publish_upsert(spark, t, two)
        return create(*args)

    monkeypatch.setattr(mf, "create_manifest", late)
    with pytest.raises(publish.ConflictError):
        publish.publish_upsert(spark, t, one)
    monkeypatch.undo()
    publish.remove_unreferenced(spark, t, older_than_seconds=0)
    spark.catalog.refreshTable(t)
    assert _rows(spark, t, "k, v, partition") == [("k0", 0, "p0"), ("k2", 2, "p2")]
    assert sorted(publish.partition_folders(spark, t)) == ["p0", "p2"]


def test_replaced_partitions_of_racing_writers_both_stay(spark, lake, monkeypatch):
    from medallion.operators import manifest as mf, publish

    t = _kv_table(spark, lake, "race2", partitioned=True)
    df = lambda rows: spark.createDataFrame(rows, "k STRING, v BIGINT")
    create, raced = mf.create_manifest, []

    def late(*args):
        if not raced:
            raced.append(True)
            replace_partition(spark, t, df([("b", 2)]), "p2")
        return create(*args)

    monkeypatch.setattr(mf, "create_manifest", late)
    replace_partition(spark, t, df([("a", 1)]), "p1")
    monkeypatch.undo()
    assert _rows(spark, t, "k, v, partition") == [("a", 1, "p1"), ("b", 2, "p2")]
    assert sorted(publish.partition_folders(spark, t)) == ["p1", "p2"]


def test_a_manifest_number_is_given_once(spark, lake):
    from concurrent.futures import ThreadPoolExecutor

    from medallion.operators import manifest as mf

    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda n: mf.create_text(spark, f"{lake.path}/once.json", f"writer {n}"), range(16)))
    assert got.count(True) == 1 and mf.read_text(spark, f"{lake.path}/once.json") == f"writer {got.index(True)}"


def test_second_writer_is_refused(spark, lake):
    from medallion.operators.publish import ConflictError, stage_upsert

    t = _kv_table(spark, lake, "conflict", partitioned=True)
    upsert(spark, t, _df(spark, [("a", 1, "p1"), ("b", 2, "p1")]), ["k"])
    one = stage_upsert(spark, t, _df(spark, [("a", 10, "p2")]), ["k"])
    two = stage_upsert(spark, t, _df(spark, [("b", 20, "p2")]), ["k"])
    publish_upsert(spark, t, one)
    with pytest.raises(ConflictError):
        publish_upsert(spark, t, two)
    assert _rows(spark, t, "k, v, partition") == [("a", 10, "p2"), ("b", 2, "p1")]


def test_unknown_columns_are_refused(spark, lake):
    t = _kv_table(spark, lake, "enforce", partitioned=True)
    with pytest.raises(ValueError, match="extra"):
        replace_partition(spark, t, spark.createDataFrame([("a", 1, 2)], "k STRING, v BIGINT, extra INT"), "p")


def test_unreferenced_folders_are_removed(spark, lake):
    from medallion.operators.publish import partition_folders, remove_unreferenced

    t = _kv_table(spark, lake, "clean", partitioned=True)
    for v in (1, 2, 3):
        upsert(spark, t, _df(spark, [("a", v, "p1"), ("b", v, "p2")]), ["k"])
    before = _rows(spark, t, "k, v, partition")
    assert remove_unreferenced(spark, t) == []  # all too young
    gone = remove_unreferenced(spark, t, older_than_seconds=0)
    assert len([g for g in gone if "/_partitions/" in g]) == 2 and not set(gone) & set(partition_folders(spark, t).values())
    spark.catalog.refreshTable(t)
    assert _rows(spark, t, "k, v, partition") == before
