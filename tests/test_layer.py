"""Layers published as one unit: a writer that dies leaves all or none."""

import pytest
from pyspark.sql import functions as F

from medallion.operators import layer, publish
from medallion.plans.ddl import create_table

COLUMNS = (("k", "STRING"), ("v", "BIGINT"), ("partition", "STRING"))


class Died(Exception):
    pass


def tables(spark, lake):
    for name, keys in (("d", ("k",)), ("f", ()), ("g", ())):
        create_table(spark, lake.db, name, COLUMNS, True, lake.path, keys, 2)
    return [f"{lake.db}.{n}" for n in ("d", "f", "g")]


def frame(spark, v, partition):
    return spark.createDataFrame([(f"k{n}", v, partition) for n in range(5)], "k STRING, v BIGINT, partition STRING")


def staged(spark, names, v, partition):
    """A layer of one upsert and two replaced partitions."""
    d, f, g = names
    changes = [publish.replacement(spark, t, partition, publish.stage_partition(spark, t, frame(spark, v, partition), partition)[0]) for t in (f, g)]
    return [*changes, publish.upsert_change(spark, d, publish.stage_upsert(spark, d, frame(spark, v, partition), ["k"]))]


def values(spark, names):
    return [sorted({r["v"] for r in publish.read_version(spark, t).where("partition = 'p2'").collect()}) for t in names]


@pytest.mark.parametrize("stop", [0, 1, 2, 3])
def test_all_or_none(spark, lake, monkeypatch, stop):
    names = tables(spark, lake)
    layer.publish_layer(spark, lake.path, staged(spark, names, 1, "p1"))
    changes = staged(spark, names, 2, "p2")
    commit, done = publish.commit, []

    def dying(session, change, intent=None):
        if len(done) == stop:
            raise Died
        done.append(change.table)
        return commit(session, change, intent)

    monkeypatch.setattr(publish, "commit", dying)
    if stop < 3:
        with pytest.raises(Died):
            layer.publish_layer(spark, lake.path, changes)
    else:
        layer.publish_layer(spark, lake.path, changes)
    monkeypatch.undo()
    assert done == names[:stop]  # the upsert first
    assert len(layer.unfinished_layers(spark, lake.path)) == (stop < 3)
    layer.finish_layers(spark, lake.path)
    assert values(spark, names) == [[2], [2], [2]] and layer.finish_layers(spark, lake.path) == []
    for t in names:
        assert len([v for v in publish.mf.versions(spark, publish.table_home(spark, t))]) == 2  # none was committed twice
        assert publish.published(spark, t).where("partition = 'p2'").count() == 5


def test_before_the_intent_nothing_is_published(spark, lake, monkeypatch):
    names = tables(spark, lake)
    changes = staged(spark, names, 2, "p2")

    def no(*args):
        raise Died

    monkeypatch.setattr(layer.mf, "create_text", no)
    with pytest.raises(Died):
        layer.publish_layer(spark, lake.path, changes)
    monkeypatch.undo()
    assert layer.finish_layers(spark, lake.path) == [] and values(spark, names) == [[], [], []]


def test_a_refused_upsert_withdraws_the_layer(spark, lake, monkeypatch):
    names = tables(spark, lake)
    changes = staged(spark, names, 2, "p2")
    publish.upsert(spark, names[0], frame(spark, 7, "p9"), ["k"])  # another writer
    with pytest.raises(publish.ConflictError):
        layer.publish_layer(spark, lake.path, changes)
    assert values(spark, names) == [[], [], []] and layer.unfinished_layers(spark, lake.path) == []
    assert spark.table(names[0]).where(F.col("v") == 7).count() == 5


def test_the_next_run_finishes_a_layer(spark, lake, monkeypatch):
    from medallion.plans.sales import SalesMartETL
    from medallion.sources.testdata import batch_source
    from tests.conftest import SF_SMALL

    etl = SalesMartETL(spark, lake.path, lake.db, batch_source(SF_SMALL, "1996-01-01"))
    commit, seen = publish.commit, []

    def dying(session, change, intent=None):
        seen.append(change.table.split(".")[1])
        if seen[-1] == "fct_orders":
            raise Died
        return commit(session, change, intent)

    monkeypatch.setattr(publish, "commit", dying)
    with pytest.raises(Died):
        etl.run("2024-01-01-00-00-00")
    monkeypatch.undo()
    count = lambda name: publish.read_version(spark, f"{lake.db}.{name}").count()
    assert seen == ["customer", "orders", "dim_customer", "fct_orders"] and count("dim_customer") and not count("fct_orders")
    SalesMartETL(spark, lake.path, lake.db, batch_source(SF_SMALL)).run("2024-01-02-00-00-00")
    by = {r["partition"]: r["n"] for r in spark.table(f"{lake.db}.fct_orders").groupBy("partition").agg(F.count("*").alias("n")).collect()}
    assert set(by) == {"2024-01-01-00-00-00", "2024-01-02-00-00-00"}
