"""Helpers shared by the operators: reading tables, cutting lineage, joining
decisions back to documents, and connected components over link tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.session import scratch_path

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` once to the shared folder and read it back.

    Later jobs start from the files, so a lost executor costs no recomputation
    of what came before, and the plan stays short."""
    spark = frame.sparkSession
    path = scratch_path(spark, "llm", name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of ``links`` (a, b long): (node, component), where
    component is the smallest node reachable. Only nodes in a link appear.

    Alternates two contractions on the link table itself until it is a set of
    stars: *large star* (every neighbour larger than a node points to the
    smallest neighbour) and *small star* (the same for smaller neighbours).
    Both are one grouped minimum and one join; the number of links never
    grows, so a hub with very many links costs no more than its links."""
    links = written(_canonical(links), "links")
    before = _state(links)
    for _ in range(rounds):
        links = written(_canonical(_star(_star(links, large=True), large=False)), "links")
        now = _state(links)
        if now == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                links.select("b", "b").distinct()
            )
        before = now
    raise RuntimeError("connected components did not settle")


def merged_components(known: DataFrame, links: DataFrame) -> DataFrame:
    """Components of the links that gave ``known`` (node, component) together
    with more ``links`` (a, b): only what joins different known components is
    contracted again."""
    known = written(known, "known")
    ends = links.select("a", "b")
    for end in ("a", "b"):
        side = known.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
        ends = ends.join(side, F.col(end) == F.col("_n"), "left").withColumn(end, F.coalesce("_c", end)).drop("_n", "_c")
    again = written(components(ends), "again")
    again = again.select(F.col("node").alias("_n"), F.col("component").alias("_root"))
    moved = known.join(again, F.col("component") == F.col("_n"), "left")
    out = moved.select("node", F.coalesce("_root", "component").alias("component"))
    new = again.join(known, F.col("_n") == F.col("node"), "left_anti")  # nodes that had no link before
    return out.unionByName(new.select(F.col("_n").alias("node"), F.col("_root").alias("component")))


def _state(links: DataFrame) -> tuple:
    """Count and order-free hash of a link table: two numbers."""
    return tuple(
        links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    )


def _canonical(links: DataFrame) -> DataFrame:
    """Larger end first, without loops and repeats."""
    return links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One contraction. ``links`` holds (a, b) with a > b or either order."""
    if large:
        ends = links.select("a", "b").union(links.select("b", "a"))
    else:
        ends = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = ends.groupBy(F.col("a").alias("_n")).agg(F.min("b").alias("_m")).select(
        "_n", F.least("_n", "_m").alias("_m")
    )
    joined = ends.join(least, ends["a"] == least["_n"])
    if large:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    return joined.select(F.col("b").alias("a"), F.col("_m").alias("b")).union(
        least.select(F.col("_n").alias("a"), F.col("_m").alias("b"))
    ).where("a <> b")
