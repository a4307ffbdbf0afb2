"""Line dedup by a fixed-depth log-template tree, in DataFrame functions only.

Every line is parsed down a tree of fixed depth: its token count, then its
first ``LEADING`` tokens, then a leaf. Tokens that hold a digit are variable
fields from the start (``<*>``, unless that would leave less than half of the
line). At the leaf a line of at least ``SPLIT`` tokens belongs to two
templates: one that keeps the first half of its other tokens and generalises
the second, and one the other way round; a shorter line keeps all tokens. A
template that occurs in several documents is recurring: its lines are dropped
from all of them but the first, the smallest doc_id. Lines of one token are
parsed like any other; lines without tokens make no template and stay.

Lines travel as 64-bit template hashes, never as text. Template counts are
combined before the shuffle, so a line that a third of all documents share
costs one row per task; the recurring templates meet the lines again by key,
broadcast only if their observed size fits, else by a shuffle that AQE splits.

Defined results: a null or empty text has no lines and stays as it is; rows of
a doc_id that is null keep all lines and make no template; repeated rows are
treated alike, and lines repeated within one document stay; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.common import table, written
from medallion.operators.sizing import ONE_SIDE_LIMIT, observe_profile, small_side

LEADING = 3
SPLIT = 12

# What separates tokens, and tokens that hold a digit.
TOKEN = r"[^ \t\n\x0B\f\r]+"
VARIABLE = r"[^ \t\n\x0B\f\r]*[0-9][^ \t\n\x0B\f\r]*"


def lines_of(text: Column) -> Column:
    return F.when(F.length(text) > 0, F.split(text, "\n"))


def _with_templates(lines: DataFrame, shortest: int) -> DataFrame:
    """``lines`` with ``template``, a row for each template of a line."""
    raw = F.regexp_extract_all("line", F.lit(TOKEN), 0)
    parsed = lines.withColumn("masked", F.regexp_replace("line", VARIABLE, "<*>")).where(F.length("line") >= 2 * shortest - 1)
    parsed = parsed.withColumn("tokens", F.regexp_extract_all("masked", F.lit(TOKEN), 0))
    parsed = parsed.withColumn("n", F.size("tokens")).where(F.col("n") >= shortest)
    variable = F.size(F.array_remove("tokens", "<*>"))
    parsed = parsed.withColumn("tokens", F.when(variable * 2 >= F.col("n"), F.col("tokens")).otherwise(raw))
    half = F.floor((F.col("n") - LEADING) / 2).cast("int")
    first = F.xxhash64(F.lit(1), "n", F.slice("tokens", 1, F.lit(LEADING) + half))
    second = F.xxhash64(F.lit(2), "n", F.slice("tokens", 1, LEADING), F.slice("tokens", F.lit(LEADING) + half + 1, F.col("n")))
    whole = F.xxhash64(F.lit(0), "n", "tokens")
    templates = F.when(F.col("n") >= SPLIT, F.array(first, second)).otherwise(F.array(whole))
    return parsed.select("doc_id", "version", "line_no", F.explode(templates).alias("template"))


def dropped_lines(docs: DataFrame, shortest: int = 1) -> DataFrame:
    """(doc_id, version, dropped): per document the numbers of its dropped
    lines; ``version`` tells texts of one doc_id apart."""
    lines = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"),
        F.posexplode(lines_of(F.col("text"))).alias("line_no", "line"))
    rows = written(_with_templates(lines, shortest), "templates")
    first = rows.groupBy("template").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    observed, profile = observe_profile(first.select(F.col("template").alias("recurring"), "first"))
    first = written(observed, "recurring")
    first = small_side(first, profile().fits(first, first.columns, ONE_SIDE_LIMIT))
    return (
        rows.join(first, F.col("template") == F.col("recurring")).where("doc_id > first")
        .groupBy("doc_id", "version").agg(F.sort_array(F.collect_set("line_no")).alias("dropped"))
    )


def drop_recurring(docs: DataFrame, shortest: int = 1) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text) for every row of ``docs``: the text
    without the lines of recurring templates of ``shortest`` or more tokens."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("version"))
    out = rows.join(dropped_lines(docs, shortest), ["doc_id", "version"], "left")
    lines, dropped = lines_of(F.col("text")), F.col("dropped")
    kept = F.filter(F.transform(lines, lambda x, i: F.when(~F.array_contains(dropped, i), x)), lambda x: x.isNotNull())
    return out.select(
        "doc_id", F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(dropped), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(dropped.isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
    ).withColumns({c: F.greatest(F.lit(0).cast("long"), F.col(c)) for c in ("n_lines", "n_dropped")})


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_recurring(table(spark, sf_dir, "documents"))
