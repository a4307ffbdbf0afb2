"""Mixing sources to target weights by iterative proportional fitting.

Token counts are summed into cells of (source, language, topic). Raking scales
the cells' weights to each axis' target shares in turn until all three fit.
A cell's factor is its raked weight per token it has; documents of the cell are
sampled with probability ``min(1, scale * factor)``, the scale chosen so that
the expected tokens are ``budget`` of all there are (cells that would need more
than they have are taken whole). Whether a document is sampled depends on a
hash of its doc_id, source and language only, so a rerun samples the same rows.

Without explicit targets an axis' shares are its token shares to the power
``ALPHA``, which lifts rare sources, languages and topics.

The cell table is raked by Spark jobs on the cells alone; it meets the
documents by key, broadcast only when its observed size fits the limit.

Defined results: null source or language are values of their own; a value an
explicit target does not name gets share 0, targets for absent values are left
out and the rest scaled up; documents without tokens have probability 0;
repeated rows are sampled alike; an empty table gives an empty result; extra
columns pass through ``sample`` untouched.
"""

from __future__ import annotations

from collections import namedtuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.common import table, written
from medallion.operators.sizing import ONE_SIDE_LIMIT, observe_profile, small_side

AXES = ("source", "lang", "topic")
ALPHA = 0.7
BUDGET = 0.6
ROUNDS = 40
TOLERANCE = 1e-4
NULL = "\x00null"

Cells = namedtuple("Cells", "table scale fits")


def token_weight() -> Column:
    """Words of the text: the weight a document is mixed by."""
    return F.coalesce(F.regexp_count("text", F.lit(r"\S+")), F.lit(0)).cast("long")


def topic(tokens: Column) -> Column:
    """A document's topic by its form: table, listing, short, long or prose."""
    text = F.coalesce("text", F.lit(""))
    bars = F.length(text) - F.length(F.replace(text, F.lit("|"), F.lit("")))
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return (
        F.when(bars * 4 >= tokens, "table").when(lines * 8 >= tokens, "listing")
        .when(tokens < 64, "short").when(tokens >= 1000, "long").otherwise("prose")
    )


def _axes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, lang, topic, tokens), nulls named."""
    rows = docs.select("doc_id", "source", "lang", token_weight().alias("tokens"), "text")
    return rows.select(
        "doc_id", *[F.coalesce(F.col(a).cast("string"), F.lit(NULL)).alias(a) for a in AXES[:2]],
        topic(F.col("tokens")).alias("topic"), "tokens",
    )


def _shares(cells: DataFrame, axis: str, target: dict[str, float] | None) -> DataFrame:
    """(axis value, share) of every value present, adding up to 1."""
    sums = cells.groupBy(axis).agg(F.sum("tokens").alias("t"))
    if target is None:
        weight = F.pow(F.col("t").cast("double"), F.lit(ALPHA))
    else:
        weight = F.lit(0.0)
        for value, share in target.items():
            weight = F.when(F.col(axis) == F.lit(value), F.lit(float(share))).otherwise(weight)
    rows = sums.withColumn("weight", weight)
    total = rows.agg(F.sum("weight")).first()[0]
    return rows.select(axis, (F.col("weight") / F.lit(total)).alias("share") if total else F.lit(0.0).alias("share"))


def rake(cells: DataFrame, targets: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """``cells`` (axes, tokens) with ``weight``, whose shares by each axis are
    the targets (shares of all the weight)."""
    targets = targets or {}
    columns = cells.columns
    cells = cells.where("tokens > 0")
    shares = {a: written(_shares(cells, a, targets.get(a)), f"shares_{a}") for a in AXES}
    total = cells.agg(F.sum("tokens")).first()[0]
    if not total:
        return cells.withColumn("weight", F.lit(0.0))
    cells = cells.withColumn("weight", F.col("tokens") / F.lit(float(total)))
    for a in AXES:
        cells = cells.join(shares[a].withColumnRenamed("share", f"_share_{a}"), a)
    cells = written(cells, "cells")
    # Written after each axis, a step's plan is one sum and one join: unwritten, each
    # axis would repeat the plans of those before it, which fills the driver's memory.
    for _ in range(ROUNDS):
        for a in AXES:
            sums = cells.groupBy(F.col(a).alias("_v")).agg(F.sum("weight").alias("_s"), F.max(f"_share_{a}").alias("_t"))
            ratio = sums.select("_v", F.when(F.col("_s") > 0, F.col("_t") / F.col("_s")).otherwise(0.0).alias("_r"))
            cells = cells.join(ratio, cells[a] == ratio["_v"]).withColumn("weight", F.col("weight") * F.col("_r")).drop("_v", "_r")
            cells = written(cells, "cells")
        each = F.array(*[F.struct(F.lit(a).alias("axis"), F.col(a).alias("value"), F.col(f"_share_{a}").alias("share")) for a in AXES])
        sums = cells.select("weight", F.explode(each).alias("_of")).select("weight", "_of.*").groupBy("axis", "value").agg(
            F.sum("weight").alias("_s"), F.max("share").alias("_t"))
        if (sums.agg(F.max(F.abs(F.col("_s") - F.col("_t")))).first()[0] or 0.0) < TOLERANCE:
            break
    return cells.select(*columns, "weight")


def _scale(cells: DataFrame, budget: float) -> float:
    """The scale at which expected tokens are ``budget`` of all: two passes of
    a grid of scales over the cells."""
    bounds = cells.where("factor > 0").agg(F.min("factor"), F.max("factor"), F.sum("tokens")).first()
    if bounds[2] is None:
        return 0.0
    wanted = budget * (cells.agg(F.sum("tokens")).first()[0] or 0)
    lo, hi = 1e-9 / bounds[1], 1 / bounds[0]
    for _ in range(3):
        grid = [lo * (hi / lo) ** (k / 63) for k in range(64)]
        sums = cells.agg(*[F.sum(F.col("tokens") * F.least(F.lit(1.0), F.col("factor") * F.lit(s))) for s in grid]).first()
        at = next((k for k, s in enumerate(sums) if s >= wanted), 63)
        lo, hi = grid[max(0, at - 1)], grid[at]
    return hi


def fit(axes: DataFrame, targets=None, budget: float = BUDGET) -> Cells:
    """Cells with their sampling probability, from (axes, tokens) rows."""
    sums = written(axes.groupBy(*AXES).agg(F.sum("tokens").alias("tokens")), "cell_sums")
    factors = written(rake(sums, targets).withColumn("factor", F.col("weight") / F.col("tokens")), "factors")
    scale = _scale(factors, budget)
    chances = factors.select(*[F.col(a).alias(f"_m_{a}") for a in AXES],
                             F.least(F.lit(1.0), F.col("factor") * F.lit(scale)).alias("_m_chance"))
    observed, profile = observe_profile(chances)
    chances = written(observed, "chances")
    return Cells(chances, scale, profile().fits(chances, chances.columns, ONE_SIDE_LIMIT))


def _chance(rows: DataFrame, axes: dict[str, Column], cells: Cells) -> DataFrame:
    side = small_side(cells.table, cells.fits)
    on = None
    for a, c in axes.items():
        on = (c == side[f"_m_{a}"]) if on is None else on & (c == side[f"_m_{a}"])
    return rows.join(side, on, "left").withColumn("_m_chance", F.coalesce("_m_chance", F.lit(0.0)))


def _draw(*keys: Column) -> Column:
    """A number in [0, 1) that only depends on the keys."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(29), *keys), 11) / F.lit(float(1 << 53))


def mix(docs: DataFrame, targets=None, budget: float = BUDGET) -> DataFrame:
    """(doc_id, source, lang, topic, tokens, probability, sampled) for every
    row of ``docs``."""
    rows = written(_axes(docs), "mix_axes")
    cells = fit(rows.select(*AXES, "tokens"), targets, budget)
    out = _chance(rows, {a: rows[a] for a in AXES}, cells)
    null = F.lit(NULL)
    return out.select(
        "doc_id", *[F.nullif(F.col(a), null).alias(a) for a in AXES], "tokens",
        F.when(F.col("tokens") > 0, F.col("_m_chance")).otherwise(0.0).alias("probability"),
    ).withColumn("sampled", _draw(F.col("doc_id").cast("string"), F.coalesce("source", null), F.coalesce("lang", null)) < F.col("probability"))


def sample(docs: DataFrame, targets=None, budget: float = BUDGET) -> DataFrame:
    """The sampled rows of ``docs``; texts stay where they are."""
    cells = fit(_axes(docs).select(*AXES, "tokens"), targets, budget)
    null = F.lit(NULL)
    rows = docs.withColumns({"_m_tokens": token_weight()})
    rows = rows.withColumns({
        "_m_s": F.coalesce(F.col("source").cast("string"), null), "_m_l": F.coalesce(F.col("lang").cast("string"), null),
        "_m_t": topic(F.col("_m_tokens")),
    })
    out = _chance(rows, {"source": F.col("_m_s"), "lang": F.col("_m_l"), "topic": F.col("_m_t")}, cells)
    out = out.where((F.col("_m_tokens") > 0) & (_draw(F.col("doc_id").cast("string"), F.col("_m_s"), F.col("_m_l")) < F.col("_m_chance")))
    return out.select(*[docs[c] for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
