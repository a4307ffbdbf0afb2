"""URL filters by a temporal list join.

List entries are dated: from ``at`` on, a pattern (a host, or a host and the
first segments of a path) is listed (``add``) or no longer listed (``drop``) by a
list. Times are compared in microseconds.
The entries of a list and pattern become validity intervals [from, to): each
reaches to the next entry of the same list and pattern. A capture (url,
fetched) is looked up under its host, every parent domain, and each of those
with its first path segments, as many as any entry has, and the as-of join keeps
the intervals that hold ``fetched``. A capture is blocked when a ``block`` list holds it at that time
and no ``allow`` list does by a pattern that is at least as long.

Keys may be hot (a third of the captures on one host; many dated entries of
one host), so neither side is grouped by key: time is cut into ``BUCKETS``
equal buckets, intervals are repeated for the buckets they reach into, captures
have one bucket, and the join is on (pattern, bucket) with the interval test on
top. Intervals are made within buckets too: what was in force when a bucket
began is carried into it from the last entry of an earlier bucket, so no window
holds more than one bucket of one pattern. AQE splits what is still skewed.

Defined results: a null or unparsable url, or a null fetch time, matches
nothing and is not blocked; entries with a null part are ignored; of entries at
the same instant a ``drop`` wins; repeated entries and captures change nothing
(captures give a row each); empty lists block nothing; extra columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medallion.llm.common import table, written

BUCKETS = 64


def host_of(url: Column) -> Column:
    """Lower-case host of an http(s) URL, without user name, port and trailing
    dot; null if there is none."""
    host = F.regexp_extract(F.lower(url), r"^https?://(?:[^/?#]*@)?([^/?#:@]+)", 1)
    return F.nullif(F.regexp_replace(host, r"\.+$", ""), F.lit(""))


def segment_of(url: Column) -> Column:
    """First path segment ('' if there is none), as written."""
    return F.regexp_extract(url, r"^[a-zA-Z]+://[^/?#]+/([^/?#]*)", 1)


def path_prefixes(url: Column, depth: int) -> Column:
    """The first 1 .. ``depth`` path segments, as written; those that would end
    in an empty segment ('/a/' after 'a') are left out."""
    path = F.split(F.regexp_extract(url, r"^[a-zA-Z]+://[^/?#]+/([^?#]*)", 1), "/")
    ends = F.sequence(F.lit(1), F.least(F.size(path), F.lit(depth)))
    return F.transform(F.filter(ends, lambda k: F.get(path, k - 1) != ""), lambda k: F.array_join(F.slice(path, 1, k), "/"))


def patterns(url: Column, depth: int = 1) -> Column:
    """What a capture is looked up under: host, parent domains of at least two
    labels, and each with the first path segments, up to ``depth`` of them."""
    labels = F.split(host_of(url), r"\.")
    n = F.size(labels)
    domains = F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), n - 1)),
        lambda k: F.array_join(F.slice(labels, k, n), "."),
    )
    found = domains
    if depth > 0:
        prefixes = path_prefixes(url, depth)
        found = F.concat(domains, F.flatten(F.transform(domains, lambda d: F.transform(prefixes, lambda p: F.concat(d, F.lit("/"), p)))))
    return F.when(host_of(url).isNotNull(), found)


def _bucket(at: Column, lo: int, width: int) -> Column:
    """Bucket of a time given in microseconds: 0 before ``lo``, and one bucket
    for all that lies far behind the last capture."""
    return F.greatest(F.lit(0), F.least(F.lit(1 << 30), F.floor((at - F.lit(lo)) / F.lit(width)))).cast("int")


def intervals(entries: DataFrame, lo: int, width: int, last: int) -> DataFrame:
    """(list, kind, pattern, bucket, start, stop): the parts of the validity
    intervals of listed patterns that lie in each bucket up to ``last``."""
    key = ["list", "kind", "pattern"]
    dated = (
        entries.where(" AND ".join(f"{c} IS NOT NULL" for c in (*key, "action", "at")))
        .where(F.col("action").isin("add", "drop"))
        .groupBy(*key, F.unix_micros(F.col("at").cast("timestamp")).alias("at"))
        .agg(F.max(F.struct((F.col("action") == "drop").alias("gone"))).alias("s"))
        .select(*key, "at", (~F.col("s.gone")).alias("on"))
        .withColumn("bucket", _bucket(F.col("at"), lo, width))
    )
    dated = written(dated, "dated")
    # the state each bucket with entries leaves behind, reaching to the next such bucket
    left = dated.groupBy(*key, "bucket").agg(F.max_by("on", "at").alias("on"))
    reach = left.withColumn("next", F.lead("bucket").over(Window.partitionBy(*key).orderBy("bucket")))
    carried = (
        reach.where("on").withColumn("until", F.least(F.coalesce("next", F.lit(last)), F.lit(last)))
        .where("until > bucket")
        .select(*key, F.explode(F.sequence(F.col("bucket") + 1, F.col("until"))).alias("bucket"))
        .select(*key, "bucket", (F.lit(lo) + F.col("bucket").cast("long") * F.lit(width)).cast("long").alias("at"), F.lit(True).alias("on"), F.lit(0).alias("order"))
    )
    events = carried.unionByName(dated.select(*key, "bucket", "at", "on", F.lit(1).alias("order")))
    within = Window.partitionBy(*key, "bucket").orderBy("at", "order")
    return (
        events.withColumn("stop", F.lead("at").over(within)).where("on")
        .select(*key, "bucket", F.col("at").alias("start"), "stop").where("stop IS NULL OR stop > start")
    )


def filter_captures(captures: DataFrame, entries: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(page_id, url, fetched, blocked, blocked_by, allowed_by) for every row of
    ``captures`` (page_id, url, fetched); the lists are sorted arrays of names.
    """
    rows = captures.select("page_id", "url", F.col("fetched").cast("timestamp").alias("fetched"))
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "captures")
    micros = F.unix_micros("fetched")
    span = rows.agg(F.min(micros), F.max(micros)).first()
    lo, hi = (span[0], span[1]) if span[0] is not None else (0, 0)
    width = max(1, -(-(hi - lo + 1) // buckets))
    depth = entries.agg(F.max(F.size(F.split("pattern", "/")) - 1)).first()[0] or 0
    asked = rows.where("fetched IS NOT NULL").select(
        "row", micros.alias("at"), _bucket(micros, lo, width).alias("bucket"), F.explode(patterns(F.col("url"), depth)).alias("pattern"))
    held = intervals(entries, lo, width, (hi - lo) // width)
    hits = (
        asked.join(held, ["pattern", "bucket"])
        .where("start <= at AND (stop IS NULL OR at < stop)")
        .groupBy("row")
        .agg(
            F.max(F.when(F.col("kind") == "block", F.length("pattern"))).alias("block_length"),
            F.max(F.when(F.col("kind") == "allow", F.length("pattern"))).alias("allow_length"),
            F.sort_array(F.collect_set(F.when(F.col("kind") == "block", F.col("list")))).alias("blocked_by"),
            F.sort_array(F.collect_set(F.when(F.col("kind") == "allow", F.col("list")))).alias("allowed_by"),
        )
    )
    none = F.array().cast("array<string>")
    blocked = F.col("block_length").isNotNull() & (
        F.col("allow_length").isNull() | (F.col("allow_length") < F.col("block_length")))
    return rows.join(hits, "row", "left").select(
        "page_id", "url", "fetched", blocked.alias("blocked"),
        F.coalesce("blocked_by", none).alias("blocked_by"), F.coalesce("allowed_by", none).alias("allowed_by"))


# ------------------------------------------------------- the registered query

EPOCH = 1_700_000_000


def _roll(key: Column, salt: str, below: int) -> Column:
    """A number in 0 .. below - 1 from a key, the same in Spark and DuckDB."""
    return F.pmod(F.conv(F.substring(F.md5(F.concat(key, F.lit(salt))), 1, 7), 16, 10).cast("long"), F.lit(below))


def page_captures(pages: DataFrame) -> DataFrame:
    """The pages as captures: page_id n was fetched n * 977 seconds, modulo 90
    days, after the start (the pages carry no fetch time of their own)."""
    at = F.lit(EPOCH) + F.pmod(F.col("page_id") * 977, F.lit(90 * 86400))
    return pages.select("page_id", "url", F.timestamp_seconds(at).alias("fetched"))


def page_entries(pages: DataFrame) -> DataFrame:
    """Dated lists over the hosts that occur: half the hosts are on ``abuse``
    from some day on for some days, a quarter on ``adult`` with a path, an
    eighth on ``trusted`` (allow)."""
    hosts = pages.select(host_of(F.col("url")).alias("host"), segment_of(F.col("url")).alias("segment")).where("host IS NOT NULL").distinct()
    day = F.lit(86400)

    def entry(rows: DataFrame, name: str, kind: str, pattern: Column, one_in: int) -> DataFrame:
        chosen = rows.select(pattern.alias("pattern")).distinct().where(_roll(F.col("pattern"), name, one_in) == 0)
        begin = F.lit(EPOCH) + _roll(F.col("pattern"), name + "from", 60) * day
        stay = (_roll(F.col("pattern"), name + "for", 40) + 1) * day
        dates = F.explode(F.array(
            F.struct(begin.alias("at"), F.lit("add").alias("action")),
            F.struct((begin + stay).alias("at"), F.lit("drop").alias("action")),
            F.struct((begin + 2 * stay).alias("at"), F.lit("add").alias("action")),
        )).alias("d")
        return chosen.select("pattern", dates).select(
            F.lit(name).alias("list"), F.lit(kind).alias("kind"), "pattern", "d.action", F.timestamp_seconds("d.at").alias("at"))

    parent = F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)
    return (
        entry(hosts, "abuse", "block", F.col("host"), 2)
        .unionByName(entry(hosts.where("segment <> ''"), "adult", "block", F.concat("host", F.lit("/"), "segment"), 4))
        .unionByName(entry(hosts, "parked", "block", parent, 3))
        .unionByName(entry(hosts, "trusted", "allow", F.col("host"), 8))
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    out = filter_captures(page_captures(pages), page_entries(pages))
    return out.select(
        "page_id", F.unix_timestamp("fetched").alias("fetched"), "blocked",
        F.array_join("blocked_by", ",").alias("blocked_by"), F.array_join("allowed_by", ",").alias("allowed_by"))
