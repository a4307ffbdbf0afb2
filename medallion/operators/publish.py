"""Writing to catalog tables: stage once, then publish by a catalog call.

Plain Parquet tables have no transaction log, so ``MERGE`` / ``DELETE`` /
``replaceWhere`` are not available, and a table cannot be overwritten by a
plan that reads it. Every publish here is therefore three steps:

1. **stage**: write the new content ONCE to a fresh folder under the table's
   home folder (the shared storage the table was created in);
2. **commit**: create the manifest of the next version, a small file that names
   the folder of every partition. Creating it fails if another writer has
   published since, so no version is lost and none is given twice;
3. **apply**: point the catalog at the new folders, with ``ALTER TABLE ..
   [PARTITION ..] SET LOCATION``.

The manifest of the highest number is the version in force. Every stage and
publish first brings its session's catalog up to it, so a publish that stopped
between commit and apply, or one made through another catalog, is finished by
whoever comes next (``finish_publish``).

An upsert into a table partitioned by one column rewrites only the partitions
it touches (those holding a matched row, and those the new rows go to). In a
*bucketed* table (``BUCKET`` and one more column; ``pmod(xxhash64(keys), N)``)
it also looks for matches only in the buckets of its keys: other buckets are
neither read nor written. An unpartitioned table gets a whole new version.

A publish of several partitions is several catalog calls. Partitions that
receive source rows come first, shrunk ones next, dropped ones last: a stop in
between shows some rows twice and loses none. A reader of one partition sees the
old or the new folder; a reader of the whole table may see both states while the
calls run.

An upsert is refused with ``ConflictError`` when another publish of the table
came between its staging and its commit; nothing is changed then. Replacing a
partition reads nothing of the table, so it is committed on top of whatever was
published meanwhile; of two writers of one partition the last wins.

Checks run between staging and commit, on the staged files, so a failed check
publishes nothing. Frames resolved before a publish keep reading the folder
they were resolved against. Replaced folders stay, like the old versions of a
table log, until ``remove_unreferenced`` deletes what no manifest in force
names.
"""

from __future__ import annotations

import json
import re
import uuid
from collections import namedtuple
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from medallion.operators import manifest as mf
from medallion.operators.profiles import PartProfiles, profile_parts
from medallion.operators.sizing import observe_profile, small_side
from medallion.session import sql_str

HOME_PROPERTY = "medallion.home"
VERSION_PROPERTY = "medallion.version"  # the version that this catalog shows
BUCKETS_PROPERTY = "medallion.buckets"
BUCKET_KEYS_PROPERTY = "medallion.bucket_keys"
VIEW_PROPERTY = "medallion.latest_view"
BUCKET = "key_bucket"  # the layout column of a bucketed table


class DuplicateKeyError(ValueError):
    """Several source rows match one target row in an upsert."""


class ConflictError(RuntimeError):
    """Another publish of the table came between staging and publishing."""


# --------------------------------------------------------------------- catalog


def _describe(spark: SparkSession, table: str) -> dict:
    """Location, table properties and partition columns, from one
    ``DESCRIBE TABLE EXTENDED``."""
    info = {"partition_cols": [], "properties": {}}
    inside = False
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect():
        name, value = (r["col_name"] or "").strip(), r["data_type"] or ""
        if name == "# Partition Information":
            inside = True
        elif inside:
            if not name or (name.startswith("#") and name != "# col_name"):
                inside = False
            elif name != "# col_name":
                info["partition_cols"].append(name)
        if name == "Location":
            info["location"] = value
        elif name == "Table Properties":
            info["properties"] = _parse_properties(value)
    return info


def _parse_properties(text: str) -> dict[str, str]:
    """``[k1=v1, k2=v2]`` as printed by DESCRIBE (values may hold ', ')."""
    body = text.strip()
    if body.startswith("[") and body.endswith("]"):
        body = body[1:-1]
    props, key = {}, None
    for piece in re.split(r", (?=[\w.\-]+=)", body):
        if "=" in piece:
            key, value = piece.split("=", 1)
            props[key] = value
    return props


def table_home(spark: SparkSession, table: str) -> str:
    """The folder new versions of the table are staged in."""
    info = _describe(spark, table)
    return (info["properties"].get(HOME_PROPERTY) or info["location"]).rstrip("/")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return _describe(spark, table)["partition_cols"]


def _fields(spark: SparkSession, table: str) -> list[StructField]:
    return list(spark.table(table).schema.fields)


class _Meta:
    """What one operation needs to know about its table, fetched once."""

    def __init__(self, spark: SparkSession, table: str):
        info = _describe(spark, table)
        properties = info["properties"]
        self.home = (properties.get(HOME_PROPERTY) or info["location"]).rstrip("/")
        self.partition_cols = info["partition_cols"]
        self.applied = properties.get(VERSION_PROPERTY) or None
        self.version = mf.newest(spark, self.home)
        self.buckets = int(properties[BUCKETS_PROPERTY]) if self.partition_cols[:1] == [BUCKET] else None
        self.bucket_keys = properties.get(BUCKET_KEYS_PROPERTY, "").split(",") if self.buckets else None
        self.view = json.loads(properties[VIEW_PROPERTY]) if properties.get(VIEW_PROPERTY) else None
        self.fields = _fields(spark, table)

    def staging_path(self, kind: str) -> str:
        return f"{self.home}/_{kind}/{uuid.uuid4().hex}"

    def part(self) -> Column:
        """A row's partition key: the value, in a bucketed table 'bucket/value'."""
        return F.concat_ws("/", *[F.col(c).cast("string") for c in self.partition_cols])

    def values(self, part: str) -> list[str]:
        return part.split("/", 1) if self.buckets else [part]

    def folder(self, part: str) -> str:
        """Where ``partitionBy`` writes a partition."""
        return "/".join(partition_dir(c, v) for c, v in zip(self.partition_cols, self.values(part)))

    def spec(self, part: str) -> str:
        """The partition in SQL."""
        of = zip(self.partition_cols, self.values(part))
        return ", ".join(f"`{c}` = {v if c == BUCKET else sql_str(v)}" for c, v in of)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row. Rows with a NULL key match nothing; all columns
    would do to spread them, so the caller gives those as ``keys``."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _with_bucket(frame: DataFrame, meta: _Meta) -> DataFrame:
    keys = meta.bucket_keys
    every = [f.name for f in meta.fields if f.name != BUCKET]
    null = F.expr(" OR ".join(f"`{k}` IS NULL" for k in keys))
    bucket = F.when(null, bucket_of(every, meta.buckets)).otherwise(bucket_of(keys, meta.buckets))
    return frame.withColumn(BUCKET, bucket).select(*[f.name for f in meta.fields])


def published(spark: SparkSession, table: str) -> DataFrame:
    """The table as its users know it: without the layout column."""
    return spark.table(table).drop(BUCKET)


def conform(frame: DataFrame, fields: Sequence[StructField], strict: bool = False) -> DataFrame:
    """Project ``frame`` onto a table's columns, in the table's order.

    ``etl_inserted`` is stamped with the load time when the table has it and
    the frame does not. Any other missing column is an error; so is, when
    ``strict`` (replacing a partition), any column the table does not have. An
    upsert updates and inserts the table's columns by name and leaves others.
    """
    have = set(frame.columns)
    unknown = sorted(have - {f.name for f in fields})
    if strict and unknown:
        raise ValueError(f"the table has no column for {unknown}")
    cols = []
    for f in fields:
        if f.name in have:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name == "etl_inserted":
            cols.append(F.current_timestamp().cast(f.dataType).alias(f.name))
        else:
            raise ValueError(f"column {f.name!r} is missing from the frame")
    return frame.select(*cols)


def materialize(frame: DataFrame, path: str) -> DataFrame:
    """Write ``frame`` to ``path`` once and read it back (cuts the lineage)."""
    frame.write.mode("errorifexists").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


Staged = namedtuple("Staged", "path frame profile parts base parts_profile", defaults=(None, None, None))
Staged.__doc__ = """A written table version: folder, frame over the new content,
the size profile of the whole version (None when it is not known), for a
partitioned upsert the touched partitions as (key, has_rows) pairs in publishing
order (None: the folder is the whole table), the version of the table it was made
from, and the profiles of its partitions, if asked for."""

# Characters written as %XX in partition folder names
# (Hive's escaping rule, which Spark follows), plus control characters.
_PATH_ESCAPES = frozenset('"#%\'*/:=?\\\x7f{[]^') | frozenset(chr(c) for c in range(1, 32))


def partition_dir(column: str, value: str) -> str:
    """Folder name ``column=value`` that ``partitionBy`` writes for a value."""
    return f"{column}=" + "".join(f"%{ord(ch):02X}" if ch in _PATH_ESCAPES else ch for ch in value)


# ------------------------------------------------------------ replace partition


def stage_partition(
    spark: SparkSession,
    table: str,
    frame: DataFrame,
    partition: str,
    partition_col: str = "partition",
    transform=None,
) -> tuple[str, DataFrame]:
    """Write the new content of one partition; return (folder, staged frame).

    ``transform`` (frame -> frame) is applied to the rows being written, e.g.
    to attach observed metrics that are computed by the write itself.
    """
    if partition is None:
        raise ValueError("partition must be given")
    meta = _settled(spark, table)
    if meta.partition_cols != [partition_col]:
        raise ValueError(f"{table} is not partitioned by {partition_col!r} alone")
    data = [f for f in meta.fields if f.name != partition_col]
    path = meta.staging_path("staged")
    rows = conform(frame.drop(partition_col), data, strict=True)  # the partition is stamped, whatever the frame says
    rows, written = _counted(rows)
    (transform(rows) if transform else rows).write.mode("errorifexists").parquet(path)
    if not written():
        mf.write_text(spark, f"{path}/{NO_ROWS}", "")
    staged = spark.read.schema(StructType(data)).parquet(path).select(
        *[F.col(f.name) for f in data], F.lit(partition).alias(partition_col)
    )
    return path, staged


NO_ROWS = "_no_rows"  # a file in a staged folder that got no rows


def _counted(frame: DataFrame):
    """(frame, rows()): how many rows the write of the frame wrote."""
    from pyspark.sql import Observation

    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    return frame.observe(obs, F.count(F.lit(1)).alias("_n")), lambda: obs.get["_n"]


Change = namedtuple("Change", "table changed empty profile base")
Change.__doc__ = """What a publish does to one table: (partition key, folder or
None) in the order of the catalog calls, the keys that got no rows, the file of the
new version's profiles, and the version it was made from (``ANY`` for a replaced
partition, which reads nothing of the table)."""
ANY = "any"


def replacement(spark: SparkSession, table: str, partition: str, path: str) -> Change:
    """The change that makes ``path`` the content of a partition."""
    empty = [partition] if mf.exists(spark, f"{path}/{NO_ROWS}") else []
    return Change(table, [(partition, path)], empty, None, ANY)


def publish_partition(
    spark: SparkSession,
    table: str,
    partition: str,
    path: str,
    partition_col: str = "partition",
) -> None:
    """Make ``path`` the content of the partition (added if new)."""
    commit(spark, replacement(spark, table, partition, path))
    _settled(spark, table)


def commit(spark: SparkSession, change: Change, intent: str | None = None) -> None:
    """Make a change part of the version in force. The catalog follows with the
    next stage, publish or ``finish_publish`` of the table, in any session.

    ``intent`` names the change; one that has been committed under that name is
    not committed again."""
    for _ in range(100):
        meta = _settled(spark, change.table)
        if intent and _committed(spark, meta, intent):
            return
        if change.base not in (ANY, meta.version):
            raise ConflictError(f"{change.table} was published by another writer after this upsert was staged")
        if _commit(spark, change.table, meta, [tuple(c) for c in change.changed], set(change.empty), change.profile, intent):
            return
        # a writer that was faster has published: go on from its version, or find a conflict there
    raise ConflictError(f"{change.table} is published to too often")


def _committed(spark: SparkSession, meta: _Meta, intent: str) -> bool:
    """Whether one of the last versions was made under that name."""
    return any(mf.read_manifest(spark, meta.home, v).get("intent") == intent for v in mf.versions(spark, meta.home)[-KEPT_MANIFESTS:])


def _commit(
    spark: SparkSession, table: str, meta: _Meta, changed: list, empty: set, profile: str | None, intent: str | None
) -> str | None:
    """Create the manifest that follows the version in ``meta``; None if
    another writer did."""
    if meta.version or not meta.partition_cols:
        before = mf.read_manifest(spark, meta.home, meta.version)
        parts, without = before["parts"], set(before["empty"])
    else:  # published to before there were manifests, or never
        parts, without = _catalog_folders(spark, table, meta), set()
    for part, path in changed:
        without.discard(part)
        if path is None:
            parts.pop(part, None)
        else:
            parts[part] = path
    return mf.create_manifest(spark, meta.home, meta.version, parts, changed, sorted(without | empty), profile, intent)


def _catalog_folders(spark: SparkSession, table: str, meta: _Meta) -> dict[str, str]:
    """Folder by partition key as the catalog has it."""
    folders = {}
    for r in spark.sql(f"SHOW PARTITIONS {table}").collect():
        part = "/".join(unquote(v.split("=", 1)[1]) for v in r["partition"].split("/"))
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({meta.spec(part)})").collect()
        folders[part] = {x["col_name"]: x["data_type"] for x in rows}["Location"]
    return folders


def _apply(spark: SparkSession, table: str, meta: _Meta, changed: list) -> None:
    """The catalog calls of a publish, in order; repeating them is harmless."""
    if not meta.partition_cols:
        set_location(spark, table, changed[-1][1])
        return
    kept = [(part, path) for part, path in changed if path is not None]
    attach_partitions(spark, table, meta, kept)
    drop_partitions(spark, table, meta, [part for part, path in changed if path is None])


def _set_properties(spark: SparkSession, table: str, values: dict[str, str]) -> None:
    body = ", ".join(f"{sql_str(k)} = {sql_str(v)}" for k, v in values.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({body})")


def attach_partitions(spark: SparkSession, table: str, meta: _Meta, folders: list[tuple[str, str]]) -> None:
    """Point partitions at folders, in order; new ones first, in one call."""
    if not folders:
        return
    have = set(_catalog_parts(spark, table, meta))
    new = [f for f in folders if f[0] not in have]
    for lo in range(0, len(new), 500):
        body = " ".join(f"PARTITION ({meta.spec(part)}) LOCATION {sql_str(path)}" for part, path in new[lo : lo + 500])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {body}")
    for part, path in folders:
        if part in have:
            spark.sql(f"ALTER TABLE {table} PARTITION ({meta.spec(part)}) SET LOCATION {sql_str(path)}")


def drop_partitions(spark: SparkSession, table: str, meta: _Meta, parts: list[str]) -> None:
    for lo in range(0, len(parts), 500):
        body = ", ".join(f"PARTITION ({meta.spec(part)})" for part in parts[lo : lo + 500])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {body}")


def set_location(spark: SparkSession, table: str, path: str) -> None:
    """Point the table at ``path`` (the command also refreshes cached listings)."""
    spark.sql(f"ALTER TABLE {table} SET LOCATION {sql_str(path)}")


def finish_publish(spark: SparkSession, table: str) -> bool:
    """Bring the catalog up to the version in force; True if it was behind."""
    meta = _Meta(spark, table)
    behind = meta.version is not None and meta.version != meta.applied
    if behind:
        _catch_up(spark, table, meta)
    return behind


def _catch_up(spark: SparkSession, table: str, meta: _Meta) -> None:
    while meta.version != meta.applied:
        body = mf.read_manifest(spark, meta.home, meta.version)
        changed = body["changed"]
        if body["base"] != meta.applied:  # several versions behind, or a catalog that never had the table
            gone = set(_catalog_parts(spark, table, meta)) - set(body["parts"])
            changed = [*body["parts"].items(), *[(part, None) for part in sorted(gone)]]
        _apply(spark, table, meta, [tuple(c) for c in changed])
        # the home is fixed by the first publish: the location moves with each version
        _set_properties(spark, table, {HOME_PROPERTY: meta.home, VERSION_PROPERTY: meta.version})
        if meta.view and spark.catalog.tableExists(meta.view["name"]):
            newest = max((p for p in body["parts"] if p not in body["empty"]), default=None)
            show_partition(spark, table, meta.view, meta.partition_cols[-1], newest)
        meta.applied = meta.version
        meta.version = mf.newest(spark, meta.home)  # a version committed meanwhile is applied last


def _catalog_parts(spark: SparkSession, table: str, meta: _Meta) -> list[str]:
    if not meta.partition_cols:
        return []
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return ["/".join(unquote(v.split("=", 1)[1]) for v in r["partition"].split("/")) for r in rows]


def _settled(spark: SparkSession, table: str) -> _Meta:
    """The table's metadata, with the catalog at the version in force."""
    meta = _Meta(spark, table)
    if meta.version is not None:
        _catch_up(spark, table, meta)
    return meta


def reattach(spark: SparkSession, table: str) -> None:
    """Point a table that was just created over an existing home folder at the
    newest published version found there."""
    _settled(spark, table)


def show_partition(spark: SparkSession, table: str, view: dict, column: str, partition: str | None) -> None:
    """(Re)define a view (``view``: its name and select list) over one partition
    of the table, named as a literal: its readers list and read no other."""
    where = "false" if partition is None else f"`{column}` = {sql_str(partition)}"
    spark.sql(f"CREATE OR REPLACE VIEW {view['name']} AS SELECT {view['select']} FROM {table} WHERE {where}")


def serve_latest(spark: SparkSession, table: str, name: str, select: str) -> None:
    """A view of the newest partition that has rows, renewed by every publish."""
    _set_properties(spark, table, {VIEW_PROPERTY: json.dumps({"name": name, "select": select})})
    meta = _settled(spark, table)
    body = mf.read_manifest(spark, meta.home, meta.version)
    newest = max((p for p in body["parts"] if p not in body["empty"]), default=None)
    show_partition(spark, table, meta.view, meta.partition_cols[-1], newest)


def partition_folders(spark: SparkSession, table: str) -> dict[str, str]:
    """Folder by partition key, from the version in force."""
    meta = _settled(spark, table)
    return mf.read_manifest(spark, meta.home, meta.version)["parts"]


def filled_partitions(spark: SparkSession, table: str) -> list[str]:
    """Keys of the partitions that have rows, as their writes counted them."""
    meta = _settled(spark, table)
    body = mf.read_manifest(spark, meta.home, meta.version)
    return sorted(set(body["parts"]) - set(body["empty"]))


def read_version(spark: SparkSession, table: str, keep=None) -> DataFrame:
    """The version in force, read from the folders its manifest names.

    Unlike a read through the catalog it sees one version only, also while the
    catalog calls of a publish are under way, and it stays on that version. All
    folders are one scan; a row's partition comes from its folder. ``keep``
    (partition key -> bool) leaves partitions out before anything is listed."""
    meta = _Meta(spark, table)
    parts = mf.read_manifest(spark, meta.home, meta.version)["parts"]
    parts = {k: f for k, f in parts.items() if keep is None or keep(k)}
    columns = [f.name for f in meta.fields if f.name != BUCKET]
    if not parts:
        return spark.createDataFrame([], StructType(meta.fields)).select(*columns)
    data = [f for f in meta.fields if f.name not in meta.partition_cols]
    rows = spark.read.schema(StructType(data)).parquet(*parts.values())
    if not meta.partition_cols:
        return rows
    where = {_uri(spark, f): meta.values(k)[-1] for k, f in parts.items()}
    names = spark.createDataFrame(list(where.items()), "_folder string, _value string")  # one row per partition
    folder = F.regexp_replace(F.regexp_replace("_metadata.file_path", "/[^/]*$", ""), "^file:/+", "/")
    kind = next(f.dataType for f in meta.fields if f.name == meta.partition_cols[-1])
    rows = rows.withColumn("_folder", folder).join(F.broadcast(names), "_folder")
    return rows.withColumn(meta.partition_cols[-1], F.col("_value").cast(kind)).select(*columns)


def _uri(spark: SparkSession, folder: str) -> str:
    """A folder as Spark's file metadata spells it."""
    uri = spark._jvm.org.apache.hadoop.fs.Path(folder).toUri().toString()
    return re.sub("^file:/+", "/", uri)


KEPT_MANIFESTS = 10  # their numbers stay taken, for writers that are about to commit


def remove_unreferenced(spark: SparkSession, table: str, older_than_seconds: float = 7 * 86400) -> list[str]:
    """Delete staged folders and manifests that the version in force does not
    name and that are older than the given age (running jobs may still read
    or be writing younger ones). Returns what was deleted."""
    meta = _settled(spark, table)
    body = mf.read_manifest(spark, meta.home, meta.version)
    live = [p.rstrip("/") for p in [*body["parts"].values(), *[body["profile"]] * bool(body["profile"])]]
    gone = []
    for kind in ("_staged", "_snapshots", "_partitions", "_batches"):
        for name in mf.children(spark, f"{meta.home}/{kind}"):
            folder = f"{meta.home}/{kind}/{name}"
            used = any(p == folder or p.startswith(f"{folder}/") for p in live)
            if not used and mf.age_seconds(spark, folder) >= older_than_seconds:
                mf.remove(spark, folder)
                gone.append(folder)
    for name in mf.children(spark, f"{meta.home}/{mf.FOLDER}")[:-KEPT_MANIFESTS]:
        file = f"{meta.home}/{mf.FOLDER}/{name}"
        if mf.age_seconds(spark, file) >= older_than_seconds:
            mf.remove(spark, file)
            gone.append(file)
    return gone


def replace_partition(
    spark: SparkSession,
    table: str,
    frame: DataFrame,
    partition: str,
    partition_col: str = "partition",
) -> DataFrame:
    """Replace one partition with ``frame``; an empty frame empties it.

    Other partitions are untouched. Returns the staged frame.
    """
    path, staged = stage_partition(spark, table, frame, partition, partition_col)
    publish_partition(spark, table, partition, path, partition_col)
    return staged


# ---------------------------------------------------------------------- upsert


def _duplicate_matches(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> bool:
    """True when some target row is matched by more than one source row.

    The costly half (a semi join with the target) runs only when the source
    has repeated keys at all, which is the rare case.
    """
    repeated = (
        source.where(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1)
        .select(*keys)
    )
    if repeated.isEmpty():
        return False
    return not repeated.join(target.select(*keys), list(keys), "left_semi").isEmpty()


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    broadcast: bool | None = None,
) -> DataFrame:
    """Upsert as a relation: all source rows, plus target rows no source row
    matches on ``keys`` with ``=`` (NULL keys never match, so they insert).

    The source's (non-NULL) keys are broadcast when their measured size fits
    (``broadcast=None``): the target is then streamed once, map-side, with no
    shuffle. Larger key sets are joined by shuffle.
    """
    key_side = _key_side(source, keys, broadcast)
    kept = target.join(key_side, _key_match(target, key_side, keys), "left_anti")
    return source.unionByName(kept)


def _key_side(source: DataFrame, keys: Sequence[str], broadcast: bool | None) -> DataFrame:
    """The source's non-NULL keys (NULL keys never match), maybe broadcast."""
    not_null = F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    return small_side(source.where(not_null).select(*[F.col(k).alias(f"_u_{k}") for k in keys]), broadcast)


def _key_match(target: DataFrame, key_side: DataFrame, keys: Sequence[str]):
    cond = None
    for k in keys:
        c = target[k] == key_side[f"_u_{k}"]
        cond = c if cond is None else cond & c
    return cond


def stage_snapshot(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    keys: Sequence[str],
    *,
    check_duplicates: bool = True,
    materialize_source: bool = True,
    transform=None,
    sort_within: Sequence[str] = (),
) -> Staged:
    """Write the table's next version (target upserted with ``source``).

    The whole table is rewritten into a new folder. ``source`` is written
    once first (when it is a computed plan), so the duplicate check and the
    snapshot do not compute it twice; the size of its keys is observed by
    that write and decides whether they are broadcast. The snapshot's own
    size profile is observed by its write and returned.
    """
    if not keys:
        raise ValueError("upsert needs key columns")
    meta = _settled(spark, table)
    if meta.partition_cols:
        raise ValueError(f"{table} is partitioned: use stage_upsert")
    fields = meta.fields
    target = spark.table(table)
    src, broadcast_keys = _prepare_source(spark, table, meta, source, keys, materialize_source, check_duplicates)
    path = meta.staging_path("snapshots")
    snapshot = merge_rows(target, src, keys, broadcast_keys)
    if sort_within:
        snapshot = snapshot.sortWithinPartitions(*sort_within)
    snapshot, profile = observe_profile(snapshot)
    (transform(snapshot) if transform else snapshot).write.mode("errorifexists").parquet(path)
    return Staged(path, spark.read.schema(StructType(fields)).parquet(path), profile(), None, meta.version)


def _prepare_source(spark, table, meta, source, keys, materialize_source, check_duplicates):
    """Conform the source, write it once (observing its size), check keys."""
    src = conform(source, meta.fields)
    broadcast_keys = None
    if materialize_source:
        observed, src_profile = observe_profile(src)
        src = materialize(observed, meta.staging_path("batches"))
        broadcast_keys = src_profile().fits(src, keys)
    if check_duplicates and _duplicate_matches(src, spark.table(table), keys):
        raise DuplicateKeyError(
            f"upsert into {table}: a target row is matched by several source rows on {list(keys)}"
        )
    return src, broadcast_keys


def stage_partitions(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    keys: Sequence[str],
    *,
    check_duplicates: bool = True,
    materialize_source: bool = True,
    transform=None,
    sort_within: Sequence[str] = (),
    profile: PartProfiles | None = None,
) -> Staged:
    """Upsert into a partitioned table, rewriting only the partitions it touches.

    Touched partitions are those holding a target row matched on ``keys``
    and those the source rows go to. One pass finds them: the source keys
    with their repeat counts are joined to the target's key and partition
    columns (broadcast when their observed size fits), which also tells
    whether a target row is matched by several source rows. In a bucketed table
    that pass opens the buckets of the source's keys only. The new content
    of the touched partitions - their unmatched target rows plus the source
    rows - is written in one job with ``partitionBy``; every other partition
    stays as it is, files and all. Touched partitions are metadata (at
    most one per partition of the table), so they are collected.

    ``profile``: which columns to profile per partition. Only the files just
    written are read for it; the profiles of the other partitions come with the
    version before.
    """
    if not keys:
        raise ValueError("upsert needs key columns")
    meta = _settled(spark, table)
    if len(meta.partition_cols) != (2 if meta.buckets else 1):
        raise ValueError(f"{table} must be partitioned by exactly one column, or by {BUCKET} and one more")
    if meta.buckets and list(keys) != meta.bucket_keys:
        raise ValueError(f"{table} is bucketed by {meta.bucket_keys}, not by {list(keys)}")
    pcol = meta.partition_cols[-1]
    src = conform(source, [f for f in meta.fields if f.name != BUCKET])
    if meta.buckets:
        src = _with_bucket(src, meta)
    src_parts = _ObservedValues(src, meta.part(), pcol)
    src = src_parts.frame
    fits = None
    if materialize_source:
        observed, src_profile = observe_profile(src)
        src = materialize(observed, meta.staging_path("batches"))
        fits = src_profile().fits(src, [*keys, "_n"])
    else:
        src.write.format("noop").mode("overwrite").save()
    received = src_parts.values()
    if src_parts.has_null():
        raise ValueError(f"source rows need a non-empty {pcol!r}")

    target = searched(spark, table, meta, received)
    not_null = F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    per_key = small_side(
        src.where(not_null)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*[F.col(k).alias(f"_u_{k}") for k in keys], "_n"),
        fits,
    )
    hits = (
        target.select(*keys, *meta.partition_cols)
        .join(per_key, _key_match(target, per_key, keys))
        .agg(F.collect_set(meta.part()).alias("parts"), F.max("_n").alias("max_n"))
        .first()
    )
    if check_duplicates and (hits["max_n"] or 0) > 1:
        raise DuplicateKeyError(
            f"upsert into {table}: a target row is matched by several source rows on {list(keys)}"
        )
    touched = sorted(set(hits["parts"] or []) | received)
    known = None
    if profile is not None:
        before = mf.read_manifest(spark, meta.home, meta.version)["profile"]
        known = profile.load(mf.read_text(spark, before)) if before else None
    if not touched:
        return Staged(None, spark.table(table), known and known.total(), (), meta.version, known)

    key_side = _key_side(src, keys, fits)
    kept = target.where(meta.part().isin(touched))
    kept = kept.join(key_side, _key_match(kept, key_side, keys), "left_anti")
    rows = src.unionByName(kept)
    if meta.buckets or not fits:
        # Every task would hold rows of every touched partition (tasks x
        # partitions files). Rebalance by the partition columns first: AQE sizes
        # the write tasks and splits a hot partition.
        rows = rows.hint("rebalance", *meta.partition_cols)
    if sort_within:
        rows = rows.sortWithinPartitions(*meta.partition_cols, *sort_within)
    written = _ObservedValues(rows, meta.part(), pcol)
    rows = transform(written.frame) if transform else written.frame
    path = meta.staging_path("partitions")
    rows.write.mode("errorifexists").partitionBy(*meta.partition_cols).parquet(path)
    filled = written.values()
    new_rows = spark.read.schema(StructType(meta.fields)).parquet(path)
    rest = spark.table(table).where(~meta.part().isin(touched))
    if profile is not None:
        kept_parts = known.without(touched) if known else profile_parts(rest, meta.part(), profile)
        known = kept_parts.merged(profile_parts(new_rows, meta.part(), profile))
    order = sorted(touched, key=lambda p: (p not in filled, p not in received, p))
    return Staged(path, rest.unionByName(new_rows), known and known.total(), tuple((p, p in filled) for p in order), meta.version, known)


def searched(spark: SparkSession, table: str, meta: _Meta, received: set[str]) -> DataFrame:
    """The part of the table that rows matching the source can be in."""
    if not meta.buckets:
        return spark.table(table)
    return spark.table(table).where(F.col(BUCKET).isin(sorted({int(p.split("/", 1)[0]) for p in received})))


class _ObservedValues:
    """Observe the distinct partition keys of a frame while it is written
    (bounded: they are partitions)."""

    def __init__(self, frame: DataFrame, part: Column, column: str):
        from pyspark.sql import Observation

        self._obs = Observation(f"parts_{uuid.uuid4().hex[:8]}")
        value = F.col(column).cast("string")
        # an empty partition value cannot be told from NULL in a folder name
        self.frame = frame.observe(
            self._obs,
            F.collect_set(F.when(value != "", part)).alias("_v"),
            F.count_if(value.isNull() | (value == "")).alias("_nulls"),
        )

    def has_null(self) -> bool:
        return bool(self._obs.get["_nulls"])

    def values(self) -> set:
        return set(self._obs.get["_v"] or [])


def stage_upsert(spark: SparkSession, table: str, source: DataFrame, keys: Sequence[str], **kw) -> Staged:
    """Stage an upsert: partitioned tables rewrite touched partitions,
    unpartitioned tables get a whole new version."""
    if partition_columns(spark, table):
        return stage_partitions(spark, table, source, keys, **kw)
    kw.pop("profile", None)  # a whole new version is profiled by its write
    return stage_snapshot(spark, table, source, keys, **kw)


def upsert_change(spark: SparkSession, table: str, staged: Staged) -> Change | None:
    """The change that a staged upsert makes; None if there is nothing to do."""
    if staged.parts == ():
        return None
    profile = None
    if staged.parts_profile is not None:
        profile = f"{staged.path}/_profile.json"
        mf.write_text(spark, profile, staged.parts_profile.dump())
    if staged.parts is None:
        return Change(table, [("", staged.path)], [], profile, staged.base)
    meta = _settled(spark, table)
    changed = [(part, f"{staged.path}/{meta.folder(part)}" if has_rows else None) for part, has_rows in staged.parts]
    return Change(table, changed, [], profile, staged.base)


def publish_upsert(spark: SparkSession, table: str, staged: Staged) -> None:
    """Publish a staged upsert: one location swap, or the catalog calls of the
    touched partitions (a partition left without rows is dropped)."""
    change = upsert_change(spark, table, staged)
    if change is None:
        if _settled(spark, table).version != staged.base:
            raise ConflictError(f"{table} was published by another writer after this upsert was staged")
        return
    commit(spark, change)
    _settled(spark, table)


def upsert(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    keys: Sequence[str],
    **kw,
) -> Staged:
    """Update matched rows (all columns), insert the others; returns the
    published version (its ``frame`` reads the published files)."""
    staged = stage_upsert(spark, table, source, keys, **kw)
    publish_upsert(spark, table, staged)
    return staged
