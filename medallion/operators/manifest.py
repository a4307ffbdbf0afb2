"""Published versions of a table, as small files beside its data.

Plain Parquet tables keep the folder of each partition in the catalog alone, so
dropping a table would lose sight of its data, and a publish of several
partitions that stops halfway would leave no trace of what was meant. Each
publish therefore first creates a manifest under the table's home folder: its
number, and the folder of every partition as it will be. The manifest of the
highest number is the version in force; the catalog follows it. A number is
given once: creating its file fails for every writer but the first. A manifest
has one line per partition; it holds no data and replaces no table format.
"""

from __future__ import annotations

import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

FOLDER = "_manifests"
# Schemes whose rename refuses a name that is taken.
RENAMES_ONCE = ("hdfs", "viewfs", "webhdfs")


def _at(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def _write(fs, where, text: str, overwrite: bool) -> None:
    out = fs.create(where, overwrite)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file."""
    _write(*_at(spark, path), text, True)


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file, whole or not at all; False if the name is taken.

    Whichever step the store makes atomic decides: a hard link on a local or
    mounted disk and a rename on HDFS, both of a finished file, and elsewhere
    (object stores, where a file appears when it is closed) a create that does
    not overwrite."""
    fs, where = _at(spark, path)
    scheme = fs.getUri().getScheme()
    try:
        if scheme != "file" and scheme not in RENAMES_ONCE:
            _write(fs, where, text, False)
            return True
        temporary = _at(spark, f"{path}.{uuid.uuid4().hex}.tmp")[1]
        _write(fs, temporary, text, False)
        try:
            if scheme in RENAMES_ONCE:
                return bool(fs.rename(temporary, where))
            paths = [spark._jvm.java.io.File(p.toUri().getPath()).toPath() for p in (where, temporary)]
            spark._jvm.java.nio.file.Files.createLink(*paths)
            return True
        finally:
            fs.delete(temporary, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder ([] if there is none)."""
    fs, where = _at(spark, path)
    if not fs.exists(where):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(where))


def age_seconds(spark: SparkSession, path: str) -> float:
    import time

    fs, where = _at(spark, path)
    return time.time() - fs.getFileStatus(where).getModificationTime() / 1000


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def next_name(version: str | None) -> str:
    return f"{(int(version) if version else 0) + 1:09d}"


def create_manifest(
    spark: SparkSession, home: str, base: str | None, parts: dict[str, str], changed: list, empty: list[str],
    profile: str | None = None, intent: str | None = None,
) -> str | None:
    """Create the manifest that follows ``base`` and return its name; None if
    another writer was first. ``parts``: folder by partition key ('' for an
    unpartitioned table). ``changed``: (key, folder or None) in the order of the
    catalog calls. ``empty``: keys of partitions without rows. ``profile``: the
    file of the version's size profile, if it has one. ``intent``: the layer
    publish it is part of, if it is."""
    name = next_name(base)
    body = {"name": name, "base": base, "parts": parts, "changed": changed, "empty": sorted(empty), "profile": profile, "intent": intent}
    return name if create_text(spark, f"{home}/{FOLDER}/{name}.json", json.dumps(body)) else None


def read_manifest(spark: SparkSession, home: str, name: str | None) -> dict:
    """The manifest, or an empty one before the first publish."""
    if not name:
        return {"name": None, "base": None, "parts": {}, "changed": [], "empty": [], "profile": None}
    return json.loads(read_text(spark, f"{home}/{FOLDER}/{name}.json"))


def versions(spark: SparkSession, home: str) -> list[str]:
    """Names of the manifests there are, oldest first (numbers are zero-padded)."""
    return [n[:-5] for n in children(spark, f"{home}/{FOLDER}") if re.fullmatch(r"\d{9}\.json", n)]


def newest(spark: SparkSession, home: str) -> str | None:
    return max(versions(spark, home), default=None)
