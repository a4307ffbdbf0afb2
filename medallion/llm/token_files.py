"""Token ids as flat binary files with 64-bit document offsets.

Documents are range-partitioned and sorted by doc_id; each task writes one
part: ``.bin`` (unsigned ids, 16 or 32 bits each, whichever holds the
vocabulary, little-endian), ``.idx`` (signed 64-bit offsets into the part, one
more than it has documents) and ``.doc`` (an Arrow file of the doc_ids). The
manifest has a row per part, and the base of each part is the prefix sum of the
id counts before it, so any document's global start is base plus offset.
Reading maps the files into memory.

A task attempt writes files of its own and only the rows of attempts that
succeed reach the manifest, so a retried task leaves no half part behind.

Defined results: a null or empty text is the end id alone; null doc_ids come
first; rows with equal doc_id are ordered by their text's hash; an empty table gives
no parts and an empty result; extra columns are not read.
"""

from __future__ import annotations

import sys
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medallion.llm.common import table
from medallion.llm.encoding import shared_encoder
from medallion.session import scratch_path

MANIFEST_SCHEMA = "part int, name string, n_docs long, n_ids long"
END_ID = 2


def width(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder given by path or URI."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def _write(tokenizer_path: str, folder: str, dtype: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer_path, dtype)
        end, item = np.array([end_id], dtype).tobytes(), np.dtype(dtype).itemsize
        store, base = open_folder(folder)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        out = docs = None
        lengths: list[np.ndarray] = []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if out is None:
                store.create_dir(base, recursive=True)
                out = store.open_output_stream(f"{base}/{name}.bin")
                sink = store.open_output_stream(f"{base}/{name}.doc")
                docs = pa.ipc.new_file(sink, pa.schema([("doc_id", pa.int64())]))
            sizes = []
            for text in batch.column("text"):
                ids = b"".join(encoder.values(text.as_py())) + end
                out.write(ids)
                sizes.append(len(ids) // item)
            lengths.append(np.array(sizes, "<i8"))
            docs.write_batch(pa.RecordBatch.from_arrays([batch.column("doc_id")], ["doc_id"]))
        if out is None:
            return
        out.close()
        docs.close()
        sink.close()
        offsets = np.concatenate([np.zeros(1, "<i8"), np.cumsum(np.concatenate(lengths), dtype="<i8")])
        with store.open_output_stream(f"{base}/{name}.idx") as f:
            f.write(offsets.tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([name]), pa.array([len(offsets) - 1]), pa.array([int(offsets[-1])])],
            ["part", "name", "n_docs", "n_ids"],
        )

    return run


def write_ids(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Write the ids of all documents to ``folder``; returns the manifest
    (part, name, n_docs, n_ids, base), which is kept there as a table too."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    dtype = width(max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), end_id + 1))
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    )
    parts = ordered.mapInArrow(_write(tokenizer_path, folder, dtype, end_id), MANIFEST_SCHEMA)
    parts.write.parquet(f"{folder}/parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    manifest = (
        spark.read.schema(MANIFEST_SCHEMA).parquet(f"{folder}/parts")
        .withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
        .withColumn("dtype", F.lit(dtype))
    )
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def mapped(store: fs.FileSystem, path: str) -> pa.Buffer:
    """A file's bytes: memory-mapped on a local or mounted store, else read."""
    if isinstance(store, fs.LocalFileSystem):
        with pa.memory_map(path) as f:
            return f.read_buffer()
    with store.open_input_file(path) as f:
        return f.read_buffer()


class Part:
    """One part read back: ``doc_ids``, ``offsets`` and ``ids`` (all mapped)."""

    def __init__(self, folder: str, name: str, dtype: str):
        store, base = open_folder(folder)
        self.ids = np.frombuffer(mapped(store, f"{base}/{name}.bin"), dtype)
        self.offsets = np.frombuffer(mapped(store, f"{base}/{name}.idx"), "<i8")
        with pa.ipc.open_file(mapped(store, f"{base}/{name}.doc")) as f:
            self.doc_ids = f.read_all().column("doc_id").combine_chunks()

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.offsets[i] : self.offsets[i + 1]]


def read_index(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                part = Part(folder, row["name"], row["dtype"])
                n = len(part.offsets) - 1
                for lo in range(0, n, 4096):
                    hi = min(n, lo + 4096)
                    crcs = [zlib.crc32(part.document(i).astype("<u4").tobytes()) for i in range(lo, hi)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.doc_ids.slice(lo, hi - lo),
                            pa.array(part.offsets[lo:hi] + row["base"]),
                            pa.array(np.diff(part.offsets[lo : hi + 1])),
                            pa.array(crcs, pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    if sys.byteorder != "little":
        raise RuntimeError("the files are little-endian")
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(n).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_read(docs: DataFrame, tokenizer_path: str, folder: str) -> DataFrame:
    return read_index(write_ids(docs, tokenizer_path, folder), folder)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return write_and_read(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("word_bpe_49k.json"),
        scratch_path(spark, "llm", "token_files"),
    )
