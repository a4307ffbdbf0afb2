"""Merkle manifest of a dataset by time-forward processing.

A row's *leaf* is the sha256 of its fields, each written as its UTF-8 byte count,
a colon and its value ('-' if null). Per source the leaves ascend by doc_id and
every ``FANOUT`` consecutive nodes become the hash of their digests, until one
node, the *subroot*, is left; the subroots, ordered by source, give the *root*
in the same way. A row's *proof* lists, level by level up to the root, the
digests left and right of its node in the run it is hashed with.

The nodes of a tree are labelled (level, index), children before parents. A
node's digest is a message to its parent's label; a priority queue ordered by
label delivers it.

* **Forward sweep.** A *block* is ``HEIGHT`` levels above ``FANOUT ** HEIGHT``
  consecutive nodes. Inside a block the queue is a heap; between blocks it is
  Spark's sorted shuffle, which spills to disk: the top of a block is a message
  to the block above. A round of blocks is one job, and each has
  ``FANOUT ** HEIGHT`` times fewer nodes than the one below, so a tree of 10^12
  leaves takes five.
* **Reversed sweep.** From the root down, each node sends its children the proof
  suffix that they share, by the same queue in descending order of labels. Leaves
  get whole proofs.

Texts are hashed where they are read and never shuffled. A task holds one block
at a time; a source that holds a third of all rows is many blocks. Positions
come from a range sort and prefix sums over its partitions.

Defined results: null fields hash as '-', so null and empty differ; rows without
source are a source of their own, the first; rows without doc_id come first in
their source; rows of equal doc_id are ordered by leaf digest; repeated rows are
leaves of their own; a dataset of one row has an empty proof; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medallion.llm.common import table, written

FANOUT = 3
HEIGHT = 6
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


# ---------------------------------------------------------------- in one block


def height_of(n: int) -> int:
    """Levels above ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def sweep_up(digests: list[str], height: int) -> list[list[str]]:
    """The digests of each level of a block, its leaves first."""
    levels: list[list[str]] = [digests, *[[] for _ in range(height)]]
    queue = [(1, k // FANOUT, k, d) for k, d in enumerate(digests)]  # sorted, so a heap
    while queue and queue[0][0] <= height:
        level, index = queue[0][:2]
        run = []
        while queue and queue[0][:2] == (level, index):
            run.append(heappop(queue)[3])
        digest = sha256("".join(run).encode()).hexdigest()
        levels[level].append(digest)
        heappush(queue, (level + 1, index // FANOUT, index, digest))
    return levels


def sweep_down(levels: list[list[str]], suffix: str) -> list[str]:
    """The proofs of a block's leaves, given that of its top: steps
    'left:right', joined by ';'."""
    queue = [(1 - len(levels), 0, suffix)]  # highest level first
    proofs = []
    while queue:
        level, index, suffix = heappop(queue)
        if level == 0:
            proofs.append(suffix)
            continue
        lo = index * FANOUT
        run = levels[-level - 1][lo : lo + FANOUT]
        for k in range(len(run)):
            step = f"{''.join(run[:k])}:{''.join(run[k + 1 :])}"
            heappush(queue, (level + 1, lo + k, f"{step};{suffix}" if suffix else step))
    return proofs


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each (tree, block) of a sorted stream."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (held[-1]["block"] != row["block"] or held[-1]["tree"] != row["tree"]):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _levels_in(n: int, done: int, height: int) -> int:
    """Levels that a block starting at level ``done`` of a tree of n leaves has."""
    return min(height, height_of(n) - done)


def _forward(done: int, height: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for rows in _runs(batches):
            n = rows[0]["n"]
            top = sweep_up([r["digest"] for r in rows], _levels_in(n, done, height))[-1][0]
            out.append((rows[0]["tree"], n, rows[0]["block"], top))
            if len(out) == 4096:
                yield _batch(out, NODE)
        yield _batch(out, NODE)

    return run


def _backward(done: int, height: int, carried: list[pa.Field]):
    schema = pa.schema([*PROOF, *carried])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for rows in _runs(batches):
            message, nodes = rows[0], rows[1:]
            levels = sweep_up([r["digest"] for r in nodes], _levels_in(message["n"], done, height))
            for row, proof in zip(nodes, sweep_down(levels, message["proof"])):
                out.append((row["tree"], row["n"], row["pos"], proof, message["subroot"], message["root"], *[row[f.name] for f in carried]))
            if len(out) >= 4096:
                yield _batch(out, schema)
        yield _batch(out, schema)

    return run


NODE = pa.schema([("tree", pa.string()), ("n", pa.int64()), ("pos", pa.int64()), ("digest", pa.string())])
PROOF = pa.schema([("tree", pa.string()), ("n", pa.int64()), ("pos", pa.int64()), ("proof", pa.string()),
                   ("subroot", pa.string()), ("root", pa.string())])
_SQL = {pa.string(): "string", pa.int64(): "long"}


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
    rows.clear()
    return batch


def _ddl(schema) -> str:
    return ", ".join(f"{f.name} {_SQL[f.type]}" for f in schema)


# ---------------------------------------------------------------------- sweeps


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with their position in their ``tree`` by ``order`` and the
    tree's number of rows, ``n``."""
    by = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    at = written(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()), "merkle_sorted")
    part = F.shiftright("_at", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    bases = at.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows")).withColumn(
        "_base", F.coalesce(F.sum("_rows").over(before), F.lit(0))).select("_part", "_base")
    at = at.withColumn("_part", part).join(F.broadcast(bases), "_part").withColumn(
        "_at", F.col("_base") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_part", "_base")
    trees = written(at.groupBy("tree").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("n")), "merkle_trees")
    return at.join(trees, "tree").withColumn("pos", F.col("_at") - F.col("_first")).drop("_at", "_first")


def _above(done: int) -> Column:
    """Trees that have a level above ``done``; all have blocks at level 0."""
    return F.col("n") > FANOUT ** done if done else F.lit(True)


def forward(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(rounds, tops): the nodes (tree, n, pos, digest) that each round of
    blocks starts from, and each tree's top (tree, n, digest)."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    rounds, tops, done = [leaves], None, 0
    while True:
        size = FANOUT ** HEIGHT
        blocks = rounds[-1].where(_above(done)).select("tree", "n", "pos", "digest", F.floor(F.col("pos") / size).alias("block"))
        blocks = blocks.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")
        nodes = written(blocks.mapInArrow(_forward(done, HEIGHT), _ddl(NODE)), "merkle_nodes")
        done += HEIGHT
        ended = nodes.where(~_above(done)).select("tree", "n", "digest")
        tops = ended if tops is None else tops.unionByName(ended)
        if most <= FANOUT ** done:
            return rounds, tops
        rounds.append(nodes)


def backward(rounds: list[DataFrame], tops: DataFrame, carried: list[str]) -> DataFrame:
    """(tree, n, pos, proof, subroot, root, and the ``carried`` columns) of every
    leaf; ``tops`` has (tree, n, proof, subroot, root) of every tree."""
    known = None
    for k in range(len(rounds) - 1, -1, -1):
        done = k * HEIGHT
        extra = carried if k == 0 else []
        fields = [pa.field(f.name, pa.int64() if f.dataType.simpleString() == "bigint" else pa.string())
                  for f in rounds[k].select(extra).schema]
        ending = tops.where(_above(done) & ~_above(done + HEIGHT)).withColumn("block", F.lit(0).cast("long"))
        messages = ending.select("tree", "n", "block", "proof", "subroot", "root")
        if known is not None:
            messages = messages.unionByName(known.select("tree", "n", F.col("pos").alias("block"), "proof", "subroot", "root"))
        nodes = rounds[k].where(_above(done)).select(
            "tree", "n", F.floor(F.col("pos") / FANOUT ** HEIGHT).alias("block"), "pos", *dict.fromkeys(["digest", *extra]))
        rows = messages.unionByName(nodes, allowMissingColumns=True)  # a message's pos is null: it comes first
        rows = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", F.col("pos").asc_nulls_first())
        known = rows.mapInArrow(_backward(done, HEIGHT, fields), _ddl([*PROOF, *fields]))
        if k:
            known = written(known, "merkle_proofs")
    return known


# -------------------------------------------------------------------- manifest


def leaf_digest(text: Column) -> Column:
    def field(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[field(text if c == "text" else F.col(c)) for c in FIELDS]), 256)


def manifest(docs: DataFrame, found: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, found) of every row; ``found`` is the
    leaf digest of the row with that text in place of its own (default: its own)."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.col("n_chars").cast("long").alias("n_chars"), "text")
    leaf = leaf_digest(F.col("text"))
    tree = F.when(F.col("source").isNull(), "0").otherwise(F.concat(F.lit("1"), "source"))
    # rows that are equal in all that is sorted are interchangeable; the salt spreads them
    rows = plain.select(tree.alias("tree"), "doc_id", leaf.alias("digest"), (leaf if found is None else found).alias("found"),
                        F.monotonically_increasing_id().alias("salt"))
    leaves = written(placed(written(rows, "merkle_leaves"), "doc_id", "digest", "salt").drop("salt"), "merkle_placed")
    rounds, subroots = forward(leaves)
    subroots = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("n").alias("size"), "digest")
    second, roots = forward(written(placed(subroots, "of"), "merkle_subroots"))
    top = roots.select("tree", "n", F.lit("").alias("proof"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    tops = backward(second, top, ["of", "size", "digest"]).select(
        F.col("of").alias("tree"), F.col("size").alias("n"), "proof", F.col("digest").alias("subroot"), "root")
    proofs = backward(rounds, written(tops, "merkle_tops"), ["doc_id", "digest", "found"])
    return proofs.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "proof", "found")


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf digest and a proof give."""
    def up(digest: Column, step: Column) -> Column:
        return F.sha2(F.concat(F.substring_index(step, ":", 1), digest, F.substring_index(step, ":", -1)), 256)

    return F.when(proof == "", leaf).otherwise(F.aggregate(F.split(proof, ";"), leaf, up))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("long").cast("string")) % 2 == 0
    tampered = F.when(hit, leaf_digest(F.replace("text", F.lit("\n"), F.lit("")))).otherwise(leaf_digest(F.col("text")))
    rows = manifest(docs, tampered)
    return rows.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(F.translate("proof", ":;", ""), 256).alias("proof_sha256"),
        fold(F.col("found"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
