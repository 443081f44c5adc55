"""Exact duplicates by deterministic block naming.

Each text, without the characters ``[\\x20\\x09-\\x0D]``, is cut into blocks of
a fixed size.  Blocks are sorted and equal ones get one integer name; then the
names of adjacent blocks are paired and the pairs named in the same way, until
every document has one name.  Names come from comparing whole blocks and whole
pairs, never from a hash, so two documents share a name exactly if their
normalised texts are equal.

Sorting at scale: rows are range-partitioned on (hash of the block, row key,
position, row number), which spreads a block that a third of all rows share over a
third of the partitions, copies of one row included, then sorted by (hash, block) inside each partition and named by
one pass in order.  Only the first and last hash of a partition can have blocks
that go on in a neighbour; a table of at most a few rows per partition joins
their names.  The text passes one shuffle; each pairing level moves 16 bytes a
block and halves their number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import FILE_ROWS, dealt_anew, in_few_files, materialise, ready, row_keys, shuffle_partitions

#: Bytes that equality ignores.
IGNORED = b"\x20\x09\x0a\x0b\x0c\x0d"
BLOCK_BYTES = 4096
#: A name is partition * 2**40 + rank in the partition.
_RANK_BITS = 40
#: Copies of one row that a task writes out.
COPIES = 1 << 16


def _cut(block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            keys = list(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()))
            rows: list[tuple] = []
            size = 0

            def flush() -> pa.RecordBatch:
                at, pos, n, points, sha, block = zip(*rows)
                return pa.RecordBatch.from_arrays(
                    [pa.array([keys[i][0] for i in at], pa.int64()), pa.array([keys[i][1] for i in at], pa.int64()),
                     ids.take(pa.array(at)), pa.array(pos, pa.int32()),
                     pa.array(n, pa.int32()), pa.array(points, pa.int64()), pa.array(sha, pa.string()),
                     pa.array(block, pa.binary())],
                    names=["key_a", "key_b", "doc_id", "pos", "n_blocks", "n_points", "text_sha256", "block"])

            for at in range(batch.num_rows):
                text = texts[at].as_py()
                body = (text or "").encode().translate(None, IGNORED)
                n = max(1, -(-len(body) // block_bytes))
                sha = hashlib.sha256(body).hexdigest()
                for pos in range(n):
                    block = body[pos * block_bytes:(pos + 1) * block_bytes]
                    rows.append((at, pos, n, len(text or ""), sha if pos == 0 else None, block))
                    size += len(block) + 100
                    if size > 8 << 20:
                        yield flush()
                        rows.clear()
                        size = 0
            if rows:
                yield flush()
    return run


def _name_in_order(carried: list[str]):
    """Name sorted blocks of a partition; also report the distinct blocks of its
    first and last hash, whose names a neighbour may share."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        rank, last_block, first_hash, last_hash = -1, None, None, None
        tail: list[tuple[int, bytes]] = []
        fields = None

        def edges(found: list[tuple[int, bytes]]) -> pa.RecordBatch:
            names = pa.array([(part << _RANK_BITS) | r for r, _ in found], pa.int64())
            blocks = pa.array([b for _, b in found], pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.nulls(len(found), f.type) for f in fields] + [names, blocks],
                names=[f.name for f in fields] + ["name", "edge"])

        for batch in batches:
            if batch.num_rows == 0:
                continue
            fields = [batch.schema.field(c) for c in carried]
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            block = column["__block"]
            h = column["__hash"].to_numpy(zero_copy_only=False)
            new = np.ones(batch.num_rows, bool)
            if batch.num_rows > 1:
                new[1:] = pc.not_equal(block.slice(1), block.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
            new[0] = rank < 0 or block[0].as_py() != last_block
            ranks = rank + np.cumsum(new)
            if first_hash is None:
                first_hash = last_hash = h[0]
            heads = np.flatnonzero(new & (h == first_hash))
            if len(heads):
                yield edges([(int(ranks[i]), block[int(i)].as_py()) for i in heads])
            if h[-1] != last_hash:
                tail, last_hash = [], h[-1]
            if last_hash != first_hash:
                tail += [(int(ranks[i]), block[int(i)].as_py()) for i in np.flatnonzero(new & (h == last_hash))]
            rank, last_block = int(ranks[-1]), block[batch.num_rows - 1].as_py()
            yield pa.RecordBatch.from_arrays(
                [column[c] for c in carried]
                + [pa.array((part << _RANK_BITS) | ranks, pa.int64()), pa.nulls(batch.num_rows, pa.binary())],
                names=carried + ["name", "edge"])
        if tail:
            yield edges(tail)
    return run


def name_by_sorting(spark: SparkSession, rows: DataFrame, block: str, spread: list[str], label: str) -> DataFrame:
    """Add ``name``: an integer that rows share exactly if their ``block`` is equal.

    ``spread`` are columns that tell rows of one block apart, so that a hot
    block spans partitions; a row number does so where even they are equal.  The result is written (and read) below the shared
    checkpoint folder.
    """
    carried = [c for c in rows.columns if c != block]
    out = T.StructType([rows.schema[c] for c in carried] + [T.StructField("name", T.LongType()), T.StructField("edge", T.BinaryType())])
    out = T.StructType([T.StructField(f.name, f.dataType, True) for f in out])
    dealt = (
        rows.select(*carried, F.col(block).alias("__block"), F.xxhash64(block).alias("__hash"), F.monotonically_increasing_id().alias("__turn"))
        .repartitionByRange(shuffle_partitions(spark), "__hash", *spread, "__turn")
        .sortWithinPartitions("__hash", "__block")
    )
    named = materialise(spark, dealt.mapInArrow(_name_in_order(carried), out), label)
    # at most a few rows per partition: one for each distinct block of its first and last hash
    edges = named.where(F.col("edge").isNotNull()).select("name", "edge")
    joined = (
        edges.join(edges.groupBy("edge").agg(F.min("name").alias("__shared")), "edge")
        .where("name <> __shared").select("name", "__shared")
    )
    return (
        named.where(F.col("edge").isNull()).drop("edge")
        .join(F.broadcast(joined), "name", "left")
        .withColumn("name", F.coalesce("__shared", "name")).drop("__shared")
    )


def _as_block(left: str, right: str) -> F.Column:
    def eight(c: str):
        return F.unhex(F.lpad(F.hex(F.col(c)), 16, "0"))
    return F.when(F.col(right).isNull(), eight(left)).otherwise(F.concat(eight(left), eight(right)))


def _copies(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Each row as often as its ``copies`` says, numbered by ``copy`` from 1; a row
    of many copies is dealt out to tasks in pieces first."""
    def numbered(first, last):
        return F.explode(F.sequence(first, last)).alias("copy")

    few = rows.where(F.col("copies") <= COPIES).select("*", numbered(F.lit(1).cast("long"), F.col("copies")))
    many = rows.where(F.col("copies") > COPIES).select(
        "*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"), F.lit(COPIES).cast("long"))).alias("__from"))
    dealt = many.repartition(shuffle_partitions(spark), "key_a", "__from")
    return few.unionByName(dealt.select(
        *rows.columns, numbered(F.col("__from"), F.least(F.col("copies"), F.col("__from") + COPIES - 1))))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Groups of equal texts, one row per input row.

    Columns: ``key_a`` and ``key_b`` (hashes of the row's id and text), ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.  Texts are equal
    when identical without the bytes of ``IGNORED``; of equal texts the row
    with the most code points, then the smallest id (null last), stays.

    Defined cases: a null text counts as empty, and empty texts equal one
    another; a repeated row (same id and text) is returned as often as it
    occurs, counts each time in ``group_size``, and at most one copy is kept;
    an empty table gives an empty result; other columns are ignored, whatever
    their names.
    """
    spark = ready(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    source = source.select("doc_id", "text", *row_keys("doc_id", "text"))
    id_type = source.schema["doc_id"].dataType
    cut_schema = T.StructType([
        T.StructField("key_a", T.LongType()), T.StructField("key_b", T.LongType()), T.StructField("doc_id", id_type),
        T.StructField("pos", T.IntegerType()),
        T.StructField("n_blocks", T.IntegerType()), T.StructField("n_points", T.LongType()),
        T.StructField("text_sha256", T.StringType()), T.StructField("block", T.BinaryType())])
    blocks = source.mapInArrow(_cut(block_bytes), cut_schema)
    named = name_by_sorting(spark, blocks, "block", ["key_a", "pos"], "blocks")

    longest = named.agg(F.max("n_blocks")).first()[0] or 1
    level = named.where("n_blocks > 1").select("key_a", "key_b", "pos", F.col("n_blocks").alias("left_over"), "name")
    done = None
    while longest > 1:
        pairs = (
            level.groupBy("key_a", "key_b", F.shiftright("pos", 1).alias("pos"))
            .agg(F.max("left_over").alias("left_over"),
                 F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("__l"),
                 F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("__r"))
            .select("key_a", "key_b", "pos", F.shiftright(F.col("left_over") + 1, 1).alias("left_over"),
                    _as_block("__l", "__r").alias("block"))
        )
        level = name_by_sorting(spark, pairs, "block", ["key_a", "pos"], "pairs")
        ended = level.where("left_over = 1").select("key_a", "key_b", F.col("name").alias("__top"))
        done = ended if done is None else done.unionByName(ended)
        level = level.where("left_over > 1")
        longest = (longest + 1) // 2

    rows = (
        named.where("pos = 0").groupBy("key_a", "key_b", "n_blocks", "n_points", "text_sha256", "name")
        .agg(F.first("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))
    )
    if done is not None:
        rows = rows.join(done, ["key_a", "key_b"], "left").withColumn("name", F.coalesce("__top", "name")).drop("__top")
    # n_blocks fixes the level at which a name was given, so (n_blocks, name) is the identity
    rows = materialise(spark, in_few_files(rows, named.where("pos = 0").count(), FILE_ROWS), "named-rows")
    mine = F.struct((-F.col("n_points")).alias("p"), F.col("doc_id").isNull().alias("z"), "doc_id", "key_a", "key_b")
    best = rows.groupBy("n_blocks", "name").agg(F.min(mine).alias("best"), F.sum("copies").alias("size"), F.count(F.lit(1)).alias("n"))
    best = dealt_anew(best.where("n > 1").drop("n"))            # groups of several rows only
    return (
        _copies(spark, rows).join(best, ["n_blocks", "name"], "left")
        .withColumn("best", F.coalesce("best", mine))
        .select("key_a", "key_b", "doc_id", F.col("best.doc_id").alias("keep_id"), F.coalesce("size", "copies").alias("group_size"),
                ((F.col("key_a") == F.col("best.key_a")) & (F.col("key_b") == F.col("best.key_b")) & (F.col("copy") == 1)).alias("kept"), "text_sha256")
    )
