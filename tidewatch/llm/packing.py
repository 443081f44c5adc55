"""Best-fit packing by minimum bin slack.

A bin is filled with the combination of available lengths that leaves the least
slack: a subset-sum dynamic program over bitsets finds the fullest sum that the
remaining lengths can reach, starting from the largest one, and the combination
is removed.  Lengths are integers up to the capacity, so all that the program
needs of a corpus is how many pieces there are of each length: the driver holds
that histogram (``capacity`` counts at any corpus size).  A combination is taken
as many times as its counts allow, which uses up a length, so a plan has about
as many distinct combinations as lengths.

The plan is then a small table of slot ranges for each length (bounded by the
capacity, broadcast).  Pieces are ranked within their length without a funnel:
the tokenising pass numbers them inside its partition and one small table of
(partition, length) counts gives the offsets.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import materialise, ready, slices
from tidewatch.llm.token_ids import encoder

CAPACITY = 1024
END_ID = 2


def fullest(counts: np.ndarray, capacity: int, seed: int) -> dict[int, int]:
    """The multiset of available lengths with ``seed`` in it whose sum is the
    largest at most ``capacity``: {length: times}."""
    room = capacity - seed
    reach = 1
    mask = (1 << (room + 1)) - 1
    trail: list[tuple[int, int]] = []          # (length, sums reachable before one more of it)
    full = 1 << room
    for length in range(min(room, len(counts) - 1), 0, -1):
        have = int(counts[length]) - (length == seed)
        for _ in range(min(have, room // length)):
            more = (reach | reach << length) & mask
            if more == reach:
                break
            trail.append((length, reach))
            reach = more
        if reach & full:
            break
    total = reach.bit_length() - 1
    chosen = {seed: 1}
    for length, before in reversed(trail):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + 1
            total -= length
    return chosen


def plan_bins(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """[(combination, how many bins hold it)] that together use every piece."""
    counts = counts.astype(np.int64).copy()
    plan = []
    for seed in range(len(counts) - 1, 0, -1):
        while counts[seed]:
            chosen = fullest(counts, capacity, seed)
            times = min(int(counts[length]) // n for length, n in chosen.items())
            for length, n in chosen.items():
                counts[length] -= n * times
            plan.append((chosen, times))
    return plan


def slot_table(plan: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, past rank, per bin, first sequence, offset): the
    piece of that length with rank r is number (r - first) of the range."""
    rows, used, sequence = [], {}, 0
    for chosen, times in plan:
        offset = 0
        for length in sorted(chosen, reverse=True):
            first = used.get(length, 0)
            used[length] = first + chosen[length] * times
            rows.append((length, first, used[length], chosen[length], sequence, offset))
            offset += length * chosen[length]
        sequence += times
    return rows


def pieces_of(ids: bytes, capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's little-endian 32-bit ids;
    a long document's first piece takes what full pieces leave over."""
    n = len(ids) // 4
    k = -(-n // capacity)
    start = 0
    for piece in range(k):
        length = n - capacity * (k - 1) if piece == 0 else capacity
        yield piece, start, length, zlib.crc32(ids[4 * start:4 * (start + length)])
        start += length


def _tokenise(make: Callable[[], Callable[[list[str]], list[bytes]]], capacity: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode = make()
        seen = np.zeros(capacity + 1, np.int64)
        for whole in batches:
            for batch in slices(whole, "text", 4 << 20):
                texts = batch.column(1).fill_null("").to_pylist()
                rows: list[tuple] = []
                at: list[int] = []
                held: list[bytes] = []
                for i, ids in enumerate(encode(texts)):
                    for piece, start, length, crc in pieces_of(ids, capacity):
                        at.append(i)
                        rows.append((piece, start, length, crc, int(seen[length])))
                        seen[length] += 1
                        if keep_ids:
                            held.append(ids[4 * start:4 * (start + length)])
                if not rows:
                    continue
                piece, start, length, crc, rank = zip(*rows)
                columns = [batch.column(0).take(pa.array(at)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                           pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                           pa.array([part] * len(rows), pa.int32()), pa.array(rank, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"]
                if keep_ids:
                    columns.append(pa.array(held, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """Cut documents into pieces of at most ``capacity`` token ids and pack them
    into as few sequences as minimum bin slack finds.

    ``tokenizer`` names a vocabulary file (readable on every executor); each
    document is its ids and ``end_id``.  Columns: ``doc_id``, ``piece``,
    ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``, and with
    ``keep_ids`` the piece's ids as little-endian unsigned 32-bit ``ids``.

    Defined cases: a null text is empty, and an empty text is one piece of
    ``end_id`` alone; rows with a null id and repeated rows are packed like any
    other; an empty table gives an empty result; other columns are ignored.
    """
    spark = ready(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    fields = [T.StructField("doc_id", source.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType()),
              T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
              T.StructField("ids_crc32", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("rank", T.LongType())]
    if keep_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    cut = materialise(spark, source.mapInArrow(
        _tokenise(encoder(tokenizer, end_id), capacity, keep_ids), T.StructType(fields)), "pieces")
    return place(spark, cut, capacity)


def place(spark: SparkSession, cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give pieces (``length``, and ``rank`` within (``part``, ``length``)) their
    sequence and offset."""
    sizes = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))

    counts = np.zeros(capacity + 1, np.int64)
    for length, n in sizes.groupBy("length").agg(F.sum("n")).collect():     # at most ``capacity`` rows
        counts[length] = n
    slots = slot_table(plan_bins(counts, capacity))
    table = spark.createDataFrame(slots, "length long, first long, past long, per_bin long, sequence long, at long")
    # one row per (length, ranges): a piece finds its range by position in sorted arrays
    ranges = table.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("first", "past", "per_bin", "sequence", "at"))).alias("ranges"))
    ranked = cut.join(offsets, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("ahead"))
    # bounded: a plan has at most about ``capacity`` combinations of at most sqrt(2 * capacity) lengths each
    placed = ranked.join(F.broadcast(ranges), "length").withColumn(
        "slot", F.filter("ranges", lambda r: (r["first"] <= F.col("rank")) & (F.col("rank") < r["past"]))[0])
    nth = F.col("rank") - F.col("slot.first")
    extra = ["ids"] if "ids" in cut.columns else []
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("slot.sequence") + F.floor(nth / F.col("slot.per_bin"))).cast("long").alias("sequence_id"),
        (F.col("slot.at") + (nth % F.col("slot.per_bin")) * F.col("length")).cast("long").alias("offset"), *extra)
