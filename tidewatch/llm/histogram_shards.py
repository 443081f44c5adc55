"""Shards of near equal bytes by a histogram sort.

Rows are ordered by (hash of the text, hash of the row), so equal texts are
neighbours.  The driver holds candidate boundaries ("probes") of that order only:
every round, all partitions count the exact bytes below each probe, and the
brackets around the wanted byte positions shrink to the bins that hold them, until
a boundary lies within the tolerance.  Boundaries between different texts are
looked for first; a group of equal texts is cut, by row hashes, only where no
boundary beside it is near enough.  Then every row goes to its place in one
exchange, and numbers follow from the last, exact histogram.

Each shard is made of several pieces (as many as the session has shuffle
partitions, in all), so tasks are never as large as shards.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import materialise, ready, shuffle_partitions

#: A boundary may miss its byte position by this share of a shard, and of a piece
#: (or by half a row, where rows are larger).
SHARD_TOLERANCE, PIECE_TOLERANCE = 0.005, 0.25
#: Bytes counted for a row beside its text.
ROW_BYTES = 8
#: Probes of one round: about so many in all, and at least so many per position.
PROBES, LEAST_PROBES = 8192, 3
_LOW, _HIGH = -(1 << 63), 1 << 63

Key = tuple[int, int]


def bins(probes: tuple[np.ndarray, np.ndarray], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """How many probes are at or below each key (first, second)."""
    pa_, pb = probes
    low, high = np.searchsorted(pa_, first, side="left"), np.searchsorted(pa_, first, side="right")
    out = high.copy()
    tied = np.flatnonzero(high > low)
    for begin in np.unique(low[tied]):
        rows = tied[low[tied] == begin]
        end = high[rows[0]]
        out[rows] = begin + np.searchsorted(pb[begin:end], second[rows], side="right")
    return out


def _arrays(keys: list[Key]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([k[0] for k in keys], np.int64), np.array([k[1] for k in keys], np.int64)


def _count(keyed: DataFrame, probes: list[Key]) -> list[tuple]:
    """(bytes, rows, least and greatest first, least and greatest second) of every
    bin between probes; partial sums are made inside the tasks."""
    arrays = _arrays(probes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            first, second, size = (batch.column(k).to_numpy() for k in range(3))
            at = bins(arrays, first, second)
            order = np.argsort(at, kind="stable")
            found, begins = np.unique(at[order], return_index=True)
            first, second = first[order], second[order]
            columns = [found, np.add.reduceat(size[order], begins), np.diff(np.append(begins, len(at)))]
            for values in (first, second):
                columns += [np.minimum.reduceat(values, begins), np.maximum.reduceat(values, begins)]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns],
                                             names=["bin", "bytes", "n", "a0", "a1", "b0", "b1"])

    counted = keyed.select("first", "second", "size").mapInArrow(
        run, "bin long, bytes long, n long, a0 long, a1 long, b0 long, b1 long")
    rows = counted.groupBy("bin").agg(
        F.sum("bytes").alias("bytes"), F.sum("n").alias("n"), F.min("a0").alias("a0"), F.max("a1").alias("a1"),
        F.min("b0").alias("b0"), F.max("b1").alias("b1")).collect()
    out: list[tuple] = [(0, 0, None, None, None, None)] * (len(probes) + 1)
    for r in rows:
        out[r["bin"]] = tuple(r)[1:]
    return out


def _between(low: Key, high: Key, n: int) -> list[Key]:
    """Up to ``n`` evenly spaced keys above ``low`` and below ``high``: between
    texts where the bracket holds several, else inside its one text."""
    if high[0] - low[0] > 1 or (high[0] - low[0] == 1 and high[1] > _LOW):
        begin, end = low[0], high[0] + (high[1] > _LOW)
        steps = min(n, end - begin - 1)
        return [(begin + (end - begin) * k // (steps + 1), _LOW) for k in range(1, steps + 1)]
    begin, end = low[1], high[1] if high[0] == low[0] else _HIGH
    steps = min(n, end - begin - 1)
    return [(low[0], begin + (end - begin) * k // (steps + 1)) for k in range(1, steps + 1)]


def splitters(keyed: DataFrame, shards: int, pieces: int) -> tuple[list[Key], int]:
    """Boundaries of ``shards * pieces`` ranges of near equal bytes (every
    ``pieces``-th bounds a shard), and the number of counting rounds."""
    total = keyed.agg(F.sum("size")).first()[0] or 0
    wanted = [total * k / (shards * pieces) for k in range(1, shards * pieces)]
    slack = total / shards * min(SHARD_TOLERANCE, PIECE_TOLERANCE / pieces)
    chosen: list[Key | None] = [None] * len(wanted)
    brackets: dict[tuple, list[int]] = {((_LOW, _LOW), 0, (_HIGH, _LOW), total): list(range(len(wanted)))} if total else {}
    rounds = 0
    while brackets:
        rounds += 1
        share = max(LEAST_PROBES, PROBES // sum(map(len, brackets.values())))
        inner = {b: _between(b[0], b[2], share * len(p)) for b, p in brackets.items()}
        edges = {b[0] for b in brackets if b[0] > (_LOW, _LOW)} | {b[2] for b in brackets if b[2][0] < _HIGH}
        probes = sorted(edges.union(*inner.values()))
        counted = _count(keyed, probes)
        after: dict[tuple, list[int]] = {}
        for bracket, positions in brackets.items():
            low, below, high, above = bracket
            steps = inner[bracket]
            edges = [low, *steps, high]
            begin = bisect_left(probes, steps[0]) if steps else 0
            held = counted[begin:begin + len(steps) + 1] if steps else []
            sums = [below]
            for bin_ in held[:-1]:
                sums.append(sums[-1] + bin_[0])
            sums.append(above)
            for position in positions:
                want = wanted[position]
                right = min(max(1, bisect_left(sums, want)), len(sums) - 1)
                left = right - 1
                near = left if want - sums[left] <= sums[right] - want else right
                if abs(sums[near] - want) <= slack or not held or held[left][1] <= 1:
                    chosen[position] = edges[near]
                    continue
                _, _, a0, a1, b0, b1 = held[left]
                lower, upper = max(edges[left], (a0, _LOW)), min(edges[right], (a1 + 1, _LOW))
                if a0 == a1:                    # one text: its rows' hashes bound it more tightly
                    if b0 == b1:
                        chosen[position] = edges[near]
                        continue
                    lower = max(lower, (a0, b0))
                    upper = min(upper, (a0, b1 + 1) if b1 + 1 < _HIGH else upper)
                after.setdefault((lower, sums[left], upper, sums[right]), []).append(position)
        brackets = after
    return sorted(c if c[0] < _HIGH else (_HIGH - 1, _HIGH - 1) for c in chosen if c is not None), rounds


def shard_by_bytes(docs: DataFrame, keep: list[str], shards: int = 24, text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` in one of ``shards`` shards of near equal bytes: ``row``
    (the ``keep`` columns), ``size`` (UTF-8 bytes of the text plus 8), ``shard``
    from 0, and ``slot``, the row's place in its shard, gapless from 0.

    A shard's bytes differ from the mean by 1 % of it at most, or by one row where
    rows are larger.  Equal texts have consecutive slots, in one shard unless a
    boundary has to cut their group to stay within that tolerance.

    Defined cases: a null text counts as an empty one; repeated rows are rows of
    their own, however many there are; ties of all hashes are kept apart by a row
    number; one very long text is one row; carried columns may hold nulls and have
    any name; fewer rows than shards leave shards empty; an empty table gives an
    empty result.
    """
    spark = ready(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = materialise(spark, docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.xxhash64(text).alias("first"), F.monotonically_increasing_id().alias("number")), "sharding")
    keyed = keyed.withColumn("second", F.xxhash64("number"))
    pieces = -(-shuffle_partitions(spark) // shards)
    bounds, _ = splitters(keyed, shards, pieces)
    counted = _count(keyed, bounds)
    offsets, filled = [], 0
    for k, bin_ in enumerate(counted):
        filled = 0 if k % pieces == 0 else filled
        offsets.append(filled)
        filled += bin_[1]
    arrays = _arrays(bounds)
    inside = T.StructType([keyed.schema[c] for c in ("row", "size", "first", "second", "number")])
    placed = T.StructType([*inside, T.StructField("piece", T.IntegerType())])
    result = T.StructType([keyed.schema["row"], T.StructField("size", T.LongType()),
                           T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = bins(arrays, batch.column(2).to_numpy(), batch.column(3).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int32))], names=placed.names)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, seen = -1, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.column(2).to_numpy()
            begins = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            if at[0] != piece:
                seen = 0
            back = np.repeat(begins, np.diff(np.append(begins, len(at))))
            slots = np.arange(len(at)) - back + np.array(offsets, np.int64)[at]
            slots[back == 0] += seen
            seen = int(len(at) - begins[-1]) + (seen if len(begins) == 1 else 0)
            piece = at[-1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array((at // pieces).astype(np.int32)), pa.array(slots)], names=result.names)

    return (
        keyed.select(*inside.names).mapInArrow(place, placed)
        .repartitionById(shards * pieces, F.col("piece"))
        .sortWithinPartitions("piece", "first", "second", "number")
        .select("row", "size", "piece").mapInArrow(number, result)
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write shards as folders ``shard=N`` of Parquet files."""
    sharded.write.partitionBy("shard").parquet(path)
