"""Ordered scans per key (running counts, run detection) that no hot key can funnel.

A window ``partitionBy(key).orderBy(ts)`` puts every row of a key into one
task; when one key holds a large share of the data that task is the whole
job.  Cutting the order into *time* blocks helps only while a key's rows are
spread over time: a burst, or many rows at one timestamp, still lands in one
block.

Here rows are range-partitioned on ``(key, ts, seq)`` and, last, a number of
the row in its input.  Spark samples the sort keys and picks slice bounds so
that every slice holds about the same number of rows, splitting a hot key
between consecutive slices at sampled points; the row number splits copies of
one ``(key, ts, seq)`` too.  No slice holds much more than ``rows / slices``,
whatever the key or time distribution or the number of copies.  Each slice is sorted and scanned once
in order by a vectorised kernel; only a slice's *first* key can continue
from earlier slices.  The work is two passes over the one shuffled input:

1. **summary**: each slice reports its first and last key segment (size,
   first and last value, the run at its end): at most two rows per slice;
2. **carry**: a window over that table, partitioned by key and ordered by
   slice, resolves per slice what its first key carries in: (run start,
   previous value, run length).  The table has at most one row per slice, a
   proven bound, so it joins back as a broadcast;
3. **scan**: each slice is scanned again as if nothing came before it; the
   rows whose run began at the slice's first row (the *open* rows) are then
   fixed up with the slice's carry by that broadcast join, in the JVM.

Both passes read the same exchange: they take whole rows (nothing to prune),
so the plans match and Spark reuses the one shuffle.  The number of slices is
always explicit (default: ``spark.sql.shuffle.partitions``): a range shuffle of
unstated size would be coalesced anew in every stage that reads it, and two
scans in one union would then see different slices.  The bounds come from
that one shuffle dependency, and a retried or recomputed task reads the same
slice.  If the two passes ever saw different slices (exchange reuse turned
off), a slice's first row would not match the summary's fingerprint of it,
and the fix-up raises an error instead of returning wrong counts.

Arrow batches of a slice are scanned one after another with the state carried
between them, so a slice is never held in memory whole.  The
passes use ``mapInArrow``: keys stay Arrow arrays compared in C++, numbers are
numpy views, and no per-row Python objects are made.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.session import ship_package

RISING = "rising"      # a run restarts at a new key or when the value does not rise
COUNT = "count"        # a run restarts only at a new key: counts are positions within the key


#: Row number that tells copies of one (key, ts, seq) apart.
_TIE = "_tie"


def not_null(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def unordered_rows(df: DataFrame, key: str, ts: str, seq: str, value: str | None = None) -> DataFrame:
    """The rows that :func:`ordered_scan` leaves out: their key, ``ts``, ``seq``
    (or ``value``, where the rule reads it) is null, so they have no place in
    the order.  Send them to a quarantine where they must not get lost."""
    return df.where(~not_null([key, ts, seq] + ([value] if value else [])))


# ---------------------------------------------------------------------------
# vectorised kernel (runs inside tasks)
# ---------------------------------------------------------------------------

def ge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a >= b`` with Spark SQL's NaN rule (NaN equals NaN and is largest)."""
    return (a >= b) | np.isnan(a)


def advance_runs(new_key: np.ndarray | None, first_key, last_key, ts_ms: np.ndarray, values: np.ndarray | None,
                 state: tuple | None, rule: str = RISING):
    """Apply the run rule to rows already in (key, ts, seq) order.

    ``new_key[i]`` is True where row ``i`` has another key than row ``i-1``
    (``None``: all rows share one key); ``first_key``/``last_key`` are the
    keys of the first and last row.  ``state`` is the run carried in,
    ``(key, start_ms, prev_value, count)``, or ``None``.  A new key starts a
    run; under ``RISING`` so does a value not above the previous one.
    Returns per-row ``(start_ms, counts)`` and the state after the last row.
    """
    n = len(ts_ms)
    idx = np.arange(n)
    restart = np.zeros(n, dtype=bool)
    if rule == RISING:
        restart[1:] = ge(values[:-1], values[1:])
    if new_key is not None and n > 1:
        restart[1:] |= new_key[1:]
    carried = state is not None and state[0] == first_key
    restart[0] = not carried
    if carried and rule == RISING:
        restart[0] = bool(ge(np.array([state[2]], dtype="float64"), values[:1])[0])
    last = np.maximum.accumulate(np.where(restart, idx, -1))
    own = last >= 0
    safe = np.where(own, last, 0)
    c_start, c_cnt = (int(state[1]), int(state[3])) if carried else (0, 0)
    counts = np.where(own, idx - safe + 1, c_cnt + idx + 1).astype("int64")
    start = np.where(own, ts_ms[safe], c_start).astype("int64")
    last_v = float(values[-1]) if values is not None else 0.0
    return start, counts, (last_key, int(start[-1]), last_v, int(counts[-1]))


def fingerprint(key, ts: int, seq: int) -> int:
    """Stable id of a row's (key, ts, seq), to check both passes saw one slicing."""
    return zlib.crc32(f"{key!r}|{int(ts)}|{int(seq)}".encode())


class _Cols:
    """Column access on Arrow record batches: keys stay Arrow (compared in
    C++), numbers become numpy views."""

    def __init__(self, key: str, ts: str, seq: str, value: str | None):
        self.key, self.ts, self.seq, self.value = key, ts, seq, value

    def read(self, batch: pa.RecordBatch):
        keys = batch.column(self.key)
        changed = np.empty(len(keys), dtype=bool)
        changed[0] = True
        if len(keys) > 1:
            changed[1:] = pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
        ts = batch.column(self.ts).to_numpy(zero_copy_only=False).astype("int64", copy=False)
        val = (batch.column(self.value).to_numpy(zero_copy_only=False).astype("float64", copy=False)
               if self.value else None)
        return keys, changed, ts, val


def _segment(keys, ts, val, start, counts, a: int, b: int) -> dict:
    return {"k": keys[a].as_py(), "n": b - a, "first_v": float(val[a]) if val is not None else 0.0,
            "first_ts": int(ts[a]), "last_v": float(val[b - 1]) if val is not None else 0.0,
            "last_start": int(start[b - 1]), "last_cnt": int(counts[b - 1])}


SEG_FIELDS = ("_slice", "k", "is_first", "chk", "n", "first_v", "first_ts", "last_v", "last_start", "last_cnt")


def _summarize(c: _Cols, rule: str):
    """Per slice: its first and last key segment (at most two rows).

    Runs are computed as if nothing came before the slice, so ``last_cnt < n``
    means the segment restarts a run after its first row.  Per batch only the
    segment continuing from the previous batch and the first and last segments
    opened are touched, so the Python work per batch is constant.
    """
    def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        slice_id = check = key_type = None
        first = cur = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys, changed, ts, val = c.read(batch)
            k0, k1 = keys[0].as_py(), keys[-1].as_py()
            if slice_id is None:
                slice_id = batch.column("_slice")[0].as_py()
                check = fingerprint(k0, ts[0], batch.column(c.seq)[0].as_py())
                key_type = keys.type
            start, counts, state_after = advance_runs(changed, k0, k1, ts, val, state, rule)
            size = batch.num_rows
            new = changed
            new[0] = cur is None or cur["k"] != k0
            opens = np.flatnonzero(new)
            cont = int(opens[0]) if len(opens) else size
            if cont > 0:                       # rows continuing the open segment
                cur["n"] += cont
                cur.update(last_v=float(val[cont - 1]) if val is not None else 0.0,
                           last_start=int(start[cont - 1]), last_cnt=int(counts[cont - 1]))
            if len(opens):
                if cur is not None and first is None:
                    first = cur
                end = int(opens[1]) if len(opens) > 1 else size
                cur = _segment(keys, ts, val, start, counts, int(opens[0]), end)
                if len(opens) > 1:
                    if first is None:
                        first = cur
                    cur = _segment(keys, ts, val, start, counts, int(opens[-1]), size)
            state = state_after
        if cur is None:
            return
        segs = [first, cur] if first is not None else [cur]
        cols = {f: [s.get(f) for s in segs] for f in SEG_FIELDS[4:]}
        cols.update(_slice=[slice_id] * len(segs), k=[s["k"] for s in segs],
                    is_first=[i == 0 for i in range(len(segs))], chk=[check] * len(segs))
        schema = pa.schema([("_slice", pa.int32()), ("k", key_type), ("is_first", pa.bool_()),
                            ("chk", pa.int64()), ("n", pa.int64()), ("first_v", pa.float64()),
                            ("first_ts", pa.int64()), ("last_v", pa.float64()), ("last_start", pa.int64()),
                            ("last_cnt", pa.int64())])
        yield pa.RecordBatch.from_pydict({f: cols[f] for f in SEG_FIELDS}, schema=schema)
    return summarize


def _carry_in(segments: DataFrame, rule: str) -> DataFrame:
    """Per slice, the run its first key carries in from earlier slices.

    A key's segments in consecutive slices are all present (a key spanning a
    slice is both its first and last segment).  A segment *resets* when it is
    the key's first, or (``RISING``) when it restarts after its first row or
    the previous segment's last value is >= its first value.  Otherwise it
    extends the run carried in, so the run at its end is anchored at the
    latest resetting segment plus the rows since.  Output, one row per
    non-empty slice: ``_slice, chk, in_start, in_cnt, extends``, where
    ``extends`` says the slice's first run continues the carried one (its
    first value rises above the previous one).
    """
    w = Window.partitionBy("k").orderBy("_slice")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prev_last = F.lag("last_v").over(w)
    resets = prev_last.isNull()
    if rule == RISING:
        resets = resets | (F.col("last_cnt") < F.col("n")) | (prev_last >= F.col("first_v"))
    ends = (
        segments.withColumn("_resets", resets)
        .withColumn("_cum_n", F.sum("n").over(upto))
        .withColumn("_a_cnt", F.when(F.col("_resets"), F.col("last_cnt") - F.col("_cum_n")))
        .withColumn("_a_start", F.when(F.col("_resets"), F.col("last_start")))
        .withColumn("_end_cnt", F.last("_a_cnt", ignorenulls=True).over(upto) + F.col("_cum_n"))
        .withColumn("_end_start", F.last("_a_start", ignorenulls=True).over(upto))
    )
    carried = F.lag("_end_cnt").over(w)
    extends = carried.isNotNull()
    if rule == RISING:
        extends = extends & ~(prev_last >= F.col("first_v"))
    return (
        ends.select(
            "_slice", "is_first", "chk",
            F.lag("_end_start").over(w).alias("in_start"),
            carried.alias("in_cnt"),
            extends.alias("extends"),
        )
        .where(F.col("is_first"))
        .drop("is_first")
    )


def _scan(c: _Cols, rule: str, keep: list[str], start_col: str, count_col: str, min_count: int | None):
    """Scan one sorted slice as if nothing came before it.

    Rows whose run began at the slice's first row are *open*: a run carried
    in from earlier slices may extend them, so they are always emitted (the
    slice's first row is always open) and fixed up after the scan.  A row at
    slice position ``g`` is open exactly when its local count is ``g + 1``.
    Other rows are final and emitted when ``count >= min_count``.  Open rows
    carry the fingerprint of the slice's first row for the slicing check.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        pos = 0
        check = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys, changed, ts, val = c.read(batch)
            k0, k1 = keys[0].as_py(), keys[-1].as_py()
            if check is None:
                check = fingerprint(k0, ts[0], batch.column(c.seq)[0].as_py())
            start, counts, state = advance_runs(changed, k0, k1, ts, val, state, rule)
            size = batch.num_rows
            is_open = counts == np.arange(pos + 1, pos + size + 1)
            pos += size
            arrays = [batch.column(k) for k in keep] + [
                pa.array(start, pa.int64()), pa.array(counts, pa.int64()), pa.array(is_open),
                batch.column("_slice"), pa.array(np.where(is_open, check, 0), pa.int64(), mask=~is_open)]
            out = pa.RecordBatch.from_arrays(arrays, names=list(keep) + [start_col, count_col, "_open", "_slice",
                                                                        "_chk"])
            if min_count is not None:
                out = out.filter(pa.array((counts >= min_count) | is_open))
            if out.num_rows:
                yield out
    return scan


def ordered_scan(df: DataFrame, key: str, ts: str, seq: str, value: str | None = None, rule: str = RISING,
                 keep: Sequence[str] | None = None, start_col: str | None = "start_ms", count_col: str = "counts",
                 slices: int | None = None, min_count: int | None = None) -> DataFrame:
    """Run a per-key ordered rule over ``df`` without funnelling any key.

    Rows with a null key, ``ts``, ``seq`` (or ``value`` for ``RISING``) have no
    place in the order and are left out (:func:`unordered_rows` returns them); a
    NaN key raises an error.  Output: the ``keep`` columns
    (default: all input columns) plus ``start_col`` (start of the row's run,
    epoch ms) and ``count_col`` (its length so far), only rows with
    ``count >= min_count`` when given.  ``slices`` is the number of range
    slices (default: ``spark.sql.shuffle.partitions``).
    """
    needed = [key, ts, seq] + ([value] if rule == RISING else [])
    keep = list(keep) if keep is not None else list(df.columns)
    cols_in = list(dict.fromkeys(keep + needed + ([value] if value else [])))
    c = _Cols(key, ts, seq, value if rule == RISING else None)
    ship_package(df.sparkSession)

    rows = df.select(*cols_in).where(not_null(needed))
    if isinstance(rows.schema[key].dataType, (T.FloatType, T.DoubleType)):
        # Arrow compares NaN keys as unequal, Spark groups them: refuse rather than miscount
        rows = rows.withColumn(key, F.when(F.isnan(key), F.raise_error(F.lit(
            f"ordered scan: NaN in key column {key}"))).otherwise(F.col(key)))
    # An explicit count: adaptive execution would resize any other range shuffle
    # once per stage that reads it, and the two passes may be in different stages.
    n_slices = int(slices or df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [key, ts, seq, _TIE]
    placed = (
        rows.withColumn(_TIE, F.monotonically_increasing_id())
        .repartitionByRange(n_slices, *order)
        .withColumn("_slice", F.spark_partition_id())
    )

    key_type = rows.schema[key].dataType
    seg_schema = T.StructType([
        T.StructField("_slice", T.IntegerType()), T.StructField("k", key_type),
        T.StructField("is_first", T.BooleanType()), T.StructField("chk", T.LongType()),
        T.StructField("n", T.LongType()), T.StructField("first_v", T.DoubleType()),
        T.StructField("first_ts", T.LongType()), T.StructField("last_v", T.DoubleType()),
        T.StructField("last_start", T.LongType()), T.StructField("last_cnt", T.LongType()),
    ])
    ordered = placed.sortWithinPartitions(*order)
    segments = ordered.mapInArrow(_summarize(c, rule), seg_schema)
    carry = F.broadcast(_carry_in(segments, rule))           # one row per slice

    tmp_start, tmp_count = "_local_start", "_local_count"
    scan_schema = T.StructType([rows.schema[k] for k in keep] + [
        T.StructField(tmp_start, T.LongType()), T.StructField(tmp_count, T.LongType()),
        T.StructField("_open", T.BooleanType()), T.StructField("_slice", T.IntegerType()),
        T.StructField("_chk", T.LongType())])
    local = ordered.mapInArrow(_scan(c, rule, keep, tmp_start, tmp_count, min_count), scan_schema)

    # apply what each slice carries in to its open rows; a slice whose first row
    # does not match the summary's fingerprint was sliced differently: fail
    fixed = local.join(carry, on="_slice", how="left")
    mismatch = F.col("_open") & ~F.col("_chk").eqNullSafe(F.col("chk"))
    ext = F.col("_open") & F.coalesce(F.col("extends"), F.lit(False))
    count_expr = (
        F.when(mismatch, F.raise_error(F.lit(
            "ordered scan: the summary and scan passes saw different range slices; both must "
            "read one shuffle (spark.sql.exchange.reuse enabled, input rows in a repeatable order)")))
        .when(ext, F.col("in_cnt") + F.col(tmp_count))
        .otherwise(F.col(tmp_count))
        .cast("long")
    )
    out = fixed.select(
        *keep,
        F.when(ext, F.col("in_start")).otherwise(F.col(tmp_start)).alias(start_col or tmp_start),
        count_expr.alias(count_col),
    )
    if min_count is not None:
        out = out.where(F.col(count_col) >= F.lit(min_count))
    return out if start_col else out.drop(tmp_start)


def ordered_running_count(df: DataFrame, key: str, ts: str, seq: str, out: str = "running",
                          slices: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based position of each row within its key, in (ts, seq) order."""
    return ordered_scan(df, key, ts, seq, rule=COUNT, start_col=None, count_col=out, slices=slices)
