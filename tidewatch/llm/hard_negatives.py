"""Hard negatives by exact inner-product search with length buckets and sorted
coordinates (LEMP).

Rows are sorted by label and length into packs, and each pack into length buckets
of at most ``BUCKET_ROWS`` rows.  An anchor q that needs scores of ``least`` or more
skips every bucket whose longest row cannot reach it.  In the others the cosine with
a row must be at least t = least / (|q| longest), so the row's unit vector lies
within the angle arccos t of q's, and on each focus coordinate (the largest ones of
q) within that angle of q's value: a range of the bucket's sorted list of that
coordinate.  The rows in all focus ranges are the candidates; their integer scores
are computed exactly.  Ranges and lengths are widened by ``SLACK``, so rounding loses
no row.

Blocks of anchors meet packs of rows.  A first meeting with one pack gives every
anchor scores to beat; a pair of block and pack whose lengths cannot beat them is
dropped before any vector travels.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import materialise, ready, shuffle_partitions

#: Rows of a length bucket, of a pack of them, of a block of anchors.
BUCKET_ROWS, PACK_ROWS, BLOCK_ROWS = 1024, 8192, 128
#: Packs that one task searches in turn, and blocks it holds beside them, about: an
#: anchor's list goes from pack to pack, so a task returns no more for many packs than
#: for one.
TEAM_PACKS, SLICE_BLOCKS = 16, 64
FOCUS = 4
SLACK = 1e-6
_MIN, _MAX = -(1 << 63), (1 << 63) - 1


def quantise(scale: int) -> Callable:
    """(id, label, vector) -> (id, label, dim, norm, vec): floor(scale x) as
    little-endian 4-byte integers, or as doubles where they are larger; rows with
    a null label, a null vector, null or non-finite components go."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels, dims, norms, rows = [], [], [], [], []
            for i, label, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if label is None or not v.is_valid or v.values.null_count:
                    continue
                with np.errstate(over="ignore", invalid="ignore"):
                    q = np.floor(scale * v.values.to_numpy(zero_copy_only=False).astype(np.float64))
                if not np.isfinite(q).all():
                    continue
                top = float(np.abs(q).max()) if len(q) else 0.0
                ids.append(i)
                labels.append(label)
                dims.append(len(q))
                norms.append(top * float(np.sqrt(((q / top) ** 2).sum())) if top else 0.0)
                rows.append(q.astype("<i4").tobytes() if top < 2 ** 31 else q.astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(labels, pa.int64()), pa.array(dims, pa.int32()),
                 pa.array(norms, pa.float64()), pa.array(rows, pa.binary())], names=["id", "label", "dim", "norm", "vec"])
    return run


def scores(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact integer products of ``rows`` with ``query``; those beyond a long are
    its largest or smallest value."""
    if not rows.size:
        return np.zeros(len(rows), np.int64)
    reach = float(np.abs(rows).max()) * float(np.abs(query).max()) * rows.shape[1]
    if reach < 2 ** 53:
        return (rows @ query).astype(np.int64)
    if reach < 2 ** 62:
        return rows.astype(np.int64) @ query.astype(np.int64)
    whole = [int(x) for x in query]
    return np.array([min(max(sum(int(x) * y for x, y in zip(row, whole)), _MIN), _MAX) for row in rows], np.int64)


def order_of(score: np.ndarray, ids: np.ndarray, nameless: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Places by score from the highest, then id (none last), then row number."""
    return np.lexsort((rows, ids, nameless, ~score))


class Bucket:
    """Rows of similar length: their unit vectors and, made when first asked for,
    sorted lists of coordinates."""

    def __init__(self, pack: dict, begin: int, end: int):
        self.rows, self.labels, self.numbers = pack["vecs"][begin:end], pack["labels"][begin:end], pack["numbers"][begin:end]
        self.ids, self.nameless = pack["ids"][begin:end], pack["nameless"][begin:end]
        norms = pack["norms"][begin:end]
        self.longest = float(norms.max())
        self.unit = self.rows / np.where(norms > 0, norms, 1)[:, None]
        self._sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self._sorted:
            order = np.argsort(self.unit[:, f])
            self._sorted[f] = order, self.unit[order, f]
        return self._sorted[f]

    def candidates(self, unit: np.ndarray, focus: np.ndarray, norm: float, least: float) -> np.ndarray | None:
        """Places of all rows that can score ``least`` or more (None: no row can)."""
        everything = np.arange(len(self.rows))
        if least <= 0:
            return everything
        reach = norm * self.longest
        if reach * (1 + SLACK) < least:
            return None
        angle = np.arccos(min(1.0, least / reach)) + SLACK
        own = np.arccos(np.clip(unit[focus], -1, 1))
        low = np.cos(np.minimum(own + angle, np.pi)) - SLACK
        high = np.cos(np.maximum(own - angle, 0)) + SLACK
        spans = []
        for f, a, b in zip(focus, low, high):
            order, values = self.coordinate(f)
            spans.append((np.searchsorted(values, a, "left"), np.searchsorted(values, b, "right"), order))
        first = min(range(len(spans)), key=lambda k: spans[k][1] - spans[k][0]) if spans else None
        if first is None:
            return everything
        begin, end, order = spans[first]
        met = order[begin:end]
        for k, f in enumerate(focus):
            if k != first:
                value = self.unit[met, f]
                met = met[(value >= low[k]) & (value <= high[k])]
        return met


def mine(buckets: list[Bucket], anchor: dict, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(score, id, nameless, row number) of all rows of the anchor's own label
    (``same``) or of the others that may be among the ``k`` first of one of its
    windows [low, high], where ``bounds`` are scores that ``k`` rows reach."""
    vec, norm = anchor["vec"], anchor["norm"]
    unit = vec / norm if norm > 0 else vec
    focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
    bounds = [max(a, b) for a, b in zip(anchor["low"], anchor["bounds"])]
    kept = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64))
    for bucket in buckets:
        met = bucket.candidates(unit, focus, norm, float(min(bounds)))
        if met is None or not len(met):
            continue
        met = met[(bucket.labels[met] == anchor["label"]) == same]
        met = met[bucket.numbers[met] != anchor["number"]]
        if not len(met):
            continue
        score = scores(bucket.rows[met], vec)
        good = (score >= min(bounds)) & (score <= max(anchor["high"]))
        if not good.any():
            continue
        met, score = met[good], score[good]
        kept = tuple(np.concatenate(pair) for pair in zip(kept, (score, bucket.ids[met], bucket.nameless[met], bucket.numbers[met])))
        order = order_of(*kept)
        kept = tuple(column[order] for column in kept)
        wanted = np.zeros(len(order), bool)
        for w, high in enumerate(anchor["high"]):
            inside = np.flatnonzero((kept[0] >= bounds[w]) & (kept[0] <= high))[:anchor["k"]]
            wanted[inside] = True
            if len(inside) == anchor["k"]:
                bounds[w] = max(bounds[w], int(kept[0][inside[-1]]))
        kept = tuple(column[wanted] for column in kept)
    return kept


def _dump(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _load(data: bytes) -> dict:
    with np.load(io.BytesIO(data)) as z:
        return {name: z[name] for name in z.files}


def _vectors(column, dim: int) -> np.ndarray:
    rows = [np.frombuffer(v, "<i4" if len(v) == 4 * dim else "<f8") for v in column.to_pylist()]
    wide = any(r.dtype.itemsize == 8 for r in rows)
    return np.array(rows, np.float64 if wide else np.int32).reshape(len(rows), dim)


def _ids(column) -> tuple[np.ndarray, np.ndarray]:
    """Ids, 0 where there is none, and where that is."""
    return column.fill_null(0).to_numpy(), column.is_null().to_numpy()


def _number(limit: int, names: list[str]):
    """Sorted rows -> the same with ``unit``: a number for up to ``limit`` rows in
    turn; a dimension starts anew, a label once a quarter of a unit is full."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held, last = TaskContext.get().partitionId() << 32, 0, None
        for batch in batches:
            out = []
            for key in zip(batch.column(names.index("dim")).to_pylist(), batch.column(names.index("label")).to_pylist()):
                if held == limit or (held and key[0] != last[0]) or (held * 4 >= limit and key != last):
                    unit, held = unit + 1, 0
                held, last = held + 1, key
                out.append(unit)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], names=[*names, "unit"])
    return run


def _by_length(rows: DataFrame) -> DataFrame:
    """``rows`` in partitions along label and falling length, cut at sampled points."""
    order = ["dim", "label", F.col("norm").desc(), "number"]
    return rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *order).sortWithinPartitions(*order)


def _pack(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(parts).combine_chunks()
    dim = table["dim"][0].as_py()
    ids, nameless = _ids(table["id"])
    labels, norms = table["label"].to_numpy(), table["norm"].to_numpy()
    payload = _dump(ids=ids, nameless=nameless, labels=labels, numbers=table["number"].to_numpy(), norms=norms, vecs=_vectors(table["vec"], dim))
    return pa.RecordBatch.from_arrays(
        [pa.array([table["unit"][0].as_py()]), pa.array([dim], pa.int32()), pa.array([np.unique(labels).tolist()], pa.list_(pa.int64())),
         pa.array([float(norms.max())]), pa.array([payload], pa.binary())], names=["pack", "dim", "labels", "longest", "payload"])


def _packed(names: list[str]):
    """Sorted rows -> packs of up to ``PACK_ROWS`` of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, unit = [], None
        for batch in _number(PACK_ROWS, names)(batches):
            units = batch.column(len(names)).to_numpy()
            begins = np.flatnonzero(np.append(units[:1] == units[:1], units[1:] != units[:-1])).tolist()
            for begin, end in zip(begins, begins[1:] + [len(units)]):
                if held and units[begin] != unit:
                    yield _pack(held)
                    held = []
                unit = units[begin]
                held.append(batch.slice(begin, end - begin))
        if held:
            yield _pack(held)
    return run


def _blocked(table: pa.Table) -> pa.Table:
    data = _dump(labels=table["label"].to_numpy(), numbers=table["number"].to_numpy(), norms=table["norm"].to_numpy(),
                 vecs=_vectors(table["vec"], table["dim"][0].as_py()), sizes=np.array([len(x) for x in table["low"].to_pylist()]),
                 **{c: np.array(sum(table[c].to_pylist(), []), np.int64) for c in ("low", "high", "bounds")})
    return pa.table({"block": table["unit"].slice(0, 1), "anchors": pa.array([data], pa.binary())})


def _meet(k: int, same: bool):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, bool, np.int64))]
        held: dict[int, list[Bucket]] = {}
        for number, data in zip(left["pack"].to_pylist(), left["payload"].to_pylist()):
            pack = _load(data)
            pack["vecs"] = pack["vecs"].astype(np.float64)
            held[number] = [Bucket(pack, b, b + BUCKET_ROWS) for b in range(0, len(pack["ids"]), BUCKET_ROWS)]
        for data, packs in zip(right["anchors"].to_pylist(), right["packs"].to_pylist()):
            block = _load(data)
            buckets = sorted((b for p in packs for b in held[p]), key=lambda b: -b.longest)
            vecs = block["vecs"].astype(np.float64)
            ends = np.cumsum(block["sizes"])
            for i, (size, end) in enumerate(zip(block["sizes"], ends)):
                anchor = {"vec": vecs[i], "norm": float(block["norms"][i]), "label": block["labels"][i], "number": block["numbers"][i],
                          "k": k, **{c: block[c][end - size:end].tolist() for c in ("low", "high", "bounds")}}
                score, ids, nameless, numbers = mine(buckets, anchor, same)
                found.append((np.full(len(score), anchor["number"]), score, ids, nameless, numbers))
        anchors, score, ids, nameless, numbers = (np.concatenate(c) for c in zip(*found))
        return pa.table({"anchor": anchors, "score": score, "found_id": pa.array(ids, mask=nameless), "found": numbers})
    return run


_FOUND = "anchor long, score long, found_id long, found long"


class _Index:
    """Packs of all rows, and meetings of anchors with them."""

    def __init__(self, spark: SparkSession, rows: DataFrame):
        self.spark = spark
        self.packs = materialise(spark, _by_length(rows).mapInArrow(
            _packed(rows.columns), "pack long, dim int, labels array<long>, longest double, payload binary"), "packs")
        # at least two tasks a core while packs are few
        self.teams = max(1, min(self.packs.count(), max(-(-self.packs.count() // TEAM_PACKS), 2 * spark.sparkContext.defaultParallelism)))

    def pairs(self, anchors: DataFrame, same: bool) -> DataFrame:
        """(block, pack) whose lengths allow a wanted score, the pack of longest
        rows first (``turn`` 1)."""
        least = F.array_min(F.zip_with("low", "bounds", lambda a, b: F.greatest(a, b))).cast("double")
        blocks = anchors.groupBy("unit", "dim").agg(
            F.max(F.when(least <= 0, F.lit(None)).otherwise(F.col("norm") / least)).alias("power"),
            F.max(least <= 0).alias("open"), F.collect_set("label").alias("asked"))
        packs = self.packs.select("pack", "dim", "labels", "longest")
        if same:
            met = blocks.withColumn("label", F.explode("asked")).join(packs.withColumn("label", F.explode("labels")), ["dim", "label"])
        else:
            met = blocks.join(packs, "dim").where((F.size("asked") > 1) | (F.size(F.array_except("labels", "asked")) > 0))
        able = F.col("open") | (F.col("longest") * F.col("power") * (1 + SLACK) >= 1)
        met = met.where(able).select(F.col("unit").alias("block"), "pack", "longest").distinct()
        return met.withColumn("turn", F.row_number().over(Window.partitionBy("block").orderBy(F.col("longest").desc(), "pack")))

    def meet(self, anchors: DataFrame, pairs: DataFrame, slices: int, k: int, same: bool) -> DataFrame:
        blocks = anchors.groupBy("unit").applyInArrow(_blocked, "block long, anchors binary")
        dealt = pairs.select("block", "pack", F.pmod(F.xxhash64("pack"), self.teams).alias("team"), F.pmod(F.xxhash64("block"), slices).alias("slice"))
        left = dealt.select(F.col("pack").alias("p"), F.col("team").alias("place"), F.col("slice").alias("part")).distinct().join(
            self.packs.select("pack", "payload"), F.col("p") == F.col("pack")).select("place", "part", "pack", "payload")
        right = dealt.groupBy("block", "team", "slice").agg(F.collect_list("pack").alias("packs")).join(blocks, "block")
        return left.groupBy("place", "part").cogroup(right.groupBy("team", "slice")).applyInArrow(_meet(k, same), _FOUND)

    def search(self, anchors: DataFrame, slices: int, k: int, same: bool, label: str) -> DataFrame:
        """Rows among the ``k`` first of an anchor's windows: one meeting of each
        block sets the bounds of the others."""
        every = materialise(self.spark, self.pairs(anchors, same), f"{label}-pairs")
        first = materialise(self.spark, self.meet(anchors, every.where("turn = 1"), slices, k, same), f"{label}-first")
        windows = anchors.select("number", F.posexplode(F.arrays_zip("low", "high")).alias("w", "span"))
        reached = Window.partitionBy("number", "w").orderBy(F.col("score").desc())
        bounds = (
            windows.join(first.withColumnRenamed("anchor", "number"), "number")
            .where("score between span.low and span.high").withColumn("n", F.row_number().over(reached)).where(F.col("n") == k)
            .groupBy("number").agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("reached"))
        )
        tight = anchors.join(bounds, "number", "left").withColumn(
            "bounds", F.transform("bounds", lambda b, w: F.coalesce(F.element_at("reached", w), b))).select(*anchors.columns)
        tight = materialise(self.spark, tight, f"{label}-bounds")
        later = self.pairs(tight, same).drop("turn").join(every.where("turn > 1").select("block", "pack"), ["block", "pack"])
        return first.unionByName(self.meet(tight, later, slices, k, same))


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", scale: int = 256) -> DataFrame:
    """For each anchor row (``is_anchor`` over the columns ``id`` and ``label``) and
    each of its ``positives`` best-scoring other rows of its label, the first
    ``negatives`` rows of other labels that score between ``low`` and ``high``
    percent of the positive: ``anchor_id``, ``positive_id``, ``rank`` from 1,
    ``negative_id``, ``positive_score``, ``negative_score``.  A score is the integer
    inner product of the vectors ``floor(scale x)``; ties go to the smaller id.

    Defined cases: rows with a null label or vector, or with null or non-finite
    components (times ``scale``, as doubles) take no part; vectors of different
    dimension do not meet; ids may repeat (every row is an anchor, a positive and a
    negative of its own; equal ids and scores go by row) or be null (last among
    ties); scores beyond a long are its largest or smallest value; positives that
    score below 0 have no negatives; an empty table gives an empty result; other
    columns are ignored.
    """
    spark = ready(vectors.sparkSession)
    source = vectors.select(F.col(id_col).cast("long"), F.col(label_col).cast("long"), vec_col)
    rows = source.mapInArrow(quantise(scale), "id long, label long, dim int, norm double, vec binary")
    rows = materialise(spark, rows.withColumn("number", F.monotonically_increasing_id()), "rows")
    index = _Index(spark, rows)
    every = F.array(F.lit(_MIN).cast("long"))
    anchors = materialise(spark, _by_length(rows.where(is_anchor)).mapInArrow(
        _number(BLOCK_ROWS, rows.columns), T.StructType([*rows.schema, T.StructField("unit", T.LongType())])), "anchors")
    slices = -(-anchors.select("unit").distinct().count() // SLICE_BLOCKS) or 1
    open_ = anchors.select("*", every.alias("low"), F.array(F.lit(_MAX).cast("long")).alias("high"), every.alias("bounds"))

    place = Window.partitionBy("anchor").orderBy(F.col("score").desc(), F.col("found_id").asc_nulls_last(), "found")
    chosen = index.search(open_, slices, positives, True, "positives").distinct().withColumn(
        "place", F.row_number().over(place)).where(F.col("place") <= positives)
    near, far = F.lit(low).cast("decimal(20,0)") * F.col("score"), F.lit(high).cast("decimal(20,0)") * F.col("score")
    chosen = materialise(spark, chosen.where("score >= 0").select(
        "anchor", "place", F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"),
        F.ceil(near / 100).cast("long").alias("low"), F.floor(far / 100).cast("long").alias("high")), "positives")

    spans = chosen.groupBy(F.col("anchor").alias("number")).agg(F.sort_array(F.collect_list(F.struct("place", "low", "high"))).alias("w"))
    asked = anchors.join(spans, "number").select(
        *anchors.columns, F.col("w.low").alias("low"), F.col("w.high").alias("high"),
        F.transform("w", lambda _: F.lit(_MIN).cast("long")).alias("bounds"))
    asked = materialise(spark, asked, "asked")
    found = index.search(asked, slices, negatives, False, "negatives").distinct()
    rank = Window.partitionBy("anchor", "place").orderBy(F.col("score").desc(), F.col("found_id").asc_nulls_last(), "found")
    return (
        found.join(chosen, "anchor").where("score between low and high")
        .withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= negatives)
        .join(anchors.select(F.col("number").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score",
                F.col("score").alias("negative_score"))
    )
