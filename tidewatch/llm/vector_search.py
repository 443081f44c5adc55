"""Exact top-k inner-product search with KD-trees per shard.

Upper median splits, fitted on a bounded sample, cut space into cells; a cell's rows
are dealt into shards of bounded size, each a KD-tree (median splits on the widest
dimension, tight bounding boxes, bucket leaves).  Queries travel in blocks of one
cell.  For a query q a box [lo, hi] bounds every score inside it by
``q+ . hi + q- . lo``; the tree is opened level by level where this bound reaches
the query's kth score, and leaves are visited best bound first until no bound
reaches it.  The kth score is propagated: every block first searches a shard of its
own cell.  A block then meets only those shards whose box bound, over the block's own
box, reaches its lowest kth score; other pairs are dropped before vectors travel.

Scores are exact integers throughout, whatever the size of the components.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import materialise, ready

SHARD_ROWS, BLOCK_ROWS, LEAF_ROWS = 8192, 1024, 128
#: Blocks that one task holds beside a tree.
SLICE_BLOCKS = 16
#: Rows that the upper splits are fitted on, at most, and cells they make, at most.
SAMPLE_ROWS, MOST_CELLS = 16_384, 1024
#: Tasks that compare a dimension's boxes.
SALTS = 16
SCALE = 64
_NONE, _MAX = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, embedding) -> (vec_id, dim, vec): floor(64 x) as little-endian 4-byte
    integers, or as doubles where they are larger; without vectors that are null or
    hold null or non-finite components (times 64, as doubles)."""
    for batch in batches:
        ids, dims, rows = [], [], []
        for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
            if not v.is_valid or v.values.null_count:
                continue
            with np.errstate(over="ignore", invalid="ignore"):
                q = np.floor(SCALE * v.values.to_numpy(zero_copy_only=False).astype(np.float64))
            if not np.isfinite(q).all():
                continue
            ids.append(i)
            dims.append(len(q))
            rows.append(q.astype("<i4" if not len(q) or np.abs(q).max() < 2 ** 31 else "<f8").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(rows, pa.binary())],
                                         names=["vec_id", "dim", "vec"])


def matrix(vecs: list[bytes], dim: int) -> np.ndarray:
    """Stored vectors as rows of doubles (which hold every quantised component exactly)."""
    if all(len(v) == 4 * dim for v in vecs):
        return np.frombuffer(b"".join(vecs), "<i4").reshape(len(vecs), dim).astype(np.float64)
    return np.array([np.frombuffer(v, "<i4" if len(v) == 4 * dim else "<f8") for v in vecs], np.float64)


def _whole(a: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in row] for row in a], object).reshape(a.shape)


def products(pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Exact integer sum of the products a @ b.T, as longs (beyond a long: its
    largest value, or its smallest but one).  Doubles are exact below 2**53."""
    reach = sum(float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] for a, b in pairs if a.size and b.size)
    if reach < 2 ** 53:
        return sum(a @ b.T for a, b in pairs).astype(np.int64)
    if reach < 2 ** 62:
        return sum(a.astype(np.int64) @ b.astype(np.int64).T for a, b in pairs)
    total = sum(_whole(a) @ _whole(b).T for a, b in pairs)
    return np.minimum(np.maximum(total, int(_NONE) + 1), int(_MAX)).astype(np.int64)


class Tree:
    """A KD-tree over the rows of one shard, kept as arrays.

    ``spans[k]`` lists nodes (begin, end) of depth k; every inner node's children are
    nodes of the next level, in order; leaves move down unchanged, so the last level
    holds the leaves.  ``lo`` and ``hi`` are their tight boxes.  ``ids`` (any values;
    ``nameless`` where there is none) and ``numbers`` name the rows; ``place`` is a
    row's rank by id, then number.
    """

    def __init__(self, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF_ROWS, numbers: np.ndarray | None = None, nameless: np.ndarray | None = None):
        numbers = np.arange(len(ids)) if numbers is None else numbers
        nameless = np.zeros(len(ids), bool) if nameless is None else nameless
        named = np.lexsort((numbers, ids, nameless))
        place = np.arange(len(ids))
        self.spans: list[np.ndarray] = []
        spans = [(0, len(ids))]
        while True:
            self.spans.append(np.array(spans))
            below, split = [], False
            for b, e in spans:
                part = rows[named[place[b:e]]]
                wide = part.max(axis=0) - part.min(axis=0) if e - b and part.shape[1] else np.zeros(1)
                if e - b <= leaf or not wide.max():
                    below.append((b, e))
                    continue
                middle = (e - b) // 2
                place[b:e] = place[b:e][np.argpartition(part[:, int(wide.argmax())], middle)]
                below += [(b, b + middle), (b + middle, e)]
                split = True
            if not split:
                break
            spans = below
        for b, e in self.spans[-1]:
            place[b:e] = np.sort(place[b:e])
        order = named[place]
        self.place, self.ids, self.numbers, self.nameless, self.rows = place, ids[order], numbers[order], nameless[order], rows[order]
        self.lo = [np.array([self.rows[b:e].min(axis=0) for b, e in s]) for s in self.spans]
        self.hi = [np.array([self.rows[b:e].max(axis=0) for b, e in s]) for s in self.spans]

    def dump(self) -> bytes:
        out = io.BytesIO()
        small = not self.rows.size or np.abs(self.rows).max() < 2 ** 31
        kind = np.int32 if small else np.float64
        named = {"place": self.place, "ids": self.ids, "numbers": self.numbers, "nameless": self.nameless, "rows": self.rows.astype(kind)}
        for k, s in enumerate(self.spans):
            named[f"s{k}"], named[f"l{k}"], named[f"h{k}"] = s, self.lo[k].astype(kind), self.hi[k].astype(kind)
        np.savez(out, **named)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> "Tree":
        with np.load(io.BytesIO(data)) as z:
            tree = cls.__new__(cls)
            tree.place, tree.ids, tree.numbers, tree.nameless = z["place"], z["ids"], z["numbers"], z["nameless"]
            tree.rows = z["rows"].astype(np.float64)
            depth = sum(n.startswith("s") for n in z.files)
            tree.spans = [z[f"s{k}"] for k in range(depth)]
            tree.lo = [z[f"l{k}"].astype(np.float64) for k in range(depth)]
            tree.hi = [z[f"h{k}"].astype(np.float64) for k in range(depth)]
        return tree


def search(tree: Tree, numbers: np.ndarray, queries: np.ndarray, k: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query position, row position, score) of every row that may be among a query's
    ``k`` best; ``numbers`` are the queries' row numbers (a row is not its own
    result), ``least`` each query's propagated kth score (or the lowest long)."""
    n = len(numbers)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    kth = least.copy()
    best = np.full((n, k), _NONE)
    place = np.full((n, k), _MAX)
    at = np.zeros((n, k), np.int64)
    alive = np.ones((n, 1), bool)
    for level, spans in enumerate(tree.spans):
        if level:
            # children of a node are the next level's spans inside it
            parent = np.searchsorted(tree.spans[level - 1][:, 0], spans[:, 0], side="right") - 1
            alive = alive[:, parent]
        bound = products([(up, tree.hi[level]), (down, tree.lo[level])])
        alive = alive & (bound >= kth[:, None])
    bound = np.where(alive, bound, _NONE)
    order = np.argsort(~bound, axis=1, kind="stable")
    for turn in range(order.shape[1]):
        leaf = order[:, turn]
        reach = bound[np.arange(n), leaf]
        active = np.flatnonzero((reach >= kth) & (reach > _NONE))
        if not len(active):
            break
        for node in np.unique(leaf[active]):
            who = active[leaf[active] == node]
            b, e = tree.spans[-1][node]
            score = products([(queries[who], tree.rows[b:e])])
            score[tree.numbers[b:e][None, :] == numbers[who][:, None]] = _NONE
            some = ((score >= kth[who][:, None]) & (score > _NONE)).any(axis=1)
            who, score = who[some], score[some]
            if not len(who):
                continue
            scores = np.concatenate([best[who], score], axis=1)
            places = np.concatenate([place[who], np.broadcast_to(tree.place[b:e], score.shape)], axis=1)
            rows = np.concatenate([at[who], np.broadcast_to(np.arange(b, e), score.shape)], axis=1)
            first = np.lexsort((places, ~scores), axis=1)[:, :k]
            best[who], place[who], at[who] = (np.take_along_axis(x, first, axis=1) for x in (scores, places, rows))
            kth[who] = np.maximum(kth[who], best[who, k - 1])
    row, column = np.nonzero((best >= least[:, None]) & (best > _NONE))
    return row, at[row, column], best[row, column]


def _gather(table: pa.Table) -> pa.Table:
    """A block's queries, and its box and lowest kth score."""
    queries = matrix(table["vec"].to_pylist(), table["dim"][0].as_py())
    data = io.BytesIO()
    np.savez(data, numbers=table["number"].to_numpy(), queries=queries, least=table["least"].to_numpy())
    return pa.table({
        **{c: table[c].slice(0, 1) for c in ("dim", "cell", "block")}, "queries": pa.array([data.getvalue()], pa.binary()),
        "low": pa.array([queries.min(axis=0).tolist()], pa.list_(pa.float64())), "high": pa.array([queries.max(axis=0).tolist()], pa.list_(pa.float64())),
        "least": pa.array([int(table["least"].to_numpy().min())], pa.int64())})


def _plant(table: pa.Table) -> pa.Table:
    ids = table["vec_id"].combine_chunks()
    rows = matrix(table["vec"].to_pylist(), table["dim"][0].as_py())
    tree = Tree(ids.fill_null(0).to_numpy(), rows, numbers=table["number"].to_numpy(), nameless=ids.is_null().to_numpy(zero_copy_only=False))
    return pa.table({
        **{c: table[c].slice(0, 1) for c in ("dim", "cell", "shard")}, "tree": pa.array([tree.dump()], pa.binary()),
        "lo": pa.array([rows.min(axis=0).tolist()], pa.list_(pa.float64())), "hi": pa.array([rows.max(axis=0).tolist()], pa.list_(pa.float64()))})


def _search(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [tuple(np.empty(0, t) for t in (np.int64, np.int64, bool, np.int64, np.int64))]
        if left.num_rows:
            tree = Tree.load(left["tree"][0].as_py())
            for data in right["queries"].to_pylist():
                with np.load(io.BytesIO(data)) as z:
                    numbers, queries, least = z["numbers"], z["queries"], z["least"]
                query, row, score = search(tree, numbers, queries, k, least)
                found.append((numbers[query], tree.ids[row], tree.nameless[row], tree.numbers[row], score))
        query, ids, nameless, numbers, score = (np.concatenate(c) for c in zip(*found))
        return pa.table({"query": query, "vec_id": pa.array(ids, mask=nameless), "number": numbers, "score": score})
    return run


_FOUND = "query long, vec_id long, number long, score long"


def upper_splits(sample: dict[int, np.ndarray], counts: dict[int, int], shard_rows: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per dimension count: (dimensions, thresholds) of a complete tree of median
    splits, in heap order, with about a cell per ``shard_rows`` rows."""
    out = {}
    for dim, rows in sample.items():
        cells = min(MOST_CELLS, max(1, counts[dim] // shard_rows), max(1, len(rows) // 16))
        depth = int(np.log2(cells)) if dim else 0
        on, cut = np.zeros(2 ** depth - 1, np.int64), np.zeros(2 ** depth - 1)
        parts = {0: rows}
        for node in range(2 ** depth - 1):
            part = parts.pop(node)
            if len(part):
                on[node] = int((part.max(axis=0) - part.min(axis=0)).argmax())
                cut[node] = np.median(part[:, on[node]])
            right = part[:, on[node]] >= cut[node]
            parts[2 * node + 1], parts[2 * node + 2] = part[~right], part[right]
        out[dim] = (on, cut)
    return out


def _cells(splits: dict[int, tuple[np.ndarray, np.ndarray]], names: list[str]):
    """Rows -> the same with their ``cell``: down the upper splits of their dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(names.index("dim")).to_numpy()
            cell = np.zeros(len(dims), np.int64)
            vecs = batch.column(names.index("vec"))
            for dim in np.unique(dims).tolist():
                on, cut = splits.get(dim, ((), ()))
                if not len(on):
                    continue
                who = np.flatnonzero(dims == dim)
                rows = matrix(vecs.take(pa.array(who)).to_pylist(), dim)
                node = np.zeros(len(who), np.int64)
                for _ in range(int(np.log2(len(on) + 1))):
                    node = 2 * node + 1 + (rows[np.arange(len(who)), on[node]] >= cut[node])
                cell[who] = node - len(on)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*names, "cell"])
    return run


class Index:
    """Shards of all rows; ``pairs_met`` counts the (block, shard) pairs of the last search."""

    def __init__(self, spark: SparkSession, vectors: DataFrame, id_col: str, vec_col: str, shard_rows: int):
        self.spark = spark
        source = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("embedding"))
        clean = source.mapInArrow(quantise, "vec_id long, dim int, vec binary").withColumn("number", F.monotonically_increasing_id())
        clean = materialise(spark, clean, "vectors")
        counts = {r["dim"]: r["n"] for r in clean.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").limit(MOST_CELLS).collect()}
        every = max(1, sum(counts.values()) // SAMPLE_ROWS)
        drawn = clean.where(F.pmod(F.xxhash64("number"), F.lit(every)) == 0).select("dim", "vec").limit(2 * SAMPLE_ROWS).collect()
        by_dim: dict[int, list] = {}
        for r in drawn:
            by_dim.setdefault(r["dim"], []).append(bytes(r["vec"]))
        splits = upper_splits({d: matrix(v, d) for d, v in by_dim.items() if d in counts}, counts, shard_rows)
        self.rows = clean.mapInArrow(_cells(splits, clean.columns), "vec_id long, dim int, vec binary, number long, cell long")
        self.rows = materialise(spark, self.rows, "cells")
        pieces = self.rows.groupBy("dim", "cell").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / shard_rows)).cast("int").alias("pieces"))
        dealt = self.rows.join(pieces, ["dim", "cell"]).withColumn(
            "shard", F.pmod(F.xxhash64("number"), "pieces") * MOST_CELLS + F.col("cell"))
        self.trees = materialise(spark, dealt.select("dim", "cell", "shard", "vec_id", "number", "vec").groupBy("dim", "shard").applyInArrow(
            _plant, "dim int, cell long, shard long, tree binary, lo array<double>, hi array<double>"), "trees")
        self.pairs_met = 0

    def blocks(self, queries: DataFrame) -> DataFrame:
        return queries.groupBy("dim", "block").applyInArrow(
            _gather, "dim int, cell long, block long, queries binary, low array<double>, high array<double>, least long")

    def meet(self, pairs: DataFrame, blocks: DataFrame, slices: int, k: int) -> DataFrame:
        dealt = pairs.select("dim", "block", "shard", F.pmod(F.xxhash64("block"), slices).alias("slice"))
        left = dealt.select(F.col("dim").alias("d"), F.col("shard").alias("s"), F.col("slice").alias("part")).distinct().join(
            self.trees.select("dim", "shard", "tree"), (F.col("d") == F.col("dim")) & (F.col("s") == F.col("shard"))).select("d", "s", "part", "tree")
        right = dealt.join(blocks.select("dim", "block", "queries"), ["dim", "block"])
        return left.groupBy("d", "s", "part").cogroup(right.groupBy("dim", "shard", "slice")).applyInArrow(_search(k), _FOUND)

    def search(self, is_query: Column, k: int, block_rows: int) -> DataFrame:
        """(query, vec_id, number, score) of all rows that may be among a query's ``k`` best."""
        asked = self.rows.where(is_query)
        pieces = asked.groupBy("dim", "cell").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / block_rows)).cast("int").alias("pieces"))
        asked = materialise(self.spark, asked.join(pieces, ["dim", "cell"]).withColumn(
            "block", F.pmod(F.xxhash64(F.lit(3), "number"), "pieces") * MOST_CELLS + F.col("cell")).select(
            "dim", "cell", "block", "number", "vec"), "asked")
        slices = -(-asked.select("dim", "block").distinct().count() // SLICE_BLOCKS) or 1
        boxes = self.trees.select("dim", "shard", F.col("cell").alias("at"), "lo", "hi")
        open_ = self.blocks(asked.withColumn("least", F.lit(int(_NONE))))
        # of the shards of a block's own cell, one by the block's number
        own = open_.select("dim", "block", "cell").join(boxes.select("dim", "at", "shard"), "dim").where("at = cell")
        turn = Window.partitionBy("dim", "block").orderBy(F.xxhash64("block", "shard"))
        home = materialise(self.spark, own.withColumn("n", F.row_number().over(turn)).where("n = 1").select("dim", "block", "shard"), "home")
        first = materialise(self.spark, self.meet(home, open_, slices, k), "first")
        kth = first.groupBy(F.col("query").alias("number")).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s")).where(F.col("n") >= k)
        blocks = materialise(self.spark, self.blocks(asked.join(kth, "number", "left").withColumn("least", F.coalesce("s", F.lit(int(_NONE))))), "blocks")
        corners = F.arrays_zip("low", "high", "lo", "hi")
        bound = F.aggregate(corners, F.lit(0.0), lambda a, x: a + F.greatest(
            x["low"] * x["lo"], x["low"] * x["hi"], x["high"] * x["lo"], x["high"] * x["hi"]))
        size = F.aggregate(corners, F.lit(1.0), lambda a, x: a + F.greatest(F.abs(x["low"]), F.abs(x["high"])) * F.greatest(F.abs(x["lo"]), F.abs(x["hi"])))
        spread = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        met = blocks.select("dim", "block", "low", "high", "least", spread).join(
            boxes.drop("at").withColumn("salt", F.pmod(F.xxhash64("shard"), SALTS).cast("int")), ["dim", "salt"]).where(
            bound + size * 1e-9 >= F.col("least").cast("double")).select("dim", "block", "shard")
        later = materialise(self.spark, met.join(home, ["dim", "block", "shard"], "left_anti"), "pairs")
        self.pairs_met = later.count()
        return first.unionByName(self.meet(later, blocks, slices, k))


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
          shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The ``k`` rows of highest integer inner product for each query row
    (``is_query`` over ``vec_id``), ties to the smaller id: ``query_id``,
    ``rank`` from 1, ``vec_id``, ``score``.

    Defined cases: rows with a null vector, or with null or non-finite components
    (times 64, as doubles) take no part; every other row is a candidate, ids that
    repeat or are null included (null ids come last among ties, equal ids by row),
    and a row is never its own result; vectors of different dimension do not meet;
    scores beyond a long are its largest, or its smallest value but one; fewer than
    ``k`` others give all of them; an empty table gives an empty result; other
    columns are ignored.
    """
    spark = ready(vectors.sparkSession)
    index = Index(spark, vectors, id_col, vec_col, shard_rows)
    found = index.search(is_query, k, block_rows)
    place = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "number")
    named = index.rows.where(is_query).select(F.col("number").alias("query"), F.col("vec_id").alias("query_id"))
    return (
        found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
        .join(named, "query").select("query_id", "rank", "vec_id", "score")
    )
