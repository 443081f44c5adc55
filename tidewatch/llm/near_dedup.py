"""Near duplicates: MinHash bands propose pairs, odd sketches estimate them, and
whole shingle sets confirm them.

1. Each text becomes the set of its distinct word shingles.  MinHash samples of
   the set give the band keys, and the same samples folded
   into a parity bitmap (flip the bit that (sample number, sample) hashes to)
   give its odd sketch.  The XOR of two odd sketches is the odd sketch of the
   samples in which they differ, so its population count estimates a high
   similarity precisely.
2. Texts with equal sets form one class; everything below is on classes.
3. Within a bucket (a band key) every class is paired with the bucket's lowest
   and highest class only; the odd sketches pick each class's best such pair,
   and whole sets confirm it.  Confirmed links give components.
4. What is left are buckets whose classes lie in several components.  Only there,
   classes outside the component of the bucket's lowest class are compared with
   the bucket's other classes: a semi-join on the sketches drops those without a
   possible partner, and the rest meet in blocks of bounded size, in which whole
   sets are intersected by a matrix product.  A block returns a spanning forest
   of its links, so no group is ever expanded into all its pairs.

Every pair of classes that shares a bucket and passes the sketch is thus
confirmed or lies within one component already.  Bands are as many as it takes
for a pair at the threshold to share no bucket with probability ``MISSED`` at
most, and the sketch rejects it beyond six standard deviations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import (
    FILE_LINKS, FILE_ROWS, dealt_anew, dealt_in_few, in_few_files, materialise, mix, ready, row_keys, slices, text_buffer, word_hashes,
    words_per_text)
from tidewatch.llm.components import connected_components

SHINGLE_WORDS = 5
PERCENT = 80
#: Probability that a pair at the threshold shares no band, and bands at most.
MISSED, MOST_BANDS = 1e-6, 40
_MOST_ROWS = 5
SKETCH_BITS = 1024
_SKETCH_LONGS = SKETCH_BITS // 64
#: Bounds of one exact block: classes and shingles of either side.
BLOCK_CLASSES, BLOCK_SHINGLES = 400, 400_000

_rng = np.random.default_rng(20_240_517)
_ALL = MOST_BANDS * _MOST_ROWS
_MULTIPLY = (_rng.integers(0, 1 << 32, _ALL, dtype=np.uint32) | np.uint32(1)).astype(np.uint32)
_ADD = _rng.integers(0, 1 << 32, _ALL, dtype=np.uint32)
_SALT = _rng.integers(0, 1 << 63, _ALL, dtype=np.uint64)


def bands_for(percent: int) -> tuple[int, int]:
    """(rows, bands): the longest bands that miss a pair at the threshold with
    probability ``MISSED`` at most."""
    for rows in range(_MOST_ROWS, 0, -1):
        share = (percent / 100) ** rows
        bands = 1 if share >= 1 else max(1, int(np.ceil(np.log(MISSED) / np.log(1 - share))))
        if bands <= MOST_BANDS:
            return rows, bands
    raise ValueError(f"{percent} % is too low a similarity for {MOST_BANDS} bands")


def sketch_limit(percent: int) -> int:
    """Largest XOR population count that a pair at the similarity may show: the
    expectation at that similarity plus six standard deviations."""
    j = percent / 100
    rows, bands = bands_for(percent)
    samples = rows * bands
    differing = 2 * samples * (1 - j)
    mean = SKETCH_BITS / 2 * (1 - np.exp(-2 * differing / SKETCH_BITS))
    slope = np.exp(-2 * differing / SKETCH_BITS)
    spread = np.sqrt((slope * 2) ** 2 * samples * j * (1 - j) + mean)
    return int(np.ceil(mean + 6 * spread))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, joined, and their bounds.

    Shingles are ``size`` consecutive words, A-Z lower-cased; a text with fewer
    words has its whole sequence as one shingle, a text without words none.
    """
    words, starts, _ = word_hashes(data, offsets)
    bounds = words_per_text(starts, offsets)
    n_words = np.diff(bounds)
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    rolled = np.full(len(words), size, np.uint64)
    for k in range(size):
        rolled = mix(rolled * np.uint64(0x9FB21C651E98DF25) + padded[k:k + len(words)])
    out, sizes = [], np.zeros(len(n_words), np.int64)
    for t, n in enumerate(n_words):
        if n == 0:
            continue
        b = bounds[t]
        if n < size:
            h = np.full(1, n, np.uint64)
            for k in range(n):
                h = mix(h * np.uint64(0x9FB21C651E98DF25) + words[b + k])
        else:
            h = np.sort(rolled[b:b + n - size + 1])
            if len(h) > 1:
                h = h[np.concatenate([[True], h[1:] != h[:-1]])]
        out.append(h)
        sizes[t] = len(h)
    joined = np.concatenate(out) if out else np.empty(0, np.uint64)
    return joined, np.concatenate([[0], np.cumsum(sizes)])


def minhash_samples(sets: np.ndarray, bounds: np.ndarray, samples: int, window: int = 1 << 17) -> np.ndarray:
    """MinHash samples (sets x samples) of non-empty sets, joined with ``bounds``."""
    folded = (sets >> np.uint64(32)).astype(np.uint32) ^ sets.astype(np.uint32)
    n = len(bounds) - 1
    out = np.full((n, samples), 0xFFFFFFFF, np.uint32)
    t = 0
    while t < n:
        u = max(t + 1, int(np.searchsorted(bounds, bounds[t] + window, side="right")) - 1)
        part = folded[bounds[t]:bounds[u]]
        at = bounds[t:u] - bounds[t]
        for s in range(samples):
            out[t:u, s] = np.minimum.reduceat(part * _MULTIPLY[s] + _ADD[s], at)
        t = u
    return out


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps (sets x SKETCH_BITS / 64 words) of MinHash samples."""
    n = len(samples)
    out = np.zeros((n, _SKETCH_LONGS), np.uint64)
    for t in range(0, n, 2048):
        part = samples[t:t + 2048]
        bit = (mix(part.astype(np.uint64) + _SALT[:samples.shape[1]]) % np.uint64(SKETCH_BITS)).astype(np.int64)
        flat = (bit + np.arange(len(part))[:, None] * SKETCH_BITS).ravel()
        odd = (np.bincount(flat, minlength=len(part) * SKETCH_BITS) & 1).astype(np.uint8)
        out[t:t + 2048] = np.packbits(odd.reshape(len(part), SKETCH_BITS), axis=1).view(np.uint64)
    return out


def band_keys(samples: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` samples; the band number is part of it."""
    bands = samples.shape[1] // rows
    out = np.empty((len(samples), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(samples), b + 1, np.uint64)
        for r in range(rows):
            h = mix(h * np.uint64(0x9FB21C651E98DF25) + samples[:, b * rows + r])
        out[:, b] = h
    return out


def _lists(values: np.ndarray, valid: np.ndarray) -> pa.Array:
    """Rows of ``values`` as array<long>, null where not ``valid``."""
    width = values.shape[1]
    offsets = np.concatenate([[0], np.cumsum(np.where(valid, width, 0))]).astype(np.int32)
    flat = pa.array(values[valid].view(np.int64).ravel(), pa.int64())
    return pa.ListArray.from_arrays(pa.array(offsets), flat, mask=pa.array(~valid))


def _signatures(size: int, percent: int):
    rows, bands = bands_for(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        for whole in batches:
            for batch in slices(whole, "text"):
                data, offsets = text_buffer(batch.column(3))
                sets, bounds = shingle_sets(data, offsets, size)
                sizes = np.diff(bounds)
                some = sizes > 0
                samples = np.zeros((len(sizes), rows * bands), np.uint32)
                if some.any():
                    samples[some] = minhash_samples(sets, np.concatenate([[0], bounds[1:][some]]), rows * bands)
                digests = [hashlib.blake2b(sets[bounds[t]:bounds[t + 1]].tobytes(), digest_size=16).digest()
                           if sizes[t] else None for t in range(len(sizes))]
                uid = (part << 40) + row + np.arange(len(sizes), dtype=np.int64)
                row += len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid, pa.int64()), batch.column(0), batch.column(1), batch.column(2),
                     pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                     _lists(band_keys(samples, rows), some), _lists(odd_sketches(samples), some)],
                    names=["uid", "doc_id", "key_a", "key_b", "n_shingles", "set_hash", "bands", "sketch"])
    return run


def _sets_of_texts(size: int):
    """(node, text) -> (node, sorted shingle hashes as bytes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                data, offsets = text_buffer(batch.column(1))
                sets, bounds = shingle_sets(data, offsets, size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0),
                     pa.array([sets[bounds[t]:bounds[t + 1]].tobytes() for t in range(batch.num_rows)], pa.binary())],
                    names=["node", "shingles"])
    return run


def _confirm(size: int, percent: int):
    """(a, b, text of a, text of b) -> the pairs whose whole sets are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text_b", 4 << 20):
                left, lb = shingle_sets(*text_buffer(batch.column(2)), size)
                right, rb = shingle_sets(*text_buffer(batch.column(3)), size)
                ok = np.zeros(batch.num_rows, bool)
                for t in range(batch.num_rows):
                    x, y = left[lb[t]:lb[t + 1]], right[rb[t]:rb[t + 1]]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok[t] = 100 * both >= percent * (len(x) + len(y) - both)
                keep = pa.array(ok)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])
    return run


def links_in_block(nodes: np.ndarray, comps: np.ndarray, sets: list[np.ndarray], left: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between ``left`` and all sets of a block,
    classes of one component taken as joined already."""
    sizes = np.array([len(s) for s in sets])
    order, flat = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    shared = np.zeros((int(left.sum()), len(sets)), np.float32)
    rows = np.flatnonzero(left)
    position = np.full(len(sets), -1)
    position[rows] = np.arange(len(rows))
    step = max(1, (4 << 20) // max(1, len(sets)))
    for lo in range(0, len(order), step):
        inside = (flat >= lo) & (flat < lo + step)
        m = np.zeros((len(sets), min(step, len(order) - lo)), np.float32)
        m[owner[inside], flat[inside] - lo] = 1
        shared += m[rows] @ m.T
    union = sizes[rows][:, None] + sizes[None, :] - shared
    linked = (100 * shared >= percent * union) & (comps[rows][:, None] != comps[None, :])
    root = {c: c for c in comps.tolist()}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    out = []
    for i, j in zip(*np.nonzero(linked)):
        x, y = find(int(comps[rows[i]])), find(int(comps[j]))
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((int(nodes[rows[i]]), int(nodes[j])))
    return out


def _exact_blocks(percent: int):
    def run(table: pa.Table) -> pa.Table:
        nodes = table["node"].to_numpy()
        # a class may stand on both sides of a block; the left side wins
        left = table["is_left"].to_numpy(zero_copy_only=False)
        order = np.lexsort((~left, nodes))
        first = np.concatenate([[True], nodes[order][1:] != nodes[order][:-1]])
        order = order[first]
        sets = [np.frombuffer(table["shingles"][int(i)].as_py(), np.uint64) for i in order]
        found = links_in_block(nodes[order], table["comp"].to_numpy()[order], sets, left[order], percent)
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})
    return run


def _differing(x: str, y: str) -> Column:
    """Population count of the XOR of two odd sketches."""
    return reduce(lambda s, c: s + c, [F.bit_count(F.col(x)[i].bitwiseXOR(F.col(y)[i])) for i in range(_SKETCH_LONGS)])


def _possible(n_x: str, n_y: str, x: str, y: str, percent: int) -> Column:
    """Sizes allow the similarity, and so do the sketches."""
    return ((100 * F.least(F.col(n_x), F.col(n_y)) >= percent * F.greatest(F.col(n_x), F.col(n_y)))
            & (_differing(x, y) <= sketch_limit(percent)))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """Components of documents linked by ``100 * |A & B| >= percent * |A | B|``
    on their sets of ``words``-word shingles.

    One row per input row: ``uid`` (a number of the row within this result),
    ``key_a`` and ``key_b`` (hashes of the row's id and text), ``doc_id``,
    ``n_shingles``, ``component_id`` (smallest id of the component) and ``kept``
    (the one row of the component that stays: smallest id, then lowest uid).

    Defined cases: null and empty texts, or texts of white space, have an empty
    set, link with nothing and stay; rows with a null id take part, come last
    among ids, and stand in a component of null id if it has no other; repeated
    rows are one class and one copy stays; an empty table gives an empty
    result; other columns are ignored, whatever their names.
    """
    spark = ready(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    keyed = source.select("doc_id", *row_keys("doc_id", "text"), "text")
    schema = T.StructType([
        T.StructField("uid", T.LongType()), T.StructField("doc_id", source.schema["doc_id"].dataType),
        T.StructField("key_a", T.LongType()), T.StructField("key_b", T.LongType()),
        T.StructField("n_shingles", T.LongType()), T.StructField("set_hash", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("sketch", T.ArrayType(T.LongType()))])
    signed = materialise(spark, keyed.mapInArrow(_signatures(words, percent), schema), "signatures")
    n = signed.count()

    classes = signed.where("n_shingles > 0").groupBy("set_hash").agg(F.min("uid").alias("node"))
    # one row per class, with the row it comes from
    members = materialise(spark, in_few_files(
        signed.join(classes.select(F.col("node").alias("uid")), "uid", "left_semi")
        .select(F.col("uid").alias("node"), "key_a", "key_b", "n_shingles", "bands", "sketch"), n, FILE_ROWS), "classes")
    edges = _links(spark, keyed, members, words, percent)
    component = connected_components(spark, edges)

    of_class = classes.join(component, "node", "left").select("set_hash", F.coalesce("comp", "node").alias("comp"))
    placed = (
        signed.select("uid", "doc_id", "key_a", "key_b", "n_shingles", "set_hash")
        .join(of_class, "set_hash", "left").withColumn("comp", F.coalesce("comp", "uid"))
    )
    placed = materialise(spark, in_few_files(placed, n, FILE_ROWS), "placed")
    mine = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "uid")
    best = placed.groupBy("comp").agg(F.min(mine).alias("best"), F.count(F.lit(1)).alias("n"))
    return placed.join(dealt_anew(best.where("n > 1").drop("n")), "comp", "left").withColumn("best", F.coalesce("best", mine)).select(
        "uid", "key_a", "key_b", "doc_id", "n_shingles", F.col("best.doc_id").alias("component_id"),
        (F.col("uid") == F.col("best.uid")).alias("kept"))


def _texts(spark: SparkSession, keyed: DataFrame, members: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) of the classes in ``nodes``, read again from the documents."""
    wanted = nodes.join(members.select("node", "key_a", "key_b"), "node")
    found = keyed.select("key_a", "key_b", "text").join(wanted, ["key_a", "key_b"]).select("node", "text")
    # a repeated document row matches more than once, with the same text
    return materialise(spark, in_few_files(found.dropDuplicates(["node"]), members.count(), FILE_ROWS), "texts")


def _links(spark: SparkSession, keyed: DataFrame, members: DataFrame, words: int, percent: int) -> DataFrame:
    """Links between classes that join every component (not all links)."""
    banded = members.select("node", F.explode("bands").alias("bucket"))
    centres = banded.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    n = members.count() * bands_for(percent)[1]
    bucketed = materialise(spark, in_few_files(banded.join(dealt_anew(centres), "bucket"), n, FILE_LINKS), "buckets")
    n = bucketed.count()

    # each class with its most promising low or high neighbour
    stars = (
        bucketed.select(F.col("low").alias("a"), F.col("node").alias("b")).where("a <> b")
        .unionByName(bucketed.select(F.col("high").alias("a"), F.col("node").alias("b")).where("a <> b"))
        .distinct()
    )
    left = members.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("sketch").alias("s_a"))
    right = members.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("sketch").alias("s_b"))
    judged = (
        stars.join(left, "a").join(right, "b").where(_possible("n_a", "n_b", "s_a", "s_b", percent))
        .select("a", "b", _differing("s_a", "s_b").alias("differing"))
    )
    best = materialise(spark, in_few_files(
        judged.groupBy("b").agg(F.min(F.struct("differing", "a")).alias("m")).select(F.col("m.a").alias("a"), "b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), members.count(), FILE_LINKS), "stars")
    # one reading of the texts serves both confirmations
    texts = _texts(spark, keyed, members, bucketed.select("node").distinct())
    proposed = (
        best.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        .join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        .select("a", "b", "text_a", "text_b")
    )
    confirmed = proposed.mapInArrow(_confirm(words, percent), "a long, b long")
    first = materialise(spark, dealt_in_few(confirmed, best.count(), FILE_LINKS), "links")
    comp = connected_components(spark, first)

    # buckets whose classes lie in several components
    labelled = (
        bucketed.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        .join(comp.select(F.col("node").alias("low"), F.col("comp").alias("low_comp")), "low", "left")
        .withColumn("low_comp", F.coalesce("low_comp", "low"))
        .select("bucket", "node", "comp", (F.col("comp") != F.col("low_comp")).alias("apart"))
    )
    labelled = materialise(spark, in_few_files(labelled, n, FILE_LINKS), "labelled")
    open_buckets = dealt_anew(labelled.where("apart").select("bucket").distinct())
    described = (
        labelled.join(open_buckets, "bucket", "left_semi")
        .join(members.select("node", "n_shingles", "sketch"), "node")
    )
    described = materialise(spark, in_few_files(described, n, FILE_LINKS), "open")
    n = described.count()
    apart = described.where("apart").select(
        "bucket", F.col("node").alias("node_x"), F.col("comp").alias("comp_x"), F.col("n_shingles").alias("n_x"), F.col("sketch").alias("s_x"))
    others = described.select(
        "bucket", F.col("node").alias("node_y"), F.col("comp").alias("comp_y"), F.col("n_shingles").alias("n_y"), F.col("sketch").alias("s_y"))
    meet = ["bucket"]

    def matched(x: DataFrame, y: DataFrame) -> DataFrame:
        x, y = x.alias("x"), y.alias("y")
        on = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("comp_x") != F.col("comp_y")) & _possible("n_x", "n_y", "s_x", "s_y", percent)
        return x.join(y, on, "left_semi")

    lefts = matched(apart, others).select(*meet, F.col("node_x").alias("node"), F.col("comp_x").alias("comp"), F.col("n_x").alias("n"))
    rights = matched(others, apart).select(*meet, F.col("node_y").alias("node"), F.col("comp_y").alias("comp"), F.col("n_y").alias("n"))
    lefts, rights = (materialise(spark, dealt_in_few(side, n, FILE_LINKS), name) for side, name in ((lefts, "lefts"), (rights, "rights")))

    def parts(side: DataFrame, name: str) -> DataFrame:
        return side.groupBy("bucket").agg(F.greatest(
            F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias(name))

    counts = dealt_anew(parts(lefts, "n_left").join(parts(rights, "n_right"), "bucket"))

    def dealt(side: DataFrame, own: str, other: str, is_left: bool) -> DataFrame:
        one = F.pmod(F.xxhash64("node"), F.col(own)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        i, j = (one, every) if is_left else (every, one)
        return (side.join(counts, "bucket").withColumn("i", i).withColumn("j", j)
                .select("bucket", "i", "j", "node", "comp", F.lit(is_left).alias("is_left")))

    wanted = lefts.select("node").unionByName(rights.select("node")).distinct()
    sets = texts.join(wanted, "node", "left_semi").mapInArrow(_sets_of_texts(words), "node long, shingles binary")
    blocks = (
        dealt(lefts, "n_left", "n_right", True).unionByName(dealt(rights, "n_right", "n_left", False))
        .join(sets, "node")
    )
    second = blocks.groupBy("bucket", "i", "j").applyInArrow(_exact_blocks(percent), "a long, b long")
    return first.unionByName(materialise(spark, in_few_files(second.distinct(), n, FILE_LINKS), "more-links"))
