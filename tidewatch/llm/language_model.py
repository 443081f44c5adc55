"""Language-model scores: a hashed maximum-entropy model with a class-factored
softmax, trained by distributed gradient updates.

A token's probability is that of its class in its context times that of the
token in its class.  Classes are the end of a text, the ``HEAD`` most frequent
words (one each), and ``TAILS`` classes of all other words by their last bytes.
The class softmax has hashed features of the context: the word before, the pair
of words before, and skips to the second and third word before (rare words stand
as their class).  Inside a tail class a word has one feature, itself: the
maximum-entropy solution is its smoothed share of the class's corpus counts, and one
more event stands for all unseen words.

Everything is learned from all training texts:

* word counts by one aggregate, pre-summed in tasks;
* the softmax first from the counts of (feature, class) pairs over all tokens,
  then by ``ROUNDS`` gradient updates: every task sums what the current weights
  expect of each (feature, class) over all its tokens, the sums are added up in a
  tree, and the weights move by the difference to the counts, scaled by the
  curvature of the likelihood.

All of it is sums over tokens, so the model and its scores do not depend on how the
texts are partitioned (but for rounding: less than 1e-4 a token).  The numbers of
weight slots and of context words grow with the square root of the training tokens
(:func:`sizes`); the weights are broadcast, 256 bytes a slot: 8 MB for 100 million
tokens, 64 MB for 7 billion.  The word counts grow with the corpus and are not
broadcast: documents are dealt into chunks by hash, each chunk asks for the counts of
its distinct words by a join, and is scored with those.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import collapse_hot, expand_copies, lowest_per_group, materialise, mix, ready, slices, text_buffer, word_hashes, words_per_text

HEAD, TAILS = 31, 32
CLASSES = 1 + HEAD + TAILS
#: Weight slots and context words (features of their own) at least.
LEAST_SLOT_BITS, LEAST_CONTEXT = 13, 1 << 12
FEATURES = 4
#: Gradient rounds over all tokens, and how far one goes along its scaled gradient.
ROUNDS, RATE = 1, 1.25
#: Counts that a slot is given beforehand, in the shares of the classes.
PRIOR = 20
#: Bounds of a weight and of its change in a round.
LARGEST, STEP = 15.0, 1.25
#: Weight slots in one row of a sum, and rows summed in one group.
_ROW_SLOTS, _FAN = 512, 32
#: Tokens whose expectations are summed at a time, and slots that are updated at a time.
_SUMMED, _TOKENS = 4096, 4096
#: Rows of a slot, at most, that are added up together with those of other slots.
_FEW = 8
#: Bytes of text in a chunk, about.
CHUNK_BYTES = 8 << 20
_COUNT_BYTES = 12 << 20
_END = 0
#: Odd factors that hash a feature's value into its slot.
_FEATURE_HASH = [np.uint64(pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64)) for k in range(FEATURES)]


def sizes(tokens: int) -> tuple[int, int]:
    """(bits of a weight slot, context words) for so many training tokens: about
    twice their square root in slots, and a context word for every four."""
    bits = max(LEAST_SLOT_BITS, math.ceil(math.log2(2 * math.sqrt(max(1, tokens)))))
    return bits, max(LEAST_CONTEXT, (1 << bits) // 4)


def tail_class(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Class of each word by its last two bytes (A-Z lower-cased)."""
    def lower(b: np.ndarray) -> np.ndarray:
        return np.where((b >= 65) & (b <= 90), b + 32, b).astype(np.uint64)
    last = lower(data[ends - 1])
    second = np.where(ends - starts > 1, lower(data[np.maximum(ends - 2, 0)]), np.uint64(0))
    return (1 + HEAD + (mix(last * np.uint64(256) + second) % np.uint64(TAILS))).astype(np.int64)


class Vocabulary:
    """The context words by hash, for array lookups: a word stands in the table of
    the first 16-bit field of its hash that no more frequent word has taken, or else
    in a sorted list."""

    def __init__(self, hashes: np.ndarray, slot_bits: int = LEAST_SLOT_BITS, words: int = LEAST_CONTEXT):
        """``hashes`` in order of frequency: a word's place is its rank."""
        self.slot_bits, self.words = slot_bits, words
        self.tables: list[tuple[np.ndarray, np.ndarray]] = []
        left, shift = np.arange(len(hashes)), 48
        while len(left) and shift >= 0:
            field = (hashes[left] >> np.uint64(shift)) & np.uint64(0xFFFF)
            _, first = np.unique(field, return_index=True)
            keys, ranks = np.zeros(1 << 16, np.uint64), np.full(1 << 16, words, np.int32)
            keys[field[first]], ranks[field[first]] = hashes[left[first]], left[first]
            self.tables.append((keys, ranks))
            left, shift = np.delete(left, first), shift - 16
        order = np.argsort(hashes[left])
        self.rest, self.rest_ranks = hashes[left][order], left[order].astype(np.int32)

    @property
    def slots(self) -> int:
        return 1 << self.slot_bits

    @property
    def edge(self) -> int:
        """What stands before a text."""
        return self.words + CLASSES

    def rank(self, words: np.ndarray) -> np.ndarray:
        """Rank of each word, ``words`` where it is not a context word."""
        out = np.full(len(words), self.words, np.int32)
        for k, (keys, ranks) in enumerate(self.tables):
            field = ((words >> np.uint64(48 - 16 * k)) & np.uint64(0xFFFF)).astype(np.int64)
            hit = (keys[field] == words) & (ranks[field] < self.words)
            out[hit] = ranks[field[hit]]
        if len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, words), len(self.rest) - 1)
            hit = self.rest[at] == words
            out[hit] = self.rest_ranks[at[hit]]
        return out


def read_tokens(data: np.ndarray, offsets: np.ndarray, frequent: Vocabulary):
    """Tokens of the joined texts: (word hashes, word bounds per text, class of
    each token, feature slots of each token, position of each word's token).

    A text's tokens are its words and one end; tokens of all texts follow each
    other."""
    words, starts, ends = word_hashes(data, offsets)
    bounds = words_per_text(starts, offsets)
    n_texts = len(bounds) - 1
    tails = tail_class(data, starts, ends)
    rank = frequent.rank(words)
    of_text = np.repeat(np.arange(n_texts), np.diff(bounds))
    at = np.arange(len(words)) + of_text
    total = len(words) + n_texts
    kind = np.full(total, _END)
    kind[at] = np.where(rank < HEAD, 1 + rank, tails)
    # what a token is as a context: an end stands before the first text, and hides what came before it
    edge = np.uint64(frequent.edge)
    unit = np.full(total + 3, edge, np.uint64)
    unit[at + 3] = np.where(rank < frequent.words, rank, frequent.words + tails)
    one, two, three = unit[2:2 + total], unit[1:1 + total], unit[:total]
    two = np.where(one == edge, edge, two)
    three = np.where(two == edge, edge, three)
    slots = np.empty((total, FEATURES), np.int64)
    for k, value in enumerate((one, two, three, (one << np.uint64(32)) + two + np.uint64(1 << 60))):
        slots[:, k] = (value * _FEATURE_HASH[k]) >> np.uint64(64 - frequent.slot_bits)
    return words, bounds, kind, slots, at


def logits(weights: np.ndarray, bias: np.ndarray, slots: np.ndarray) -> np.ndarray:
    z = np.take(weights, slots[:, 0], axis=0)
    for k in range(1, FEATURES):
        z += np.take(weights, slots[:, k], axis=0)
    z += bias
    return z


def _row_sums(z: np.ndarray) -> np.ndarray:
    """The sum of each row, in less time than ``z.sum(axis=1)`` (no matrix product,
    whose library would start threads in every task)."""
    return np.einsum("ij->i", z)


def class_probabilities(weights: np.ndarray, bias: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Softmax over the classes; weights within ``LARGEST`` cannot overflow it."""
    z = logits(weights, bias, slots)
    np.exp(z, out=z)
    z /= _row_sums(z)[:, None]
    return z


def class_scores(weights: np.ndarray, bias: np.ndarray, slots: np.ndarray, kind: np.ndarray, step: int = 2048) -> np.ndarray:
    """log P(class | context) of every token."""
    out = np.empty(len(kind))
    for lo in range(0, len(kind), step):
        z = logits(weights, bias, slots[lo:lo + step])
        own = z[np.arange(len(z)), kind[lo:lo + step]]
        np.exp(z, out=z)
        out[lo:lo + step] = own - np.log(_row_sums(z))
    return out


def _segment_sums(rows: np.ndarray, order: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Sums of ``rows[order]`` over the stretches that begin at ``heads``: short
    stretches are added up row by row, all of them at once, long ones one by one."""
    sizes = np.diff(np.append(heads, len(order)))
    out = np.take(rows, order[heads], axis=0)
    short = np.flatnonzero((sizes > 1) & (sizes <= _FEW))
    for k in range(1, _FEW):
        out[short] += np.take(rows, order[heads[short] + k], axis=0)
        short = short[sizes[short] > k + 1]
    for k in np.flatnonzero(sizes > _FEW):
        out[k] = np.take(rows, order[heads[k]:heads[k] + sizes[k]], axis=0).sum(axis=0)
    return out


def add_expected(expected: np.ndarray, weights: np.ndarray, bias: np.ndarray, slots: np.ndarray) -> None:
    """Add to ``expected`` (slots x classes) how often the weights expect each class
    with each slot of the tokens, some tokens at a time, as the caches hold them."""
    # short keys sort by radix
    keys = slots.astype(np.uint16 if len(weights) <= 1 << 16 else np.int32)
    for lo in range(0, len(slots), _SUMMED):
        share = class_probabilities(weights, bias, slots[lo:lo + _SUMMED])
        for k in range(FEATURES):
            key = keys[lo:lo + _SUMMED, k]
            order = np.argsort(key, kind="stable")
            key = key[order]
            heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            expected[key[heads]] += _segment_sums(share, order, heads)


def _by_slots(shape: tuple[int, int], fill) -> np.ndarray:
    """A float32 table filled some slots at a time, to bound the working arrays."""
    out = np.empty(shape, np.float32)
    for lo in range(0, shape[0], _TOKENS):
        out[lo:lo + _TOKENS] = fill(slice(lo, lo + _TOKENS))
    return out


def first_weights(seen: np.ndarray, share: np.ndarray) -> np.ndarray:
    """What each feature's counts say beyond the shares of the classes, as one of
    ``FEATURES`` that say it."""
    def fill(at: slice) -> np.ndarray:
        told = (seen[at] + PRIOR * share) / (seen[at].sum(axis=1, keepdims=True, dtype=np.float64) + PRIOR)
        return (np.log(told) - np.log(share)) / (FEATURES / 1.5)
    return _by_slots(seen.shape, fill)


def updated(weights: np.ndarray, seen: np.ndarray, expected: np.ndarray, share: np.ndarray) -> np.ndarray:
    """The weights after a step along the gradient (seen - expected), scaled by the
    curvature of the likelihood in each weight."""
    def fill(at: slice) -> np.ndarray:
        total = np.maximum(seen[at].sum(axis=1, keepdims=True, dtype=np.float64), 1)
        curve = np.maximum(expected[at] * (1 - expected[at] / total), 0) + PRIOR * share
        step = np.clip(RATE * (seen[at].astype(np.float64) - expected[at]) / curve / FEATURES, -STEP, STEP)
        return np.clip(weights[at] + step, -LARGEST, LARGEST)
    return _by_slots(seen.shape, fill)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text", _COUNT_BYTES):
            data, offsets = text_buffer(batch.column(0))
            words, starts, ends = word_hashes(data, offsets)
            kinds, first, counts = np.unique(words, return_index=True, return_counts=True)
            tails = tail_class(data, starts[first], ends[first]) if len(words) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(tails, pa.int32()), pa.array(counts, pa.int64())],
                                             names=["word", "tail", "n"])


def _pack(part: int, table: np.ndarray) -> pa.RecordBatch:
    """Rows (block, part, values) of a slots x classes table."""
    blocks = range(len(table) // _ROW_SLOTS)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(blocks), pa.int32()), pa.array([part] * len(blocks), pa.int32()),
         pa.array([table[b * _ROW_SLOTS:(b + 1) * _ROW_SLOTS].astype(np.float32).tobytes() for b in blocks], pa.binary())],
        names=["block", "part", "vals"])


def _observe(frequent):
    """Counts of (slot, class) over all tokens of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = frequent.value.slots * CLASSES
        counts = np.zeros(size)
        for whole in batches:
            for batch in slices(whole, "text"):
                _, _, kind, slots, _ = read_tokens(*text_buffer(batch.column(0)), frequent.value)
                for k in range(FEATURES):
                    counts += np.bincount(slots[:, k] * CLASSES + kind, minlength=size)
        if counts.any():
            yield _pack(TaskContext.get().partitionId(), counts.reshape(-1, CLASSES))
    return run


def _expect(shared, frequent):
    """What the weights expect of (slot, class) over all tokens of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        expected = np.zeros(weights.shape, np.float32)
        for whole in batches:
            for batch in slices(whole, "text"):
                _, _, _, slots, _ = read_tokens(*text_buffer(batch.column(0)), frequent.value)
                add_expected(expected, weights, bias, slots)
        if expected.any():
            yield _pack(TaskContext.get().partitionId(), expected)
    return run


def _add(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(v.as_py(), np.float32).astype(np.float64) for v in table["vals"])
    return pa.table({"block": table["block"].slice(0, 1), "part": table["up"].slice(0, 1), "vals": pa.array([total.astype(np.float32).tobytes()], pa.binary())})


def summed(rows: DataFrame, slots: int, parts: int) -> np.ndarray:
    """The slots x classes sum of the tables of ``parts`` tasks.  Groups of
    ``_FAN`` are summed at a time, so no task sees more; the driver gets the sum
    alone."""
    while parts > 1:
        rows = (rows.withColumn("up", F.floor(F.col("part") / _FAN).cast("int")).groupBy("block", "up")
                .applyInArrow(_add, "block int, part int, vals binary"))
        parts = -(-parts // _FAN)
    out = np.zeros((slots, CLASSES), np.float32)
    for r in rows.select("block", "vals").toLocalIterator():          # slots / _ROW_SLOTS rows
        out[r["block"] * _ROW_SLOTS:(r["block"] + 1) * _ROW_SLOTS] += np.frombuffer(r["vals"], np.float32).reshape(_ROW_SLOTS, CLASSES)
    return out


@dataclass
class LanguageModel:
    frequent: Vocabulary
    weights: np.ndarray
    bias: np.ndarray
    tokens: int                     # N: training tokens
    kinds: int                      # V: distinct ones
    ends: int                       # training texts
    class_tokens: np.ndarray        # counts inside each class
    class_kinds: np.ndarray


def fit_language_model(docs: DataFrame, training: Column | None = None, text_col: str = "text") -> tuple[LanguageModel, DataFrame]:
    """The model and the table of word counts (``word`` hash, ``n``), from all
    training texts."""
    spark = ready(docs.sparkSession)
    rows = docs if training is None else docs.where(training)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = rows.select(text.alias("text"))
    counts = materialise(spark, (
        texts.mapInArrow(_count_words, "word long, tail int, n long")
        .groupBy("word").agg(F.min("tail").alias("tail"), F.sum("n").alias("n"))), "words")
    ends = texts.count()
    n_words = counts.agg(F.sum("n")).first()[0] or 0
    slot_bits, n_context = sizes(n_words + ends)
    first = lowest_per_group(counts.select("*", (-F.col("n")).alias("down"), F.lit(0).alias("all")), "all", ["down", "word"], n_context)
    top = first.orderBy("down", "word").select("word", "n", "tail").collect()            # n_context rows
    frequent = Vocabulary(np.array([r["word"] for r in top], np.int64).view(np.uint64), slot_bits, n_context)
    class_tokens, class_kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in counts.groupBy("tail").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).collect():     # TAILS rows
        class_tokens[r["tail"]], class_kinds[r["tail"]] = r["n"], r["k"]
    for rank, r in enumerate(top[:HEAD]):
        class_tokens[1 + rank], class_kinds[1 + rank] = r["n"], 1
        class_tokens[r["tail"]] -= r["n"]
        class_kinds[r["tail"]] -= 1
    class_tokens[_END], class_kinds[_END] = ends, ends > 0
    tokens, kinds = int(class_tokens.sum()), int(class_kinds.sum())

    sc = spark.sparkContext
    shared = sc.broadcast(frequent)
    share = (class_tokens + 1) / (class_tokens.sum() + CLASSES)
    bias = np.log(share).astype(np.float32)
    schema = "block int, part int, vals binary"
    parts = texts.rdd.getNumPartitions()
    seen = summed(texts.mapInArrow(_observe(shared), schema), frequent.slots, parts)
    weights = first_weights(seen, share)
    for _ in range(ROUNDS):
        state = sc.broadcast((weights, bias))
        weights = updated(weights, seen, summed(texts.mapInArrow(_expect(state, shared), schema), frequent.slots, parts), share)
    model = LanguageModel(frequent, weights, bias, tokens, kinds, ends, class_tokens, class_kinds)
    return model, counts.select("word", "n")


def _distinct_words(table: pa.Table) -> pa.Table:
    data, offsets = text_buffer(table["text"].combine_chunks())
    words = np.unique(word_hashes(data, offsets)[0])
    chunk = table["chunk"][0].as_py()
    return pa.table({"chunk": pa.array(np.full(len(words), chunk), pa.int64()), "word": pa.array(words.view(np.int64))})


def score_texts(model: LanguageModel, data: np.ndarray, offsets: np.ndarray, known: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Scores of texts; ``known`` are sorted word hashes with their ``counts``."""
    words, bounds, kind, slots, at = read_tokens(data, offsets, model.frequent)
    n_texts = len(bounds) - 1
    c = np.zeros(len(kind))
    if len(known):
        found = np.minimum(np.searchsorted(known, words), len(known) - 1)
        c[at] = np.where(known[found] == words, counts[found], 0)
    is_end = kind == _END
    c[is_end] = model.ends
    base = np.log10((c + 1) / (model.tokens + 1.0 * (model.kinds + 1)))
    inside = np.where(kind > HEAD, np.log((c + 1) / (model.class_tokens + model.class_kinds + 1)[kind]), 0.0)
    score = (class_scores(model.weights, model.bias, slots, kind) + inside) / np.log(10)
    heads = bounds[:-1] + np.arange(n_texts)
    if not n_texts:
        return {"n_tokens": np.empty(0, np.int64), "n_known": np.empty(0, np.int64), "base_score": np.empty(0), "score": np.empty(0)}
    return {"n_tokens": np.diff(bounds) + 1, "n_known": np.add.reduceat((c > 0).astype(np.int64), heads),
            "base_score": np.add.reduceat(base, heads), "score": np.add.reduceat(score, heads)}


def _score(shared):
    def run(texts: pa.Table, words: pa.Table) -> pa.Table:
        if texts.num_rows == 0:
            return pa.table({"doc_id": texts["doc_id"], "__copies": texts["__copies"], **{n: pa.array([], t) for n, t in (
                ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()))}})
        known = words["word"].to_numpy().view(np.uint64)
        order = np.argsort(known)
        known, counts = known[order], words["n"].to_numpy()[order]
        out = []
        for batch in texts.combine_chunks().to_batches():
            for part in slices(batch, "text", 4 << 20):
                got = score_texts(shared.value, *text_buffer(part.column(part.schema.names.index("text"))), known, counts)
                out.append(pa.table({**{c: part.column(part.schema.names.index(c)) for c in ("doc_id", "__copies")}, **{k: pa.array(v) for k, v in got.items()}}))
        return pa.concat_tables(out)
    return run


def language_model_scores(docs: DataFrame, training: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the ``training`` rows and score every whole text: ``doc_id``,
    ``n_tokens``, ``n_known`` (tokens with a count), ``train_tokens``,
    ``base_score`` (add-one unigrams) and ``score`` (this model), both log10
    probabilities of the text and its end.

    Defined cases: null and empty texts are their end alone; without training
    rows all counts are 0 and the classes equally likely; every row, repeated
    ones and null ids too, is returned once; an empty table gives an empty
    result; texts of any length are scored whole; other columns are ignored, whatever
    their names.  How rows are partitioned changes a score by less than 1e-4 a token.
    """
    spark = ready(docs.sparkSession)
    model, counts = fit_language_model(docs, training, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-size // CHUNK_BYTES))
    # copies of one row would all fall into one chunk
    dealt = collapse_hot(rows, "doc_id", ["doc_id", "text"]).withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))
    asked = dealt.groupBy("chunk").applyInArrow(_distinct_words, "chunk long, word long")
    answered = asked.join(counts, "word").select("chunk", "word", "n")
    shared = spark.sparkContext.broadcast(model)
    out = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("__copies", T.LongType()), T.StructField("n_tokens", T.LongType()),
                        T.StructField("n_known", T.LongType()), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])
    scored = dealt.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(_score(shared), out)
    return expand_copies(scored).withColumn("train_tokens", F.lit(model.tokens).cast("long"))
