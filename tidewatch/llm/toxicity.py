"""Toxicity by class-conditional Kneser-Ney language models.

Two bigram models, of toxic and of ordinary texts, give every word a
probability.  Each interpolates discounted bigram counts of its class with
continuation counts of its class, and those with continuation counts that both
classes share, so an expression that is rare in either class is judged by what
both have seen of it and says little.  A text's score compares the two
log-likelihoods, normalised by length; a logistic curve, fitted on sample texts
that the counts have not seen, turns the comparison into 0 to 1.

Three of the five comparisons look at words that speak strongly for toxicity alone
(log ratio above ``STRONG``): their sum per word and per square root of the number of
words, and the logarithm of the sum, which is not normalised by length.  A few such
words in a long text would vanish in the whole text's mean.

The model is fitted on a bounded sample of labelled documents, one text per id: for
each label, ``PER_LABEL`` documents with texts of at most ``SAMPLE_CHARS`` characters,
in the order of their ids' hashes; where there are fewer, the shortest longer ones
follow, as long as the label's texts stay below ``PER_LABEL * SAMPLE_CHARS`` characters
together.  Every text is scored whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import PUNCTUATION, lowest_per_group, map_texts, mix, text_buffer, word_hashes, words_per_text

PER_LABEL, SAMPLE_CHARS = 3000, 20_000
#: Counts taken from a class's expressions for its backoff, and from continuation
#: counts for unknown words.
DISCOUNT, KN_DISCOUNT = 0.75, 0.75
#: Expressions in fewer texts than these shares of the rarer label's texts (and
#: ``LEAST_TEXTS``) are rare; the curve's texts choose among the shares.
RARE_SHARES, LEAST_TEXTS = (0.005, 0.01, 0.02, 0.04, 0.08), 3
#: Log ratio from which a word speaks strongly.
STRONG = 3.5
#: Share of the sample kept from the counts for the logistic curve: one in so many.
CURVE_SHARE = 4
_START = np.uint64(0x5851F42D4C957F2D)


def hashed_texts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' words (between white space and punctuation) and each
    text's bounds."""
    data, offsets = text_buffer(pa.array([t or "" for t in texts], pa.large_string()))
    words, starts, _ = word_hashes(data, offsets, breaks=PUNCTUATION)
    return words, words_per_text(starts, offsets)


def _contexts(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[bounds[:-1][np.diff(bounds) > 0]] = _START
    return before


def _pair(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix(before * np.uint64(0x9FB21C651E98DF25) + words)


def _find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Positions in a sorted table; its length where absent."""
    if not len(table):
        return np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, len(table))


@dataclass
class ToxicityModel:
    words: np.ndarray           # sorted word hashes
    unigram: np.ndarray         # words + 1 x 2: smoothed class unigrams; the last row is of unknown words
    backoff: np.ndarray         # words + 1 x 2: weight of the unigram after this word
    pairs: np.ndarray           # sorted bigram hashes
    bigram: np.ndarray          # pairs + 1 x 2: discounted bigram probabilities; the last row is 0
    curve: np.ndarray           # logistic weights: constant, then of each comparison
    scale: np.ndarray           # means and deviations of the comparisons

    def comparisons(self, words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Per text: the log-likelihood difference of the two classes per word and
        per square root of the number of words, the same of the words alone that
        speak strongly for toxicity, and the logarithm of their sum."""
        before = _contexts(words, bounds)
        at, ahead = _find(self.words, words), _find(self.words, before)
        pair = np.full(len(words), len(self.pairs))
        both = np.flatnonzero(at < len(self.words))
        pair[both] = _find(self.pairs, _pair(before[both], words[both]))
        p = self.bigram[pair] + self.backoff[ahead] * self.unigram[at]
        ratio = np.log(p[:, 1] / p[:, 0])
        n = np.diff(bounds)
        sums = np.concatenate([[0.0], np.cumsum(ratio)])
        total = sums[bounds[1:]] - sums[bounds[:-1]]
        strong = np.concatenate([[0.0], np.cumsum(np.where(ratio > STRONG, ratio, 0))])
        high = strong[bounds[1:]] - strong[bounds[:-1]]
        size = np.maximum(n, 1)
        return np.stack([total / size, total / np.sqrt(size), high / size, high / np.sqrt(size), np.log1p(high)], axis=1)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        x = (self.comparisons(*hashed_texts(texts)) - self.scale[0]) / self.scale[1]
        return 1 / (1 + np.exp(-np.clip(self.curve[0] + x @ self.curve[1:], -30, 30)))


def _in_texts(keys: np.ndarray, of_text: np.ndarray, n: int) -> np.ndarray:
    """In how many texts each of the keys 0..n-1 occurs."""
    order = np.lexsort((of_text, keys))
    k, t = keys[order], of_text[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (t[1:] != t[:-1])
    return np.bincount(k[new], minlength=n)


class _Counts:
    """Counts of the sample's words and bigrams, by class and by text."""

    def __init__(self, words: np.ndarray, bounds: np.ndarray, label: np.ndarray):
        of_text = np.repeat(np.arange(len(label), dtype=np.int32), np.diff(bounds))
        mine = label[of_text] == 1
        self.vocabulary, ids = np.unique(words, return_inverse=True)
        ids = ids.astype(np.int32)
        size = len(self.vocabulary)
        # the start of a text is a context like a word, and never a word itself
        contexts = np.empty_like(ids)
        contexts[1:] = ids[:-1]
        contexts[bounds[:-1][np.diff(bounds) > 0]] = size
        kinds, pair_of = np.unique(contexts.astype(np.int64) * size + ids, return_inverse=True)
        pair_of = pair_of.astype(np.int32)
        self.left, self.right = (kinds // size).astype(np.int32), (kinds % size).astype(np.int32)
        self.texts, self.pair_texts = _in_texts(ids, of_text, size), _in_texts(pair_of, of_text, len(kinds))
        self.tokens = np.bincount(ids, minlength=size)
        self.by_class = [np.bincount(ids[side], minlength=size) for side in (~mine, mine)]
        self.pairs_by_class = [np.bincount(pair_of[side], minlength=len(kinds)) for side in (~mine, mine)]
        self.before_by_class = [np.bincount(contexts[side], minlength=size + 1) for side in (~mine, mine)]

    def model(self, least: int) -> ToxicityModel:
        """Kneser-Ney tables; expressions in fewer than ``least`` texts are rare
        and stand in the shared backoff only."""
        size = len(self.vocabulary)
        # continuation counts that the classes share: in how many distinct contexts a word stands
        ahead = np.bincount(self.right, minlength=size).astype(float)
        frequent = self.texts >= least
        rare_mass = (1.0 + self.tokens[~frequent].sum()) / (self.tokens.sum() + 2.0)
        rare = np.append(np.where(frequent, 0, np.maximum(ahead - KN_DISCOUNT, 0)), 1.0)       # the last is of unknown words
        rare[-1] = max((~frequent).sum() * KN_DISCOUNT, 1.0)                                     # what the discounts leave
        rare *= rare_mass / rare.sum()
        shared = np.where(frequent, ahead, 0) / max(1.0, ahead[frequent].sum())
        kept = np.flatnonzero((self.pair_texts >= least) & frequent[self.right])
        left, right = self.left[kept], self.right[kept]
        unigram, backoff = np.empty((size + 1, 2)), np.ones((size + 1, 2))
        bigram = np.zeros((len(kept) + 1, 2))
        for y in (0, 1):
            own = np.where(frequent, self.by_class[y], 0).astype(float)
            first = np.maximum(own - DISCOUNT, 0) / max(1.0, own.sum())
            left_over = 1 - first.sum() if frequent.any() else 0.0
            unigram[:, y] = np.append((1 - rare_mass) * (first + left_over * shared), 0) + rare
            bigram[:-1, y] = np.maximum(self.pairs_by_class[y][kept] - DISCOUNT, 0) / np.maximum(self.before_by_class[y][left], 1)
            backoff[:, y] = 1 - np.bincount(left, weights=bigram[:-1, y], minlength=size + 1)
        if not frequent.any():
            unigram /= unigram.sum(axis=0)
        # rare words are as good as unknown: only their shared probability differs, which says nothing of a class
        listed = np.flatnonzero(np.append(frequent, True))
        names = np.append(self.vocabulary, _START)
        hashed = _pair(names[left], self.vocabulary[right])
        order = np.argsort(hashed)
        table = listed[np.argsort(names[listed])]
        by_name = np.append(unigram[:-1], unigram[-1:], axis=0)
        known = np.isin(left, listed)
        order = order[known[order]]
        return ToxicityModel(names[table], np.append(by_name[table], unigram[-1:], axis=0),
                             np.append(backoff[table], np.ones((1, 2)), axis=0), hashed[order],
                             np.append(bigram[:-1][order], np.zeros((1, 2)), axis=0), np.zeros(6), np.array([np.zeros(5), np.ones(5)]))


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Newton steps of a penalised logistic regression; both classes weigh by their rows."""
    rows = np.append(np.ones((len(x), 1)), x, axis=1)
    w = np.zeros(rows.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        h = (rows * (p * (1 - p))[:, None]).T @ rows + penalty * len(x) * np.diag([1e-6] + [1e-2] * x.shape[1]) + 1e-9 * np.eye(len(w))
        w = w - np.linalg.solve(h, rows.T @ (p - y) + penalty * len(x) * np.append(0, 1e-2 * w[1:]))
    return w


def fit(texts: list[str], labels: list[int], shares: tuple[float, float] | None = None) -> ToxicityModel | None:
    """Fit on labelled texts; every ``CURVE_SHARE``-th text of each label fits the
    curve, the others are counted.  ``shares`` are the classes' true shares
    where the sample is balanced.  None unless both labels occur."""
    y = np.array(labels, np.int64)
    if len(y) == 0 or y.min() == y.max():
        return None
    turn = np.zeros(len(y), np.int64)
    for k in (0, 1):
        turn[y == k] = np.arange((y == k).sum())
    curve = turn % CURVE_SHARE == CURVE_SHARE - 1
    if not (curve & (y == 0)).any() or not (curve & (y == 1)).any():
        curve = np.zeros(len(y), bool)
    counts = _Counts(*hashed_texts([t for t, c in zip(texts, curve) if not c]), y[~curve])
    if not len(counts.vocabulary):
        return None
    used = curve if curve.any() else ~curve
    probe = hashed_texts([t for t, c in zip(texts, used) if c])
    target = y[used].astype(float)
    best = None
    for least in sorted({max(LEAST_TEXTS, round(share * np.bincount(y[~curve], minlength=2).min())) for share in RARE_SHARES}):
        model = counts.model(least)
        x = model.comparisons(*probe)
        model.scale = np.array([x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)])
        x = (x - model.scale[0]) / model.scale[1]
        model.curve = _logistic(x, target)
        p = 1 / (1 + np.exp(-np.clip(model.curve[0] + x @ model.curve[1:], -30, 30)))
        loss = -np.mean(np.where(target == 1, np.log(p), np.log(1 - p)))
        if best is None or loss < best[0]:
            best = (loss, model)
    model = best[1]
    if shares:
        model.curve[0] += np.log(shares[1] / shares[0]) - np.log(target.sum() / (len(target) - target.sum()))
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, training: Column | None = None, id_col: str = "doc_id",
                    text_col: str = "text", label_col: str = "toxic", per_label: int = PER_LABEL,
                    sample_chars: int = SAMPLE_CHARS) -> tuple[list[tuple[str, int]], dict[int, int]]:
    """The bounded sample described above as (text, label), in the order of the ids'
    hashes, and the number of labelled documents by label.

    The driver receives at most ``per_label`` rows a label.  A document is an id with
    a text; of an id's several rows the shortest text counts (ties: the smallest).
    """
    known = labels if training is None else labels.where(training)
    known = known.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y"))
    known = known.where("__id IS NOT NULL AND __y IN (0, 1)").groupBy("__id").agg(F.max("__y").alias("__y"))
    total = {r["__y"]: r["n"] for r in known.groupBy("__y").agg(F.count(F.lit(1)).alias("n")).collect()}
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__t")).where(F.col("__t").isNotNull())
    # the size is settled per id before any row is ranked
    sizes = texts.select("__id", F.length("__t").alias("__size")).groupBy("__id").agg(F.min("__size").alias("__size"))
    ranked = known.join(sizes, "__id").withColumn("__h", F.xxhash64("__id")).withColumn(
        "__over", F.when(F.col("__size") <= sample_chars, 0).otherwise(F.col("__size")))
    keys = lowest_per_group(ranked, "__y", ["__over", "__h", "__id"], per_label).select("__id", "__y", "__size", "__over", "__h").collect()
    room = {y: per_label * sample_chars for y in (0, 1)}
    chosen = []
    for r in sorted(keys, key=lambda r: (r["__over"], r["__h"], r["__id"])):
        room[r["__y"]] -= r["__size"]
        if room[r["__y"]] >= 0:
            chosen.append((r["__id"], r["__y"], r["__size"]))
    if not chosen:
        return [], total
    kind = known.schema["__id"].dataType.simpleString()
    asked = docs.sparkSession.createDataFrame(chosen, f"__id {kind}, __y int, __size int")
    # at most per_label keys a label; one row per id after the aggregate
    found = texts.join(F.broadcast(asked), "__id").where(F.length("__t") == F.col("__size"))
    rows = found.groupBy("__id", "__y").agg(F.min("__t").alias("__t")).orderBy(F.xxhash64("__id"), "__id").collect()
    return [(r["__t"], r["__y"]) for r in rows], total


def fit_toxicity(docs: DataFrame, labels: DataFrame, training: Column | None = None, id_col: str = "doc_id",
                 text_col: str = "text", label_col: str = "toxic", per_label: int = PER_LABEL,
                 sample_chars: int = SAMPLE_CHARS) -> ToxicityModel | None:
    """Fit on the bounded sample described above.  ``training`` filters labels by
    their id; an id with several labels takes the largest, null labels and ids
    are left out."""
    sample, total = labelled_sample(docs, labels, training, id_col, text_col, label_col, per_label, sample_chars)
    if len(total) < 2:
        return None
    return fit([t for t, _ in sample], [y for _, y in sample], (total[0], total[1]))


def with_toxicity(docs: DataFrame, model: ToxicityModel | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """``row`` (the columns in ``keep``), ``score`` (0 to 1, higher: more likely
    toxic) and ``predicted`` (1 if the score is at least 0.5).

    Defined cases: null and empty texts get the score of a text without words;
    where nothing was learned (not both labels) every score is 0; every row is
    returned once, whatever its id, and equal texts score alike; texts of any length
    are scored whole; carried columns may have any name; an empty table gives an
    empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)      # bounded by the sample

    def make():
        def apply(texts: list[str | None]):
            scores = shared.value.scores(texts) if shared.value is not None else np.zeros(len(texts))
            return scores, (scores >= 0.5).astype(np.int32)
        return apply

    return map_texts(docs, text_col, keep, make, [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
