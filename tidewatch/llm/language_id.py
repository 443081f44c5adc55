"""Language identification by string kernels.

The kernel of two texts is a blend over n-gram orders: how many distinct byte
n-grams both have, over the geometric mean of how many each has (presence, not
counts; n-grams are hashed into a fixed number of slots per order).  Landmark
texts give a Nyström map of it, and one-versus-rest kernel ridge regression on
that map gives one score per language.  Scoring is two matrix products per
batch: normalised presence rows by landmarks, then by the regression's weights.

The model is fitted on a bounded sample: for each language the ``per_language``
training rows with the lowest hash among those of at most ``sample_chars``
characters.  Every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import lowest_per_group, map_texts

#: Slots of each n-gram order, from single bytes up.
SLOTS = (256, 2048, 4096, 4096)
PER_LANGUAGE, SAMPLE_CHARS = 300, 20_000
LANDMARKS, RIDGE = 128, 1e-3
UNKNOWN = "und"
_WINDOW = 1 << 22
_ROWS = 128


def presence(texts: Iterable[bytes]) -> np.ndarray:
    """Rows of the texts' n-gram presence, each order scaled so that the inner
    product of two rows is their kernel."""
    texts = list(texts)
    out = np.zeros((len(texts), sum(SLOTS)), np.float32)
    for row, text in zip(out, texts):
        for lo in range(0, max(1, len(text)), _WINDOW):
            b = np.frombuffer(text, np.uint8)[lo:lo + _WINDOW + len(SLOTS) - 1]
            code = np.zeros(len(b), np.uint32)
            base = 0
            for n, slots in enumerate(SLOTS, 1):
                if len(b) < n:
                    break
                code = (code[:len(b) - n + 1] << np.uint32(8)) | b[n - 1:]
                slot = code if n == 1 else (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - int(np.log2(slots)))
                row[base + slot] = 1
                base += slots
    base = 0
    for slots in SLOTS:
        part = out[:, base:base + slots]
        part /= np.sqrt(np.maximum(part.sum(axis=1, keepdims=True), 1) * len(SLOTS))
        base += slots
    return out


def _plain(text: str) -> bytes:
    return " ".join(text.lower().split()).encode("utf-8", "surrogatepass")


@dataclass
class LanguageModel:
    languages: list[str]
    landmarks: np.ndarray       # landmarks x slots
    weights: np.ndarray         # landmarks x languages: Nyström map and ridge weights in one

    def scores(self, texts: list[bytes]) -> np.ndarray:
        out = np.empty((len(texts), len(self.languages)), np.float32)
        for lo in range(0, len(texts), _ROWS):
            rows = presence(texts[lo:lo + _ROWS])
            out[lo:lo + _ROWS] = (rows @ self.landmarks.T) @ self.weights
        return out


def fit(texts: list[str], languages: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> LanguageModel | None:
    """Fit on labelled texts in the order given; None without any."""
    if not texts:
        return None
    names = sorted(set(languages))
    y = np.array([names.index(x) for x in languages])
    rows = presence(_plain(t) for t in texts)
    # landmarks in turn from every language
    turn = np.zeros(len(y), np.int64)
    for k in range(len(names)):
        turn[y == k] = np.arange((y == k).sum())
    chosen = np.sort(np.lexsort((y, turn))[:landmarks])
    marks = rows[chosen]
    value, vector = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    keep = value > 1e-6 * value[-1]
    half = vector[:, keep] / np.sqrt(value[keep])
    mapped = (rows @ marks.T).astype(np.float64) @ half
    target = np.where(y[:, None] == np.arange(len(names)), 1.0, -1.0)
    # every language weighs the same, however many rows it has
    weight = 1.0 / np.bincount(y, minlength=len(names))[y]
    gram = mapped.T @ (mapped * weight[:, None])
    solved = np.linalg.solve(gram + ridge * np.eye(len(gram)) * np.trace(gram) / len(gram), mapped.T @ (target * weight[:, None]))
    return LanguageModel(names, marks, (half @ solved).astype(np.float32))


def fit_languages(docs: DataFrame, training: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang", per_language: int = PER_LANGUAGE, sample_chars: int = SAMPLE_CHARS) -> LanguageModel | None:
    """Fit on the bounded sample described above (``training`` filters rows)."""
    rows = docs if training is None else docs.where(training)
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
                       F.xxhash64(F.col(id_col), F.col(text_col)).alias("h"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (F.length("text") <= sample_chars))
    keys = lowest_per_group(rows.select("lang", "h"), "lang", ["h"], per_language)
    # at most per_language keys a language
    sample = rows.join(F.broadcast(keys.distinct()), ["lang", "h"]).dropDuplicates(["lang", "h"]).orderBy("h", "lang").collect()
    return fit([r["text"] for r in sample], [r["lang"] for r in sample])


def with_language(docs: DataFrame, model: LanguageModel | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """``row`` (the columns in ``keep``), ``lang_pred`` and ``score`` (0 to 1).

    Defined cases: a null text, or one without a letter, is ``und`` with score
    0; so is every text if nothing was learned (no labelled row).  Of languages that
    score alike the first by name is taken; equal texts get equal results, one per
    row; texts of any length are scored whole (in a very long one most n-grams are
    present, so the kernel tells less); carried columns may have any name; an empty
    table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)      # slots x landmarks, fixed size

    def make():
        import regex

        letter = regex.compile(r"\p{L}")

        def apply(texts: list[str | None]):
            m = shared.value
            some = [i for i, t in enumerate(texts) if m is not None and t and letter.search(t)]
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if some:
                f = m.scores([_plain(texts[i]) for i in some])
                best = f.argmax(axis=1)
                for i, k, v in zip(some, best, f[np.arange(len(some)), best]):
                    names[i] = m.languages[k]
                    scores[i] = min(1.0, max(0.0, (float(v) + 1) / 2))
            return names, scores
        return apply

    return map_texts(docs, text_col, keep, make, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
