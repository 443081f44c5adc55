"""SentencePiece encoding and decoding by an Aho-Corasick automaton and one
Viterbi pass.

The automaton over all pieces reports, at each position of the text, every piece
that ends there (its output links lead from the longest to the shortest); each
relaxes the best score of that position from the best score of its start.  The
segmentation of the highest total score results.  Characters without a piece of
their own cost less than any piece and become byte pieces.

Where no piece reaches over a word mark that follows another character (this is
checked when a vocabulary is loaded), a best segmentation is the best ones of its
words in order, words starting at marks and at white space that occurs in no
piece; a task keeps those of words it has seen in a bounded cache.  With other
vocabularies a text is one word.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewatch.llm.common import map_texts

MARK = "▁"
#: What an uncovered character costs below the lowest single-character piece.
UNKNOWN_COST = 10.0
CACHE_WORDS, CACHE_CHARS = 400_000, 64


@dataclass
class Pieces:
    """A vocabulary: pieces with scores, and byte pieces by byte value."""

    pieces: list[str]
    scores: list[float]
    normal: list[bool]
    byte_ids: list[int]                 # 256 ids, or empty without byte pieces
    unknown_id: int
    known: dict[str, tuple[bytes, float]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for i, (piece, score, normal) in enumerate(zip(self.pieces, self.scores, self.normal)):
            if normal and piece:
                self.automaton.add_word(piece, (len(piece), score, i))
        if len(self.automaton):
            self.automaton.make_automaton()
        used = [p for p, n in zip(self.pieces, self.normal) if n]
        self.single = {p for p in used if len(p) == 1}
        self.fallback = min((s for p, s, n in zip(self.pieces, self.scores, self.normal) if n and len(p) == 1), default=0.0) - UNKNOWN_COST
        alone = "".join(c for c in "\n\t\x0b\x0c\x1c\x1d\x1e\x1f\x85" if not any(c in p for p in used))
        if any(MARK in p.lstrip(MARK) for p in used):
            pattern = r".+"
        else:
            pattern = f"{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+" + (f"|[{alone}]" if alone else "")
        self.words = re.compile(pattern, re.S).findall
        self.value = {i: v for v, i in enumerate(self.byte_ids)}
        self.plain = [p.replace(MARK, " ").encode("utf-8", "surrogatepass") for p in self.pieces]
        for i, v in self.value.items():
            self.plain[i] = bytes([v])

    def _bytes_of(self, char: str) -> list[int]:
        if not self.byte_ids:
            return [self.unknown_id]
        return [self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")]

    def viterbi(self, word: str) -> tuple[list[int], float]:
        """Best segmentation of a word whose spaces are marks; of equal scores
        the one whose last piece is shorter."""
        n = len(word)
        best = [0.0] + [float("-inf")] * n
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        done = 0

        def settle(upto: int) -> None:
            """Uncovered characters reach the positions up to ``upto``."""
            nonlocal done
            while done < upto:
                done += 1
                if word[done - 1] not in self.single:
                    score = best[done - 1] + self.fallback
                    if score > best[done]:
                        best[done], back[done] = score, (done - 1, -1)

        if len(self.automaton):
            for end, (size, score, i) in self.automaton.iter(word):
                settle(end)
                total = best[end + 1 - size] + score
                if total > best[end + 1] or total == best[end + 1] and back[end + 1][0] < end + 1 - size:
                    best[end + 1], back[end + 1] = total, (end + 1 - size, i)
        settle(n)
        ids: list[int] = []
        at = n
        while at:
            start, i = back[at]
            ids += [i] if i >= 0 else self._bytes_of(word[start])[::-1]
            at = start
        return ids[::-1], best[n]

    def encode(self, text: str | None) -> tuple[bytes, float]:
        """(little-endian 32-bit ids, total score) of a whole text.  A mark stands
        for each space and before the text; a literal mark becomes byte pieces."""
        if not text:
            return b"", 0.0
        out, total = [], 0.0
        for k, part in enumerate((" " + text).split(MARK)):
            if k:
                out.append(np.array(self._bytes_of(MARK), "<u4").tobytes())
                total += self.fallback
            for word in self.words(part.replace(" ", MARK)):
                found = self.known.get(word)
                if found is None:
                    ids, score = self.viterbi(word)
                    found = np.array(ids, "<u4").tobytes(), score
                    if len(word) <= CACHE_CHARS:
                        if len(self.known) >= CACHE_WORDS:
                            self.known.clear()
                        self.known[word] = found
                out.append(found[0])
                total += found[1]
        return b"".join(out), total

    def decode(self, ids: bytes) -> str:
        """The text of ids: exact for what ``encode`` made, if there are byte pieces."""
        plain = self.plain
        joined = b"".join([plain[i] for i in np.frombuffer(ids, "<u4").tolist()])
        return joined.decode("utf-8", "replace")[1 if joined[:1] == b" " else 0:]


def load_pieces(model_file: str) -> Pieces:
    """The vocabulary of a SentencePiece model file."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=model_file)
    n = sp.get_piece_size()
    pieces = [sp.id_to_piece(i) for i in range(n)]
    is_byte = [sp.is_byte(i) for i in range(n)]
    normal = [not (b or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) for i, b in enumerate(is_byte)]
    by_value = {int(pieces[i][3:5], 16): i for i in range(n) if is_byte[i]}
    return Pieces(pieces, [sp.get_score(i) for i in range(n)], normal,
                  [by_value[v] for v in range(256)] if len(by_value) == 256 else [], sp.unk_id())


def _fresh(model_file: str) -> Callable[[], Pieces]:
    """Loads a vocabulary once per worker process."""
    def make() -> Pieces:
        if model_file not in _LOADED:
            _LOADED[model_file] = load_pieces(model_file)
        return _LOADED[model_file]
    return make


_LOADED: dict[str, Pieces] = {}


def with_pieces(docs: DataFrame, model_file: str, keep: list[str], text_col: str = "text", ids: bool = True) -> DataFrame:
    """``row`` (the columns in ``keep``), ``n_pieces``, ``ids`` (little-endian
    unsigned 32-bit, on request), ``ids_crc32``, ``score`` (of the segmentation)
    and ``round_trip`` (whether decoding gives the text again).

    ``model_file`` is read on every executor.  Defined cases: null and empty
    texts have no pieces and score 0; every row is returned once, whatever its
    id, and equal texts give equal pieces; of segmentations that score alike the
    one whose last piece is shorter is taken; texts of any length are coded
    whole; carried columns may have any name; an empty table gives an empty result.
    """
    def make():
        pieces = _fresh(model_file)()

        def apply(texts: list[str | None]):
            coded = [pieces.encode(t) for t in texts]
            columns = [[len(c) // 4 for c, _ in coded], [zlib.crc32(c) for c, _ in coded], [s for _, s in coded],
                       [pieces.decode(c) == (t or "") for (c, _), t in zip(coded, texts)]]
            return columns + [[c for c, _ in coded]] if ids else columns
        return apply

    fields = [T.StructField("n_pieces", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("score", T.DoubleType()),
              T.StructField("round_trip", T.BooleanType())]
    return map_texts(docs, text_col, keep, make, fields + ([T.StructField("ids", T.BinaryType())] if ids else []))


def decoded(coded: DataFrame, model_file: str, keep: list[str], ids_col: str = "ids") -> DataFrame:
    """``row`` (the columns in ``keep``) and the ``text`` of binary ids; null ids
    give a null text."""
    from pyspark.sql import functions as F

    def make():
        pieces = _fresh(model_file)()
        return lambda hexa: ([pieces.decode(bytes.fromhex(h)) if h is not None else None for h in hexa],)

    whole = coded.withColumn(ids_col, F.hex(ids_col))
    return map_texts(whole, ids_col, keep, make, [T.StructField("decoded", T.StringType())])
