"""Token ids of texts under a byte-level BPE vocabulary file.

The ids are those that the file's own library gives.  It spends most of its time
on things that a corpus job does not need (offsets, masks), so where a file has
the plain byte-level form, a second library merges by the same ranks, several
times faster.  That path is taken only for files whose merges stand in the order
of their ids, and for texts whose characters have had the same classes (letter,
number, white space, other) in all versions of Unicode since 5.0, so that both
libraries split them alike; other texts go to the file's own library.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable

#: Fixed value: how byte-level vocabularies split a text before the merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Ranges of characters whose classes have not changed: Latin, Cyrillic, common
#: punctuation and currency signs, kana, Han and Hangul.
SETTLED = "\u0000-ɏА-я‐-‧‰-⁞₠-₵ぁ-ゖァ-ヺ一-龥가-힣"
_UNSETTLED = re.compile(f"[^{SETTLED}]")


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable
    Latin-1 characters stand for themselves, all other bytes for the characters
    from U+0100 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def byte_ranks(vocabulary: str) -> dict[bytes, int] | None:
    """{token bytes: id} of a plain byte-level BPE file whose ids are in merge
    order, else None."""
    with open(vocabulary, encoding="utf-8") as f:
        told = json.load(f)
    model, split = told["model"], told.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or told.get("normalizer") or split.get("type") != "ByteLevel" \
            or split.get("add_prefix_space") or not split.get("use_regex", True) \
            or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        return None
    alphabet = byte_alphabet()
    added = {t["content"] for t in told.get("added_tokens", ())}
    ranks = {}
    for token, i in model["vocab"].items():
        if token not in added:
            if any(c not in alphabet for c in token):
                return None
            ranks[bytes(alphabet[c] for c in token)] = i
    merged = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    order = [model["vocab"].get(a + b, -1) for a, b in merged]
    if order != sorted(order) or len(set(order)) != len(order) or -1 in order or len(ranks) != 256 + len(order):
        return None
    return ranks


class TokenIds:
    """Encodes texts as little-endian unsigned 32-bit ids, ``end`` appended."""

    def __init__(self, vocabulary: str, end: bytes = b""):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # a task has one core
        from tokenizers import Tokenizer

        self.end = end
        self.library = Tokenizer.from_file(vocabulary)
        self.library.encode_special_tokens = True            # their strings in a text are ordinary text
        self.library.no_truncation()
        self.library.no_padding()
        ranks = byte_ranks(vocabulary)
        self.fast = None
        if ranks is not None:
            import tiktoken

            self.fast = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        slow = []
        for k, text in enumerate(texts):
            if self.fast is not None and (text.isascii() or not _UNSETTLED.search(text)):
                out[k] = self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes() + self.end
            else:
                slow.append(k)
        for k, found in zip(slow, self.library.encode_batch([texts[k] for k in slow], add_special_tokens=False)):
            out[k] = packed(found.ids) + self.end
        return out


def packed(ids: list[int]) -> bytes:
    a = array("I", ids)
    if a.itemsize != 4:
        raise RuntimeError("ids need 32-bit integers")
    import sys

    if sys.byteorder == "big":
        a.byteswap()
    return a.tobytes()


_LOADED: dict[tuple, TokenIds] = {}


def encoder(vocabulary: str, end_id: int | None = None) -> Callable[[], TokenIds]:
    """A factory for tasks: loads a vocabulary file once per worker process."""
    def make() -> TokenIds:
        key = (vocabulary, end_id)
        if key not in _LOADED:
            _LOADED[key] = TokenIds(vocabulary, packed([end_id]) if end_id is not None else b"")
        return _LOADED[key]
    return make
