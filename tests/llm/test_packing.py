import random
import zlib

import numpy as np
import pytest
from fixtures import awkward, docs_frame, with_clashes, words

from tidewatch.llm.packing import fullest, pack, plan_bins, slot_table
from tidewatch.llm.queries import tokenizer_path
from tidewatch.llm.token_ids import encoder


def best_fill(items, room):
    sums = {0}
    for x in items:
        sums |= {s + x for s in sums if s + x <= room}
    return max(sums)


@pytest.mark.parametrize("seed", range(6))
def test_fullest_equals_exhaustive_subset_sum(seed):
    rnd = random.Random(seed)
    counts = np.zeros(41, np.int64)
    for _ in range(rnd.randint(1, 12)):
        counts[rnd.randint(1, 40)] += 1
    first = int(np.flatnonzero(counts).max())
    items = [length for length in range(1, 41) for _ in range(counts[length] - (length == first))]
    chosen = fullest(counts, 40, first)
    assert first in chosen and all(n <= counts[length] for length, n in chosen.items())
    assert sum(length * n for length, n in chosen.items()) == first + best_fill(items, 40 - first)


def test_plan_uses_every_piece_and_few_bins():
    rnd = np.random.default_rng(1)
    counts = np.bincount(rnd.integers(1, 1025, 5000), minlength=1025)
    plan = plan_bins(counts)
    used = np.zeros(1025, np.int64)
    for chosen, times in plan:
        assert sum(length * n for length, n in chosen.items()) <= 1024 and times > 0
        for length, n in chosen.items():
            used[length] += n * times
    assert (used == counts).all()
    least = -(-int((counts * np.arange(1025)).sum()) // 1024)
    assert sum(t for _, t in plan) <= 1.02 * least
    assert len(plan) < 3000
    ranges = {}
    for length, first, past, *_ in slot_table(plan):
        assert first == ranges.get(length, 0)
        ranges[length] = past
    assert all(ranges[length] == counts[length] for length in ranges)


def reference_ids(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids


def test_fast_encoding_equals_the_library():
    rnd = random.Random(2)
    odd = ["", "a", " ", "  a  b ", "don't we'll I'M 'sx", "x\n\n y\t\tz \r\n", "naïve Ärger ß·½²µªº", "日本語 text", "🙂🙂", "a b c​",
           "1234 5,678.90%", "<|endoftext|> x", "\x1c\x1d\x85 a", "ı İ ŉ", "_a_b__c", "é" * 300]
    odd += ["".join(rnd.choice("ab '\n1é.,日\t<|>_") for _ in range(rnd.randint(0, 60))) for _ in range(200)]
    got = encoder(tokenizer_path("byte_bpe_50k.json"))()(odd)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [reference_ids(t) for t in odd]


def test_settled_characters_split_alike_in_both_libraries():
    """Every character that may take the fast path, next to letters, digits,
    spaces and itself."""
    from tidewatch.llm.token_ids import _UNSETTLED
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and not _UNSETTLED.search(chr(c))]
    assert 30_000 < len(chars) < 60_000
    e = encoder(tokenizer_path("byte_bpe_50k.json"))()
    assert e.fast is not None
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    texts = ["".join(f"a{c}1{c}{c} {c} .{c}  {c}" for c in chars[k:k + 100]) for k in range(0, len(chars), 100)]
    want = [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(g, "<u4").tolist() for g in e(texts)] == want


def test_packing_whole_contract(spark):
    rnd = random.Random(5)
    rows = awkward() + [(100 + i, " ".join(words(rnd, rnd.randint(0, 900)))) for i in range(60)]
    got = pack(with_clashes(docs_frame(spark, rows)), tokenizer_path("byte_bpe_50k.json"), keep_ids=True).collect()
    by_doc = {}
    for r in got:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        by_doc.setdefault(r.doc_id, []).append(r)
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append(reference_ids(t) + [2])
    assert set(by_doc) == set(want)
    for i, all_ids in want.items():
        pieces = []
        for ids in all_ids:
            k = -(-len(ids) // 1024)
            cut = [0] + [len(ids) - 1024 * (k - p) for p in range(1, k + 1)]
            pieces += [(p, cut[p], cut[p + 1] - cut[p], zlib.crc32(np.array(ids[cut[p]:cut[p + 1]], "<u4").tobytes())) for p in range(k)]
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[i]) == sorted(pieces)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(bins) <= 1 + 1.05 * sum(r.length for r in got) / 1024


def test_empty_table(spark):
    assert pack(docs_frame(spark, []), tokenizer_path("byte_bpe_50k.json")).count() == 0
