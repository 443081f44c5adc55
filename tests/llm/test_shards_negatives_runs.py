import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from conftest import SF_ORACLE, SF_SMALL
from fixtures import awkward, docs_frame, with_clashes, words
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle_check import compare, duck
from pyspark.sql import functions as F

from tidewatch.llm import hard_negatives as hn
from tidewatch.llm import histogram_shards as hs
from tidewatch.llm import periodic_runs as pr
from tidewatch.llm import queries


# -- shards -------------------------------------------------------------------

def sharded(docs, shards=24):
    named = docs.withColumn("crc", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    return hs.shard_by_bytes(named, ["doc_id", "crc"], shards).select("row.*", "size", "shard", "slot").collect()


def assert_law(rows, shards):
    """Slots gapless from 0; every border within 1 % of a shard, or half a row, of its place."""
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    assert all(0 <= s < shards for s in by)
    for held in by.values():
        assert sorted(r["slot"] for r in held) == list(range(len(held)))
    total, largest, below = sum(r["size"] for r in rows), max(r["size"] for r in rows), 0
    for s in range(shards):
        below += sum(r["size"] for r in by.get(s, []))
        assert abs(below - total * (s + 1) / shards) <= max(0.005 * total / shards, largest / 2) + 1


@pytest.mark.parametrize("folder", [SF_SMALL, SF_ORACLE])
def test_shards_hold_near_equal_bytes(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = sharded(docs)
    want = sorted((r["doc_id"], len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
    assert sorted((r["doc_id"], r["size"], r["crc"]) for r in rows) == want
    assert_law(rows, 24)


def test_equal_texts_are_neighbours_and_only_borders_cut_them(spark):
    rnd = random.Random(5)
    texts = [" ".join(words(rnd, 12)) for _ in range(900)]
    docs = docs_frame(spark, [(k, t) for k, t in enumerate(texts * 3)])
    rows = sorted(sharded(docs, 6), key=lambda r: (r["shard"], r["slot"]))
    order = [r["crc"] for r in rows]
    turns = sum(a != b for a, b in zip(order, order[1:]))
    assert turns == len(set(order)) - 1                 # each group is one stretch of the global order
    spread = {}
    for r in rows:
        spread.setdefault(r["crc"], set()).add(r["shard"])
    assert sum(len(s) > 1 for s in spread.values()) <= 5
    assert_law(rows, 6)


def test_a_hot_repeated_row_is_spread(spark):
    """Half of all rows repeat one row: shards stay equal, and so do tasks."""
    docs = docs_frame(spark, [(1, "the same row every time")] * 6000 + [(k, f"row number {k:012d}") for k in range(6000)])
    out = hs.shard_by_bytes(docs, ["doc_id"], 8).select("row.doc_id", "size", "shard", "slot", F.spark_partition_id().alias("task"))
    rows = out.collect()
    assert_law(rows, 8)
    tasks = {}
    for r in rows:
        tasks[r["task"]] = tasks.get(r["task"], 0) + 1
    assert max(tasks.values()) <= 1.1 * len(rows) / 8


def test_shards_of_awkward_rows(spark):
    docs = docs_frame(spark, awkward())
    rows = sharded(docs, 3)
    assert len(rows) == docs.count()
    assert sorted(r["size"] for r in rows)[:3] == [8, 8, 8]
    carried = hs.shard_by_bytes(with_clashes(docs), with_clashes(docs).columns, 3)
    assert carried.columns == ["row", "size", "shard", "slot"] and carried.count() == len(rows)
    assert hs.shard_by_bytes(docs.limit(0), ["doc_id"]).collect() == []
    few = sharded(docs.limit(2), 24)
    assert len(few) == 2 and {r["slot"] for r in few} == {0}
    assert sharded(docs, 1) and {r["shard"] for r in sharded(docs, 1)} == {0}


def test_pieces_cut_a_shard_over_tasks(spark):
    """With more shuffle partitions than shards, a shard's rows lie in several tasks."""
    rnd = random.Random(2)
    docs = docs_frame(spark, [(k, " ".join(words(rnd, 8))) for k in range(2000)])
    out = hs.shard_by_bytes(docs, ["doc_id"], 2).select("shard", "slot", "size", F.spark_partition_id().alias("task")).collect()
    assert len({r["task"] for r in out if r["shard"] == 0}) == 4
    assert_law(out, 2)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(-3, 3), st.integers(-3, 3)), min_size=1, max_size=30),
       st.lists(st.tuples(st.integers(-3, 3), st.integers(-3, 3)), max_size=12, unique=True))
def test_bins_count_probes(keys, probes):
    probes = sorted(probes)
    got = hs.bins(hs._arrays(probes), *hs._arrays(keys))
    assert got.tolist() == [sum(p <= k for p in probes) for k in keys]


def test_written_shards(spark, tmp_dir):
    docs = docs_frame(spark, [(k, f"text {k}") for k in range(40)])
    hs.write_shards(hs.shard_by_bytes(docs, ["doc_id", "text"], 4), f"{tmp_dir}/shards")
    back = spark.read.parquet(f"{tmp_dir}/shards")
    assert sorted(r["doc_id"] for r in back.select("row.doc_id").collect()) == list(range(40))
    assert {r["shard"] for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}


# -- hard negatives -----------------------------------------------------------

def brute_negatives(rows, is_anchor, positives=5, negatives=10):
    kept = []
    for n, (i, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        kept.append((n, i, label, [int(np.floor(256 * float(x))) for x in v]))
    out = []

    def order(found):
        return sorted(found, key=lambda s: (-s[0], s[1] is None, s[1] or 0, s[2]))

    for n, i, label, v in kept:
        if not is_anchor(i):
            continue
        scored = [(min(max(sum(a * b for a, b in zip(v, w)), -2 ** 63), 2 ** 63 - 1), j, m, other) for m, j, other, w in kept
                  if m != n and len(w) == len(v)]
        for p in order([s for s in scored if s[3] == label])[:positives]:
            inside = [s for s in scored if s[3] != label and 30 * p[0] <= 100 * s[0] <= 90 * p[0]]
            out += [(i, p[1], rank, s[1], p[0], s[0]) for rank, s in enumerate(order(inside)[:negatives], 1)]
    return out


def found_negatives(spark, rows, every, partitions=3):
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, norm string").repartition(partitions)
    return [tuple(r) for r in hn.hard_negatives(frame, F.col("id") % every == 0).collect()]


def key(row):
    return tuple((x is None, x or 0) for x in row)


def clustered(rnd, n, dim, centres=6, spread=0.2):
    heart = rnd.normal(size=(centres, dim))
    at = rnd.integers(centres, size=n)
    length = rnd.uniform(0.2, 3, size=(n, 1))
    return (heart[at] + spread * rnd.normal(size=(n, dim))) * length, at


def test_negatives_equal_brute_force(spark):
    rnd = np.random.default_rng(1)
    vecs, at = clustered(rnd, 500, 8)
    rows = [(k, v.tolist(), int(a) % 4) for k, (v, a) in enumerate(zip(vecs, at))]
    rows += [(500, [0.0] * 8, 1), (501, None, 1), (502, [None] + [1.0] * 7, 2), (503, [float("nan")] * 8, 2), (504, [1.0] * 8, None),
             (505, [float("inf")] + [0.0] * 7, 1), (None, vecs[3].tolist(), 0), (None, vecs[4].tolist(), 1), (510, [1.0, 2.0], 1), (520, [1.0, 2.5], 1),
             (530, [0.7, 1.0], 2), (540, [], 1), (550, [], 1)]
    got, want = found_negatives(spark, rows, 10), brute_negatives(rows, lambda i: i is not None and i % 10 == 0)
    assert len(want) > 500 and sorted(got, key=key) == sorted(want, key=key)


def test_repeated_rows_and_ids(spark):
    rnd = np.random.default_rng(2)
    vecs, at = clustered(rnd, 40, 4, 2, spread=2.0)
    rows = [(k, v.tolist(), int(a)) for k, (v, a) in enumerate(zip(vecs, at))]
    rows += [rows[0]] * 30 + [(7, vecs[9].tolist(), 1)]
    got, want = found_negatives(spark, rows, 20), brute_negatives(rows, lambda i: i % 20 == 0)
    assert len(want) > 100 and sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("size", [2.0 ** 21, 2.0 ** 25, 2.0 ** 40, 1e30])
def test_large_components_score_exactly(spark, size):
    rnd = np.random.default_rng(3)
    vecs, at = clustered(rnd, 60, 6, 3)
    rows = [(k, (v * size).tolist(), int(a)) for k, (v, a) in enumerate(zip(vecs, at))]
    got, want = found_negatives(spark, rows, 10), brute_negatives(rows, lambda i: i % 10 == 0)
    assert (want or size > 2 ** 30) and sorted(got, key=key) == sorted(want, key=key)     # beyond a long all scores are alike


def test_negatives_of_empty_and_lone_tables(spark):
    assert found_negatives(spark, [], 10) == []
    assert found_negatives(spark, [(0, [1.0], 1)], 10) == []
    assert found_negatives(spark, [(0, [1.0], 1), (1, [-1.0], 1), (2, [0.5], 2)], 10) == []       # the positive scores below 0


def test_candidates_hold_every_row_that_can_score_enough():
    rnd = np.random.default_rng(4)
    vecs, _ = clustered(rnd, 1024, 16)
    vecs = np.floor(256 * vecs)
    norms = np.linalg.norm(vecs, axis=1)
    order = np.argsort(-norms)
    pack = {"vecs": vecs[order], "norms": norms[order], "labels": np.zeros(1024), "numbers": np.arange(1024), "ids": np.arange(1024),
            "nameless": np.zeros(1024, bool)}
    bucket = hn.Bucket(pack, 0, 1024)
    met = 0
    for q in vecs[:60]:
        norm = float(np.linalg.norm(q))
        focus = np.argsort(-np.abs(q))[:hn.FOCUS]
        score = bucket.rows @ q
        for least in (np.sort(score)[-5], 0.8 * score.max(), 1.0, 0.0, -1e9):
            some = bucket.candidates(q / norm, focus, norm, float(least))
            assert set(np.flatnonzero(score >= least)) <= set([] if some is None else some.tolist())
            met += len(some) if some is not None and least == np.sort(score)[-5] else 0
        assert bucket.candidates(q / norm, focus, norm, norm * bucket.longest * 1.1) is None
    assert met < 0.5 * 60 * 1024                                 # the sorted lists rule most rows out


def test_negatives_match_sql(spark):
    r = compare(spark, duck(SF_ORACLE), "op12", queries.QUERIES["op12_hard_negatives"], queries.ORACLE_SQL["op12_hard_negatives"], SF_ORACLE)
    assert r["ok"], r


# -- periodic runs ------------------------------------------------------------

def brute_runs(seq, exponent=4, least=6):
    out = []
    for q in range(1, len(seq) // exponent + 1):
        i = 0
        while i + q < len(seq):
            j = i
            while j + q < len(seq) and seq[j] == seq[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, exponent * q):
                part = seq[i:i + length]
                if not any(part[r:] == part[:-r] for r in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


repeats = st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=5), st.integers(1, 30)), max_size=5).map(
    lambda parts: [x for p, n in parts for x in (p * 30)[:n]])


@settings(max_examples=400, deadline=None)
@given(repeats, st.sampled_from([(4, 6), (2, 3), (3, 5), (5, 20)]))
def test_runs_equal_brute_force(seq, rule):
    assert pr.text_runs(seq, *rule) == brute_runs(seq, *rule)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=2, max_size=40))
def test_suffix_tree_answers_extensions(seq):
    tree = pr.SuffixTree(seq)
    pairs = [(a, b) for a in range(len(seq) + 1) for b in range(len(seq) + 1) if a != b]
    got = tree.extension(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
    for (a, b), n in zip(pairs, got.tolist()):
        want = 0
        while max(a, b) + want < len(seq) and seq[a + want] == seq[b + want]:
            want += 1
        assert n == want
    ranks = tree.ranks(False)
    assert sorted(range(len(seq) + 1), key=lambda i: seq[i:]) == sorted(range(len(seq) + 1), key=ranks.__getitem__)
    up = tree.ranks(True)
    assert sorted(range(len(seq) + 1), key=lambda i: [-x for x in seq[i:]]) == sorted(range(len(seq) + 1), key=up.__getitem__)


def test_long_runs_and_long_texts():
    rnd = random.Random(1)
    base = [rnd.randrange(90) for _ in range(700)]
    seq = [-1 - k for k in range(5)] + base * 30
    assert pr.text_runs(seq) == [(5, 21000, 700)]
    assert pr.text_runs(["a"] * 50_000) == [(0, 50_000, 1)]
    noise = [rnd.randrange(3) for _ in range(3000)]
    assert pr.text_runs(noise) == brute_runs(noise)


def test_run_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r) for r in queries.op13_periodic_runs(spark, SF_SMALL).collect()}
    assert len(got) == len(rows)
    some = 0
    for r in rows:
        seq = (r["text"] or "").encode().split()
        n, h = len(seq), zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            seq = [seq[k] if k < a else seq[a + (k - a) % p] for k in range(n)]
        runs = brute_runs(seq)
        some += len(runs)
        top = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None, None, None))
        gone = {k for s, length, q in runs for k in range(s + q, s + length)}
        left = b" ".join(w for k, w in enumerate(seq) if k not in gone)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        assert got[r["doc_id"]] == (r["doc_id"], len(runs), *top, 1000 * top[1] // top[2] if runs else None,
                                    hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest())
    assert some > 20


def test_runs_of_awkward_rows(spark):
    texts = awkward() + [(20, "a b a b a b a b a"), (21, "x x x x x x"), (22, "x x x x x"), (20, "a b a b a b a b a"), (23, "é é é é " * 6)]
    docs = docs_frame(spark, texts)
    rows = pr.with_runs(with_clashes(docs), ["doc_id", "row", "score"]).collect()
    assert len(rows) == len(texts)
    by = {}
    for r in rows:
        by.setdefault(r["row"]["doc_id"], []).append(r)
    for i in (1, 2, 3):
        assert (by[i][0]["n_words"], by[i][0]["runs"], by[i][0]["strongest"], by[i][0]["collapsed"]) == (0, [], None, "")
    assert [tuple(x) for x in by[20][0]["runs"]] == [(0, 9, 2)] and by[20][0]["collapsed"] == "a b" and by[20][0] == by[20][1]
    assert [tuple(x) for x in by[21][0]["runs"]] == [(0, 6, 1)] and by[21][0]["collapsed"] == "x"
    assert by[22][0]["runs"] == [] and by[22][0]["collapsed"] == "x x x x x"
    assert tuple(by[23][0]["strongest"]) == (0, 12, 1)
    assert pr.with_runs(docs.limit(0), ["doc_id"]).collect() == []
    moved = {r["doc_id"]: r["text"] for r in queries.stretched(docs_frame(spark, [(k, None if k % 2 else "") for k in range(60)])).collect()}
    assert len(moved) == 60 and not any(moved.values())


def test_a_text_beyond_a_slice_is_read_whole(spark):
    """A text larger than the slices that tasks read (4 MB): its run is found whole."""
    rnd = random.Random(7)
    phrase = words(rnd, 40, "abcdefghijklmnop")
    head = [f"w{k}" for k in range(300_000)]
    text = " ".join(head + phrase * 5000)
    assert len(text) > 3 * (1 << 20)
    out = pr.with_runs(docs_frame(spark, [(1, text + " " + text[:2_000_000])]), ["doc_id"]).select("runs", "n_words").first()
    assert (300_000, 200_000, 40) in {tuple(r) for r in out["runs"]} and out["n_words"] > 500_000
