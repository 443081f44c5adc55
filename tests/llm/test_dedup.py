import hashlib
import random
import re
from collections import defaultdict

import pytest
from fixtures import awkward, docs_frame, with_clashes, words
from pyspark.sql import functions as F

from tidewatch.llm import common, components, exact_dedup, near_dedup
from tidewatch.llm.components import connected_components
from tidewatch.llm.exact_dedup import exact_duplicates, name_by_sorting
from tidewatch.llm.near_dedup import bands_for, near_duplicates, sketch_limit


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def by_hand(rows):
    """(id, keep id, size, digest) of distinct (id, text) rows, and how many are kept."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[plain(t)].append((i, t))
    out = []
    for body, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1] or ""), m[0] is None, m[0] or 0))
        out += [(i, keep[0], len(members), hashlib.sha256(body.encode()).hexdigest()) for i, _ in members]
    return sorted(out, key=repr), len(groups)


@pytest.mark.parametrize("block", [300, 4096])
def test_exact_groups(spark, block):
    rows = awkward()
    got = exact_duplicates(with_clashes(docs_frame(spark, rows)), block_bytes=block).collect()
    want, kept = by_hand(rows)
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=repr) == want
    assert sum(r.kept for r in got) == kept
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_random_texts_with_shared_blocks(spark):
    """Texts made of few distinct blocks in all orders: names must tell them apart."""
    rnd = random.Random(3)
    parts = ["".join(rnd.choice("abc") for _ in range(8)) for _ in range(3)]
    rows = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 7))) + rnd.choice(["", " ", "z"])) for i in range(400)]
    got = exact_duplicates(docs_frame(spark, rows), block_bytes=8).collect()
    want, kept = by_hand(rows)
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=repr) == want
    assert sum(r.kept for r in got) == kept


def test_empty_tables(spark):
    none = docs_frame(spark, [])
    assert exact_duplicates(none).count() == 0
    assert near_duplicates(none).count() == 0


def shingles(text, k):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < k else frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def brute_components(rows, k, percent):
    """{position: (set size, smallest id of the component)}"""
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    members = defaultdict(list)
    for a in range(len(rows)):
        members[find(a)].append(a)
    out = {}
    for group in members.values():
        ids = [rows[a][0] for a in group if rows[a][0] is not None]
        for a in group:
            out[a] = (len(sets[a]), min(ids) if ids else None)
    return out, len(members)


def variants(rnd, base, n, changes):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rnd.randint(0, changes)):
            w[rnd.randrange(len(w))] = "".join(rnd.choice("xyz") for _ in range(5))
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, k, percent):
    """Groups whose members lie around the threshold, so that components hang on
    single links, beside awkward rows."""
    rnd = random.Random(k)
    texts = []
    for size, n, changes in ((120, 60, 6), (60, 60, 3), (400, 25, 12), (12, 40, 1)):
        texts += variants(rnd, words(rnd, size), n, changes)
    texts += [" ".join(words(rnd, rnd.randint(3, 80))) for _ in range(60)]
    ids = list(range(100, 100 + len(texts)))
    rnd.shuffle(ids)
    rows = awkward(k) + list(zip(ids, texts))
    got = near_duplicates(with_clashes(docs_frame(spark, rows)), words=k, percent=percent).collect()
    want, n_components = brute_components(rows, k, percent)
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=repr) == sorted(
        [(rows[a][0], n, c) for a, (n, c) in want.items()], key=repr)
    assert sum(r.kept for r in got) == n_components
    assert all(r.doc_id == r.component_id for r in got if r.kept)


def test_default_is_five_words_at_eighty_percent(spark):
    base = [f"w{i}" for i in range(200)]
    near = list(base)
    near[100] = "other"                    # 191 of 201 shingles are shared
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(base[:100]))]
    assert [r.component_id for r in near_duplicates(docs_frame(spark, rows)).orderBy("doc_id").collect()] == [1, 1, 3]


def test_components_of_chains_and_stars(spark):
    rnd = random.Random(1)
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 101 + i) for i in range(30)]
    rest = [(rnd.randint(200, 260), rnd.randint(200, 260)) for _ in range(40)]
    links = chain + star + rest + [(5, 5), (None, 3)]
    got = {r.node: r.comp for r in connected_components(spark, spark.createDataFrame(links, "a long, b long")).collect()}
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            root[max(find(a), find(b))] = min(find(a), find(b))
    assert got == {x: find(x) for x in root}
    assert connected_components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def test_sketch_limit_is_far_from_the_threshold():
    assert 60 < sketch_limit(85) < sketch_limit(80) < 200


def test_bands_miss_hardly_any_pair_at_the_threshold():
    for percent in (65, 70, 80, 85, 95, 100):
        rows, bands = bands_for(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= 1e-6 and rows * bands <= 200
    assert bands_for(85) == (5, 24) and bands_for(80) == (5, 35)


@pytest.mark.parametrize("distinct", [True, False])
def test_hot_groups_are_spread(spark, monkeypatch, distinct):
    """Copies of one block of text span the partitions of the naming pass, also
    where the rows are copies of one row."""
    key = F.col("id") if distinct else F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(F.lit(7).cast("long"))
    rows = spark.range(0, 8000, 1, 4).select(F.lit(b"same").alias("block"), key.alias("key_a"), F.lit(0).alias("pos"))
    written = []
    keep = exact_dedup.materialise
    monkeypatch.setattr(exact_dedup, "materialise", lambda *a: written.append(keep(*a)) or written[-1])
    named = name_by_sorting(spark, rows, "block", ["key_a", "pos"], "test")
    assert named.select("name").distinct().count() == 1 and named.count() == 8000
    # the naming pass writes a file per task
    files = written[0].where("edge IS NULL").groupBy(F.input_file_name().alias("f")).count().collect()
    assert sum(r["count"] for r in files) == 8000
    assert len(files) == 8 and max(r["count"] for r in files) < 2 * 8000 / 8


def test_small_tables_are_kept_in_few_files(spark, monkeypatch):
    """Many shuffle partitions, as a cluster is set up for large tables, must not
    make a file each of intermediates of a few rows; the groups stay the same."""
    import corpus_pipeline

    rnd = random.Random(5)
    rows = []
    for k in range(60):
        text = words(rnd, 60)
        for copy in range(rnd.randint(1, 4)):
            some = list(text)
            some[rnd.randrange(60)] = f"other{copy}"
            rows.append((len(rows), " ".join(some if copy else text)))
    rows += [(1000 + i, "a b c d e f g") for i in range(20)]
    docs = docs_frame(spark, rows)
    groups = lambda: {r.doc_id: (r.component_id, r.kept) for r in near_duplicates(docs).collect()}
    names = lambda: sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_duplicates(docs).collect())
    want, want_names = groups(), names()
    assert len(set(want.values())) < len(rows)
    files = []
    write = common.materialise

    def counted(session, df, label):
        out = write(session, df, label)
        files.append((label, len(out.inputFiles())))
        return out

    for module in (components, exact_dedup, near_dedup):
        monkeypatch.setattr(module, "materialise", counted)
    own = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        assert groups() == want and names() == want_names
        stay = corpus_pipeline._stay(docs, docs.where("doc_id < 9").select(*common.row_keys("doc_id", "text")))
        assert stay.rdd.getNumPartitions() == 1 and sorted(r.doc_id for r in stay.collect()) == list(range(9))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {"classes", "buckets", "stars", "texts", "links", "edges", "labelled", "open", "lefts", "rights", "more-links", "placed",
            "named-rows"} <= {label for label, _ in files}
    assert [x for x in files if x[0] not in ("signatures", "blocks") and x[1] > 2] == []


def test_large_tables_keep_their_partitions(spark):
    rows = spark.range(0, 1000, 1, 8)
    assert common.in_few_files(rows, 1000, 100).rdd.getNumPartitions() == 8
    assert common.in_few_files(rows, 1000, 400).rdd.getNumPartitions() == 3
    assert common.in_few_files(rows, 0, 400).rdd.getNumPartitions() == 1
    assert common.dealt_in_few(rows, 1000, 100).rdd.getNumPartitions() == 8        # shuffle_partitions are 8
    dealt = common.dealt_in_few(rows, 1000, 400)
    assert dealt.rdd.getNumPartitions() == 3 and dealt.distinct().count() == 1000


def test_a_repeated_row_is_written_out_by_several_tasks(spark, monkeypatch):
    """Half of all rows are one row: its copies come from several tasks, one of them kept."""
    monkeypatch.setattr(exact_dedup, "COPIES", 500)
    rows = [(1, "the same text")] * 4000 + [(10 + i, f"text {i}") for i in range(4000)]
    out = exact_duplicates(docs_frame(spark, rows)).withColumn("task", F.spark_partition_id()).collect()
    mine = [r for r in out if r.doc_id == 1]
    assert len(out) == 8000 and len(mine) == 4000 and sum(r.kept for r in mine) == 1 and {r.group_size for r in mine} == {4000}
    copies = exact_dedup._copies(spark, spark.createDataFrame([(1, 4000), (2, 3)], "key_a long, copies long")).select("key_a", "copy", F.spark_partition_id().alias("t"))
    got = copies.collect()
    assert sorted((r.key_a, r.copy) for r in got) == [(1, k) for k in range(1, 4001)] + [(2, k) for k in range(1, 4)]
    tasks = {}
    for r in got:
        tasks[r.t] = tasks.get(r.t, 0) + 1
    assert len(tasks) >= 4 and max(tasks.values()) <= 2000
