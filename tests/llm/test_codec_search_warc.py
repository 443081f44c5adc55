import io
import math
import random
import struct
import zipfile

import numpy as np
import pytest
from fixtures import awkward, docs_frame, with_clashes, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewatch.llm import piece_coding, vector_search, warc_zip
from tidewatch.llm.queries import tokenizer_path

MODEL = tokenizer_path("piece_bpe_32k.model")


# -- pieces -------------------------------------------------------------------

def small_vocabulary():
    pieces = ["<unk>"] + [f"<0x{v:02X}>" for v in range(256)] + ["▁", "a", "b", "ab", "ba", "▁a", "▁ab", "abb", "▁▁", "bb", "é", "aé"]
    rnd = random.Random(3)
    scores = [0.0] * 257 + [-rnd.uniform(1, 9) for _ in pieces[257:]]
    return piece_coding.Pieces(pieces, scores, [False] * 257 + [True] * (len(pieces) - 257), list(range(1, 257)), 0)


VOCABULARY = small_vocabulary()


def best_by_dynamic_programming(p, word):
    score = {x: s for x, s, n in zip(p.pieces, p.scores, p.normal) if n}
    best = [0.0] + [-math.inf] * len(word)
    for e in range(1, len(word) + 1):
        for s in range(e):
            if word[s:e] in score:
                best[e] = max(best[e], best[s] + score[word[s:e]])
        if word[e - 1] not in score:
            best[e] = max(best[e], best[e - 1] + p.fallback)
    return best[-1]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é\n▁日🙂", max_size=14))
def test_viterbi_is_best_and_decodes(text):
    ids, total = VOCABULARY.encode(text)
    assert VOCABULARY.decode(ids) == text
    if text:
        marked = (" " + text).split("▁")
        want = sum(best_by_dynamic_programming(VOCABULARY, x.replace(" ", "▁")) for x in marked) + (len(marked) - 1) * VOCABULARY.fallback
        assert abs(total - want) < 1e-9


def test_real_vocabulary_round_trip_and_score(spark):
    rnd = random.Random(1)
    p = piece_coding.load_pieces(MODEL)
    texts = [t for _, t in awkward() if t and len(t) < 2000] + [" ".join(words(rnd, 20)) for _ in range(10)] + ["a\r\nb\tc  d", "é▁è"]
    for t in texts:
        ids, total = p.encode(t)
        assert p.decode(ids) == t
        marked = (" " + t).split("▁")
        want = sum(best_by_dynamic_programming(p, x.replace(" ", "▁")) for x in marked) + (len(marked) - 1) * p.fallback
        assert math.isclose(total, want, rel_tol=1e-12, abs_tol=1e-6)
    docs = with_clashes(docs_frame(spark, awkward()))
    coded = piece_coding.with_pieces(docs, MODEL, ["doc_id", "text"])
    rows = coded.collect()
    assert len(rows) == len(awkward()) and all(r.round_trip for r in rows)
    back = piece_coding.decoded(coded.select("row.*", "ids"), MODEL, ["text"]).collect()
    assert all(r.decoded == (r.row.text or "") for r in back)
    assert piece_coding.with_pieces(docs_frame(spark, []), MODEL, ["doc_id"]).count() == 0


# -- vector search ------------------------------------------------------------

def brute_top(rows, step, k):
    """Every row is a candidate, whatever its id; Python integers, cut to a long."""
    ok = [(n, i, tuple(math.floor(64 * x) for x in v)) for n, (i, v) in enumerate(rows)
          if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, q in ok:
        if i is not None and i % step == 0:
            scored = [(min(max(sum(a * b for a, b in zip(q, c)), -2 ** 63 + 1), 2 ** 63 - 1), j, m) for m, j, c in ok if m != n and len(c) == len(q)]
            found = sorted(scored, key=lambda s: (-s[0], s[1] is None, s[1] or 0, s[2]))[:k]
            out += [(i, r + 1, j, s) for r, (s, j, _) in enumerate(found)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard,block", [(16, 4), (64, 1000), (1000, 7)])
def test_top_k_equals_brute_force(spark, shard, block):
    rnd = random.Random(shard)
    rows = [(i, [rnd.uniform(-1, 1) for _ in range(6)]) for i in range(300)]
    rows += [(300 + i, [0.5] * 6) for i in range(120)]                      # one very common vector
    rows += [(500, None), (501, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (505, [math.nan] * 6), (510, [math.inf] * 6), (None, [1.0] * 6), (520, []), (525, []),
             (530, [1.0, 2.0]), (535, [3.0, -4.0]), (300, [0.5] * 6), (20, [0.1] * 6), (None, [0.4] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1)).withColumn("dim", F.lit("x"))
    got = vector_search.top_k(df, F.col("vec_id") % 5 == 0, 9, shard_rows=shard, block_rows=block).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_top(rows, 5, 9)


@pytest.mark.parametrize("size", [2.0 ** 21 - 1, 3.0e6, 2.0 ** 24, 2.0 ** 40, 1e30])
def test_large_components_score_exactly(spark, size):
    """Quantised components around 2**27 (where products leave the doubles' exact
    range), beyond it, and so large that scores leave a long."""
    rng = np.random.default_rng(5)
    rows = [(i, (rng.uniform(-1, 1, 64) * size).tolist()) for i in range(120)] + [(200, [size] * 64), (201, [1.0] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vector_search.top_k(df, F.col("vec_id") % 20 == 0, 20, shard_rows=32, block_rows=4).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_top(rows, 20, 20)


def test_boxes_rule_out_shards_on_clustered_data(spark):
    """Most (block, shard) pairs are dropped before vectors travel, and nothing is lost."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 8)) * 4
    rows = [(i, (centres[i % 12] + 0.1 * rng.normal(size=8)).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = vector_search.Index(spark, df, "vec_id", "embedding", 64)
    found = index.search(F.col("vec_id") % 20 == 0, 5, 16)
    blocks = found.select("query").distinct().count() / 16
    every = blocks * index.trees.count()
    assert index.trees.count() >= 32 and 0 < index.pairs_met < 0.6 * every
    got = vector_search.top_k(df, F.col("vec_id") % 20 == 0, 5, shard_rows=64, block_rows=16).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_top(rows, 20, 5)


def test_top_k_few_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in vector_search.top_k(df, F.col("vec_id") % 20 == 0, 20).collect()] == [(0, 1, 1, 64 * 128)]
    assert vector_search.top_k(df.where("vec_id > 5"), F.col("vec_id") % 20 == 0).count() == 0


def test_tree_boxes_are_tight_and_prune():
    rng = np.random.default_rng(1)
    rows = rng.integers(-64, 64, (1000, 3)).astype(float)
    tree = vector_search.Tree(np.arange(1000), rows, leaf=16)
    for level, spans in enumerate(tree.spans):
        for (b, e), lo, hi in zip(spans, tree.lo[level], tree.hi[level]):
            assert (tree.rows[b:e].min(axis=0) == lo).all() and (tree.rows[b:e].max(axis=0) == hi).all()
    assert sorted(tree.ids.tolist()) == list(range(1000))
    assert (tree.ids[np.argsort(tree.place)] == np.arange(1000)).all()
    back = vector_search.Tree.load(tree.dump())
    assert (back.rows == tree.rows).all() and len(back.spans) == len(tree.spans)


# -- WARC in ZIP --------------------------------------------------------------

PAGE = "page_id long, url string, html string"


def pages(spark, rows):
    return spark.createDataFrame(rows, PAGE)


def brute_pages(rows):
    """One record per row, repeated rows too."""
    last = {}
    for i, _, h in rows:
        if i is not None:
            last[h or ""] = max(i, last.get(h or "", i))
    out = []
    for i, _, h in rows:
        body = (h or "").encode()
        kind = i is not None and i < last[h or ""]
        out.append((i, len(body), warc_zip.digest(body), "revisit" if kind else "response", last[h or ""] if kind else None))
    return out


def test_every_page_row_is_a_record(spark):
    """Rows that share an id and a payload, at one address or at several, and rows without an id."""
    rows = [(1, "http://a", "same"), (1, "http://b", "same"), (1, "http://b", "same"), (2, "http://c", "same"), (2, "http://d", "same"),
            (3, "http://e", "other"), (None, "http://f", "same"), (None, "http://f", "same"), (3, None, None), (3, None, None)]
    got = warc_zip.read_packages(spark, warc_zip.write_packages(pages(spark, rows)), keep_payload=True).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=repr) == sorted(brute_pages(rows), key=repr)
    assert sorted((r.page_id or 0, r.url or "") for r in got) == sorted((i or 0, u or "") for i, u, _ in rows)


def test_batches_of_records_are_cut_by_bytes(spark, monkeypatch):
    """Neighbours are read together and rows leave in batches of bounded size."""
    monkeypatch.setattr(warc_zip, "READ_TOGETHER", 5000)
    assert list(warc_zip._stretches(["p", "p", "p", "q", "q"], [0, 10, 30, 40, 42], [10, 10, 10, 2, 9000])) == [
        ("p", 0, [10, 10]), ("p", 30, [10]), ("q", 40, [2]), ("q", 42, [9000])]
    rows = [(i, None, "".join(chr(97 + (i * k) % 26) for k in range(900))) for i in range(60)]
    packages = warc_zip.write_packages(pages(spark, rows))
    listed = next(warc_zip._list_records(iter([_batch(packages.select("path").collect())])))
    out = list(warc_zip._read_records(True)(iter([listed])))
    assert len(out) > 3 and max(b.nbytes for b in out) < 9000
    assert sum(b.num_rows for b in out) == listed.num_rows
    assert sum(b.num_rows for b in warc_zip._read_records(False)(iter([listed]))) == listed.num_rows


def _batch(rows):
    import pyarrow as pa
    return pa.RecordBatch.from_arrays([pa.array([r.path for r in rows])], names=["path"])


def test_write_and_read_back(spark):
    rnd = random.Random(2)
    rows = [(i, f"http://x/{i}", " ".join(words(rnd, 50))) for i in range(60)]
    rows += [(100 + i, "http://copy", "<p>same é 🙂</p>") for i in range(40)]
    rows += [(200, None, None), (201, "http://e", ""), (None, "http://none", "lost"), (202, "a\r\nb", "\r\n\r\nx" * 9), (203, "u", "z" * 300_000),
             (5, "http://x/5", rows[5][2])]
    df = pages(spark, rows).withColumn("payload", F.lit(1)).withColumn("key", F.lit("k")).withColumn("refers_to", F.lit(3))
    packages = warc_zip.write_packages(df)
    got = warc_zip.read_packages(spark, packages, keep_payload=True).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=repr) == sorted(brute_pages(rows), key=repr)
    by_id = {i: h for i, _, h in rows}
    assert all(r.payload == (by_id[r.page_id] or "") for r in got if r.record_type == "response")
    assert all(r.payload is None for r in got if r.record_type == "revisit")


def test_least_bytes_and_empty_table(spark):
    rows = [(1, "u", "tiny"), (2, "u", "tiny"), (3, "u", "longer text"), (4, "u", "longer text")]
    packages = warc_zip.write_packages(pages(spark, rows), least_bytes=10)
    kinds = {r.page_id: r.record_type for r in warc_zip.read_packages(spark, packages).collect()}
    assert kinds == {1: "response", 2: "response", 3: "revisit", 4: "response"}
    none = warc_zip.write_packages(pages(spark, []))
    assert none.count() == 0 and warc_zip.read_packages(spark, none).count() == 0


def test_packages_are_zip_files_others_can_read(spark):
    packages = warc_zip.write_packages(pages(spark, [(1, "u", "one"), (2, "v", "two")])).collect()
    import gzip
    text = b""
    for p in packages:
        with zipfile.ZipFile(p.path.removeprefix("file://")) as z:
            assert z.testzip() is None and all(i.compress_type == zipfile.ZIP_STORED for i in z.infolist())
            text += b"".join(gzip.decompress(z.read(n)) for n in z.namelist() if n.startswith("archive/"))
    assert text.count(b"WARC/1.1\r\n") == 2 and b"urn:page:1" in text


def as_zip64(data, comment=b""):
    """Rewrite a small ZIP so that its sizes and offsets stand in ZIP64 fields only."""
    end = data.rfind(b"PK\x05\x06")
    n, length, offset = struct.unpack_from("<HII", data, end + 10)
    directory, out, at = data[offset:offset + length], b"", 0
    for _ in range(n):
        packed, plain, ln, le, lc = struct.unpack_from("<IIHHH", directory, at + 20)
        local = struct.unpack_from("<I", directory, at + 42)[0]
        extra = struct.pack("<HHQQQ", 1, 24, plain, packed, local)
        head = bytearray(directory[at:at + 46])
        struct.pack_into("<IIHHH", head, 20, 0xFFFFFFFF, 0xFFFFFFFF, ln, len(extra), 0)
        struct.pack_into("<I", head, 42, 0xFFFFFFFF)
        out += bytes(head) + directory[at + 46:at + 46 + ln] + extra
        at += 46 + ln + le + lc
    record = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, len(out), offset)
    locator = b"PK\x06\x07" + struct.pack("<IQI", 0, offset + len(out), 1)
    tail = b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, len(comment)) + comment
    return data[:offset] + out + record + locator + tail


@pytest.mark.parametrize("zip64", [False, True])
def test_directory_parser(zip64):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr(zipfile.ZipInfo("archive/data-0.warc.gz"), b"0123456789" * 30)
        z.writestr("deflated.txt", "a" * 500, compress_type=zipfile.ZIP_DEFLATED)
        z.writestr(zipfile.ZipInfo(warc_zip.INDEX), "archive/data-0.warc.gz 10 20\narchive/data-0.warc.gz 30 5\n")
    data = out.getvalue()
    if zip64:
        data = as_zip64(data, b"PK\x05\x06 is no end here")
    f = io.BytesIO(data)
    found = {m.name: m for m in warc_zip.members(f, len(data))}
    assert found["archive/data-0.warc.gz"].stored and not found["deflated.txt"].stored
    begin = found["archive/data-0.warc.gz"].begin
    assert data[begin:begin + 10] == b"0123456789"
    assert warc_zip.record_ranges(f, len(data)) == [(begin + 10, 20), (begin + 30, 5)]


def test_broken_packages_raise():
    with pytest.raises(ValueError):
        warc_zip.members(io.BytesIO(b"nothing"), 7)
    with pytest.raises(ValueError):
        warc_zip.parse_record(b"WARC/1.1\r\nContent-Length: 9\r\nWARC-Type: response\r\n\r\nshort")
