"""Registered queries of the corpus operators: each applies its operator, with
production parameters, to its whole table and derives the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import fold, load
from tidewatch.llm.exact_dedup import exact_duplicates
from tidewatch.llm.hard_negatives import hard_negatives
from tidewatch.llm.histogram_shards import shard_by_bytes
from tidewatch.llm.language_id import fit_languages, with_language
from tidewatch.llm.language_model import language_model_scores
from tidewatch.llm.near_dedup import near_duplicates
from tidewatch.llm.packing import pack
from tidewatch.llm.periodic_runs import with_runs
from tidewatch.llm.piece_coding import with_pieces
from tidewatch.llm.secret_scan import fit_secrets, with_secrets
from tidewatch.llm.toxicity import fit_toxicity, with_toxicity
from tidewatch.llm.vector_search import top_k
from tidewatch.llm.warc_zip import read_packages, write_packages


def tokenizer_path(name: str) -> str:
    """The installed vocabulary file ``name`` (the same place on every machine)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from labelled rows outside fold 0 of 5."""
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    model = fit_toxicity(docs, labels, fold("doc_id", 5) != 0)
    return with_toxicity(docs, model, ["doc_id"]).select(
        "row.doc_id", (fold("row.doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of ``documents`` by block naming."""
    return exact_duplicates(load(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model score of every document, learned from rows outside fold 2 of 7."""
    docs = load(spark, sf_dir, "documents")
    return language_model_scores(docs, fold("doc_id", 7) != 2).select(
        "doc_id", (fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of ``documents``: three-word shingles, similarity 0.85."""
    return near_duplicates(load(spark, sf_dir, "documents"), words=3, percent=85).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op5_piece_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, decoded again."""
    return with_pieces(load(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), ["doc_id"], ids=False).select(
        "row.doc_id", "n_pieces", "ids_crc32", "score", "round_trip")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` packed into sequences of 1024 token ids."""
    return pack(load(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: spans, and the digest of the masked text."""
    docs = load(spark, sf_dir, "documents")
    return with_secrets(docs, fit_secrets(docs), ["doc_id"]).select(
        "row.doc_id", "n_candidates", F.size("secrets").alias("n_secrets"),
        F.array_join(F.transform("secrets", lambda x: F.concat_ws("+", x["start"], x["length"])), ",").alias("spans"),
        "redacted_sha256")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` written as WARC records in ZIP packages and read back by ranges."""
    packages = write_packages(load(spark, sf_dir, "pages"))
    return read_packages(spark, packages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from rows outside fold 0 of 5."""
    docs = load(spark, sf_dir, "documents")
    model = fit_languages(docs, fold("doc_id", 5) != 0)
    return with_language(docs, model, ["doc_id"]).select(
        "row.doc_id", (fold("row.doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op10_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every 20th vector against all others."""
    return top_k(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` in 24 shards of near equal bytes."""
    docs = load(spark, sf_dir, "documents").withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    return shard_by_bytes(docs, ["doc_id", "text_crc32"], 24).select(
        "row.doc_id", "size", "row.text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 100th vector, for its five best positives."""
    vectors = load(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    moved = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives(moved, F.col("id") % 100 == 0)


def stretched(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, where the words of a tenth of the documents (by the
    crc32 of their id) repeat with a period, as the contract of op13 has it."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    g = F.floor(F.col("h") / 10)
    begin = g % F.nullif(F.size("words"), F.lit(0))
    period = 1 + F.floor((F.size("words") - F.col("a")) / (3 + g % 8))
    moved = F.transform("words", lambda w, i: F.when(
        i >= F.col("a"), F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))).otherwise(w))
    return (
        docs.select("doc_id", "text", h.alias("h"))
        .withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumn("a", begin).withColumn("p", period)
        .select("doc_id", F.when(F.size("words") > 0, F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of exponent 4 or more in every document, and what is left without their repeats."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return with_runs(stretched(load(spark, sf_dir, "documents")), ["doc_id"]).select(
        "row.doc_id", F.size("runs").cast("long").alias("n_runs"), "strongest.start", "strongest.length", "strongest.period",
        F.floor(F.lit(1000) * F.col("strongest.length") / F.col("strongest.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_lm_score": op3_lm_score,
    "op4_near_dedup": op4_near_dedup,
    "op5_piece_coding": op5_piece_coding,
    "op6_packing": op6_packing,
    "op7_secret_scan": op7_secret_scan,
    "op8_warc": op8_warc,
    "op9_language_id": op9_language_id,
    "op10_vector_search": op10_vector_search,
    "op11_sharding": op11_sharding,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_periodic_runs": op13_periodic_runs,
}

#: DuckDB SQL of the queries that SQL can express.
ORACLE_SQL = {
    "op2_exact_dedup": r"""
        WITH d AS (
          SELECT doc_id, coalesce(text, '') AS raw,
                 regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
          FROM documents),
        s AS (
          SELECT body, count(*) AS group_size,
                 first(doc_id ORDER BY length(raw) DESC, doc_id) AS keep_id
          FROM d GROUP BY body)
        SELECT d.doc_id, s.keep_id, CAST(s.group_size AS BIGINT) AS group_size,
               d.doc_id = s.keep_id AS kept, sha256(d.body) AS text_sha256
        FROM d JOIN s USING (body)
    """,
    "op4_near_dedup": r"""
        WITH RECURSIVE t AS (
          SELECT doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
          FROM documents),
        s AS (
          SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                 ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
          FROM t),
        u AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
        p AS (
          SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS met, any_value(a.n) AS m, any_value(b.n) AS n
          FROM u a JOIN u b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
        l AS (SELECT x, y FROM p WHERE 100 * met >= 85 * (m + n - met)),
        e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
        c AS (
          SELECT doc_id, doc_id AS reached FROM s
          UNION SELECT c.doc_id, e.y FROM c JOIN e ON e.x = c.reached),
        m AS (SELECT doc_id, min(reached) AS component_id FROM c GROUP BY doc_id)
        SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM s JOIN m USING (doc_id)
    """,
    "op8_warc": """
        WITH p AS (
          SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
        m AS (SELECT html, max(page_id) AS last FROM p GROUP BY html),
        chunks AS (
          SELECT page_id, k, CAST('0x' || substr(hex, 5 * k + 1, 5) AS INTEGER) AS v
          FROM p, range(8) AS r(k)),
        digits AS (
          SELECT page_id, string_agg(
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 15) & 31) + 1, 1) ||
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 10) & 31) + 1, 1) ||
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 5) & 31) + 1, 1) ||
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v & 31) + 1, 1), '' ORDER BY k) AS payload_digest
          FROM chunks GROUP BY page_id)
        SELECT p.page_id, CAST(strlen(p.html) AS BIGINT) AS payload_bytes, d.payload_digest,
               CASE WHEN p.page_id < m.last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN p.page_id < m.last THEN m.last END AS refers_to
        FROM p JOIN m USING (html) JOIN digits d USING (page_id)
    """,
    "op10_vector_search": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e
          FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id
          WHERE q.vec_id % 20 = 0),
        r AS (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
    """,
    "op12_hard_negatives": """
        WITH v AS (
          SELECT row_number() OVER () AS n, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
          FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT a.n AS anchor, a.vec_id AS anchor_id, a.label = c.label AS same, c.n, c.vec_id,
                 CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
          FROM v a JOIN v c ON a.n <> c.n
          WHERE a.vec_id % 100 = 0),
        p AS (
          SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS place
          FROM s WHERE same QUALIFY place <= 5),
        r AS (
          SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
                 row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY s.score DESC, s.vec_id) AS rank
          FROM p JOIN s ON p.anchor = s.anchor AND NOT s.same
          WHERE 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
        FROM r WHERE rank <= 10
    """,
}
