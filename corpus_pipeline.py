"""A training-data pipeline over ``documents`` in five stages.

Each stage takes the rows that the one before it kept, as they were written, and
its decisions take effect: documents without a language go, of equal and of near
equal documents one stays, secrets are masked, and the rest is packed into
sequences.  All stages but the last return the columns of ``documents``.

Every stage takes nulls in any column, empty texts, repeated rows and further
columns (which it carries along, whatever their names), and returns an empty
table for an empty one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import FILE_ROWS, in_few_files, load, row_keys
from tidewatch.llm.exact_dedup import exact_duplicates
from tidewatch.llm.language_id import UNKNOWN, fit_languages, with_language
from tidewatch.llm.near_dedup import near_duplicates
from tidewatch.llm.packing import pack
from tidewatch.llm.queries import tokenizer_path
from tidewatch.llm.secret_scan import fit_secrets, with_secrets
from tidewatch.session import state_path


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language: null texts and texts without a letter
    (all that can be told where no row has a ``lang`` to learn from)."""
    model = fit_languages(docs)
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return with_language(docs, model, docs.columns).where(F.col("lang_pred") != UNKNOWN).select("row.*")


def _stay(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``kept`` names by their keys, one per key: rows
    that repeat an id and a text are one document."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *row_keys("doc_id", "text"))
    keys = ["key_a", "key_b"]
    stay = whole.join(kept.select(*keys).distinct(), keys, "left_semi").dropDuplicates(keys).select("row.*")
    return in_few_files(stay, docs.count(), FILE_ROWS)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts (white space aside) one stays."""
    return _stay(docs, exact_duplicates(docs).where("kept"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8) one stays."""
    return _stay(docs, near_duplicates(docs).where("kept"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask secrets in the text; ``n_chars`` follows it."""
    scanned = with_secrets(docs, fit_secrets(docs), docs.columns)
    changed = {"text": F.coalesce("redacted", "row.text").alias("text")}
    if "n_chars" in docs.columns:
        length = F.when(F.col("redacted").isNull(), F.col("row.n_chars")).otherwise(F.length("redacted"))
        changed["n_chars"] = length.cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return scanned.select(*[changed.get(c, F.col(f"row.`{c}`").alias(c)) for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 token ids, packed into sequences."""
    return pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("secret_scan", secret_stage),
    ("packing", packing_stage),
]

#: The stages learn models, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each one's rows are written below the
    shared checkpoint folder and read again as the next one's."""
    docs = load(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            path = state_path(spark, "pipeline", f"{name}-{uuid.uuid4().hex}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
