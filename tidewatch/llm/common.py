"""Shared helpers of the corpus operators: tables, durable intermediates and
vectorised word hashing.

Words are maximal runs of bytes other than ``\\x20 \\x09-\\x0D`` of the UTF-8
text, with A-Z lower-cased when asked.  All of them are hashed with array
operations over the joined text buffer of an Arrow batch, so no Python code
runs per word.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidewatch.session import ship_package, state_path

#: Bytes of text hashed at a time: bounds the working arrays, not the text.
WINDOW_BYTES = 1 << 17

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Mask of white space and ASCII punctuation.
PUNCTUATION = _SPACE.copy()
PUNCTUATION[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
#: Bytes with A-Z as a-z.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += np.uint8(32)
_powers = [np.empty(0, np.uint64), np.empty(0, np.uint64)]
_digits: list[np.ndarray] = []


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def materialise(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: cuts
    the lineage, and a lost executor costs no recomputation of it."""
    path = state_path(spark, "llm", f"{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows in a file at least, where there are more files than that: of rows that go
#: with documents, and of short rows of numbers.
FILE_ROWS, FILE_LINKS = 1 << 12, 1 << 16


def in_few_files(df: DataFrame, rows: int, least: int) -> DataFrame:
    """``df``, of at most ``rows`` rows, in no more partitions than one per
    ``least`` rows; a larger table keeps its partitions.

    A task that writes a file starts a program or two for its access rights (Hadoop
    does, on a local folder without its native library), so hundreds of files of a
    few rows cost more than their rows.  The partitions are put together where they
    are made: for a last step that is an aggregate or a light join."""
    return df.coalesce(max(1, -(-rows // least)))


def dealt_in_few(df: DataFrame, rows: int, least: int) -> DataFrame:
    """``in_few_files`` for few rows that are costly to make: all tasks make them,
    then they are shuffled."""
    few = max(1, -(-rows // least))
    return df.repartition(few) if few < shuffle_partitions(df.sparkSession) else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def dealt_anew(df: DataFrame) -> DataFrame:
    """``df`` (an aggregate) shuffled by row, for a join back to what it sums up.
    The join then has shuffles of its own on both sides, and adaptive execution
    can split those of a hot key; joined in the aggregate's own partitions, a hot
    key's rows would stay in one task."""
    return df.repartition(shuffle_partitions(df.sparkSession))


def ready(spark: SparkSession) -> SparkSession:
    """Make this package importable in the Python workers."""
    ship_package(spark)
    return spark


def row_keys(row_id: str, text: str) -> list[Column]:
    """``key_a`` and ``key_b``: 128 bits of hash of a row's id and text, by which
    an operator's decisions find their rows again."""
    return [F.xxhash64(F.col(row_id), F.col(text)).alias("key_a"), F.xxhash64(F.lit(7), F.col(text), F.col(row_id)).alias("key_b")]


def fold(column: Column | str, folds: int) -> Column:
    """crc32 of an id's text modulo ``folds`` (null ids count as empty text)."""
    text = F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(None)).cast("string")
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary")) % folds


#: Ids that are looked at as hot, at most, and copies that a hot row has at least.
HOT_IDS, LEAST_COPIES = 10_000, 1000
#: Copies that one step writes out.
_PIECE = 1 << 16


def collapse_hot(rows: DataFrame, row_id: str, columns: list[str]) -> DataFrame:
    """``rows`` with ``__copies``: a row that repeats very often (equal in
    ``columns``, of which ``row_id`` is one) stands once with the number of its
    copies, all others stand as they are with 1.

    Copies of a row hash alike, so dealing rows out by hash would put them all in one
    task.  Ids on more than ``LEAST_COPIES`` rows and more than one row in
    ``HOT_IDS`` are at most ``HOT_IDS`` many; only their rows are compared.
    """
    least = max(LEAST_COPIES, rows.count() // HOT_IDS)
    ids = rows.groupBy(F.col(f"`{row_id}`").alias("__id")).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > least).select("__id")
    ids = materialise(rows.sparkSession, ids, "hot-ids")                 # at most HOT_IDS rows
    if ids.isEmpty():
        return rows.withColumn("__copies", F.lit(1).cast("long"))
    hot = ids.select("__id", F.lit(True).alias("__hot"))
    marked = rows.join(F.broadcast(hot), F.col(f"`{row_id}`").eqNullSafe(F.col("__id")), "left").drop("__id")
    cold = marked.where(F.col("__hot").isNull()).drop("__hot").withColumn("__copies", F.lit(1).cast("long"))
    counted = marked.where(F.col("__hot")).drop("__hot").groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count(F.lit(1)).alias("__copies"))
    return cold.unionByName(counted.select(*[F.col(f"`{c}`") for c in rows.columns], "__copies"))


def expand_copies(rows: DataFrame) -> DataFrame:
    """Each row as often as ``__copies`` says, some at a time."""
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("__copies") - 1, F.lit(_PIECE).cast("long"))).alias("__from")
    size = F.least(F.lit(_PIECE).cast("long"), F.col("__copies") - F.col("__from")).cast("int")
    return rows.select("*", first).select("*", F.explode(F.sequence(F.lit(1), size)).alias("__copy")).drop("__copies", "__from", "__copy")


#: Tasks that rank a group, level by level: each passes on at most ``n`` rows, so no
#: task ranks more than ``n`` rows for every 64 of the level before (or, at first, for
#: every 4096th input partition).
LEVELS = (4096, 64)


def lowest_per_group(rows: DataFrame, group: str, order: list[str], n: int, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """The ``n`` rows of lowest ``order`` in each group: first within each input
    partition (Spark limits a rank before it shuffles), then within fewer and fewer
    sets of partitions, so that a hot group is not ranked in a single task."""
    few = rows.withColumn("__salt", F.spark_partition_id())
    for keys in [(group, F.col("__salt") % salts) for salts in levels] + [(group,)]:
        window = Window.partitionBy(*keys).orderBy(*order)
        few = few.withColumn("__rank", F.row_number().over(window)).where(F.col("__rank") <= n).drop("__rank")
    return few.drop("__salt")


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; null texts are empty."""
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        width = np.int64
    else:
        width = np.int32
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if len(offsets) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    h = h.copy()
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, WINDOW_BYTES + 1)
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def _pair_digits() -> np.ndarray:
    """The digit of a byte (low) after another (high; 0 at the start of a word)."""
    if not _digits:
        _digits.append(mix(np.arange(1, (1 << 16) + 1, dtype=np.uint64) * _BASE) | np.uint64(1))
    return _digits[0]


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True, breaks: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash every word of the joined texts.

    Returns (64-bit hash, start byte, end byte) of the words in order.  Texts
    end words: ``offsets`` are the text boundaries, ``breaks`` the byte values
    (as a mask) between words.  The hash is a polynomial
    over the bytes, read off prefix sums modulo 2**64, and mixed.
    """
    if len(data) == 0:
        empty = np.empty(0, np.int64)
        return np.empty(0, np.uint64), empty, empty
    solid = ~breaks[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    cuts = offsets[:-1][np.diff(offsets) > 0]
    first[cuts] = solid[cuts]
    inner = cuts[cuts > 0]
    last[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        begin = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, begin + WINDOW_BYTES, side="right")))
        plain = data[begin:ends[j - 1]]
        if lower:
            plain = _LOWER[plain]
        s, e = starts[i:j] - begin, ends[i:j] - begin
        pairs = plain.astype(np.uint16)
        pairs[1:] |= plain[:-1].astype(np.uint16) << np.uint16(8)
        pairs[s] = plain[s]
        digits = _pair_digits()[pairs]
        up, down = _power_tables(len(digits) + 1)
        digits *= up[:-1]
        sums = np.zeros(len(digits) + 1, np.uint64)
        np.cumsum(digits, out=sums[1:])
        out[i:j] = (sums[e] - sums[s]) * down[s]
        i = j
    return mix(out), starts, ends


def words_per_text(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bounds of each text's words: text k has words ``bounds[k]:bounds[k+1]``."""
    return np.searchsorted(starts, offsets)


def cuts(texts: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``limit`` bytes of text (one longer text is
    a range of its own)."""
    _, offsets = text_buffer(texts)
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + limit, side="right")) - 1)
        yield begin, end
        begin = end


def slices(batch: pa.RecordBatch, text: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about ``limit`` bytes of text."""
    for begin, end in cuts(batch.column(batch.schema.names.index(text)), limit):
        yield batch.slice(begin, end - begin)


def map_texts(df: DataFrame, text_col: str, keep: list[str], make, fields: list, limit: int = 4 << 20) -> DataFrame:
    """Run a batch function over whole texts, carrying columns along untouched.

    ``make()`` is called once per task and returns a function from a list of
    texts (null stays None) to one sequence per new field.  The carried columns
    travel in a struct ``row``, so their names cannot clash with the new ones;
    a carried text travels once.
    """
    ready(df.sparkSession)
    carried = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    inside = text_col in keep and df.schema[text_col].dataType == T.StringType()
    whole = df.select(carried) if inside else df.select(carried, F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([whole.schema["row"], *fields])
    types = [to_arrow_type(f.dataType) for f in fields]
    names = ["row"] + [f.name for f in fields]
    at = keep.index(text_col) if inside else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            rows = batch.column(0)
            texts = rows.flatten()[at] if inside else batch.column(1)
            for begin, end in cuts(texts, limit):
                columns = apply(texts.slice(begin, end - begin).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [rows.slice(begin, end - begin)] + [pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return whole.mapInArrow(run, schema)
