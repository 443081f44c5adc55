"""Small inputs for the corpus operators."""

import random

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def words(rnd, n, alphabet="abcdefgh"):
    return [("".join(rnd.choice(alphabet) for _ in range(rnd.randint(2, 6)))) for _ in range(n)]


def docs_frame(spark, texts, lang="en"):
    """Documents from (id, text) pairs; ``lang`` may be a list."""
    rows = [(i, t, lang if isinstance(lang, str) else lang[k], f"s{k % 3}", len(t) if t is not None else None)
            for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DOC)


#: Columns whose names the operators use inside.
CLASHING = ("row", "name", "block", "pos", "uid", "node", "comp", "score", "length", "piece", "part", "rank", "lang_pred", "word",
            "chunk", "key_a", "text_sha256", "kept", "secrets", "redacted", "predicted", "n_pieces")


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING if c not in df.columns])


def awkward(seed=1):
    """(id, text) pairs: nulls, empties, white space, long texts, repeated rows."""
    rnd = random.Random(seed)
    long = " ".join(words(rnd, 6000))
    return [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two"), (None, "no id here at all"), (None, None), (6, long),
            (7, long), (8, long.replace(" ", "\n")), (9, "a b c d e f"), (9, "a b c d e f"), (10, "A B  C D E F"), (11, "é ü 日本 🙂 x"),
            (12, "x" * 30_000), (13, "x" * 30_000 + " "), (14, "12 34 !!"), (15, "one two three four five six seven")]
