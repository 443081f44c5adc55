"""String expressions: marker tests, text after a marker, CSV lines."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def contains_any(col, markers: Iterable[str]) -> Column:
    """True when the text contains at least one marker (substring anywhere)."""
    c = as_col(col)
    terms = [c.contains(m) for m in markers]
    if not terms:
        return F.lit(False)
    return reduce(lambda a, b: a | b, terms)


def contains_none(col, markers: Iterable[str]) -> Column:
    """True when the text contains none of the markers; null text is kept out."""
    c = as_col(col)
    terms = [~c.contains(m) for m in markers]
    if not terms:
        return c.isNotNull()
    return reduce(lambda a, b: a & b, terms)


def substring_after(col, marker: str) -> Column:
    """Text after the first ``marker``; empty string when it is missing.

    ``substring_index`` would return the whole text when the marker is
    missing, so the position is tested explicitly.
    """
    c = as_col(col)
    pos = F.instr(c, marker)
    return (
        F.when(pos > 0, c.substr(pos + F.lit(len(marker)), F.length(c) + F.lit(1)))
        .when(c.isNotNull(), F.lit(""))
    )


def to_line(*cols, null_text: str = "null", sep: str = ",") -> Column:
    """Join fields into one CSV line; a null field prints as ``null``.

    ``concat_ws`` skips nulls, which would shift fields, so each field is
    coalesced to the literal text first.
    """
    parts = [F.coalesce(as_col(c).cast("string"), F.lit(null_text)) for c in cols]
    return F.concat_ws(sep, *parts)
