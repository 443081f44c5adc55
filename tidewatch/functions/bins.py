"""Stepwise histogram bins.

A value belongs to the smallest upper edge that is >= the value; values
above the last edge (and NaN, which compares greater than everything) go to
the last edge.  The bin is found by arithmetic, not by searching an edge
array, so the expression is plain generated code with no per-row array or
lambda.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch import config
from tidewatch.functions.text import as_col


def bin_edges(start: float = config.BIN_START, step: float = config.BIN_STEP,
              count: int = config.BIN_COUNT) -> list[float]:
    """Upper edges start, start+step, ... (count of them)."""
    return [float(start + i * step) for i in range(count)]


def assign_bin(value, start: float = config.BIN_START, step: float = config.BIN_STEP,
               count: int = config.BIN_COUNT) -> Column:
    """Upper edge of the bin holding ``value``; null stays null.

    Edge ``i`` is ``start + i * step``.  The index estimate
    ``ceil((v - start) / step)`` is clamped to ``[0, count - 1]`` before
    rounding (NaN compares greatest in Spark, so it clamps to the last bin),
    then corrected by one step either way against the edges themselves, which
    are computed with the same double arithmetic as :func:`bin_edges`.  The
    answer is therefore exactly the smallest edge >= v, rounding included.
    """
    v = as_col(value).cast("double")
    last = count - 1

    def edge(i: Column) -> Column:
        return F.lit(float(start)) + i.cast("double") * F.lit(float(step))

    raw = (v - F.lit(float(start))) / F.lit(float(step))
    i0 = (
        F.when(raw <= F.lit(0.0), F.lit(0).cast("long"))
        .when(raw >= F.lit(float(last)), F.lit(last).cast("long"))
        .otherwise(F.ceil(raw))
    )
    lower = i0 - F.lit(1)
    idx = (
        F.when((i0 > F.lit(0)) & (edge(lower) >= v), lower)
        .when(edge(i0) >= v, i0)
        .otherwise(F.least(i0 + F.lit(1), F.lit(last).cast("long")))
    )
    return F.when(v.isNotNull(), edge(idx))
