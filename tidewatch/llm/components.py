"""Connected components of a link table, by joins and aggregates only.

Alternating large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond"): each step links a node's neighbours to
the smallest node it knows, until every node is linked to the smallest node of
its component alone.  A node's neighbours are never gathered: the step is a
``min`` aggregate (partial before the shuffle), dealt anew and joined back to the
links, so that Spark's adaptive skew join can split the links of a hot node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import FILE_LINKS, dealt_anew, in_few_files, materialise


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is linked to one smaller node at most, and such a node
    to none: then that is the smallest of its component."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    each = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return each.where("up > 1 OR up = 1 AND down = 1").isEmpty()


def connected_components(spark: SparkSession, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp) of every node that has a link to another one; ``comp`` is
    the smallest node of its component.  Nodes are longs; loops, repeated and
    null links are ignored; no links give an empty result.  ``links`` is read twice."""
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    edges = materialise(spark, in_few_files(edges, links.count(), FILE_LINKS), "edges")
    while not _are_stars(edges):
        n = edges.count()                                       # large has as many rows at most, small twice as many
        # large star: a node's larger neighbours go to the smallest of it and its neighbours
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(dealt_anew(lowest), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialise(spark, in_few_files(large, n, FILE_LINKS), "large")
        # small star: a node and its smaller neighbours go to the smallest of these
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(dealt_anew(lowest), "a")
        small = (
            joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(lowest.select("a", F.col("m").alias("b")))
            .where("a <> b").distinct()
        )
        edges = materialise(spark, in_few_files(small, 2 * n, FILE_LINKS), "edges")
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    return found.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())
