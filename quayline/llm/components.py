"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayline.llm.common import staged


def _stars(links: DataFrame) -> DataFrame:
    """One round: every vertex hands its larger neighbours, then its smaller ones, to its least
    neighbour.  Least neighbours are aggregates, so a vertex of any degree is summed before it is
    moved, and the joins are plain equi-joins that can be split where a vertex is frequent."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select(F.col("a").alias("_a"), F.least("a", "m").alias("m"))
    large = (
        both.filter("b > a")
        .join(least, F.col("a") == F.col("_a"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )
    # Every remaining link points from a larger vertex to a smaller one.
    least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "_a")
    moved = (
        large.join(least, F.col("a") == F.col("_a"))
        .filter("b <> m")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
    )
    own = least.select(F.col("_a").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(own).distinct()


def _digest(links: DataFrame) -> tuple:
    return tuple(
        links.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
    )


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (``a``, ``b`` of one orderable type) to ``vertex`` and ``root``, the least vertex of
    its component, for every vertex of a link.

    Alternates two kinds of star until nothing changes: a number of rounds that grows with the
    logarithm of the longest path, each written to the shared folder.  Links with a null end and
    links of a vertex to itself alone are dropped; an empty table gives none.
    """
    links = links.select("a", "b").dropna().filter("a <> b")
    links = staged(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    last, now = None, _digest(links)
    while now != last:
        links = staged(_stars(links), "links")
        last, now = now, _digest(links)
    return links.select(F.col("a").alias("vertex"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("vertex"), F.col("b").alias("root")).distinct()
    )
