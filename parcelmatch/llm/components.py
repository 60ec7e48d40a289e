"""Connected components of a link table, in rounds of stars, without driver or hot-key work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged


def _neighbours(links: DataFrame) -> DataFrame:
    return links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))


def _least(rows: DataFrame) -> DataFrame:
    """Per u the smallest of u and its neighbours; summed up before the shuffle and stored."""
    return staged(rows.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b of one integer type): root is the smallest
    node of its component.

    Every node's larger neighbours are linked to its smallest one, then its smaller neighbours
    likewise, until the links are stars around the roots. Rounds grow with the logarithm of the
    longest path; every round is stored, so lost executors re-read it.
    """
    links = staged(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    while True:
        both = staged(_neighbours(links), "both")
        large = both.where("v > u").join(_least(both), "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        large = staged(large.where("a <> b").distinct(), "large")
        down = large.select(F.col("b").alias("u"), F.col("a").alias("v"))  # to the smaller end
        least = _least(down)
        small = down.join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        small = small.unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
        after = staged(small.where("a <> b").distinct(), "links")
        if not _changed(links, after):
            break
        links = after
    return after.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        after.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )


def _changed(before: DataFrame, after: DataFrame) -> bool:
    """Whether two link tables differ, by count and checksum."""

    def total(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("b", "a"))).first()

    return total(before) != total(after)
