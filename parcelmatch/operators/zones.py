"""Zone adjacency and candidate pools."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def adjacency(pairs: DataFrame) -> DataFrame:
    """Undirected pairs (a, b) -> each direction once, as (zone, neighbour)."""
    a, b = pairs.columns[:2]
    ways = F.array(
        F.struct(F.col(a).alias("zone"), F.col(b).alias("neighbour")),
        F.struct(F.col(b).alias("zone"), F.col(a).alias("neighbour")),
    )
    return pairs.select(F.inline(ways)).distinct()


def pool_edges(adjacent: DataFrame, isolated: DataFrame | None = None) -> DataFrame:
    """Directed edges plus one self edge per zone: where a zone's candidates come from.

    ``isolated`` (column ``zone``) adds self edges for zones without any neighbour.
    """
    zones = adjacent.select("zone")
    if isolated is not None:
        zones = zones.unionByName(isolated.select("zone"))
    own = zones.distinct().select("zone", F.col("zone").alias("neighbour"))
    return adjacent.select("zone", "neighbour").unionByName(own).distinct()


def neighbour_lists(adjacent: DataFrame) -> DataFrame:
    """List form: one sorted array of neighbours per zone (bounded by the zone graph)."""
    return adjacent.groupBy("zone").agg(F.sort_array(F.collect_set("neighbour")).alias("neighbours"))


def require_zones(edges: DataFrame, wanted: list[str]) -> None:
    """Fail clearly when a requested zone is not in the adjacency map."""
    known = {r.zone for r in edges.where(F.col("zone").isin(wanted)).select("zone").distinct().collect()}
    missing = sorted(set(wanted) - known)
    if missing:
        raise ValueError(f"zones not in the adjacency map: {missing}")


def pool_sizes(properties: DataFrame, edges: DataFrame) -> DataFrame:
    """Properties, candidates per search property and candidate pairs of every zone edge.

    Counted from zone totals; no pair is formed.
    """
    counts = properties.groupBy("zone").agg(F.count("*").alias("n"))
    searched = counts.select("zone", F.col("n").alias("searched"))
    offered = counts.select(F.col("zone").alias("neighbour"), F.col("n").alias("offered"))
    own = (F.col("zone") == F.col("neighbour")).cast("long")
    return (
        edges.join(searched, "zone")
        .join(offered, "neighbour")
        .select("zone", "neighbour", "searched", (F.col("offered") - own).alias("candidates"))
        .withColumn("pairs", F.col("searched") * F.col("candidates"))
    )
