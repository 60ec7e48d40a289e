"""Distances of one metric -> similarities in [0, 1]."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..registry import NEIGHBOURS


def combine_scores(scores: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """Keep rank <= k, invert and scale each metric over all of its rows.

    (max - score) / (max - min) does both in one step; 0 where all scores are equal. The
    per-metric extremes are one partial aggregate, a handful of rows. Sign-projection scores
    (metric 'lsh') are constant similarities already and stay as they are.
    """
    kept = scores.where(F.col("sim_rank") <= k)
    ends = kept.groupBy("metric").agg(F.min("sim_score").alias("_lo"), F.max("sim_score").alias("_hi"))
    span = F.col("_hi") - F.col("_lo")
    similarity = F.when(F.col("sim_score").isNotNull(), F.when(span > 0, (F.col("_hi") - F.col("sim_score")) / span).otherwise(F.lit(0.0)))
    similarity = F.when(F.col("metric") == "lsh", F.col("sim_score")).otherwise(similarity)
    return kept.join(ends, "metric").select("search_prop", "sim_prop", similarity.alias("sim_score"), "sim_rank", "metric")
