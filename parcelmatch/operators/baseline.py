"""Random partners with falling scores: a stand-in result for load tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..registry import NEIGHBOURS
from ..session import staged

DECAY = 0.9
HASH_DIGITS = 15


def hashed(*parts: Column | str) -> Column:
    """First 60 bits of the md5 of the parts joined by '_'."""
    return F.conv(F.substring(F.md5(F.concat_ws("_", *parts)), 1, HASH_DIGITS), 16, 10).cast("bigint")


def numbered(ids: DataFrame) -> DataFrame:
    """(prop_id, at): 0-based position in id order, without sorting in one task."""
    n = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = staged(
        ids.select("prop_id").repartitionByRange(n, "prop_id").sortWithinPartitions("prop_id").withColumn("pos", F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftright("pos", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # one row per partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = F.col("pos").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("part", part).join(starts, "part").select("prop_id", (F.col("start") + within).alias("at"))


def random_baseline(ids: DataFrame, k: int = NEIGHBOURS, seed: str = "0") -> DataFrame:
    """k partners per property, drawn with replacement; scores u*0.9, u*0.81, ..."""
    all_ids = staged(numbered(ids), "positions")
    total = all_ids.agg(F.count("*").alias("n")).scalar()
    drawn = all_ids.select(F.col("prop_id").alias("search_prop"), F.explode(F.sequence(F.lit(1), F.lit(k))).alias("sim_rank")).withColumn(
        "at", F.pmod(hashed(F.lit(seed), F.col("search_prop").cast("string"), F.col("sim_rank").cast("string")), F.greatest(total, F.lit(1)))
    )
    start = hashed(F.lit(seed), F.col("search_prop").cast("string")) / float(16**HASH_DIGITS)
    score = start * F.pow(F.lit(DECAY), F.col("sim_rank"))
    # Packed numbers take a few bytes a row in their file, so its size must not decide that all of them are broadcast.
    partners = all_ids.select("at", F.col("prop_id").alias("sim_prop")).hint("merge")
    return drawn.join(partners, "at").select("search_prop", "sim_prop", score.alias("sim_score"), "sim_rank")
