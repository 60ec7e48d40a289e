from pyspark.sql import functions as F

from parcelmatch.operators.baseline import random_baseline
from parcelmatch.operators.lookup import neighbour_view


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_random_baseline_broadcasts_no_ids(spark):
    """The ids fit the broadcast threshold as a file, but grow many times in the driver's memory."""
    found = random_baseline(spark.range(50).withColumnRenamed("id", "prop_id"), k=3)
    assert "BroadcastHashJoin" not in plan(found)
    rows = found.collect()
    assert len(rows) == 150 and {r.sim_rank for r in rows} == {1, 2, 3}
    assert {r.sim_prop for r in rows} <= set(range(50)) and all(0 <= r.sim_score < 1 for r in rows)


def test_neighbour_view_broadcasts_no_links(spark, tmp_path):
    others = F.array(*[F.struct(((F.col("id") + i) % 40).alias("_id"), F.lit(i).alias("rank")) for i in (1, 2)])
    docs = spark.range(40).select(F.col("id").alias("_id"), (F.col("id") * 10).alias("land_sqft"), others.alias("similar"))
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    found = neighbour_view(docs, docs, columns=("rank", "land_sqft"))
    assert "BroadcastHashJoin" not in plan(found)
    rows = [tuple(r) for r in found.where("search_id = 39").collect()]
    assert rows == [(39, 39, 0, 390), (39, 0, 1, 0), (39, 1, 2, 10)]
