import pytest
from pyspark.sql import functions as F

from parcelmatch.operators import neighbours
from parcelmatch.operators.dedupe import keep_first
from parcelmatch.operators.zones import adjacency, pool_edges
from parcelmatch.plans import catalog, oracles
from scoring_fixture import ZONE_PAIRS, matrix


def plan(df):
    return df._jdf.queryExecution().toString()


def test_scoring_has_no_cross_join(spark, monkeypatch):
    seen = []
    stored = neighbours.staged

    def watch(df, label):
        seen.append(plan(df))
        return stored(df, label)

    for module in ("neighbours", "ranges", "blocks"):
        monkeypatch.setattr(f"parcelmatch.operators.{module}.staged", watch)
    edges = pool_edges(adjacency(spark.createDataFrame(ZONE_PAIRS, "a string, b string")))
    seen.append(plan(neighbours.nearest(neighbours.score_rows(matrix(spark)), edges)))
    assert len(seen) > 8
    for text in seen:
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert any("WindowGroupLimit" in text for text in seen)


def test_dedupe_cuts_before_the_shuffle(spark):
    text = plan(keep_first(spark.range(10).withColumn("v", F.rand(1)), ["id"], ["v"]))
    assert text.count("WindowGroupLimit") >= 2


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracles.oracle_sql())


def test_unknown_metric(spark):
    with pytest.raises(ValueError, match="unknown metrics"):
        neighbours.nearest(None, None, ("cosine",))
