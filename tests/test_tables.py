import json

import pytest
from pyspark.sql import functions as F

from parcelmatch.operators import lookup
from parcelmatch.operators.dedupe import keep_first
from parcelmatch.sources import fixed_width, listings, tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_blocks(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_first_is_the_line_read_first_in_any_number_of_files(spark, tmp_path, small_blocks):
    """Later lines have smaller values, files are split into many blocks."""
    csv, json_ = tmp_path / "csv", tmp_path / "json"
    csv.mkdir()
    json_.mkdir()
    for f in range(3):
        rows = [(k % 40, 10_000 - 100 * f - k) for k in range(100)]
        (csv / f"part{f}.csv").write_text("id,v\n" + "".join(f"{i},{v}\n" for i, v in rows))
        (json_ / f"output{f}.json").write_text(json.dumps([{"id": str(i), "address": str(v)} for i, v in rows]))
    got = tables.read_csv(spark, str(csv), "id int, v int", order="o")
    assert got.rdd.getNumPartitions() > 5
    assert {tuple(r) for r in keep_first(got, ["id"], ["o"]).select("id", "v").collect()} == {(i, 10_000 - i) for i in range(40)}
    got = listings.read_listings(spark, str(json_), "output", order="o")
    assert {tuple(r) for r in keep_first(got, ["id"], ["o"]).select("id", "address").collect()} == {(str(i), str(10_000 - i)) for i in range(40)}


@pytest.fixture(scope="module")
def shelf(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("shelf"))
    names = ["BLUE GEAR", "RED BOLT", "GEARBOX", "", "AB", "A"]
    docs = spark.range(400).select(
        F.col("id").alias("_id"), F.when(F.col("id") % 50 != 7, F.element_at(F.array(*map(F.lit, names)), (F.col("id") % 6 + 1).cast("int"))).alias("address"),
        F.when(F.col("id") > 0, F.array(F.struct(F.lit(0).cast("bigint").alias("_id"), F.lit(1).alias("rank")))).otherwise(F.array().cast("array<struct<_id:bigint,rank:int>>")).alias("similar"),
    )
    tables.write_lookup_table(docs, path)
    return path


@pytest.mark.parametrize("part", ["gear", "lue g", "BLUE GEAR", "b", "AB", "r", "xyz", "gearz", "", "blue gear!", "ear"])
def test_substrings_through_the_grams(spark, shelf, part):
    docs, grams = (tables.read_lookup_table(spark, shelf, by) for by in ("key", "grams"))
    got = lookup.containing_indexed(docs, grams, part, page=500).collect()
    assert sorted(got) == sorted(lookup.containing(docs, part, page=500).collect())


def test_only_wanted_postings_are_read(spark, shelf):
    docs, grams = (tables.read_lookup_table(spark, shelf, by) for by in ("key", "grams"))
    text = plan(lookup.containing_indexed(docs, grams, "blue"))
    assert "In(gram, [BLU,LUE])" in text
    assert "StringStartsWith(gram,BL)" in plan(lookup.containing_indexed(docs, grams, "bl"))


def test_keyed_documents_are_not_shuffled(spark, shelf):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = tables.read_lookup_table(spark, shelf, "key")
        ids = spark.range(0, 400, 3).select(F.col("id").alias("_id"))
        text = plan(lookup.by_ids(docs, ids))
        assert "Join" in text and text.count("Exchange hashpartitioning") == 1  # of the ids alone
        lists = tables.read_lookup_table(spark, shelf, "key").select("_id", F.col("address").alias("a"))
        text = plan(docs.join(lists, "_id"))
        assert "Join" in text and "Exchange" not in text
        assert lookup.by_ids(docs, ids).count() == 134
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_result_table_sorted_by_another_column(spark, shelf):
    docs = tables.read_lookup_table(spark, shelf, "key").withColumn("land_sqft", F.col("_id") * -1)
    got = lookup.neighbour_view(docs, docs.where("_id IN (5, 9)"), sort_by="land_sqft", columns=("rank", "land_sqft")).collect()
    assert [(r["search_id"], r["_id"], r["rank"]) for r in got] == [(5, 5, 0), (5, 0, 1), (9, 9, 0), (9, 0, 1)]


def test_each_year_has_its_layout_and_a_year_filter_leaves_out_folders(spark, tmp_path):
    for year, line in ((2015, "  1 10.5"), (2016, "20.5 junk   2"), (2017, "  3")):
        (tmp_path / f"year={year}").mkdir()
        (tmp_path / f"year={year}" / "PROP.TXT").write_text(line + "\n")
    layouts = {2015: (("id", "v"), (3, 5)), 2016: (("v", "x", "id"), (5, 4, 4)), 2017: (("id",), (3,))}
    rows = fixed_width.read_yearly(spark, str(tmp_path), layouts, {"id": "int", "v": "double"}, "PROP.TXT")
    assert sorted(map(tuple, rows.collect())) == [(2015, 1, 10.5), (2016, 2, 20.5), (2017, 3, None)]
    some = rows.where("year >= 2017")
    assert "PartitionFilters: [isnotnull(year" in plan(some) and "(year#" in plan(some) and [tuple(r) for r in some.collect()] == [(2017, 3, None)]
    with pytest.raises(Exception, match="no layout for year 2017"):
        fixed_width.read_yearly(spark, str(tmp_path), {2015: layouts[2015], 2016: layouts[2016]}, {"id": "int"}).collect()


def test_a_large_array_is_read_by_several_tasks(spark, tmp_path, small_blocks):
    """Brackets, quotes and backslashes in texts; one line, many blocks."""
    odd = ["}", "{", '"', "\\\\", '\\"}', "],[", "a}b{c", "", "é}", "\\n"]
    records = [{"id": str(i), "address": odd[i % 10] * (i % 4), "zestimate": None, "beds": [odd[i % 7], "x"], "type": ["}" * (i % 3)]} for i in range(300)]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "big.json").write_text(json.dumps(records))
    (tmp_path / "a" / "small.json").write_text(json.dumps(records[:3], indent=1))
    (tmp_path / "a" / "none.json").write_text("[]")
    got = listings.read_large_arrays(spark, str(tmp_path / "a"), order="o")
    want = listings.read_listings(spark, str(tmp_path / "a"), order="o")
    text = lambda df: sorted((r["id"], r["address"], r["zestimate"], str(sorted(r["facts"].items()))) for r in df.collect())
    assert text(got) == text(want) and got.count() == 303
    assert spark.read.option("lineSep", "}").text(str(tmp_path / "a" / "big.json")).rdd.getNumPartitions() > 20
    first = keep_first(got.where("o.file LIKE '%big%'"), ["address"], ["o"]).orderBy("o").select("id").collect()
    assert [r["id"] for r in first] == [r["id"] for r in keep_first(want.where("o.o.file LIKE '%big%'"), ["address"], ["o"]).orderBy("o").select("id").collect()]
