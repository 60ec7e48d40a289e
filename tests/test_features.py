import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from parcelmatch.functions import codes, text
from parcelmatch.operators import features
from parcelmatch.operators.combine import combine_scores
from parcelmatch.operators.dedupe import keep_first
from parcelmatch.operators.facts import address_inputs, geocode_enrich, page_facts
from parcelmatch.operators.history import history_pivot, union_years
from parcelmatch.operators.scaling import min_max
from parcelmatch.operators.zones import adjacency, neighbour_lists, pool_edges, require_zones
from parcelmatch.sources import fixed_width, listings, tables


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_improvements(spark):
    details = spark.createDataFrame([
        (1, "1st Floor", 1990, 1000.0), (1, "2nd FLOOR", 1995, 500.0), (1, "open porch", 1988, 80.0), (1, "Garage", None, 400.0),
        (2, "HVAC residential", 2001, None), (2, None, 2003, 10.0), (3, "1st floor", None, None),
    ], "prop_id bigint, imprv_det_type_desc string, yr_built int, imprv_det_area double")
    got = features.improvement_features(details).select(
        "prop_id", "yr_built", "building_sqft", "has_outdoor_space", "has_garage", "has_pool", "has_central_air", "has_fireplace"
    )
    assert rows(got, "prop_id") == [(1, 1988, 1500.0, 1, 1, 0, 0, 0), (2, 2001, 0.0, 0, 0, 0, 1, 0), (3, None, 0.0, 0, 0, 0, 0, 0)]


def test_land(spark):
    details = spark.createDataFrame(
        [(1, "Commercial lot", "F", 100.0), (1, "Pasture", "T", 50.0), (2, "commercial", None, None)],
        "prop_id bigint, land_type_desc string, ag_apply string, size_square_feet double",
    )
    assert rows(features.land_features(details), "prop_id") == [(1, 150.0, 1, 1), (2, 0.0, 0, 0)]


def test_code_join_and_one_hot(spark):
    cd = spark.createDataFrame([("A1", "Single Family Residence")], "state_cd string, ptd_state_cd_description string")
    props = spark.createDataFrame(
        [(1, "A1", "Y", "R", "201"), (2, None, "N", "P", None)],
        "prop_id bigint, imprv_state_cd string, py_addr_ml_deliverable string, prop_type_cd string, situs_unit string",
    )
    coded = features.code_join(props, cd)
    hot = features.one_hot(coded, "ptd_state_cd_description", features.vocabulary(cd, "ptd_state_cd_description"))
    assert not {"none", "nan", "null"} & set(hot.columns)
    got = rows(hot.select("prop_id", "is_deliverable", "is_residential", "is_unit", "single_family_residence"), "prop_id")
    assert got == [(1, 1, 1, 1, 1), (2, 0, 0, 0, 0)]
    with pytest.raises(ValueError, match="both become"):
        features.one_hot(coded, "ptd_state_cd_description", ["A b", "a B"])
    with pytest.raises(ValueError, match="there already"):
        features.one_hot(coded, "ptd_state_cd_description", ["Prop_ID"])
    with pytest.raises(ValueError, match="more than"):
        features.vocabulary(spark.range(9).selectExpr("string(id) AS x"), "x", 5)


def test_keep_first_is_idempotent(spark):
    df = spark.createDataFrame([(7, "a", 1), (8, "b", 2), (7, "c", 3), (None, "d", 4)], "id bigint, v string, seq int")
    once = keep_first(df, ["id"], ["seq"])
    assert rows(once.select("id", "v"), "id") == [(7, "a"), (8, "b")]
    assert rows(keep_first(once, ["id"], ["seq"]), "id") == rows(once, "id")


def test_listing_parsing(spark):
    F_ = "map<string,array<string>>"
    df = spark.createDataFrame([
        ("1", "a", "$1,250,000", {"baths": ["2 full, 1 half"], "floorsize": ["1,500 sqft"], "yearbuilt": ["1990"], "flooring": ["Hardwood, Tile"]}),
        ("2", "b", "None", {"baths": ["3 baths"], "floorsize": [], "yearbuilt": ["2005.0"]}),
        ("3", "c", "", {"baths": ["2.5"], "yearbuilt": ["no data"]}),
        ("4", "d", None, {"baths": ["10"]}), ("5", "e", None, {}), ("6", "f", None, {"baths": ["none"], "beds": ["NaN"]}),
    ], f"id string, address string, zestimate string, facts {F_}")
    got = rows(features.listing_features(df).select(
        "prop_id", "zestimate", "floorsize", "yearbuilt", "baths", "beds", "has_hardwood", "has_carpet", "has_tile"), "prop_id")
    assert got == [
        (1, 1250000.0, 1500.0, 1990, 2.5, None, 1, 0, 1), (2, None, None, None, 3.0, None, 0, 0, 0), (3, None, None, None, 4.5, None, 0, 0, 0),
        (4, None, None, None, 1.0, None, 0, 0, 0), (6, None, None, None, None, None, 0, 0, 0),
    ]


def test_listing_files(spark, tmp_path):
    batch = [{"id": str(i), "address": f"{i} St", "beds": [str(i)], "lot": ["1", "2"]} for i in range(3)]
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "output-1.json").write_text(json.dumps(batch, indent=1))
    (tmp_path / "deep" / "other.json").write_text(json.dumps(batch))
    (tmp_path / "output.txt").write_text("x")
    got = rows(listings.read_listings(spark, str(tmp_path), "output").select("id", F.size("facts"), F.element_at("facts", "lot")), "id")
    assert got == [(str(i), 2, ["1", "2"]) for i in range(3)]


def test_zone_clean_and_adjacency(spark):
    df = spark.createDataFrame([("78704-1234",), ("78704.0",), (None,)], "z string")
    assert [r[0] for r in df.select(text.clean_zone(F.col("z"))).collect()] == ["78704", "78704", None]
    pairs = spark.createDataFrame([("1", "2"), ("2", "3"), ("3", "2")], "a string, b string")
    near = adjacency(pairs)
    assert rows(near, "zone", "neighbour") == [("1", "2"), ("2", "1"), ("2", "3"), ("3", "2")]
    assert rows(neighbour_lists(near), "zone") == [("1", ["2"]), ("2", ["1", "3"]), ("3", ["2"])]
    isolated = spark.createDataFrame([("9",)], "zone string")
    assert pool_edges(near, isolated).where("zone = '9'").count() == 1
    with pytest.raises(ValueError, match="not in the adjacency map"):
        require_zones(pool_edges(near), ["1", "8"])


def test_hamming(spark):
    df = spark.createDataFrame([("1010", "1011", "H", "H"), ("1010", "0010", "H", "G"), ("1010", "1010", None, None)], "a string, b string, x string, y string")
    ham = codes.text_hamming(F.col("a"), F.col("b"), F.col("x"), F.col("y"))
    assert [r[0] for r in df.select(ham).collect()] == [1, 2, 1]
    with pytest.raises(PySparkException, match="unequal length"):
        spark.createDataFrame([("10", "1", "H", "H")], "a string, b string, x string, y string").select(ham).collect()


def test_address_and_facts(spark):
    df = spark.createDataFrame([(1, "3114 CONGRESS AVE TX 78704", "TX", "78704")], "prop_id bigint, address string, state string, zone string")
    assert address_inputs(df).first().address == "3114 CONGRESS AVE Austin, TX 78704"
    found = spark.createDataFrame(
        [(1, 0, "Year built:\n1990", "1990"), (1, 2, "Type: Condo", "Condo"), (1, 1, "Type: House", "House"), (1, 3, "x", "x")],
        "page_id bigint, seq int, parent string, child string",
    )
    assert page_facts(found).first().facts == {"yearbuilt": ["1990"], "type": ["house", "condo"]}
    gaz = spark.createDataFrame([("a", 1.0, 2.0)], "address string, lat double, lng double")
    gaz = gaz.selectExpr("*", "1 AS seq").unionByName(spark.createDataFrame([("a", 9.0, 9.0, 2), (None, 5.0, 5.0, 1)], "address string, lat double, lng double, seq int"))
    known = geocode_enrich(spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("a", 4)], "address string, id int"), gaz, "id", ["seq"])
    assert rows(known.select("id", "address", "lat", "lng"), "id") == [(1, "a", 1.0, 2.0), (2, "b", 0.0, 0.0), (3, None, 0.0, 0.0), (4, "a", 1.0, 2.0)]


def test_history(spark):
    one = spark.createDataFrame([(1, 2015, 10.0, 1), (1, 2016, 20.0, 2)], "prop_id bigint, prop_val_yr int, appraised_val double, seq int")
    two = spark.createDataFrame([(1, 2016, 99.0, 3), (2, 2018, 5.0, 4)], one.schema)
    assert union_years([one, two]).count() == 4
    got = history_pivot(one.unionByName(two), ["seq"])
    assert rows(got, "prop_id") == [(1, 10.0, 20.0, None, None), (2, None, None, None, 5.0)]
    with pytest.raises(PySparkException, match="year without a column: 2016"):
        history_pivot(one, ["seq"], (2015,)).collect()


def test_numbers_that_are_none(spark):
    df = spark.createDataFrame([("12d",), ("Infinity",), ("NaN",), ("1e400",), (" -1.5e1 ",), (".5",), ("1.",), ("",)], "v string")
    assert [r[0] for r in df.select(text.number(F.col("v"))).collect()] == [None, None, None, None, -15.0, 0.5, 1.0, None]
    nan = float("nan")
    details = spark.createDataFrame([(1, "1st floor", 1990, nan), (1, "2nd floor", 1991, 5.0), (2, "floor", 1990, float("inf"))], "prop_id bigint, imprv_det_type_desc string, yr_built int, imprv_det_area double")
    assert rows(features.improvement_features(details).select("prop_id", "building_sqft"), "prop_id") == [(1, 5.0), (2, 0.0)]
    scaled = min_max(spark.createDataFrame([(1, 2.0), (2, nan), (3, 4.0)], "id int, a double"), ["a"])
    assert rows(scaled, "id") == [(1, 0.0), (2, None), (3, 1.0)]


def test_ingest_order(spark, tmp_path):
    for name, lines in (("a.txt", "1 x\n1 y\n"), ("b.txt", "1 z\n2 w\n")):
        (tmp_path / name).write_text(lines)
    got = fixed_width.read_fixed_width(spark, str(tmp_path), ["id", "v"], [2, 1], {"id": "bigint"}, order="seq")
    assert rows(keep_first(got, ["id"], ["seq"]).select("id", "v"), "id") == [(1, "x"), (2, "w")]


def test_score_files_need_their_columns(spark, tmp_path):
    other = spark.createDataFrame([(1, 2, 1.0, 1, 37, "lsh")], "search_prop bigint, sim_prop bigint, sim_score double, sim_rank int, band_hits int, metric string")
    tables.write_csv(other, str(tmp_path / "bad"))
    with pytest.raises(Exception, match="FAILED_READ_FILE|header"):
        tables.read_parts(spark, str(tmp_path / "bad")).collect()
    tables.write_csv(other.drop("band_hits"), str(tmp_path / "good"))
    assert tables.read_parts(spark, str(tmp_path / "good")).first().metric == "lsh"


def test_scaling_and_combine(spark):
    df = spark.createDataFrame([(1, 2.0, 5.0), (2, None, 5.0), (3, 4.0, 5.0)], "id int, a double, b double")
    assert rows(min_max(df, ["a", "b"]), "id") == [(1, 0.0, 0.0), (2, None, 0.0), (3, 1.0, 0.0)]
    scores = spark.createDataFrame(
        [(1, 2, 1.0, 1, "m"), (1, 3, 3.0, 2, "m"), (1, 4, None, 3, "m"), (1, 5, 9.0, 21, "m"), (1, 2, 1.0, 1, "lsh")],
        "search_prop bigint, sim_prop bigint, sim_score double, sim_rank int, metric string",
    )
    got = rows(combine_scores(scores).where("metric = 'm'").select("sim_prop", "sim_score"), "sim_prop")
    assert got == [(2, 1.0), (3, 0.0), (4, None)]
    assert combine_scores(scores).where("metric = 'lsh'").first().sim_score == 1.0


def test_fixed_width_and_csv(spark, tmp_path):
    (tmp_path / "PROP.TXT").write_text("   12 abc 1.5\n    x     bad \n")
    got = fixed_width.read_fixed_width(spark, str(tmp_path / "PROP.TXT"), ["id", "t", "v"], [5, 4, 4], {"id": "bigint", "v": "double"}, ["id", "v", "t"])
    assert rows(got, "t") == [(None, None, None), (12, 1.5, "abc")] or rows(got, "id")[1] == (12, 1.5, "abc")
    with pytest.raises(ValueError, match="widths"):
        fixed_width.read_fixed_width(spark, str(tmp_path), ["a"], [1, 2])
    (tmp_path / "h.json").write_text('{"PROP.TXT": {"names": ["a"], "lengths": [3]}}')
    assert fixed_width.read_headers(spark, str(tmp_path / "h.json"))["PROP.TXT"]["lengths"] == [3]
    (tmp_path / "edges.csv").write_text("78701,78702\n78701,78703\n")
    assert adjacency(tables.read_edges(spark, str(tmp_path / "edges.csv"))).count() == 4
    typed = spark.createDataFrame([("007", 1)], "prop_id string, n int")
    tables.write_csv(typed, str(tmp_path / "out"))
    assert rows(tables.read_csv(spark, str(tmp_path / "out"), "prop_id string, n int"), "n") == [("007", 1)]
    zoned = spark.createDataFrame([(1, "78730"), (2, "1")], "prop_id bigint, zone string")
    tables.write_by_zone(zoned, str(tmp_path / "zones"))
    assert [d.name for d in (tmp_path / "zones").iterdir() if d.is_dir()] == ["zone=78730"]
