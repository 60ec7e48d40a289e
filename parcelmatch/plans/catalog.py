"""Queries over the given tables, one per operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..functions import text as t
from ..functions.codes import text_hamming
from ..operators import baseline, facts, features, lookup, signs, zones
from ..operators.attach import attach
from ..operators.combine import combine_scores
from ..operators.dedupe import keep_first
from ..operators.documents import neighbour_list, publish_documents
from ..operators.history import history_pivot, union_years
from ..operators.neighbours import METRICS, nearest, pair_components, pool_ranges, score_rows
from ..operators.scaling import min_max
from ..registry import FLAGS, MEASURES, PROJECTION_FEATURES, SCORES
from ..session import staged, staging_root
from ..sources import fixed_width, listings, tables
from ..streaming.incremental import append_pending, outcomes
from ..streaming.maintenance import current_scores, refresh
from .views import LISTING_LABELS, table, view

YEARS = tuple(range(1995, 2002))  # columns of the pivot; a row of another year is an error
SIGN_ROWS, SIGN_BANDS = 8, 16
DIGITS = 6


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles rounded for comparison, integers as bigint."""
    columns = []
    for name, kind in df.dtypes:
        if kind == "double":
            columns.append(F.round(f"`{name}`", digits).alias(name))
        elif kind == "int":
            columns.append(F.col(f"`{name}`").cast("bigint").alias(name))
        else:
            columns.append(F.col(f"`{name}`"))
    return df.select(*columns)


def scratch(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


# Property tables -----------------------------------------------------------------------------

def listing_records(spark: SparkSession, sf: str) -> DataFrame:
    """One record per property: of several scrapes the first."""
    texts = keep_first(view(spark, sf, "listing_rows"), ["id"], ["ingest_seq"])
    every = F.map_from_arrays(F.array(*[F.lit(x) for x in LISTING_LABELS]), F.array(*[F.col(f"{x}_text") for x in LISTING_LABELS]))
    known = F.map_filter(every, lambda _, v: v.isNotNull())
    return texts.select("id", "address", "zestimate", F.transform_values(known, lambda _, v: F.array(v)).alias("facts"))


def geodata(spark: SparkSession, sf: str) -> DataFrame:
    return keep_first(view(spark, sf, "geodata_rows"), ["prop_id"], ["ingest_seq"]).drop("ingest_seq")


def appraisal_features(spark: SparkSession, sf: str) -> DataFrame:
    """Of several lines of a property the first counts; later ones go before any join."""
    roll = keep_first(view(spark, sf, "appraisal_rows"), ["prop_id"], ["ingest_seq"]).drop("ingest_seq")
    return features.property_features(roll, *[view(spark, sf, v) for v in ("state_codes", "improvements", "land", "mobile_homes")])


def full_matrix(spark: SparkSession, sf: str) -> DataFrame:
    found = features.listing_features(listing_records(spark, sf))
    return features.feature_matrix(geodata(spark, sf), appraisal_features(spark, sf), found)


def matrix(spark: SparkSession, sf: str) -> DataFrame:
    return features.score_matrix(full_matrix(spark, sf))


def adjacent(spark: SparkSession, sf: str) -> DataFrame:
    """Adjacency from a headerless file of pairs."""
    path = scratch(spark, "zone-pairs")
    view(spark, sf, "zone_pairs").write.csv(path)
    return zones.adjacency(tables.read_edges(spark, path))


def edges(spark: SparkSession, sf: str) -> DataFrame:
    return staged(zones.pool_edges(adjacent(spark, sf)), "edges")


def top_scores(spark: SparkSession, sf: str, metrics: tuple[str, ...] = METRICS) -> DataFrame:
    return nearest(score_rows(matrix(spark, sf)), edges(spark, sf), metrics)


def history_wide(spark: SparkSession, sf: str) -> DataFrame:
    return history_pivot(view(spark, sf, "history_rows"), ["ingest_seq"], YEARS)


def documents(spark: SparkSession, sf: str, scores: DataFrame, metric: str = "euclidean") -> DataFrame:
    return publish_documents(full_matrix(spark, sf), history_wide(spark, sf), scores, metric)


def property_signs(spark: SparkSession, sf: str, with_hits: bool = False) -> DataFrame:
    """Sign-projection neighbours of the raw features in own and adjacent zones, with the full signature."""
    vectors = signs.property_vector(full_matrix(spark, sf))
    return signs.sign_neighbours(signs.sign_bands(vectors, len(PROJECTION_FEATURES)), edges(spark, sf), with_hits=with_hits)


# Sources and sinks ---------------------------------------------------------------------------

CUSTOMER_NAMES = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
CUSTOMER_WIDTHS = (20, 25, 6, 16, 14)
CUSTOMER_TYPES = {"c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double"}


def fixed_lines(df: DataFrame, names: tuple[str, ...], widths: tuple[int, ...], *keep: str) -> DataFrame:
    padded = [F.rpad(F.coalesce(F.col(n).cast("string"), F.lit("")), w, " ") for n, w in zip(names, widths)]
    return df.select(F.concat(*padded).alias("value"), *keep)


def q_fixed_width_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "customer-txt")
    fixed_lines(table(spark, sf, "customer"), CUSTOMER_NAMES, CUSTOMER_WIDTHS).write.text(path)
    return rounded(fixed_width.read_fixed_width(spark, path, CUSTOMER_NAMES, CUSTOMER_WIDTHS, CUSTOMER_TYPES))


def q_history_long(spark: SparkSession, sf: str) -> DataFrame:
    """Yearly fixed-width extracts, one folder per year, read back as one long table: all years there are."""
    path = scratch(spark, "history-txt")
    names, widths = ("prop_id", "prop_val_yr", "appraised_val"), (20, 6, 24)
    rows = view(spark, sf, "history_rows").withColumn("year", F.col("prop_val_yr"))
    fixed_lines(rows, names, widths, "year").write.partitionBy("year").text(path)
    types = {"prop_id": "bigint", "prop_val_yr": "int", "appraised_val": "double"}
    return rounded(union_years([fixed_width.read_fixed_width(spark, path, names, widths, types)]))


def q_history_yearly(spark: SparkSession, sf: str) -> DataFrame:
    """Extracts whose layout changes from year to year, one folder per year; of these the later years."""
    path = scratch(spark, "yearly-txt")
    old, new = (("prop_id", "appraised_val", "prop_val_yr"), (20, 24, 6)), (("prop_val_yr", "note", "prop_id", "appraised_val"), (8, 5, 22, 26))
    rows = view(spark, sf, "history_rows").withColumns({"year": F.col("prop_val_yr"), "note": F.lit("x")})
    for layout, which in ((old, "year < 1998"), (new, "year >= 1998")):
        fixed_lines(rows.where(which), *layout, "year").write.mode("append").partitionBy("year").text(path)
    layouts = {year: old if year < 1998 else new for year in YEARS}
    types = {"prop_id": "bigint", "prop_val_yr": "int", "appraised_val": "double"}
    return rounded(fixed_width.read_yearly(spark, path, layouts, types).where("year >= 1997"))


def q_csv_scan_typed(spark: SparkSession, sf: str) -> DataFrame:
    """Write with header, read back with forced string columns."""
    path = scratch(spark, "geodata-csv")
    tables.write_csv(view(spark, sf, "geodata_rows"), path)
    schema = "prop_id string, Address string, City string, State string, Lat string, Long string, geo_id string, ingest_seq int"
    return rounded(tables.read_csv(spark, path, schema).withColumn("Lat", F.trim("Lat")))


def q_partition_by_zone(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "by-zone")
    properties = view(spark, sf, "appraisal").select("prop_id", t.clean_zone(F.col("situs_zip")).alias("zone"), "appraised_val")
    tables.write_by_zone(properties, path)
    back = spark.read.schema("prop_id bigint, appraised_val double, zone string").parquet(path)
    return rounded(back.select("prop_id", "zone", "appraised_val"))


def _listing_batches(spark: SparkSession, sf: str, size: int) -> DataFrame:
    """Scraped records, some in one JSON array."""
    record = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.concat(F.col("user_id").cast("string"), F.lit(" "), F.col("event_type")).alias("address"),
        F.when(F.col("event_type") != "view", F.concat(F.lit("$"), F.col("value").cast("string"))).alias("zestimate"),
        F.array(F.get_json_object("props", "$.k")).alias("beds"),
        F.when(F.col("event_type").isin("click", "error"), F.array(F.col("event_type"), F.lit("other"))).alias("type"),
    )
    batches = table(spark, sf, "events").groupBy(F.floor(F.col("event_id") / size).alias("batch")).agg(F.collect_list(record).alias("r"))
    return batches.select(F.to_json("r").alias("value"))


def _listing_columns(found: DataFrame) -> DataFrame:
    return rounded(found.select(
        F.col("id"), "address", "zestimate", F.size("facts").alias("n_facts"), t.first_of(F.try_element_at("facts", F.lit("type"))).alias("type"),
        t.number(t.first_of(F.try_element_at("facts", F.lit("beds")))).alias("beds"),
    ))


def q_listing_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of scraped records as JSON arrays of open-ended objects, read back."""
    path = scratch(spark, "output-listings")
    _listing_batches(spark, sf, 6).write.text(path)
    return _listing_columns(listings.read_listings(spark, path, "output", per_line=True, pattern="*.txt"))


def q_listing_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """The same records in files of one array each, read by any number of tasks per file."""
    path = scratch(spark, "listing-arrays")
    _listing_batches(spark, sf, 5000).write.option("maxRecordsPerFile", 1).text(path)
    return _listing_columns(listings.read_large_arrays(spark, path, pattern="*.txt"))


# Features ------------------------------------------------------------------------------------

def q_improvement_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.improvement_features(view(spark, sf, "improvements")))


def q_land_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.land_features(view(spark, sf, "land")))


def q_code_join(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.code_join(view(spark, sf, "appraisal"), view(spark, sf, "state_codes")))


def q_one_hot(spark: SparkSession, sf: str) -> DataFrame:
    coded = features.code_join(view(spark, sf, "appraisal"), view(spark, sf, "state_codes")).select("prop_id", "ptd_state_cd_description")
    return rounded(features.one_hot(coded, "ptd_state_cd_description", features.vocabulary(view(spark, sf, "state_codes"), "ptd_state_cd_description")))


def q_property_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(appraisal_features(spark, sf))


def q_listing_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.listing_features(listing_records(spark, sf)))


def q_feature_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(full_matrix(spark, sf).select(
        "prop_id", "geo_address", "City", "State", "lat", "lon", "zone", "hood_cd", *MEASURES, *FLAGS, "listing", "zestimate", "type", "address",
    ))


def q_dedupe_first(spark: SparkSession, sf: str) -> DataFrame:
    """First line per (order, line number); the order by all other columns is total."""
    lines = table(spark, sf, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    rest = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return rounded(keep_first(lines, keys, rest).select(*keys, *rest))


def q_hamming_encode(spark: SparkSession, sf: str) -> DataFrame:
    return features.hamming_encode(full_matrix(spark, sf)).select("prop_id", "hamming", "flag_bits")


def q_minmax_scale(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(min_max(matrix(spark, sf), MEASURES).select("prop_id", *MEASURES))


# Zones and pools -----------------------------------------------------------------------------

def q_clean_zone(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "appraisal").select("prop_id", "situs_zip", t.clean_zone(F.col("situs_zip")).alias("zone"))


def q_zone_adjacency(spark: SparkSession, sf: str) -> DataFrame:
    return adjacent(spark, sf)


def q_zone_filter(spark: SparkSession, sf: str) -> DataFrame:
    zoned = view(spark, sf, "appraisal").select("prop_id", t.clean_zone(F.col("situs_zip")).alias("zone"), "hood_cd")
    return zoned.where(F.col("zone") == "78704")


def q_candidate_pool(spark: SparkSession, sf: str) -> DataFrame:
    """Per zone: searched properties and candidates of each, self left out."""
    zoned = view(spark, sf, "appraisal").select("prop_id", t.clean_zone(F.col("situs_zip")).alias("zone"))
    sizes = zones.pool_sizes(zoned, zones.pool_edges(adjacent(spark, sf)))
    return sizes.groupBy("zone").agg(F.max("searched").alias("searched"), F.sum("candidates").alias("candidates"), F.count("*").alias("zones"))


def q_candidate_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Candidate pairs of every zone edge, counted without forming them."""
    zoned = view(spark, sf, "appraisal").select("prop_id", t.clean_zone(F.col("situs_zip")).alias("zone"))
    return zones.pool_sizes(zoned, zones.pool_edges(adjacent(spark, sf)))


# Scoring -------------------------------------------------------------------------------------

def _components(spark: SparkSession, sf: str) -> DataFrame:
    rows, links = score_rows(matrix(spark, sf)), edges(spark, sf)
    return pair_components(nearest(rows, links, ("euclidean",)), rows, pool_ranges(rows, links))


def q_hamming_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Hamming count of every listed Euclidean pair."""
    codes = staged(features.hamming_encode(full_matrix(spark, sf)).select("prop_id", "hamming", "hood_cd"), "codes")
    pairs = staged(top_scores(spark, sf, ("euclidean",)).select("search_prop", "sim_prop"), "pairs")
    theirs = codes.select(F.col("prop_id").alias("sim_prop"), F.col("hamming").alias("c_code"), F.col("hood_cd").alias("c_hood"))
    own = codes.select(F.col("prop_id").alias("search_prop"), "hamming", "hood_cd")
    both = attach(pairs, theirs, ["sim_prop"], F.col("search_prop"), "inner").join(own, "search_prop")
    ham = text_hamming(F.col("hamming"), F.col("c_code"), F.col("hood_cd"), F.col("c_hood"))
    return rounded(both.select("search_prop", "sim_prop", ham.alias("ham")))


def q_pair_scale(spark: SparkSession, sf: str) -> DataFrame:
    """Range of the Hamming count and the distance over each property's pool."""
    return rounded(pool_ranges(score_rows(matrix(spark, sf)), edges(spark, sf)))


def q_pair_distance(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_components(spark, sf))


def _sites(spark: SparkSession, sf: str) -> DataFrame:
    """Every line's property and the coordinates of it and of its supplier's nation."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    sites = features.geodata_columns(geodata(spark, sf)).select(F.col("prop_id").alias("l_partkey"), "lat", "lon")
    nations = table(spark, sf, "supplier").selectExpr("s_suppkey AS l_suppkey", "30D + s_nationkey * 1.5e-1 AS s_lat", "-98D + s_nationkey * 5e-2 AS s_lon")
    return lines.groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("n_lines")).join(sites, "l_partkey").join(nations, "l_suppkey")


def q_haversine_distance(spark: SparkSession, sf: str) -> DataFrame:
    km = geo.distance_km("haversine", "lat", "lon", "s_lat", "s_lon")
    return rounded(_sites(spark, sf).select("l_partkey", "l_suppkey", "n_lines", km.alias("km")))


def q_geodesic_distance(spark: SparkSession, sf: str) -> DataFrame:
    km = geo.distance_km("vincenty", "lat", "lon", "s_lat", "s_lon")
    return rounded(_sites(spark, sf).select("l_partkey", "l_suppkey", "n_lines", km.alias("km")))


def q_top_k_euclidean(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(top_scores(spark, sf, ("euclidean",)))


def q_top_k_manhattan(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(top_scores(spark, sf, ("manhattan",)))


def q_combine_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Part files of all three metrics, read as one table and turned into similarities."""
    path = scratch(spark, "score-parts")
    tables.write_csv(top_scores(spark, sf), f"{path}/distances")
    tables.write_csv(property_signs(spark, sf), f"{path}/lsh")
    return rounded(combine_scores(tables.read_parts(spark, path)))


def q_neighbour_list(spark: SparkSession, sf: str) -> DataFrame:
    lists = neighbour_list(top_scores(spark, sf), "euclidean")
    ids = F.transform("similar", lambda e: F.concat_ws(":", e["rank"].cast("string"), e["_id"].cast("string")))
    return lists.select("_id", F.array_join(ids, ",").alias("similar"))


def q_incremental_score(spark: SparkSession, sf: str) -> DataFrame:
    """Some properties by one metric, then what is missing of both, then a repeat that adds nothing; read back."""
    m, links, path = staged(matrix(spark, sf), "matrix"), edges(spark, sf), scratch(spark, "scores")
    some = m.where("hood_cd IN ('Brand#3', 'Brand#7')").select("prop_id")
    append_pending(m, links, path, metrics=("manhattan",), only=some)
    for _ in range(2):
        append_pending(m, links, path)
    return rounded(spark.read.schema(SCORES).parquet(path))


def q_score_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Attempts on record after two runs: every searched property and metric, with the length of its list."""
    m, links, path = staged(matrix(spark, sf), "matrix"), edges(spark, sf), scratch(spark, "scores")
    append_pending(m, links, path, metrics=("euclidean",), only=m.where("hood_cd IN ('Brand#3', 'Brand#7')").select("prop_id"))
    append_pending(m, links, path, metrics=("euclidean",))
    return rounded(outcomes(spark, path))


def q_refresh_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Lists of a part of the properties, brought up to date after the others have come and some have changed."""
    m, links, path = staged(matrix(spark, sf), "matrix"), edges(spark, sf), scratch(spark, "lists")
    early = m.where("prop_id % 50 <> 3").withColumn("hood_cd", F.expr("if(prop_id % 60 = 1, 'other', hood_cd)"))
    refresh(early, links, path)
    refresh(m, links, path)
    return rounded(current_scores(spark, path))


def q_random_baseline(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(baseline.random_baseline(view(spark, sf, "appraisal")))


# Sign projections ----------------------------------------------------------------------------

def _signatures(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("prop_id"), F.lit("*").alias("zone"), F.col("embedding").cast("array<double>").alias("vector")
    )
    return signs.sign_bands(vectors, 64, SIGN_ROWS, SIGN_BANDS)


def q_lsh_signature(spark: SparkSession, sf: str) -> DataFrame:
    return _signatures(spark, sf).select("prop_id", F.posexplode("bands").alias("band", "signature")).select(
        "prop_id", F.col("band").cast("bigint").alias("band"), "signature"
    )


def q_lsh_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(signs.sign_neighbours(_signatures(spark, sf), with_hits=True))


def q_property_lsh(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(property_signs(spark, sf, with_hits=True))


# History, documents, lookups -----------------------------------------------------------------

def q_history_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(history_wide(spark, sf))


DOCUMENT_COLUMNS = (
    "_id", "address", "geo_address", "City", "State", "Lat", "Long", "hood_cd", "situs_num", "type", "appraisal", "beds", "baths", "floorsize",
    "yr_built", "building_sqft", "land_sqft", "is_mobile", "has_pool", "zillow", "zestimate", "appraisal_1995", "appraisal_2001",
)


def q_publish_documents(spark: SparkSession, sf: str) -> DataFrame:
    """One set of documents per metric, written as JSON and read back; the neighbour list is flattened."""
    scores = staged(top_scores(spark, sf).unionByName(property_signs(spark, sf)), "scores")
    path = scratch(spark, "documents-json")
    for metric in (*METRICS, "lsh"):
        docs = documents(spark, sf, scores, metric)
        tables.write_documents(docs, f"{path}/metric={metric}")
    back = spark.read.schema(f"{docs.schema.toDDL()}, metric string").json(path)
    return rounded(_flat(back, "metric"))


def _flat(docs: DataFrame, *more: str) -> DataFrame:
    ids = F.transform("similar", lambda e: F.concat_ws(":", e["rank"].cast("string"), e["_id"].cast("string")))
    return docs.select(*DOCUMENT_COLUMNS, *more, F.array_join(ids, ",").alias("similar"))


def _lookup_path(spark: SparkSession, sf: str) -> str:
    path = scratch(spark, "lookup")
    docs = documents(spark, sf, top_scores(spark, sf, ("euclidean",)))
    tables.write_lookup_table(docs.withColumn("address", F.col("geo_address")), path)
    return path


def q_lookup_by_id(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_flat(lookup.by_id(tables.read_lookup_table(spark, _lookup_path(spark, sf)), "42")))


def q_lookup_by_address(spark: SparkSession, sf: str) -> DataFrame:
    """Exact address of property 7, typed in small letters."""
    typed = geodata(spark, sf).where("prop_id = 7").select(F.lower("Address")).first()[0]  # what a user would type
    return rounded(_flat(lookup.by_address(tables.read_lookup_table(spark, _lookup_path(spark, sf), "address"), typed)))


def q_lookup_contains(spark: SparkSession, sf: str) -> DataFrame:
    """First page of addresses with a part, through the grams."""
    path = _lookup_path(spark, sf)
    docs, grams = (tables.read_lookup_table(spark, path, by) for by in ("key", "grams"))
    return rounded(_flat(lookup.containing_indexed(docs, grams, "blue Gear")))


def q_lookup_by_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of all properties some supplier key names; the documents are not shuffled."""
    ids = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("_id"))
    return rounded(_flat(lookup.by_ids(tables.read_lookup_table(spark, _lookup_path(spark, sf), "key"), ids)))


def q_neighbour_view(spark: SparkSession, sf: str) -> DataFrame:
    """Result table of every property, itself and its neighbours, exported as CSV and read back."""
    path = scratch(spark, "documents-keyed")
    tables.write_keyed(documents(spark, sf, top_scores(spark, sf, ("euclidean",))), path)
    docs = tables.read_keyed(spark, path)
    shown = ("rank", "geo_address", "appraisal_2001", "appraisal_1995", "building_sqft", "land_sqft")
    table_ = lookup.neighbour_view(docs, docs, sort_by="land_sqft", columns=shown)
    path = scratch(spark, "result-csv")
    tables.write_csv(table_, path)
    return rounded(tables.read_csv(spark, path, table_.schema.toDDL()))


# Facts and addresses -------------------------------------------------------------------------

def q_page_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Every shown text of the stored pages as a fact: under the label before it, or under its element's name."""
    texts = facts.page_texts(table(spark, sf, "pages"))
    rows = facts.page_facts(facts.labelled_texts(texts)).select("page_id", F.explode("facts").alias("label", "values"))
    return rows.select("page_id", "label", F.array_join("values", "|").alias("values"))


def q_page_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Every shown text with its enclosing elements and the text before it."""
    return facts.page_texts(table(spark, sf, "pages"))


def q_normalize_address(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, "appraisal").select(
        "prop_id", F.concat_ws(" ", "situs_num", F.lit("CONGRESS AVE TX"), "situs_zip").alias("address"), F.lit("TX").alias("state"),
        F.col("situs_zip").alias("zone"),
    )
    return facts.address_inputs(rows)


def q_geocode_enrich(spark: SparkSession, sf: str) -> DataFrame:
    addresses = table(spark, sf, "supplier").join(
        table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left"
    ).select("s_suppkey", F.col("n_name").alias("address"))
    known = table(spark, sf, "nation").where("n_regionkey <> 3")
    gazetteer = known.selectExpr("n_name AS address", "n_nationkey * 1.5e0 AS lat", "n_nationkey * -2.5e0 AS lng", "1 AS seq").unionByName(
        known.selectExpr("n_name AS address", "-1e0 AS lat", "-1e0 AS lng", "2 AS seq")
    )
    return rounded(facts.geocode_enrich(addresses, gazetteer, "s_suppkey", ["seq"]))


def q_geocode_match(spark: SparkSession, sf: str) -> DataFrame:
    """Coordinates of addresses that are misspelt, reordered or unknown."""
    return rounded(facts.geocode_match(view(spark, sf, "typed_addresses"), view(spark, sf, "gazetteer"), "prop_id", ["seq"], ("AUSTIN", "TX")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: f for name, f in list(globals().items()) if name.startswith("q_")
}
