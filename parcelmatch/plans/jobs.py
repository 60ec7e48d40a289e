"""The whole job: folders of raw files -> scores, documents per metric, lookup tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features, signs, zones
from ..operators.combine import combine_scores
from ..operators.dedupe import keep_first
from ..operators.documents import publish_documents
from ..operators.history import history_pivot, union_years
from ..operators.neighbours import METRICS, nearest, score_rows
from ..registry import HISTORY_YEARS, PROJECTION_FEATURES
from ..session import staged, temporary_staging
from ..sources import fixed_width, listings, tables

# Files of an extract and the columns the job reads from them.
EXTRACT = {
    "PROP.TXT": {
        "prop_id": "bigint", "prop_type_cd": "string", "geo_id": "string", "py_addr_ml_deliverable": "string", "hood_cd": "string",
        "appraised_val": "double", "assessed_val": "double", "market_value": "double", "situs_num": "string", "situs_unit": "string",
        "situs_zip": "string", "imprv_state_cd": "string", "land_state_cd": "string",
    },
    "IMP_DET.TXT": {"prop_id": "bigint", "Imprv_det_type_desc": "string", "yr_built": "int", "imprv_det_area": "double"},
    "LAND_DET.TXT": {"prop_id": "bigint", "land_type_desc": "string", "ag_apply": "string", "size_square_feet": "double"},
    "MOBILE_HOME_INFO.TXT": {"prop_id": "bigint"},
    "STATE_CD.TXT": {"state_cd": "string", "ptd_state_cd_description": "string"},
}
YEARLY = {"prop_id": "bigint", "prop_val_yr": "int", "appraised_val": "double"}
GEODATA = "prop_id string, Address string, City string, State string, Lat string, Long string, geo_id string"


def read_extract(spark: SparkSession, folder: str, name: str, columns: dict[str, str], order: str | None = None) -> DataFrame:
    header = fixed_width.read_headers(spark, f"{folder}/headers.json")[name]
    return fixed_width.read_fixed_width(spark, f"{folder}/{name}", header["names"], header["lengths"], columns, list(columns), order)


def read_matrix(spark: SparkSession, extract: str, listing_folder: str, geodata: str) -> DataFrame:
    """One feature row per geocoded property; of repeated keys the line read first counts."""
    roll, improvements, land, mobile, codes = (read_extract(spark, extract, f, c, "ingest_seq") for f, c in EXTRACT.items())
    roll = keep_first(roll, ["prop_id"], ["ingest_seq"])
    codes = keep_first(codes, ["state_cd"], ["ingest_seq"])
    found = features.property_features(*[x.drop("ingest_seq") for x in (roll, codes, improvements, land, mobile)])
    scraped = keep_first(listings.read_listings(spark, listing_folder, order="ingest_seq"), ["id"], ["ingest_seq"]).drop("ingest_seq")
    places = tables.read_csv(spark, geodata, GEODATA, order="ingest_seq").withColumn("prop_id", F.col("prop_id").try_cast("bigint"))
    places = keep_first(places, ["prop_id"], ["ingest_seq"]).drop("ingest_seq")
    return features.hamming_encode(features.feature_matrix(places, found, features.listing_features(scraped)))


def read_history(spark: SparkSession, extracts: Sequence[str], years: Sequence[int]) -> DataFrame:
    read = [read_extract(spark, folder, "PROP.TXT", YEARLY, "ingest_seq") for folder in extracts]
    return history_pivot(union_years(read, "ingest_seq"), ["ingest_seq"], years)


def build_documents(
    spark: SparkSession, extract: str, listing_folder: str, geodata: str, adjacency: str, out: str, history: Sequence[str] = (),
    years: Sequence[int] = HISTORY_YEARS, default_lon: float | None = None,
) -> None:
    """Read the raw folders and write ``scores``, ``documents/metric=...`` and ``lookup`` below ``out``.

    ``extract``: folder of the current year's fixed-width files with headers.json; ``history``: such folders
    of all years (PROP.TXT). Nothing staged is left behind.
    """
    with temporary_staging(spark):
        matrix = staged(read_matrix(spark, extract, listing_folder, geodata), "matrix")
        edges = staged(zones.pool_edges(zones.adjacency(tables.read_edges(spark, adjacency)), matrix.where("zone IS NOT NULL").select("zone")), "edges")
        signed = signs.sign_bands(signs.property_vector(matrix), len(PROJECTION_FEATURES))
        scores = nearest(score_rows(matrix), edges).unionByName(signs.sign_neighbours(signed, edges))
        combine_scores(scores).write.parquet(f"{out}/scores")
        scores = spark.read.parquet(f"{out}/scores")
        published = matrix.drop("hamming", "flag_bits")
        past = staged(read_history(spark, list(history) or [extract], years), "history")
        for metric in (*METRICS, "lsh"):
            tables.write_documents(publish_documents(published, past, scores, metric, default_lon), f"{out}/documents/metric={metric}")
        tables.write_lookup_table(publish_documents(published, past, scores, METRICS[0], default_lon), f"{out}/lookup")
