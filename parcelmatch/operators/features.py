"""Raw appraisal, listing and geocode tables -> one feature row per property."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.codes import code_bits, code_text
from ..registry import FLAGS, MEASURES
from .dedupe import keep_first

MAX_CODES = 1000


def improvement_features(details: DataFrame) -> DataFrame:
    """Per property: oldest year, floor area and five keyword flags.

    ``details``: prop_id, imprv_det_type_desc, yr_built, imprv_det_area.
    """
    details = t.finite_columns(details)
    words = F.upper("imprv_det_type_desc")
    flags = {name: t.has_any(words, keys) for name, keys in t.IMPROVEMENT_WORDS.items()}
    floor = F.when(t.has_any(words, (t.FLOOR_WORD,)) == 1, F.col("imprv_det_area"))
    return details.groupBy("prop_id").agg(
        F.min("yr_built").alias("yr_built"),
        F.coalesce(F.sum(floor), F.lit(0.0)).alias("building_sqft"),
        *[F.max(flag).alias(name) for name, flag in flags.items()],
    )


def land_features(details: DataFrame) -> DataFrame:
    """Per property: land area, any commercial and any agricultural land.

    ``details``: prop_id, land_type_desc, ag_apply, size_square_feet.
    """
    return t.finite_columns(details).groupBy("prop_id").agg(
        F.coalesce(F.sum("size_square_feet"), F.lit(0.0)).alias("land_sqft"),
        F.max(t.has_any(F.col("land_type_desc"), ("Commercial",))).alias("is_commercial"),
        F.max(t.flag(F.col("ag_apply") == "T")).alias("is_ag"),
    )


def mobile_flag(homes: DataFrame) -> DataFrame:
    return homes.select("prop_id").distinct().withColumn("is_mobile", F.lit(1))


def code_join(appraisal: DataFrame, codes: DataFrame) -> DataFrame:
    """Attach the state-code description and turn three text fields into flags."""
    described = appraisal.join(codes.select("state_cd", "ptd_state_cd_description"), F.col("imprv_state_cd") == F.col("state_cd"), "left")
    return described.withColumns({
        "is_deliverable": t.flag(F.col("py_addr_ml_deliverable") == "Y"),
        "is_residential": t.flag(F.col("prop_type_cd") == "R"),
        "is_unit": F.col("situs_unit").isNotNull().cast("int"),
    }).drop("py_addr_ml_deliverable", "prop_type_cd", "situs_unit")


def vocabulary(df: DataFrame, column: str, most: int = MAX_CODES) -> list[str]:
    """Distinct values of a code column, sorted; more than ``most`` are no code book and an error."""
    found = [r[0] for r in df.select(column).distinct().limit(most + 2).collect()]
    values = sorted(v for v in found if v is not None)
    if len(values) > most:
        raise ValueError(f"more than {most} values in {column!r}")
    return values


def one_hot(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """One 0/1 column per value; a missing value has 0 everywhere."""
    names: dict[str, str] = {}
    taken = {c.lower() for c in df.columns}
    for value in values:
        name = t.column_name(value)
        if name in names:
            raise ValueError(f"{value!r} and {names[name]!r} both become column {name!r}")
        if name.lower() in taken:
            raise ValueError(f"{value!r} becomes column {name!r}, which is there already")
        names[name] = value
    return df.withColumns({name: t.flag(F.col(column) == value) for name, value in names.items()})


def property_features(
    appraisal: DataFrame, codes: DataFrame, improvements: DataFrame, land: DataFrame, mobile: DataFrame,
    descriptions: Sequence[str] | None = None,
) -> DataFrame:
    """Appraisal row with its code flags, improvements, land and mobile-home flag."""
    if descriptions is None:
        descriptions = vocabulary(codes, "ptd_state_cd_description")
    base = one_hot(code_join(appraisal, codes), "ptd_state_cd_description", descriptions)
    return (
        base.join(improvement_features(improvements), "prop_id", "left")
        .join(land_features(land), "prop_id", "left")
        .join(mobile_flag(mobile), "prop_id", "left")
    )


def listing_features(listings: DataFrame) -> DataFrame:
    """Typed facts of scraped listings (id, address, zestimate, facts); fact-less ones are dropped."""
    facts = F.col("facts")

    def first(label: str) -> Column:
        return t.first_of(F.try_element_at(facts, F.lit(label)))

    estimate = F.when((F.col("zestimate") != "") & (F.col("zestimate") != "None"), F.col("zestimate"))
    found = listings.where(F.col("zestimate").isNotNull() | (F.size(F.coalesce(facts, F.create_map().cast("map<string,array<string>>"))) > 0))
    return found.select(
        t.number(F.col("id"), "bigint").alias("prop_id"),
        F.col("address").alias("address"),
        t.money(estimate).alias("zestimate"),
        first("type").alias("type"),
        t.number(first("yearbuilt"), "int").alias("yearbuilt"),
        t.floor_area(first("floorsize")).alias("floorsize"),
        t.number(first("beds")).alias("beds"),
        t.bathrooms(first("baths")).alias("baths"),
        *[t.flooring_flag(F.try_element_at(facts, F.lit("flooring")), w).alias(f"has_{w}") for w in t.FLOORING_WORDS],
        F.lit(1).alias("listing"),
    )


def geodata_columns(geodata: DataFrame) -> DataFrame:
    """Geocode table with its own address name and typed coordinates."""
    other = [c for c in geodata.columns if c not in ("Address", "Lat", "Long")]
    return geodata.select(
        *other, F.col("Address").alias("geo_address"), t.number(F.trim("Lat")).alias("lat"), t.number(F.trim("Long")).alias("lon")
    )


def feature_matrix(geodata: DataFrame, features: DataFrame, listings: DataFrame) -> DataFrame:
    """Geocoded properties with their appraisal and listing features.

    The geocode table decides which properties exist. Each input is one row per key already
    (see ``keep_first``).
    """
    joined = geodata_columns(geodata).join(features.drop("geo_id"), "prop_id", "left").join(listings, "prop_id", "left")
    return joined.na.fill(0, ["is_mobile", "listing"]).withColumn("zone", t.clean_zone(F.col("situs_zip")))


def hamming_encode(matrix: DataFrame, flags: Sequence[str] = FLAGS) -> DataFrame:
    """Add the Hamming code over ``flags`` as text and as bit mask."""
    return matrix.withColumns({"hamming": code_text(flags), "flag_bits": code_bits(flags)})


def score_matrix(matrix: DataFrame) -> DataFrame:
    """The columns scoring needs."""
    return hamming_encode(matrix).select(
        "prop_id", "zone", "listing", "lat", "lon", "hood_cd", "hamming", "flag_bits", *[F.col(m).cast("double").alias(m) for m in MEASURES]
    )


__all__ = [
    "code_join", "feature_matrix", "geodata_columns", "hamming_encode", "improvement_features", "keep_first", "land_features",
    "listing_features", "mobile_flag", "one_hot", "property_features", "score_matrix", "vocabulary",
]
