"""Property tables derived from the given tables.

Each view is one SQL text that both Spark and the checking engine run as it is; ``{name}``
stands for a table or an earlier view. Coordinates and texts are arithmetic on the columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
)

VIEWS = {
    "zone_pairs": """
        SELECT DISTINCT CAST(78700 + p_size AS STRING) AS a, CAST(78701 + p_size AS STRING) AS b
        FROM {part} WHERE p_size < 50""",
    "appraisal": """
        SELECT p_partkey AS prop_id,
          CASE WHEN p_type IN ('STANDARD', 'SMALL', 'MEDIUM') THEN 'R' ELSE 'P' END AS prop_type_cd,
          concat('G', CAST(p_partkey AS STRING)) AS geo_id,
          CASE WHEN p_type = 'PROMO' THEN 'N' WHEN p_type <> 'LARGE' THEN 'Y' END AS py_addr_ml_deliverable,
          CASE WHEN p_brand <> 'Brand#25' THEN p_brand END AS hood_cd,
          CASE WHEN p_partkey % 97 = 0 THEN 1e20 ELSE p_retailprice * 100 END AS appraised_val, p_retailprice * 95 AS assessed_val, p_retailprice * 110 AS market_value,
          CAST(p_partkey AS STRING) AS situs_num,
          CASE WHEN p_name LIKE 'small%' THEN '201' END AS situs_unit,
          concat(CAST(78700 + p_size AS STRING),
            CASE p_type WHEN 'ECONOMY' THEN '-1234' WHEN 'PROMO' THEN '.0' ELSE '' END) AS situs_zip,
          CASE WHEN p_type <> 'SMALL' THEN substr(p_type, 1, 2) END AS imprv_state_cd,
          substr(p_type, 1, 2) AS land_state_cd
        FROM {part}""",
    "state_codes": """
        SELECT DISTINCT substr(p_type, 1, 2) AS state_cd, concat(p_type, ' Residence') AS ptd_state_cd_description
        FROM {part}""",
    "improvements": """
        SELECT l_partkey AS prop_id,
          CASE WHEN l_quantity = 50 THEN 'Swimming pool' WHEN l_quantity = 49 THEN 'FIREPLACE, brick'
            WHEN l_quantity = 48 THEN 'Hvac residential' WHEN l_quantity = 47 THEN 'Garage' WHEN l_quantity = 46 THEN 'wood deck'
            WHEN l_quantity = 45 THEN 'Open Porch' WHEN l_quantity > 20 THEN '1st Floor' WHEN l_quantity > 10 THEN '2nd FLOOR'
            WHEN l_quantity > 5 THEN 'Obsolete' END AS imprv_det_type_desc,
          CASE WHEN l_linenumber <> 7 THEN year(l_shipdate) END AS yr_built,
          CASE WHEN l_linenumber = 5 AND l_quantity > 40 THEN CAST('NaN' AS DOUBLE) WHEN l_linenumber <> 6 THEN l_quantity * 10 END AS imprv_det_area
        FROM {lineitem}""",
    "land": """
        SELECT l_partkey AS prop_id,
          CASE WHEN l_discount > 0.095e0 THEN 'Commercial lot' WHEN l_discount > 0.005e0 THEN 'Pasture' END AS land_type_desc,
          CASE WHEN l_tax > 0.075e0 THEN 'T' WHEN l_tax > 0.005e0 THEN 'F' END AS ag_apply,
          CASE WHEN l_linenumber = 6 AND l_tax < 0.015e0 THEN CAST('NaN' AS DOUBLE) ELSE CAST(floor(l_extendedprice) AS DOUBLE) END AS size_square_feet
        FROM {lineitem}""",
    "mobile_homes": """
        SELECT l_partkey AS prop_id FROM {lineitem} WHERE l_quantity = 1""",
    "geodata_rows": """
        SELECT p_partkey AS prop_id, concat(CAST(p_partkey AS STRING), ' ', p_name, ' TX') AS Address, 'Austin' AS City, 'tx' AS State,
          CASE WHEN p_brand = 'Brand#13' THEN ' USA'
            ELSE CAST(round(30.1e0 + (p_size % 10) * 0.03e0 + (p_partkey * 7919 % 9973) * 0.000004e0, 6) AS STRING) END AS Lat,
          CAST(round(-97.9e0 + floor(p_size / 10.0e0) * 0.04e0 + (p_partkey * 104729 % 9967) * 0.000005e0, 6) AS STRING) AS Long,
          concat('G', CAST(p_partkey AS STRING)) AS geo_id, 1 AS ingest_seq
        FROM {part}
        UNION ALL
        SELECT p_partkey, concat('LATER ', p_name), 'Round Rock', 'TX', '0.0', '0.0', 'later', 2 FROM {part} WHERE p_name LIKE 'red%'""",
    "listing_texts": """
        SELECT CAST(p_partkey AS STRING) AS id, concat(CAST(p_partkey AS STRING), ' ', p_name, ' Austin, TX ', CAST(78700 + p_size AS STRING)) AS address,
          CASE WHEN p_type = 'SMALL' THEN concat('$1,', CAST(100 + p_size AS STRING), ',500')
            WHEN p_type = 'STANDARD' AND p_size % 2 = 0 THEN 'None' END AS zestimate,
          CASE WHEN p_type <> 'LARGE' THEN p_brand END AS type_text,
          CASE WHEN p_type = 'LARGE' THEN NULL WHEN p_size % 7 = 0 THEN '2005.0' ELSE CAST(1950 + p_partkey % 60 AS STRING) END AS yearbuilt_text,
          CASE WHEN p_type <> 'LARGE' THEN concat('1,', CAST(100 + p_partkey % 900 AS STRING), ' sqft') END AS floorsize_text,
          CASE WHEN p_type = 'LARGE' THEN NULL WHEN p_size % 11 = 3 THEN '12d' WHEN p_size % 11 = 5 THEN 'Infinity'
            ELSE CAST(1 + p_size % 5 AS STRING) END AS beds_text,
          CASE WHEN p_type = 'LARGE' THEN NULL WHEN p_size % 4 = 0 THEN '2 full, 1 half' WHEN p_size % 4 = 1 THEN '3 baths'
            WHEN p_size % 4 = 2 THEN '2.5' ELSE 'no data' END AS baths_text,
          CASE WHEN p_type = 'LARGE' THEN NULL WHEN p_name LIKE '%ring' THEN 'Hardwood, Tile' WHEN p_name LIKE '%bolt' THEN 'Carpet' END AS flooring_text
        FROM {part} WHERE p_type IN ('STANDARD', 'SMALL', 'LARGE')""",
    "history_rows": """
        SELECT o_custkey AS prop_id, year(o_orderdate) AS prop_val_yr, o_totalprice AS appraised_val, o_orderkey AS ingest_seq
        FROM {orders}""",
}

VIEWS["gazetteer"] = """
        SELECT concat(CAST(p_partkey AS STRING), ' ', p_name, ', Austin, TX ', CAST(78700 + p_size AS STRING)) AS address,
          p_size * 1.5e0 AS lat, p_partkey * -0.5e0 AS lng, 1 AS seq FROM {part} WHERE p_brand <> 'Brand#25'"""
VIEWS["typed_addresses"] = """
        SELECT p_partkey AS prop_id, CASE p_type
            WHEN 'SMALL' THEN concat(split_part(p_name, ' ', 2), ' ', split_part(p_name, ' ', 1), ' ', CAST(p_partkey AS STRING), ' tx ', CAST(78700 + p_size AS STRING))
            WHEN 'MEDIUM' THEN concat(CAST(p_partkey AS STRING), ' ', substr(p_name, 2), ' apt 4 Austin ', CAST(78700 + p_size AS STRING), '-1234')
            WHEN 'LARGE' THEN concat(CAST(p_partkey AS STRING), ' ', p_name, ' ', CAST(78800 + p_size AS STRING))
            WHEN 'PROMO' THEN concat(CAST(p_partkey AS STRING), ' elsewhere ', CAST(78700 + p_size AS STRING))
            ELSE concat(CAST(p_partkey AS STRING), ' ', upper(p_name), '. ', CAST(78700 + p_size AS STRING)) END AS address
        FROM {part}"""

_ROLL = ("prop_id", "prop_type_cd", "geo_id", "py_addr_ml_deliverable", "hood_cd", "appraised_val", "assessed_val", "market_value", "situs_num",
         "situs_unit", "situs_zip", "imprv_state_cd", "land_state_cd")
_LATER = {"hood_cd": "'LATER'", "situs_zip": "'00000'", "prop_type_cd": "'P'", "appraised_val": "1e0"}
_CHANGED = ", ".join(f"{_LATER[c]} AS {c}" if c in _LATER else c for c in _ROLL)
#: The roll with conflicting later lines for some properties.
VIEWS["appraisal_rows"] = f"""
        SELECT {", ".join(_ROLL)}, 2 AS ingest_seq FROM ({VIEWS["appraisal"]}) a
        UNION ALL SELECT {_CHANGED}, 3 AS ingest_seq FROM ({VIEWS["appraisal"]}) a WHERE prop_id % 5 = 0"""
VIEWS["listing_rows"] = f"""
        SELECT *, 2 AS ingest_seq FROM ({VIEWS["listing_texts"]}) l
        UNION ALL SELECT id, 'LATER' AS address, '$1' AS zestimate, 'LATER' AS type_text, '1900' AS yearbuilt_text, '1 sqft' AS floorsize_text, '9' AS beds_text,
          '9' AS baths_text, 'Tile' AS flooring_text, 3 AS ingest_seq
        FROM ({VIEWS["listing_texts"]}) l WHERE id LIKE '%3'"""

# Labels of a listing record and the text columns they come from.
LISTING_LABELS = ("type", "yearbuilt", "floorsize", "beds", "baths", "flooring")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived table as a lazy DataFrame over the given parquet files."""
    text = VIEWS[name]
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def view_sql(name: str) -> str:
    """The same text over the checking engine's tables."""
    text = VIEWS[name]
    for t in TABLES:
        text = text.replace("{" + t + "}", t)
    return text
