"""Scraped listings: files holding an array of open-ended JSON objects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import staged
from .tables import ingest_order

FIXED = ("id", "address", "zestimate")


def _fields(record: Column) -> list[Column]:
    lists = F.transform_values(F.map_filter(record, lambda k, v: ~k.isin(*FIXED) & v.isNotNull()), lambda k, v: F.from_json(v, "array<string>"))
    return [*[F.try_element_at(record, F.lit(c)).alias(c) for c in FIXED], lists.alias("facts")]


def read_large_arrays(spark: SparkSession, path: str, pattern: str = "*.json", order: str | None = None) -> DataFrame:
    """Like ``read_listings`` for array files of any size: each is read by as many tasks as it has blocks.

    Files are cut behind every ``}``, wherever it stands. The quotes before a piece tell whether it begins inside
    a text, the brackets outside of texts how deep it is; both are sums over the pieces before it, first within
    a block, then over the blocks of a file (a row each). A record ends where the depth is back at the array's.
    """
    pieces = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).option("lineSep", "}").text(path)
    place = ["file", "block"]
    rows = pieces.select("value", F.inline(F.array(ingest_order())))
    plain = F.regexp_replace("value", r"(?s)\\.", "")  # without escaped characters
    rows = staged(rows.withColumn("plain", plain).withColumn("quotes", F.length("plain") - F.length(F.replace("plain", F.lit('"'), F.lit("")))), "array-pieces")
    earlier = Window.partitionBy(*place).orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    blocks = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)

    def running(df: DataFrame, what: str, into: str) -> DataFrame:
        """The sum of ``what`` over all pieces of the file before each piece."""
        totals = df.groupBy(*place).agg(F.sum(what).alias("_all")).withColumn("_before", F.coalesce(F.sum("_all").over(blocks), F.lit(0))).drop("_all")
        return df.join(totals, place).withColumn(into, F.col("_before") + F.coalesce(F.sum(what).over(earlier), F.lit(0))).drop("_before")

    quoted = running(rows, "quotes", "before").withColumn("inside", F.col("before") % 2 == 1)
    shown = F.concat(F.when(F.col("inside"), '"').otherwise(""), "plain")
    shown = F.regexp_replace(shown, '"[^"]*(?:"|$)', "")  # without texts
    ended = (F.col("before") + F.col("quotes")) % 2 == 0  # the cut is outside of a text
    opened = F.length(F.regexp_replace(shown, r"[^{]", "")) - F.when(ended, 1).otherwise(0)
    deep = running(quoted.withColumns({"deep": opened, "ended": ended}).drop("before", "plain"), "deep", "depth")
    closing = (F.col("ended") & (F.col("depth") + F.col("deep") == 0)).cast("int")
    numbered = running(staged(deep.withColumn("closing", closing).select("value", *place, "line", "closing"), "array-depths"), "closing", "record")
    whole = numbered.groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("block", "line", "value"))).alias("p"), F.max("closing").alias("closed"))
    text = F.concat(F.ltrim(F.array_join(F.col("p.value"), "}"), F.lit("[, \n\r\t")), F.lit("}"))
    records = whole.where("closed = 1").select("file", "record", F.from_json(text, "map<string,string>").alias("r"))
    return records.select(*_fields(F.col("r")), *([] if order is None else [F.struct("file", "record").alias(order)]))



def read_listings(
    spark: SparkSession, path: str, name_part: str = "", per_line: bool = False, pattern: str = "*.json", order: str | None = None
) -> DataFrame:
    """id, address, zestimate and all other keys as map label -> list of texts.

    Reads every file matching ``pattern`` below ``path`` whose path contains ``name_part``. A scrape batch is one
    array: a small file of its own, or with ``per_line`` a line of a larger, splittable file. ``order`` names a
    column that tells which record was read first: file, place of the array, place in the array.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    files = reader.text(path, wholetext=not per_line)
    if name_part:
        files = files.where(F.col("_metadata.file_path").contains(name_part))
    arrays = files.select(F.from_json("value", "array<map<string,string>>").alias("a"), ingest_order().alias("o"))
    records = arrays.select("o", F.posexplode("a").alias("at", "r"))
    place = [] if order is None else [F.struct("o", "at").alias(order)]
    return records.select(*_fields(F.col("r")), *place)
