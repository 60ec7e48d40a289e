"""CSV, parquet and JSON tables read and written by the jobs."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import grams
from ..registry import LISTING_ZONES, SCORES
from ..session import staged


def ingest_order(*more: Column) -> Column:
    """Which row was read first: by file, place of its block in the file, line in the block, and ``more``.

    Only comparable inside a block are the line numbers; how Spark packs blocks into tasks does not matter.
    """
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")]
    return F.struct(*place, *more)


def read_csv(spark: SparkSession, path: str, schema: str, name_glob: str | None = None, order: str | None = None) -> DataFrame:
    """CSV files with a header and an explicit schema; nothing is inferred, other columns are an error.

    ``order`` names a column that tells which line was read first.
    """
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob).option("recursiveFileLookup", True)
    rows = reader.csv(path)
    return rows if order is None else rows.select("*", ingest_order().alias(order))


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """Headerless pairs of adjacent zones."""
    return spark.read.schema("a string, b string").csv(path).selectExpr("trim(a) AS a", "trim(b) AS b")


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """All score part files of a folder as one table."""
    return read_csv(spark, path, SCORES, "*.csv")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


def zone_subset(properties: DataFrame, zones: Sequence[str | int] = LISTING_ZONES) -> DataFrame:
    return properties.where(F.col("zone").isin([str(z) for z in zones]))


def write_by_zone(properties: DataFrame, path: str, zones: Sequence[str | int] = LISTING_ZONES) -> None:
    """One partition folder per listed zone."""
    zone_subset(properties, zones).write.partitionBy("zone").parquet(path)


def write_documents(documents: DataFrame, path: str) -> None:
    """One JSON object per line."""
    documents.write.json(path)


LAYOUT = "buckets int, columns string"


def write_keyed(df: DataFrame, path: str, key: str = "_id", buckets: int | None = None) -> None:
    """A table bucketed and sorted by ``key``: tables with as many buckets join on it without a shuffle.

    The layout is written beside the data, so another session can read it (``read_keyed``).
    """
    spark = df.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"keyed_{uuid.uuid4().hex}"
    dealt = df.repartition(count, key)  # one file per bucket
    dealt.write.bucketBy(count, key).sortBy(key).option("path", f"{path}/data").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    spark.createDataFrame([(count, df.schema.toDDL())], LAYOUT).coalesce(1).write.json(f"{path}/layout")


def read_keyed(spark: SparkSession, path: str, key: str = "_id") -> DataFrame:
    """A table of ``write_keyed`` with its layout."""
    layout = spark.read.schema(LAYOUT).json(f"{path}/layout").first()
    name = f"keyed_{uuid.uuid4().hex}"
    where = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({layout.columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {layout.buckets} BUCKETS LOCATION '{where}/data'")
    return spark.table(name)


def write_lookup_table(documents: DataFrame, path: str) -> None:
    """Three copies and an index: sorted by id and by address, so lookups by either skip files by their column
    statistics; bucketed by id, for joins; and the grams of the addresses, sorted, for substring search."""
    documents = staged(documents, "documents")
    documents.repartitionByRange("_id").sortWithinPartitions("_id").write.parquet(f"{path}/by_id")
    by_address = documents.repartitionByRange("address", "_id").sortWithinPartitions("address", "_id").write
    by_address.option("parquet.bloom.filter.enabled#address", "true").parquet(f"{path}/by_address")
    write_keyed(documents, f"{path}/keyed")
    postings = documents.select("_id", F.explode(grams(F.col("address"))).alias("gram"))
    postings.repartitionByRange("gram", "_id").sortWithinPartitions("gram", "_id").write.parquet(f"{path}/grams")


def read_lookup_table(spark: SparkSession, path: str, by: str = "id") -> DataFrame:
    """The copy sorted by ``id`` or by ``address``, the one bucketed by id (``key``), or the ``grams``."""
    if by == "key":
        return read_keyed(spark, f"{path}/keyed")
    return spark.read.parquet(f"{path}/{by}" if by == "grams" else f"{path}/by_{by}")
