"""Lookup joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPREAD = 256


def attach(rows: DataFrame, dim: DataFrame, on: Sequence[str], spread: Column, how: str = "left", parts: int = SPREAD) -> DataFrame:
    """Join ``rows`` with ``dim`` (one row per key) so that no task holds a whole hot key.

    Rows are salted; the distinct (salt, key) pairs -- at most ``parts`` per key -- fetch the
    ``dim`` row first, then every salt joins its own copy. Keys must not be NULL.
    ``rows`` is read twice and should be a stored table.
    """
    on = list(on)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(parts)).cast("int"))
    found = salted.select("_salt", *on).distinct().join(dim, on, "inner")
    return salted.join(found, ["_salt", *on], how).drop("_salt")
