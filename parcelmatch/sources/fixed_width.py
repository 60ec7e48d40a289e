"""Fixed-width appraisal extracts."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import number
from .tables import ingest_order


def read_headers(spark: SparkSession, path: str) -> dict[str, dict[str, list]]:
    """Header map {file: {"names": [...], "lengths": [...]}}, a small JSON file."""
    return json.loads("\n".join(r.value for r in spark.read.text(path).collect()))


def _cuts(names: Sequence[str], widths: Sequence[int], types: Mapping[str, str], columns: Sequence[str]) -> dict[str, Column]:
    """The wanted columns of a line ``value``."""
    if len(names) != len(widths):
        raise ValueError(f"{len(names)} names for {len(widths)} widths")
    place = {n: (1 + sum(widths[:i]), w) for i, (n, w) in enumerate(zip(names, widths))}
    cuts = {}
    for name in columns:
        cut = F.nullif(F.trim(F.substring("value", *place[name])), F.lit(""))
        kind = types.get(name, "string")
        cuts[name] = cut if kind == "string" else number(cut, kind)
    return cuts


def read_yearly(
    spark: SparkSession, path: str, layouts: Mapping[int, tuple[Sequence[str], Sequence[int]]], columns: Mapping[str, str], pattern: str = "*", order: str | None = None
) -> DataFrame:
    """Lines of all years below ``path`` (folders ``year=...``), each year by its own layout (names, widths); with column ``year``.

    A filter on ``year`` leaves out folders before any file is opened. A column that a year's layout lacks is
    NULL there; a year without a layout is an error.
    """
    lines = spark.read.schema("value string, year int").option("pathGlobFilter", pattern).text(path)
    fields = []
    for name, kind in columns.items():
        value = F.raise_error(F.concat(F.lit("no layout for year "), F.col("year").cast("string"))).cast(kind)
        for year, (names, widths) in sorted(layouts.items()):
            cut = _cuts(names, widths, columns, [name])[name] if name in names else F.lit(None).cast(kind)
            value = F.when(F.col("year") == year, cut).otherwise(value)
        fields.append(value.alias(name))
    if order is not None:
        fields.append(ingest_order().alias(order))
    return lines.select("year", *fields)


def read_fixed_width(
    spark: SparkSession, paths: str | Sequence[str], names: Sequence[str], widths: Sequence[int],
    types: Mapping[str, str] | None = None, columns: Sequence[str] | None = None, order: str | None = None,
) -> DataFrame:
    """Lines cut at fixed widths, trimmed; blank is NULL and a misfit of the type is NULL.

    Only ``columns`` are cut out of the line. ``order`` names a column that tells which line was
    read first: file, place of the block in it, line in the block.
    """
    fields = [cut.alias(name) for name, cut in _cuts(names, widths, types or {}, columns or names).items()]
    if order is not None:
        fields.append(ingest_order().alias(order))
    return spark.read.text(paths if isinstance(paths, str) else list(paths)).select(*fields)
