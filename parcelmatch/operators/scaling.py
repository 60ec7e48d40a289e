"""Min-max scaling with missing values ignored in the fit and kept in the result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import finite


def unit(value: Column, low: Column, high: Column) -> Column:
    """(value - low) / (high - low); 0 where the range is empty, NULL stays NULL."""
    return F.when(value.isNotNull(), F.when(high > low, (value - low) / (high - low)).otherwise(F.lit(0.0)))


def fit_range(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    """Smallest and largest value per column: one row, from partial aggregates."""
    known = {c: finite(F.col(c).cast("double")) for c in columns}
    ends = [end(known[c]).alias(f"{how}_{c}") for c in columns for how, end in (("min", F.min), ("max", F.max))]
    row = df.agg(*ends).first()
    return {c: (row[f"min_{c}"], row[f"max_{c}"]) for c in columns}


def min_max(df: DataFrame, columns: Sequence[str], fit: dict[str, tuple[float | None, float | None]] | None = None) -> DataFrame:
    """Scale ``columns`` to [0, 1] by ``fit``, by default the range of the table itself."""
    fit = fit or fit_range(df, columns)
    ends = {c: tuple(F.lit(x).cast("double") for x in fit[c]) for c in columns}
    return df.withColumns({c: unit(finite(F.col(c).cast("double")), *ends[c]) for c in columns})
