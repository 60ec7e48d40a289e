"""Hamming codes over flag columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_BITS = 63


def code_text(flags: Sequence[str]) -> Column:
    """'0'/'1' text in the order of ``flags``; a missing flag is 0."""
    return F.concat(*[F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("int").cast("string") for c in flags])


def code_bits(flags: Sequence[str]) -> Column:
    """The same code as a bit mask."""
    if len(flags) > MAX_BITS:
        raise ValueError(f"at most {MAX_BITS} flags fit one mask")
    bits = F.lit(0).cast("long")
    for i, c in enumerate(flags):
        bits = bits.bitwiseOR(F.shiftleft(F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("long"), i))
    return bits


def text_to_bits(code: Column) -> Column:
    return F.conv(code, 2, 10).cast("long")


def hood_differs(a: Column, b: Column) -> Column:
    """1 unless both neighbourhood codes are known and equal."""
    return 1 - F.coalesce((a == b).cast("int"), F.lit(0))


def bits_hamming(a: Column, b: Column, a_hood: Column, b_hood: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) + hood_differs(a_hood, b_hood)


def text_hamming(a: Column, b: Column, a_hood: Column, b_hood: Column) -> Column:
    """Distance of two text codes; codes of unequal length are an error."""
    same = F.length(a) == F.length(b)
    return F.when(same, bits_hamming(text_to_bits(a), text_to_bits(b), a_hood, b_hood)).otherwise(
        F.raise_error(F.lit("Hamming codes of unequal length")).cast("int")
    )
