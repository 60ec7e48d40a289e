"""Cleaning rules for scraped and appraisal text."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words looked for in upper-cased improvement descriptions.
IMPROVEMENT_WORDS = {
    "has_outdoor_space": ("DECK", "PORCH", "TERRACE"),
    "has_garage": ("GARAGE",),
    "has_pool": ("POOL",),
    "has_central_air": ("HVAC",),
    "has_fireplace": ("FIREPLACE",),
}
FLOOR_WORD = "FLOOR"
FLOORING_WORDS = ("hardwood", "carpet", "tile")


def flag(condition: Column) -> Column:
    """0/1 with unknown counted as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def has_any(text: Column, words: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | text.contains(word)
    return flag(found)


DECIMAL = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def finite(value: Column) -> Column:
    """The value, or NULL where it is NaN or infinite."""
    return F.when(F.abs(value) < float("inf"), value)


def finite_columns(df: DataFrame) -> DataFrame:
    """All floating-point columns with NaN and infinity as NULL."""
    return df.withColumns({name: finite(F.col(f"`{name}`")) for name, kind in df.dtypes if kind in ("double", "float")})


def number(text: Column, kind: str = "double") -> Column:
    """Number in decimal notation or NULL; NaN, infinity and type suffixes count as missing."""
    value = F.when(text.rlike(DECIMAL), text).try_cast(kind)
    return finite(value) if kind in ("double", "float") else value


def money(text: Column) -> Column:
    return number(F.regexp_replace(text, "[$,]", ""))


def floor_area(text: Column) -> Column:
    return number(F.regexp_replace(text, " sqft|,", ""))


def first_of(values: Column) -> Column:
    return F.try_element_at(values, F.lit(1))


def bathrooms(text: Column) -> Column:
    """Single digits d -> d, (d, e) -> d + e/2, anything else -> NULL."""
    digits = F.regexp_extract_all(text, F.lit("([0-9])"), F.lit(1))
    first = F.try_element_at(digits, F.lit(1)).cast("double")
    second = F.try_element_at(digits, F.lit(2)).cast("double")
    return F.when(F.size(digits) == 1, first).when(F.size(digits) == 2, first + second * 0.5)


def flooring_flag(values: Column, word: str) -> Column:
    return flag(F.lower(F.array_join(values, ",")).contains(word))


def clean_zone(text: Column) -> Column:
    """Zone without suffix: the part before '-', and no '.0' left by a float reading."""
    return F.replace(F.split_part(text, F.lit("-"), F.lit(1)), F.lit(".0"), F.lit(""))


def column_name(value: str) -> str:
    """Name of the 0/1 column made from a category value."""
    return value.lower().replace(" ", "_")


def full_address(address: Column, state: Column, zone: Column, city: str = "Austin, TX") -> Column:
    """Address with its state and zone fields cut out, then city and zone appended."""

    def cut(text: Column, piece: Column) -> Column:
        return F.when(F.length(piece) > 0, F.replace(text, piece, F.lit(""))).otherwise(text)

    return F.concat_ws(" ", F.trim(cut(cut(address, F.coalesce(state, F.lit(""))), F.coalesce(zone, F.lit("")))),
                       F.lit(city), zone)


def fact_label(parent: Column, child: Column) -> Column:
    """Label of a fact: the enclosing text without the value, ':', line breaks and blanks."""
    rest = F.when(F.length(child) > 0, F.replace(parent, child, F.lit(""))).otherwise(parent)
    return F.lower(F.regexp_replace(rest, "[: \\n]", ""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


GRAM = 3
END_OF_TEXT = "\x00"  # fills the grams at a text's end


def grams(text: Column) -> Column:
    """All runs of three characters that begin in the text, each once."""
    padded = F.concat(text, F.lit(END_OF_TEXT * (GRAM - 1)))
    starts = F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text)))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(padded, i, F.lit(GRAM))))


#: Words that introduce a unit.
UNIT_WORDS = ("APT", "APARTMENT", "UNIT", "STE", "SUITE")


def address_parts(address: Column, noise: Sequence[str] = ()) -> Column:
    """number, street (words in their order), sorted (the same words in order), unit and zip of an address; '' for what it lacks.

    The number is the first whole number that is neither unit nor zip, so the parts may come in any order. Every step is a
    ``let``: the words' filter would otherwise work out the number again, from the whole address, for each word.
    ``noise``: words such as the city that say nothing.
    """
    marked = rf"(?:(?:^|\s)(?:{'|'.join(UNIT_WORDS)})\s+#?|#)\s*([A-Z0-9-]+)"

    def of_rest(rest: Column, unit: Column, zip_: Column) -> Column:
        return let(F.regexp_extract(rest, r"(?:^|\s)(\d+)(?=\s|$)", 1), lambda number: let(
            F.filter(F.split(rest, r"\s+"), lambda w: (w != "") & (w != number) & ~w.isin(*noise, "")), lambda words: F.struct(
                number.alias("number"), F.array_join(words, " ").alias("street"), F.array_join(F.sort_array(words), " ").alias("sorted"),
                unit.alias("unit"), zip_.alias("zip"),
            )))

    def of_text(text: Column) -> Column:
        zip_ = F.regexp_extract(text, r"(?:^|\s)(\d{5})(?:-\d{4})?\s*$", 1)
        return let(F.regexp_replace(text, r"(?:^|\s)\d{5}(?:-\d{4})?\s*$", ""), lambda rest: let(
            F.regexp_replace(rest, marked, " "), lambda bare: of_rest(bare, F.regexp_extract(rest, marked, 1), zip_)))

    return let(F.upper(F.regexp_replace(F.coalesce(address, F.lit("")), "[.,;]", " ")), of_text)
