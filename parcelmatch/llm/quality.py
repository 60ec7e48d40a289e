"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let

BLANK = r"\x20\x09-\x0D"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
FEW = 64  # hashes that are looked up one by one
# Frequent function words of the languages the rules are meant for.
STOP_WORDS = (
    "the", "of", "and", "to", "a", "in", "that", "is", "was", "for", "it", "with", "as", "on", "be", "at", "by", "this",
    "der", "die", "das", "und", "ist", "nicht", "ein", "zu", "den", "von", "mit", "auf", "für", "im",
    "le", "la", "les", "de", "des", "et", "un", "une", "que", "qui", "en", "du", "est", "pour",
    "el", "los", "las", "y", "no", "se", "del", "por", "con", "una", "su", "para", "lo",
)


class Rule(NamedTuple):
    """A ratio of two measures that must lie in [low, high]; an empty denominator breaks no rule."""

    name: str
    over: str
    under: str
    low: float
    high: float


RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 2.0, 14.0),
    Rule("symbol_ratio", "n_symbols", "n_words", 0.0, 0.5),
    Rule("stop_word_ratio", "n_stop_words", "n_words", 0.01, 1.0),
    Rule("repeated_line_ratio", "n_dup_lines", "n_lines", 0.0, 0.5),
    Rule("upper_word_ratio", "n_upper_words", "n_words", 0.0, 0.5),
)


def _rest(items: Column) -> Column:
    return F.slice(items, F.lit(2), F.greatest(F.size(items) - 1, F.lit(0)))


def _but_last(items: Column) -> Column:
    return F.slice(items, F.lit(1), F.greatest(F.size(items) - 1, F.lit(0)))


def _covered(places: Column) -> Column:
    """Words covered by three-word windows that begin at the sorted ``places``."""
    steps = F.zip_with(_but_last(places), _rest(places), lambda a, b: F.least(F.lit(3), b - a))
    return F.when(F.size(places) > 0, F.aggregate(steps, F.lit(3), lambda s, x: s + x)).otherwise(0)


def repeated_words(words: Column) -> Column:
    """Number of words inside three-word windows that the text holds twice or more.

    Most windows have a hash of their own and are left out. The others are sorted by hash, then words, then place, so
    equal windows are neighbours.
    """
    starts = F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))
    hashes = F.transform(starts, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))

    def windows(h: Column, twice: Column) -> Column:
        """Those whose hash is there twice; all, if so many are that looking them up would take longer than to sort them."""
        some = F.transform(h, lambda x, i: F.when((F.size(twice) > FEW) | F.array_contains(twice, x), F.struct(
            x.alias("h"), F.get(words, i).alias("a"), F.get(words, i + 1).alias("b"), F.get(words, i + 2).alias("c"), i.alias("i"),
        )))
        return F.filter(some, lambda x: x.isNotNull())

    def same(x: Column, y: Column) -> Column:
        return (x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])

    def found(s: Column, e: Column) -> Column:
        twice = F.transform(s, lambda x, j: F.when(F.coalesce(F.get(e, j), F.lit(False)) | F.coalesce(F.get(e, j - 1), F.lit(False)), x["i"]))
        return let(F.sort_array(F.filter(twice, lambda p: p.isNotNull())), _covered)

    def met_twice(h: Column) -> Column:
        return let(F.sort_array(h), lambda s: F.array_distinct(F.filter(s, lambda x, i: F.coalesce(x == F.get(s, i + 1), F.lit(False)))))

    def places(h: Column, twice: Column) -> Column:
        return let(F.sort_array(windows(h, twice)), lambda s: let(F.zip_with(_but_last(s), _rest(s), same), lambda e: found(s, e)))

    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(met_twice(h), lambda twice: places(h, twice))))


def measures(docs: DataFrame) -> DataFrame:
    """doc_id and the counts that the rules use, for every whole text."""
    words = F.regexp_extract_all(F.col("t"), F.lit(f"[^{BLANK}]+"), F.lit(0))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(f"[^{BLANK}]"))
    cut = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    parts = cut.select("doc_id", "t", words.alias("words"), lines.alias("lines"))

    def number(value: Column, name: str) -> Column:
        return value.cast("bigint").alias(name)

    return parts.select(
        "doc_id",
        number(F.size("words"), "n_words"),
        number(F.length(F.translate("t", " \t\n\x0b\x0c\r", "")), "word_chars"),
        number(F.length("t") - F.length(F.translate("t", SYMBOLS, "")), "n_symbols"),
        number(F.size("lines"), "n_lines"),
        number(F.size("lines") - F.size(F.array_distinct("lines")), "n_dup_lines"),
        number(repeated_words(F.col("words")), "n_repeat_words"),
        number(F.size(F.filter("words", lambda w: F.lower(w).isin(*STOP_WORDS))), "n_stop_words"),
        number(F.size(F.filter("words", lambda w: (w == F.upper(w)) & (w != F.lower(w)) & (F.length(w) > 1))), "n_upper_words"),
    )


def compiled(rules: Sequence[Rule]) -> Column:
    """One boolean expression: every ratio lies within its limits."""
    kept = F.lit(True)
    for rule in rules:
        over, under = F.col(rule.over), F.col(rule.under)
        kept = kept & ((under == 0) | ((over >= under * rule.low) & (over <= under * rule.high)))
    return kept


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """doc_id, the measures, ``base_failed`` (too short or too repetitive) and ``kept``.

    A missing or empty text has no words, so it fails. Rows are judged one by one: repeated
    rows and rows without id are all returned, an empty table has none.
    """
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    judged = measures(docs).withColumn("base_failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & compiled(rules))
