"""Reproducible shuffle into shards: a Feistel permutation with cycle walking over row numbers.

Rows are numbered 0..N-1 in the order of their id (then checksum and size), the number is
permuted, and the permuted number says shard and slot. Everything is a SQL expression, so the
place of any row can be computed from its number alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .common import fresh, partitions

ROUNDS = 6
SHARDS = 40
OVERHEAD = 16


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Add ``name``: the 0-based place of each row in ``order``, without sorting in one task.

    Equal rows are told apart by their place in the input, so they spread over tasks as well.
    """
    pos, part, start, tie = (fresh(rows, x) for x in ("_pos", "_part", "_start", "_tie"))
    n = partitions(rows.sparkSession)
    tied = rows.withColumn(tie, F.monotonically_increasing_id())
    ordered = tied.repartitionByRange(n, *order, tie).sortWithinPartitions(*order, tie).drop(tie)
    placed = staged(ordered.withColumn(pos, F.monotonically_increasing_id()), "numbered").withColumn(part, F.shiftright(pos, 33))
    sizes = placed.groupBy(part).agg(F.count("*").alias("n"))  # one row per partition
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(start))
    within = F.col(pos).bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(starts, part).withColumn(name, F.col(start) + within).drop(pos, part, start)


def grid(total: int) -> tuple[int, int]:
    """Sides a, b of the smallest near-square grid with at least ``total`` cells."""
    a = math.isqrt(max(total, 1) - 1) + 1
    return a, -(-max(total, 1) // a)


def _once(x: str, a: int, b: int, seed: int) -> str:
    """The Feistel permutation of 0..a*b-1: the halves take turns in shifting each other."""
    left = f"named_struct('l', pmod(s.l + pmod(xxhash64(s.r, k, {seed}), {a}L), {a}L), 'r', s.r)"
    right = f"named_struct('l', s.l, 'r', pmod(s.r + pmod(xxhash64(s.l, k, {seed}), {b}L), {b}L))"
    return (
        f"aggregate(sequence(0, {ROUNDS - 1}), named_struct('l', ({x}) div {b}L, 'r', pmod({x}, {b}L)), "
        f"(s, k) -> CASE WHEN k % 2 = 0 THEN {left} ELSE {right} END, s -> s.l * {b}L + s.r)"
    )


def permuted(rows: DataFrame, number: str, total: int, seed: int, name: str) -> DataFrame:
    """Add ``name``: the place of row ``number`` in a permutation of 0..total-1.

    A result beyond ``total`` is permuted again until it falls inside. The grid has fewer than
    a cells too many, which bounds every walk; only the few rows that land there walk at all.
    """
    a, b = grid(total)
    first = fresh(rows, "_first")
    beyond = max(a * b - total, 1)
    walk = f"aggregate(sequence(1, {beyond}), {first}, (p, _i) -> CASE WHEN p < {total}L THEN p ELSE {_once('p', a, b, seed)} END)"
    once = rows.withColumn(first, F.expr(_once(f"`{number}`", a, b, seed)))
    return once.withColumn(name, F.expr(f"CASE WHEN {first} < {total}L THEN {first} ELSE {walk} END")).drop(first)


def text_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("bigint")


def shard_rows(docs: DataFrame, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row.

    The law is ``rows``: shard sizes differ by one row at most and slots run from 0 without
    gaps. A missing text counts as empty, rows without id come first, repeated rows get places
    of their own, an empty table has no rows. ``grown_shard`` belongs to another law and is NULL.
    Only id, size and checksum are shuffled, not the texts.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text_size(F.col("text")).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    order = numbered(rows, ["doc_id", "text_crc32", "size"], "number")
    total = docs.count()
    placed = permuted(order, "number", total, seed, "place")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.pmod("place", F.lit(shards)).cast("int").alias("shard"),
        F.expr(f"place div {shards}").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
