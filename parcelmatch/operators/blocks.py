"""Small blocks of similar rows per zone, and pruned joins between blocks.

Rows are range-sorted by zone and a bit-interleaved key, so every block is a short run of
similar rows with exact bounds, however skewed the data: a hot zone or a hot spot simply
spans more blocks. Joins compare the bounds of coarse blocks first and descend only into
pairs that can still matter.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .attach import attach

LEAF_BITS = 6  # 64 rows per leaf
FAN_BITS = 6  # 64 children per coarser node
TOP_NODES = 64  # coarsest tier: about this many nodes in the largest zone
KEY_BITS = 60
MAX_FAN_IN = 1024  # search leaves that may meet one offered leaf before its rows are copied


def interleaved(df: DataFrame, units: Sequence[str], digits: int) -> tuple[DataFrame, list[str]]:
    """Add sort-key columns holding the interleaved leading bits of several values.

    ``units`` are SQL texts in [0, 1]; the key is split over as many longs as it takes.
    """
    grid = {f"_q{i}": F.expr(f"bigint(greatest(0D, least(1D, {u})) * {(1 << digits) - 1})") for i, u in enumerate(units)}
    per_long = KEY_BITS // len(units)
    keys = {}
    for high in range(digits - 1, -1, -per_long):
        bits = [(i, bit) for bit in range(high, max(high - per_long, -1), -1) for i in range(len(units))]
        terms = [f"shiftleft(shiftright(_q{i}, {bit}) & 1L, {len(bits) - 1 - at})" for at, (i, bit) in enumerate(bits)]
        keys[f"_k{len(keys)}"] = F.expr(" | ".join(terms))
    return df.withColumns(grid).withColumns(keys).drop(*grid), list(keys)


def parallel(df: DataFrame, *keys: str) -> DataFrame:
    """Shuffle by ``keys`` into the session's number of partitions.

    For inputs of small, expensive rows: their size says little about the work behind them, so
    they must not be merged into a few tasks by size.
    """
    return df.repartition(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1), *keys)


def place(df: DataFrame, keys: Sequence[str], tie: Sequence[str], label: str) -> DataFrame:
    """Give every row its position in (zone, key) order and store the result.

    ``tie`` makes the order total, so equal keys still split over partitions.
    """
    order = ["zone", *keys, *tie]
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    placed = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("pos", F.monotonically_increasing_id())
    return staged(placed.drop(*[k for k in keys if k.startswith("_k")]), label)


def node(shift: int) -> Column:
    return F.shiftright(F.col("pos"), shift)


def tier_shifts(placed: DataFrame, leaf_bits: int, fan_bits: int, top_nodes: int = TOP_NODES) -> list[int]:
    """Position shifts from the coarsest tier down to the leaves, from the largest zone's size."""
    largest = placed.groupBy("zone").count().agg(F.max("count")).first()[0] or 1
    nodes = largest / (1 << leaf_bits)
    extra = max(0, math.ceil(math.log2(nodes / top_nodes) / fan_bits)) if nodes > top_nodes else 0
    return [leaf_bits + fan_bits * i for i in range(extra, -1, -1)]


def summarise(rows: DataFrame, shifts: Sequence[int], measures: dict[str, tuple[str, str]]) -> list[DataFrame]:
    """Node summaries per tier; ``measures`` maps a summary column to (source, aggregate).

    Finer tiers are summarised from the rows, coarser ones from the next finer tier.
    """
    tiers: list[DataFrame] = []
    base = rows
    source = {name: src for name, (src, _) in measures.items()}
    fine = None
    for shift in reversed(shifts):
        key = node(shift) if fine is None else F.shiftright(F.col("node"), shift - fine)
        aggs = [F.expr(f"{how}({source[name]}) AS {name}") for name, (_, how) in measures.items()]
        base = base.groupBy("zone", key.alias("node")).agg(*aggs)
        source = {name: name for name in measures}
        fine = shift
        tiers.insert(0, base)
    return tiers


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[f"{prefix}{c}" for c in df.columns])


def pruned_pairs(
    search: Sequence[DataFrame],
    offered: Sequence[DataFrame],
    edges: DataFrame,
    shifts: Sequence[int],
    keep: Callable[[DataFrame], DataFrame],
    more: Sequence[Column] = (),
) -> DataFrame:
    """Leaf pairs (a_zone, a_node, c_zone, c_node) which survive ``keep`` on every tier, and ``more`` of each.

    ``keep`` gets node pairs with ``a_`` and ``c_`` summary columns and drops hopeless ones.
    """
    ids = ["a_zone", "a_node", "c_zone", "c_node"]
    pairs: DataFrame | None = None
    for i, (a, c) in enumerate(zip(search, offered)):
        a, c = prefixed(a, "a_"), prefixed(c, "c_")
        if pairs is None:
            links = edges.select(F.col("zone").alias("a_zone"), F.col("neighbour").alias("c_zone"))
            joined = a.join(links, "a_zone").join(c, "c_zone")
        else:
            step = shifts[i - 1] - shifts[i]
            up = pairs.select("a_zone", F.col("a_node").alias("a_up"), "c_zone", F.col("c_node").alias("c_up"))
            joined = (
                up.join(a.withColumn("a_up", F.shiftright("a_node", step)), ["a_zone", "a_up"])
                .join(c.withColumn("c_up", F.shiftright("c_node", step)), ["c_zone", "c_up"])
                .drop("a_up", "c_up")
            )
        pairs = keep(joined).select(*ids, *(more if i == len(shifts) - 1 else ()))
        if i < len(shifts) - 1:
            pairs = staged(pairs, "node-pairs")
    return pairs


def balanced(leaves: DataFrame, max_fan_in: int = MAX_FAN_IN) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Spread leaves that very many search leaves need (a far corner, a popular spot).

    Returns the leaf pairs with a ``c_salt`` column, and a function which copies offered rows
    (columns ``c_zone, c_node``) once per salt of their leaf. Leaves within ``max_fan_in``
    have a single salt, so nothing is copied where nothing is hot.
    """
    leaves = staged(leaves, "leaf-pairs")
    key = ["c_zone", "c_node"]
    degree = leaves.groupBy(*key).count()
    busiest = degree.agg(F.max("count")).first()[0] or 0
    if busiest <= max_fan_in:
        def single(df: DataFrame) -> DataFrame:
            return df.withColumn("c_salt", F.lit(0))
        return single(leaves), single
    salts = staged(degree.select(*key, F.ceil(F.col("count") / max_fan_in).cast("int").alias("salts")), "salts")
    pairs = attach(leaves, salts, key, F.struct("a_zone", "a_node"), "inner")
    pairs = pairs.withColumn("c_salt", F.pmod(F.xxhash64("a_zone", "a_node"), F.col("salts")).cast("int")).drop("salts")

    def copies(df: DataFrame) -> DataFrame:
        return df.join(salts, key).withColumn("c_salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")

    return pairs, copies
