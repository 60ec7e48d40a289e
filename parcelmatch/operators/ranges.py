"""Smallest and largest Hamming count and distance of every property over its pool.

The pool is the property's own zone and the adjacent ones, without the property itself.
Neither range forms the pool's pairs: flags are relaxed over the masks in use, distances are
found per distinct place through pruned blocks.

Input rows: ``prop_id, zone, lat, lon, hood, flag_bits, wanted`` (``wanted`` marks search rows).
"""

from __future__ import annotations

import sys
from collections.abc import Iterable

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import AXES, box_km_bounds, box_km_by_degrees, position
from ..registry import FLAGS
from ..session import staged
from .attach import attach
from .blocks import TOP_NODES, interleaved, node, place, pruned_pairs, summarise, tier_shifts
from .flags import over_hood, over_zone
from .packs import as_blocks, far_and_near, streamed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PLACE_LEAF_BITS = 7  # places of a block: arrays of 128
PLACE_FAN_BITS = 3  # few children: most pairs of places' blocks are hopeless, which a tier just above tells at less cost


def hood_key(hood: Column) -> Column:
    """Neighbourhood code as a non-NULL join key."""
    return F.coalesce(F.concat(F.lit("="), hood), F.lit("~"))


def flag_ranges(rows: DataFrame, edges: DataFrame, bits: int = len(FLAGS)) -> DataFrame:
    """(zone, flag_bits, hood_key) -> ham_lo, ham_hi.

    Other neighbourhoods add one to the count of differing flags, the own one does not; both parts are found
    per zone from at most 2^bits masks (see ``flags``). Neighbourhoods of any number only meet their
    mask's row of each zone.
    """
    codes = staged(rows.groupBy("zone", "flag_bits", "hood").agg(F.count("*").alias("n"), F.max("wanted").alias("wanted")), "codes")
    links = edges.select("zone", F.col("neighbour").alias("c_zone"))
    sought = codes.where("wanted").select("zone", "flag_bits", "hood", "n").join(links, "zone")
    sought = staged(sought.withColumn("own", F.expr("zone = c_zone")), "sought-codes")

    masks = codes.groupBy(F.col("zone").alias("c_zone"), F.col("flag_bits").alias("c_bits")).agg(
        F.sum("n").alias("n"), F.count_if(F.col("hood").isNull()).alias("unknown"), F.min("hood").alias("hood_lo"), F.max("hood").alias("hood_hi")
    )
    wanted_masks = sought.select("c_zone", "flag_bits").distinct()

    def zone_ends(members: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        if not len(members) or not len(wanted):
            return pd.DataFrame(columns=list(ends), dtype=object)
        return over_zone(members, wanted, bits).assign(c_zone=members["c_zone"].iloc[0])[list(ends)]

    ends = {"c_zone": "string", "flag_bits": "bigint"} | {
        f"{end}_{x}": "string" if x == "hood" else "int" for end in ("low", "high") for x in ("1", "hood", "2")
    } | {"alone_low": "int", "alone_high": "int"}
    schema = ", ".join(f"{c} {kind}" for c, kind in ends.items())
    reach = staged(masks.groupBy("c_zone").cogroup(wanted_masks.groupBy("c_zone")).applyInPandas(zone_ends, schema), "reach")
    met = attach(sought, reach, ["c_zone", "flag_bits"], F.struct("zone", "hood"), "inner")

    def elsewhere(end: str) -> str:
        known = f"if({end}_hood = hood, {end}_2, {end}_1)"
        return f"if(hood IS NULL, if(own, alone_{end}, {end}_1), {known}) + 1"

    others = met.selectExpr("zone", "flag_bits", "hood", f"{elsewhere('low')} AS low", f"{elsewhere('high')} AS high")

    members = codes.where("hood IS NOT NULL").select(F.col("zone").alias("c_zone"), "hood", F.col("flag_bits").alias("c_bits"), "n")
    asked = sought.where("hood IS NOT NULL").select("c_zone", "hood", "flag_bits", "own").distinct()

    def hood_ends(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        """The members of each neighbourhood come first, then the masks that ask."""
        held, key = [], None

        def answer() -> Iterable[pa.RecordBatch]:
            if held:
                rows = pd.concat(held)
                inside, asking = rows[rows["n"].notna()], rows[rows["n"].isna()]
                if len(inside) and len(asking):
                    found = over_hood(inside, asking, bits).assign(c_zone=key[0], hood=key[1])
                    yield pa.RecordBatch.from_pandas(found[kinds.names], kinds, False)

        for batch in batches:
            frame = batch.to_pandas()
            at = list(zip(frame["c_zone"], frame["hood"]))
            cuts = [0, *[i for i in range(1, len(at)) if at[i] != at[i - 1]], len(at)]
            for low, high in zip(cuts, cuts[1:]):
                if at[low] != key:
                    yield from answer()
                    held, key = [], at[low]
                held.append(frame.iloc[low:high])
        yield from answer()

    kinds = pa.schema([("c_zone", pa.string()), ("hood", pa.string()), ("flag_bits", pa.int64()), ("own", pa.bool_()), ("low", pa.int32()), ("high", pa.int32())])
    listed = members.selectExpr("c_zone", "hood", "c_bits", "n", "bigint(NULL) AS flag_bits", "false AS own")
    asking = asked.selectExpr("c_zone", "hood", "bigint(NULL) AS c_bits", "bigint(NULL) AS n", "flag_bits", "own")
    dealt = listed.unionByName(asking).repartition("c_zone", "hood").sortWithinPartitions("c_zone", "hood")
    near = dealt.mapInArrow(hood_ends, "c_zone string, hood string, flag_bits bigint, own boolean, low int, high int")
    same = sought.join(staged(near, "same-hood"), ["c_zone", "hood", "flag_bits", "own"]).select("zone", "flag_bits", "hood", "low", "high")
    found = same.unionByName(others).groupBy("zone", "flag_bits", "hood").agg(F.min("low").alias("ham_lo"), F.max("high").alias("ham_hi"))
    return found.where("ham_lo IS NOT NULL").select("zone", "flag_bits", hood_key(F.col("hood")).alias("hood_key"), "ham_lo", "ham_hi")


_PLACE_NODE = {
    **{f"{x}_lo": (x, "min") for x in ("lat", "lon", *AXES)}, **{f"{x}_hi": (x, "max") for x in ("lat", "lon", *AXES)}, "n": ("n", "sum"),
}


def distance_ranges(
    rows: DataFrame, edges: DataFrame, metric: str, leaf_bits: int = PLACE_LEAF_BITS, fan_bits: int = PLACE_FAN_BITS, top_nodes: int = TOP_NODES
) -> DataFrame:
    """(zone, lat, lon) -> km_lo, km_hi over the other properties of the pool."""
    places = rows.where("lat is not null and lon is not null").groupBy("zone", "lat", "lon").agg(
        F.count("*").alias("n"), F.max("wanted").alias("wanted")
    )
    keyed, keys = interleaved(places, ["(lat + 90) / 180", "(lon + 180) / 360"], digits=30)
    keyed = keyed.withColumns({x: F.expr(e) for x, e in position("lat", "lon", metric).items()})
    placed = place(keyed, keys, ["lat", "lon"], "places")
    shifts = tier_shifts(placed, leaf_bits, fan_bits, top_nodes)
    offered = summarise(placed, shifts, _PLACE_NODE)
    search = summarise(placed.where("wanted"), shifts, _PLACE_NODE)

    def keep_ends(pairs: DataFrame, low: str, high: str, by: list[str]) -> DataFrame:
        """Keep the boxes which may hold the nearest or the farthest other property."""
        w = Window.partitionBy(*by)
        peopled = F.expr("CASE WHEN a_zone <> c_zone OR a_node <> c_node OR c_n > 1 THEN _high END")
        return (
            pairs.withColumns({"_low": F.expr(low), "_high": F.expr(high)})
            .withColumns({"_near": F.min(peopled).over(w), "_far": F.max("_low").over(w), "_top": F.max("_high").over(w)})
            .where("_high >= _far OR _near IS NULL OR _low <= _near")
        )

    def may_matter(pairs: DataFrame, by: list[str]) -> DataFrame:
        """By straight lines between the boxes in space, and by their latitudes and longitudes."""
        straight, curved = box_km_bounds("a_", "c_", metric), box_km_by_degrees("a_", "c_", metric)
        return keep_ends(pairs, f"greatest({straight[0]}, {curved[0]})", f"least({straight[1]}, {curved[1]})", by)

    leaf = shifts[-1]
    # the blocks that can hold the nearest or the farthest place come first: they limit what the others are looked at for
    first = F.expr("least(_low, _top - _high)").alias("slack")
    pairs = pruned_pairs(search, offered, edges, shifts, lambda p: may_matter(p, ["a_zone", "a_node"]), [first])
    rows = placed.withColumn("node", node(leaf))
    asking, held = as_blocks(rows.where("wanted"), ("pos", "n", "lat", "lon")), as_blocks(rows, ("pos", "lat", "lon"))
    ends = far_and_near(streamed(staged(pairs, "place-pairs"), asking, held, ("slack", "c_zone", "c_node")), metric)
    found = ends.groupBy(F.col("a_pos").alias("pos")).agg(F.min("km_lo").alias("km_lo"), F.max("km_hi").alias("km_hi"))
    return placed.select("pos", "zone", "lat", "lon").join(found, "pos").drop("pos")
