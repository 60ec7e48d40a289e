"""The nearest neighbours of every property, exactly, without forming all pairs of a pool.

1. Properties that agree in everything scored become one class; only the smallest ids of a
   class can enter a top list, because ties go to the smaller id.
2. Classes are laid out in blocks of similar rows (``blocks``): equal flags first. A block is a row
   of arrays. Each meets the blocks with the least bounds first, which limits its k-th scores.
3. Blocks whose bound exceeds the limits are dropped, the rest is met in the order of the bounds and
   in rounds, with smaller limits each time. Inside a task, blocks, single properties and then
   single pairs are passed over in the same way (``packs``).
4. Class lists go back to their members; members without coordinates have no score and list
   the smallest ids of their pool.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import Accumulator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codes import bits_hamming
from ..functions.geo import AXES, axis_gap, box_km_bounds, distance_km, position
from ..registry import BASE_MEASURES, FLAGS, MEASURES, NEIGHBOURS
from ..session import staged
from .attach import attach
from .blocks import FAN_BITS, TOP_NODES, interleaved, node, place, pruned_pairs, summarise, tier_shifts
from .packs import MARGIN, Shape, as_blocks, in_groups, scored
from .ranges import distance_ranges, flag_ranges, hood_key
from .scaling import fit_range, min_max, unit

METRICS = ("euclidean", "manhattan")
SCORE_DIGITS = 9  # scores closer than this are ties, broken by id
LEAF_BITS = 8  # classes of a block: arrays of 256
FIRST = 4  # blocks that a search block meets first
GROWTH = 16  # so many times more in each round
GROUP_BITS = 3  # up to eight adjacent search blocks share the blocks offered to them
GROUPS = 3  # groups of search blocks a task at least, else fewer blocks share
INF = float("inf")  # inner mark for "no score": sorts behind every score
_N = len(MEASURES)
_NB = len(BASE_MEASURES)
_ROW = ["zone", "flag_bits", "hood", "lat", "lon", "listing", *[f"f{i}" for i in range(_N)]]


def score_rows(
    matrix: DataFrame, zones: Sequence[str] | None = None, done: DataFrame | None = None, only: DataFrame | None = None
) -> DataFrame:
    """Rows to score, over a stored matrix: measures scaled over the whole table, a missing one as 0.

    ``zones`` and ``only`` (column ``prop_id``) limit the search side, ``done`` (the same) leaves
    out finished ids; every property stays a candidate.
    """
    matrix = staged(matrix.select("prop_id", "zone", "flag_bits", "hood_cd", "lat", "lon", "listing", *MEASURES), "score-matrix")
    scaled = min_max(matrix, MEASURES, fit_range(matrix, MEASURES))
    wanted = F.lit(True) if zones is None else F.col("zone").isin(list(zones))
    rows = scaled.where("zone IS NOT NULL").selectExpr(
        "prop_id", "zone", "flag_bits", "hood_cd AS hood", "if(lon IS NOT NULL, lat, NULL) AS lat", "if(lat IS NOT NULL, lon, NULL) AS lon",
        "int(listing) AS listing", *[f"coalesce({m}, 0D) AS f{i}" for i, m in enumerate(MEASURES)],
    ).withColumns({"wanted": wanted, "profile": F.expr(f"to_json(struct({', '.join(_ROW)}))")})
    for ids, keep in ((only, "IS NOT NULL"), (done, "IS NULL")):
        if ids is not None:
            marked = ids.select("prop_id").distinct().withColumn("_mark", F.lit(True))
            rows = rows.join(marked, "prop_id", "left").withColumn("wanted", F.expr(f"wanted AND _mark {keep}")).drop("_mark")
    if only is not None or done is not None:
        rows = staged(rows, "score-rows")
    return rows


def pool_ranges(rows: DataFrame, edges: DataFrame, distance: str = "vincenty") -> DataFrame:
    """Per search property: smallest and largest Hamming count and distance of its pool."""
    ham = flag_ranges(rows, edges)
    km = distance_ranges(rows, edges, distance)
    wanted = rows.where("wanted").select("prop_id", "zone", "flag_bits", hood_key(F.col("hood")).alias("hood_key"), "lat", "lon")
    with_ham = attach(wanted, ham, ["zone", "flag_bits", "hood_key"], F.col("prop_id"))
    keyed = staged(with_ham, "ranges").withColumns({"lat": F.coalesce("lat", F.lit(-999.0)), "lon": F.coalesce("lon", F.lit(-999.0))})
    return attach(keyed, km, ["zone", "lat", "lon"], F.col("prop_id")).select("prop_id", "zone", "ham_lo", "ham_hi", "km_lo", "km_hi")


def _classes(rows: DataFrame, edges: DataFrame, distance: str, k: int, metrics: Sequence[str], offers: DataFrame | None, caps: DataFrame | None) -> DataFrame:
    """One stored row per distinct profile with coordinates: its k+1 smallest (offered) ids, its ranges and its caps."""
    first = Window.partitionBy("profile").orderBy("prop_id")
    located = rows.where("lat is not null")
    listed = located if offers is None else located.join(offers.select("prop_id").distinct(), "prop_id", "left_semi")
    heads = (
        listed.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= k + 1)
        .groupBy("profile", *_ROW).agg(F.sort_array(F.collect_list("prop_id")).alias("heads"))
    )
    searching = located.where("wanted")
    if caps is not None:
        searching = searching.join(caps, "prop_id", "left")
    limit = [F.max(F.coalesce(F.col(f"limit_{m}") if caps is not None else F.lit(INF), F.lit(INF))).alias(f"limit_{m}") for m in metrics]
    sought = searching.groupBy("profile").agg(F.lit(True).alias("wanted"), *limit)
    if offers is not None:  # also those that search and have nobody to offer
        alone = located.where("wanted").select("profile", *_ROW).distinct().join(heads, "profile", "left_anti")
        heads = heads.unionByName(alone.withColumn("heads", F.array().cast("array<bigint>")))
    classes = staged(
        heads.join(sought, "profile", "left").withColumns({
            "wanted": F.coalesce("wanted", F.lit(False)), "rep": F.coalesce(F.get("heads", F.lit(0)), F.xxhash64("profile")), "hood_key": hood_key(F.col("hood")),
            **{f"limit_{m}": F.coalesce(f"limit_{m}", F.lit(INF)) for m in metrics},
        }),
        "classes",
    )
    ham = flag_ranges(rows, edges)
    km = distance_ranges(rows, edges, distance)
    ranged = staged(attach(classes, ham, ["zone", "flag_bits", "hood_key"], F.col("rep")), "classes-ham")
    ranged = attach(ranged, km, ["zone", "lat", "lon"], F.col("rep"))
    ranged = ranged.select(
        "profile", "rep", "heads", "wanted", *[f"limit_{m}" for m in metrics], *_ROW,
        "ham_lo", (F.col("ham_hi") - F.col("ham_lo")).alias("ham_span"), "km_lo", (F.col("km_hi") - F.col("km_lo")).alias("km_span"),
    ).withColumns({x: F.expr(e) for x, e in position("lat", "lon", distance).items()})
    # Blocks share flags first, those that vary most, then places and measures, each in its own spread.
    spread = [*[f"f{i}" for i in range(_N)], "lat", "lon"]
    shares = [F.avg(F.shiftright("flag_bits", i).bitwiseAND(1).cast("double")).alias(f"_b{i}") for i in range(len(FLAGS))]
    about = classes.agg(*shares, *[f(x).alias(f"{n}_{x}") for x in spread for n, f in (("mean", F.avg), ("sd", F.stddev_pop))]).first()
    ranked = sorted(range(len(FLAGS)), key=lambda i: abs((about[f"_b{i}"] or 0) - 0.5))
    mask = " | ".join(f"shiftleft(shiftright(flag_bits, {b}) & 1L, {len(ranked) - 1 - at})" for at, b in enumerate(ranked))
    units = [f"({x} - {about[f'mean_{x}'] or 0!r}D) / {4 * (about[f'sd_{x}'] or 1)!r}D + 0.5D" for x in spread]
    keyed, keys = interleaved(ranged, units, digits=18)
    return place(keyed.withColumn("_kmask", F.expr(mask)), ["listing", "_kmask", *keys], ["rep"], "placed")


_BOXED = [*[f"f{i}" for i in range(_N)], *AXES]
_NODE = {
    **{f"{x}_lo": (x, "min") for x in _BOXED}, **{f"{x}_hi": (x, "max") for x in _BOXED},
    "and_bits": ("flag_bits", "bit_and"), "or_bits": ("flag_bits", "bit_or"), "hood_lo": ("hood", "min"), "hood_hi": ("hood", "max"),
}
# Search side of a block: the loosest of its classes' ranges.
_LOOSEST = {"listing": ("listing", "min"), "ham_lo": ("ham_lo", "max"), "ham_rate": ("ham_rate", "min"), "km_lo": ("km_lo", "max"), "km_rate": ("km_rate", "min")}


def _known(df: DataFrame, prefix: str, columns: Sequence[str]) -> DataFrame:
    """Columns prefixed and, except texts and lists, marked as never NULL.

    A pair condition over nullable columns grows past the size the JIT compiles.
    """
    kinds = dict(df.dtypes)
    zero = {"double": "0D", "bigint": "0L", "int": "0"}
    return df.selectExpr(*[f"coalesce({c}, {zero[kinds[c]]}) AS {prefix}{c}" if kinds[c] in zero else f"{c} AS {prefix}{c}" for c in columns])


def _with_rates(df: DataFrame) -> DataFrame:
    """1 / range of the Hamming and distance parts; 0 where the range is empty."""
    return df.withColumns({f"{p}_rate": F.expr(f"if({p}_span > 0, 1D / {p}_span, 0D)") for p in ("ham", "km")})


def _least_scores(gaps: Sequence[str], ham: str, km: str, metrics: Sequence[str]) -> dict[str, str]:
    """Scores by metric from the least parts of a pair of blocks."""
    parts = {"ham": f"greatest(0D, {ham} - a_ham_lo) * a_ham_rate", "km": f"greatest(0D, {km} - a_km_lo) * a_km_rate"}
    totals = {}
    for m in metrics:
        terms = [f"({t}) * ({t})" if m == "euclidean" else f"abs({t})" for t in (*gaps, *parts.values())]
        whole = f"{' + '.join([*terms[:_NB], *terms[_N:]])} + a_listing * ({' + '.join(terms[_NB:_N])})"
        totals[m] = f"sqrt({whole})" if m == "euclidean" else whole
    return totals


def _bounds(distance: str, metrics: Sequence[str]) -> dict[str, str]:
    """Per metric the best score any pair of the blocks ``a_`` and ``c_`` can have."""
    differ = "bit_count((a_and_bits & ~c_or_bits) | (c_and_bits & ~a_or_bits))"
    ham = f"{differ} + if(coalesce(a_hood_lo <= c_hood_hi AND c_hood_lo <= a_hood_hi, false), 0, 1)"
    km, _ = box_km_bounds("a_", "c_", distance)
    return _least_scores([axis_gap("a_", "c_", f"f{i}") for i in range(_N)], ham, km, metrics)


_SEARCH_COLUMNS = ("pos", *[f"f{i}" for i in range(_N)], *AXES, "lat", "lon", "flag_bits", "hood", "listing", "ham_lo", "ham_rate", "km_lo", "km_rate")
_OFFER_COLUMNS = ("pos", *[f"f{i}" for i in range(_N)], *AXES, "lat", "lon", "flag_bits", "hood", "heads")
_PAIR = ["a_zone", "a_node", "c_zone", "c_node"]


def _class_lists(
    placed: DataFrame, edges: DataFrame, distance: str, metrics: Sequence[str], k: int, leaf_bits: int, fan_bits: int, top_nodes: int, width: int = FIRST,
    tally: Accumulator | None = None, apart: bool = False,
) -> DataFrame:
    """(profile, metric, found): the k+1 best (score, id) of every search class, own ids included.

    Best first, in rounds. The first round takes the ``width`` blocks with the least bounds of a search
    block, found tier by tier. Its scores limit what may still enter a list, so only blocks within
    the limits are listed then, and taken in the order of their bounds, more every round;
    before each, the limits have shrunk and drop most of the rest.
    """
    shape = Shape(tuple(f"f{i}" for i in range(_N)), _NB, tuple(metrics), k, distance, apart)
    shifts = tier_shifts(placed, leaf_bits, fan_bits, top_nodes)
    leaf = shifts[-1]
    names = [f"limit_{m}" for m in metrics]
    some = placed.where("size(heads) > 0")
    offered = [_known(tier, "", ["zone", "node", *_NODE]) for tier in summarise(some, shifts, _NODE)]
    packs = staged(as_blocks(some.withColumn("node", node(leaf)), _OFFER_COLUMNS), "offered-blocks")
    rated = _with_rates(placed.where("wanted"))
    seekers = staged(_known(rated, "", ["zone", *_SEARCH_COLUMNS, *names]).withColumn("node", node(leaf)), "search-rows")
    bound = _bounds(distance, metrics)
    nearer = [F.expr(bound[m]).alias(f"bound_{m}") for m in metrics]
    turn = Window.partitionBy("a_zone", "a_node").orderBy(f"bound_{metrics[0]}", "c_zone", "c_node")

    def tiers(rows: DataFrame) -> list[DataFrame]:
        kept = [*_NODE, *_LOOSEST, *names]
        loosest = {**_NODE, **_LOOSEST, **{n: (n, "max") for n in names}}
        return [_known(tier, "", ["zone", "node", *kept]) for tier in summarise(rows, shifts, loosest)]

    def asked(limits: DataFrame) -> DataFrame:
        """Search rows with the smaller of their limits."""
        found = limits.withColumnsRenamed({n: f"new_{n}" for n in names})
        return seekers.join(found, "pos", "left").withColumns({n: F.least(n, f"new_{n}") for n in names}).drop(*[f"new_{n}" for n in names])

    def best(entries: DataFrame) -> DataFrame:
        order = Window.partitionBy("a_pos", "metric").orderBy(F.round("score", SCORE_DIGITS), "id")
        return staged(entries.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1), "entries")

    def limits_of(found: DataFrame) -> DataFrame:
        last = found.where(F.col("r") == k + 1).groupBy(F.col("a_pos").alias("pos"))
        return staged(last.agg(*[F.max(F.when(F.col("metric") == m, F.col("score"))).alias(f"limit_{m}") for m in metrics]), "limits")

    def nearest_blocks(pairs: DataFrame) -> DataFrame:
        order = Window.partitionBy("a_zone", "a_node").orderBy(F.expr(bound[metrics[0]]), "c_zone", "c_node")
        return pairs.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= width)

    def met(pairs: DataFrame) -> DataFrame:
        return scored(in_groups(pairs, as_blocks(rows, (*_SEARCH_COLUMNS, *names)), packs, together, [f"bound_{m}" for m in metrics]), shape, tally)

    rows = seekers
    spread = max(int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1) * GROUPS
    together = max(0, min(GROUP_BITS, int(math.log2(max(1, seekers.select("zone", "node").distinct().count() / spread)))))
    first = pruned_pairs(tiers(rows), offered, edges, shifts, nearest_blocks, nearer)
    first = staged(first.withColumn("turn", F.row_number().over(turn)), "first-pairs")
    found = best(met(first))

    rows = staged(asked(limits_of(found)), "search-rows")
    within = " OR ".join(f"{bound[m]} <= a_limit_{m} + {MARGIN!r}D" for m in metrics)
    rest = pruned_pairs(tiers(rows), offered, edges, shifts, lambda p: p.where(within), nearer)
    rest = staged(rest.join(first, _PAIR, "left_anti").withColumn("turn", F.row_number().over(turn)), "rest-pairs")
    done, upto = 0, GROWTH * width
    while not rest.where(F.col("turn") > done).isEmpty():
        now = rest.where(F.col("turn").between(done + 1, upto))
        if done:  # with the limits of the round before
            rows = staged(asked(limits_of(found)), "search-rows")
            block = rows.groupBy(F.col("zone").alias("a_zone"), F.col("node").alias("a_node")).agg(*[F.max(n).alias(n) for n in names])
            still = " OR ".join(f"bound_{m} <= limit_{m} + {MARGIN!r}D" for m in metrics)
            rest = staged(rest.where(F.col("turn") > done).join(block, ["a_zone", "a_node"]).where(still).drop(*names), "rest-pairs")
            now = rest.where(F.col("turn") <= upto)
        found = best(found.drop("r").unionByName(met(now)))
        done, upto = upto, GROWTH * upto
    lists = found.groupBy("a_pos", "metric").agg(F.sort_array(F.collect_list(F.struct("r", "score", "id"))).alias("found"))
    return lists.join(placed.select(F.col("pos").alias("a_pos"), "profile"), "a_pos").select("profile", "metric", "found")


def _smallest_ids(rows: DataFrame, edges: DataFrame, k: int, name: str) -> DataFrame:
    """(zone, name): the k+1 smallest ids of every zone's pool."""
    per_zone = Window.partitionBy("zone").orderBy("prop_id")
    heads = rows.withColumn("_r", F.row_number().over(per_zone)).where(F.col("_r") <= k + 1).select(F.col("zone").alias("neighbour"), "prop_id")
    pool = edges.select("zone", "neighbour").join(heads, "neighbour")
    best = Window.partitionBy("zone").orderBy("prop_id")
    return (
        pool.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k + 1)
        .groupBy("zone").agg(F.sort_array(F.collect_list("prop_id")).alias(name))
    )


def nearest(
    rows: DataFrame,
    edges: DataFrame,
    metrics: Sequence[str] = METRICS,
    k: int = NEIGHBOURS,
    distance: str = "vincenty",
    leaf_bits: int = LEAF_BITS,
    fan_bits: int = FAN_BITS,
    top_nodes: int = TOP_NODES,
    width: int = FIRST,
    tally: Accumulator | None = None,
    offers: DataFrame | None = None,
    caps: DataFrame | None = None,
) -> DataFrame:
    """search_prop, sim_prop, sim_score, sim_rank, metric for every wanted row of ``rows``.

    ``rows`` comes from :func:`score_rows`. Rank 1..k by score (missing last), then id. ``tally`` counts the
    pairs that got an exact distance. ``offers`` (column ``prop_id``, none of them wanted) are the only ones listed, with
    the ranges of the whole pool; ``caps`` (prop_id, limit_<metric>): nothing beyond these scores is looked for.
    """
    unknown = sorted(set(metrics) - set(METRICS))
    if unknown:
        raise ValueError(f"unknown metrics {unknown}; use {METRICS}")
    placed = _classes(rows, edges, distance, k, metrics, offers, caps)
    lists = _class_lists(placed, edges, distance, metrics, k, leaf_bits, fan_bits, top_nodes, width, tally, offers is not None)
    by_class = staged(
        lists.groupBy("profile").agg(F.map_from_entries(F.collect_list(F.struct("metric", "found"))).alias("found")), "class-lists"
    )

    # Candidates without coordinates rank behind all scored ones, so only short pools need them.
    sizes = rows.groupBy("zone").agg(F.count_if(F.col("lat").isNotNull()).alias("located"), F.count("*").alias("n"))
    short = (
        edges.join(sizes.withColumnRenamed("zone", "neighbour"), "neighbour").groupBy("zone")
        .agg(F.sum("located").alias("located"), F.sum("n").alias("n")).where((F.col("located") <= k + 1) & (F.col("n") > F.col("located")))
        .select("zone")
    )
    tails = _smallest_ids(rows.where("lat is null"), edges, k, "tail").join(short, "zone", "left_semi")
    pools = _smallest_ids(rows, edges, k, "tail")
    tails = staged(
        tails.withColumn("located", F.lit(True)).unionByName(pools.withColumn("located", F.lit(False))), "tails"
    )

    entry = "array<struct<r:int,score:double,id:bigint>>"
    members = rows.where("wanted").select("prop_id", "zone", "profile", F.col("lat").isNotNull().alias("located"))
    located = attach(members, by_class, ["profile"], F.col("prop_id"))
    listed = attach(staged(located, "members"), tails, ["zone", "located"], F.col("prop_id"))
    unscored = F.coalesce(F.transform("tail", lambda i: F.struct(F.lit(0), F.lit(INF), i)).cast(entry), F.array().cast(entry))
    each = listed.select("prop_id", "found", unscored.alias("unscored"), F.explode(F.array(*[F.lit(m) for m in metrics])).alias("metric"))
    scored = F.coalesce(F.try_element_at("found", F.col("metric")), F.array().cast(entry))
    others = F.slice(F.filter(F.concat(scored, F.col("unscored")), lambda e: e["id"] != F.col("prop_id")), 1, k)
    return each.select("prop_id", "metric", F.posexplode(others).alias("at", "e")).select(
        F.col("prop_id").alias("search_prop"), F.col("e.id").alias("sim_prop"), F.when(F.col("e.score") < INF, F.col("e.score")).alias("sim_score"),
        (F.col("at") + 1).alias("sim_rank"), "metric",
    )


def pair_components(pairs: DataFrame, rows: DataFrame, ranges: DataFrame, distance: str = "vincenty") -> DataFrame:
    """Parts of the score for listed pairs (search_prop, sim_prop): counts, distance, scaled parts.

    A much-listed neighbour is looked up through :func:`attach`.
    """
    pairs = staged(pairs.select("search_prop", "sim_prop").distinct(), "pairs")
    cols = ["flag_bits", "hood", "lat", "lon", "listing", *[f"f{i}" for i in range(_N)]]
    c = rows.select(F.col("prop_id").alias("sim_prop"), *[F.col(x).alias(f"c_{x}") for x in cols])
    a = rows.where("wanted").select(F.col("prop_id").alias("search_prop"), *[F.col(x).alias(f"a_{x}") for x in cols]).join(
        ranges.select(F.col("prop_id").alias("search_prop"), "ham_lo", "ham_hi", "km_lo", "km_hi"), "search_prop"
    )
    both = attach(pairs, c, ["sim_prop"], F.col("search_prop"), "inner").join(a, "search_prop")
    full = both.withColumns({
        "ham": bits_hamming(F.col("a_flag_bits"), F.col("c_flag_bits"), F.col("a_hood"), F.col("c_hood")),
        "km": distance_km(distance, "a_lat", "a_lon", "c_lat", "c_lon"),
    }).withColumns({
        "ham_scaled": unit(F.col("ham"), F.col("ham_lo"), F.col("ham_hi")),
        "km_scaled": unit(F.col("km"), F.col("km_lo"), F.col("km_hi")),
    })
    gaps = [f"abs(a_f{i} - c_f{i})" for i in range(_N)]
    both_tiers = [*gaps[:_NB], *[f"a_listing * {g}" for g in gaps[_NB:]]]
    squares = " + ".join(f"{g} * {g}" for g in both_tiers)
    return full.selectExpr("search_prop", "sim_prop", "ham", "km", "ham_scaled", "km_scaled", f"{squares} AS squared_diffs", f"{' + '.join(both_tiers)} AS absolute_diffs").withColumns({
        "euclidean": F.expr("sqrt(squared_diffs + ham_scaled * ham_scaled + km_scaled * km_scaled)"),
        "manhattan": F.expr("absolute_diffs + ham_scaled + km_scaled"),
    })
