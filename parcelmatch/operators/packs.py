"""Scores of blocks of properties against blocks of candidates, as arrays.

A block is one row whose columns are lists. A task holds a few adjacent search blocks and streams the blocks of
candidates past them, those with the least bound first; each comes once for all of them. What was found so far limits
what may still enter a list: blocks whose bound exceeds it are passed over, then properties whose bound to the block's
box does, then pairs whose cheap bound (a dense matrix) does; only what is left gets the exact distance.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Accumulator, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import AXES, BLUR_KM, EARTH_KM, FAR_KM, inverse_km, least_chord, least_km, most_km, positions
from .blocks import parallel

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MARGIN = 1e-8
ROUGH = 1e-5  # bounds in single precision are that much looser
TILE = 256  # search rows of a dense matrix
UNIT = 1e9  # scores are compared in whole billionths
HELD_PLACES = 1 << 17  # candidates for the nearest and the farthest place of a block's rows
UNSURE = 1e-5  # so near to a half of one, the rounding is left to the last step
ENTRIES = "a_pos bigint, metric string, score double, id bigint"


def as_blocks(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per (zone, node) with a list per column, in the order of ``pos``."""
    listed = rows.groupBy("zone", "node").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("r"))
    return listed.select("zone", "node", *[F.col(f"r.{c}").alias(c) for c in columns])


def streamed(pairs: DataFrame, search: DataFrame, offered: DataFrame, order: Sequence[str] = ("c_zone", "c_node")) -> DataFrame:
    """The blocks of all listed pairs: every search block, then the offered blocks that it needs, in ``order`` (columns of ``pairs``).

    ``offers`` tells them apart; columns that one side lacks are NULL. Any number of search blocks may need one
    offered block: each gets a copy, and they are dealt by search block.
    """
    kinds = dict(search.dtypes) | dict(offered.dtypes)
    names = [c for c in kinds if c not in ("zone", "node")]
    at = ["a_zone", "a_node"]

    def aligned(df: DataFrame, offers: bool) -> DataFrame:
        places = [F.col(c) if offers else F.lit(None).cast(pairs.schema[c].dataType).alias(c) for c in order]
        return df.select(*at, F.lit(offers).alias("offers"), *places, *[F.col(c) if c in df.columns else F.lit(None).cast(kinds[c]).alias(c) for c in names])

    asking = search.withColumnsRenamed({"zone": "a_zone", "node": "a_node"}).join(pairs.select(*at).distinct(), at, "left_semi")
    needed = pairs.join(offered.withColumnsRenamed({"zone": "c_zone", "node": "c_node"}), ["c_zone", "c_node"])
    dealt = parallel(aligned(asking, False).unionByName(aligned(needed, True)), *at)
    return dealt.sortWithinPartitions(*at, "offers", *order)


def in_groups(pairs: DataFrame, search: DataFrame, offered: DataFrame, bits: int, bounds: Sequence[str]) -> DataFrame:
    """Like ``streamed``, for 2^bits adjacent search blocks at a time, by the pairs' ``turn``.

    The search blocks of a group come first; every offered block that some of them need comes once, with
    ``seek``: the nodes that need it, and their ``bounds`` to it.
    """
    at = ["a_zone", "a_up"]
    up = F.shiftright("a_node", bits).alias("a_up")
    kinds = dict(search.dtypes) | dict(offered.dtypes)
    names = [c for c in kinds if c not in ("zone", "node")]
    seek = F.sort_array(F.collect_list(F.struct("a_node", *bounds))).alias("seek")
    grouped = pairs.groupBy("a_zone", up, "c_zone", "c_node").agg(F.min("turn").alias("turn"), seek)
    blocks = search.withColumnsRenamed({"zone": "a_zone", "node": "a_node"}).join(pairs.select("a_zone", "a_node").distinct(), ["a_zone", "a_node"], "left_semi")

    def aligned(df: DataFrame, offers: bool, places: dict[str, Column]) -> DataFrame:
        kept = [F.col(c) if c in df.columns else F.lit(None).cast(kinds[c]).alias(c) for c in names]
        return df.select("a_zone", *[x.alias(c) for c, x in places.items()], F.lit(offers).alias("offers"), *kept)

    none = {c: F.lit(None).cast(grouped.schema[c].dataType) for c in ("turn", "c_zone", "c_node", "seek")}
    asking = aligned(blocks, False, {"a_up": up, "own": F.col("a_node"), **none})
    needed = grouped.join(offered.withColumnsRenamed({"zone": "c_zone", "node": "c_node"}), ["c_zone", "c_node"])
    needed = aligned(needed, True, {"a_up": F.col("a_up"), "own": F.lit(None).cast("bigint"), **{c: F.col(c) for c in none}})
    return parallel(asking.unionByName(needed), *at).sortWithinPartitions(*at, "offers", "turn", "c_zone", "c_node", "own")


def _numbers(batch: pa.RecordBatch, i: int, names: Sequence[str]) -> list[np.ndarray]:
    return [batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in names]


class Shape(NamedTuple):
    """What the arrays hold: measures (the first ``base`` known for all), metrics, list length, distance.

    ``apart``: nobody searched is offered, so a class may list the ids of its own row.
    """

    measures: tuple[str, ...]
    base: int
    metrics: tuple[str, ...]
    k: int
    distance: str
    apart: bool = False


class Block:
    """The columns of one block; neighbourhoods as numbers of a dictionary that the task keeps."""

    def __init__(self, batch: pa.RecordBatch, i: int, shape: Shape, names: dict[str | None, int]) -> None:
        def values(name: str) -> pa.Array:
            return batch.column(name)[i].values

        def numbers(name: str) -> np.ndarray:
            return values(name).to_numpy(zero_copy_only=False)

        self.pos, self.bits, self.lat, self.lon = (numbers(c) for c in ("pos", "flag_bits", "lat", "lon"))
        self.f = np.stack([numbers(c) for c in shape.measures], 1)
        self.at = np.stack([numbers(c) for c in AXES], 1)
        hoods = values("hood").dictionary_encode()
        known = np.array([names.setdefault(h, len(names)) for h in hoods.dictionary.to_pylist()] or [-1], np.int64)
        self.hood = np.where(hoods.indices.is_null().to_numpy(zero_copy_only=False), -1, known[hoods.indices.fill_null(0).to_numpy(zero_copy_only=False)])


class Seekers(Block):
    """The rows of a group's search blocks, and which block (``own``) a row belongs to."""

    def __init__(self, parts: Sequence[tuple[pa.RecordBatch, int]], shape: Shape, names: dict[str | None, int]) -> None:
        blocks = [Block(batch, i, shape, names) for batch, i in parts]
        for c in ("pos", "bits", "lat", "lon", "f", "at", "hood"):
            setattr(self, c, np.concatenate([getattr(x, c) for x in blocks]))

        def joined(name: str) -> np.ndarray:
            return np.concatenate([batch.column(name)[i].values.to_numpy(zero_copy_only=False) for batch, i in parts])

        for c in ("listing", "ham_lo", "ham_rate", "km_lo", "km_rate"):
            setattr(self, c, joined(c).astype(float))
        self.limits = {m: joined(f"limit_{m}").astype(float) for m in shape.metrics}
        self.own = np.repeat([batch.column("own")[i].as_py() for batch, i in parts], [len(x.pos) for x in blocks])
        self.middle = self.at.mean(0)
        self.centred = self.at - self.middle
        self.far = np.square(self.centred).sum(1)
        single = self.f.astype(np.float32)
        self.single, self.weight = single, self.listing.astype(np.float32)
        self.scaled = np.concatenate([self.f[:, : shape.base], self.listing[:, None] * self.f[:, shape.base :]], 1)
        square = np.square(self.scaled).sum(1)
        self.product = np.column_stack([-2 * self.scaled, square, np.ones(len(square)), self.listing]).astype(np.float32)


class Offered(Block):
    def __init__(self, batch: pa.RecordBatch, i: int, shape: Shape, names: dict[str | None, int]) -> None:
        super().__init__(batch, i, shape, names)
        heads = batch.column("heads")[i].values
        self.ids, first = heads.values.to_numpy(zero_copy_only=False), heads.offsets.to_numpy()
        self.head_start, self.head_count = first[:-1].astype(np.int64), np.diff(first).astype(np.int64)
        self.low, self.high = (np.concatenate([end(self.f, axis=0), end(self.at, axis=0)]) for end in (np.min, np.max))
        self.and_bits, self.or_bits = np.bitwise_and.reduce(self.bits), np.bitwise_or.reduce(self.bits)
        self.hoods = np.unique(self.hood[self.hood >= 0])
        self.single = self.f.astype(np.float32)
        square = np.square(self.f)
        self.product = np.column_stack([self.f, np.ones(len(self.f)), square[:, : shape.base].sum(1), square[:, shape.base :].sum(1)]).astype(np.float32)


def _parts(shape: Shape, gaps: Iterable[np.ndarray], listing: np.ndarray, ham: np.ndarray) -> dict[str, np.ndarray]:
    """Per metric the sum of all parts but the distance: squares or absolute values."""
    sums = {m: np.square(ham) if m == "euclidean" else np.abs(ham) for m in shape.metrics}
    for i, gap in enumerate(gaps):
        for m in shape.metrics:
            term = gap * gap if m == "euclidean" else np.abs(gap)
            sums[m] += term if i < shape.base else listing * term
    return sums


def _total(metric: str, parts: np.ndarray, far: np.ndarray) -> np.ndarray:
    return np.sqrt(parts + far * far) if metric == "euclidean" else parts + np.abs(far)


def _exact_km(distance: str, lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    if distance == "vincenty":
        return inverse_km(lat1, lon1, lat2, lon2)
    half = (np.sin(np.radians(x) / 2) ** 2 for x in (lat2 - lat1, lon2 - lon1))
    chord = next(half) + np.cos(np.radians(lat1)) * np.cos(np.radians(lat2)) * next(half)
    return 2 * EARTH_KM * np.arcsin(np.sqrt(np.minimum(chord, 1)))


def _kept(of: np.ndarray, score: np.ndarray, ident: np.ndarray, k: int) -> np.ndarray:
    """Places of the k+1 best entries of each search row by (billionths, id), and of those whose rounding is unsure."""
    scaled = np.where(np.isfinite(score), score, np.finfo(float).max / UNIT) * UNIT
    whole = np.floor(scaled + 0.5)
    order = np.lexsort((ident, whole, of))
    sorted_of = of[order]
    rank = np.arange(len(order)) - np.searchsorted(sorted_of, sorted_of, "left")
    unsure = np.abs(scaled - np.floor(scaled) - 0.5) < UNSURE
    return order[(rank <= k) | unsure[order]]


def _in_reach(a: Seekers, c: Offered, shape: Shape, rows: np.ndarray) -> np.ndarray:
    """Those of the search ``rows`` whose bound to the box of the offered block is within a limit."""
    def apart(values: np.ndarray, dim: int) -> np.ndarray:
        return np.maximum(0, np.maximum(c.low[dim] - values, values - c.high[dim]))

    bits, wide = a.bits[rows], a.f.shape[1]
    ham = np.bitwise_count((bits & ~c.or_bits) | (c.and_bits & ~bits)) + 1.0 - np.isin(a.hood[rows], c.hoods)
    ham = np.maximum(0, ham - a.ham_lo[rows]) * a.ham_rate[rows]
    sums = _parts(shape, (apart(a.f[rows, d], d) for d in range(wide)), a.listing[rows], ham)
    chord = np.sqrt(sum(np.square(apart(a.at[rows, d], wide + d)) for d in range(3)))
    far = np.maximum(0, least_km(chord) - a.km_lo[rows]) * a.km_rate[rows]
    near = np.zeros(len(rows), bool)
    for m in shape.metrics:
        near |= _total(m, sums[m], far) <= a.limits[m][rows] + MARGIN
    return rows[near]


def _hopeful(a: Seekers, c: Offered, shape: Shape, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, place) of the search ``rows`` whose bound is within a limit, or in doubt: a dense matrix in single precision."""
    ham = np.bitwise_count(a.bits[rows, None] ^ c.bits[None, :]).astype(np.float32)
    ham -= a.hood[rows, None] == np.where(c.hood < 0, -2, c.hood)[None, :]
    ham += (1 - a.ham_lo[rows]).astype(np.float32)[:, None]
    np.maximum(ham, 0, out=ham)
    ham *= a.ham_rate[rows].astype(np.float32)[:, None]
    # straight lines from products; what these may lose to rounding is taken off first
    theirs = c.at - a.middle
    their_far = np.square(theirs).sum(1)
    far = a.centred[rows] @ (-2 * theirs.T)
    far += a.far[rows, None] - 1e-14 * (a.far[rows].max() + their_far.max())
    far += their_far[None, :]
    np.sqrt(np.maximum(far, 0, out=far), out=far)
    far -= (a.km_lo[rows] + BLUR_KM)[:, None]
    np.maximum(far, 0, out=far)
    far *= a.km_rate[rows][:, None]
    far = far.astype(np.float32)
    wanted = np.zeros(far.shape, bool)
    for m in shape.metrics:
        limit = a.limits[m][rows] + ROUGH
        if m == "euclidean":
            total = a.product[rows] @ c.product.T
            total += ham * ham
            total += far * far
            limit = limit * limit * (1 + ROUGH) + ROUGH
        else:
            total = ham + far
            for d in range(a.f.shape[1]):
                gap = np.abs(a.single[rows, d, None] - c.single[None, :, d])
                if d >= shape.base:
                    gap *= a.weight[rows, None]
                total += gap
            limit = limit * (1 + ROUGH)
        wanted |= total <= limit.astype(np.float32)[:, None]
    of, to = np.nonzero(wanted)
    return rows[of], to


def meet(a: Seekers, c: Offered, shape: Shape, rows: np.ndarray) -> tuple[list[tuple[str, np.ndarray, np.ndarray, np.ndarray]], int]:
    """Entries (metric, search row, score, id) that may be among the k+1 best of the search ``rows``, and the pairs scored exactly."""
    rows = _in_reach(a, c, shape, rows)
    found, pairs = [], 0
    for start in range(0, len(rows), TILE):
        of, to = _hopeful(a, c, shape, rows[start : start + TILE])
        other = (a.pos[of] != c.pos[to]) | (c.head_count[to] > 1) | shape.apart
        of, to = of[other], to[other]
        if len(of):
            entries, n = _exact(a, c, shape, of, to)
            found += entries
            pairs += n
    return found, pairs


def _exact(a: Seekers, c: Offered, shape: Shape, of: np.ndarray, to: np.ndarray) -> tuple[list[tuple[str, np.ndarray, np.ndarray, np.ndarray]], int]:
    # Bounds first.
    same = (a.hood[of] == c.hood[to]) & (a.hood[of] >= 0)
    ham = (np.bitwise_count(a.bits[of] ^ c.bits[to]) + 1.0 - same - a.ham_lo[of]) * a.ham_rate[of]
    gaps = a.f[of] - c.f[to]
    sums = _parts(shape, gaps.T, a.listing[of], ham)
    chord = np.sqrt(np.square(a.at[of] - c.at[to]).sum(1))
    least = np.maximum(0, least_km(chord) - a.km_lo[of]) * a.km_rate[of]
    hopeful, limits = np.zeros(len(of), bool), {}
    sought, line = np.unique(of, return_inverse=True)
    many = len(of) > 2 * shape.k * len(sought)  # lists that fill up here: no more than k+1 upper bounds are worth while
    most = np.maximum(0, most_km(shape.distance, chord) - a.km_lo[of]) * a.km_rate[of] if many else None
    for m in shape.metrics:
        limits[m] = a.limits[m]
        if many:
            upper = np.full((len(sought), len(c.pos)), np.inf)
            upper[line, to] = _total(m, sums[m], most)
            limits[m] = limits[m].copy()
            limits[m][sought] = np.minimum(limits[m][sought], np.partition(upper, shape.k, axis=1)[:, shape.k])
        hopeful |= _total(m, sums[m], least) <= limits[m][of] + MARGIN
    of, to = of[hopeful], to[hopeful]

    # Exact scores of what is left.
    km = _exact_km(shape.distance, a.lat[of], a.lon[of], c.lat[to], c.lon[to])
    far = (km - a.km_lo[of]) * a.km_rate[of]
    out = []
    for m in shape.metrics:
        score = _total(m, sums[m][hopeful], far)
        score = np.where(np.isnan(score), np.inf, score)
        near = np.flatnonzero(score <= limits[m][of] + MARGIN)
        near = near[_kept(of[near], score[near], c.ids[c.head_start[to[near]]], shape.k)]
        counts = c.head_count[to[near]]
        each = np.repeat(near, counts)
        ids = c.ids[np.repeat(c.head_start[to[near]] - (np.cumsum(counts) - counts), counts) + np.arange(len(each))]
        keep = _kept(of[each], score[each], ids, shape.k)
        out.append((m, of[each[keep]], score[each[keep]], ids[keep]))
    return out, len(of)


class Best:
    """The k+1 best entries of every search row so far, for one metric."""

    def __init__(self, rows: int, k: int) -> None:
        self.k = k
        self.of, self.score, self.id = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        self.last = np.full(rows, np.inf)

    def add(self, of: np.ndarray, score: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The (k+1)-th best score of every row, infinite where there are fewer. Only rows with new entries are sorted again."""
        if not len(of):
            return self.last
        touched = np.zeros(len(self.last), bool)
        touched[of] = True
        again = touched[self.of]
        of, score, ids = (np.concatenate([x[again], new]) for x, new in ((self.of, of), (self.score, score), (self.id, ids)))
        keep = _kept(of, score, ids, self.k)
        of, score, ids = of[keep], score[keep], ids[keep]
        self.of, self.score, self.id = (np.concatenate([x[~again], new]) for x, new in ((self.of, of), (self.score, score), (self.id, ids)))
        order = np.lexsort((score, of))
        rows, first, counts = np.unique(of[order], return_index=True, return_counts=True)
        full = counts > self.k
        self.last[rows[full]] = score[order][first[full] + self.k]
        return self.last


def scored(stream: DataFrame, shape: Shape, tally: Accumulator | None = None) -> DataFrame:
    """Entries of all search blocks, at most k+1 per row and metric but for ties in doubt.

    ``stream`` is partitioned and sorted by ``in_groups``, by bound: the least first. Memory: the search blocks of
    a group and one offered block. ``tally`` counts the pairs that got an exact distance.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        names: dict[str | None, int] = {}
        parts: list[tuple[pa.RecordBatch, int]] = []
        seekers: Seekers | None = None
        best: dict[str, Best] = {}
        worst: dict[str, dict[int, float]] = {}
        nodes: dict[int, np.ndarray] = {}

        def entries() -> Iterable[pa.RecordBatch]:
            for metric, b in best.items():
                columns = [pa.array(seekers.pos[b.of]), pa.array([metric] * len(b.of), pa.string()), pa.array(b.score), pa.array(b.id)]
                yield pa.RecordBatch.from_arrays(columns, names=["a_pos", "metric", "score", "id"])

        for batch in batches:
            for i, offering in enumerate(batch.column("offers").to_pylist()):
                if not offering:
                    if seekers is not None:
                        yield from entries()
                        seekers, parts = None, []
                    parts.append((batch, i))
                    continue
                if seekers is None:
                    seekers = Seekers(parts, shape, names)
                    best = {m: Best(len(seekers.pos), shape.k) for m in shape.metrics}
                    nodes = {x: np.flatnonzero(seekers.own == x) for x in np.unique(seekers.own).tolist()}
                    worst = {m: {x: float(seekers.limits[m][rows].max()) for x, rows in nodes.items()} for m in shape.metrics}
                asked = [
                    x["a_node"] for x in batch.column("seek")[i].as_py()
                    if any(x[f"bound_{m}"] <= worst[m][x["a_node"]] + MARGIN for m in shape.metrics)
                ]
                if not asked:
                    continue
                found, pairs = meet(seekers, Offered(batch, i, shape, names), shape, np.concatenate([nodes[x] for x in asked]))
                if tally is not None:
                    tally.add(pairs)
                for metric, of, score, ids in found:
                    seekers.limits[metric] = np.minimum(seekers.limits[metric], best[metric].add(of, score, ids))
                if found:
                    for m in shape.metrics:
                        worst[m] |= {x: float(seekers.limits[m][nodes[x]].max()) for x in asked}
        if seekers is not None:
            yield from entries()

    return stream.mapInArrow(run, ENTRIES)


class Ends:
    """Nearest and farthest other place of the rows of one search block, over the blocks offered so far.

    The straight lines met so far limit what is still looked at: rows that cannot gain from a block are passed over,
    and only places that can still be the nearest or the farthest are remembered (at most about ``HELD_PLACES`` before their
    exact distances are taken).
    """

    def __init__(self, distance: str, pos: np.ndarray, n: np.ndarray, lat: np.ndarray, lon: np.ndarray) -> None:
        self.distance, self.pos, self.single, self.lat, self.lon = distance, pos, n == 1, lat, lon
        self.axes = positions(distance, lat, lon)
        self.closest, self.farthest = np.full(len(pos), np.inf), np.zeros(len(pos))
        self.low, self.high = np.full(len(pos), np.inf), np.full(len(pos), -np.inf)
        self.held: list[list[np.ndarray]] = []
        self.count = 0

    def _limits(self) -> tuple[np.ndarray, np.ndarray]:
        """No nearest place is farther than its arc, no farthest nearer than the straight line."""
        return most_km(self.distance, self.closest), least_chord(self.distance, least_km(self.farthest))

    def offer(self, pos: np.ndarray, lat: np.ndarray, lon: np.ndarray) -> None:
        axes = positions(self.distance, lat, lon)
        ends = [(x, c.min(), c.max()) for x, c in zip(self.axes, axes)]
        least = np.sqrt(sum(np.square(np.maximum(0, np.maximum(low - x, x - high))) for x, low, high in ends))
        most = np.sqrt(sum(np.square(np.maximum(high - x, x - low)) for x, low, high in ends)) + BLUR_KM
        near, far = self._limits()
        rows = np.flatnonzero((least_km(least) <= near) | (most >= far))
        if not len(rows):
            return
        chord = np.sqrt(sum(np.square(x[rows, None] - c[None, :]) for x, c in zip(self.axes, axes)))
        other = ~((self.pos[rows, None] == pos[None, :]) & self.single[rows, None])
        self.closest[rows] = np.minimum(self.closest[rows], np.where(other, chord, np.inf).min(1))
        # places nearly opposite may have no distance, so they set no limit
        self.farthest[rows] = np.maximum(self.farthest[rows], np.where(other & (chord <= FAR_KM), chord, 0).max(1))
        near, far = self._limits()
        of, to = np.nonzero(((least_km(chord) <= near[rows, None]) | (chord >= far[rows, None])) & other)
        self.held.append([rows[of], lat[to], lon[to], chord[of, to]])
        self.count += len(of)
        if self.count > HELD_PLACES:
            self._thin()
            if self.count > HELD_PLACES // 2:
                self._settle()

    def _thin(self) -> None:
        """Forget the places that were passed by others since."""
        near, far = self._limits()
        of, lat, lon, chord = (np.concatenate(x) for x in zip(*self.held))
        keep = (least_km(chord) <= near[of]) | (chord >= far[of])
        self.held = [[x[keep] for x in (of, lat, lon, chord)]]
        self.count = int(keep.sum())

    def _settle(self) -> None:
        of, lat, lon, _ = self.held[0]
        km = _exact_km(self.distance, self.lat[of], self.lon[of], lat, lon)
        known = ~np.isnan(km)
        np.minimum.at(self.low, of[known], km[known])
        np.maximum.at(self.high, of[known], km[known])
        self.held, self.count = [], 0

    def found(self) -> pa.RecordBatch:
        if self.held:
            self._thin()
            self._settle()
        there = np.isfinite(self.low)
        return pa.RecordBatch.from_arrays([pa.array(x[there]) for x in (self.pos, self.low, self.high)], names=["a_pos", "km_lo", "km_hi"])


def far_and_near(stream: DataFrame, distance: str) -> DataFrame:
    """(a_pos, km_lo, km_hi): nearest and farthest other place of each search row.

    Columns pos, n (properties at the place), lat, lon; every search block is followed by the blocks offered to it. Straight lines
    tell which few places can be the nearest or the farthest; only these get the exact distance.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        ends: Ends | None = None
        for batch in batches:
            for i, offering in enumerate(batch.column("offers").to_pylist()):
                if offering:
                    ends.offer(*_numbers(batch, i, ("pos", "lat", "lon")))
                    continue
                if ends is not None:
                    yield ends.found()
                ends = Ends(distance, *_numbers(batch, i, ("pos", "n", "lat", "lon")))
        if ends is not None:
            yield ends.found()

    return stream.mapInArrow(run, "a_pos bigint, km_lo double, km_hi double")
