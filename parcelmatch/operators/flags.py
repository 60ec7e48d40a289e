"""Smallest and largest Hamming count of a flag mask over sets of masks, without comparing all of them.

The distance from every mask to a set is found by one pass per flag: a mask is as near as
itself or as the mask with that flag flipped, plus one. The farthest member of a set is the one
nearest to the complement. All tables here have at most 2^flags entries per group.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FAR = 1 << 20  # "no member"
ANY = "\x00"
PAIRS = 1 << 18  # up to so many comparisons are made one by one


class Nearest:
    """Per mask: distance and label of the nearest member, and distance of the nearest with another label."""

    def __init__(self, bits: int) -> None:
        self.bits, n = bits, 1 << bits
        self.one, self.two = np.full(n, FAR), np.full(n, FAR)
        self.label, self.other = np.full(n, -1), np.full(n, -1)

    def _offer(self, near: np.ndarray, label: np.ndarray) -> None:
        same, closer = label == self.label, near < self.one
        moved = closer & ~same
        second = ~closer & ~same & (near < self.two)
        self.two = np.where(moved, self.one, np.where(second, near, self.two))
        self.other = np.where(moved, self.label, np.where(second, label, self.other))
        self.one, self.label = np.where(closer, near, self.one), np.where(closer, label, self.label)

    def fill(self, masks: np.ndarray, *labels: np.ndarray) -> Nearest:
        """Members ``masks`` with one or more labels each (-1: none), then all distances."""
        for label in labels:
            near = np.full(len(self.one), FAR)
            tag = np.full(len(self.one), -1)
            near[masks[label >= 0]], tag[masks[label >= 0]] = 0, label[label >= 0]
            self._offer(near, tag)
        every = np.arange(len(self.one))
        for bit in range(self.bits):
            flipped = every ^ (1 << bit)
            offers = [(self.one[flipped] + 1, self.label[flipped]), (self.two[flipped] + 1, self.other[flipped])]
            for near, label in offers:
                self._offer(np.minimum(near, FAR), label)
        return self

    def without(self, masks: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Distance to the nearest member that has a label other than ``label``."""
        return np.where(self.label[masks] == label, self.two[masks], self.one[masks])


def _missing(values: np.ndarray, ok: np.ndarray) -> pd.Series:
    return pd.Series(np.where(ok, values, 0)).astype("Int64").where(pd.Series(ok))


def over_zone(masks: pd.DataFrame, sought: pd.DataFrame, bits: int) -> pd.DataFrame:
    """Per sought mask its ranges over the masks of one zone, in a form that fits any neighbourhood.

    ``masks``: c_bits, hood_lo, hood_hi (smallest and largest neighbourhood of the mask's properties),
    unknown (of them without one), n. Result: low_1, low_hood, low_2 -- distance of the nearest
    property, its neighbourhood (ANY if it has none, which differs from all), distance of
    the nearest one of another neighbourhood -- the same for the farthest, and the ends over all
    properties but one of the mask itself (alone_low, alone_high).
    """
    members = masks["c_bits"].to_numpy(np.int64)
    names = [ANY, *sorted({*masks["hood_lo"].dropna(), *masks["hood_hi"].dropna()})]
    number = {h: i for i, h in enumerate(names)}
    first = np.where(masks["unknown"] > 0, 0, masks["hood_lo"].map(number).fillna(-1)).astype(np.int64)
    second = np.where(masks["unknown"] > 0, -1, masks["hood_hi"].map(number).fillna(-1)).astype(np.int64)
    second = np.where(second == first, -1, second)
    by_hood = Nearest(bits).fill(members, first, second)
    lone = np.where(masks["n"] == 1, members, 1 << bits)  # two properties of a mask never leave it empty
    by_mask = Nearest(bits).fill(members, lone)
    at = sought["flag_bits"].to_numpy(np.int64)
    away = at ^ ((1 << bits) - 1)
    out = {"flag_bits": at}
    for end, place in (("low", at), ("high", away)):
        sign, base = (1, 0) if end == "low" else (-1, bits)
        one, two = by_hood.one[place], by_hood.two[place]
        out |= {
            f"{end}_1": _missing(base + sign * one, one < FAR), f"{end}_hood": [names[i] if i >= 0 else None for i in by_hood.label[place]],
            f"{end}_2": _missing(base + sign * two, two < FAR),
        }
        alone = by_mask.without(place, at)
        out[f"alone_{end}"] = _missing(base + sign * alone, alone < FAR)
    return pd.DataFrame(out)


def over_hood(members: pd.DataFrame, sought: pd.DataFrame, bits: int) -> pd.DataFrame:
    """Per sought mask its range over the masks of one neighbourhood: flag_bits, own, low, high.

    ``members``: c_bits, n; ``sought``: flag_bits, own (whether the mask's property is in this zone, and so
    itself no candidate).
    """
    masks, n = members["c_bits"].to_numpy(np.int64), members["n"].to_numpy(np.int64)
    at, own = sought["flag_bits"].to_numpy(np.int64), sought["own"].to_numpy(bool)
    if len(masks) * len(at) <= PAIRS:
        apart = np.bitwise_count(at[:, None] ^ masks[None, :]).astype(np.int64)
        itself = own[:, None] & (at[:, None] == masks[None, :]) & (n == 1)[None, :]
        low = np.where(itself, FAR, apart).min(1, initial=FAR)
        high = np.where(itself, -FAR, apart).max(1, initial=-FAR)
    else:
        near = Nearest(bits).fill(masks, np.where(n == 1, masks, 1 << bits))
        label = np.where(own, at, -2)
        low = near.without(at, label)
        high = bits - near.without(at ^ ((1 << bits) - 1), label)
    ok = low < FAR
    return pd.DataFrame({"flag_bits": at, "own": own, "low": _missing(low, ok), "high": _missing(high, ok)})
