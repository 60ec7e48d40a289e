"""Fill-in-the-middle: texts cut into prefix, middle and suffix at drawn units, and put back together.

A unit is a run of ASCII letters or any other single character. A text is laid out in blocks of fixed
size; a Fenwick tree over the blocks holds how many units and code points begin in each. To cut after
u units the tree is descended by halving steps to the block in which unit u begins, and only that
block is searched for the place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import Step, fresh, in_batches, texts_of

BLOCK = 1024  # bytes of a block
# The marks, the seed of the draws, and how often a text is cut and the suffix goes first (of 100).
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "1:"
CUT_RATE, SUFFIX_FIRST = 90, 20


class Counts:
    """Fenwick tree over blocks; each node sums the pairs (units, code points) of the blocks it covers."""

    def __init__(self, pairs: np.ndarray) -> None:
        n = len(pairs)
        tree = np.zeros((n + 1, 2), np.int64)
        tree[1:] = pairs
        step = 1
        while step <= n:  # each node adds itself to the next larger node, level by level
            at = np.arange(step, n + 1, 2 * step)
            above = at + step
            tree[above[above <= n]] += tree[at[above <= n]]
            step *= 2
        self.tree, self.top = tree, 1 << (n.bit_length() - 1) if n else 0

    def find(self, unit: int) -> tuple[int, int, int]:
        """The block in which unit number ``unit`` begins, and the units and code points before that block."""
        tree, at, units, points, step = self.tree, 0, 0, 0, self.top
        while step:
            ahead = at + step
            if ahead < len(tree) and units + tree[ahead, 0] <= unit:
                at, units, points = ahead, units + int(tree[ahead, 0]), points + int(tree[ahead, 1])
            step >>= 1
        return at, units, points


class Layout:
    """Where the units of a text (as UTF-8) begin, by blocks."""

    def __init__(self, raw: bytes, size: int = BLOCK) -> None:
        data = np.frombuffer(raw, np.uint8)
        self.size, self.points = size, (data & 0xC0) != 0x80
        letter = ((data | 0x20) >= ord("a")) & ((data | 0x20) <= ord("z"))
        self.begins = self.points.copy()
        self.begins[1:] &= ~(letter[1:] & letter[:-1])
        starts = np.arange(0, len(data), size)
        pairs = [np.add.reduceat(x, starts, dtype=np.int64) if len(data) else np.zeros(0, np.int64) for x in (self.begins, self.points)]
        self.units, self.code_points = int(pairs[0].sum()), int(pairs[1].sum())
        self.counts = Counts(np.stack(pairs, 1))

    def cut(self, units: int) -> tuple[int, int]:
        """Bytes and code points of the first ``units`` units."""
        if units >= self.units:
            return len(self.begins), self.code_points
        block, before, points = self.counts.find(units)
        low = block * self.size
        inside = int(np.flatnonzero(self.begins[low : low + self.size])[units - before])
        return low + inside, points + int(np.count_nonzero(self.points[low : low + inside]))


class Infill(NamedTuple):
    units: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: bytes


def draws(doc_id: object) -> tuple[int, int, int, int]:
    seen = hashlib.sha256(f"{SEED}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(seen[k : k + 8], 16) for k in range(0, 32, 8))


def transform(doc_id: object, text: str) -> Infill:
    """One text's form and output; the same id and text always give the same."""
    raw = text.encode()
    layout = Layout(raw)
    n = layout.units
    first, second, chance, order = draws(doc_id)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or chance % 100 >= CUT_RATE:
        return Infill(n, "plain", None, None, raw)
    low, high = sorted((first % (n + 1), second % (n + 1)))
    (a, a_points), (b, b_points) = layout.cut(low), layout.cut(high)
    prefix, middle, suffix = (PREFIX.encode(), raw[:a]), (MIDDLE.encode(), raw[a:b]), (SUFFIX.encode(), raw[b:])
    form = "spm" if order % 100 < SUFFIX_FIRST else "psm"
    parts = (suffix, prefix, middle) if form == "spm" else (prefix, suffix, middle)
    return Infill(n, form, a_points, b_points - a_points, b"".join(x for part in parts for x in part))


def restore(output: str, form: str) -> str:
    """The text that an output was made of.

    A cut text has no mark of its own, and none can arise where a part meets a mark, so the first
    of each mark is the one that was put there.
    """
    if form == "plain":
        return output
    first, second = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    one, rest = output[len(first) :].split(second, 1)
    two, middle = rest.split(MIDDLE, 1)
    prefix, suffix = (two, one) if form == "spm" else (one, two)
    return prefix + middle + suffix


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """``docs`` with n, form, prefix_chars, middle_chars and output for every whole text.

    A missing text is empty and stays plain; a missing id draws like an empty one; repeated rows and
    ids give the same output each. A column of ``docs`` that has one of these names keeps it, the
    new one gets ``_`` behind its name.
    """
    names = [fresh(docs, x) for x in ("n", "form", "prefix_chars", "middle_chars", "output")]
    kinds = (LongType(), StringType(), LongType(), LongType(), StringType())
    schema = StructType([*docs.schema.fields, *(StructField(n, k) for n, k in zip(names, kinds))])
    types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())

    def start() -> Step:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            done = [transform(i, t) for i, t in zip(batch.column("doc_id").to_pylist(), texts_of(batch))]
            columns: Iterator = zip(*done) if done else ([] for _ in types)
            new = [pa.array([x.decode() for x in c] if k == 4 else c, types[k]) for k, c in enumerate(columns)]
            return pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *names])

        return step

    return in_batches(docs, start, schema)


def restored(infilled: DataFrame, output: str = "output", form: str = "form", name: str = "restored") -> DataFrame:
    """``infilled`` with the texts rebuilt from output and form; a missing output or form gives a missing text."""
    name = fresh(infilled, name)

    def start() -> Step:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            pairs = zip(batch.column(output).to_pylist(), batch.column(form).to_pylist())
            texts = pa.array([None if o is None or f is None else restore(o, f) for o, f in pairs], pa.string())
            return pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, name])

        return step

    return in_batches(infilled, start, StructType([*infilled.schema.fields, StructField(name, StringType())]))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 of every document."""
    done = restored(fill_in_middle(docs.select("doc_id", "text")).drop("text"))
    sha = {f"{x}_sha256": F.sha2(F.col(x).cast("binary"), 256) for x in ("output", "restored")}
    return done.withColumns(sha).select("doc_id", "n", "form", "prefix_chars", "middle_chars", *sha)
