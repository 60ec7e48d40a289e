"""The prefix trie of conversations: which beginnings are shared, by how many, and what sharing saves.

Conversations are put in order by their turns, so the conversations below a node stand together. The
order is cut into blocks. In a block, the numbers of first turns that neighbours have in common are
kept in a sparse table of range minima, and every prefix finds its own left and right end by halving
steps in that table. A prefix that reaches a border of its block is summed over blocks by its hash.

All counts of a node are sums over its conversations in order. A conversation i shares s(i) turns
with the one before it; its turns behind these begin new nodes. B(i, d) are the text bytes of its first d turns.
  saved tokens below a node of depth d:   sum of B(i, s(i)) - B(i, d - 1) over all but its first conversation
  leaves below it:                        conversations whose next one shares fewer turns than they have
  children:                               conversations that share d turns with the one before and have more
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.attach import attach
from ..session import staged
from .common import fresh
from .sharding import numbered

GROUP = 5  # conversations that may share the beginning of the first of them
HEADS = 9  # fewer turns than this are taken over
BLOCK = 256  # conversations of a block
HASH = 16  # bytes of a turn's hash: the first half of its SHA-256
EMPTY = hashlib.sha256(b"").hexdigest()


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of every conversation in order, as hash and bytes of the text.

    The order is turn (missing first), then role, then text; a missing role or text is empty. Rows without
    conv_id belong to no conversation and are left out. A conversation is one row, as a document is.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    whole = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    short = F.substring(F.sha2(whole.cast("binary"), 256), 1, 2 * HASH)
    hashed = rows.select("conv_id", "turn", short.alias("h"), F.octet_length("text").alias("b"))
    # Only turns whose number is there twice need their texts to be put in order.
    again = rows.groupBy("conv_id", "turn").agg(F.count("*").alias("n")).where("n > 1").selectExpr("conv_id AS c", "turn AS t")
    tied = rows.join(staged(again, "repeated-turns"), F.expr("c = conv_id AND t <=> turn"), "left_semi").distinct()
    ranks = tied.withColumn("h", short).selectExpr(
        "conv_id AS c", "turn AS t", "h AS g", "int(row_number() OVER (PARTITION BY conv_id, turn ORDER BY role, text)) AS tie"
    )
    placed = hashed.join(staged(ranks, "turn-ranks"), F.expr("c = conv_id AND t <=> turn AND g = h"), "left")
    placed = placed.selectExpr("conv_id", "turn", "h", "b", "coalesce(tie, 0) AS tie")
    entries = F.sort_array(F.collect_list(F.struct("turn", "tie", "h", "b")))
    return placed.groupBy("conv_id").agg(entries.alias("e")).select("conv_id", F.transform("e", lambda x: F.struct(x["h"].alias("h"), x["b"].alias("b"))).alias("turns"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): every conversation with its first h turns taken from the first of its group.

    h is crc32 of the id in decimal, mod 9. If the group's first conversation is shorter, all of its turns
    are taken; if it is absent, none.
    """
    own = staged(conversations(turns), "conversations")
    heads = own.where(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, HEADS - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    asked = own.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % GROUP})
    taken = asked.join(heads, "base", "left").withColumn("head", F.coalesce("head", F.slice("turns", 1, F.lit(0))))
    return taken.select("conv_id", F.expr("concat(slice(head, 1, h), slice(turns, h + 1, greatest(size(turns) - h, 0)))").alias("turns"))


# One block -----------------------------------------------------------------------------------

class Minima:
    """Sparse table: the least of any 2^k values one after the other."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [values]
        while 2 << len(self.levels) - 1 <= len(values):
            last, half = self.levels[-1], 1 << len(self.levels) - 1
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def right(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The last place p >= at so that all values in at+1..p are ``least`` or more."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            level, size = self.levels[k], 1 << k
            inside = at + 1 < len(level)
            go = inside & (level[np.where(inside, at + 1, 0)] >= least)
            at += np.where(go, size, 0)
        return at

    def left(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The first place p <= at so that all values in p+1..at are ``least`` or more."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            level, size = self.levels[k], 1 << k
            inside = at - size >= 0
            go = inside & (level[np.where(inside, at - size + 1, 0)] >= least)
            at -= np.where(go, size, 0)
        return at

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least value in low..high."""
        out = np.zeros(len(low), self.levels[0].dtype)
        span = np.frexp(high - low + 1)[1] - 1
        for k in np.unique(span):
            here = span == k
            out[here] = np.minimum(self.levels[k][low[here]], self.levels[k][high[here] - (1 << int(k)) + 1])
        return out


def shared(a: bytes, b: bytes) -> int:
    """Turns that two conversations have in common at the beginning."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // HASH
    return int(np.argmax(np.frombuffer(a[:n], np.uint8) != np.frombuffer(b[:n], np.uint8))) // HASH


def prefix_hash(key: bytes, depth: int) -> bytes:
    return hashlib.sha256(key[: depth * HASH]).digest()


_NODE = (
    "done boolean, node binary, part bigint, depth bigint, conv_id bigint, parent_conv_id bigint, above binary, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends string"
)
_NODE_NAMES = [f.split(" ")[0] for f in _NODE.split(", ")]
_KINDS = {"boolean": pa.bool_(), "binary": pa.binary(), "bigint": pa.int64(), "string": pa.string()}
_NODE_KINDS = [_KINDS[f.split(" ")[1]] for f in _NODE.split(", ")]


def block_nodes(part: int, keys: list[bytes], ids: np.ndarray, sizes: list[np.ndarray], before: bytes | None, after: bytes | None) -> pa.RecordBatch:
    """The nodes of one block of ordered conversations, between the conversations before and after it.

    Nodes inside are done; of those that go on before or behind, ``node`` and ``above`` are hashes of
    their own and their parent's turns, and ``ends`` lists ids instead of hashing them.
    """
    m = len(keys)
    around = [before, *keys, after]
    share = np.array([-1 if a is None or b is None else shared(a, b) for a, b in zip(around, around[1:])], np.int64)  # with the one before
    length = np.array([len(k) // HASH for k in keys], np.int64)
    first = np.maximum(share[:m] + 1, 0)
    first[0] = 0  # the block's first conversation also stands for prefixes that began before
    counts = length - first + 1
    row = np.repeat(np.arange(m), counts)
    depth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + first[row]
    minima, smallest = Minima(share[:m]), Minima(ids)
    low, high = minima.left(row, depth), minima.right(row, depth)
    goes_on = (low == 0) & (share[0] >= depth)
    done = ~goes_on & ~((high == m - 1) & (share[m] >= depth))
    bytes_of = [np.concatenate(([0], np.cumsum(s, dtype=np.int64))) for s in sizes]  # B(i, 0), B(i, 1), ...
    common = np.array([bytes_of[i][max(share[i], 0)] for i in range(m)], np.int64)
    leaf = share[1:] < length
    sums, leaves = (np.concatenate(([0], np.cumsum(x, dtype=np.int64))) for x in (common, leaf))
    start = low + ~goes_on  # all but the node's first conversation
    base = np.array([bytes_of[i][d - 1] if d else 0 for i, d in zip(row.tolist(), depth.tolist())], np.int64)
    saved = sums[high + 1] - sums[start] - (high + 1 - start) * base
    fork = np.flatnonzero((length > share[:m]) & (share[:m] >= 0))
    forks = np.sort(share[fork] * (m + 1) + fork)
    children = np.searchsorted(forks, depth * (m + 1) + high, "right") - np.searchsorted(forks, depth * (m + 1) + start, "left")
    children += ~goes_on & (length[low] > depth)
    up = np.maximum(depth - 1, 0)
    up_low, up_high = minima.left(row, up), minima.right(row, up)
    up_done = ~((up_low == 0) & (share[0] >= up)) & ~((up_high == m - 1) & (share[m] >= up))
    up_conv = smallest.least(up_low, up_high)
    spot = length * (m + 1) + np.arange(m)  # conversations by length, then place
    by = np.argsort(spot)
    ended = spot[by]
    end_low = np.searchsorted(ended, depth * (m + 1) + low, "left")
    end_high = np.searchsorted(ended, depth * (m + 1) + high, "right")
    names = ids.tolist()
    ends = []
    for k, (a, b) in enumerate(zip(end_low.tolist(), end_high.tolist())):
        text = ",".join(str(names[i]) for i in by[a:b].tolist())
        ends.append(hashlib.sha256(text.encode()).hexdigest() if done[k] else text or None)
    places = list(zip(row.tolist(), depth.tolist()))
    columns = [
        done, [None if ok else prefix_hash(keys[i], d) for ok, (i, d) in zip(done.tolist(), places)], np.full(len(row), part), depth,
        smallest.least(low, high), [int(c) if d and ok else None for c, d, ok in zip(up_conv.tolist(), depth.tolist(), up_done.tolist())],
        [None if ok or not d else prefix_hash(keys[i], d - 1) for ok, (i, d) in zip(up_done.tolist(), places)],
        high - low + 1, children, leaves[high + 1] - leaves[low], saved, ends,
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _NODE_KINDS)], names=_NODE_NAMES)


# All blocks ----------------------------------------------------------------------------------

def _blocks(ordered: DataFrame, place: str, size: int) -> DataFrame:
    """Nodes of all blocks; every block also gets the conversations next to it."""
    near = F.expr(f"array_distinct(array({place} div {size}, ({place} + 1) div {size}, greatest({place} - 1, 0) div {size}))")
    dealt = ordered.withColumn("part", F.explode(near)).repartition("part").sortWithinPartitions("part", place)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        part, rows = None, []

        def nodes() -> Iterable[pa.RecordBatch]:
            inside = [r for r in rows if r[0] // size == part]
            if not inside:
                return
            before = next((r[2] for r in rows if r[0] == inside[0][0] - 1), None)
            after = next((r[2] for r in rows if r[0] == inside[-1][0] + 1), None)
            ids = np.array([r[1] for r in inside], np.int64)
            yield block_nodes(part, [r[2] for r in inside], ids, [np.array(r[3], np.int64) for r in inside], before, after)

        for batch in batches:
            for at, place_, conv, key, sizes in zip(*(batch.column(c).to_pylist() for c in ("part", place, "conv_id", "key", "sizes"))):
                if at != part:
                    yield from nodes()
                    part, rows = at, []
                rows.append((place_, conv, key, sizes))
        yield from nodes()

    return dealt.select("part", place, "conv_id", "key", "sizes").mapInArrow(run, _NODE)


def _end_hashes(parts: DataFrame) -> DataFrame:
    """(node, ends_sha256) of nodes whose ids are listed over blocks: hashed in block order, a block's list at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        node, state = None, None

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])

        for batch in batches:
            for key, text in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
                if key != node:
                    if node is not None:
                        yield closed()
                    node, state = key, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
        if node is not None:
            yield closed()

    listed = parts.where("ends IS NOT NULL").select("node", "part", "ends")
    return listed.repartition("node").sortWithinPartitions("node", "part").select("node", "ends").mapInArrow(run, "node binary, ends_sha256 string")


def prefix_trie(rebuilt_: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``rebuilt_`` has one row (conv_id, turns) per conversation. Nothing is grouped by prefix before it is
    reduced to one row per block, so a beginning that a third of all conversations share costs nothing
    extra. A block's memory grows with its conversations' turns, not with their texts. An empty table has no
    nodes; conversations without turns are members of the root.
    """
    keyed = rebuilt_.select("conv_id", F.expr("unhex(array_join(turns.h, ''))").alias("key"), F.expr("turns.b").alias("sizes"))
    place = fresh(keyed, "place")
    ordered = staged(numbered(keyed, ["key", "conv_id"], place), "ordered-conversations")
    found = staged(_blocks(ordered, place, block), "trie-nodes")
    parts = found.where("NOT done")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    over = parts.groupBy("node", "depth").agg(F.min("conv_id").alias("conv_id"), F.first("above").alias("above"), *sums)
    over = over.join(_end_hashes(parts), "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY)))
    over = staged(over, "wide-nodes")
    out = ["conv_id", "depth", "above", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    rows = found.where("done").withColumnRenamed("ends", "ends_sha256").select(*out).unionByName(over.withColumn("parent_conv_id", F.lit(None).cast("bigint")).select(*out))
    rows = staged(rows, "all-nodes")
    below = rows.where("above IS NOT NULL").drop("parent_conv_id")
    parents = over.select(F.col("node").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    shown = [c for c in out if c != "above"]
    return rows.where("above IS NULL").select(*shown).unionByName(attach(below, parents, ["above"], F.struct("conv_id", "depth"), "inner").select(*shown))
