import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from parcelmatch.llm import trie

from .conftest import rows_of

TURNS = "conv_id bigint, turn bigint, role string, text string"


def brute(rows):
    """Nodes of the trie of rebuilt conversations, from a dictionary of all prefixes."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in turns.items()}
    members = defaultdict(list)
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        full = tuple(own.get(c - c % 5, [])[:h] + mine[h:])
        for d in range(len(full) + 1):
            members[full[:d]].append((c, d == len(full)))
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)

    def below(p):
        rest = [below(k) for k in kids[p]]
        cost = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        return (sum(x for x, _ in rest) or (not rest)), cost + sum(y for _, y in rest)

    out = []
    for p, who in members.items():
        ends = ",".join(str(c) for c in sorted(c for c, last in who if last))
        leaves, saved = below(p)
        parent = min(c for c, _ in members[p[:-1]]) if p else None
        out.append((min(c for c, _ in who), len(p), parent, len(who), len(kids[p]), int(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def made(seed, conversations=80):
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(3 * conversations), conversations):
        for k in range(draw.choice((0, 1, 2, 3, 5, 12))):
            rows.append((c, k, draw.choice(("user", "bot", None)), draw.choice(("hi", "é", "", None, "long " * 9))))
    draw.shuffle(rows)
    return rows


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@pytest.mark.parametrize("block", [1, 2, 7, 1000])
def test_equals_brute_force_for_any_block_size(spark, block):
    rows = made(block)
    got = trie.prefix_trie(trie.rebuilt(spark.createDataFrame(rows, TURNS)), block)
    assert rows_of(got, *COLUMNS) == brute(rows)


def test_hot_beginnings_repeated_and_missing_rows(spark):
    rows = [(5 * c, k, "user", "hello" if k < 2 else f"{c} {k}") for c in range(60) for k in range(3)]
    rows += [(5 * c, 0, "user", "hello") for c in range(60, 120)] + [(1, None, None, None), (1, None, None, None), (1, 0, "b", "x"), (1, 0, "a", "y"), (1, 0, "a", "x")]
    rows += [(None, 1, "user", "nobody's"), (2, 0, "user", "word " * 100_000), (602, 0, "user", "x"), (603, 5, "r", ""), (603, 5, "r", None)]
    got = trie.prefix_trie(trie.rebuilt(spark.createDataFrame(rows, TURNS)), 16)
    assert rows_of(got, *COLUMNS) == brute(rows)


def test_turnless_only_and_empty(spark):
    rows = [(c, 0, "u", "t") for c in range(601, 640) if c % 5 and zlib.crc32(str(c).encode()) % 9]
    got = trie.prefix_trie(trie.rebuilt(spark.createDataFrame(rows, TURNS)), 4)
    assert rows_of(got, *COLUMNS) == brute(rows)
    assert len(rows_of(got)) == 1
    assert trie.prefix_trie(trie.rebuilt(spark.createDataFrame([], TURNS))).count() == 0


def test_more_columns_with_clashing_names(spark):
    rows = made(3, 30)
    turns = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], TURNS + ", place string, depth int, H string")
    assert rows_of(trie.prefix_trie(trie.rebuilt(turns), 8), *COLUMNS) == brute(rows)


def test_long_conversation(spark):
    rows = [(0, k, "u", f"t{k}") for k in range(3000)] + [(1, k, "u", f"t{k}") for k in range(2000)]
    got = {(r["conv_id"], r["depth"]): r for r in trie.prefix_trie(trie.rebuilt(spark.createDataFrame(rows, TURNS)), 1).collect()}
    assert len(got) == 3001 and got[0, 2000]["n_convs"] == 2 and got[0, 2001]["n_convs"] == 1 and got[0, 0]["n_leaves"] == 1


def test_ends_of_ranges():
    draw = np.random.default_rng(2)
    values = draw.integers(0, 5, 50)
    minima = trie.Minima(values)
    for at in range(50):
        for least in range(6):
            right = next((p for p in range(at + 1, 50) if values[p] < least), 50) - 1
            left = next((p for p in range(at, 0, -1) if values[p] < least), 0)
            assert minima.right(np.array([at]), np.array([least]))[0] == right
            assert minima.left(np.array([at]), np.array([least]))[0] == left
        for high in range(at, 50):
            assert minima.least(np.array([at]), np.array([high]))[0] == values[at : high + 1].min()
