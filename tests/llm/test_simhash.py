import random
import re
from collections import defaultdict

import numpy as np
import xxhash

from parcelmatch.llm import simhash
from parcelmatch.llm.components import components

from .conftest import DOCS


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def close(values):
    array = np.array(values, np.uint64)
    for i, x in enumerate(array):
        for j in np.flatnonzero(np.bitwise_count(array[i + 1 :] ^ x) <= 2):
            yield values[i], values[i + 1 + j]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints_equal_the_definition():
    for text in ("", "  ", "One", "one TWO", "a b c", "Straße É é a b c d e f", "x " * 500, "a\x0bb\x0cc\x1cd e f g h"):
        assert simhash.fingerprint(text) == signed(slow_fingerprint(text))


def test_golay_code_corrects_three_errors():
    near, far = simhash.error_patterns()
    weights = np.bitwise_count(near)
    assert np.bincount(weights).tolist() == [1, 23, 253, 1771]
    assert ((far != 0).sum(1) == np.where(weights == 3, 5, 0)).all()
    draw = np.random.default_rng(1)
    words = draw.integers(0, 1 << 23, 2000)
    codes, others, has = simhash.codewords(words)
    assert (simhash.remainder(codes) == 0).all() and (np.bitwise_count(codes ^ words) <= 3).all()
    assert (simhash.remainder(others[has].ravel()) == 0).all() and (np.bitwise_count(others[has] ^ words[has, None]) == 4).all()


def test_two_bits_apart_always_share_a_key():
    draw = np.random.default_rng(2)
    for _ in range(400):
        a = int(draw.integers(0, 1 << 63))
        bits = draw.choice(64, draw.integers(0, 3), replace=False)
        b = a
        for bit in bits:
            b ^= 1 << int(bit)
        pair = np.array([signed(a), signed(b)], np.int64)
        rows, stored = simhash.keys(pair, False)
        _, sought = simhash.keys(pair[:1], True)
        assert set(stored[rows == 1]) & set(sought)


def random_prints(seed, clusters, size):
    draw, out = random.Random(seed), set()
    for _ in range(clusters):
        centre = draw.getrandbits(64)
        for _ in range(size):
            x = centre
            for bit in draw.sample(range(64), draw.randrange(4)):
                x ^= 1 << bit
            out.add(x)
    return sorted(out)


def test_links_have_the_components_of_brute_force(spark):
    for hot in (simhash.HOT, 3, 0):
        values = random_prints(hot, 12, 40)
        prints = spark.createDataFrame([(signed(v),) for v in values], "fp bigint")
        rows = components(simhash.links(prints, hot)).collect()
        got, want = defaultdict(set), defaultdict(set)
        root = {r["node"]: r["root"] for r in rows}
        for v in values:
            got[root.get(signed(v), signed(v))].add(v)
        for v, r in roots(values, close(values)).items():
            want[r].add(v)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 80)]
    links = spark.createDataFrame([*path, *star, *path, (5, 5)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in components(links).collect()}
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(80)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_documents_get_the_smallest_id(spark, odd, documents):
    rows = simhash.near_duplicates(odd).collect()
    found = defaultdict(list)
    for r in rows:
        found[r["component_id"]].append(r["doc_id"])
    assert sorted(found[1]) == [1, 2, 3] and sorted(found[5]) == [5, 5, 6] and found[None] == [None]
    assert len(rows) == odd.count()
    text = " ".join(f"w{i}" for i in range(900))
    near = documents([(9, text), (8, text + " more"), (3, text.upper()), (4, "quite another text than that one")])
    ids = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(near).collect()}
    assert ids[9][1] == ids[8][1] == ids[3][1] == 3 and ids[4][1] == 4
    assert ids[9][0] == f"{slow_fingerprint(text):016x}"
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_one_of_each_component_stays(odd, documents, spark):
    out = simhash.one_of_each(odd.selectExpr("*", "1 AS `_fp`", "2 AS `_key`"))
    assert out.columns == [*odd.columns, "_fp", "_key"]
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out.collect()) == [(False, 1), (False, 4), (False, 5), (False, 7), (True, 0)]
    twice = documents([(1, "alpha beta gamma delta"), (1, "other words entirely for the same id"), (2, "alpha beta gamma delta"), (None, "alpha beta gamma delta")])
    kept = [(r["doc_id"], r["text"]) for r in simhash.one_of_each(twice).collect()]
    assert sorted(kept) == [(1, "alpha beta gamma delta"), (1, "other words entirely for the same id")]
    lost = documents([(None, "alpha beta gamma delta"), (None, "alpha beta gamma delta")])
    assert simhash.one_of_each(lost).count() == 1
    assert simhash.one_of_each(spark.createDataFrame([], DOCS)).count() == 0
