import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelmatch.functions.geo import inverse_km
from parcelmatch.operators import blocks
from parcelmatch.operators.neighbours import nearest, pair_components, pool_ranges, score_rows
from parcelmatch.operators.zones import adjacency, pool_edges
from parcelmatch.registry import MEASURES
from scoring_fixture import ZONE_PAIRS, expected_rows, matrix


def fixture_edges(spark):
    return pool_edges(adjacency(spark.createDataFrame(ZONE_PAIRS, "a string, b string")))


def close(got, want, tol=1e-8):
    return (got is None) == (want is None) and (got is None or abs(got - want) <= tol)


def test_fixture_lists(spark):
    got = {(r.search_prop, r.sim_prop, r.metric): r for r in nearest(score_rows(matrix(spark)), fixture_edges(spark)).collect()}
    assert len(got) == 36
    for row in expected_rows():
        for metric, at in (("euclidean", 6), ("manhattan", 9)):
            r = got[int(row[0]), int(row[1]), metric]
            assert close(r.sim_score, row[at]), (row, metric, r)
            assert r.sim_rank == row[at + 1]


def test_fixture_components(spark):
    rows, edges = score_rows(matrix(spark)), fixture_edges(spark)
    pairs = nearest(rows, edges)
    got = {(r.search_prop, r.sim_prop): r for r in pair_components(pairs, rows, pool_ranges(rows, edges)).collect()}
    assert len(got) == 18
    for row in expected_rows():
        r = got[int(row[0]), int(row[1])]
        for name, want in zip(("ham", "km", "ham_scaled", "km_scaled", "euclidean"), row[2:7]):
            assert close(getattr(r, name), want), (row, name, r)
        assert close(r.manhattan, row[9])


def brute_force(props, neighbours, k):
    """All pairs in plain numpy, from the scoring rules."""
    lists = {}
    cols = np.array([[np.nan if v is None else v for v in p["m"]] for p in props], dtype=float)
    lo, hi = np.nanmin(cols, axis=0), np.nanmax(cols, axis=0)
    unit = np.nan_to_num(np.where(hi > lo, (cols - lo) / np.where(hi > lo, hi - lo, 1), 0 * cols), nan=0.0)
    for i, a in enumerate(props):
        pool = [j for j, c in enumerate(props) if j != i and c["zone"] in neighbours.get(a["zone"], ())]
        if not pool:
            continue
        ham = [bin(a["bits"] ^ props[j]["bits"]).count("1") + (0 if a["hood"] is not None and a["hood"] == props[j]["hood"] else 1) for j in pool]
        km = []
        for j in pool:
            c = props[j]
            ok = None not in (a["lat"], a["lon"], c["lat"], c["lon"])
            km.append(float(inverse_km(*(np.array([x]) for x in (a["lat"], a["lon"], c["lat"], c["lon"])))[0]) if ok else None)
        known = [x for x in km if x is not None]

        def scale(x, xs):
            return None if x is None else (x - min(xs)) / (max(xs) - min(xs)) if max(xs) > min(xs) else 0.0

        for metric in ("euclidean", "manhattan"):
            scored = []
            for j, h, d in zip(pool, ham, km):
                n = 7 if a["listing"] else 3
                diff = np.abs(unit[i, :n] - unit[j, :n])
                hs, ds = scale(h, ham), scale(d, known)
                if ds is None:
                    s = None
                elif metric == "euclidean":
                    s = round(float(np.sqrt((diff**2).sum() + hs**2 + ds**2)), 9)
                else:
                    s = round(float(diff.sum() + hs + ds), 9)
                scored.append((s is None, s or 0.0, props[j]["id"], s))
            lists[a["id"], metric] = [(e[2], e[3]) for e in sorted(scored)[:k]]
    return lists


def random_props(n, seed, hot=0.4, copies=0.3, missing=0.1):
    """Properties with one hot zone, many exact copies and missing coordinates."""
    rng = random.Random(seed)
    props = []
    for i in range(n):
        if props and rng.random() < copies:
            p = dict(props[rng.randrange(min(len(props), 5))], id=i)
        else:
            zone = 0 if rng.random() < hot else rng.randrange(1, 6)
            at = rng.random() >= missing
            listed = rng.random() < 0.5
            p = {
                "id": i, "zone": str(zone), "hood": rng.choice([None, "a", "b", "c"]), "bits": rng.randrange(32),
                "lat": 30 + zone * 0.01 + rng.random() * 0.02 if at else None, "lon": -97.7 + rng.random() * 0.02 if at else None,
                "listing": int(listed),
                "m": [rng.choice([None, rng.random()]), rng.random(), rng.random()] + [rng.random() if listed else None for _ in range(4)],
            }
        props.append(p)
    return props


def as_matrix(spark, props):
    data = [(p["id"], p["zone"], p["listing"], p["lat"], p["lon"], p["hood"], p["bits"], *p["m"]) for p in props]
    ms = ", ".join(f"{m} double" for m in MEASURES)
    return spark.createDataFrame(data, f"prop_id bigint, zone string, listing int, lat double, lon double, hood_cd string, flag_bits bigint, {ms}")


@pytest.mark.parametrize("seed,n,tiny", [(1, 260, True), (2, 260, False), (3, 12, True)])
def test_lists_equal_brute_force(spark, monkeypatch, seed, n, tiny):
    """Tiny blocks and fan-in limits drive every tier and the copying of hot leaves."""
    if tiny:
        monkeypatch.setattr(blocks, "MAX_FAN_IN", 2)
        monkeypatch.setattr(blocks.balanced, "__defaults__", (2,))
    props = random_props(n, seed)
    pairs = [(str(z), str(z + 1)) for z in range(4)]  # zone 5 stays outside the map
    edges = pool_edges(adjacency(spark.createDataFrame(pairs, "a string, b string"))).persist()
    near = {}
    for e in edges.collect():
        near.setdefault(e.zone, set()).add(e.neighbour)
    size = {"leaf_bits": 2, "fan_bits": 1, "top_nodes": 2, "width": 1} if tiny else {}
    got = {}
    for r in nearest(score_rows(as_matrix(spark, props)), edges, k=7, **size).orderBy("search_prop", "metric", "sim_rank").collect():
        got.setdefault((r.search_prop, r.metric), []).append((r.sim_prop, r.sim_score))
    want = brute_force(props, near, 7)
    assert got.keys() == want.keys()
    for key, entries in want.items():
        assert [e[0] for e in got[key]] == [e[0] for e in entries], key
        assert all(close(g[1], w[1], 2e-9) for g, w in zip(got[key], entries)), key


def one_zone(n, seed=4):
    """Properties of one zone with a dozen flags, many neighbourhoods and no copies."""
    rng = random.Random(seed)
    draw = lambda: round(rng.random(), 4)
    bits = lambda: sum((rng.random() < 0.3 + 0.04 * i) << i for i in range(12))
    return [
        {"id": i, "zone": "z", "hood": rng.choice("abcdefghijklmnopqrst"), "bits": bits(), "lat": 30 + 0.2 * draw(), "lon": -97.9 + 0.2 * draw(), "listing": 0,
         "m": [draw(), draw(), draw(), None, None, None, None]}
        for i in range(n)
    ]


def test_a_hot_zone_does_not_score_its_pairs(spark):
    """Ten times the properties: the pairs with an exact distance grow far less than a hundredfold."""
    counts = []
    for n in (500, 5000):
        edges = spark.createDataFrame([("z", "z")], "zone string, neighbour string")
        tally = spark.sparkContext.accumulator(0)
        rows = nearest(score_rows(as_matrix(spark, one_zone(n))), edges, ("euclidean",), tally=tally).count()
        assert rows == 20 * n
        counts.append(tally.value)
    assert counts[1] < 25 * counts[0], counts
    assert counts[1] < 0.03 * 5000 * 5000, counts
