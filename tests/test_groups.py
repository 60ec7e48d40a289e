import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parcelmatch.operators import neighbours, packs
from parcelmatch.operators.neighbours import nearest, score_rows
from parcelmatch.operators.zones import adjacency, pool_edges
from test_scoring import as_matrix, brute_force, close, random_props


@pytest.mark.parametrize("seed", [5, 6])
def test_lists_of_search_blocks_in_groups_equal_brute_force(spark, monkeypatch, seed):
    """Several search blocks of one zone share the blocks offered to them."""
    monkeypatch.setattr(neighbours, "GROUPS", 0.01, raising=False)
    groups = []
    monkeypatch.setattr(neighbours, "in_groups", lambda *args: groups.append(args[3]) or packs.in_groups(*args))
    props = random_props(220, seed, hot=0.8)
    edges = pool_edges(adjacency(spark.createDataFrame([(str(z), str(z + 1)) for z in range(4)], "a string, b string"))).persist()
    near = {}
    for e in edges.collect():
        near.setdefault(e.zone, set()).add(e.neighbour)
    got = {}
    found = nearest(score_rows(as_matrix(spark, props)), edges, k=7, leaf_bits=2, width=2)
    for r in found.orderBy("search_prop", "metric", "sim_rank").collect():
        got.setdefault((r.search_prop, r.metric), []).append((r.sim_prop, r.sim_score))
    want = brute_force(props, near, 7)
    assert max(groups) > 0
    assert got.keys() == want.keys()
    for key, entries in want.items():
        assert [e[0] for e in got[key]] == [e[0] for e in entries], key
        assert all(close(g[1], w[1], 2e-9) for g, w in zip(got[key], entries)), key


def test_an_offered_block_comes_once_for_a_group(spark):
    pairs = spark.range(8).select(F.lit("z").alias("a_zone"), F.col("id").alias("a_node")).crossJoin(
        spark.range(100, 105).select(F.lit("z").alias("c_zone"), F.col("id").alias("c_node"))
    ).withColumns({"turn": F.lit(1), "bound_euclidean": F.lit(0.5)})
    side = lambda low, high: spark.range(low, high).select(F.lit("z").alias("zone"), F.col("id").alias("node"), F.array("id").alias("pos"))
    dealt = packs.in_groups(pairs, side(0, 8), side(100, 105), 3, ["bound_euclidean"]).collect()
    assert sorted(r.own for r in dealt if not r.offers) == list(range(8))
    offered = [r for r in dealt if r.offers]
    assert sorted(r.c_node for r in offered) == list(range(100, 105))
    assert all([s.a_node for s in r.seek] == list(range(8)) for r in offered)


def _block(rng, n, first, wide, **more):
    lat, lon = 30 + wide * rng.random(n), -97.9 + wide * rng.random(n)
    columns = {f"f{i}": rng.random(n) for i in range(7)} | dict(zip("xyz", packs.positions("vincenty", lat, lon))) | {
        "lat": lat, "lon": lon, "pos": first + np.arange(n), "flag_bits": rng.integers(0, 64, n), "hood": [[None, "a", "b"][i] for i in rng.integers(0, 3, n)],
    } | more
    return pa.RecordBatch.from_pydict({c: [list(x) if not isinstance(x, int) else x][0:1] if not isinstance(x, int) else [x] for c, x in columns.items()})


@pytest.mark.parametrize("wide", [1e-6, 1e-3, 0.3, 60.0])
@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_dense_bounds_lose_no_pair(metric, wide):
    """Every pair within the limits is scored, at any spread of the places."""
    rng, n = np.random.default_rng(1), 40
    shape = packs.Shape(tuple(f"f{i}" for i in range(7)), 3, (metric,), 5, "vincenty")
    km = 110 * wide
    fixed = {"listing": rng.integers(0, 2, n), "ham_lo": np.zeros(n), "ham_rate": np.full(n, 0.1), "km_lo": np.full(n, 0.01 * km), "km_rate": np.full(n, 1 / km)}
    names = {}
    search = _block(rng, n, 0, wide, own=3, **fixed, **{f"limit_{metric}": np.full(n, 9.0)})
    a = packs.Seekers([(search, 0)], shape, names)
    offer = _block(rng, 60, 1000, wide, heads=[[2000 + i] for i in range(60)])
    c = packs.Offered(offer, 0, shape, names)
    of, to = np.divmod(np.arange(n * 60), 60)
    same = (a.hood[of] == c.hood[to]) & (a.hood[of] >= 0)
    parts = packs._parts(shape, (a.f[of] - c.f[to]).T, a.listing[of], (np.bitwise_count(a.bits[of] ^ c.bits[to]) + 1.0 - same) * 0.1)
    far = (packs._exact_km("vincenty", a.lat[of], a.lon[of], c.lat[to], c.lon[to]) - a.km_lo[of]) * a.km_rate[of]
    scores = packs._total(metric, parts[metric], far).reshape(n, 60)
    a.limits[metric] = np.sort(scores, axis=1)[:, 9]  # exactly the tenth score
    got = set(zip(*(x.tolist() for x in packs._hopeful(a, c, shape, packs._in_reach(a, c, shape, np.arange(n))))))
    within = set(zip(*(x.tolist() for x in np.nonzero(scores <= a.limits[metric][:, None]))))
    assert within <= got and len(got) < n * 60
    found, _ = packs.meet(a, c, shape, np.arange(n))
    best = packs.Best(n, shape.k)
    for _, rows, score, ids in found:
        last = best.add(rows, score, ids)
    assert np.allclose(last, np.sort(scores, axis=1)[:, 5], atol=1e-12)
