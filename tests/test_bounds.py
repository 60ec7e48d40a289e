import numpy as np
import pytest

from parcelmatch.functions.geo import AXES, box_km_by_degrees, inverse_km, least_chord, least_km, most_km, position
from parcelmatch.operators import packs
from parcelmatch.operators.packs import _exact_km


@pytest.mark.parametrize("metric", ["vincenty", "haversine"])
def test_straight_lines_bound_distances(spark, metric):
    draw = np.random.default_rng(3)
    lat, lon = draw.uniform(-90, 90, 4000), draw.uniform(-180, 180, 4000)
    near = draw.normal(0, 0.2, (2, 2000))
    lat[2000:], lon[2000:] = np.clip(lat[:2000] + near[0], -90, 90), lon[:2000] + near[1]
    rows = spark.createDataFrame(list(enumerate(zip(lat.tolist(), lon.tolist()))), "i int, p struct<lat:double,lon:double>").select("i", "p.*")
    at = rows.selectExpr("i", *[f"{e} AS {x}" for x, e in position("lat", "lon", metric).items()]).toPandas().sort_values("i")[list(AXES)].to_numpy()
    for a, b in ((np.arange(2000), np.arange(2000, 4000)), (np.arange(3999), np.arange(1, 4000))):
        km = _exact_km(metric, lat[a], lon[a], lat[b], lon[b])
        chord = np.sqrt(np.square(at[a] - at[b]).sum(1))
        ok = ~np.isnan(km)
        assert ok.mean() > 0.99
        assert (least_km(chord) <= km)[ok].all() and (most_km(metric, chord) >= km)[ok].all() and (chord >= least_chord(metric, km))[ok].all()
        short = ok & (km < 200)
        assert ((most_km(metric, chord) - least_km(chord))[short] < 1e-4 * km[short] + 3e-6).all()


def test_inverse_needs_no_valid_latitude():
    assert np.isfinite(inverse_km(*(np.array([x]) for x in (30.0, 10.0, 200.0, 10.5)))).all()


@pytest.mark.parametrize("metric", ["vincenty", "haversine"])
def test_boxes_bound_distances(spark, metric):
    draw = np.random.default_rng(8)
    rows, points = [], []
    for size in (0.01, 0.5, 20.0, 120.0):
        for _ in range(60):
            row = []
            inside = []
            for top, scale in ((90, 0.5), (180, 1.0), (90, 0.5), (180, 1.0)):
                low = draw.uniform(-top, top)
                high = min(top, low + draw.uniform(0, size * scale))
                row += [float(low), float(high)]
                inside.append(draw.uniform(low, high, 50))
            rows.append(row)
            points.append(_exact_km(metric, *inside))
    names = [f"{p}_{x}_{e}" for p in "ac" for x in ("lat", "lon") for e in ("lo", "hi")]
    low, high = box_km_by_degrees("a_", "c_", metric)
    got = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).selectExpr(*names, f"{low} AS low", f"{high} AS high").collect()
    found = {tuple(r[:8]): r for r in got}
    for row, km in zip(rows, points):
        r = found[tuple(row)]
        assert r["low"] <= np.nanmin(km) + 1e-9 and np.nanmax(km) <= r["high"] + 1e-9


@pytest.mark.parametrize("metric", ["vincenty", "haversine"])
def test_few_places_get_an_exact_distance(monkeypatch, metric):
    taken = []
    monkeypatch.setattr(packs, "_exact_km", lambda m, *at: taken.append(len(at[0])) or _exact_km(m, *at))
    draw = np.random.default_rng(5)
    lat, lon = draw.uniform(30, 30.04, 4096), draw.uniform(-97.9, -97.85, 4096)
    lat[7], lon[7] = -30.02, 82.12  # nearly opposite: may have no distance
    grid = np.lexsort((lon, np.floor((lat - 30) * 800)))
    lat, lon, pos = lat[grid], lon[grid], np.arange(4096)
    blocks = np.array_split(pos, 32)
    ends = packs.Ends(metric, pos[blocks[3]], np.where(blocks[3] % 9 == 0, 2, 1), lat[blocks[3]], lon[blocks[3]])
    for k in (3, 2, 4, *[i for i in range(32) if i not in (2, 3, 4)]):
        ends.offer(pos[blocks[k]], lat[blocks[k]], lon[blocks[k]])
    got = ends.found().to_pydict()
    assert sum(taken) < 8 * len(blocks[3])  # of 32 blocks; two of each block before
    for at, low, high in zip(got["a_pos"], got["km_lo"], got["km_hi"]):
        km = _exact_km(metric, np.full(4096, lat[at]), np.full(4096, lon[at]), lat, lon)
        others = np.delete(km, at) if at % 9 else km
        assert low == np.nanmin(others) and high == np.nanmax(others)
    assert got["a_pos"] == pos[blocks[3]].tolist()
