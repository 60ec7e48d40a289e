import random
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from parcelmatch.functions.geo import distance_km, inverse_km
from parcelmatch.operators import flags, lookup
from parcelmatch.operators.attach import attach
from parcelmatch.operators.baseline import numbered, random_baseline
from parcelmatch.operators.documents import neighbour_list, publish_documents, require_single
from parcelmatch.operators.signs import hyperplanes, property_vector, sign_bands, sign_neighbours, signer
from parcelmatch.operators.zones import adjacency, pool_edges
from parcelmatch.session import staged, staging_root, temporary_staging
from parcelmatch.streaming.incremental import append_pending, follow_requests, ledger
from scoring_fixture import ZONE_PAIRS, matrix


def test_distance_anchors(spark):
    df = spark.createDataFrame(
        [(30.2672, -97.7431, 30.27, -97.74), (30.2672, -97.7431, 30.35, -97.76), (30.0, 1.0, 30.0, 1.0), (None, 1.0, 2.0, 3.0)],
        "a double, b double, c double, d double",
    )
    got = df.select(distance_km("vincenty", "a", "b", "c", "d").alias("v"), distance_km("haversine", "a", "b", "c", "d").alias("h")).collect()
    assert got[0].v == pytest.approx(0.430499696, abs=1e-8) and got[0].h == pytest.approx(0.430776966, abs=1e-8)
    assert got[1].v == pytest.approx(9.321840588, abs=1e-8) and got[1].h == pytest.approx(9.348796108, abs=1e-8)
    assert got[2].v == got[2].h == 0.0
    assert got[3].v is None and got[3].h is None
    with pytest.raises(ValueError, match="unknown distance"):
        distance_km("taxi", "a", "b", "c", "d")


def test_distance_is_symmetric():
    rng = np.random.default_rng(3)
    a, b = rng.uniform(-60, 60, (2, 500)), rng.uniform(-80, 80, (2, 500))
    there, back = inverse_km(a[0], b[0], a[1], b[1]), inverse_km(a[1], b[1], a[0], b[0])
    assert np.allclose(there, back, rtol=1e-11)


def test_attach_equals_join(spark):
    rows = spark.range(1000).select(F.col("id"), F.when(F.col("id") < 700, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    dim = spark.createDataFrame([("hot", 1), ("800", 2)], "k string, v int")
    got = {tuple(r) for r in attach(rows, dim, ["k"], F.col("id"), parts=8).select("id", "k", "v").collect()}
    assert got == {tuple(r) for r in rows.join(dim, "k", "left").select("id", "k", "v").collect()}


def sign_lists(props, near, k):
    lists = {}
    for i, (pid, zone, bands) in enumerate(props):
        scored = []
        for qid, other, theirs in props:
            hits = sum(x == y for x, y in zip(bands, theirs))
            if qid != pid and hits and other in near[zone]:
                scored.append((-hits, qid))
        lists[pid] = [(q, -h) for h, q in sorted(scored)[:k]]
    return {p: v for p, v in lists.items() if v}


@pytest.mark.parametrize("first,hot,values,seed", [(240, 4096, 4, 5), (6, 5, 4, 6), (3, 20, 60, 7), (6, 2, 300, 8)])
def test_sign_neighbours_with_hot_buckets(spark, first, hot, values, seed):
    """Bucket limit 3, one band value shared by most rows, exact copies, and from many to hardly any agreeing bands."""
    rng = random.Random(seed)
    props = []
    for i in range(150):
        if props and rng.random() < 0.3:
            props.append((i, *rng.choice(props[:4])[1:]))
        else:
            bands = [0 if rng.random() < (0.6 if values < 10 or band == 2 else 0.05) else rng.randrange(1, values) for band in range(5)]
            props.append((i, rng.choice("ab") if rng.random() < 0.8 else "c", bands))
    edges = pool_edges(adjacency(spark.createDataFrame([("a", "b"), ("b", "c")], "a string, b string"))).persist()
    near = {}
    for e in edges.collect():
        near.setdefault(e.zone, set()).add(e.neighbour)
    df = spark.createDataFrame(props, "prop_id bigint, zone string, bands array<bigint>")
    got = {}
    for r in sign_neighbours(df, edges, k=6, chunk=3, with_hits=True, first=first, hot=hot).orderBy("search_prop", "sim_rank").collect():
        got.setdefault(r.search_prop, []).append((r.sim_prop, r.band_hits))
    assert got == sign_lists(props, near, 6)


def test_signatures(spark):
    assert hyperplanes(4, 6)[3, 5] == pytest.approx(4159922290 / 4294967296 - 0.5)
    with pytest.raises(ValueError, match="rows per band"):
        signer(4, 64, 1)
    m = spark.createDataFrame([(1, "z", 30.0, None)], "prop_id bigint, zone string, lat double, beds double")
    vector = property_vector(m)
    v = vector.first().vector
    assert len(v) == 36 and v[0] == 30.0 and set(v[1:]) == {-1.0}
    bands = sign_bands(vector, 36).first().bands
    assert len(bands) == 100
    bits = np.array(v) @ hyperplanes(36, 5000) > 0
    assert bands[0] == sum(1 << i for i in range(50) if bits[i])


def test_documents_and_lookups(spark):
    m = spark.createDataFrame(
        [(1, "a st", "x", 30.0, -97.0, 2.9, None), (2, "b st", "y", None, None, float("nan"), 1e300), (3, "1.5 (A) St", "z", 1.0, 2.0, None, None)],
        "prop_id bigint, address string, geo_address string, lat double, lon double, beds double, appraised_val double",
    )
    hist = spark.createDataFrame([(1, 10.0)], "prop_id bigint, appraisal_2015 double")
    scores = spark.createDataFrame(
        [(1, 2, 1, "euclidean"), (1, 3, 2, "euclidean"), (1, 9, 2, "euclidean"), (2, 1, 1, "euclidean"), (1, 3, 1, "lsh")],
        "search_prop bigint, sim_prop bigint, sim_rank int, metric string",
    )
    docs = publish_documents(m, hist, scores).persist()
    got = {r["_id"]: r for r in docs.collect()}
    assert got[1].address == "A ST" and got[1].beds == 2 and got[1].appraisal == 0 and got[1].appraisal_2015 == 10
    assert got[2].Lat == 30.2672 and got[2].Long is None and got[2].appraisal == 0 and got[2].beds == 0 and got[2].appraisal_2015 == 0
    assert [tuple(e) for e in got[1].similar] == [(2, 1), (3, 2)] and got[3].similar == []
    assert [r["_id"] for r in lookup.by_id(docs, "2").collect()] == [2]
    assert lookup.by_id(docs, "x").count() == 0
    assert [r["_id"] for r in lookup.by_address(docs, "a St").collect()] == [1]
    assert [r["_id"] for r in lookup.containing(docs, "(a) s").collect()] == [3]  # literal, not a pattern
    assert {r["_id"] for r in lookup.by_ids(docs, [1, 3]).collect()} == {1, 3}
    view = lookup.neighbour_view(docs, docs.where("_id = 1"), columns=("rank", "address"))
    assert [(r["_id"], r["rank"]) for r in view.collect()] == [(1, 0), (2, 1), (3, 2)]
    assert neighbour_list(scores, "euclidean").count() == 2 and neighbour_list(scores, "lsh").first().similar == [(3, 1)]
    twice = spark.createDataFrame([(1, 1.0), (1, 2.0)], "_id bigint, v double")
    with pytest.raises(Exception, match="duplicate _id"):
        require_single(twice, "_id").collect()


def test_random_baseline(spark):
    ids = spark.range(0, 300, 3).withColumnRenamed("id", "prop_id")
    assert [r.at for r in numbered(ids).orderBy("prop_id").collect()] == list(range(100))
    got = random_baseline(ids).collect()
    assert set(Counter(r.search_prop for r in got).values()) == {20}
    one = sorted((r.sim_rank, r.sim_score) for r in got if r.search_prop == 3)
    assert all(b[1] == pytest.approx(a[1] * 0.9) for a, b in zip(one, one[1:]))


def test_incremental_runs_resume(spark, tmp_path):
    edges = pool_edges(adjacency(spark.createDataFrame(ZONE_PAIRS, "a string, b string")))
    m, out = matrix(spark), str(tmp_path / "scores")
    append_pending(m, edges, out, zones=["78702"])
    first = spark.read.parquet(out).count()
    assert {r.prop_id for r in ledger(spark, out).collect()} == {3} and first == 6
    append_pending(m, edges, out, zones=["78702"])
    assert spark.read.parquet(out).count() == first
    with pytest.raises(ValueError, match="not in the adjacency map"):
        append_pending(m, edges, out, zones=["1"])
    drop = tmp_path / "asked"
    spark.createDataFrame([(3,), (6,)], "prop_id bigint").coalesce(1).write.parquet(str(drop))
    asked = spark.readStream.schema("prop_id bigint").parquet(str(drop))
    follow_requests(asked, m, edges, out, str(tmp_path / "checkpoint")).awaitTermination()
    assert {r.prop_id for r in ledger(spark, out).collect()} == {3, 6}
    got = spark.read.parquet(out)
    assert got.count() == 6 + 8 and got.distinct().count() == 14


def test_ledger_knows_the_metric(spark, tmp_path):
    edges = pool_edges(adjacency(spark.createDataFrame(ZONE_PAIRS, "a string, b string")))
    m, out = matrix(spark), str(tmp_path / "scores")
    for metrics in (("euclidean",), ("manhattan",), ("euclidean", "manhattan")):
        append_pending(m, edges, out, zones=["78702"], metrics=metrics)
    assert Counter(r.metric for r in spark.read.parquet(out).collect()) == {"euclidean": 3, "manhattan": 3}


def test_staged_tables_can_be_removed(spark):
    with temporary_staging(spark):
        path = staged(spark.range(3), "short-lived").inputFiles()[0]
        assert Path(path.removeprefix("file://")).exists()
    assert not Path(path.removeprefix("file://")).parent.exists()


@pytest.mark.parametrize("seed", range(6))
def test_flag_ranges_equal_brute_force(seed):
    rng = random.Random(seed)
    bits, hoods = 5, ["A", "B", None] if seed % 2 else ["A", None]
    props = [(rng.randrange(32) if seed < 4 else 7, rng.choice(hoods)) for _ in range(rng.choice([1, 2, 3, 12]))]
    codes = pd.DataFrame(props, columns=["c_bits", "hood"])
    masks = codes.groupby("c_bits").agg(n=("hood", "size"), unknown=("hood", lambda h: h.isna().sum()), hood_lo=("hood", lambda h: h.dropna().min()), hood_hi=("hood", lambda h: h.dropna().max())).reset_index()
    found = flags.over_zone(masks, pd.DataFrame({"flag_bits": range(32)}), bits).set_index("flag_bits")
    none = lambda x: None if pd.isna(x) else int(x)
    for mask in range(32):
        row = found.loc[mask]
        for hood in ("A", "B", "Z"):
            apart = [(mask ^ m).bit_count() for m, h in props if h != hood]
            for end, pick in (("low", min), ("high", max)):
                got = row[f"{end}_2"] if row[f"{end}_hood"] == hood else row[f"{end}_1"]
                assert none(got) == (pick(apart) if apart else None)
        mine = [m for m, _ in props]
        if mask in mine:
            mine.remove(mask)
        apart = [(mask ^ m).bit_count() for m in mine]
        assert (none(row["alone_low"]), none(row["alone_high"])) == ((min(apart), max(apart)) if apart else (None, None))
    counts = Counter(m for m, _ in props)
    inside = pd.DataFrame({"c_bits": list(counts), "n": list(counts.values())})
    asked = pd.DataFrame({"flag_bits": [*range(32)] * 2, "own": [True] * 32 + [False] * 32})
    for limit in (flags.PAIRS, 0):
        old, flags.PAIRS = flags.PAIRS, limit
        try:
            ends = flags.over_hood(inside, asked, bits)
        finally:
            flags.PAIRS = old
        for _, row in ends.iterrows():
            mine = [m for m, _ in props]
            if row["own"] and row["flag_bits"] in mine:
                mine.remove(row["flag_bits"])
            apart = [(row["flag_bits"] ^ m).bit_count() for m in mine]
            assert (none(row["low"]), none(row["high"])) == ((min(apart), max(apart)) if apart else (None, None))


def test_staging_folder_comes_from_the_session(spark):
    assert staging_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
