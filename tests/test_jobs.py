import json
import random

from parcelmatch.plans.jobs import EXTRACT, build_documents
from parcelmatch.session import staging_root
from parcelmatch.sources.tables import read_lookup_table

WIDTH = 24


def extract(folder, rows):
    folder.mkdir()
    header = {}
    for name, columns in EXTRACT.items():
        names = [*columns, "prop_val_yr"] if name == "PROP.TXT" else list(columns)
        header[name] = {"names": names, "lengths": [WIDTH] * len(names)}
        lines = ["".join(str(r.get(c, "")).ljust(WIDTH) for c in names) for r in rows[name]]
        (folder / name).write_text("\n".join(lines) + "\n")
    (folder / "headers.json").write_text(json.dumps(header))


def test_raw_folders_become_documents(spark, tmp_path):
    draw = random.Random(4)
    ids = range(1, 31)
    for year in (2017, 2018):
        roll = [{
            "prop_id": i, "prop_type_cd": "R", "geo_id": f"G{i}", "py_addr_ml_deliverable": "Y", "hood_cd": f"H{i % 3}", "appraised_val": 1000 * i + year,
            "situs_num": i, "situs_zip": f"7870{1 + i % 2}", "imprv_state_cd": "A1", "prop_val_yr": year,
        } for i in ids]
        extract(tmp_path / str(year), {
            "PROP.TXT": [*roll, {**roll[0], "hood_cd": "LATER", "appraised_val": 1}],
            "IMP_DET.TXT": [{"prop_id": i, "Imprv_det_type_desc": "1st Floor", "yr_built": 1950 + i, "imprv_det_area": draw.choice([900, "NaN", "12d", 1500])} for i in ids],
            "LAND_DET.TXT": [{"prop_id": i, "land_type_desc": "Land", "ag_apply": "F", "size_square_feet": 5000 + i} for i in ids],
            "MOBILE_HOME_INFO.TXT": [{"prop_id": 3}], "STATE_CD.TXT": [{"state_cd": "A1", "ptd_state_cd_description": "Single Family"}],
        })
    (tmp_path / "listings").mkdir()
    (tmp_path / "listings" / "output-1.json").write_text(json.dumps([{"id": str(i), "address": f"{i} Oak St", "zestimate": "$100,000", "beds": ["3"]} for i in range(1, 11)]))
    lines = [f"{i},{i} Oak St,Austin,TX,30.{i:02d},-97.{i:02d},G{i}" for i in ids]
    (tmp_path / "geo.csv").write_text("prop_id,Address,City,State,Lat,Long,geo_id\n" + "\n".join([*lines, "1,Elsewhere,X,TX,0,0,G0"]) + "\n")
    (tmp_path / "zips.csv").write_text("78701,78702\n")
    out = tmp_path / "out"
    before = set(_staged(spark))
    build_documents(
        spark, str(tmp_path / "2018"), str(tmp_path / "listings"), str(tmp_path / "geo.csv"), str(tmp_path / "zips.csv"), str(out),
        [str(tmp_path / "2017"), str(tmp_path / "2018")],
    )
    assert set(_staged(spark)) == before
    scores = spark.read.parquet(str(out / "scores")).groupBy("metric").count().collect()
    assert {r["metric"]: r["count"] for r in scores if r["metric"] != "lsh"} == {"euclidean": 600, "manhattan": 600}
    docs = {(r["metric"], r["_id"]): r for r in spark.read.json(str(out / "documents")).collect()}
    assert {m for m, _ in docs} == {"euclidean", "manhattan", "lsh"} and len(docs) == 90
    one = docs["euclidean", 1]
    assert (one["hood_cd"], one["appraisal"], one["appraisal_2017"], one["appraisal_2018"], one["geo_address"], one["zillow"]) == ("H1", 3018, 3017, 3018, "1 OAK ST", 1)
    assert [e["rank"] for e in one["similar"]] == list(range(1, 21)) and docs["euclidean", 3]["is_mobile"] == 1
    assert read_lookup_table(spark, str(out / "lookup"), "address").where("address = '7 OAK ST'").count() == 1


def _staged(spark):
    from pathlib import Path

    folder = Path(staging_root(spark)) / spark.sparkContext.applicationId
    return [p.name for p in folder.iterdir()] if folder.exists() else []
