import random
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from parcelmatch.llm import secrets, simhash

from .conftest import DOCS
from .test_decontaminate import brute
from .test_simhash import close, roots


@pytest.fixture(scope="module")
def folder(spark, documents, tmp_path_factory):
    """Documents with toxic ones, copies, a benchmark passage and a secret, among clean ones."""
    draw = random.Random(8)
    words = [a + b + c for a in ("ti", "on", "re", "ha") for b in ("th", "ou", "an") for c in ("le", "er", "is", "on")]
    passage = " ".join(f"bench{i}" for i in range(30))
    rows = []
    for i in range(400):
        text = draw.choices(words, k=120)
        if i % 4 == 0:
            text[::15] = draw.choices(["idiot", "moron", "scum"], k=8)
        rows.append((i, " ".join(text)))
    clean = [t for i, t in rows if i % 4]
    rows += [(400 + k, t) for k, t in enumerate(clean[:5])]
    rows += [(410, f"{clean[7]} {passage} {clean[8]}"), (411, passage), (412, f'{clean[9]} token = "{"0a" * 20}" {clean[10]}')]
    path = tmp_path_factory.mktemp("tables")
    documents([*rows, (500, None), (501, "")]).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)], "doc_id bigint, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path), dict(rows), passage


def test_stages_keep_columns_and_take_effect(spark, folder):
    path, rows, passage = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.schema.simpleString() == spark.createDataFrame([], DOCS).schema.simpleString()
        docs = spark.createDataFrame(out.collect(), out.schema)
        seen[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    toxic = seen["toxicity"]
    assert all((i in toxic) == bool(i % 4) for i in range(400))
    prints = {i: simhash.fingerprint(t or "") & (1 << 64) - 1 for i, t in toxic.items()}
    root = roots(sorted(set(prints.values())), close(sorted(set(prints.values()))))
    heads = {}
    for i in sorted(prints):
        heads.setdefault(root[prints[i]], i)
    assert set(seen["simhash_near_dedup"]) == set(heads.values())
    cut = seen["decontamination"]
    assert 411 not in cut and not any(brute(t, [("1", passage)], 10)[0] for t in cut.values())
    assert all(cut[i] == t for i, t in seen["simhash_near_dedup"].items() if i in cut and i != 410)
    hidden = seen["secret_scan"]
    assert set(hidden) == set(cut) and not any(secrets.base_spans(t or "") for t in hidden.values())
    assert Counter(hidden[i] == t for i, t in cut.items())[False] == 1
    assert seen["byte_bpe"] == hidden and all(r["decoded"] == (r["text"] or "") for r in docs.collect())


def test_registered_pipeline_is_the_stages(spark, folder):
    path, _, _ = folder
    got = entry.queries()["pipeline"](spark, path)
    assert {"doc_id", "text", "lang", "source", "n_chars", "token_ids"} <= set(got.columns)
    assert got.count() == len({r["doc_id"] for r in got.collect()}) > 250
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in entry.queries() if q.startswith("op")}
