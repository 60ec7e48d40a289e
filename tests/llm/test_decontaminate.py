import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelmatch.llm import decontaminate as d

from .conftest import DOCS

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, window):
    """Hit word places and the items that have a window in the text."""
    doc, hit, found = words(text), set(), set()
    for item, item_text in items:
        w = words(item_text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1) if n else ():
            for j in range(len(doc) - n + 1):
                if doc[j : j + n] == w[i : i + n]:
                    hit |= set(range(j, j + n))
                    found.add(item)
    return hit, found


def test_words_are_those_of_the_pattern():
    text = "Aé-Ö_9 x\x00y\x7fz`{|} ÀB 漢字、a"
    assert [w.decode() for w in d.words_of(text)] == words(text)


letters = st.lists(st.sampled_from("abc"), max_size=14)


@settings(max_examples=300, deadline=None)
@given(st.lists(letters, max_size=5), st.lists(st.sampled_from("abcd"), max_size=40), st.integers(1, 5))
def test_automaton_finds_what_brute_force_finds(items, doc, window):
    pieces = [(str(k), [w.encode() for w in item], len(item) < window) for k, item in enumerate(items) if item]
    spans, found = d.automaton(pieces, window).scan([w.encode() for w in doc])
    hit, ids = brute(" ".join(doc), [(str(k), " ".join(item)) for k, item in enumerate(items)], window)
    assert {i for a, b in spans for i in range(a, b)} == hit
    assert found == ids
    assert all(x[1] < y[0] or x[1] <= y[0] for x, y in zip(spans, spans[1:]))


def sample(spark, documents):
    draw = random.Random(3)
    vocabulary = [f"w{i}" for i in range(30)]
    items = [(k, " ".join(draw.choices(vocabulary, k=draw.choice((0, 3, 9, 10, 25))))) for k in range(12)] + [(12, None), (3, "two words"), (None, "lost item")]
    docs = []
    for k in range(60):
        parts = [" ".join(draw.choices(vocabulary, k=30))]
        if k % 3 == 0:
            parts.append(items[draw.randrange(12)][1].upper())
        docs.append((k, ". ".join(parts)))
    return documents([*docs, (60, None), (61, ""), (7, "two WORDS, two words")]), docs, spark.createDataFrame(items, "item_id bigint, text string"), items


def test_contamination_equals_brute_force(spark, documents):
    docs, _, benchmark, items = sample(spark, documents)
    for block in (d.BLOCK_WORDS, 40):
        found = d.find_windows(docs.select("doc_id", "text"), benchmark, block_words=block).collect()
        for row in found:
            hit, ids = brute(row["text"], [("" if k is None else str(k), t) for k, t in items], 10)
            assert {i for s in row["spans"] for i in range(s["start"], s["end"])} == hit
            assert row["items"] == sorted(ids)
    for row in d.contamination(docs, benchmark).collect():
        text = next(r["text"] for r in found if r["doc_id"] == row["doc_id"] and r["n_words"] == row["n_words"] and bool(r["spans"]) == row["contaminated"])
        hit, ids = brute(text, [("" if k is None else str(k), t) for k, t in items], 10)
        assert (row["n_hit"], row["n_items"], row["contaminated"]) == (len(hit), len(ids), bool(hit))
        assert row["items_sha256"] == hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()


def test_cut_documents_have_no_window_left(spark, documents):
    item = " ".join(f"x{i}" for i in range(24))
    halves = item.split()
    clean = " ".join(f"c{i}" for i in range(40))
    nested = f"{clean} {' '.join(halves[:12])} {item} {' '.join(halves[12:])} {clean}"
    docs = documents([(1, f"{clean} {item} {clean}"), (2, clean), (3, item), (4, nested), (5, None), (6, f"{clean} {item} {clean}")])
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    out = d.decontaminate(docs, items)
    assert out.columns == docs.columns
    kept = {r["doc_id"]: r for r in out.collect()}
    assert set(kept) == {1, 2, 4, 5, 6}
    assert kept[2]["text"] == clean and kept[5]["text"] is None
    assert words(kept[1]["text"]) == words(f"{clean} {clean}")
    for row in kept.values():
        assert not brute(row["text"], [("1", item)], 10)[0]
        assert row["n_chars"] == (None if row["text"] is None else len(row["text"]))
    several = spark.createDataFrame([(k, " ".join(halves[k : k + 11])) for k in range(14)], "item_id bigint, text string")
    before, d.BLOCK_WORDS = d.BLOCK_WORDS, 25
    try:
        again = {r["doc_id"]: r["text"] for r in d.decontaminate(docs, several).collect()}
    finally:
        d.BLOCK_WORDS = before
    assert again == {k: r["text"] for k, r in kept.items()}


def test_odd_rows_and_empty_tables(spark, odd):
    items = spark.createDataFrame([(1, "the quick brown fox and the quick brown fox and")], "item_id bigint, text string")
    rows = d.contamination(odd, items).collect()
    assert len(rows) == odd.count()
    assert {r["doc_id"]: (r["n_words"], r["n_hit"]) for r in rows}[4] == (100_000, 100_000)
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert not any(r["contaminated"] for r in d.contamination(odd, none).collect())
    assert d.decontaminate(odd, none).count() == odd.count()
    assert d.contamination(spark.createDataFrame([], DOCS), items).count() == 0
    clashing = odd.selectExpr("*", "'own' AS spans", "7 AS n_words", "'i' AS items", "1 AS `_spans`")
    out = d.decontaminate(clashing, items)
    assert out.columns == clashing.columns
    assert {(r["spans"], r["n_words"], r["items"], r["_spans"]) for r in out.collect()} == {("own", 7, "i", 1)}


def test_a_cut_of_a_middle_block_is_scanned_again_by_the_first(spark, documents, monkeypatch):
    monkeypatch.setattr(d, "BLOCK_WORDS", 3)
    items = spark.createDataFrame([(1, "a b c"), (2, "p q r"), (3, "x y z")], "item_id bigint, text string").coalesce(1)
    assert len([*d._blocks(items, 3, 3)]) == 3
    docs = documents([(1, "one a b p x y z q r c two"), (2, "nothing here")])
    left = {r["doc_id"]: words(r["text"]) for r in d.decontaminate(docs, items, 3, 3, 1.0).collect()}
    assert left == {1: ["one", "two"], 2: ["nothing", "here"]}


def test_columns_that_clash_in_other_case_stay(spark, documents):
    docs = documents([(1, "some clean words")]).selectExpr("*", "'a' AS Spans", "'b' AS ITEMS", "7L AS N_words")
    items = spark.createDataFrame([(1, "a b c d e f g h i j k l")], "item_id bigint, text string")
    out = d.decontaminate(docs, items)
    assert out.columns == docs.columns and tuple(out.first())[-3:] == ("a", "b", 7)


@pytest.mark.parametrize("block_words", [1 << 30, 20])
def test_a_task_runs_one_python_step(spark, documents, monkeypatch, block_words):
    """Every Python step of a task has a worker of its own, which stays and holds memory in all that follows."""
    monkeypatch.setattr(d, "BLOCK_WORDS", block_words)
    passages = [" ".join(f"{c}{i}c" for i in range(60)).replace("0", "x") for c in "vw"]
    docs = documents([(1, f"{'a ' * 180}{passages[0]} {'b ' * 180}{passages[1]}"), (2, "clean text"), (3, None)])
    out = d.decontaminate(docs, spark.createDataFrame([*enumerate(passages)], "item_id bigint, text string"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") <= 1
    assert {r["doc_id"]: r["text"] and r["text"].split() for r in out.collect()} == {1: ["a"] * 180 + ["b"] * 180, 2: ["clean", "text"], 3: None}
