import hashlib
import random
import re

import pytest

from parcelmatch.llm import infill

from .conftest import rows_of

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def brute(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    seen = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(seen[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def made(seed, pieces=("a", "bc", "é", "\n", "💥", "<P", ">", "<", " ", "x" * 300)):
    draw = random.Random(seed)
    return "".join(draw.choice(pieces) for _ in range(draw.randint(0, 60)))


@pytest.mark.parametrize("size", [1, 2, 7, 64, 1024])
def test_cuts_at_every_unit(size):
    for seed in range(60):
        text = made(seed)
        units, layout = UNIT.findall(text), infill.Layout(text.encode(), size)
        assert (layout.units, layout.code_points) == (len(units), len(text))
        for k in range(len(units) + 2):
            before = "".join(units[:k])
            assert layout.cut(k) == (len(before.encode()), len(before))


def test_fenwick_tree_finds_blocks_with_empty_ones_between():
    import numpy as np

    pairs = np.array([[0, 3], [2, 2], [0, 1], [0, 0], [5, 9], [1, 1]])
    tree = infill.Counts(pairs)
    assert [tree.find(k) for k in range(8)] == [(1, 0, 3)] * 2 + [(4, 2, 6)] * 5 + [(5, 7, 15)]


def test_equals_brute_force(documents):
    texts = [(k, made(k)) for k in range(300)] + [(900, "has <S> inside"), (901, None), (902, ""), (903, "word"), (903, "word"), (None, "no id at all")]
    done = infill.restored(infill.fill_in_middle(documents(texts)))
    got = rows_of(done, "doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored")
    assert got == sorted(((i, *brute(i, t), t or "") for i, t in texts), key=repr)
    assert {"plain", "spm", "psm"} == {r[2] for r in got}


def test_odd_rows_and_digests(odd):
    got = infill.digest(odd).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = [(r["doc_id"], *brute(r["doc_id"], r["text"]), r["text"] or "") for r in odd.collect()]
    assert sorted(map(repr, [tuple(r) for r in got])) == sorted(repr((*w[:5], sha(w[5]), sha(w[6]))) for w in want)
    assert infill.digest(odd.limit(0)).count() == 0


def test_clashing_names_stay(spark):
    docs = spark.createDataFrame([(1, "some words here", "kept", 7)], "doc_id int, text string, Output string, n int")
    row = infill.fill_in_middle(docs).first()
    assert (row["Output"], row["n"], row["n_"], row["output_"]) == ("kept", 7, 5, brute(1, "some words here")[4])
    again = infill.restored(infill.fill_in_middle(docs), "output_", "form").first()
    assert again["restored"] == "some words here"
