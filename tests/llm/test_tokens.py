import base64
import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from parcelmatch.llm import bpe, huffman
from parcelmatch.llm.queries import GENERAL, GENERAL_IDS, MULTI

from .conftest import DOCS


def sha(data):
    return hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def ranked():
    with open(MULTI, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    spec = bpe.ranks_spec(MULTI, public_tokenizers.PATTERN)
    return reference, spec, bpe.Coder(spec)


@pytest.fixture(scope="module")
def general():
    library = Tokenizer.from_file(GENERAL)
    library.encode_special_tokens = True
    return library, bpe.Coder(bpe.file_spec(GENERAL))


texts = st.text(st.one_of(st.sampled_from(" \n\t\r'sdtrelmvo aA0é漢💥 \u0085 \x1ć²Ⅷ<|>"), st.characters(exclude_categories=["Cs"])), max_size=60)


@settings(max_examples=400, deadline=None)
@given(texts)
def test_ids_equal_the_rank_library(ranked, text):
    reference, _, coder = ranked
    ids = next(coder.encode([text])).tolist()
    assert ids == reference.encode_ordinary(text)
    assert coder.decode(ids) == text.encode()


@settings(max_examples=400, deadline=None)
@given(texts)
def test_chunks_do_not_change_ids(general, text):
    library, coder = general
    assert next(coder.encode([text])).tolist() == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aabéà'sd0,.×\n"), min_size=1, max_size=8), min_size=1, max_size=60))
def test_many_new_words_at_once(general, ranked, words):
    library, coder = general
    text = " ".join(words)
    for one in (coder, ranked[2]):
        one._forget()
    assert next(coder.encode([text])).tolist() == library.encode(text, add_special_tokens=False).ids
    assert next(ranked[2].encode([text])).tolist() == ranked[0].encode_ordinary(text)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\t\r'strevlmd1²éÀ!?«×ɏ"), max_size=30), max_size=5))
def test_matches_of_plain_texts(texts):
    letter, digit = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe"
    pattern = f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{digit}]+| ?[^\\t\\n\\r {letter}{digit}]+|[\\t\\n\\r ]+(?![^\\t\\n\\r ])|[\\t\\n\\r ]+"
    raw = "".join(texts).encode()
    first = np.cumsum([0, *(len(t.encode()) for t in texts)])
    cut = bpe.matches(np.frombuffer(raw, np.uint8), first).tolist()
    assert [raw[a:b].decode() for a, b in zip(cut, cut[1:])] == [m for t in texts for m in re.findall(pattern, t)]


def test_each_match_is_encoded_once_whatever_stands_beside_it():
    coder = bpe.Coder(bpe.file_spec(GENERAL))
    text = "word word, word. (word  word\n\n word!"
    want = coder.library.encode(text, add_special_tokens=False).ids

    class Library:
        model = coder.library.model

        def encode_batch_fast(self, texts, add_special_tokens):
            assert not texts  # a plain text is cut here, even with blanks in a row
            return []

    coder.library = Library()
    assert next(coder.encode([text])).tolist() == want
    assert sorted(coder.known) == sorted({b"word", b" word", b",", b".", b" (", b" ", b"\n\n", b"!"})


def test_tokens_over_a_blank_do_not_join_words(tmp_path):
    tokens = [bytes([b]) for b in range(256)] + [b" a", b"b ", b"b a", b"ab"]
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens)))
    spec = bpe.ranks_spec(str(path), public_tokenizers.PATTERN)
    coder, library = bpe.Coder(spec), Tokenizer.from_str(spec)
    assert coder.together == 1
    text = "ab ab cb ac b a bb aa"
    assert next(coder.encode([text])).tolist() == library.encode(text, add_special_tokens=False).ids


def test_special_strings_long_words_and_many_texts(general, ranked):
    for reference, coder in ((lambda t: general[0].encode(t, add_special_tokens=False).ids, general[1]), (ranked[0].encode_ordinary, ranked[2])):
        many = ["<|endoftext|> it's  a\n\n b ", "a" * 5000, "", "x " * 3000, "don't\tdo\r\n it   ", "mañana über 12 345"] * 3
        assert [ids.tolist() for ids in coder.encode(many)] == [reference(t) for t in many]


def test_round_trip_of_odd_rows(spark, odd, ranked):
    reference, spec, _ = ranked
    texts = {(r["doc_id"], r["text"] or "") for r in odd.collect()}
    want = sorted(((i is None, i or 0, len(ids := reference.encode_ordinary(t)), sha(",".join(map(str, ids)).encode()), sha(t.encode())) for i, t in texts))
    got = sorted({(r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.round_trip(odd, spec).collect()})
    assert got == want
    assert bpe.round_trip(odd, spec).count() == odd.count()
    assert bpe.round_trip(spark.createDataFrame([], DOCS), spec).count() == 0


def test_decoding_in_the_same_pass(odd, ranked):
    rows = bpe.encode(odd, ranked[1], decoded=True)
    for row in bpe.decode(rows, ranked[1], name="apart").collect():
        assert row["decoded"] == row["apart"] == (row["text"] or "")


def test_offsets_and_split_characters(documents, ranked):
    _, spec, _ = ranked
    rows = documents([(1, "a💥b"), (2, None)]).selectExpr("*", "5 AS n_tokens")
    out = bpe.decode(bpe.encode(rows, spec, offsets=True), spec)
    one, two = sorted(out.collect(), key=lambda r: r["doc_id"])
    assert one["n_tokens"] == 5 and one["n_tokens_"] == len(one["token_ids"]) == len(one["starts"])
    assert one["decoded"] == "a💥b" and two["decoded"] == "" and two["token_ids"] == []
    assert (one["starts"][0], one["ends"][-1]) == (0, 3)
    assert any((a, b) == (1, 2) for a, b in zip(one["starts"], one["ends"]))


# Huffman -------------------------------------------------------------------------------------

def plain_huffman(counts):
    heap = [(int(c), 0) for c in counts if c]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        total += a[0] + b[0]
        heapq.heappush(heap, (a[0] + b[0], 0))
    return total


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=2, max_size=60))
def test_code_lengths_are_optimal_and_complete(counts):
    counts = np.array(counts)
    lengths = huffman.code_lengths(counts, 25)
    used = lengths[counts > 0]
    assert (lengths[counts == 0] == 0).all()
    if len(used) > 1:
        assert (2.0 ** -used).sum() == 1
        assert int((counts * lengths).sum()) == plain_huffman(counts)
        short = huffman.code_lengths(counts, 6)
        assert short.max() <= 6 and (2.0 ** -short[short > 0]).sum() == 1
        assert (counts * short).sum() >= (counts * lengths).sum()


def test_limited_lengths_are_optimal_by_brute_force():
    counts = np.array([1, 2, 4, 8, 16, 32])
    best = min(
        sum(int(c) * n for c, n in zip(counts, lengths))
        for lengths in np.ndindex(*(4,) * 6) if all(lengths) and sum(2.0 ** -n for n in lengths) <= 1
    )
    assert int((counts * huffman.code_lengths(counts, 3)).sum()) == best
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(9), 3)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 1500), min_size=1, max_size=6), st.integers(0, 5))
def test_segments_come_back(sizes, seed):
    draw = np.random.default_rng(seed)
    ids = np.minimum(draw.geometric(0.02, sum(sizes)), 400) if seed else np.full(sum(sizes), 7)
    lengths = huffman.code_lengths(np.bincount(ids, minlength=500))
    payload, offsets, marks = huffman.pack(ids, np.array(sizes), lengths, huffman.canonical(lengths))
    data = huffman.segment(sizes, marks, [payload[a:b] for a, b in zip(offsets, offsets[1:])])
    counts, back = huffman.read_segment(data, *huffman.decoding_table(lengths))
    assert counts.tolist() == sizes and back.tolist() == ids.tolist()
    with pytest.raises(ValueError):
        huffman.read_segment(data[:-1], *huffman.decoding_table(lengths))


def test_token_file_of_documents(spark, documents, odd, general, tmp_path):
    library, _ = general
    draw = random.Random(1)
    rows = [(i, " ".join(draw.choices(["alpha", "béta", "gamma,", "\n"], k=draw.randrange(3000)))) for i in draw.sample(range(1000), 40)]
    huffman.write_token_file(documents([*rows, (5000, None)]), str(tmp_path / "a"), bpe.file_spec(GENERAL), GENERAL_IDS)
    got = sorted(tuple(r) for r in huffman.read_token_file(spark, str(tmp_path / "a"), GENERAL_IDS, with_ids=True).collect())
    at = 0
    for (doc_id, start, n, crc, found), (want_id, text) in zip(got, [*sorted(rows), (5000, "")], strict=True):
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        assert (doc_id, start, n, found) == (want_id, at, len(ids), ids)
        assert crc == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += n


def test_token_file_of_odd_rows(spark, odd, documents, tmp_path):
    huffman.write_token_file(odd, str(tmp_path / "odd"), bpe.file_spec(GENERAL), GENERAL_IDS)
    rows = sorted(huffman.read_token_file(spark, str(tmp_path / "odd"), GENERAL_IDS).collect(), key=lambda r: r["start"])
    assert [r["start"] for r in rows] == [sum(x["n_tokens"] for x in rows[:k]) for k in range(len(rows))]
    assert [-1 if r["doc_id"] is None else r["doc_id"] for r in rows] == sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in odd.collect())
    huffman.write_token_file(spark.createDataFrame([], DOCS), str(tmp_path / "none"), bpe.file_spec(GENERAL), GENERAL_IDS)
    assert huffman.read_token_file(spark, str(tmp_path / "none"), GENERAL_IDS).count() == 0
    hot = documents([(3, f"copy {i % 50}") for i in range(400)])
    huffman.write_token_file(hot, str(tmp_path / "hot"), bpe.file_spec(GENERAL), GENERAL_IDS)
    parts = spark.read.parquet(str(tmp_path / "hot/segments")).select("part").distinct().count()
    assert parts > 1 and huffman.read_token_file(spark, str(tmp_path / "hot"), GENERAL_IDS).count() == 400
