"""Byte-level BPE with the tokenizers library over Arrow batches, and back to text.

Every byte stands for one printable character; the vocabulary and the merges are over these
characters, and decoding reverses the table before the bytes are read as UTF-8, so a character
split between tokens comes back whole.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
import pickle
import re
from collections.abc import Iterator, Sequence
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import Step, fresh, in_batches, kept, share, texts_of

SPEC_BYTES = 64 << 20  # more is refused: a vocabulary is shared with every worker
CACHE = 600_000  # matches that a worker remembers
CACHED_BYTES = 64
TOGETHER = 256  # matches that the model cuts in one call
GROUP_CHARS = 1 << 20
#: Texts of these characters only, whose classes are the same in every edition of Unicode, may be cut before the library.
PLAIN = re.compile(r"[^\t\n\r\x20-\x7e\xa1-\u024f]")
_LETTER, _DIGIT = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe"
#: By code point: 0 blank, tabulator or line end, 1 letter, 2 digit, 3 any other.
KINDS = np.array([0 if c in "\t\n\r " else 1 if re.match(f"[{_LETTER}]", c) else 2 if re.match(f"[{_DIGIT}]", c) else 3 for c in map(chr, range(0x250))], np.uint8)


def byte_characters() -> dict[int, str]:
    """Byte to character: printable bytes stand for themselves, the others for 256, 257, ..."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in own)
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


def ranks_spec(path: str, pattern: str) -> str:
    """The tokenizer of a rank file (base64 token and rank per line), as the library's JSON.

    Ranks merge any two neighbours that make up a token, so every way to cut a token in two is a
    merge; a match of the pattern that is a token as a whole is not merged at all.
    """
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    table = byte_characters()

    def text(token: bytes) -> str:
        return "".join(table[b] for b in token)

    merges = [
        [text(t[:cut]), text(t[cut:])]
        for t in sorted(ranks, key=ranks.__getitem__) for cut in range(1, len(t)) if t[:cut] in ranks and t[cut:] in ranks
    ]
    split = {"type": "Split", "pattern": {"Regex": pattern}, "behavior": "Isolated", "invert": False}
    level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
    return json.dumps({
        "version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None,
        "pre_tokenizer": {"type": "Sequence", "pretokenizers": [split, level]}, "post_processor": None, "decoder": None,
        "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None,
                  "fuse_unk": False, "byte_fallback": False, "ignore_merges": True, "vocab": {text(t): r for t, r in ranks.items()}, "merges": merges},
    })


def file_spec(path: str) -> str:
    with open(path, encoding="utf-8") as spec:
        return spec.read()


def shared_spec(spark: SparkSession, spec: str):
    if len(spec) > SPEC_BYTES:
        raise ValueError(f"a tokenizer of {len(spec)} bytes is too large to share")
    return spark.sparkContext.broadcast(spec)


def token_bytes(vocabulary: dict[str, int]) -> list[bytes]:
    """The bytes of every token by its number, by the reversed byte table."""
    back = {c: b for b, c in byte_characters().items()}
    tokens = [b""] * (max(vocabulary.values(), default=-1) + 1)
    for token, number in vocabulary.items():
        tokens[number] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
    return tokens


def matches(raw: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the matches of the vocabularies' split pattern begin in plain texts one after the other, and the end.

    ``raw``: the texts' UTF-8 bytes; ``first``: where texts begin and the last one ends. A match is a run of letters, digits or
    other characters, with the blank before it, or a run of blanks without the last one that a run follows; or ``'s`` and the like.
    """
    kind = KINDS[raw]
    wide = np.flatnonzero(raw >= 0xC2)  # of two bytes
    kind[wide] = kind[wide + 1] = KINDS[(raw[wide].astype(np.int64) & 31) << 6 | raw[wide + 1] & 63]
    edge = np.zeros(len(raw) + 1, bool)
    edge[first] = True
    begin = edge.copy()
    begin[1:-1] |= kind[1:] != kind[:-1]
    behind = np.flatnonzero(begin[1:-1] & (kind[:-1] == 0) & ~edge[1:-1]) + 1  # runs behind blanks
    begin[behind - 1] = True
    begin[behind[raw[behind - 1] == 0x20]] = False
    tick = np.flatnonzero(raw == 0x27)
    tick = tick[begin[tick] & ~edge[tick + 1]]
    one, two = raw[tick + 1], np.where(edge[tick + 2], 0, raw[np.minimum(tick + 2, len(raw) - 1)])
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = np.isin(one.astype(np.int64) << 8 | two, [int.from_bytes(x) for x in (b"re", b"ve", b"ll")])
    begin[tick[short | long] + 1] = False
    begin[tick[short] + 2] = begin[tick[long] + 3] = True
    return np.flatnonzero(begin)


def joined(tokens: Sequence[bytes], ids: Sequence[int]) -> bytes:
    return b"".join([tokens[i] for i in ids])


def listed(values: pa.LargeBinaryArray) -> list[bytes]:
    """The values, none empty and none with a zero byte; much faster than ``to_pylist``."""
    if not len(values):
        return []
    ends = np.frombuffer(values.buffers()[1], np.int64, len(values) + 1)
    return np.insert(np.frombuffer(values.buffers()[2], np.uint8, ends[-1]), ends[1:-1], 0).tobytes().split(b"\0")


class Coder:
    """Encodes and decodes with one tokenizer; remembers the ids of the split pattern's matches.

    Plain texts are cut into the pattern's matches, and each distinct match is encoded once. Other
    texts go to the library as a whole.

    If no token that can occur in a plain text holds a blank after another character, the model cannot
    merge over the front of a blank, so it cuts many new matches in one call; the tokens' bytes tell
    where each ends.
    """

    def __init__(self, spec: str, cache: int = CACHE) -> None:
        self.cache = cache
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.library.encode_special_tokens = True  # their strings are ordinary text
        self.characters = str.maketrans({chr(b): c for b, c in byte_characters().items()})
        self.token = token_bytes(self.library.get_vocab(with_added_tokens=True))
        self.bytes = np.array([len(t) for t in self.token], np.int64)
        self.whole = {t: i for i, t in enumerate(self.token)} if getattr(self.library.model, "ignore_merges", False) else {}
        over = (t.decode("utf-8", "ignore") for t in self.token if re.search(rb"[^\t\n\r ] ", t))
        self.together = TOGETHER if all(PLAIN.search(t) for t in over) else 1
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}  # match -> its number
        self.again = np.zeros(0, bool)  # by number: met again after it was learned
        self.first = np.zeros(1, np.int64)  # by number: its ids are pool[first[number] : first[number + 1]]
        self.pool = np.zeros(0, np.int32)

    @staticmethod
    def of(spec: str, cache: int = CACHE) -> Coder:
        return kept((hashlib.sha256(spec.encode()).digest(), cache), lambda: Coder(spec, cache))

    def _remember(self, names: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        base = len(self.first) - 1
        self.known.update(zip(names, range(base, base + len(names))))
        self.first = np.concatenate([self.first, len(self.pool) + np.cumsum(sizes)])
        self.pool = np.concatenate([self.pool, ids])
        self.again = np.concatenate([self.again, np.zeros(len(names), bool)])

    def _make_room(self) -> None:
        """Forget the matches that were met once only; everything, if that is too little."""
        again = self.again.tolist()
        kept = [s for s, number in self.known.items() if again[number]]
        ids, sizes = self._ids(np.fromiter(map(self.known.__getitem__, kept), np.int64, len(kept)))
        self._forget()
        if len(kept) < self.cache // 2:
            self._remember(kept, ids, sizes)

    def _ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of remembered matches, one after the other, and how many each has."""
        start = self.first[numbers]
        sizes = self.first[numbers + 1] - start
        ends = np.cumsum(sizes)
        at = np.repeat(start - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self.pool[at], sizes

    def _cut(self, text: bytes) -> list[int]:
        return [t.id for t in self.library.model.tokenize(text.decode("latin-1").translate(self.characters))]

    def _learn(self, new: list[bytes]) -> None:
        whole = self.whole
        if whole:
            own = [whole.get(m, -1) for m in new]
            ids = [i for i in own if i >= 0]
            self._remember([m for m, i in zip(new, own) if i >= 0], np.array(ids, np.int32), np.ones(len(ids), np.int64))
            new = [m for m, i in zip(new, own) if i < 0]
        words = [m for m in new if m[0] == 0x20 < m[-1]]  # with a blank before them, and none at the end
        alone = [m for m in new if not m[0] == 0x20 < m[-1]]
        found, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for at in range(0, len(words), self.together):
            some = words[at : at + self.together]
            ids = np.array(self._cut(b"".join(some)), np.int32)
            ends = np.cumsum(np.fromiter(map(len, some), np.int64, len(some)))
            found.append(ids)
            sizes.append(np.diff(np.searchsorted(np.cumsum(self.bytes[ids]), ends, "right"), prepend=0))
        each = [*map(self._cut, alone)]
        found.append(np.fromiter(chain.from_iterable(each), np.int32))
        sizes.append(np.fromiter(map(len, each), np.int64, len(each)))
        self._remember(words + alone, np.concatenate(found), np.concatenate(sizes))

    def _group(self, texts: Sequence[str]) -> Iterator[np.ndarray]:
        plain = [PLAIN.search(t) is None for t in texts]
        odd = iter([np.array(e.ids, np.int32) for e in self.library.encode_batch_fast([t for t, p in zip(texts, plain) if not p], add_special_tokens=False)])
        if len(self.first) > self.cache:
            self._make_room()
        own = pa.array([t for t, p in zip(texts, plain) if p], pa.large_string())
        data = own.buffers()[2] or pa.py_buffer(b"")
        first = np.frombuffer(own.buffers()[1], np.int64, len(own) + 1) if len(own) else np.zeros(1, np.int64)
        cut = matches(np.frombuffer(data, np.uint8, first[-1]), first)
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cut) - 1, [None, pa.py_buffer(cut), data]).dictionary_encode()
        distinct, at = listed(coded.dictionary), coded.indices.to_numpy()
        known = self.known
        numbers = np.fromiter(map(known.get, distinct, repeat(-1)), np.int64, len(distinct))
        repeated = (np.bincount(at, minlength=len(distinct)) > 1) | (numbers >= 0)
        missing = np.flatnonzero(numbers < 0)
        new = [distinct[i] for i in missing.tolist()]
        if new:
            self._learn(new)
            numbers[missing] = np.fromiter(map(known.__getitem__, new), np.int64, len(new))
        self.again[numbers[repeated]] = True
        ids, each = self._ids(numbers[at])
        ends = np.concatenate([[0], np.cumsum(each)])[np.searchsorted(cut, first)].tolist()
        bounds = iter(zip(ends, ends[1:]))
        for p in plain:
            yield ids[slice(*next(bounds))] if p else next(odd)
        for m in new:
            if len(m) > CACHED_BYTES:
                known.pop(m, None)

    def encode(self, texts: Sequence[str]) -> Iterator[np.ndarray]:
        """The ids of every whole text, in bounded groups of texts."""
        group: list[str] = []
        size = 0
        for text in texts:
            if group and size + len(text) > GROUP_CHARS:
                yield from self._group(group)
                group, size = [], 0
            group.append(text)
            size += len(text)
        yield from self._group(group)

    def offsets(self, text: str) -> list[tuple[int, int]]:
        """First and last+1 code point that each token touches."""
        return self.library.encode(text, add_special_tokens=False).offsets

    def decode(self, ids: Sequence[int]) -> bytes:
        return joined(self.token, ids)


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def encode(docs: DataFrame, spec: str, offsets: bool = False, decoded: bool = False, cache: int = CACHE) -> DataFrame:
    """``docs`` with token_ids and n_tokens of the whole text, and with ``offsets`` starts and ends:
    the code points each token touches (tokens that share a character repeat it). With ``decoded``
    the ids are decoded again in the same pass, to the text that ``decode`` would give. ``cache``: matches that a worker remembers.

    A missing text counts as empty and has no ids. Rows are encoded one by one.
    """
    new = {"token_ids": "array<int>", "n_tokens": "bigint"} | ({"starts": "array<int>", "ends": "array<int>"} if offsets else {}) | ({"decoded": "string"} if decoded else {})
    named = {c: fresh(docs, c) for c in new}
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), *(f"`{named[c]}` {k}" for c, k in new.items())])
    shared = shared_spec(docs.sparkSession, spec)

    def start() -> Step:
        coder = Coder.of(shared.value, cache)
        ints = pa.list_(pa.int32())

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = texts_of(batch)
            ids = [*coder.encode(texts)]
            sizes = np.array([len(i) for i in ids], np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
            columns = [*batch.columns, lists, pa.array(sizes)]
            if offsets:
                places = [coder.offsets(t) for t in texts]
                columns += [pa.array([[p[at] for p in each] for each in places], ints) for at in (0, 1)]
            if decoded:
                columns.append(pa.array((coder.decode(i.tolist()).decode("utf-8", "replace") for i in ids), pa.string()))
            return pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *named.values()])

        return step

    return in_batches(docs, start, schema)


def decode(rows: DataFrame, spec: str, ids: str = "token_ids", name: str = "decoded") -> DataFrame:
    """``rows`` with the text of their ids; bytes that are not UTF-8 become replacement characters,
    missing ids a missing text."""
    from tokenizers import Tokenizer

    name = fresh(rows, name)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), f"`{name}` string"])
    shared = share(rows.sparkSession, token_bytes(Tokenizer.from_str(spec).get_vocab(with_added_tokens=True)))  # one entry a token

    def start() -> Step:
        tokens = pickle.loads(shared.value)

        def text(found: pa.ListScalar) -> str | None:
            return joined(tokens, found.values.to_pylist()).decode("utf-8", "replace") if found.is_valid else None

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = pa.array(map(text, batch.column(ids)), pa.string())
            return pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, name])

        return step

    return in_batches(rows, start, schema)


def round_trip(docs: DataFrame, spec: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids, comma-joined) and decoded_sha256 (of the
    bytes the ids decode to) of every whole text; a missing text counts as empty."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    shared = shared_spec(docs.sparkSession, spec)

    def start() -> Step:
        coder = Coder.of(shared.value)
        digits = [str(i) for i in range(len(coder.token))]

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, ids_sha, text_sha = [], [], []
            for found in coder.encode(texts_of(batch)):
                ids = found.tolist()
                n.append(len(ids))
                ids_sha.append(_sha(",".join([digits[i] for i in ids]).encode()))
                text_sha.append(_sha(coder.decode(ids)))
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

        return step

    return in_batches(docs.select("doc_id", "text"), start, schema)
