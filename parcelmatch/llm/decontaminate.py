"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton's alphabet are the items' words. Document words run through it; the length of the
longest match that ends at each word tells which words lie inside an item window.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .common import Step, fresh, in_batches, share, texts_of, unpacked, with_text

WINDOW = 10
BLOCK_WORDS = 200_000  # of items in one automaton, which bounds what is broadcast
PIECE_WORDS = 20_000
MIN_SPAN = 10
MAX_COVERAGE = 0.5
WORD_BYTES = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: Lower-cases A-Z and turns every byte outside words into a blank.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(FOLD).split()


class Automaton:
    """Generalised suffix automaton over words with the windows of its items."""

    def __init__(self, window: int) -> None:
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.items: list[set[str] | None] = [None]

    def _state(self, length: int, link: int, arrows: dict[bytes, int]) -> int:
        self.next.append(arrows)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, p: int, word: bytes) -> int:
        """The state of p's strings extended by ``word``, cut off from longer ones."""
        q = self.next[p][word]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: bytes) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        state, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = state
            p = self.link[p]
        if p >= 0:
            self.link[state] = self._split(p, word)
        return state

    def add(self, words: Iterable[bytes]) -> None:
        state = 0
        for word in words:
            state = self._extend(state, word)

    def finish(self, pieces: list[tuple[str, list[bytes], bool]]) -> None:
        """Note which items hold which window; a piece that is a whole short item is one window."""
        n = len(self.length)
        self.holds = [self.length[v] >= self.window for v in range(n)]  # by length of the longest string
        self.whole: dict[int, int] = {}  # state with full-length window: the state of its last `window` words
        self.items = [None] * n
        self.short: dict[int, dict[int, set[str]]] = {}
        for item, words, is_short in pieces:
            v, at = 0, 0
            for word in words:
                v, at = self.next[v][word], at + 1
                if at >= self.window:
                    u = self._window_state(v)
                    if self.items[u] is None:
                        self.items[u] = set()
                    self.items[u].add(item)
            if is_short and words:
                self.short.setdefault(v, {}).setdefault(len(words), set()).add(item)
        # short windows that end wherever a state ends: its own and those of all its suffixes
        self.ends: list[tuple[tuple[int, frozenset[str]], ...]] = [()] * n
        for v in sorted(range(n), key=self.length.__getitem__):
            own = tuple((m, frozenset(found)) for m, found in sorted(self.short.get(v, {}).items()))
            above = self.ends[self.link[v]] if v else ()
            self.ends[v] = above + own if own else above
        self.live = [self.holds[v] or bool(self.ends[v]) for v in range(n)]

    def _window_state(self, v: int) -> int:
        u, path = v, []
        while self.length[self.link[u]] >= self.window:
            if u in self.whole:
                u = self.whole[u]
                break
            path.append(u)
            u = self.link[u]
        for x in path:
            self.whole[x] = u
        return u

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans [start, end) of words inside windows, in order and apart, and the items found."""
        arrows, link, length, live = self.next, self.link, self.length, self.live
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        v = matched = 0
        for i, word in enumerate(words):
            to = arrows[v].get(word)
            if to is None:
                while v and to is None:
                    v = link[v]
                    to = arrows[v].get(word)
                if to is None:
                    matched = 0
                    continue
                matched = length[v]
            v, matched = to, matched + 1
            if not live[v]:
                continue
            reach = 0
            if matched >= self.window:
                reach = matched
                found |= self.items[self._window_state(v)] or ()
            for m, items in self.ends[v]:
                if m <= matched:
                    reach = max(reach, m)
                    found |= items
            if reach:
                start = i + 1 - reach
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i + 1))
        return spans, found


def automaton(pieces: list[tuple[str, list[bytes], bool]], window: int = WINDOW) -> Automaton:
    made = Automaton(window)
    for _, words, _ in pieces:
        made.add(words)
    made.finish(pieces)
    return made


def _blocks(items: DataFrame, window: int, block_words: int) -> Iterator[list[tuple[str, list[bytes], bool]]]:
    """Items in blocks of bounded size. A long item is cut into pieces that share window-1 words."""
    block: list[tuple[str, list[bytes], bool]] = []
    size = 0
    step = max(PIECE_WORDS - window + 1, 1)
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text").where("text is not null")
    for row in rows.toLocalIterator():
        words = words_of(row["text"])
        for at in range(0, max(len(words) - window + 1, 1), step):
            piece = words[at : at + step + window - 1]
            if piece:
                if size + len(piece) > block_words and block:
                    yield block
                    block, size = [], 0
                block.append((row["item_id"], piece, len(words) < window))
                size += len(piece)
    yield block


def find_windows(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with n_words, spans (of words, end exclusive) and items of every row.

    ``items``: item_id, text. Each block of items is one automaton of bounded size and one pass
    over the documents; usually there is one block. Texts without words (missing, empty) have no
    spans. Rows are matched one by one, so repeated rows and equal ids are all returned; an item
    without id counts as the id ''. A column that is already called like a new one is replaced.
    """
    spark = docs.sparkSession
    new = {"n_words": "bigint", "spans": "array<struct<start:int,end:int>>", "items": "array<string>"}
    rows = docs.drop(*new)
    kept = rows.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    full = schema + ", " + ", ".join(f"{k} {v}" for k, v in new.items())
    for block in _blocks(items, window, block_words):
        shared = share(spark, automaton(block, window))
        first = "spans" not in rows.columns
        if not first:
            rows = staged(rows, "matched")

        def start(shared=shared, first=first) -> Step:
            graph = unpacked(shared)
            span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

            def step(batch: pa.RecordBatch) -> pa.RecordBatch:
                n, spans, found = [], [], []
                old = ([[]] * batch.num_rows,) * 2 if first else (batch.column("spans").to_pylist(), batch.column("items").to_pylist())
                for text, was, had in zip(texts_of(batch), *old):
                    words = words_of(text)
                    got, ids = graph.scan(words)
                    n.append(len(words))
                    spans.append([{"start": a, "end": b} for a, b in merged([(s["start"], s["end"]) for s in was], got)])
                    found.append(sorted(ids.union(had)))
                arrays = [batch.column(c) for c in kept] + [pa.array(n, pa.int64()), pa.array(spans, span_type), pa.array(found, pa.list_(pa.string()))]
                return pa.RecordBatch.from_arrays(arrays, names=[*kept, *new])

            return step

        rows = in_batches(rows, start, full)
    return rows


def merged(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    if not a or not b:
        return a or b
    out: list[tuple[int, int]] = []
    for start, end in sorted([*a, *b]):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the characters from a span's first to its last word; a line break stays."""
    raw = text.encode()
    places = [m.span() for m in WORD_BYTES.finditer(raw)]
    out, at = [], 0
    for start, end in spans:
        out.append(raw[at : places[start][0]])
        at = places[end - 1][1]
    out.append(raw[at:])
    return b"\n".join(out).decode()


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated per row of ``docs``."""
    found = find_windows(docs.select("doc_id", "text"), items, window)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + (x["end"] - x["start"]))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, min_span: int = MIN_SPAN, max_coverage: float = MAX_COVERAGE
) -> DataFrame:
    """``docs`` without the spans of ``min_span`` words or more (and without whole short items); a
    row whose spans cover more than ``max_coverage`` of its words goes. Columns stay as they are.

    What a cut brings together is scanned again until nothing is left to cut. Missing and empty
    texts are kept as they are, repeated rows are treated alike.
    """
    clash = {c: fresh(docs, "_" + c) for c in docs.columns if c.lower() in ("n_words", "spans", "items")}
    found = find_windows(docs.withColumnsRenamed(clash), items, window)
    covered = F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + (x["end"] - x["start"]))
    rows = staged(found.where(covered <= F.col("n_words") * max_coverage), "found")  # two Python steps in a task would take two workers
    shared = [share(docs.sparkSession, automaton(block, window)) for block in _blocks(items, window, BLOCK_WORDS)]
    first = True
    while True:
        for k, graph in enumerate(shared):
            rows = in_batches(rows, _cutter(graph, window, min_span, first, k > 0), rows.schema)
            first = False
            if len(shared) > 1:
                rows = staged(rows, "cut")
        if len(shared) == 1:
            break  # else a cut by one block may bring together what another block looks for
        if rows.where("n_words < 0").isEmpty():
            break
    return rows.drop("n_words", "spans", "items").withColumnsRenamed({v: k for k, v in clash.items()})


def _cutter(shared: Broadcast, window: int, min_span: int, first: bool, later: bool = False) -> Callable[[], Step]:
    """A step that cuts the rows with spans, the ``first`` time by these, until the automaton finds none; n_words is -1 where it
    or, if it is a ``later`` one of the round, one before it cut."""

    def start() -> Step:
        graph = unpacked(shared)

        def due(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
            return [s for s in spans if s[1] - s[0] >= min_span or s[1] - s[0] < window]

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column("text").to_pylist()
            cut = [min(n, 0) for n in batch.column("n_words").to_pylist()] if later else [0] * len(texts)
            for i, spans in enumerate(batch.column("spans").to_pylist()):
                if not spans:
                    continue
                gone = due([(s["start"], s["end"]) for s in spans] if first else graph.scan(words_of(texts[i]))[0])
                while gone:
                    texts[i] = without_spans(texts[i], gone)
                    cut[i] = -1
                    gone = due(graph.scan(words_of(texts[i]))[0])
            out = with_text(batch, texts)
            return out.set_column(out.schema.get_field_index("n_words"), "n_words", pa.array(cut, pa.int64()))

        return step

    return start


__all__ = ["Automaton", "automaton", "contamination", "decontaminate", "find_windows", "merged", "without_spans", "words_of"]
