"""Secrets: fixed patterns, and a linear-chain conditional random field over all tokens of a text.

Tokens are runs of ASCII letters and digits, and all other characters but blanks. The chain runs
from the first token of a text to the last, over blanks, so a secret may have no digit, no letter or
several words. A string is a run of characters other than blanks; it only gives features.
"""

from __future__ import annotations

import heapq
import random
import re
import string
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from itertools import chain as chain_
from operator import or_
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .common import Step, bounded_sample, id_type, in_batches, share, texts_of, unpacked, with_text

SAMPLE = 2000  # documents with and without a base match that the field is trained on, at most each
WINDOWS = 4000  # windows of documents in training, at most; half of them with secrets
PLANTED = 5000  # invented lines
LONGEST_TRAINED = 48  # tokens of a training window
WINDOW_TOKENS = 24  # tokens of a training window of a document
EPOCHS = 80
LEAST_GAIN = 2e-3  # of the likelihood per example, in five rounds
KINDS = ("assign", "access", "hex", "crf")
REDACTED = "[SECRET]"
COMMON = (
    "the of and to in is that it for was on are as with his they be at one have this from or had by not but what all were when we there can an "
    "your which their said if do will each about how up out them then she many some so these would other into has more her two like him see time "
    "could no make than first been its who now people my made over did down only way find use may water long little very after words called just "
    "where most know required correct horse house battery garden place lost open name number file user"
).split()

# The base patterns and their least lengths (of group 2, of the match, of the match).
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 8, 16, 32

ASSIGN_CUES = ("password", "passwd", "secret", "token", "apikey", "api_key")
LONG_HEX = re.compile(r"[0-9a-f]{%d,}" % HEX_LENGTH)  # finds the same runs as HEX, sooner
TOKEN = re.compile(r"[A-Za-z0-9]+|[^A-Za-z0-9\s]")
PIECE = re.compile(r"[A-Za-z0-9]+|\s+|[^A-Za-z0-9\s]")  # tokens, and the blanks between them
KINDS_OF = str.maketrans(string.ascii_uppercase + string.ascii_lowercase + string.digits, "X" * 26 + "x" * 26 + "d" * 10)
SIGNS = "-./:=@_"
SIZES, DIGITS, VARIETY = (4, 8, 12, 16, 20, 28, 36, 48, 80), (0.01, 0.1, 0.2, 0.35, 0.6, 1), (0.2, 0.35, 0.5, 0.7)
BLANKS = np.array([*(chr(c).isspace() for c in range(0x3001)), False])  # by code point; no later one is blank
CACHE = 300_000  # tokens and strings whose scores a worker remembers, about
GROUP = 1 << 20  # about as many characters are decoded at once
BLOCK = 128  # tokens of a block of the chain
OUTSIDE, BEGIN, INSIDE = range(3)
#: Which label may follow which; INSIDE neither starts a string nor follows OUTSIDE.
FORBIDDEN = -1e9
LEAST = 8


class Span(NamedTuple):
    start: int
    kind: int
    end: int


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, by start, then kind."""
    found = []
    folded = text.lower()
    if any(cue in folded for cue in ASSIGN_CUES):
        found += [Span(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        found += [Span(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    found += [Span(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(found)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in spans)


# Features ------------------------------------------------------------------------------------

def kinds(token: str) -> str:
    """The token with X, x and d for ASCII capitals, small letters and digits."""
    return token.translate(KINDS_OF)


def shape(kind: str) -> str:
    return re.sub(r"(.)\1+", r"\1+", kind)[:12]


def _bucket(value: float, steps: tuple[float, ...]) -> int:
    return bisect_right(steps, value)


def file_features(text: str) -> list[str]:
    """How much the text looks like code or settings, and how long it is."""
    marks = sum(map(text.count, "={};:"))
    return [f"file.marks={_bucket(1000 * marks / (len(text) + 1), (1, 5, 20, 60))}", f"file.size={_bucket(len(text), (200, 2000, 20000))}"]


def kind_features(kind: str) -> list[str]:
    letters = kind.count("x") + kind.count("X")
    out = ["bias", f"shape={shape(kind)}", f"size={_bucket(len(kind), (2, 4, 8, 12, 16, 24, 32, 40))}", f"changes={_bucket(len(shape(kind)), (2, 4, 7, 10))}"]
    return [*out, f"letters={_bucket(letters / len(kind), (0.01, 0.5, 0.8, 1))}"]


def token_features(w: str) -> list[str]:
    return [*kind_features(kinds(w)), f"hex={not w.strip(string.hexdigits)}", f"word={w[:10].lower()}"]


def prev_features(w: str | None) -> list[str]:
    return [f"prev={'^' if w is None else w[:6].lower()}", f"prev.shape={'^' if w is None else shape(kinds(w))}"]


def prev2_features(w: str | None) -> list[str]:
    return [] if w is None else [f"prev2={w[:8].lower()}"]


def next_features(w: str | None) -> list[str]:
    return [f"next={'$' if w is None else w[:3].lower()}", f"next.shape={'$' if w is None else shape(kinds(w))}"]


def sign_text(code: int) -> str:
    return "".join(c for i, c in enumerate(SIGNS) if code >> i & 1)


def string_features(words: list[str]) -> list[str]:
    """Of the string that the tokens ``words`` make up."""
    size, kind = sum(map(len, words)), kinds("".join(words))
    digits, small, capital = kind.count("d"), kind.count("x"), kind.count("X")
    return [
        f"string.size={_bucket(size, SIZES)}", f"string.digits={_bucket(digits / max(digits + small + capital, 1), DIGITS)}", f"string.mix={2 * (small > 0) + (capital > 0)}",
        f"string.kinds={_bucket(sum(len(set(w)) for w in words) / size, VARIETY)}", f"string.signs={''.join(c for c in SIGNS if c in words)}",
    ]


def is_cue(word: str) -> bool:
    return 2 <= len(word) <= 20 and word.isascii() and word.isalpha()


def cue(words: list[str] | None) -> str:
    """The string's last token of letters."""
    return next((w.lower() for w in reversed(words or []) if is_cue(w)), "")


def lead(words: list[str] | None) -> str:
    """The sign that a string ends with."""
    return "" if not words or words[-1].isalnum() else words[-1]


def last_features(words: list[str] | None) -> list[str]:
    """Of the string before a token's string."""
    return [f"last={cue(words)}", f"lead={lead(words)}", *before_features(words)]


def before_features(words: list[str] | None) -> list[str]:
    """Of each of the three strings before a token's string."""
    return [f"before={cue(words)}"] if words else []


def place_features(place: int) -> list[str]:
    """Of the number of tokens before it in its string (3 for more), and whether a line starts there."""
    return [f"at={place % 4}", f"line={place >= 4}"]


def features(text: str, start: int, end: int, whole: list[str]) -> tuple[list[tuple[int, int]], list[list[str]]]:
    """Tokens that begin in a part of the text (as spans of the text) and the features of each, in the whole text."""
    tokens, places, at, gap = [], [], 0, ""
    strings, in_string, pieces = [], 0, []
    for piece in PIECE.findall(text):
        if piece[0].isspace():
            gap = piece
        else:
            new = not tokens or gap != ""
            in_string = 0 if new else in_string + 1
            strings.append((strings[-1] + 1 if strings else 0) if new else strings[-1])
            places.append(min(in_string, 3) + 4 * (not tokens or "\n" in gap))
            tokens.append((at, at + len(piece)))
            pieces += [[]] if new else []
            pieces[-1].append(piece)
            gap = ""
        at += len(piece)
    words = [text[a:b] for a, b in tokens]
    out = []
    for i, w in enumerate(words):
        if not start <= tokens[i][0] < end:
            continue
        k = strings[i]
        row = token_features(w) + prev_features(words[i - 1] if i else None) + next_features(words[i + 1] if i + 1 < len(words) else None)
        row += prev2_features(words[i - 2] if i > 1 else None) + place_features(places[i]) + string_features(pieces[k])
        row += last_features(pieces[k - 1] if k else None)
        for back in (2, 3):
            row += before_features(pieces[k - back] if k >= back else None)
        out.append(row + whole)
    return [t for t in tokens if start <= t[0] < end], out


# Field ---------------------------------------------------------------------------------------

class Scores(dict):
    """Numbers of values, and their label scores; made on first use."""

    def __init__(self, score: Callable[[Any], np.ndarray]) -> None:
        super().__init__()
        self.score, self.rows = score, []

    def __missing__(self, value: Any) -> int:
        self.rows.append(self.score(value))
        self[value] = len(self.rows) - 1
        return self[value]

    def of(self, values: Iterable[Any]) -> np.ndarray:
        """Scores of many values."""
        at = [self[v] for v in values]
        return np.stack(self.rows)[at]


class Met(dict):
    """Numbers of texts met in a group; ``settle`` gives the new ones their scores, all at once."""

    def __init__(self, make: Callable[[list[str]], list[np.ndarray]], none: list[np.ndarray]) -> None:
        super().__init__()
        self.make, self.new = make, []
        self.tables = [np.asarray(x)[None] for x in none]  # number 0: there is none
        self.count = 1

    def __missing__(self, value: str) -> int:
        self.new.append(value)
        self[value] = self.count
        self.count += 1
        return self[value]

    def settle(self) -> list[np.ndarray]:
        if self.new:
            self.tables = [np.concatenate(x) for x in zip(self.tables, self.make(self.new))]
            self.new = []
        return self.tables


def string_places(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Where the strings of a text begin, and whether each is the first of its line."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = BLANKS[np.minimum(codes, len(BLANKS) - 1)]
    begins = np.flatnonzero(~blank & np.append(True, blank[:-1])) if len(codes) else np.zeros(0, np.int64)
    lines = np.cumsum(codes == 10)[begins]
    return begins, np.append(True, lines[1:] > lines[:-1])[: len(begins)]


class Field:
    """Weights of features by label and of label pairs."""

    def __init__(self, names: list[str], weights: np.ndarray, moves: np.ndarray) -> None:
        self.number = {f: i for i, f in enumerate(names)}
        self.weights, self.moves = weights, moves
        self.padded = np.concatenate([weights, np.zeros((1, 3))])
        self.by_name: dict[str, dict[str, int]] = {}  # of features "template=value": value -> number
        for f, i in self.number.items():
            template, _, value = f.partition("=")
            self.by_name.setdefault(template, {})[value] = i
        self.caches: tuple[Met, Met] | None = None
        self.remembered, self.together = CACHE, GROUP
        self.by_kind = [Scores(lambda v, f=f: self.scores([f(v)])[0]) for f in (kind_features, lambda k: [f"prev.shape={shape(k)}"], lambda k: [f"next.shape={shape(k)}"])]
        steps = (("size", len(SIZES) + 1), ("digits", len(DIGITS) + 1), ("mix", 4), ("kinds", len(VARIETY) + 1))
        self.by_look = [self.scores([[f"string.{name}={i}"] for i in range(n)]) for name, n in steps]
        self.by_signs = self.scores([[f"string.signs={sign_text(i)}"] for i in range(1 << len(SIGNS))])

    def scores(self, rows: list[list[str]]) -> np.ndarray:
        number, out = self.number, np.zeros((len(rows), 3))
        for i, row in enumerate(rows):
            known = [number[f] for f in row if f in number]
            if known:
                out[i] = self.weights[known].sum(0)
        return out

    def decode(self, rows: list[list[str]]) -> list[int]:
        """Most likely labels (Viterbi); the earlier label wins ties."""
        emit = self.scores(rows)
        best, back = emit[0] + np.array([0.0, 0.0, FORBIDDEN]), []
        for i in range(1, len(emit)):
            step = best[:, None] + self.moves
            back.append(step.argmax(0))
            best = step.max(0) + emit[i]
        labels = [int(best.argmax())]
        for choice in reversed(back):
            labels.append(int(choice[labels[-1]]))
        return labels[::-1]

    def _named(self, template: str, values: Iterable[str]) -> np.ndarray:
        """Weights of one feature per value; none for unknown ones."""
        number, none = self.by_name.get(template, {}).get, len(self.weights)
        return self.padded.take([number(v, none) for v in values], 0)

    def _of_tokens(self, new: list[str]) -> list[np.ndarray]:
        """Scores as the token itself, before, two before and behind another, as the last and an earlier string's cue, as its end, and numbers."""
        kind, low = [kinds(w) for w in new], [w[:10].lower() for w in new]
        own, prev, following = (table.of(kind) for table in self.by_kind)
        hexed = self._named("hex", [str(not w.strip(string.hexdigits)) for w in new])
        own = own + hexed + self._named("word", low)
        prev = prev + self._named("prev", [w[:6] for w in low])
        behind = following + self._named("next", [w[:3] for w in low])
        cues = [w.lower() if is_cue(w) else "" for w in new]
        before = self._named("before", cues)
        leads = self._named("lead", ["" if w.isalnum() else w for w in new])
        sign = {c: 1 << i for i, c in enumerate(SIGNS)}
        numbers = np.array([
            [len(w) for w in new], [k.count("d") for k in kind], [k.count("x") for k in kind], [k.count("X") for k in kind], [len(set(w)) for w in new],
            [sign.get(w, 0) for w in new], [c != "" for c in cues],
        ], np.int64).T
        return [own, prev, self._named("prev2", [w[:8] for w in low]), behind, self._named("last", cues) + before, before, leads, numbers]

    def _of_strings(self, new: list[str]) -> list[np.ndarray]:
        """Scores of whole strings, their last token of letters (0: none) and last token, and where their tokens are in the pool."""
        tokens = self.caches[0]
        parts = [[tokens[t] for t in TOKEN.findall(w)] for w in new]
        numbers = tokens.settle()[-1]
        count = np.array([len(p) for p in parts], np.int64)
        ident, first = np.fromiter(chain_.from_iterable(parts), np.int64), np.cumsum(count) - count
        size, digits, small, capital, variety = np.add.reduceat(numbers[:, :5].take(ident, 0), first, axis=0).T
        signs = np.bitwise_or.reduceat(numbers[ident, 5], first)
        row = np.maximum.reduceat(np.where(numbers[ident, 6] > 0, np.arange(len(ident)), -1), first)
        cues = np.where(row >= first, ident[row], 0)
        place = (
            np.searchsorted(SIZES, size, "right"), np.searchsorted(DIGITS, digits / np.maximum(digits + small + capital, 1), "right"),
            2 * (small > 0) + (capital > 0), np.searchsorted(VARIETY, variety / size, "right"),
        )
        own = sum(table[at] for table, at in zip(self.by_look, place)) + self.by_signs[signs]
        length = numbers[ident, 0]
        before = np.cumsum(length) - length
        base = len(self.pool)
        self.pool = np.concatenate([self.pool, np.stack([ident, before - np.repeat(before[first], count), length], 1)])
        return [own, np.stack([cues, ident[first + count - 1], base + first, count], 1)]

    def _known(self) -> tuple[Met, Met]:
        """What is remembered of tokens and of strings; emptied when it is full, between groups."""
        if self.caches is None or max(map(len, self.caches)) > self.remembered:
            none = [self.scores([f])[0] for f in ([], prev_features(None), [], next_features(None), ["last=", "before="], ["before="], ["lead="])]
            self.pool = np.zeros((0, 3), np.int64)  # of all tokens of strings: number, place in the string, length
            self.caches = Met(self._of_tokens, [*none, np.zeros(7, np.int64)]), Met(self._of_strings, [np.zeros(3), np.zeros(4, np.int64)])
        return self.caches

    def emissions(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Label scores of all tokens of the texts one after the other, their starts and ends, and how many each text has."""
        tokens, strings = self._known()
        words = [text.split() for text in texts]
        every = [np.fromiter(map(strings.__getitem__, w), np.int64, len(w)) for w in words]
        own_string, about = strings.settle()
        n_strings = np.array([len(w) for w in words], np.int64)
        part = np.concatenate(every)
        if not len(part):
            return np.zeros((0, 3)), part, part, np.zeros(len(texts), np.int64)
        own, prev, prev2, following, as_last, as_before, as_lead, _ = tokens.settle()
        begins, lines = zip(*map(string_places, texts))
        cues, ends, first, count = about.take(part, 0).T
        string_of = np.repeat(np.arange(len(part)), count)
        in_string = np.arange(len(string_of)) - (np.cumsum(count) - count)[string_of]
        ident, offset, length = self.pool.take(first[string_of] + in_string, 0).T
        start = np.concatenate(begins)[string_of] + offset
        text_of_string = np.repeat(np.arange(len(texts)), n_strings)
        since = np.arange(len(part)) - (np.cumsum(n_strings) - n_strings)[text_of_string]  # strings before it in its text
        text_of = text_of_string[string_of]
        counts = np.bincount(text_of, minlength=len(texts))
        row = np.arange(len(ident))
        nth = row - (np.cumsum(counts) - counts)[text_of]
        spot = np.minimum(in_string, 3) + 4 * ((in_string == 0) & np.concatenate(lines)[string_of])

        at = np.arange(len(part))
        none = self.scores([last_features(None)])[0]
        of_string = own_string.take(part, 0) + np.where(since[:, None] > 0, as_last.take(cues[at - 1], 0) + as_lead.take(ends[at - 1], 0), none)
        for back in (2, 3):
            of_string += np.where(since[:, None] >= back, as_before.take(cues[np.maximum(at - back, 0)], 0), 0)
        of_string += self.scores([file_features(t) for t in texts]).take(text_of_string, 0)
        emit = own.take(ident, 0)
        emit += of_string.take(string_of, 0)
        emit += prev.take(np.where(nth > 0, ident[row - 1], 0), 0)
        emit += prev2.take(np.where(nth > 1, ident[row - 2], 0), 0)
        emit += following.take(np.where(np.append(nth[1:], 0) == 0, 0, np.roll(ident, -1)), 0)
        emit += self.scores([place_features(k) for k in range(8)]).take(spot, 0)
        return emit, start, start + length, counts

    def spans(self, text: str) -> list[tuple[int, int]]:
        return self.spans_of([text])[0]

    def spans_of(self, texts: list[str]) -> list[list[tuple[int, int]]]:
        """Secrets in each whole text: a begin with the insides after it, of eight characters or more."""
        out: list[list[tuple[int, int]]] = []
        group: list[str] = []
        for k, text in enumerate(texts):
            group.append(text)
            if sum(map(len, group)) >= self.together or k + 1 == len(texts):
                out += self._spans_of(group)
                group = []
        return out

    def _spans_of(self, texts: list[str]) -> list[list[tuple[int, int]]]:
        emit, start, end, counts = self.emissions(texts)
        out: list[list[tuple[int, int]]] = [[] for _ in texts]
        labels = chain(emit, counts, self.moves)
        stop = np.append(np.flatnonzero(labels != INSIDE), len(labels))
        ends = np.cumsum(counts)
        for at in np.flatnonzero(labels == BEGIN).tolist():
            k = int(np.searchsorted(ends, at, "right"))
            a, b = int(start[at]), int(end[min(stop[np.searchsorted(stop, at, "right")], ends[k]) - 1])
            if b - a >= LEAST:
                out[k].append((a, b))
        return out


def chain(emit: np.ndarray, counts: np.ndarray, moves: np.ndarray, size: int = BLOCK) -> np.ndarray:
    """Most likely labels (Viterbi) of several texts one after the other, ``counts`` tokens each.

    The sequence is cut into blocks that are decoded side by side from every label before them; then
    the label at each border follows from the blocks before and behind, so no block decides alone.
    """
    n, blocks = len(emit), -(-len(emit) // size)
    if not n:
        return np.zeros(0, np.int64)
    first = np.zeros(blocks * size, bool)
    first[(np.cumsum(counts) - counts)[np.asarray(counts) > 0]] = True
    first[n:] = True  # filling
    scores = np.zeros((blocks * size, 3))
    scores[:n] = emit
    scores = np.ascontiguousarray(scores.reshape(blocks, size, 3).transpose(1, 2, 0))
    first = np.ascontiguousarray(first.reshape(blocks, size).T)
    start = np.array([0.0, 0.0, FORBIDDEN])
    inner, fresh_ = np.repeat(moves[:, :, None], blocks, 2), np.repeat(np.repeat(start[None, :, None], 3, 0), blocks, 2)
    best = np.full((3, 3, blocks), 4 * FORBIDDEN)  # label now, label before the block
    best[np.arange(3), np.arange(3)] = 0
    back = np.zeros((size, 3, 3, blocks), np.int8)
    for t in range(size):
        step = np.where(first[t], fresh_, inner) if first[t].any() else inner
        a, b, c = (best[j][None] + step[j][:, None] for j in range(3))
        top = np.maximum(a, b)
        back[t] = np.where(c > top, 2, b > a)
        best = np.maximum(top, c) + scores[t][:, None]
    level, entered = np.zeros(3), np.zeros((blocks, 3), np.int64)
    for k in range(blocks):
        total = best[:, :, k] + level
        entered[k] = total.argmax(1)
        level = total.max(1)
        level -= level.max()
    label, last, into = int(level.argmax()), np.zeros(blocks, np.int64), np.zeros(blocks, np.int64)
    for k in range(blocks - 1, -1, -1):
        last[k], into[k] = label, entered[k, label]
        label = int(into[k])
    out, row = np.zeros((size, blocks), np.int64), np.arange(blocks)
    for t in range(size - 1, -1, -1):
        out[t] = last
        last = back[t, last, into, row]
    return out.T.ravel()[:n]


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def train(examples: Iterable[tuple[list[list[str]], list[int]]], epochs: int = EPOCHS) -> Field:
    """Maximum likelihood with a small quadratic penalty; forward-backward over all examples at once.

    Only feature numbers are kept, one after the other, and the examples are ordered by length, so
    nothing is padded. It ends when the likelihood gains less than ``LEAST_GAIN``.
    """
    number: dict[str, int] = {}
    kept_: list[tuple[np.ndarray, np.ndarray, list[int]]] = []
    for rows, labels in examples:
        ids = np.fromiter((number.setdefault(f, len(number)) for row in rows for f in row), np.int32)
        kept_.append((ids, np.array([len(row) for row in rows], np.int32), labels))
    allowed = np.zeros((3, 3))
    allowed[OUTSIDE, INSIDE] = FORBIDDEN
    kept_.sort(key=lambda e: -len(e[2]))
    if not kept_ or not kept_[0][2]:
        return Field([], np.zeros((0, 3)), allowed)
    seen = np.zeros(len(number), np.int64)
    for ids, _, _ in kept_:
        seen[np.unique(ids)] += 1
    names = sorted(f for f, i in number.items() if seen[i] >= 2)
    renumber = np.full(len(number), len(names), np.int32)  # all rare features are one without weight
    renumber[[number[f] for f in names]] = np.arange(len(names), dtype=np.int32)
    flat, width = renumber[np.concatenate([e[0] for e in kept_])], np.concatenate([e[1] for e in kept_])
    gold = np.eye(3)[np.concatenate([e[2] for e in kept_])]
    size = np.array([len(e[2]) for e in kept_])
    n, longest, start_of = len(size), int(size[0]), np.cumsum(size) - size
    alive = [int(np.searchsorted(-size, -t)) for t in range(longest)]  # examples with a token t
    cuts = np.cumsum(width) - width
    inner = np.ones(len(gold), bool)
    inner[start_of] = False
    behind = np.flatnonzero(inner)  # tokens with one before them
    pairs = gold[behind - 1].T @ gold[behind]
    weights, moves = np.zeros((len(names) + 1, 3)), np.zeros((3, 3))
    state = [np.zeros_like(x) for x in (weights, weights, moves, moves)]
    start, before = np.array([0.0, 0.0, FORBIDDEN]), -np.inf
    for epoch in range(1, epochs + 1):
        emit = np.stack([np.add.reduceat(weights[:, y].astype(np.float32)[flat], cuts) for y in range(3)], 1).astype(float)
        step = moves + allowed
        alpha, beta = np.empty_like(emit), np.zeros_like(emit)
        alpha[start_of] = emit[start_of] + start
        for t in range(1, longest):
            at = start_of[: alive[t]] + t
            alpha[at] = _lse(alpha[at - 1][:, :, None] + step, 1) + emit[at]
        for t in range(longest - 2, -1, -1):
            at = start_of[: alive[t + 1]] + t
            beta[at] = _lse(step + (emit[at + 1] + beta[at + 1])[:, None, :], 2)
        whole = _lse(alpha[start_of + size - 1], 1)
        total = np.repeat(whole, size)
        chance = np.exp(np.minimum(alpha + beta - total[:, None], 0))
        joint = np.exp(np.minimum(alpha[behind - 1][:, :, None] + step + (emit[behind] + beta[behind])[:, None, :] - total[behind, None, None], 0))
        error = gold - chance
        slope = np.stack([np.bincount(flat, np.repeat(error[:, y], width), len(names) + 1) for y in range(3)], 1)
        slope[-1] = 0
        for x, g, m, v in ((weights, slope / n - 1e-3 * weights, *state[:2]), (moves, (pairs - joint.sum(0)) / n - 1e-3 * moves, *state[2:])):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x += 0.3 * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.99**epoch)) + 1e-8)
        if epoch % 5 == 0:
            path = (gold * emit).sum() + (pairs * np.where(pairs > 0, step, 0)).sum()
            likely = (path - whole.sum()) / n
            if likely - before < LEAST_GAIN:
                break
            before = likely
    return Field(names, weights[:-1], moves + allowed)


# Training strings ----------------------------------------------------------------------------

def _labels(tokens: list[tuple[int, int]], secrets: list[tuple[int, int]]) -> list[int]:
    out, before = [], None
    for a, b in tokens:
        inside = next((s for s in secrets if s[0] < b and a < s[1]), None)
        out.append(OUTSIDE if inside is None else INSIDE if inside == before else BEGIN)
        before = inside
    return out


def windows_of(text: str, wanted: Callable[[int, bool], bool] = lambda at, has: True) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Parts of a text with their surroundings, and the secrets that the base patterns show there.

    ``wanted`` says by the place of the first token, and whether there is a secret, which to make.
    """
    secrets = [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH] + [(s.start, s.end) for s in base_spans(text) if s.kind]
    apart: list[tuple[int, int]] = []
    for s in sorted(set(secrets), key=lambda s: (s[0], -s[1])):  # without those inside another
        if not apart or s[1] > apart[-1][1]:
            apart.append(s)
    places, next_ = [m.span() for m in TOKEN.finditer(text)], 0
    for at in range(0, len(places), WINDOW_TOKENS):
        a, b = places[at][0], places[min(at + WINDOW_TOKENS, len(places)) - 1][1]
        while next_ < len(apart) and apart[next_][1] <= a:
            next_ += 1
        has = next_ < len(apart) and apart[next_][0] < b
        if not wanted(a, has):
            continue
        left, right = max(0, a - 60), b + 20
        found, i = [], next_
        while i < len(apart) and apart[i][0] < b:
            found.append((max(apart[i][0], a) - left, min(apart[i][1], b) - left))
            i += 1
        yield text[left:right], a - left, b - left, found


CUES = (
    "password", "Password", "pass", "pwd", "secret", "token", "key", "api key", "api_key", "apikey", "access key", "access_token", "credential", "credentials", "auth",
    "Authorization: Bearer", "bearer", "private key", "client_secret", "PIN", "license key", "X-Auth-Key", "SECRET_KEY", "DB_PASS", "passcode", "login", "clave", "senha",
    "Passwort", "mot de passe", "wlan key", "signing key", "session key",
)
LINKS = (": ", "=", " = ", ": \"", "='", "=\"", " is ", " is: ", " -> ", " := ", " ", " was ", " : ", ", ", " lautet ", " est ", " (", "\t")
LEETS = str.maketrans("aeiost", "431057")


class Inventor:
    """Draws invented strings."""

    def __init__(self, seed: int) -> None:
        self.draw = random.Random(seed)

    def some(self, alphabet: str, low: int, high: int | None = None) -> str:
        return "".join(self.draw.choices(alphabet, k=self.draw.randint(low, high or low)))

    def word(self) -> str:
        return self.draw.choice(COMMON) if self.draw.random() < 0.5 else self.some(string.ascii_lowercase, 3, 9)

    def words(self, low: int, high: int) -> list[str]:
        return [self.word() for _ in range(self.draw.randint(low, high))]

    def key(self) -> str:
        """A random key that shows by itself: many kinds of characters in any order."""
        draw, letters, digits = self.draw, string.ascii_letters, string.digits
        mixed = letters + digits
        which = draw.randrange(9)
        if which == 0:  # short name, separator, body
            return self.some(string.ascii_letters if draw.random() < 0.3 else string.ascii_lowercase, 2, 6) + draw.choice("-_.") + self.some(mixed, 12, 44)
        if which == 1:  # two short names
            return self.some(string.ascii_lowercase, 2, 4) + "_" + self.some(string.ascii_lowercase, 3, 6) + "_" + self.some(mixed, 16, 40)
        if which == 2:
            return self.some(mixed + "+/", 24, 72) + draw.choice(("", "=", "=="))
        if which == 3:
            return ".".join(self.some(mixed + "-_", 12, 40) for _ in range(draw.randint(2, 3)))
        if which == 4:
            return self.some("0123456789abcdef", 33, 64)
        if which == 5:
            return self.some(string.ascii_uppercase, 3, 5) + self.some(string.ascii_uppercase + digits, 12, 30)
        if which == 6:
            return "-".join(self.some(mixed, 4, 10) for _ in range(draw.randint(3, 5)))
        if which == 7:
            return self.some(string.ascii_letters, 4) + self.some(mixed + "_-", 20, 40)
        return self.some(mixed, 18, 64)

    def login(self) -> str:
        """A password that shows only behind a cue."""
        draw = self.draw
        parts = "".join(w.capitalize() if draw.random() < 0.6 else w for w in self.words(1, 3))
        which = draw.randrange(8)
        if which == 0:
            out = parts + self.some(string.digits, 1, 5) + self.some("!?#$%&*", 0, 2)
        elif which == 1:
            out = parts.translate(LEETS) + self.some("!?#$%&*", 0, 2)
        elif which == 2:
            out = self.some(string.ascii_letters + string.digits + "!%*?&#", 9, 20)
        elif which == 3:
            out = self.some(string.digits, 10, 20)
        elif which == 4:
            out = self.some(string.ascii_letters, 12, 30)
        elif which == 5:
            out = (self.some(string.ascii_lowercase, 3, 7) + self.some(string.digits, 1, 2)) * 2
        elif which == 6:
            out = "".join(w.capitalize() for w in self.words(2, 4))
        else:
            out = self.some(string.ascii_lowercase + string.digits, 9, 24) + self.some(string.digits, 1)
        return out if len(out) >= LEAST else out + self.some(string.digits, LEAST)

    def harmless(self) -> str:
        """What looks a little like a key and is none."""
        draw, digits = self.draw, string.digits
        return draw.choice((
            lambda: f"{self.word()}{self.some(digits, 2, 5)}@example.{draw.choice(('com', 'org'))}",
            lambda: f"https://{self.word()}.example.com/{self.some(string.ascii_lowercase, 4, 12)}/{self.some(digits, 1, 6)}{draw.choice(('', '?page=2&ref=x', '.html'))}",
            lambda: f"{self.word()} on 20{self.some(digits, 2)}-0{draw.randint(1, 9)}-1{self.some(digits, 1)}T1{self.some(digits, 1)}:{self.some('012345', 1)}0:00Z",
            lambda: f"v{self.some(digits, 1)}.{self.some(digits, 1, 2)}.{self.some(digits, 1)}-{draw.choice(('beta', 'rc'))}{self.some(digits, 1)}",
            lambda: f"{draw.choice(('IMG', 'DSC', 'scan'))}_{self.some(digits, 4, 8)}.{draw.choice(('jpg', 'pdf'))}", lambda: f"section{self.some(digits, 1, 3)},",
            lambda: f"{self.some(string.ascii_uppercase, 2)}{self.some(digits, 4, 6)}", lambda: f"order {self.some(digits, 6, 14)}", lambda: f"+{self.some(digits, 2)} {self.some(digits, 3)} {self.some(digits, 6, 8)}",
            lambda: "".join(w.capitalize() for w in self.words(2, 4)), lambda: "_".join(self.words(2, 4)), lambda: f"{self.word()}{draw.choice(('***', '%%%', '$$$', '###', '&amp;'))}",
            lambda: f"{self.some(digits, 1, 3)},{self.some(digits, 3)}.{self.some(digits, 2)} EUR", lambda: f"({self.some(string.ascii_lowercase, 5, 9)}{self.some(digits, 1, 2)})",
            lambda: "-".join(self.words(2, 4)), lambda: " ".join([self.some(string.ascii_lowercase, 2, 5)] * draw.choice((3, 8, 20))),
            lambda: " ".join([draw.choice(COMMON).capitalize()] * draw.choice((3, 8, 20))), lambda: f"{self.word()} {self.some(digits, 9, 18)} {self.word()}",
            lambda: f"{self.word()}, {self.some(digits, 15, 16)} {self.word()}", lambda: (self.some(string.ascii_lowercase, 3, 6) * 2),
        ))()


def planted(seed: int, count: int) -> list[tuple[str, int, int, list[tuple[int, int]]]]:
    """Invented lines with keys, passwords and passphrases, and harmless look-alikes, to learn from beyond the base patterns."""
    invent = Inventor(seed)
    draw = invent.draw
    phrases = ("passphrase: ", "passphrase is ", 'passphrase = "', "pass phrase: ", "seed phrase: ", "recovery phrase is ")
    talk = ("is required", "must be changed", "of the week", "to success", "points are", "was lost", "for the door", "and the user", "in the list", "is not", "holder", "12 of 30")
    out = []
    for k in range(count):
        line = " ".join(invent.words(0, 6))
        line = line.capitalize() + draw.choice((" ", ". ", "\n")) if line else ""
        value, tail = "", ""
        if k % 2:  # harmless
            which = draw.random()
            if which < 0.45:
                line += " ".join(invent.harmless() for _ in range(draw.randint(1, 2)))
            elif which < 0.7:
                line += f"{draw.choice(('the', 'this', 'a', 'every', ''))} {draw.choice(CUES)} {draw.choice(talk)} {' '.join(invent.words(0, 3))}"
            else:
                line += " ".join(invent.words(4, 16)) + draw.choice((".", "", ","))
        else:
            which = draw.random()
            if which < 0.08:
                lead_, value = draw.choice(phrases), " ".join(invent.words(3, 7))
            elif which < 0.14:
                lead_, value, tail = f"{draw.choice(('mysql', 'https', 'ftp', 'amqp'))}://{invent.word()}:", draw.choice((invent.key, invent.login))(), f"@{invent.word()}.example.com/{invent.word()}"
                value = value.replace("@", "").replace("/", "")
            elif which < 0.45:
                lead_, value = "", invent.key()
            else:
                lead_, value = draw.choice(CUES) + draw.choice(LINKS), draw.choice((invent.key, invent.login, invent.login))()
            if lead_ in phrases:
                tail = '"' if lead_.endswith('"') else draw.choice((".", "\n", ""))
            elif not tail:
                tail = {'"': '"', "'": "'", "(": ")"}.get(lead_[-1:], draw.choice(("", "", ".", ",", ";")))
            line += lead_
        a = len(line)
        line += value + tail
        if not (value and line[:a].endswith(phrases) and not tail):
            line += draw.choice(("\n", " ")) + " ".join(invent.words(0, 5))
        out.append((line, 0, len(line), [(a, a + len(value))] if value else []))
    return out


def learn(docs: DataFrame) -> Field:
    """The field, from a bounded sample of documents labelled by the base patterns, and planted lines."""
    folded = F.lower("text")
    has = reduce(or_, [folded.contains(c) for c in ASSIGN_CUES]) | F.col("text").contains("AKIA") | F.col("text").rlike("[0-9a-f]{32}")
    marked = staged(docs.select("doc_id", F.coalesce(has, F.lit(False)).alias("has")), "marked")
    sample = staged(bounded_sample(marked, "has", SAMPLE).select("doc_id").distinct(), "sample")
    half, names = WINDOWS // 2, ["place", "line", "start", "end", "secrets"]
    spans = pa.list_(pa.list_(pa.int32()))

    def windows(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        """Of each kind those with the smallest hashes of text and place: no task gives more than can be chosen."""
        held: dict[bool, list[tuple]] = {True: [], False: []}
        for batch in batches:
            for text in texts_of(batch):
                seed, drawn = zlib.crc32(text.encode("utf-8", "surrogatepass")), []

                def wanted(at: int, has: bool) -> bool:
                    draw = zlib.crc32(f"{seed}:{at}".encode())
                    full = len(held[has]) >= half
                    if not full or draw < -held[has][0][0]:
                        drawn.append((draw, has))
                        return True
                    return False

                for window in windows_of(text, wanted):
                    draw, has = drawn.pop()
                    (heapq.heappushpop if len(held[has]) >= half else heapq.heappush)(held[has], (-draw, *window))
        rows = [(-r[0], *r[1:]) for some in held.values() for r in some]
        if rows:
            kinds_ = (pa.int64(), pa.string(), pa.int32(), pa.int32(), spans)
            yield pa.RecordBatch.from_arrays([pa.array([[list(s) for s in x] for x in c] if k is spans else c, k) for c, k in zip(zip(*rows), kinds_)], names=names)

    lines = docs.select("doc_id", "text").join(sample, "doc_id").select("text").mapInArrow(windows, "place bigint, line string, start int, end int, secrets array<array<int>>")
    lines, chosen = staged(lines, "windows"), []
    for some in ("size(secrets) > 0", "size(secrets) = 0"):
        chosen += lines.where(some).orderBy("place", "line", "start").limit(half).collect()
    real = ((r["line"], r["start"], r["end"], [tuple(s) for s in r["secrets"]]) for r in chosen)
    return train(e for e in map(example, chain_(real, planted(7, PLANTED))) if e[0])


def example(window: tuple[str, int, int, list[tuple[int, int]]]) -> tuple[list[list[str]], list[int]]:
    """Features and labels of the tokens of a window."""
    line, a, b, secrets = window
    tokens, rows = features(line, a, b, file_features(line))
    return rows[:LONGEST_TRAINED], _labels(tokens, secrets)[:LONGEST_TRAINED]


def all_spans(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """Base spans of each text, and these with the field's spans that touch none of them."""
    out = []
    for text, found in zip(texts, field.spans_of(texts)):
        base = base_spans(text)
        more = [Span(a, 3, b) for a, b in found if not any(s.start < b and a < s.end for s in base)]
        out.append((base, sorted([*base, *more])))
    return out


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_crf, base_sha256, spans, of every whole text.

    A span is a whole match (kind:start:end in code points). A missing or empty text has none.
    Rows are searched one by one, so repeated rows and ids are all returned.
    """
    shared = share(docs.sparkSession, learn(docs))  # bounded by WINDOWS and PLANTED
    counts = ["n_assign", "n_access", "n_hex", "n_crf"]
    schema = f"doc_id {id_type(docs)}, {', '.join(f'{c} bigint' for c in counts)}, base string, spans string"

    def start() -> Step:
        field = unpacked(shared)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = all_spans(texts_of(batch), field)
            columns = [pa.array([sum(s.kind == k for s in every) for _, every in found], pa.int64()) for k in range(len(KINDS))]
            columns += [pa.array([joined(spans[k]) for spans in found], pa.string()) for k in (0, 1)]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", *counts, "base", "spans"])

        return step

    found = in_batches(docs.select("doc_id", "text"), start, schema)
    return found.select("doc_id", *counts, F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


def redacted(text: str, spans: list[Span], mark: str = REDACTED) -> str:
    out, at = [], 0
    for s in spans:
        if s.end <= at:
            continue
        if s.start >= at:
            out += [text[at : s.start], mark]
        at = s.end
    return "".join([*out, text[at:]])


def without_secrets(docs: DataFrame, cache: int = CACHE // 3, group: int = GROUP // 4) -> DataFrame:
    """``docs`` with every secret replaced by a mark; no row goes, missing texts stay missing.

    Workers remember less and decode fewer texts at once than in ``find_secrets``, as those of a pipeline hold memory of other stages.
    """
    shared = share(docs.sparkSession, learn(docs))

    def start() -> Step:
        field = unpacked(shared)
        field.remembered, field.together = cache, group

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column("text").to_pylist()
            for i, (_, spans) in enumerate(all_spans([t or "" for t in texts], field)):
                if spans:
                    texts[i] = redacted(texts[i], spans)
            return with_text(batch, texts)

        return step

    return in_batches(docs, start, docs.schema)
