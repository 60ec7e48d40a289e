"""Toxicity from the nearest labelled examples by TF-IDF cosine, found exactly with block-max bounds.

Terms are words and word beginnings that tell the classes apart in the examples; all other words
count as one common term, so that the share of telling words matters. The inverted index keeps,
per term and block of entries, the largest weight; blocks whose best possible cosine is below the
k-th best found are never scored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .common import Step, bounded_sample, id_type, in_batches, learnable, share, texts_of, unpacked

PER_CLASS = 2000  # labelled examples of each class in the index, at most
MAX_TERMS = 1000  # telling terms, at most: those with the largest chi-square
MIN_EXAMPLES = 5
MIN_CHI = 12.0
MIN_LIFT = 2.0
PREFIXES = (3, 4, 5, 6, 7)
NEIGHBOURS = 15
BLOCK = 64
SOFTEN = 1e-3
THRESHOLD = 0.7
EVIDENCE = 3
WORD = re.compile(r"[^\W\d_]+")
CACHE = 100_000


def terms_of(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)]


class Terms:
    """Term counts of texts; remembers which telling terms a word has."""

    def __init__(self, terms: list[str]) -> None:
        self.number = {t: i for i, t in enumerate(terms)}
        self.known: dict[str, tuple[int, ...]] = {}

    def _of(self, word: str) -> tuple[int, ...]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= CACHE:
                self.known.clear()
            found = self.known[word] = tuple(self.number[t] for t in terms_of(word) if t in self.number)
        return found

    def counts(self, text: str) -> tuple[int, dict[int, int]]:
        """Number of words, and of telling terms."""
        words = Counter(WORD.findall(text.lower()))
        found: dict[int, int] = {}
        for word, n in words.items():
            for t in self._of(word):
                found[t] = found.get(t, 0) + n
        return words.total(), found


class Index:
    """Block-max inverted index of the examples' unit vectors; equal vectors are one entry."""

    def __init__(self, idf: np.ndarray, vectors: list[tuple[int, dict[int, int]]], ids: list, labels: np.ndarray, weights: np.ndarray) -> None:
        self.idf, self.k = idf, NEIGHBOURS
        entries: dict[tuple, int] = {}
        self.entry_of = np.array([entries.setdefault(self._key(*v), len(entries)) for v in vectors], np.int64)
        units = [self.unit(*key_counts(key)) for key in entries]
        order = sorted(range(len(units)), key=lambda e: (int(units[e][0][np.argmax(units[e][1])]) if len(units[e][0]) else -1, tuple(units[e][0]), tuple(units[e][1])))
        rank = np.argsort(np.array(order, np.int64)) if order else np.zeros(0, np.int64)
        self.entry_of = rank[self.entry_of] if len(vectors) else self.entry_of
        units = [units[e] for e in order]
        n, n_terms = len(units), len(idf)
        self.blocks = -(-n // BLOCK)
        self.n = np.bincount(self.entry_of, minlength=n).astype(float)
        self.mass = np.bincount(self.entry_of, weights, n)
        self.toxic = np.bincount(self.entry_of, weights * labels, n)
        self.example = [[] for _ in range(n)]
        for e, i, y in sorted(zip(self.entry_of.tolist(), ids, labels.tolist()), key=lambda x: (x[0], str(x[1]))):
            if len(self.example[e]) < EVIDENCE:
                self.example[e].append((i, int(y)))
        term = np.concatenate([t for t, _ in units]) if n else np.zeros(0, np.int64)
        entry = np.repeat(np.arange(n), [len(t) for t, _ in units])
        weight = np.concatenate([w for _, w in units]) if n else np.zeros(0)
        at = np.lexsort((entry, term))
        self.entry, self.weight = entry[at], weight[at]
        cell = term[at] * self.blocks + self.entry // BLOCK
        self.first = np.searchsorted(cell, np.arange(n_terms * self.blocks + 1)) if self.blocks else np.zeros(1, np.int64)
        self.most = np.zeros(n_terms * self.blocks)
        np.maximum.at(self.most, cell, self.weight)
        self.most = self.most.reshape(n_terms, self.blocks) if self.blocks else np.zeros((n_terms, 0))
        self.steps: tuple[np.ndarray, np.ndarray] = (np.zeros(1), np.zeros(1))
        self.prior = 0.0
        self.cache: dict[tuple, tuple] = {}

    @staticmethod
    def _key(n_words: int, counts: dict[int, int]) -> tuple:
        """Equal for texts with equal vectors: without telling terms the number of words has no effect."""
        return (n_words if counts else min(n_words, 1), *sorted(counts.items()))

    def unit(self, n_words: int, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """Terms in order and their TF-IDF weights; the common term of all words is the last one."""
        if not n_words:
            return np.zeros(0, np.int64), np.zeros(0)
        terms = np.array([*sorted(counts), len(self.idf) - 1], np.int64)
        tf = 1 + np.log(np.array([*(counts[t] for t in sorted(counts)), n_words], float))
        weights = tf * self.idf[terms]
        return terms, weights / math.sqrt(float(weights @ weights))

    def _cosines(self, terms: np.ndarray, weights: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Cosines of all entries of ``blocks``, term after term from the postings."""
        cells = (terms[:, None] * self.blocks + blocks[None, :]).ravel()
        start = self.first[cells]
        size = self.first[cells + 1] - start
        at = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
        return np.bincount(self.entry[at], np.repeat(np.repeat(weights, len(blocks)), size) * self.weight[at], len(self.n))

    def nearest(self, n_words: int, counts: dict[int, int], n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Entries in order of cosine until they hold k examples, with all that tie with the last; and the cosines."""
        n = self.n if n is None else n
        terms, weights = self.unit(n_words, counts)
        if not len(terms) or not self.blocks:
            return np.zeros(0, np.int64), np.zeros(0)
        bound = weights @ self.most[terms]
        order = np.argsort(-bound, kind="stable")
        first = order[:4]
        cosine = self._cosines(terms, weights, first)
        limit = self._kth(cosine, n)
        rest = order[4:]
        rest = np.sort(rest[bound[rest] >= limit - 1e-9])
        if len(rest):
            cosine += self._cosines(terms, weights, rest)
            limit = self._kth(cosine, n)
        near = np.flatnonzero((cosine >= limit) & (cosine > 0) & (n > 0))
        near = near[np.lexsort((near, -cosine[near]))]
        return near, cosine[near]

    def _kth(self, cosine: np.ndarray, n: np.ndarray) -> float:
        """Cosine of the k-th example, 0 if there are fewer."""
        some = np.flatnonzero((cosine > 0) & (n > 0))
        if n[some].sum() < self.k:
            return 0.0
        if len(some) > 4 * self.k:  # every entry holds an example at least
            some = some[np.argpartition(-cosine[some], self.k)[: self.k + 1]]
        some = some[np.argsort(-cosine[some], kind="stable")]
        held = np.cumsum(n[some])
        return float(cosine[some[np.searchsorted(held, self.k)]])

    def vote(self, near: np.ndarray, cosine: np.ndarray, mass: np.ndarray | None = None, toxic: np.ndarray | None = None) -> float:
        mass, toxic = self.mass if mass is None else mass, self.toxic if toxic is None else toxic
        close = 1 / (np.maximum(1 - cosine, 0) + SOFTEN)
        total = float(close @ mass[near])
        return float(close @ toxic[near]) / total if total > 0 else self.prior

    def calibrate(self, vectors: list[tuple[int, dict[int, int]]], labels: np.ndarray, weights: np.ndarray) -> None:
        """Fit the step from votes to rates on the examples, each judged without itself."""
        self.prior = float((weights @ labels) / weights.sum()) if len(labels) else 0.0
        votes = np.zeros(len(labels))
        seen: dict[tuple, float] = {}
        for i, (vector, y, w) in enumerate(zip(vectors, labels, weights)):
            key = (*self._key(*vector), int(y))
            if key not in seen:
                e = self.entry_of[i]
                n, mass, toxic = self.n.copy(), self.mass.copy(), self.toxic.copy()
                n[e], mass[e], toxic[e] = n[e] - 1, mass[e] - w, toxic[e] - w * y
                seen[key] = self.vote(*self.nearest(*vector, n), mass, toxic)
            votes[i] = seen[key]
        self.steps = isotonic(votes, labels, weights)

    def score(self, n_words: int, counts: dict[int, int]) -> tuple[float, np.ndarray, np.ndarray]:
        """Calibrated score, and the nearest entries with their cosines as evidence."""
        key = self._key(n_words, counts)
        found = self.cache.get(key)
        if found is None:
            near, cosine = self.nearest(n_words, counts)
            value = float(np.interp(self.vote(near, cosine), *self.steps)) if len(near) else self.prior
            found = value, near[:EVIDENCE].copy(), cosine[:EVIDENCE].copy()
            if len(self.cache) < 20_000:
                self.cache[key] = found
        return found


def key_counts(key: tuple) -> tuple[int, dict[int, int]]:
    return key[0], dict(key[1:])


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the best non-decreasing fit, by pooling adjacent violators; two votes ease the ends."""
    if not len(x):
        return np.zeros(1), np.zeros(1)
    unit = float(w.mean())
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = [[0.0, 0.0, unit, 0.0, 0.0]]  # x from, sum of y, weight, sum of x, x to
    for xi, yi, wi in [*zip(x[order], y[order], w[order]), (1.0, 1.0, unit)]:
        pools.append([xi, yi * wi, wi, xi * wi, xi])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [pools[-1][0], *(a + b for a, b in zip(pools[-1][1:4], last[1:4])), last[4]]
    points: list[tuple[float, float]] = []
    for p in pools:
        rate = p[1] / p[2]
        points += [(p[0], rate), (p[4], rate)] if p[4] > p[0] else [(p[0], rate)]
    xs, ys = np.array([p[0] for p in points]), np.array([p[1] for p in points])
    return xs, np.clip(ys, 0, 1)


def _examples(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """Texts and labels of the sampled examples, and how many labelled texts each class has.

    An id that is there several times counts once per different text, so repeated rows are one example.
    """
    known = labels.where(learnable(labels) & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    whole = F.xxhash64(F.coalesce("text", F.lit(""))).alias("whole")
    present = staged(docs.select("doc_id", whole).join(known, "doc_id").distinct(), "labelled")  # hashes move, not texts
    sizes = {r["toxic"]: r["n"] for r in present.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    sample = staged(bounded_sample(present, "toxic", PER_CLASS), "sample")
    found = docs.select("doc_id", "text", whole).join(sample, ["doc_id", "whole"])
    return staged(found.groupBy("doc_id", "whole").agg(F.first("text").alias("text"), F.first("toxic").alias("toxic")).drop("whole"), "examples"), sizes


def _telling(examples: DataFrame, sizes: dict[int, int]) -> list[str]:
    """Terms whose presence differs between the classes of the examples."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(texts_of(batch), batch.column("toxic").to_pylist()):
                totals[toxic].update({t for w in set(WORD.findall(text.lower())) for t in terms_of(w)})
        terms = [*set(totals[0]) | set(totals[1])]
        for at in range(0, len(terms), 50_000):
            part = terms[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), *(pa.array([c[t] for t in part], pa.int64()) for c in totals)], names=["term", "n0", "n1"])

    split = {r["toxic"]: r["n"] for r in examples.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    clean, toxic = split.get(0, 0), split.get(1, 0)
    if not clean or not toxic:
        return []
    found = examples.mapInArrow(count, "term string, n0 bigint, n1 bigint").groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    total, seen = clean + toxic, F.col("n0") + F.col("n1")
    chi = total * F.pow(F.col("n1") * (clean - F.col("n0")) - F.col("n0") * (toxic - F.col("n1")), F.lit(2.0)) / (float(clean) * toxic * seen * (total - seen) + 1e-9)
    telling = found.where((seen >= MIN_EXAMPLES) & (F.col("n1") * clean >= MIN_LIFT * F.col("n0") * toxic)).withColumn("chi", chi).where(F.col("chi") >= MIN_CHI)
    return sorted(r["term"] for r in telling.orderBy(F.desc("chi"), "term").limit(MAX_TERMS).collect())


def _document_counts(docs: DataFrame, terms: list[str]) -> tuple[int, np.ndarray]:
    """Number of all documents, and of those with each term, summed up in the tasks."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, total = Terms(terms), np.zeros(len(terms) + 1, np.int64)
        for batch in batches:
            total[-1] += batch.num_rows
            for text in texts_of(batch):
                for t in reader.counts(text)[1]:
                    total[t] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["term", "n"])

    counts = np.zeros(len(terms) + 1, np.int64)
    for row in docs.select("text").mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect():
        counts[row["term"]] = row["n"]
    return int(counts[-1]), counts[:-1]


def learn(docs: DataFrame, labels: DataFrame) -> tuple[list[str], Index]:
    """Telling terms and the calibrated index. Labels are learned from ``learnable`` rows only, a
    document with several labels is toxic if one says so; document frequencies cover all texts."""
    examples, sizes = _examples(docs, labels)
    terms = _telling(examples, sizes)
    n_docs, frequency = _document_counts(docs, terms)
    idf = np.append(np.log((1 + n_docs) / (1 + frequency)) + 1, 1.0)

    def vectors() -> Step:
        reader = Terms(terms)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts = [reader.counts(t) for t in texts_of(batch)]
            columns = [
                batch.column("doc_id"), batch.column("toxic"), pa.array([n for n, _ in counts], pa.int64()),
                pa.array([[*c] for _, c in counts], pa.list_(pa.int64())), pa.array([[*c.values()] for _, c in counts], pa.list_(pa.int64())),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "toxic", "n_words", "terms", "counts"])

        return step

    schema = f"doc_id {id_type(docs)}, toxic {id_type(examples, 'toxic')}, n_words bigint, terms array<bigint>, counts array<bigint>"
    rows = sorted(in_batches(examples, vectors, schema).collect(), key=lambda r: (str(r["doc_id"]), r["n_words"], r["terms"], r["counts"]))
    found = [(r["n_words"], dict(zip(r["terms"], r["counts"]))) for r in rows]
    y = np.array([r["toxic"] for r in rows], float)
    taken = Counter(int(v) for v in y)
    w = np.array([sizes[int(v)] / taken[int(v)] for v in y], float)  # a thinned class counts for all it stands for
    index = Index(idf, found, [r["doc_id"] for r in rows], y, w)
    index.calibrate(found, y, w)
    return terms, index


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and evidence (nearest examples) of every whole text.

    ``labels``: doc_id, toxic. A text without words (missing, empty) and a table without labels
    get the rate of toxic rows among the labelled ones (0 without any) and no evidence. Rows are
    scored one by one, so repeated rows and ids are all returned, alike for alike texts.
    """
    terms, index = learn(docs, labels)
    shared = share(docs.sparkSession, (terms, index))  # at most 2 x PER_CLASS entries of MAX_TERMS terms
    kind = id_type(docs)
    schema = f"doc_id {kind}, score double, evidence array<struct<doc_id:{kind},similarity:double,toxic:int>>"

    def start() -> Step:
        known, found = unpacked(shared)
        reader = Terms(known)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores, evidence = [], []
            for text in texts_of(batch):
                value, near, cosine = found.score(*reader.counts(text))
                scores.append(value)
                best = [{"doc_id": i, "similarity": float(c), "toxic": y} for e, c in zip(near, cosine) for i, y in found.example[e]]
                evidence.append(best[:EVIDENCE])
            ids = batch.column("doc_id")
            kinds = pa.list_(pa.struct([("doc_id", ids.type), ("similarity", pa.float64()), ("toxic", pa.int32())]))
            return pa.RecordBatch.from_arrays([ids, pa.array(scores, pa.float64()), pa.array(evidence, kinds)], names=["doc_id", "score", "evidence"])

        return step

    scored = in_batches(docs.select("doc_id", "text"), start, schema)
    return scored.select("doc_id", (~learnable(scored)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence")


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows scored ``threshold`` or more; columns stay as they are."""
    terms, index = learn(docs, labels)
    shared = share(docs.sparkSession, (terms, index))

    def start() -> Step:
        known, found = unpacked(shared)
        reader = Terms(known)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            return batch.filter(pa.array([found.score(*reader.counts(t))[0] < threshold for t in texts_of(batch)], pa.bool_()))

        return step

    return in_batches(docs, start, docs.schema)


__all__ = ["Index", "Terms", "isotonic", "learn", "score", "terms_of", "without_toxic"]
