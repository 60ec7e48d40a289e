"""Language of a text as a mixture: expectation-maximisation over its words, languages chosen by
penalised likelihood.

A word's likelihood in a language comes from its letter trigrams. Shares of all languages are
fitted first; then the weakest languages are taken away step by step, and the set whose
likelihood, less a charge for every language, is largest is kept.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .common import Step, bounded_sample, id_type, in_batches, learnable, share, texts_of, unpacked

PER_LANGUAGE = 1000  # documents that each language is learned from, at most
SMOOTH = 0.5
ROUNDS = 12
CHARGE = 3.0  # log-likelihood a further language must gain per doubling of e in words
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
CACHE = 200_000
GROUP_WORDS = 400_000


def grams(word: str) -> list[str]:
    padded = f"^{word}$"
    return [padded[i : i + 3] for i in range(len(padded) - 2)]


def words_of(text: str) -> Counter:
    return Counter(w for w in WORD.findall(text.lower()))


class Model:
    """Log-likelihoods of trigrams per language."""

    def __init__(self, languages: list[str], counts: dict[tuple[str, str], int]) -> None:
        self.languages = languages
        column = {x: i for i, x in enumerate(languages)}
        self.number = {g: i for i, g in enumerate(sorted({g for _, g in counts}))}
        table = np.full((len(self.number), len(languages)), SMOOTH)
        for (language, gram), n in counts.items():
            table[self.number[gram], column[language]] += n
        self.log = np.log(table / table.sum(0, keepdims=True)) if len(table) else table
        self.rows: dict[str, int] = {}
        self.words = np.zeros((0, len(languages)))

    def remember(self, words: Iterable[str]) -> None:
        """Rows of log-likelihoods for words not met yet; unknown trigrams say nothing."""
        new = [w for w in words if w not in self.rows]
        if not new:
            return
        places = [[self.number[g] for g in grams(w) if g in self.number] if w.isalpha() or any(map(str.isalpha, w)) else [] for w in new]
        size = np.array([len(p) for p in places])
        total = np.zeros((len(new), len(self.languages)))
        if size.sum():
            flat = self.log[np.concatenate([np.array(p, np.int64) for p in places if p])]
            some = np.flatnonzero(size)
            total[some] = np.add.reduceat(flat, np.cumsum(size[some]) - size[some], axis=0)
        base = len(self.words)
        self.rows.update((w, base + i) for i, w in enumerate(new))
        self.words = np.concatenate([self.words, total])

    def mixtures(self, bags: list[Counter]) -> tuple[np.ndarray, np.ndarray]:
        """Shares of the chosen languages (0 for others) of non-empty bags, and the log-likelihoods."""
        if len(self.rows) > CACHE:
            self.rows.clear()
            self.words = self.words[:0]
        self.remember(dict.fromkeys(w for b in bags for w in b))
        row = np.fromiter((self.rows[w] for b in bags for w in b), np.int64)
        n = np.fromiter((c for b in bags for c in b.values()), float)
        sizes = np.array([len(b) for b in bags])
        return mixtures(self.words[row], n, sizes)


def mixtures(log: np.ndarray, n: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of ``sizes`` words with counts ``n`` and log-likelihoods ``log``: shares and penalised fit."""
    first = np.cumsum(sizes) - sizes
    run = np.repeat(np.arange(len(sizes)), sizes)
    top = log.max(1)
    likely = np.exp(log - top[:, None])
    total = np.add.reduceat(n, first)
    level = np.add.reduceat(n * top, first)
    charge = CHARGE * np.log(total + np.e)
    allowed = np.ones((len(sizes), log.shape[1]), bool)
    best, best_fit = np.zeros(allowed.shape), np.full(len(sizes), -np.inf)
    count = log.shape[1]
    while count:
        share = allowed / count
        for _ in range(ROUNDS if count > 1 else 0):
            part = likely * share[run]
            part *= (n / np.maximum(part.sum(1), 1e-300))[:, None]
            share = np.add.reduceat(part, first, axis=0) / total[:, None]
        fit = level + np.add.reduceat(n * np.log(np.maximum((likely * share[run]).sum(1), 1e-300)), first) - charge * count
        better = fit > best_fit
        best[better], best_fit[better] = share[better], fit[better]
        if count == 1:
            break
        count -= 1
        weakest_first = np.argsort(np.where(allowed, share, -1.0), axis=1, kind="stable")
        allowed = np.zeros_like(allowed)
        np.put_along_axis(allowed, weakest_first[:, -count:], True, axis=1)
    return best, best_fit


def learn(docs: DataFrame) -> Model:
    """Trigram counts of a bounded sample of the learnable documents of each language."""
    known = docs.where(learnable(docs) & F.col("lang").isNotNull()).select("doc_id", "lang")
    sample = staged(bounded_sample(known, "lang", PER_LANGUAGE).distinct(), "sample")
    texts = docs.where(F.col("lang").isNotNull()).select("doc_id", "lang", "text").join(sample, ["doc_id", "lang"])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text, lang in zip(texts_of(batch), batch.column("lang").to_pylist()):
                for word, n in words_of(text).items():
                    for gram in grams(word):
                        total[lang, gram] += n
        keys = [*total]
        columns = [pa.array([k[i] for k in keys], pa.string()) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([total[k] for k in keys], pa.int64())], names=["lang", "gram", "n"])

    counted = texts.select("text", F.col("lang").cast("string").alias("lang")).mapInArrow(count, "lang string, gram string, n bigint")
    rows = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).collect()  # every trigram, so every sampled language with letters
    return Model(sorted({r["lang"] for r in rows}), {(r["lang"], r["gram"]): r["n"] for r in rows})


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score (share of that language), languages and shares.

    A text without letters (missing, empty, digits) and any text where no language was learned
    is ``und`` with score 0; equal shares go to the first language by name. Rows are judged one
    by one, so repeated rows and ids are all returned.
    """
    model = learn(docs)
    shared = share(docs.sparkSession, model)  # bounded by the trigrams of PER_LANGUAGE documents a language
    schema = f"doc_id {id_type(docs)}, lang_pred string, score double, languages array<string>, shares array<double>"

    def start() -> Step:
        found = unpacked(shared)
        names = found.languages

        def judge(bags: list[Counter]) -> Iterator[tuple]:
            some = [b for b in bags if b] if names else []
            shares = iter(found.mixtures(some)[0] if some else ())
            for bag in bags:
                if not bag or not names:
                    yield UNKNOWN, 0.0, [], []
                    continue
                share = next(shares)
                top = int(np.argmax(share))
                there = np.flatnonzero(share > 0)
                yield names[top], min(float(share[top]), 1.0), [names[i] for i in there], share[there].tolist()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out, bags, size = [], [], 0
            for text in texts_of(batch):
                bag = words_of(text)
                if bag and not any(any(map(str.isalpha, w)) for w in bag):
                    bag = Counter()  # numerals that are no letters
                bags.append(bag)
                size += len(bag)
                if size > GROUP_WORDS:
                    out += judge(bags)
                    bags, size = [], 0
            out += judge(bags)
            kinds = (pa.string(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.float64()))
            columns = [pa.array([row[i] for row in out], kind) for i, kind in enumerate(kinds)]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "lang_pred", "score", "languages", "shares"])

        return step

    judged = in_batches(docs.select("doc_id", "text"), start, schema)
    return judged.select("doc_id", (~learnable(judged)).alias("held_out"), "lang_pred", "score", "languages", "shares")
