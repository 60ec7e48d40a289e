"""URL filter: rules first, then naive Bayes over the words of host and path.

Names in hosts are often several words run together; a unigram Viterbi cuts them. Word counts come
from the pages' visible text, class counts from the urls that the rules decide.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.attach import attach
from ..session import staged
from .common import Step, in_batches

LONGEST = 24  # letters of a word
SMOOTH = 1.0
MICRO = 1_000_000  # log-odds are added as whole millionths, so their order does not matter


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?`` or ``#``, A-Z lower-cased."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def deciding(rules: Sequence[Rule], value: str) -> Column:
    """``value`` (text or verdict) of the longest rule that fits host and path, else NULL."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)) & F.col("path").startswith(rule.path)
        found = F.when(fits, F.lit(getattr(rule, value))).otherwise(found)
    return found


def judged_by_rules(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    split = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return split.withColumns({"rule": deciding(rules, "text"), "ruled": deciding(rules, "verdict")})


# Words ---------------------------------------------------------------------------------------

def word_counts(pages: DataFrame) -> DataFrame:
    """(word, n) of the visible text of all pages; counted per task before the shuffle."""
    visible = F.regexp_replace(F.col("html"), r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>", " ")
    words = F.explode(F.split(F.lower(visible), r"[^\p{L}]+"))
    return pages.select(words.alias("word")).where((F.length("word") > 0) & (F.length("word") <= LONGEST)).groupBy("word").agg(F.count("*").alias("n"))


def names_of(host: Column) -> Column:
    """Runs of letters of a host."""
    return F.filter(F.split(host, r"[^\p{L}]+"), lambda x: x != "")


def segmented(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, words): every run of letters of ``hosts`` (host), cut into its likeliest words.

    Only the substrings of names look up their counts, by a join, so the vocabulary may have any
    size. Unknown strings cost more the longer they are; equal splits prefer longer first words.
    """
    distinct = hosts.select(F.explode(names_of(F.col("host"))).alias("name")).distinct()
    names = staged(distinct.withColumn("number", F.monotonically_increasing_id()), "names")
    # A name may be long, so no row but its own holds it: the others have its number.
    rests = F.transform(F.sequence(F.lit(0), F.length("name") - 1), lambda at: F.struct(at.alias("at"), F.substring("name", at + 1, F.lit(LONGEST)).alias("rest")))
    starts = names.select("number", F.inline(rests))
    pieces = starts.select("number", "at", "rest", F.explode(F.sequence(F.lit(1), F.length("rest"))).alias("size"))
    pieces = pieces.select("number", "at", "size", F.expr("left(rest, size)").alias("word"))
    known = staged(counts, "words")
    wanted = staged(pieces.select("word").distinct().join(known, "word"), "wanted")
    found = attach(staged(pieces, "pieces"), wanted, ["word"], F.col("number"), "inner").groupBy("number").agg(F.collect_list(F.struct("at", "size", "n")).alias("pieces"))
    total = known.agg(F.sum("n").alias("n")).first()["n"] or 0  # one row
    each = names.join(found, "number", "left").select("name", "pieces")

    def start() -> Step:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column("name").to_pylist()
            words = [viterbi(t, {(p["at"], p["size"]): p["n"] for p in ps or ()}, total) for t, ps in zip(texts, batch.column("pieces").to_pylist())]
            return pa.RecordBatch.from_arrays([batch.column("name"), pa.array(words, pa.list_(pa.string()))], names=["name", "words"])

        return step

    return in_batches(each, start, "name string, words array<string>")


def viterbi(name: str, counts: dict[tuple[int, int], int], total: int) -> list[str]:
    """The split with the largest product of unigram probabilities."""
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(name) + 1):
        choices = []
        for size in range(1, min(LONGEST, end) + 1):
            n = counts.get((end - size, size))
            cost = math.log((total + 1) / n) if n else math.log(total + 1) + math.log(10) * size
            choices.append((best[end - size][0] + cost, end - size))
        best.append(min(choices))
    words, end = [], len(name)
    while end:
        words.append(name[best[end][1] : end])
        end = best[end][1]
    return words[::-1]


# Naive Bayes ---------------------------------------------------------------------------------

def path_tokens(path: Column) -> Column:
    """Words of a path; numbers count as one token."""
    words = F.filter(F.split(F.lower(path), r"[^\p{L}\p{N}]+"), lambda x: x != "")
    return F.transform(words, lambda x: F.when(x.rlike(r"^\p{N}+$"), F.lit("p:0")).otherwise(F.concat(F.lit("p:"), x)))


def host_tokens(urls: DataFrame, names: DataFrame) -> DataFrame:
    """(host, token, n) of every distinct host."""
    hosts = staged(urls.select("host").distinct().select("host", F.explode(names_of(F.col("host"))).alias("name")), "host-names")
    cut = attach(hosts, staged(names, "segmented"), ["name"], F.col("host"), "inner")
    marked = F.transform("words", lambda w: F.concat(F.lit("h:"), w))
    return cut.select("host", F.explode(marked).alias("token")).groupBy("host", "token").agg(F.count("*").alias("n"))


def log_odds(urls: DataFrame, hosts: DataFrame) -> tuple[DataFrame, int]:
    """(token, odds) of block against allow in millionths, and the prior; learned from ruled urls.

    Urls are counted per host and verdict first, so a hot host is one row.
    """
    ruled = urls.where("ruled is not null")
    both = [F.sum(F.when(F.col("ruled") == v, F.col("m"))).alias(v) for v in ("block", "allow")]
    per_host = ruled.groupBy("host", "ruled").agg(F.count("*").alias("m"))
    from_hosts = per_host.join(hosts, "host").select("token", "ruled", (F.col("m") * F.col("n")).alias("m"))
    per_path = ruled.groupBy("path", "ruled").agg(F.count("*").alias("m"))
    from_paths = per_path.select(F.explode(path_tokens(F.col("path"))).alias("token"), "ruled", "m")
    tokens = staged(from_hosts.unionByName(from_paths).groupBy("token").agg(*both).na.fill(0), "tokens")
    sums = tokens.agg(F.count("*").alias("v"), F.sum("block").alias("block"), F.sum("allow").alias("allow")).first()
    rows = {r["ruled"]: r["n"] for r in ruled.groupBy("ruled").agg(F.count("*").alias("n")).collect()}  # two rows
    if len(rows) < 2:
        return tokens.select("token", F.lit(0).cast("bigint").alias("odds")), 0
    prior = round(MICRO * math.log(rows["block"] / rows["allow"]))
    share = {v: (F.col(v) + SMOOTH) / (sums[v] + SMOOTH * sums["v"]) for v in ("block", "allow")}
    return tokens.select("token", F.round(F.log(share["block"] / share["allow"]) * MICRO).cast("bigint").alias("odds")), prior


def filter_urls(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and score (log-odds of block, NULL under a rule).

    The longest fitting rule decides; else block if the score is above 0. A missing url or one
    without ``://`` has empty host and path and only the prior to judge by; without ruled urls
    of both verdicts everything else is allowed. Repeated rows are all returned, alike.
    """
    urls = staged(judged_by_rules(pages, rules), "urls")
    hosts = staged(host_tokens(urls, segmented(urls.select("host").distinct(), word_counts(pages))), "host-tokens")
    odds, prior = log_odds(urls, hosts)
    model = staged(odds, "odds")
    host_score = attach(hosts, model, ["token"], F.col("host"), "inner").groupBy("host").agg(F.sum(F.col("odds") * F.col("n")).alias("host_odds"))
    open_urls = urls.where("ruled is null")
    paths = staged(open_urls.select("path").distinct().select("path", F.explode(path_tokens(F.col("path"))).alias("token")), "path-tokens")
    path_score = attach(paths, model, ["token"], F.col("path"), "inner").groupBy("path").agg(F.sum("odds").alias("path_odds"))
    spread = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    one = staged(attach(urls, staged(host_score, "host-scores"), ["host"], F.concat(spread, "path")), "with-host")
    two = attach(one, staged(path_score, "path-scores"), ["path"], F.concat(spread, "host"))
    score = F.coalesce("host_odds", F.lit(0)) + F.coalesce("path_odds", F.lit(0)) + F.lit(prior)
    verdict = F.coalesce("ruled", F.when(score > 0, "block").otherwise("allow"))
    return two.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.when(F.col("ruled").isNull(), score / MICRO).alias("score"))
