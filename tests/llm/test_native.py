import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from parcelmatch.llm import quality, sharding, urls

from .conftest import DOCS

# Sharding ------------------------------------------------------------------------------------


def spark_hash(x, k, seed):
    value = 42
    for data in (struct.pack("<q", x), struct.pack("<i", k), struct.pack("<i", seed)):
        value = xxhash.xxh64_intdigest(data, value)
    return value - (1 << 64) if value >> 63 else value


def slow_place(number, total, seed):
    a, b = sharding.grid(total)
    while True:
        left, right = divmod(number, b)
        for k in range(sharding.ROUNDS):
            if k % 2 == 0:
                left = (left + spark_hash(right, k, seed) % a) % a
            else:
                right = (right + spark_hash(left, k, seed) % b) % b
        number = left * b + right
        if number < total:
            return number


@pytest.mark.parametrize("total", [1, 2, 3, 40, 41, 997, 1000, 4096])
def test_permutation_equals_its_definition(spark, total):
    rows = sharding.permuted(spark.range(total), "id", total, 5, "place").collect()
    assert sorted(r["place"] for r in rows) == list(range(total))
    assert all(r["place"] == slow_place(r["id"], total, 5) for r in rows)


def test_shards_are_even_and_slots_gapless(spark, documents):
    draw = random.Random(1)
    rows = [(i, "ö" * draw.randrange(50)) for i in range(1003)]
    draw.shuffle(rows)
    got = sharding.shard_rows(documents(rows)).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(40)) and {len(s) for s in slots.values()} == {25, 26}
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts = dict(rows)
    for r in got:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 16, zlib.crc32(data), "rows", None)
        place = slow_place(r["doc_id"], 1003, 0)
        assert (r["shard"], r["slot"]) == (place % 40, place // 40)
    assert {tuple(r) for r in sharding.shard_rows(documents(rows[::-1])).collect()} == {tuple(r) for r in got}


def test_sharding_of_odd_rows(spark, odd):
    rows = sharding.shard_rows(odd.selectExpr("*", "1 AS number", "2 AS `_pos`"), shards=2).collect()
    assert sorted(Counter(r["shard"] for r in rows).values()) == [4, 5]
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows}[1] == (16, 0)
    assert sharding.shard_rows(spark.createDataFrame([], DOCS)).count() == 0


# Quality -------------------------------------------------------------------------------------

BLANK = r"\x20\x09-\x0D"


def slow_measures(text):
    text = text or ""
    words = re.findall(f"[^{BLANK}]+", text)
    lines = [x for x in text.split("\n") if re.search(f"[^{BLANK}]", x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines),
    }


def test_measures_equal_brute_force(documents, odd):
    draw = random.Random(2)
    texts = ["".join(draw.choices(["a", "b ", "c ", " \n", "#", "é", "\u00a0", "\x1c", "\t", "💥 "], k=draw.randrange(200))) for _ in range(150)]
    docs = documents([*enumerate(texts), (1000, "a b c"), (1001, "a a a a"), (1002, "a b c a b c"), (1003, "a\x00b\n\na\x00b")])
    for table in (docs, odd):
        want = defaultdict(list)
        for r in table.collect():
            want[r["doc_id"]].append(slow_measures(r["text"]))
        for r in quality.measures(table).collect():
            assert {k: r[k] for k in want[r["doc_id"]][0]} in want[r["doc_id"]]


def test_rules_keep_prose_and_drop_junk(spark, documents):
    draw = random.Random(3)
    prose = " ".join(draw.choices(["the", "of", "house", "river", "green", "walked", "and", "seven", "quietly", "into"], k=120)) + "."
    rows = [(1, prose), (2, "word " * 20), (3, prose.replace(" ", "### ")), (4, "the same line\n" * 60), (5, prose.upper()), (6, None)]
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality.judge(documents(rows)).collect()}
    assert got == {1: (False, True), 2: (True, False), 3: (False, False), 4: (True, False), 5: (False, False), 6: (True, False)}
    assert quality.judge(spark.createDataFrame([], DOCS)).count() == 0


def test_only_windows_met_twice_are_sorted(spark, documents):
    """Around the bound up to which hashes are looked up; stop words by a hash set."""
    rows = []
    for n in (1, 2, quality.FEW - 1, quality.FEW, quality.FEW + 1, 3 * quality.FEW):
        twice, once = [f"t{i}" for i in range(n + 2)], [f"o{n}.{i}" for i in range(50)]
        rows.append((len(rows), " ".join([*once[:20], *twice, *once[20:40], *twice, *once[40:]]), 2 * (n + 2)))
    got = {r["doc_id"]: r["n_repeat_words"] for r in quality.measures(documents([r[:2] for r in rows])).collect()}
    assert got == {r[0]: r[2] for r in rows}
    plan = quality.judge(documents([(1, "a b")]))._jdf.queryExecution().optimizedPlan().toString()
    assert "INSET" in plan and "size(array_distinct(" in plan


def test_quality_and_sharding_run_no_python(documents):
    for plan in (quality.judge(documents([(1, "a b")])), sharding.shard_rows(documents([(1, "a b")]))):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", text.replace("ArrowEvalPythonExec", "Python"))


# Urls ----------------------------------------------------------------------------------------

PAGES = "page_id bigint, url string, html string"


def slow_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max((r.text for r in fits), key=len, default=None)


URLS = [
    "http://WWW.Example.com/en/1?x=/fr/", "https://example.com/en/", "https://a.example.com/en", "http://notexample.com/en/", "x://net/es/q#f", "x://a.net/fr",
    "x://a.net/fr/", "x://com", "x://com?a", "x://b.com:80/", "no scheme", None, "", "://", "a://b://c/d", "x://y.org/\n/en/?", "x://éa.net/es/",
]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "<p>the house</p>") for i, u in enumerate(URLS)], PAGES)
    rows = urls.filter_urls(pages).collect()
    assert len(rows) == len(URLS)
    for r in rows:
        host, path, rule = slow_rule(URLS[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), URLS[r["page_id"]]
        assert r["verdict"] in ("allow", "block")
        if rule:
            assert r["verdict"] == next(x.verdict for x in urls.RULES if x.text == rule)


def test_viterbi_cuts_names_into_frequent_words():
    counts = {"spam": 50, "farm": 40, "the": 900, "there": 80, "rein": 5, "in": 500}

    def cut(name):
        found = {(i, n): counts[name[i : i + n]] for i in range(len(name)) for n in range(1, 25) if name[i : i + n] in counts}
        return urls.viterbi(name, found, sum(counts.values()))

    assert cut("spamfarm") == ["spam", "farm"] and cut("therein") == ["there", "in"] and cut("") == []
    assert "".join(cut("xqspamzz")) == "xqspamzz"


def slow_verdicts(pages, words):
    """Naive Bayes over all rows, in plain Python."""
    import math

    total = sum(words.values())

    def tokens(host, path):
        out = []
        for name in [n for n in re.split(r"[^\w]+|[\d_]+", host) if n]:
            found = {(i, n): words[name[i : i + n]] for i in range(len(name)) for n in range(1, 25) if name[i : i + n] in words}
            out += ["h:" + w for w in urls.viterbi(name, found, total)]
        return out, ["p:0" if w.isdigit() else "p:" + w for w in re.split(r"[\W_]+", path.lower()) if w]

    split = {i: slow_rule(u) for i, u in pages}
    verdict = {r.text: r.verdict for r in urls.RULES}
    counts = {"block": Counter(), "allow": Counter()}
    rows = Counter()
    for host, path, rule in split.values():
        if rule:
            rows[verdict[rule]] += 1
            for part in tokens(host, path):
                counts[verdict[rule]].update(part)
    vocabulary = set(counts["block"]) | set(counts["allow"])
    sums = {v: sum(c.values()) + len(vocabulary) for v, c in counts.items()}
    odds = {t: round(1e6 * math.log((counts["block"][t] + 1) / sums["block"] / ((counts["allow"][t] + 1) / sums["allow"]))) for t in vocabulary}
    prior = round(1e6 * math.log(rows["block"] / rows["allow"]))
    out = {}
    for i, (host, path, rule) in split.items():
        score = prior + sum(odds.get(t, 0) for part in tokens(host, path) for t in part)
        out[i] = (verdict[rule], None) if rule else ("block" if score > 0 else "allow", score / 1e6)
    return out


def test_verdicts_equal_plain_naive_bayes(spark):
    draw = random.Random(6)
    words = ["spam", "farm", "green", "house", "river", "casino"]
    rows = []
    for i in range(300):
        host = f"{draw.choice(['www.', '', 'm.'])}{''.join(draw.choices(words, k=2))}.example.{draw.choice(['com', 'net', 'org'])}"
        rows.append((i, f"http://{host}/{draw.choice(['en', 'es', 'fr', 'de'])}/{draw.randrange(99)}", f"<p>{' '.join(draw.choices(words, k=30))}</p><script>casinocasino</script>"))
    rows += [(i, rows[0][1], "") for i in range(300, 400)] + [(400, None, None)]
    counts = Counter(w for _, _, h in rows if h for w in re.findall("[a-z]+", re.sub(r"<script>.*?</script>|<[^>]*>", " ", h)))
    want = slow_verdicts([(i, u) for i, u, _ in rows], counts)
    for r in urls.filter_urls(spark.createDataFrame(rows, PAGES)).collect():
        assert r["verdict"] == want[r["page_id"]][0]
        assert (r["score"] is None) == (want[r["page_id"]][1] is None)
        if r["score"] is not None:
            assert abs(r["score"] - want[r["page_id"]][1]) < 1e-4


def test_urls_of_odd_tables(spark):
    none = spark.createDataFrame([], PAGES)
    assert urls.filter_urls(none).count() == 0
    lone = spark.createDataFrame([(1, "x://y.org/a", None), (1, "x://y.org/a", None), (None, None, None)], PAGES).withColumn("host", F.lit("own"))
    assert [r["verdict"] for r in urls.filter_urls(lone).collect()] == ["allow"] * 3


def test_a_very_long_host_name(spark):
    name = "the" * 3_000
    pages = spark.createDataFrame([(1, f"http://{name}.org/x", "<p>the the</p>"), (2, "http://a.com/", "<p>a</p>"), (3, "http://b.net/es/", None)], "page_id bigint, url string, html string")
    rows = {r["page_id"]: r for r in urls.filter_urls(pages).collect()}
    assert rows[1]["host"] == name + ".org" and rows[1]["verdict"] in ("allow", "block") and rows[2]["verdict"] == "allow"
    words = urls.segmented(pages.selectExpr("split(url, '/')[2] AS host"), urls.word_counts(pages)).where("length(name) > 9").first()["words"]
    assert words == ["the"] * 3_000
