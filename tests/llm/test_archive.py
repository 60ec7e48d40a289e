import gzip
import hashlib
import random
from base64 import b32encode

import pyarrow as pa
import pytest

from parcelmatch.llm import archive

from .conftest import rows_of

PAGES = "page_id bigint, url string, html string"


@pytest.fixture
def round_trip(spark, tmp_path):
    def run(pages, kind="bigint"):
        archive.write_archive(pages, str(tmp_path / "warc"))
        return archive.read_archive(spark, str(tmp_path / "warc"), kind)

    return run


def expected(rows):
    first = {}
    for page, _, html in rows:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        other = first.get(html or "")
        again = page is not None and other != page
        digest = b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((page, len(raw), digest, "revisit" if again else "response", other if again else None))
    return sorted(out, key=repr)


SHOWN = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def test_pages_come_back(spark, round_trip):
    nasty = "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n\r\n\r\n"
    rows = [
        (1, "http://a.com/x", "same"), (2, "https://www.A.com/x#top", "same"), (3, None, None), (4, "", ""), (5, "http://b.org/\r\nX: y", nasty), (6, "http://b.org", nasty),
        (7, "http://c.net/é", "é\x00💥\n" * 50_000), (None, "http://a.com", "same"), (None, "http://a.com", "same"), (9, "u", "one"), (9, "u", "one"), (9, "u", "two"), (8, "v", "two"),
    ]
    captures = round_trip(spark.createDataFrame(rows, PAGES))
    assert rows_of(captures, *SHOWN) == expected(rows)
    merged = archive.merged_index(captures, range_rows=3)
    assert rows_of(merged, *SHOWN) == expected(rows)
    keys = [tuple(r) for r in merged.select(*archive.KEY).collect()]
    assert keys == sorted(keys)


def test_files_are_archives(spark, tmp_path):
    rows = [(k, f"http://h{k}.com/", f"page {k} " * 50) for k in range(40)]
    archive.write_archive(spark.createDataFrame(rows, PAGES).coalesce(1), str(tmp_path / "w"))
    files = sorted((tmp_path / "w").glob("*.gz"))
    found = [r for f in files for r in archive.records(f.read_bytes())]
    assert len(found) == 40
    whole = gzip.decompress(files[0].read_bytes())
    first = next(archive.records(files[0].read_bytes()))
    assert whole[: first.length].startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and whole[: first.length].endswith(first.payload + b"\r\n\r\n")


def test_several_streams_and_broken_files():
    record = b"WARC/1.1\r\nContent-Length: 10\r\n\r\nA: b\r\n\r\nxy\r\n\r\n"
    packed = gzip.compress(record) + gzip.compress(record + record)
    assert [(r.payload, r.offset) for r in archive.records(packed)] == [(b"xy", k * len(record)) for k in range(3)]
    for broken in (packed[:-40], gzip.compress(record[:-1]), gzip.compress(record.replace(b"10", b"11"))):
        with pytest.raises(ValueError):
            list(archive.records(broken))
    assert list(archive.records(gzip.compress(b""))) == []


def test_a_wrong_digest_is_an_error(spark, tmp_path):
    head = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Date: d\r\nWARC-Payload-Digest: sha1:AAAA\r\nContent-Length: 4\r\n\r\n"
    (tmp_path / "a.gz").write_bytes(gzip.compress(head + b"\r\n\r\n\r\n\r\n"))
    with pytest.raises(Exception, match="does not have the digest"):
        archive.read_archive(spark, str(tmp_path)).collect()


def test_one_url_and_one_payload_with_most_rows(spark, round_trip):
    rows = [(k, "http://hot.com/", "copy" if k % 3 else f"own {k}") for k in range(1500)]
    captures = round_trip(spark.createDataFrame(rows, PAGES))
    merged = archive.merged_index(captures, range_rows=100)
    assert rows_of(merged, *SHOWN) == expected(rows)
    keys = [tuple(r) for r in merged.select(*archive.KEY).collect()]
    assert keys == sorted(keys) and len(set(keys)) == 1500
    sizes = [len(p) for p in merged.rdd.glom().collect()]
    assert max(sizes) < 500


def test_empty_table_other_ids_and_more_columns(spark, round_trip):
    empty = spark.createDataFrame([], PAGES)
    assert archive.merged_index(round_trip(empty)).count() == 0


def test_text_ids_and_clashing_columns(spark, round_trip):
    rows = [("a b/é", "http://x.y", "t", "1", "2", 3), ("b", "http://x.y", "t", "1", "2", 3)]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string, captured string, Body string, refers_to int")
    assert rows_of(archive.merged_index(round_trip(pages, "string")), "page_id", "record_type", "refers_to") == [("a b/é", "response", None), ("b", "revisit", "a b/é")]


def test_loser_tree_merges_runs():
    draw = random.Random(5)
    for _ in range(150):
        runs = [sorted(draw.randint(0, 40) for _ in range(draw.randint(0, 25))) for _ in range(draw.randint(0, 12))]
        blocks = [(k, (r[a],), pa.RecordBatch.from_arrays([pa.array(r[a : a + 3])], names=["x"])) for k, r in enumerate(runs) for a in range(0, len(r), 3)]
        blocks.sort(key=lambda b: (b[1], b[0]))
        got = [b.column(0)[i].as_py() for b, i in archive.merged(blocks, ("x",))]
        assert got == sorted(x for r in runs for x in r)


def test_url_keys():
    same = {archive.url_key(u) for u in ("http://www.A.com/p?q=1#z", "https://a.com:443/p?q=1", "a.com/p?q=1")}
    assert same == {"com,a)/p?q=1"}
    assert archive.url_key("http://a.com") == "com,a)/" and archive.url_key("http://a.com:8080?x") == "com,a:8080)?x" and archive.url_key("") == ")/"
