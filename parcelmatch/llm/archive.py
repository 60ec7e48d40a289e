"""Web pages as WARC files, read back into one index in URL and time order.

Every distinct payload is stored once: the page with the smallest id is a ``response``, pages with an
equal payload are ``revisit`` records that name it. The index is made by an external merge: tasks
sort captures into runs, runs are cut at range borders into small blocks, and each range merges the
blocks of all its runs through a loser tree. A block is opened only when the merge gets to its first
capture, so a task holds about one block per run, however many captures a URL has.
"""

from __future__ import annotations

import hashlib
import zlib
from base64 import b32encode
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.attach import attach
from ..session import staged
from .common import partitions

RECORDS_BYTES = 32 << 20  # payload bytes of a file, about
RUN = 50_000  # captures that a task sorts at once
BLOCK = 64  # captures of a block of a run
RANGE_ROWS = 200_000  # captures of a range, about
MAX_RANGES = 4096
BORDER_SAMPLE = 32  # captures looked at per range to place the borders
CHUNK = 1 << 20  # bytes unpacked at once

# Marks of the file format and the digits of base 32.
CRLF = "\r\n"
END = CRLF + CRLF
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:page:"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE32_PLAIN = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base-32 SHA-1: eight digits from every ten hex digits."""
    hexed = F.sha1(data)
    digits = [F.lpad(F.conv(F.substring(hexed, k, 10), 16, 32), 8, "0") for k in (1, 11, 21, 31)]
    return F.translate(F.concat(*digits), BASE32_PLAIN, BASE32)


def captured_at(pages: DataFrame) -> Column:
    """The time of a capture where the table has none: seconds from the epoch, by page id; 0 without a number."""
    return F.timestamp_seconds(F.coalesce(F.expr("try_cast(page_id AS bigint)") % F.lit(1 << 32), F.lit(0)))


def roles(pages: DataFrame) -> DataFrame:
    """(page_id, whole, refers_to, refers_url, refers_time): the pages that revisit another, one row per id and payload.

    Only ids and hashes are shuffled. A hash that a third of all pages share is reduced before the
    shuffle, and its pages fetch the result by salted keys.
    """
    known = pages.where("page_id IS NOT NULL").groupBy("whole", "page_id").agg(F.min(F.struct("url", "captured")).alias("where"))
    light = staged(known, "payload-hashes")
    firsts = light.groupBy("whole").agg(F.min(F.struct("page_id", "where")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    found = attach(light.drop("where"), firsts, ["whole"], F.col("page_id"), "inner").where(F.col("page_id") > F.col("first.page_id"))
    return staged(found.selectExpr("page_id", "whole", "first.page_id AS refers_to", "first.where.url AS refers_url", "first.where.captured AS refers_time"), "revisits")


def write_archive(pages: DataFrame, path: str, captured: Column | None = None) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) as WARC files below ``path``.

    Missing html is an empty payload, a missing url an empty one, a page without id is always a
    response. Repeated ids with an equal payload have the same role. ``captured`` is the time of a capture.
    Files are whole gzip streams, written by Spark's own writer, so any store will do.
    """
    when = captured_at(pages) if captured is None else captured
    clean = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20")
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", clean.alias("url"), payload.alias("payload"), F.date_trunc("second", when).alias("captured"))
    rows = rows.withColumn("whole", F.unhex(F.sha2(F.col("payload").cast("binary"), 256)))
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("payload")), F.lit(0)).alias("size")).first()
    records = max(1, int(total["n"] * RECORDS_BYTES / max(total["size"], RECORDS_BYTES)))
    joined = rows.join(roles(rows.drop("payload")), ["page_id", "whole"], "left")

    def uri(name: str) -> Column:
        return F.concat(F.lit(f"<{ID_PREFIX}"), F.coalesce(F.url_encode(F.col(name).cast("string")), F.lit("")), F.lit(">"))

    def stamp(name: str) -> Column:
        return F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss'Z'")

    repeat = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length("payload").cast("string"), F.lit(END)
    )
    about = F.when(repeat, F.concat(
        F.lit(f"WARC-Profile: {PROFILE}{CRLF}WARC-Refers-To: "), uri("refers_to"), F.lit(f"{CRLF}WARC-Refers-To-Target-URI: "), F.col("refers_url"),
        F.lit(f"{CRLF}WARC-Refers-To-Date: "), stamp("refers_time"), F.lit(CRLF),
    )).otherwise("")
    body = F.when(repeat, http).otherwise(F.concat(http, "payload"))
    record = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.when(repeat, "revisit").otherwise("response"), F.lit(f"{CRLF}WARC-Record-ID: "), uri("page_id"),
        F.lit(f"{CRLF}WARC-Target-URI: "), F.col("url"), F.lit(f"{CRLF}WARC-Date: "), stamp("captured"),
        F.lit(f"{CRLF}WARC-Payload-Digest: sha1:"), base32_sha1(F.col("payload").cast("binary")), F.lit(CRLF), about,
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}Content-Length: "), F.octet_length("body").cast("string"), F.lit(END), F.col("body"),
    )
    text = joined.withColumn("body", body).select(record.alias("value"))
    text.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records).text(path)


# Reading -------------------------------------------------------------------------------------

class Stream:
    """Bytes of a gzip file, unpacked as they are asked for."""

    def __init__(self, packed: bytes) -> None:
        self.rest, self.next, self.unpacker = memoryview(packed), b"", zlib.decompressobj(31)
        self.have, self.place = bytearray(), 0

    def _more(self) -> bool:
        """Unpack some more; False at the end. Files may be several streams one after the other."""
        while True:
            if not self.next:
                self.next, self.rest = bytes(self.rest[:CHUNK]), self.rest[CHUNK:]
            if self.unpacker.eof:
                if not self.next:
                    return False
                self.unpacker = zlib.decompressobj(31)
            new = self.unpacker.decompress(self.next, CHUNK)
            if not new and not self.next:
                raise ValueError("an archive ends within its packed data")
            self.next = self.unpacker.unused_data if self.unpacker.eof else self.unpacker.unconsumed_tail
            if new:
                self.have += new
                return True

    def take(self, size: int) -> bytes:
        while len(self.have) < size:
            if not self._more():
                raise ValueError("an archive ends within a record")
        out = bytes(self.have[:size])
        del self.have[:size]
        self.place += size
        return out

    def until(self, mark: bytes) -> bytes | None:
        """Up to and without ``mark``, which is passed over; None at the end."""
        looked = 0
        while (at := self.have.find(mark, looked)) < 0:
            looked = max(0, len(self.have) - len(mark) + 1)
            if not self._more():
                if self.have:
                    raise ValueError("an archive ends within a header")
                return None
        out = self.take(at)
        self.take(len(mark))
        return out


def _fields(header: str) -> dict[str, str]:
    lines = header.split(CRLF)[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}


class Record(NamedTuple):
    head: dict[str, str]
    http: dict[str, str]
    payload: bytes
    offset: int
    length: int


def records(packed: bytes) -> Iterator[Record]:
    """The records of a file one after the other; offsets are places in the unpacked file."""
    stream = Stream(packed)
    while True:
        offset = stream.place
        header = stream.until(END.encode())
        if header is None:
            return
        head = _fields(header.decode())
        block = stream.take(int(head["content-length"]))
        if stream.take(len(END)) != END.encode():
            raise ValueError(f"the record at {offset} does not end where its length says")
        http, _, payload = block.partition(END.encode())
        yield Record(head, _fields(http.decode()), payload, offset, stream.place - offset)


def url_key(url: str) -> str:
    """Sort key of a URL: host labels from the last to the first, then path and query; scheme, ``www.`` and fragment do not count."""
    rest = url.split("#", 1)[0].split("://", 1)[-1]
    cut = min((rest.find(c) for c in "/?" if c in rest), default=len(rest))
    host, path = rest[:cut].lower().rsplit("@", 1)[-1], rest[cut:] or "/"
    name, _, port = host.partition(":")
    labels = name.removeprefix("www.").split(".")
    return f"{','.join(reversed(labels))}{':' + port if port not in ('', '80', '443') else ''}){path}"


def _page(uri: str) -> str | None:
    from urllib.parse import unquote_plus

    return unquote_plus(uri.strip("<>").removeprefix(ID_PREFIX)) or None


_CAPTURE = (
    "url_key string, captured string, page string, file string, offset bigint, length bigint, url string, record_type string, refers string, "
    "payload_digest string, payload_bytes bigint"
)
KEY = ("url_key", "captured", "page", "file", "offset")


def read_archive(spark: SparkSession, path: str, id_kind: str = "bigint") -> DataFrame:
    """One row per record of the archives below ``path``, in the order of the files.

    Lengths and digests come from the payloads of responses (a digest that differs from its header is
    an error) and from the headers of revisits, which hold none. Files are unpacked piece by piece.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(path).select("path", "content")

    def captures(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        names = [f.split(" ")[0] for f in _CAPTURE.split(", ")]
        kinds = [pa.int64() if " bigint" in f else pa.string() for f in _CAPTURE.split(", ")]

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        rows: list[tuple] = []
        for batch in batches:
            for i in range(batch.num_rows):
                file = batch.column("path")[i].as_py()
                for r in records(batch.column("content")[i].as_py()):
                    head, kind, url = r.head, r.head["warc-type"], r.head.get("warc-target-uri", "")
                    told = head["warc-payload-digest"].removeprefix("sha1:")
                    size = len(r.payload) if kind == "response" else int(r.http["content-length"])
                    if kind == "response" and told != b32encode(hashlib.sha1(r.payload).digest()).decode():
                        raise ValueError(f"{file}: the payload at {r.offset} does not have the digest of its header")
                    refers = _page(head["warc-refers-to"]) if kind == "revisit" else None
                    page = _page(head["warc-record-id"])
                    rows.append((url_key(url), head["warc-date"], page or "", file, r.offset, r.length, url or None, kind, refers, told, size))
                    if len(rows) >= 5000:
                        yield packed(rows)
                        rows = []
        if rows:
            yield packed(rows)

    found = files.mapInArrow(captures, _CAPTURE)
    ids = {"page_id": F.expr(f"CAST(nullif(page, '') AS {id_kind})"), "refers_to": F.expr(f"CAST(refers AS {id_kind})")}
    return staged(found, "captures").withColumns(ids)


# Merging -------------------------------------------------------------------------------------

class LoserTree:
    """The least of the heads of many sorted sequences, found again with one comparison per level.

    Inner nodes keep the loser of their match, so after the winner moves on only the matches on its
    way to the top are played again. A place without a sequence loses all matches.
    """

    def __init__(self) -> None:
        self.heads: list[tuple | None] = [None]
        self.tree = [0]

    def _less(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or x < y)

    def _rebuild(self, size: int) -> None:
        self.heads += [None] * (size - len(self.heads))
        self.tree = [0] * size
        won = [0] * size + list(range(size))
        for node in range(size - 1, 0, -1):
            a, b = won[2 * node], won[2 * node + 1]
            won[node], self.tree[node] = (a, b) if not self._less(b, a) else (b, a)
        self.tree[0] = won[1] if size > 1 else 0

    def put(self, place: int, head: tuple | None) -> None:
        """A new head at a place that need not be the winner's."""
        if place >= len(self.heads):
            self._rebuild(max(2, 1 << place.bit_length()))
        if place == self.tree[0]:
            self.advance(head)
        else:
            self.heads[place] = head
            self._rebuild(len(self.heads))

    def advance(self, head: tuple | None) -> None:
        """The winner's next head."""
        winner = self.tree[0]
        self.heads[winner] = head
        node = (winner + len(self.heads)) // 2
        while node >= 1 and len(self.heads) > 1:
            if self._less(self.tree[node], winner):
                winner, self.tree[node] = self.tree[node], winner
            node //= 2
        self.tree[0] = winner

    def top(self) -> tuple[int, tuple | None]:
        return self.tree[0], self.heads[self.tree[0]]


class _Run:
    """What is open of one run: its blocks that the merge has reached."""

    def __init__(self) -> None:
        self.blocks: list[tuple[pa.RecordBatch, list[tuple]]] = []
        self.at = 0

    def head(self) -> tuple | None:
        return self.blocks[0][1][self.at] if self.blocks else None

    def step(self) -> None:
        self.at += 1
        if self.at == len(self.blocks[0][1]):
            self.blocks.pop(0)
            self.at = 0


def keys_of(batch: pa.RecordBatch, names: tuple[str, ...] = KEY) -> list[tuple]:
    return list(zip(*(batch.column(n).to_pylist() for n in names)))


def merged(blocks: Iterable[tuple[object, tuple, pa.RecordBatch]], names: tuple[str, ...] = KEY) -> Iterator[tuple[pa.RecordBatch, int]]:
    """(block, row) of all captures in key order, from (run, first key, block) in the order of first keys."""
    tree, runs, numbers, idle = LoserTree(), [], {}, []
    waiting = iter(blocks)
    following = next(waiting, None)
    while True:
        place, head = tree.top()
        while following is not None and (head is None or following[1] <= head):
            run, _, block = following
            if run not in numbers:
                numbers[run] = idle.pop() if idle else len(runs)
                if numbers[run] == len(runs):
                    runs.append(_Run())
            number = numbers[run]
            was = runs[number].head()
            runs[number].blocks.append((block, keys_of(block, names)))
            if was is None:
                tree.put(number, runs[number].head())
            following = next(waiting, None)
            place, head = tree.top()
        if head is None:
            return
        block, _ = runs[place].blocks[0]
        yield block, runs[place].at
        runs[place].step()
        tree.advance(runs[place].head())


def _borders(captures: DataFrame, ranges: int) -> list[tuple]:
    """Keys that part the captures into about equal ranges, from a bounded sample by hash of the key.

    The sample only says where ranges end; every capture is merged wherever they do.
    """
    want = ranges * BORDER_SAMPLE
    n = captures.count()
    space = 1 << 31
    near = captures.select(*KEY).where(F.xxhash64(*KEY).bitwiseAND(F.lit(space - 1)) * F.lit(float(n)) < F.lit(2.0 * want * space))
    keys = sorted(tuple(r) for r in near.limit(4 * want).collect())  # twice the wanted number is expected
    return sorted({keys[len(keys) * k // ranges] for k in range(1, ranges)}) if keys else []


def merged_index(captures: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``captures`` in the order of URL key, time, page, file and place: the history of every URL.

    Partitions follow one another in that order. Each row of ``captures`` is there once; an empty
    table has no rows. Keys are unique, because no two records share file and place, so even one URL
    with a third of all captures is spread over ranges.
    """
    spark = captures.sparkSession
    ranges = min(MAX_RANGES, max(partitions(spark), -(-captures.count() // range_rows)))
    borders = _borders(captures, ranges)
    columns = captures.columns
    fields = captures.schema

    def runs(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number, held, rows = TaskContext.get().partitionId(), 0, [], 0

        def blocks(table: pa.Table) -> Iterable[pa.RecordBatch]:
            ordered = table.sort_by([(k, "ascending") for k in KEY]).combine_chunks()
            if not ordered.num_rows:
                return
            batch = ordered.to_batches()[0]
            keys = keys_of(batch)
            cut, at = [], 0
            while at < len(keys):
                part = bisect_right(borders, keys[at])
                stop = min(at + BLOCK, len(keys))
                if part < len(borders):
                    while keys[stop - 1] >= borders[part]:  # at most a block is looked through
                        stop -= 1
                packed = pa.BufferOutputStream()
                with pa.ipc.new_stream(packed, batch.schema) as out:
                    out.write_batch(batch.slice(at, stop - at))
                cut.append((part, *keys[at], f"{task}-{number}", packed.getvalue().to_pybytes()))
                at = stop
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*cut), _BLOCK_KINDS)], names=_BLOCK_NAMES)

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= RUN:
                yield from blocks(pa.Table.from_batches(held))
                held, rows, number = [], 0, number + 1
        if rows:
            yield from blocks(pa.Table.from_batches(held))

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        def opened() -> Iterator[tuple[object, tuple, pa.RecordBatch]]:
            for batch in batches:
                for i, key in enumerate(keys_of(batch)):
                    yield batch.column("run")[i].as_py(), key, pa.ipc.open_stream(batch.column("block")[i].as_buffer()).read_next_batch()

        held: dict[int, tuple[pa.RecordBatch, int]] = {}
        places: list[int] = []

        def flush() -> pa.RecordBatch:
            whole = pa.Table.from_batches([b for b, _ in held.values()]).take(pa.array(places, pa.int64())).combine_chunks()
            held.clear()
            places.clear()
            return whole.to_batches()[0]

        size = 0
        for block, row in merged(opened()):
            if id(block) not in held:
                held[id(block)] = (block, size)
                size += block.num_rows
            places.append(held[id(block)][1] + row)
            if len(places) >= 4096:
                yield flush()
                size = 0
        if places:
            yield flush()

    cut = captures.select(*columns).mapInArrow(runs, _BLOCK_DDL)
    dealt = staged(cut, "run-blocks").repartitionByRange(ranges, "part").sortWithinPartitions("part", *KEY, "run")
    return dealt.mapInArrow(merge, fields)


_BLOCK_DDL = "part int, url_key string, captured string, page string, file string, offset bigint, run string, block binary"
_BLOCK_NAMES = [f.split(" ")[0] for f in _BLOCK_DDL.split(", ")]
_BLOCK_KINDS = [pa.int32(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.binary()]
