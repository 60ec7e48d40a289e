"""Token files: ids in canonical length-limited Huffman code, decoded by table in independent blocks.

A token file is a folder of three tables. ``codebook``: length of each id's code. ``segments``:
binary segments of whole documents in ascending id order, with the number of their part and
place. ``index``: ids before each part. A segment is

    magic, documents, blocks, payload bytes          (4s, 3 x uint32, little-endian)
    ids of each document                             (uint64)
    bit offset of each block in the payload          (uint64): the checkpoints
    payload                                          (codes, most significant bit first)

Every document begins at a byte and is cut into blocks of ``BLOCK`` ids, so each block can be
decoded alone; all blocks of a segment are decoded side by side.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import Coder, shared_spec
from .common import Step, id_type, in_batches, partitions, stored, texts_of

END_ID = 2
BLOCK = 512
LIMIT = 16  # bits of a code, if the ids in use allow it
PART_IDS = 64_000_000
SEGMENT_IDS = 1_000_000
CHUNK_IDS = 1_000_000  # coded at once
MAGIC = b"PMH1"
HEAD = "<4s3I"


# Code ----------------------------------------------------------------------------------------

def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``limit`` bits (package-merge); 0 for unused ids."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids do not fit codes of {limit} bits")
    order = used[np.lexsort((used, counts[used]))]
    weights = counts[order].astype(np.float64)  # exact up to 2^53
    # level by level: merge the leaves with the pairs of the level below, remembering how many leaves come first
    levels, pairs = [], np.zeros(0)
    for _ in range(limit):
        both = np.concatenate([weights, pairs])
        at = np.argsort(both, kind="stable")
        levels.append(at < len(weights))
        both = both[at]
        pairs = both[: len(both) // 2 * 2].reshape(-1, 2).sum(1)
    take = 2 * len(weights) - 2
    for is_leaf in reversed(levels):
        leaves = int(is_leaf[:take].sum())
        lengths[order[:leaves]] += 1
        take = 2 * (take - leaves)
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    codes = np.zeros(len(lengths), np.int64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    code = last = 0
    for length in np.unique(lengths[order]):
        members = order[lengths[order] == length]
        code <<= int(length) - last
        codes[members] = code + np.arange(len(members))
        code, last = code + len(members), int(length)
    return codes


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """For the next ``bits`` bits: the id and, in the low five bits, the length of its code."""
    bits = max(int(lengths.max(initial=1)), 1)
    table, codes = np.zeros(1 << bits, np.int64), canonical(lengths)
    order = np.flatnonzero(lengths)
    order = order[np.argsort(codes[order] << (bits - lengths[order]))]
    entries = np.repeat(order << 5 | lengths[order], 1 << (bits - lengths[order]))
    table[: len(entries)] = entries
    return table, bits


def pack(ids: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray, list[np.ndarray]]:
    """Payload of several documents, byte offset of each (and the end), and each one's checkpoints
    relative to its first bit. ``sizes``: ids of each document, none zero."""
    size = lengths[ids]
    ends = np.cumsum(size)
    first = np.concatenate([[0], np.cumsum(sizes)])
    bits_before = np.concatenate([[0], ends])[first]
    offsets = np.concatenate([[0], np.cumsum(-(-np.diff(bits_before) // 8))])
    place = ends - size + np.repeat(offsets[:-1] * 8 - bits_before[:-1], sizes)
    wide = codes[ids].astype(np.uint64) << (64 - (place & 31) - size).astype(np.uint64)
    word = place >> 5
    words = int(offsets[-1] // 4 + 2)
    # codes do not overlap, so adding is the same as setting bits, and exact
    high = np.bincount(word, (wide >> np.uint64(32)).astype(np.float64), words).astype(np.uint64)
    low = np.bincount(word + 1, (wide & np.uint64(0xFFFFFFFF)).astype(np.float64), words).astype(np.uint64)
    payload = (high + low).astype(">u4").tobytes()[: offsets[-1]]
    marks = [place[a:b:BLOCK] - place[a] for a, b in zip(first, first[1:])]
    return payload, offsets, marks


def unpack(payload: bytes, sizes: np.ndarray, marks: np.ndarray, table: np.ndarray, bits: int) -> np.ndarray:
    """All ids: blocks (``sizes`` ids from bit ``marks``) are decoded side by side, one id of each at a time."""
    raw = np.frombuffer(payload + bytes(8), np.uint8).astype(np.int64)
    window = raw[:-4] << 24 | raw[1:-3] << 16 | raw[2:-2] << 8 | raw[3:-1]
    order = np.argsort(-sizes, kind="stable")
    out = np.zeros(int(sizes.sum()), np.int64)
    to = (np.cumsum(sizes) - sizes)[order]
    at, left = marks[order].astype(np.int64), sizes[order]
    mask = (1 << bits) - 1
    live = np.searchsorted(-left, -np.arange(int(left[0]) if len(left) else 0), side="left")  # blocks longer than k
    for k, n in enumerate(live):
        p = at[:n]
        entry = table[window[p >> 3] >> (32 - bits - (p & 7)) & mask]
        out[to[:n] + k] = entry >> 5
        p += entry & 31
    return out


# Segments ------------------------------------------------------------------------------------

def segment(counts: list[int], marks: list[np.ndarray], payloads: list[bytes]) -> bytes:
    starts = np.cumsum([0, *map(len, payloads)])[:-1] * 8
    blocks = np.concatenate([m + s for m, s in zip(marks, starts)]).astype("<u8")
    body = b"".join(payloads)
    return struct.pack(HEAD, MAGIC, len(counts), len(blocks), len(body)) + np.array(counts, "<u8").tobytes() + blocks.tobytes() + body


def read_segment(data: bytes, table: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids per document and all ids of a segment."""
    head = struct.calcsize(HEAD)
    magic, documents, blocks, size = struct.unpack_from(HEAD, data)
    if magic != MAGIC or len(data) != head + 8 * (documents + blocks) + size:
        raise ValueError("not a token segment")
    counts = np.frombuffer(data, "<u8", documents, head).astype(np.int64)
    marks = np.frombuffer(data, "<u8", blocks, head + 8 * documents)
    per_document = -(-counts // BLOCK)
    sizes = np.full(blocks, BLOCK, np.int64)
    sizes[np.cumsum(per_document) - 1] = counts - (per_document - 1) * BLOCK
    return counts, unpack(data[head + 8 * (documents + blocks) :], sizes, marks, table, bits)


# Jobs ----------------------------------------------------------------------------------------

def tokenized(docs: DataFrame, spec: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, n_tokens and the ids of every whole text with ``end_id`` after them, as binary."""
    shared = shared_spec(docs.sparkSession, spec)

    def start() -> Step:
        coder = Coder.of(shared.value)
        kind = id_dtype(max(len(coder.token) - 1, end_id))
        end = np.array([end_id], kind).tobytes()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, data = [], []
            for ids in coder.encode(texts_of(batch)):
                n.append(len(ids) + 1)
                data.append(ids.astype(kind).tobytes() + end)
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(data, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids"])

        return step

    return in_batches(docs.select("doc_id", "text"), start, f"doc_id {id_type(docs)}, n_tokens bigint, ids binary")


def id_dtype(largest: int) -> str:
    return "<u2" if largest < 1 << 16 else "<u4"


def _chunks(data: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Consecutive documents' ids, ``CHUNK_IDS`` at most or one document."""
    at = 0
    while at < len(data):
        to, size = at, 0
        while to < len(data) and (to == at or size + len(data[to]) <= CHUNK_IDS):
            size += len(data[to])
            to += 1
        yield data[at:to]
        at = to


def global_counts(tokens: DataFrame, ids: int) -> np.ndarray:
    """How often each of ``ids`` ids occurs: one row per id and task is shuffled, one per id comes back."""
    kind = id_dtype(ids - 1)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ids, np.int64)
        for batch in batches:
            for some in _chunks([np.frombuffer(x.as_buffer(), kind) for x in batch.column("ids")]):
                total += np.bincount(np.concatenate(some), minlength=ids)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    rows = tokens.select("ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(ids, np.int64)
    for row in rows:
        counts[row["id"]] = row["n"]
    return counts


def _bounds(tokens: DataFrame, parts: int) -> np.ndarray:
    """Ids that divide the documents into parts of about equal size."""
    if parts < 2:
        return np.zeros(0, np.int64)
    shares = [k / parts for k in range(1, parts)]
    found = tokens.agg(F.percentile_approx("doc_id", shares, max(10_000, 20 * parts)).alias("at")).first()["at"]
    return np.array(found or [], np.int64)


def write_token_file(docs: DataFrame, path: str, spec: str, vocabulary: int, end_id: int = END_ID, limit: int = LIMIT) -> None:
    """Encode every whole text and write the token file to ``path``.

    Texts are encoded once; their ids are stored, counted, coded and only then shuffled, by ranges
    of doc_id. Documents that share an id may be spread over several parts. Missing texts count
    as empty and have the end id alone; documents without id come first.
    """
    spark = docs.sparkSession
    tokens = stored(tokenized(docs, spec, end_id), "tokens")
    ids = max(vocabulary, end_id + 1)
    counts = global_counts(tokens, ids)
    lengths = code_lengths(counts, max(limit, int(max((counts > 0).sum(), 1) - 1).bit_length()))
    parts = max(partitions(spark), -(-int(counts.sum()) // PART_IDS))
    coded = _coded(tokens, lengths, _bounds(tokens, parts), id_dtype(ids - 1))
    ordered = coded.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "doc_id", "n_tokens", "payload")
    _segmented(ordered, id_type(docs)).write.parquet(f"{path}/segments")
    spark.createDataFrame(
        pa.table({"id": pa.array(np.flatnonzero(lengths)), "length": pa.array(lengths[lengths > 0])})
    ).coalesce(1).write.parquet(f"{path}/codebook")
    sums = spark.read.parquet(f"{path}/segments").groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row per part
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")).write.parquet(f"{path}/index")


def _coded(tokens: DataFrame, lengths: np.ndarray, bounds: np.ndarray, kind: str) -> DataFrame:
    """doc_id, n_tokens, part, payload, marks (checkpoints) of every document."""

    def start() -> Step:
        codes = canonical(lengths)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            payloads: list[bytes] = []
            marks: list[bytes] = []
            for some in _chunks([np.frombuffer(x.as_buffer(), kind) for x in batch.column("ids")]):
                packed, offsets, places = pack(np.concatenate(some), np.array([len(x) for x in some]), lengths, codes)
                payloads += [packed[a:b] for a, b in zip(offsets, offsets[1:])]
                marks += [m.astype("<u8").tobytes() for m in places]
            numbers = batch.column("doc_id")
            filled = numbers.fill_null(0).to_numpy(zero_copy_only=False)
            low, high = np.searchsorted(bounds, filled, "left"), np.searchsorted(bounds, filled, "right")
            # an id that is several bounds at once has many documents: any part between those will do
            spread = np.array([zlib.crc32(x) for x in payloads], np.int64) % (high - low + 1)
            part = np.where(numbers.is_null().to_numpy(zero_copy_only=False), 0, low + np.where(high - low > 1, spread, 0))
            columns = [numbers, batch.column("n_tokens"), pa.array(part.astype(np.int32)), pa.array(payloads, pa.binary()), pa.array(marks, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "part", "payload", "marks"])

        return step

    return in_batches(tokens, start, f"doc_id {id_type(tokens)}, n_tokens bigint, part int, payload binary, marks binary")


def _segmented(ordered: DataFrame, kind: str) -> DataFrame:
    """Consecutive documents of a part as segments, with the ids before each in its part."""
    schema = f"part int, before bigint, n_ids bigint, doc_ids array<{kind}>, segment binary"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = -1, 0
        waiting: list[tuple] = []

        def flush() -> pa.RecordBatch:
            nonlocal before
            ids, counts, payloads, marks = zip(*waiting)
            total = sum(counts)
            data = segment(counts, [np.frombuffer(m, "<u8").astype(np.int64) for m in marks], payloads)
            columns = [
                pa.array([part], pa.int32()), pa.array([before]), pa.array([total]),
                pa.array([ids], pa.list_(id_arrow)), pa.array([data], pa.binary()),
            ]
            before += total
            waiting.clear()
            return pa.RecordBatch.from_arrays(columns, names=["part", "before", "n_ids", "doc_ids", "segment"])

        size = 0
        for batch in batches:
            id_arrow = batch.column("doc_id").type
            for number, row in zip(batch.column("part").to_pylist(), zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "payload", "marks")))):
                if waiting and (number != part or size + row[1] > SEGMENT_IDS):
                    yield flush()
                    size = 0
                if number != part:
                    part, before = number, 0
                waiting.append(row)
                size += row[1]
        if waiting:
            yield flush()

    return ordered.mapInArrow(run, schema)


def read_token_file(spark: SparkSession, path: str, vocabulary: int, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian 32-bit numbers) of every
    document of a token file, and with ``with_ids`` the ids themselves."""
    lengths = np.zeros(vocabulary, np.int64)
    for row in spark.read.parquet(f"{path}/codebook").collect():  # as many as the vocabulary has at most
        lengths[row["id"]] = row["length"]
    segments = spark.read.parquet(f"{path}/segments")
    placed = segments.join(spark.read.parquet(f"{path}/index").withColumnRenamed("before", "first"), "part")
    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()
    schema = f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else "")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bits = decoding_table(lengths)
        for batch in batches:
            for row in range(batch.num_rows):
                counts, ids = read_segment(batch.column("segment")[row].as_py(), table, bits)
                ends = np.cumsum(counts)
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends - counts, ends)]
                start = batch.column("first")[row].as_py() + batch.column("before")[row].as_py() + ends - counts
                columns = [batch.column("doc_ids")[row].values, pa.array(start), pa.array(counts), pa.array(crc, pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([ids[a:b].tolist() for a, b in zip(ends - counts, ends)], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return placed.select("first", "before", "doc_ids", "segment").mapInArrow(run, schema)
