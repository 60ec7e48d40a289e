"""SimHash near-duplicates found through Golay codes.

A 64-bit fingerprint is cut into three segments. Two fingerprints that differ in at most two
bits agree in one segment and differ in at most one bit of the next (in cyclic order; see
``PAIRS``). So a key is one exact segment with a codeword of the binary Golay code near the next:
decoding gives the nearest codeword, at most three bits away, and words one bit apart have the
same nearest codeword or both lie three bits away. In that case the five codewords four bits
away are keys as well, on the searching side.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.attach import attach
from ..session import staged
from .common import Step, fresh, in_batches, kept
from .components import components

SHINGLE = 3
SEED = 42
MAX_BITS = 2
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, bits
#: (exact, decoded) segments. Two errors leave a segment k free of errors. If both are in one segment, some pair has
#: none; if they are in two, the pair that begins at k has one.
PAIRS = ((0, 1), (1, 2), (2, 0))
HOT = 64
# Fixed value: generator polynomial of the binary Golay code of length 23.
GENERATOR = 0b101011100011
CODE_BITS, CHECK_BITS = 23, 11


# Golay code ----------------------------------------------------------------------------------

def remainder(words: np.ndarray) -> np.ndarray:
    """Syndrome: the remainder of the word as a polynomial."""
    left = words.astype(np.int64)
    for bit in range(CODE_BITS - 1, CHECK_BITS - 1, -1):
        left = np.where(left >> bit & 1, left ^ (GENERATOR << (bit - CHECK_BITS)), left)
    return left


def error_patterns() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the error of up to three bits, and the five of four bits (0 where there are none)."""
    return kept("golay", _error_patterns)


def _error_patterns() -> tuple[np.ndarray, np.ndarray]:
    near, far, filled = np.zeros(1 << CHECK_BITS, np.int64), np.zeros((1 << CHECK_BITS, 5), np.int64), np.zeros(1 << CHECK_BITS, int)
    for weight in range(1, 5):
        patterns = np.array([sum(1 << b for b in bits) for bits in combinations(range(CODE_BITS), weight)])
        for syndrome, pattern in zip(remainder(patterns), patterns):
            if weight < 4:
                near[syndrome] = pattern
            else:
                far[syndrome, filled[syndrome]] = pattern
                filled[syndrome] += 1
    return near, far


def codewords(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest codeword; the codewords four bits away, where the nearest is three away; whether there are any."""
    near, far = error_patterns()
    syndrome = remainder(words)
    others = far[syndrome]
    return words ^ near[syndrome], words[:, None] ^ others, others[:, 0] != 0


def segment(prints: np.ndarray, at: int) -> np.ndarray:
    first, bits = SEGMENTS[at]
    return (prints.view(np.uint64) >> np.uint64(first) & np.uint64((1 << bits) - 1)).astype(np.int64)


def keys(prints: np.ndarray, searching: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): one key per pair of segments, for a searching fingerprint up to six."""
    rows, found = [], []
    every = np.arange(len(prints))
    for number, (exact, decoded) in enumerate(PAIRS):
        base = (np.int64(number) << np.int64(46)) | (segment(prints, exact) << np.int64(CODE_BITS))
        nearest, others, has = codewords(segment(prints, decoded))
        rows.append(every)
        found.append(base | nearest)
        if searching:
            rows.append(np.repeat(every[has], others.shape[1]))
            found.append((base[has, None] | others[has]).ravel())
    return np.concatenate(rows), np.concatenate(found)


# Fingerprints --------------------------------------------------------------------------------

def fingerprint(text: str, size: int = SHINGLE) -> int:
    """Bits set in over half the hashes of the word shingles, as a signed 64-bit number."""
    words = text.encode().lower().split()  # of bytes: A-Z, blanks 20 and 09-0D only
    if not words:
        return 0
    if len(words) < size:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        digest = xxhash.xxh64_intdigest
        hashes = [digest(s, SEED) for s in map(b" ".join, zip(*(words[i:] for i in range(size))))]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    set_bits = np.add.reduce(bits, axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(set_bits, bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, name: str, size: int = SHINGLE) -> DataFrame:
    """``docs`` with the fingerprint of the whole text; texts without words have zero."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), f"`{name}` bigint"])

    def start() -> Step:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            prints = pa.array([fingerprint(t.as_py() or "", size) for t in batch.column("text")], pa.int64())
            return pa.RecordBatch.from_arrays([*batch.columns, prints], names=[*batch.schema.names, name])

        return step

    return in_batches(docs, start, schema)


# Links and groups ----------------------------------------------------------------------------

def _keyed(prints: DataFrame, searching: bool) -> DataFrame:
    def start() -> Step:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            values = batch.column("fp").to_numpy()
            rows, found = keys(values, searching)
            return pa.RecordBatch.from_arrays([pa.array(values[rows]), pa.array(found)], names=["fp", "key"])

        return step

    return in_batches(prints, start, "fp bigint, key bigint")


def _apart(x: str, y: str) -> Column:
    return F.bit_count(F.col(x).bitwiseXOR(F.col(y)))


def links(prints: DataFrame, hot: int = HOT) -> DataFrame:
    """(a, b): links whose components are those of all fingerprints at most two bits apart.

    ``prints``: distinct ``fp``. A key that up to ``hot`` fingerprints are stored under pairs its
    searchers with them and verifies the distance. A larger one would form pairs with the square
    of its size; its fingerprints and searchers are instead linked to all words at most one bit
    away, because two words are at most two bits apart exactly if some word is at most one bit
    from either.
    """
    stored = staged(_keyed(prints, False), "stored")
    sought = staged(_keyed(prints, True), "sought")
    large = staged(stored.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("key", F.lit(True).alias("hot")), "large")
    if large.isEmpty():
        cold_stored, middles = stored, None
    else:
        marked = staged(attach(stored, large, ["key"], F.col("fp")), "marked")
        cold_stored = marked.where("hot is null").select("fp", "key")
        in_large = marked.where("hot").select("fp").unionByName(attach(sought, large, ["key"], F.col("fp"), "inner").select("fp")).distinct()
        near = F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")
        middles = staged(in_large.select("fp", F.explode(near).alias("mid")), "middles")
    other = cold_stored.select("key", F.col("fp").alias("b"))
    pairs = sought.select("key", F.col("fp").alias("a")).join(other, "key").where((F.col("a") < F.col("b")) & (_apart("a", "b") <= MAX_BITS)).select("a", "b")
    if middles is None:
        return pairs
    # every word's smallest neighbour stands for it: a star instead of pairs
    first = staged(middles.groupBy("mid").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n"), "first")
    return pairs.unionByName(middles.join(first, "mid").select("a", F.col("fp").alias("b")).where("a <> b").distinct())


def groups(rows: DataFrame, name: str) -> DataFrame:
    """(fp, first, head): per fingerprint the smallest id of its component and that id's fingerprint.

    ``rows``: doc_id and the fingerprint ``name``. Ids that are missing come last.
    """
    keep = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"), F.col(name).alias("fp"))
    prints = staged(rows.groupBy(F.col(name).alias("fp")).agg(F.min(keep).alias("least")), "prints")
    linked = staged(components(links(prints.select("fp"))), "components")
    rooted = staged(prints.join(linked, prints["fp"] == linked["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "least"), "rooted")
    heads = staged(rooted.groupBy("root").agg(F.min("least").alias("least")), "heads")
    return rooted.select("fp", "root").join(heads, "root").select("fp", F.col("least.id").alias("first"), F.col("least.fp").alias("head"))


def near_duplicates(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row.

    Fingerprints at most two bits apart are linked; component_id is the smallest id that can be
    reached, NULL if all ids of the component are. Texts without words (missing or empty) share
    the fingerprint zero and are linked like others. Repeated rows and ids are all returned.
    """
    rows = staged(with_fingerprint(docs.select("doc_id", "text"), "fp", size).select("doc_id", "fp"), "fingerprints")
    found = staged(groups(rows, "fp"), "groups")
    return rows.join(found, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("first").alias("component_id"))


def one_of_each(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``docs`` reduced to one row per component, the one with the smallest id (and, among rows
    that share that id, the smallest fingerprint; equal ones are interchangeable)."""
    name, no, order, key = (fresh(docs, x) for x in ("_fp", "_no_id", "_order", "_key"))
    rows = staged(with_fingerprint(docs, name, size), "printed")
    found = groups(rows.select("doc_id", name), name)
    spare = F.lit(0).cast(docs.schema["doc_id"].dataType)
    heads = found.where("fp = head").select(
        F.col("fp").alias(name), F.coalesce(F.col("first"), spare).alias(key), F.col("first").isNull().alias(no)
    )
    keyed = rows.withColumn(no, F.col("doc_id").isNull()).withColumn(key, F.coalesce(F.col("doc_id"), spare))
    kept = keyed.join(staged(heads, "heads"), [name, key, no], "left_semi")
    everything = F.xxhash64(*[f"`{c}`" for c in docs.columns])
    place = F.row_number().over(Window.partitionBy(name, key, no).orderBy(everything))
    return kept.withColumn(order, place).where(F.col(order) == 1).select(*[f"`{c}`" for c in docs.columns])
