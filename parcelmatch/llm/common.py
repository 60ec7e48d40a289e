"""What the operators share: batch-wise Python steps, objects kept by a worker, texts, fresh names."""

from __future__ import annotations

import ctypes
import hashlib
import pickle
import sys
import types
import uuid
from collections.abc import Callable, Iterable, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.attach import attach
from ..session import staging_root

SHARED_BYTES = 256 << 20  # of a model that every worker loads
SLICE_BYTES = 4 << 20  # about as much of a batch is worked on at once

Step = Callable[[pa.RecordBatch], pa.RecordBatch | None]


def in_batches(df: DataFrame, start: Callable[[], Step], schema: str | StructType) -> DataFrame:
    """Apply ``start()``'s step to every Arrow batch, a few megabytes at a time; ``start`` runs once per task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        step = start()
        for batch in batches:
            rows = max(batch.num_rows // (1 + batch.nbytes // SLICE_BYTES), 1)
            for at in range(0, batch.num_rows, rows):
                out = step(batch.slice(at, rows))
                if out is not None:
                    yield out
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Freed memory goes back to the system, as a worker may wait long for its next task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's; others have none
    if trim:
        trim(0)


def kept(key: object, make: Callable[[], object]) -> object:
    """An object that is slow to build and stays in the Python worker until another one is asked for.

    There is one at a time, so the models of several jobs do not add up.
    """
    home = sys.modules.setdefault("_parcelmatch_worker", types.ModuleType("_parcelmatch_worker"))
    slot = home.__dict__.setdefault("slot", {})
    if key not in slot:
        slot.clear()
        slot[key] = make()
    return slot[key]


def share(spark: SparkSession, value: object) -> Broadcast:
    """A broadcast of an object whose class the executors need not have; one of more than ``SHARED_BYTES`` is refused."""
    packed = cloudpickle.dumps(value)
    if len(packed) > SHARED_BYTES:
        raise ValueError(f"{type(value).__name__} of {len(packed)} bytes is too large to share with every worker")
    return spark.sparkContext.broadcast(packed)


def unpacked(shared: Broadcast) -> object:
    """The object of ``share``, built once per worker."""
    return kept(hashlib.sha256(shared.value).digest(), lambda: pickle.loads(shared.value))


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Whole texts; a missing one is empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def with_text(batch: pa.RecordBatch, texts: Sequence[str | None]) -> pa.RecordBatch:
    """The batch with new texts and, where there is such a column, their length in code points."""
    columns = []
    for field, column in zip(batch.schema, batch.columns):
        if field.name == "text":
            column = pa.array(texts, field.type)
        elif field.name == "n_chars":
            column = pa.array([None if t is None else len(t) for t in texts], field.type)
        columns.append(column)
    return pa.RecordBatch.from_arrays(columns, schema=batch.schema)


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` lacks, ignoring case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_type(df: DataFrame, name: str = "doc_id") -> str:
    return df.schema[name].dataType.simpleString()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def learnable(df: DataFrame):
    """True for rows whose labels may be learned: crc32 of the id as text, mod 3, is not 1."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 != 1


def stored(df: DataFrame, label: str) -> DataFrame:
    """Like ``staged``, packed more tightly: for tables about as large as the input."""
    spark = df.sparkSession
    path = f"{staging_root(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_sample(rows: DataFrame, key: str, per_key: int) -> DataFrame:
    """At most ``per_key`` rows for each value of ``key``: those whose doc_id has the smallest hash.

    Rows fetch the size of their key by salted keys and are thinned by their hash to about twice the bound, so
    no task holds a hot key: the sort gets about 2 x ``per_key`` rows of each. ``rows`` is read twice. Rows without a key go.
    """
    space = 1 << 31
    at, n, place = (fresh(rows, x) for x in ("_at", "_n", "_place"))
    rows = rows.where(F.col(key).isNotNull())
    counts = rows.groupBy(key).agg(F.count("*").alias(n))
    thinned = attach(rows, counts, [key], F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "inner")
    thinned = thinned.withColumn(at, F.xxhash64("doc_id").bitwiseAND(F.lit(space - 1))).where(F.col(at) * F.col(n) < F.lit(2.0 * per_key * space))
    first = Window.partitionBy(key).orderBy(at, "doc_id")
    return thinned.withColumn(place, F.row_number().over(first)).where(F.col(place) <= per_key).drop(at, n, place)
