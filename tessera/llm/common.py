"""What several operators share: table access, text units, chunks of documents."""

from __future__ import annotations

import math
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import cut_lineage, stored

__all__ = ["UPPER", "LOWER", "ascii_lower", "chunk_count", "chunk_of", "cut_lineage", "key_filter", "passing", "python_tasks", "stored", "table"]

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Text bytes that one chunk of documents holds on average: what a Python task has in memory at once.
CHUNK_BYTES = 8 << 20
#: Rows of one Arrow batch for whole texts. The default of 10,000 suits narrow rows; 10,000 long texts would not fit a worker.
TEXT_BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; no other letter changes."""
    return F.translate(c, UPPER, LOWER)


def python_tasks(spark: SparkSession) -> None:
    """Readies a session for Python tasks over whole texts: workers find this package where the driver does
    (a cluster that installs it elsewhere keeps its own path), and Arrow batches get smaller unless the
    session already chose a size."""
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), _ROOT])
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, "10000") == "10000":
        spark.conf.set(key, str(TEXT_BATCH_ROWS))


def chunk_count(df: DataFrame, text: str, chunk_bytes: int = CHUNK_BYTES) -> int:
    """Number of chunks so that one holds about ``chunk_bytes`` of text: it follows the input, the chunk does not."""
    total = df.agg(F.sum(F.octet_length(text))).head()[0] or 0
    return max(1, math.ceil(total / chunk_bytes))


def chunk_of(key: Column, n: int) -> Column:
    """Chunk of a document by the hash of its id, so a hot source spreads over all chunks."""
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


#: Bits of a key filter, and bits that one row of it holds: 16 MB go to every worker whatever the number of keys.
FILTER_BITS, FILTER_ROW_BITS = 1 << 27, 1 << 19


def _filter_bit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (b.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    x ^= x >> np.uint64(31)
    return ((x * np.uint64(0x94D049BB133111EB)) >> np.uint64(64 - 27)).astype(np.int64)


def key_filter(keys: DataFrame) -> Broadcast:
    """A bitmap over the hashes of (integer, integer) keys. It passes all of them, and others with the share of bits set."""
    a, b = keys.columns

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(_filter_bit(*(batch.column(c).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for c in (a, b))))
            yield pa.RecordBatch.from_arrays([pa.array(at // FILTER_ROW_BITS), pa.array(at % FILTER_ROW_BITS)], names=["row", "bit"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for held in batch.column("held"):
                out = np.zeros(FILTER_ROW_BITS, bool)
                out[held.values.to_numpy()] = True
                packed.append(np.packbits(out).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(packed, pa.binary())], names=["row", "bits"])

    spark, filled = keys.sparkSession, np.zeros(FILTER_BITS // 8, np.uint8)
    width = FILTER_ROW_BITS // 8
    for row, packed in (keys.mapInArrow(bits, "row bigint, bit bigint").groupBy("row").agg(F.collect_set("bit").alias("held"))
                        .mapInArrow(pack, "row bigint, bits binary").toLocalIterator()):
        filled[row * width:(row + 1) * width] = np.frombuffer(packed, np.uint8)
    return spark.sparkContext.broadcast(filled)


def passing(member: Broadcast, a: str, b: str, inside: bool):
    """Batch function: the rows whose key (columns ``a``, ``b``) the filter passes, or the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _filter_bit(*(batch.column(c).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for c in (a, b)))
            yield batch.filter(pa.array((member.value[at >> 3] >> (7 - (at & 7)) & 1).astype(bool) == inside))
    return run
