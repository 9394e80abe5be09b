"""Line deduplication through a sharded minimal perfect hash.

Lines are known by a 128-bit digest of their key (white space stripped, A-Z lowered).
Documents send each distinct digest once; counts are pre-aggregated, so a line found in
a third of all documents costs one row a task. The digests of the lines found in at
least ``min_docs`` documents are dealt over shards, each of which builds a minimal
perfect hash (levels of bit arrays; a digest's slot is the rank of its bit) over three
compact arrays: a 64-bit fingerprint, the document count, and the largest document id.
A digest outside the index lands on some slot and is turned away by the fingerprint.

Chunks of documents then probe the arrays: a chunk sends each distinct digest once to
its shard and gets back the slots that answered, so lines are never joined with lines
and a hot line gives a shard one probe a chunk. Shards and chunks hold a bounded amount
each, and their number follows the input.

Defined results: a null or empty text is one empty line; a document is a row, so
repeated rows count as documents of their own and keep a line they share as its largest
id; a null id is below every other; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, UPPER, ascii_lower, chunk_count, chunk_of, python_tasks, table

MIN_CHARS = 40
MIN_DOCS = 5
#: Digests in one shard on average: about 1.3 MB of arrays.
SHARD_KEYS = 50_000

SPACE = " \t\n\x0b\f\r"
_FOLD = str.maketrans(UPPER, LOWER)
_ABSENT = np.iinfo(np.int64).min


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def line_digests(text: Column, min_chars: int) -> Column:
    """Digests of the distinct lines of a text whose key is long enough."""
    keys = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), line_key)
    long = F.array_distinct(F.filter(keys, lambda k: F.length(k) >= min_chars))
    return F.transform(long, lambda k: F.unhex(F.md5(k.cast("binary"))))


# --- minimal perfect hash -------------------------------------------------------------

def _mix(x: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit finaliser, another one at each level."""
    x = x + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def _place(hi: np.ndarray, lo: np.ndarray, level: int, size: int) -> np.ndarray:
    return (_mix(_mix(hi, level) ^ lo, level) % np.uint64(size)).astype(np.int64)


class MinimalPerfectHash:
    """Slots 0..n-1 for n distinct digests. At each level, a digest alone at its bit stays there; the others go on."""

    LOAD = 2

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.ranks = np.concatenate([[0], np.cumsum(bits)]).astype(np.int64)

    @classmethod
    def build(cls, hi: np.ndarray, lo: np.ndarray) -> MinimalPerfectHash:
        sizes, levels = [], []
        while len(hi):
            size = cls.LOAD * len(hi)
            at = _place(hi, lo, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            hi, lo = hi[~alone[at]], lo[~alone[at]]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    def slots(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Slot of each digest; -1 where no level has it (any slot is possible for a digest that was not built in)."""
        out, start = np.full(len(hi), -1, np.int64), 0
        for level, size in enumerate(self.sizes):
            todo = np.flatnonzero(out < 0)
            at = start + _place(hi[todo], lo[todo], level, size)
            hit = self.bits[at]
            out[todo[hit]] = self.ranks[at[hit]]
            start += size
        return out


_SHARD = "_shard int, _sizes array<bigint>, _bits binary, _prints binary, _counts binary, _last binary"


def _build(keys: pd.DataFrame) -> pd.DataFrame:
    hi, lo = _halves(keys["_digest"].tolist())
    found = MinimalPerfectHash.build(hi, lo)
    slots = found.slots(hi, lo)
    arrays = []
    for values in (lo, keys["_docs"].to_numpy(np.int64), keys["_last"].fillna(_ABSENT).to_numpy(np.int64)):
        array = np.empty_like(values)
        array[slots] = values
        arrays.append(array.tobytes())
    return pd.DataFrame([(keys["_shard"].iloc[0], found.sizes, np.packbits(found.bits).tobytes(), *arrays)],
                        columns=["_shard", "_sizes", "_bits", "_prints", "_counts", "_last"])


def _probe(_, probes: pd.DataFrame, shards: pd.DataFrame) -> pd.DataFrame:
    """(chunk, digest, last) for the probes that the shard's arrays answer."""
    if probes.empty or shards.empty:
        return pd.DataFrame({"_chunk": [], "_digest": [], "_last": []})
    shard = shards.iloc[0]
    sizes = list(shard["_sizes"])
    found = MinimalPerfectHash(sizes, np.unpackbits(np.frombuffer(shard["_bits"], np.uint8), count=sum(sizes)).astype(bool))
    prints, last = np.frombuffer(shard["_prints"], "<u8"), np.frombuffer(shard["_last"], "<i8")
    hi, lo = _halves(probes["_digest"].tolist())
    slots = found.slots(hi, lo)
    known = (slots >= 0) & (prints[slots] == lo)
    return pd.DataFrame({"_chunk": probes["_chunk"].to_numpy()[known], "_digest": probes["_digest"].to_numpy()[known], "_last": last[slots[known]]})


def line_index(docs: DataFrame, text: str, key: str, least: int = 1, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> tuple[DataFrame, int]:
    """(shards, number of shards, at least ``least``): the index of lines that at least ``min_docs`` documents hold."""
    shared = (docs.select(F.col(key).cast("bigint").alias("_id"), F.explode(line_digests(F.col(text), min_chars)).alias("_digest"))
              .groupBy("_digest").agg(F.count(F.lit(1)).alias("_docs"), F.max("_id").alias("_last")).filter(F.col("_docs") >= min_docs)).checkpoint()
    shards = max(least, -(-shared.count() // SHARD_KEYS))
    return shared.withColumn("_shard", chunk_of(F.col("_digest"), shards)).groupBy("_shard").applyInPandas(_build, _SHARD), shards


def _cut(min_chars: int):
    """Drops the answered lines of a chunk's documents."""
    def cut(_, docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        last = dict(zip(answers["_digest"], answers["_last"])) if len(answers) else {}
        lines, dropped, kept = [], [], []
        for key, text in zip(docs["_key"], docs["_text"]):
            own = (text or "").split("\n")
            stay = own
            if last:
                key, stay = _ABSENT if pd.isna(key) else int(key), []
                for line in own:
                    if len(line) >= min_chars:
                        k = line.strip(SPACE).translate(_FOLD)
                        if len(k) >= min_chars and last.get(hashlib.md5(k.encode("utf-8", "replace")).digest(), key) != key:
                            continue
                    stay.append(line)
            lines.append(len(own))
            dropped.append(len(own) - len(stay))
            kept.append("\n".join(stay))
        return docs[["_row"]].assign(_lines=lines, _dropped=dropped, _kept=kept)
    return cut


def dedup_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", columns: list[str] | None = None,
                min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per document: its columns in struct ``_row``, ``_lines``, ``_dropped`` and the ``_kept`` text."""
    python_tasks(docs.sparkSession)
    columns = docs.columns if columns is None else columns
    chunks = chunk_count(docs, text)
    # probes grow with the chunks even where the index stays small, so shards do too
    index, shards = line_index(docs, text, key, chunks, min_chars, min_docs)
    chunk = chunk_of(F.col(key), chunks)
    probes = (docs.select(chunk.alias("_chunk"), F.explode(line_digests(F.col(text), min_chars)).alias("_digest")).distinct()
              .withColumn("_shard", chunk_of(F.col("_digest"), shards)))
    answers = probes.groupBy("_shard").cogroup(index.groupBy("_shard")).applyInPandas(_probe, "_chunk int, _digest binary, _last bigint")
    rows = docs.select(chunk.alias("_chunk"), F.col(key).cast("bigint").alias("_key"), F.col(text).alias("_text"), F.struct(*columns).alias("_row"))
    row = docs.select(*columns).schema.simpleString()[len("struct<"):-1]
    return rows.groupBy("_chunk").cogroup(answers.groupBy("_chunk")).applyInPandas(
        _cut(min_chars), f"_row struct<{row}>, _lines bigint, _dropped bigint, _kept string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), columns=["doc_id"])
    return found.select(F.col("_row.doc_id").alias("doc_id"), F.col("_lines").alias("n_lines"), F.col("_dropped").alias("n_dropped"),
                        F.sha2(F.col("_kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH l AS (SELECT doc_id, i, lines[i] AS line,
                  translate(regexp_replace(lines[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
           FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents), unnest(range(1, len(lines) + 1)) AS r(i)),
f AS (SELECT k, max(doc_id) AS last FROM l WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT l.doc_id, i, line, f.last IS NOT NULL AND f.last <> l.doc_id AS gone FROM l LEFT JOIN f USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
