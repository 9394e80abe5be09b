"""SimHash near-duplicates through a byte-position inverted index.

A 64-bit fingerprint is 8 positional bytes. Fingerprints that differ in at most 3 bits
share at least 5 of them, so whichever bytes differ lie inside one of the 14 blocks of
the Steiner system S(3, 4, 8), and the two agree on the 4 bytes outside it. The index
posts each distinct fingerprint under those 14 four-byte signatures. Within a posting
the shared positional bytes of a pair are tallied, pairs below the guaranteed minimum
are dropped, and the rest is verified by the bit distance.

A posting longer than ``MAX_POSTING`` (a large group of near copies) is not compared pair
by pair. Its members are posted again under one more agreeing part of the bits that are
left: 3 differing bits leave at least one of 4 parts untouched, so no link is lost.
Each level shortens the rest from 32 to 24, 18 and 13 bits, where a posting can't hold more
than 8,192 distinct fingerprints. Tasks send on a spanning forest of the links in a
posting, never the pairs. Equal fingerprints are one node; components come from
large-star and small-star rounds.

Defined results: a text without words (or null) has fingerprint 0 and is linked like any
other; fewer than three words are one shingle; a null id never is a group's smallest id
unless the group has no other; repeated rows keep one row each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import cut_lineage, python_tasks, table
from tessera.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Distinct fingerprints of one posting that a task compares with each other.
MAX_POSTING = 8192

#: The 14 blocks of 4 byte positions whose numbers cancel under exclusive or: every 3 positions lie in one of them.
BLOCKS = [b for b in combinations(range(8), 4) if b[0] ^ b[1] ^ b[2] ^ b[3] == 0]


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the shingles' XXH64 values, repeats included, as unsigned 64 bits."""
    w = (text or "").encode("utf-8", "replace").lower().split()
    if not w:
        return 0
    if len(w) <= shingle:
        grams = [b" ".join(w)]
    else:
        grams = map(b" ".join, zip(*(w[k:] for k in range(shingle))))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(g, SEED) for g in grams], np.uint64)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(h), 4096):
        ones += np.unpackbits(h[start:start + 4096].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", columns: list[str] | None = None, shingle: int = SHINGLE) -> DataFrame:
    """(_row, _print): the document's columns in a struct and its fingerprint as a signed long."""
    python_tasks(docs.sparkSession)
    columns = docs.columns if columns is None else columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["_row", "_print"])

    row = docs.select(*columns).schema.simpleString()[len("struct<"):-1]
    return docs.select(F.struct(*columns).alias("_row"), F.col(text).alias("_text")).mapInArrow(run, f"_row struct<{row}>, _print bigint")


def _mask(positions) -> int:
    return sum(0xFF << (8 * p) for p in positions)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _parts(rest: int) -> list[int]:
    """Masks of four parts, near equal in bits, of the bits in ``rest``."""
    bits = [b for b in range(64) if rest >> b & 1]
    return [sum(1 << b for b in part) for part in (bits[k * len(bits) // 4:(k + 1) * len(bits) // 4] for k in range(4))]


def _levels() -> list[list[int]]:
    """Masks of agreeing bits at each level: 4 bytes, then one more part of the rest each time, until the rest has at most 13 bits."""
    all_bits, levels = (1 << 64) - 1, [sorted({_mask(set(range(8)) - set(b)) for b in BLOCKS})]
    while bin(all_bits & ~levels[-1][0]).count("1") > 13:
        levels.append([m | p for m in levels[-1] for p in _parts(all_bits & ~m)])
    return levels


def _forest(prints: np.ndarray, max_bits: int, least: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the distinct fingerprints of one posting, breadth first: each is compared once with those not yet reached."""
    out, left = [], prints
    while len(left) > 1:
        root, left = left[0], left[1:]
        front = [root]
        while front and len(left):
            here = front.pop()
            x = left ^ here
            agreeing = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
            near = agreeing >= least
            near[near] = np.bitwise_count(x[near]) <= max_bits
            if near.any():
                out += [(int(here), int(v)) for v in left[near]]
                front += list(left[near])
                left = left[~near]
    return out


def _link(max_bits: int, least: int):
    """Links of the postings in a partition, which is sorted by signature."""
    def emit(edges: list[tuple[int, int]]) -> pa.RecordBatch:
        both = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["u", "v"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = (np.zeros(0, np.int64),) * 3
        for batch in batches:
            now = [np.concatenate([a, b.to_numpy(zero_copy_only=False)]) for a, b in zip(rest, batch.columns)]
            starts = np.flatnonzero(np.r_[True, (now[0][1:] != now[0][:-1]) | (now[1][1:] != now[1][:-1])])
            edges = []
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
                if b - a > 1:
                    edges += _forest(now[2][a:b].view(np.uint64), max_bits, least)
            yield emit(edges)
            rest = tuple(x[starts[-1]:] for x in now) if len(now[0]) else rest
        yield emit(_forest(rest[2].view(np.uint64), max_bits, least) if len(rest[2]) else [])
    return link


def near_links(prints: DataFrame, max_bits: int = MAX_BITS, max_posting: int = MAX_POSTING) -> DataFrame:
    """(u, v): links among the distinct fingerprints ``_print`` (long) that connect whatever differs in at most ``max_bits`` (3 or fewer)."""
    if max_bits > 3:
        raise ValueError("the index guarantees links of 3 or fewer differing bits")
    found, levels = None, _levels()
    signature = lambda masks: F.explode(F.array(*[F.struct(F.lit(k).cast("bigint").alias("_mask"), F.col("_print").bitwiseAND(F.lit(_signed(m))).alias("_bits"))
                                                  for k, m in enumerate(masks)]))
    postings = prints.select("_print", signature(levels[0]).alias("_s")).select("_s._mask", "_s._bits", "_print")
    for level in range(len(levels)):
        last = level + 1 == len(levels)
        sizes = postings.groupBy("_mask", "_bits").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        if not last:
            sizes = cut_lineage(sizes)
        short = sizes if last else sizes.filter(F.col("_n") <= max_posting)
        shared = postings.join(short, ["_mask", "_bits"]).select("_mask", "_bits", "_print")
        # not by the join's own keys: the planner drops such an exchange behind the join, and may then split a posting over tasks
        links = (shared.repartition(F.xxhash64("_mask", "_bits")).sortWithinPartitions("_mask", "_bits", "_print")
                 .mapInArrow(_link(max_bits, 8 - max_bits), "u bigint, v bigint"))
        found = links if found is None else found.union(links)
        long = sizes.filter(F.col("_n") > max_posting)
        if last or not long.head(1):
            break
        # the four finer signatures of mask k are 4k .. 4k + 3 of the next level
        parts = F.create_map(*[x for k, m in enumerate(levels[level + 1]) for x in (F.lit(k).cast("bigint"), F.lit(_signed(m)))])
        postings = cut_lineage(
            postings.join(long, ["_mask", "_bits"]).select("_print", F.explode(F.array(*[F.col("_mask") * 4 + k for k in range(4)])).alias("_mask"))
            .select("_mask", F.col("_print").bitwiseAND(parts[F.col("_mask")]).alias("_bits"), "_print"))
    return found


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", columns: list[str] | None = None, shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: its columns in struct ``_row``, ``_print``, ``_group`` (one fingerprint of the group, the same for all of it)
    and ``_component`` (the smallest ``key`` reachable)."""
    columns = docs.columns if columns is None else columns
    marked = cut_lineage(fingerprints(docs.select(F.struct(*columns).alias("_row"), F.col(key).alias("_key"), F.col(text).alias("_text")),
                                      "_text", ["_row", "_key"], shingle)
                         .select("_row._row", "_row._key", "_print"))
    nodes = cut_lineage(marked.groupBy("_print").agg(F.min("_key").alias("_first")))
    reached = components(near_links(nodes.select("_print"), max_bits))
    grouped = nodes.join(reached, F.col("_print") == F.col("node"), "left").withColumn("_root", F.coalesce("component", "_print"))
    smallest = grouped.groupBy("_root").agg(F.min("_first").alias("_component"))
    named = cut_lineage(grouped.select(F.col("_print").alias("_p"), "_root").join(smallest, "_root").select("_p", "_component", F.col("_root").alias("_group")))
    return marked.join(named, F.col("_print") == F.col("_p")).select("_row", "_print", "_group", "_component")


def hex_print(c: Column) -> Column:
    return F.lpad(F.lower(F.hex(c)), 16, "0")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), columns=["doc_id"])
    return found.select(F.col("_row.doc_id").alias("doc_id"), hex_print(F.col("_print")).alias("fingerprint"), F.col("_component").alias("component_id"))
