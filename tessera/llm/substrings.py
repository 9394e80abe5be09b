"""Repeated byte strings by bucket-pointer refinement.

Every offset of a text belongs to the bucket of the q-gram that starts there. A bucket is
refined by the bucket identifiers of later offsets: the 8-byte bucket of an offset and
that of the offset 8 bytes on make its 16-byte bucket, 16-byte buckets make 32-byte ones,
and so on; each refined table is used again for the next. Identifiers are named by
hashing the pair, so equal strings get equal identifiers in every task without a shuffle.

Sorting all suffixes would move many times the text, so the buckets meet in three
steps, each on what the step before left open. (1) Every window of ``length`` bytes picks
the smallest 48-byte bucket inside it (the leftmost of equals). Equal windows pick equal
buckets at equal places, so a window can only repeat inside its bucket. Consecutive
windows with the same pick are one segment, about one for 75 bytes, and only segments
whose bucket has another segment go on. (2) Within a bucket, segments are refined by the
identifiers of their first and last windows; a segment found twice repeats as a whole.
(3) Segments left alone in a bucket with others are refined by blocks of 32 windows, of 4,
and by single windows, their own bytes supplying the identifiers; of equal segments one
stands for all.

Counts are pre-aggregated, so a passage in a third of all documents adds one row a task,
and joins have one row a key on one side. Texts that no open segment or span names take no
part in the two joins with texts: a bitmap of fixed size, filled with the hashes of
wanted keys, holds them back (more keys let more texts through, never fewer).

Defined results: a null or empty text has no bytes; matches never cross texts; overlapping
repeats inside one text count; a text shorter than ``length`` keeps all; repeated rows
repeat each other; identifiers are hashes of 64 bits, compared within a bucket of another
64; a text is known by its id and a 32-bit hash, so an id used twice keeps two texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import key_filter, passing, python_tasks, stored, table

LENGTH = 200
#: Bytes of the buckets that windows pick from; 152 offsets on, the last one of a window starts.
GRAM = 48
#: Bytes of text refined at once: the tables of one slice stay in a CPU's cache.
SLICE_BYTES = 1 << 18
#: Windows refined together, down to single ones.
BLOCKS = (32, 4, 1)

_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Identifiers of (a, b)."""
    x = a * _C1
    x ^= x >> np.uint64(29)
    x += b
    x *= _C2
    x ^= x >> np.uint64(32)
    return x


def _refined(data: np.ndarray) -> np.ndarray:
    """Identifiers of the 48 bytes at every offset, from 8-byte buckets refined by later offsets. ``data``: at least 48 bytes."""
    b8 = np.ndarray(len(data) - 7, "<u8", data.data, strides=(1,))
    b16 = _pair(b8[:-8], b8[8:])
    b32 = _pair(b16[:-16], b16[16:])
    return _pair(b32[:-16], b16[32:])


def _window_ids(b48: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Identifiers of the ``length`` bytes at some offsets: the bucket of an offset refined by later ones."""
    out = b48[at]
    for later in [*range(GRAM, length - GRAM, GRAM), length - GRAM]:
        out = _pair(out, b48[at + later])
    return out


def _picks(b48: np.ndarray, length: int) -> np.ndarray:
    """The offset each window picks: the smallest identifier's, the leftmost of equals. Low bits hold the offset, high bits order."""
    width = length - GRAM + 1
    bits = max(1, int(len(b48)).bit_length())
    low = np.uint64((1 << bits) - 1)
    least = (b48 & ~low) | np.arange(len(b48), dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[:span - width], least[width - span:])
    return (least & low).astype(np.int64)


def _runs(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``SLICE_BYTES`` together."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= SLICE_BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def segments(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(bucket, content, text, place): one row a segment. ``place`` packs its first window, the pick's distance from it,
    and the windows after it."""
    out = []
    for a, b in _runs(texts):
        sizes = np.array([len(t) for t in texts[a:b]], np.int64)
        data = np.frombuffer(b"".join(texts[a:b]), np.uint8)
        if len(data) < length:
            continue
        starts = np.cumsum(sizes) - sizes
        b48 = _refined(data)
        picks = _picks(b48, length)
        inside = np.ones(len(picks), bool)
        for s, n in zip((starts + np.maximum(sizes - length + 1, 0)).tolist(), np.minimum(sizes, length - 1).tolist()):
            inside[s:s + n] = False
        at = np.flatnonzero(inside)
        if not len(at):
            continue
        own = picks[at]
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        lo, hi, p = at[first], at[np.r_[first[1:] - 1, len(at) - 1]], own[first]
        where = ((p - lo) << 8 | (hi - lo)).astype(np.uint64)
        content = _pair(_pair(_window_ids(b48, lo, length), _window_ids(b48, hi, length)), where)
        text = np.searchsorted(starts, lo, "right") - 1
        out.append((b48[p].view(np.int64), content.view(np.int64), text + a, (lo - starts[text]) << 16 | where.astype(np.int64)))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*out))


def _bytes(batch: pa.RecordBatch, name: str) -> list[bytes]:
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


def _segment_rows(length: int, full: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket, content, text, place = segments(_bytes(batch, "_text"), length)
            if full:
                yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(content), batch.column("_id").take(pa.array(text)), batch.column("_mark").take(pa.array(text)), pa.array(place)],
                                                 names=["bucket", "content", "id", "mark", "place"])
            else:
                yield pa.RecordBatch.from_arrays([pa.array(bucket)], names=["bucket"])
    return run


def _ids(b48: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    return _window_ids(b48, at, n).view(np.int64)


def _content_rows(length: int):
    """(bucket, content, id, mark, place, n, data): wanted segments with their bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for id_, mark, text, wanted in zip(batch.column("_id").to_pylist(), batch.column("_mark").to_pylist(), _bytes(batch, "_text"), batch.column("_wanted").to_pylist()):
                for w in wanted:
                    lo = w["place"] >> 16
                    rows.append((w["bucket"], w["content"], id_, mark, w["place"], w["n"], text[lo:lo + (w["place"] & 255) + length]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 7, _CONTENT.types)], schema=_CONTENT)
    return run


_CONTENT = pa.schema([("bucket", pa.int64()), ("content", pa.int64()), ("id", pa.int64()), ("mark", pa.int32()), ("place", pa.int64()), ("n", pa.int64()), ("data", pa.binary())])


def _packed(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The picks' distances from the first and from the last windows."""
    return place >> 8 & 255, (place >> 8 & 255) - (place & 255)


def _block_rows(length: int, size: int, parent: int):
    """(bucket, block, inner, outer, content, n): blocks of ``size`` windows by their distance to the pick, of whole segments or of some of
    their ``parent``-sized blocks. ``inner`` names the bytes that all windows of a block share, ``outer`` (null for a block cut off by the
    segment's ends) all their bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            far, near = _packed(batch.column("place").to_numpy())
            data = batch.column("data").to_pylist()
            begin = np.cumsum([0, *map(len, data)])
            b48 = _refined(np.frombuffer(b"".join(data), np.uint8))
            if parent:  # the blocks inside those chosen a level above
                chosen = batch.column("blocks")
                row = np.repeat(np.arange(len(far)), np.diff(chosen.offsets.to_numpy()) * (parent // size))
                block = (chosen.flatten().to_numpy()[:, None] * (parent // size) + np.arange(parent // size)).ravel()
                inside = (block >= near[row] // size) & (block <= far[row] // size)
                row, block = row[inside], block[inside]
            else:
                count = far // size - near // size + 1
                row = np.repeat(np.arange(len(far)), count)
                block = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + (near // size)[row]
            at = begin[row] + far[row] - size * block
            inner = _window_ids(b48, at, length - size + 1).view(np.int64)
            whole = (size * block >= near[row]) & (size * block + size - 1 <= far[row])
            outer = np.zeros(len(block), np.int64)
            outer[whole] = _pair(*(_window_ids(b48, at[whole] - k, length) for k in (size - 1, 0))).view(np.int64)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([batch.column("bucket").take(take), pa.array(block), pa.array(inner), pa.array(outer, mask=~whole), batch.column("content").take(take), batch.column("n").take(take)],
                                             names=["bucket", "block", "inner", "outer", "content", "n"])
    return run


def _on(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on equal keys; the right side's columns beside them stay. Null keys are equal."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = F.lit(True)
    for k in keys:
        on &= F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(r, on).drop(*[f"_r_{k}" for k in keys])


def _refine_alone(contents: DataFrame, length: int) -> DataFrame:
    """(id, mark, start, end): repeated windows of segments (n = 1) that are alone in a bucket, by ever smaller blocks.

    A block whose inner bytes are not shared in its bucket holds no repeated window; one whose outer bytes are shared
    holds nothing else; only blocks between the two are opened, with all blocks they share the inner bytes with. Blocks
    of one window are one or the other."""
    segment, block = ["bucket", "content"], ["bucket", "block", "inner"]
    todo, found = contents.withColumn("blocks", F.array().cast("array<bigint>")), None
    for parent, size in zip((0, *BLOCKS), BLOCKS):
        blocks = stored(todo.select("bucket", "content", "place", "n", "data", "blocks").mapInArrow(
            _block_rows(length, size, parent), "bucket bigint, block bigint, inner bigint, outer bigint, content bigint, n bigint"))
        by_outer = blocks.groupBy(*block, "outer").agg(F.sum("n").alias("m"))
        settled = F.col("outer").isNotNull() & (F.col("m") > 1)
        whole = _on(blocks.filter("n = 1 AND outer IS NOT NULL"), by_outer.filter(settled).select(*block, "outer"), [*block, "outer"]).groupBy(*segment).agg(F.collect_list("block").alias("blocks"))
        spans = _on(contents.drop("data"), whole, segment).select(
            "id", "mark", F.explode("blocks").alias("block"), (F.shiftright("place", 16) + F.shiftright("place", 8).bitwiseAND(255)).alias("pick")).select(
            "id", "mark", (F.col("pick") - size * F.col("block") - (size - 1)).alias("start"), (F.col("pick") - size * F.col("block") + length).alias("end"))
        found = spans if found is None else found.union(spans)
        if size > 1:
            opened = by_outer.groupBy(*block).agg(F.sum("m").alias("all"), F.count(F.when(~settled, 1)).alias("unsettled")).filter("all > 1 AND unsettled > 0").select(*block)
            todo = _on(contents, _on(blocks, opened, block).groupBy(*segment).agg(F.collect_list("block").alias("blocks")), segment)
    return found


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(id, mark, spans): per text of (_id, _mark, _text, ...), offsets (start, end) covered by repeated strings, not merged."""
    short = docs.select("_id", "_mark", "_text").filter(F.octet_length("_text") >= length)
    kind = "bucket bigint, content bigint, id bigint, mark int, place bigint"
    shared = short.select("_text").mapInArrow(_segment_rows(length, False), "bucket bigint").groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket")
    shared = stored(shared)  # a join of two exchanges, which Spark can split where a bucket is hot
    active = stored(short.mapInArrow(_segment_rows(length, True), kind).join(shared, "bucket"))

    segment = ["bucket", "content"]
    alike = stored(active.groupBy(*segment).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "mark", "place")).alias("one")))
    covered = _on(active, alike.filter("n > 1").select(*segment), segment).select(
        "id", "mark", F.shiftright("place", 16).alias("start"), (F.shiftright("place", 16) + F.col("place").bitwiseAND(255) + length).alias("end"))

    # buckets where a segment is alone among others
    opened = stored(alike.groupBy("bucket").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least")).filter("kinds > 1 AND least = 1").select("bucket"))
    wanted = stored(alike.join(opened, "bucket").groupBy(F.col("one.id").alias("_i"), F.col("one.mark").alias("_m"))
                    .agg(F.collect_list(F.struct("bucket", "content", F.col("one.place").alias("place"), "n")).alias("_wanted")))
    member = key_filter(wanted.select("_i", "_m"))
    texts = short.mapInArrow(passing(member, "_id", "_mark", True), short.schema)
    contents = stored(texts.join(wanted, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_mark") == F.col("_m")))
                      .select("_id", "_mark", "_text", "_wanted").mapInArrow(_content_rows(length), "bucket bigint, content bigint, id bigint, mark int, place bigint, n bigint, data binary"))
    return covered.union(_refine_alone(contents, length)).groupBy("id", "mark").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of covered offsets."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    first = np.flatnonzero(np.r_[True, start[1:] > reach[:-1]])
    return start[first], reach[np.r_[first[1:] - 1, len(start) - 1]]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, removed, counts, firsts, lasts, kept, digests = [], [], [], [], [], [], []
        spans = batch.column("spans")
        at, flat = np.cumsum([0, *(n or 0 for n in pc.list_value_length(spans).to_pylist())]), spans.flatten()
        start, end = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("start", "end"))
        for i, text in enumerate(_bytes(batch, "_text")):
            own = merged(start[at[i]:at[i + 1]], end[at[i]:at[i + 1]])
            edges = [0, *(int(x) for both in zip(*own) for x in both), len(text)]
            rest = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
            sizes.append(len(text))
            removed.append(len(text) - len(rest))
            counts.append(len(own[0]))
            firsts.append(own[0])
            lasts.append(own[1])
            kept.append(rest)
            digests.append(hashlib.sha256(rest).hexdigest())
        runs = pa.StructArray.from_arrays([pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in (firsts, lasts)], names=["start", "end"])
        yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                                          pa.ListArray.from_arrays(pa.array(np.cumsum([0, *counts]), pa.int32()), runs), pa.array(kept, pa.binary()), pa.array(digests, pa.string())],
                                         names=["_row", "_bytes", "_removed", "_spans", "_kept", "_sha256"])


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", columns: list[str] | None = None, length: int = LENGTH) -> DataFrame:
    """One row per document: its columns in struct ``_row``, ``_bytes``, ``_removed``, ``_spans`` (maximal removed runs, byte offsets),
    ``_kept`` (the remaining bytes, which need not be whole characters) and their ``_sha256``."""
    if length - GRAM > 200 or length < 2 * GRAM:
        raise ValueError("a place packs distances below 256, and windows need room for two buckets: take 96 to 248 bytes")
    python_tasks(docs.sparkSession)
    columns = docs.columns if columns is None else columns
    rows = docs.select(F.struct(*columns).alias("_row"), F.col(key).cast("bigint").alias("_id"), F.hash(F.lit(1), F.col(text)).alias("_mark"), F.col(text).alias("_text"))
    spans = stored(repeated_spans(rows, length))
    member = key_filter(spans.select("id", "mark"))
    with_spans = rows.mapInArrow(passing(member, "_id", "_mark", True), rows.schema).join(
        spans, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_mark") == F.col("mark")), "left").select("_row", "_text", "spans")
    others = rows.mapInArrow(passing(member, "_id", "_mark", False), rows.schema).select("_row", "_text", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))
    row = docs.select(*columns).schema.simpleString()[len("struct<"):-1]
    return with_spans.union(others).mapInArrow(
        _cut, f"_row struct<{row}>, _bytes bigint, _removed bigint, _spans array<struct<start: bigint, end: bigint>>, _kept binary, _sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), columns=["doc_id"])
    return found.select(F.col("_row.doc_id").alias("doc_id"), F.col("_bytes").alias("n_bytes"), F.col("_removed").alias("n_removed"),
                        F.size("_spans").cast("bigint").alias("n_spans"), F.col("_sha256").alias("kept_sha256"))
