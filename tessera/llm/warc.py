"""WARC archives, index first.

``write_archives`` writes each partition of pages as archives of compressed records (one
gzip member a record) in the shared folder and returns the index: path, offset, length,
URL and digest of every record. An archive gets a name of its own for every attempt, and
only the index of the attempt that succeeded is kept, so a retried or lost task leaves at
most a file that no index names. ``read_records`` takes selected rows of an index, sorts
them by archive and offset, coalesces neighbouring byte ranges into one read each, and
parses the records; a digest that does not fit its payload fails the task.

Records with equal payloads of at least ``min_bytes``: the one with the smallest id is
the response, others are revisits that name it and carry the HTTP head only. Payload
digests are pre-aggregated and joined back with a salt, on narrow rows; the payloads are
shuffled once, by id, so neither a hot host nor a hot payload makes a large task.

Defined results: a null payload is empty; a null id sorts last among equal payloads and
is written as an empty id; pages that share both id and payload are all responses; an
empty table gives no archive and no row; other columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import python_tasks, table
from tessera.session import ensure_checkpoint_dir

#: Compressed bytes after which a task starts its next archive.
ARCHIVE_BYTES = 64 << 20
#: Bytes between two wanted records that one read still spans, and the most that one read fetches beside a larger record.
GAP_BYTES, READ_BYTES = 64 << 10, 4 << 20
_END = b"\r\n\r\n"
#: Compressed bytes that one read task gets on average.
TASK_BYTES = 4 << 20
#: Parts that a digest's pages are dealt over when its first page is joined back.
SALTS = 16
_DIGITS32, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: One date for all records: reruns write the same bytes.
_DATE = "2000-01-01T00:00:00Z"


def sha1_base32(c: Column) -> Column:
    """Bare upper-case base32 SHA-1: 40 hex digits are 8 groups of 20 bits, 4 base32 digits each."""
    digest = F.upper(F.sha1(c))
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), _DIGITS32, _BASE32)


def plan_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0) -> DataFrame:
    """(page_id, url, body, payload_digest, refers_to): one row per page; ``refers_to`` is null for responses."""
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), body.alias("body"), sha1_base32(body.cast("binary")).alias("payload_digest"))
    narrow = pages.filter(F.octet_length(body) >= min_bytes).select(F.col(page_id).alias("_id"), sha1_base32(body.cast("binary")).alias("_digest"))
    shared = (narrow.groupBy("_digest").agg(F.min("_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND refers_to IS NOT NULL")
              .select("_digest", "refers_to", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")))
    revisits = (narrow.distinct().withColumn("_salt", F.pmod(F.xxhash64("_id"), F.lit(SALTS)).cast("int"))
                .join(shared, ["_digest", "_salt"]).filter(~F.col("_id").eqNullSafe(F.col("refers_to"))).drop("_salt"))
    return (rows.join(revisits, F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("payload_digest") == F.col("_digest")), "left")
            .select("page_id", "url", "body", "payload_digest", "refers_to"))


def _urn(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record_bytes(page_id, url: str | None, body: bytes, digest: str, refers_to) -> bytes:
    """One WARC record, its block an HTTP response; a revisit's block ends after the HTTP head."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}".encode() + _END
    block = http + (body if refers_to is None else b"")
    # a URL with a line break must not end its header line
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {_DATE}",
            f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_urn(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "replace") + _END + block + _END


INDEX = "path string, offset bigint, length bigint, page_id string, url string, payload_digest string"


def _open(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a shared path, by its scheme."""
    return pyarrow.fs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path)


def _write(folder: str, archive_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, at = None, "", 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, body, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                    if out is None or at >= archive_bytes:
                        if out is not None:
                            out.close()
                        path, at = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
                        fs, where = _open(path)
                        out = fs.open_output_stream(where, compression=None)
                    data = gzip.compress(record_bytes(page_id, url, body, digest, refers_to), 5, mtime=0)
                    out.write(data)
                    rows.append((path, at, len(data), page_id, url, digest))
                    at += len(data)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], pa.int64() if k in (1, 2) else pa.string()) for k in range(6)],
                    names=["path", "offset", "length", "page_id", "url", "payload_digest"])
        finally:
            if out is not None:
                out.close()
    return write


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the records below ``folder``/archives and their index to ``folder``/index; returns the index as read back."""
    fs, at = _open(f"{folder}/archives")
    fs.create_dir(at, recursive=True)
    (records.select(F.col("page_id").cast("string"), "url", F.col("body").cast("binary"), "payload_digest", F.col("refers_to").cast("string"))
     .mapInArrow(_write(f"{folder}/archives", archive_bytes), INDEX).write.parquet(f"{folder}/index"))
    return records.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


def coalesced(ranges: list[tuple[int, int]], gap: int = GAP_BYTES, most: int = READ_BYTES) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """Reads (start, end, ranges inside) for (offset, length) ranges sorted by offset."""
    reads: list[tuple[int, int, list[tuple[int, int]]]] = []
    for offset, length in ranges:
        if reads and offset - reads[-1][1] <= gap and offset + length - reads[-1][0] <= most:
            start, end, inside = reads[-1]
            inside.append((offset, length))
            reads[-1] = start, max(end, offset + length), inside
        else:
            reads.append((offset, offset + length, [(offset, length)]))
    return reads


def parse_record(record: bytes) -> dict:
    head, _, block = record.partition(_END)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[:int(fields["Content-Length"])]
    http, _, payload = block.partition(_END)
    size = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))[16:])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    named = lambda key: fields.get(key, "").removeprefix("<urn:page:").removesuffix(">") or None
    if fields["WARC-Type"] == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"record {named('WARC-Record-ID')}: its payload does not fit its digest")
    return {"page_id": named("WARC-Record-ID"), "url": fields["WARC-Target-URI"], "payload_bytes": size, "payload_digest": digest,
            "record_type": fields["WARC-Type"], "refers_to": named("WARC-Refers-To"), "payload": payload}


_READ = pa.schema([("page_id", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("record_type", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary())])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges arrive sorted by archive and offset; one open file at a time."""
    for batch in batches:
        wanted: dict[str, list[tuple[int, int]]] = {}
        for path, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
            wanted.setdefault(path, []).append((offset, length))
        for path, ranges in wanted.items():
            fs, at = _open(path)
            with fs.open_input_file(at) as f:
                for start, end, inside in coalesced(ranges):
                    data = f.read_at(end - start, start)
                    rows = [parse_record(gzip.decompress(data[o - start:o - start + n])) for o, n in inside]
                    yield pa.RecordBatch.from_pylist(rows, schema=_READ)


def read_records(selected: DataFrame, id_type: str = "bigint") -> DataFrame:
    """Records of the selected index rows, read by coalesced byte ranges; ``payload`` is empty for revisits.
    A task reads about ``TASK_BYTES``: neighbouring ranges of one archive, or of several."""
    # the index is tiny beside the bodies, so tasks are dealt by the bytes they will read, not by the index's own size
    tasks = max(1, math.ceil((selected.agg(F.sum("length")).head()[0] or 0) / TASK_BYTES))
    ranges = (selected.select("path", "offset", "length").repartitionByRange(tasks, "path", "offset")
              .sortWithinPartitions("path", "offset"))
    return (ranges.mapInArrow(_read, "page_id string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, payload binary")
            .withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")}))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    python_tasks(spark)
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    index = write_archives(plan_records(table(spark, sf_dir, "pages").select("page_id", "url", "html")), folder)
    return read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, upper(sha1(body)) AS hex FROM p),
b AS (SELECT page_id, payload_bytes, hex, list_aggregate(list_transform(range(0, 32), lambda k:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + CAST((('0x' || substr(hex, 1 + 5 * (k // 4), 5))::BIGINT >> (5 * (3 - k % 4))) & 31 AS INTEGER)], 1, 1)), 'string_agg', '') AS digest
      FROM d),
f AS (SELECT hex, min(page_id) AS first FROM d GROUP BY hex)
SELECT page_id, payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM b JOIN f USING (hex)
"""
