"""Benchmark decontamination: one Aho-Corasick automaton over the normalised test items.

Every window of ``window`` consecutive words of an item (a shorter item whole) is one
pattern, its words between single spaces. Tasks scan each text once in the same normal
form. A match ends at a space, whose rank gives the words it covers; word ranks map
back to code points of the original text.

The benchmark side is a stated query set. It reaches the tasks in blocks of at most
``block_bytes`` of pattern text, so no broadcast grows with the benchmark: a larger one
makes more blocks, and the texts pass through one automaton after the other, each pass
stored in the shared folder before the next, so that memory does not grow with the number
of blocks. Nothing is shuffled on the document side.

Defined results: a null or empty text has no words and no hits; an item without words
gives no pattern; a null ``item_id`` counts as the id ``""``; repeated items and
repeated documents each keep their own rows; other columns are not read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import python_tasks, stored, table

WINDOW = 10
#: Pattern text in one automaton and one broadcast; its trie takes roughly fifty times that in a worker.
BLOCK_BYTES = 4 << 20

#: A word in the original text, upper case included.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Word bytes to lower case, every other ASCII byte to a space; bytes of longer UTF-8 sequences stay.
_FOLD = bytes(b if b >= 128 or 48 <= b < 58 or 97 <= b < 123 else b + 32 if 65 <= b < 91 else 32 for b in range(256))

_SCHEMA = ("_row struct<{row}>, _text string, _words bigint, _spans array<struct<first: bigint, last: bigint>>, "
           "_items array<string>")


def words_of(text: str | None) -> list[bytes]:
    """Normalised words, as UTF-8."""
    return (text or "").encode("utf-8", "replace").translate(_FOLD).split()


def _framed(words: list[bytes]) -> str:
    """Words between single spaces, one character a byte."""
    return (b" " + b" ".join(words) + b" ").decode("latin-1")


def item_patterns(benchmark: DataFrame, text: str = "text", item_id: str = "item_id", window: int = WINDOW) -> DataFrame:
    """(pattern, words, items): each distinct window with the sorted ids of the items it occurs in."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, patterns, sizes = [], [], []
            for item, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                w = words_of(t)
                for i in range(max(1, len(w) - window + 1) if w else 0):
                    ids.append(item)
                    patterns.append(_framed(w[i:i + window]))
                    sizes.append(len(w[i:i + window]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(patterns, pa.string()), pa.array(sizes, pa.int32())],
                names=["item", "pattern", "words"])

    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))
    return (rows.mapInArrow(cut, "item string, pattern string, words int").distinct()
            .groupBy("pattern", "words").agg(F.sort_array(F.collect_set("item")).alias("items")))


_built: dict[str, tuple[ahocorasick.Automaton, list]] = {}


def _automaton(block) -> tuple[ahocorasick.Automaton, list]:
    """The automaton of a broadcast block, built once in each Python worker."""
    if block.value["id"] not in _built:
        _built.clear()
        found = ahocorasick.Automaton()
        for k, (pattern, _, _) in enumerate(block.value["patterns"]):
            found.add_word(pattern, k)
        found.make_automaton()
        _built[block.value["id"]] = found, [(n, items) for _, n, items in block.value["patterns"]]
    return _built[block.value["id"]]


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def _scan(block):
    """Batch function: adds the spans (ranks of words) and items that one block of patterns finds."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, patterns = _automaton(block)
        for batch in batches:
            counts, spans, items = [], [], []
            for text, before, known in zip(*(batch.column(k).to_pylist() for k in (1, 3, 4))):
                words = words_of(text)
                framed = _framed(words)
                counts.append(len(words))
                hits = list(automaton.iter(framed)) if words and patterns else []
                got, ids = [(s["first"], s["last"]) for s in before or []], set(known or [])
                if hits:
                    spaces = np.flatnonzero(np.frombuffer(framed.encode("latin-1"), np.uint8) == 32)
                    for last, (_, k) in zip(np.searchsorted(spaces, [e for e, _ in hits]).tolist(), hits):
                        got.append((last - patterns[k][0], last - 1))
                        ids.update(patterns[k][1])
                spans.append([{"first": a, "last": b} for a, b in _merge(got)])
                items.append(sorted(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
                 pa.array(items, pa.list_(pa.string()))], names=["_row", "_text", "_words", "_spans", "_items"])
    return scan


def _offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Code points (end exclusive) of the spans, for texts that have any."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        out = []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist()):
            at = [m.span() for m in _WORD.finditer(text)] if spans else []
            out.append([{"start": at[s["first"]][0], "end": at[s["last"]][1]} for s in spans or []])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], names=[*batch.schema.names, "_offsets"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", columns: list[str] | None = None,
                  window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: its columns in struct ``_row``, ``_text``, ``_words`` (count), ``_spans`` (merged
    ranks of hit words), ``_items`` (sorted ids) and ``_offsets`` (the spans in code points)."""
    spark = docs.sparkSession
    python_tasks(spark)
    columns = docs.columns if columns is None else columns
    rows = docs.select(F.struct(*columns).alias("_row"), F.col(text).alias("_text"), F.lit(0).cast("bigint").alias("_words"),
                       F.lit(None).cast("array<struct<first: bigint, last: bigint>>").alias("_spans"),
                       F.lit(None).cast("array<string>").alias("_items"))
    patterns = stored(item_patterns(benchmark, window=window).withColumn("size", F.length("pattern") + F.length(F.array_join("items", ","))))
    total = patterns.agg(F.sum("size")).head()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    schema = _SCHEMA.format(row=docs.select(*columns).schema.simpleString()[len("struct<"):-1])
    for b in range(blocks):
        part = patterns.filter(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == b)
        block = spark.sparkContext.broadcast({"id": uuid.uuid4().hex, "patterns": [(r.pattern, r.words, list(r["items"])) for r in part.toLocalIterator()]})
        rows = rows.mapInArrow(_scan(block), schema)
        if b < blocks - 1:  # a stage, and a worker, holds one automaton at a time
            rows = stored(rows)
            block.destroy()
    return rows.mapInArrow(_offsets, schema + ", _offsets array<struct<start: bigint, end: bigint>>")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), columns=["doc_id"])
    hit = F.aggregate("_spans", F.lit(0).cast("bigint"), lambda n, s: n + s["last"] - s["first"] + 1)
    return found.select(
        F.col("_row.doc_id").alias("doc_id"), F.col("_words").alias("n_words"), hit.alias("n_hit"),
        F.size("_items").cast("bigint").alias("n_items"), F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"))


ORACLE = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
patterns AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS p
  FROM items, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM patterns),
windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS p
  FROM words, sizes, unnest(range(1, len(w) - n + 2)) AS t(i) WHERE len(w) >= n),
hits AS (SELECT h.doc_id, h.i, h.n, q.item FROM windows h JOIN patterns q ON q.n = h.n AND q.p = h.p),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hits, unnest(range(0, n)) AS t(k) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""
