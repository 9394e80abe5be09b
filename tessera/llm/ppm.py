"""Scoring by prediction by partial matching over bytes.

The model is a trie of byte contexts: for every context of up to ``order`` bytes, how
often each byte (or the end of the text) followed it in the training documents. A byte
is priced from its longest context down: seen there, its count less a half over the
total; not seen, the escape (half a count for each distinct byte over the total) and the
next shorter context, from which the bytes already ruled out are taken away. Below the empty context all bytes
left are equally likely, so the prices of a context add up to one.

Only the longest contexts are counted in the corpus. A gram (context and next byte) is
one long of 9-bit symbols. Tasks count grams and words of the documents they scan, and
Spark adds them up. The trie is sharded by the last two context bytes, which keeps all
longer contexts of a byte together; the counts of shorter contexts are at most 258 by
258 numbers, the only thing that goes to every task. Each gram that occurs in any
document is priced once. Documents are scored in chunks: a chunk asks for its distinct
grams and words, and gets their prices and counts by a join, so no task holds the model
and what is moved follows the input; answers arrive ahead of the texts, which are then scored
batch by batch.

Defined results: a null or empty text is scored as its end alone; a null id trains (it
has no remainder); without training documents all bytes are equally likely and the base
score is 0; repeated rows are documents of their own; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import chunk_count, chunk_of, python_tasks, stored, table

ORDER = 5
#: Bytes of text in one chunk: larger chunks ask for fewer prices in all.
CHUNK_BYTES = 32 << 20
#: Text bytes of one message, and of which a task makes grams at once (these take about 50 times their bytes for a
#: moment); grams and words that it holds before it sends them on.
SLICE_BYTES, COUNT_BYTES, HELD_WORDS, HELD_GRAMS = 2 << 20, 1 << 19, 100_000, 1 << 19

_BITS, _END = 9, 257
#: Texts in one slice: a gram of up to 54 bits leaves 10 for the number of its text.
_RUN_BITS = 10
_RUN = 1 << _RUN_BITS
_SYMBOLS = 258
#: The end of a text, in a table of words: no word is empty.
END_WORD = b""
#: Texts move twice by chunk, so they move compressed.
CODEC = "zstd"


def grams_of(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams of all texts in a row, and how many each text has (its bytes and its end). Contexts begin with zeros."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    pad, first = bytes(order), np.cumsum(sizes + order) - sizes - order
    grams = np.frombuffer(b"".join(x for t in texts for x in (pad, t, b"\0")), np.uint8).astype(np.int64)
    grams += 1
    begin = (first[:, None] + np.arange(order)).ravel()
    grams[begin] = 0
    grams[first + order + sizes - 1] = _END
    span = 1
    while span <= order:  # a gram beside the one ``step`` before it: symbols that both hold agree
        step = min(span, order + 1 - span)
        grams[step:] |= grams[:-step] << (_BITS * step)
        span += step
    own = np.ones(len(grams), bool)
    own[begin] = False
    return grams[own], sizes


def _folded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace").lower()


def _slices(texts: list[bytes], most: int = SLICE_BYTES) -> Iterator[slice]:
    """Runs of texts of about ``most`` bytes, no more than ``_RUN`` of them."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most or i + 1 - start == _RUN:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Folded texts of a chunk with their rows, about ``SLICE_BYTES`` to a compressed message: one flat column moves them."""
    for batch in batches:
        chunk = batch.column("_chunk").to_numpy()
        order = np.argsort(chunk, kind="stable")
        chunks, messages = [], []
        for run in np.split(order, np.flatnonzero(np.diff(chunk[order])) + 1) if len(order) else ():
            folded = [_folded(batch.column("_text")[i].as_py()) for i in run.tolist()]
            for part in _slices(folded):
                at = pa.array(run[part])
                docs = pa.RecordBatch.from_arrays([pa.array(folded[part], pa.binary()), batch.column("_out").take(at), batch.column("_row").take(at)], names=["_text", "_out", "_row"])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, docs.schema, options=pa.ipc.IpcWriteOptions(compression=CODEC)) as out:
                    out.write_batch(docs)
                chunks.append(int(chunk[run[0]]))
                messages.append(sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int32()), pa.array(messages, pa.binary())], names=["_chunk", "_doc"])


def _unpacked(messages: pa.Array) -> Iterator[pa.RecordBatch]:
    for message in messages:
        with pa.ipc.open_stream(message.as_buffer()) as docs:
            yield from docs


def _firsts(ordered: np.ndarray) -> np.ndarray:
    """Where each distinct value of a sorted array begins."""
    return np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, np.int64)


def _tally(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, ascending, and their counts. Sorting whole numbers is vectorised; hashing them is not."""
    ordered = np.sort(grams)
    at = _firsts(ordered)
    return ordered[at], np.diff(np.r_[at, len(ordered)])


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    grams, n = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(grams, kind="stable")
    at = _firsts(grams[order])
    return grams[order][at], np.add.reduceat(n[order], at) if len(at) else n


def _union(grams: list[np.ndarray]) -> np.ndarray:
    """Distinct values, ascending; sorted in place."""
    every = np.concatenate(grams)
    grams.clear()
    every.sort()
    return every[_firsts(every)]


def _count(order: int):
    """(gram, word, n): counts in the training documents; grams of other documents come with 0."""
    def grams_batch(grams: np.ndarray, ns: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(grams), pa.nulls(len(grams), pa.binary()), pa.array(ns)], names=["gram", "word", "n"])

    def words_batch(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.nulls(len(held), pa.int64()), pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())],
                                          names=["gram", "word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        held_words: Counter = Counter()
        for batch in batches:
            texts, out = [_folded(t) for t in batch.column(0).to_pylist()], batch.column(1).to_pylist()
            for skip in (False, True):
                own = [t for t, o in zip(texts, out) if o == skip]
                for part in _slices(own, COUNT_BYTES):
                    grams, n = _tally(grams_of(own[part], order)[0])
                    held.append((grams, n * (not skip)))
                    if sum(len(g) for g, _ in held) > HELD_GRAMS:
                        held = [_merged(held)]
                        if len(held[0][0]) > HELD_GRAMS // 2:
                            yield grams_batch(*held.pop())
            for t, skip in zip(texts, out):
                if not skip:
                    held_words.update(t.split())
                    held_words[END_WORD] += 1
                    if len(held_words) > HELD_WORDS:
                        yield words_batch(held_words)
                        held_words = Counter()
        if held:
            yield grams_batch(*_merged(held))
        yield words_batch(held_words)
    return count


def _last(k: int) -> int:
    return (1 << (_BITS * k)) - 1


def price_grams(grams: np.ndarray, counts: np.ndarray, order: int, pairs: np.ndarray) -> np.ndarray:
    """log10 of the probability of each gram's last symbol after its context.

    ``grams`` are distinct and hold every gram of the contexts they share the last two bytes with; ``pairs`` counts
    symbols (columns) after the last byte (rows) in the whole corpus, for the contexts of one byte and none.
    """
    keys, n = {order: grams}, {order: counts}
    rank = {order: np.arange(len(grams))}
    for k in range(order - 1, 1, -1):
        keys[k], up = np.unique(keys[k + 1] & _last(k + 1), return_inverse=True)
        n[k] = np.bincount(up, n[k + 1], len(keys[k])).astype(np.int64)
        rank[k] = up[rank[k + 1]]
    symbol, before = grams & _last(1), grams >> _BITS & _last(1)
    empty = pairs.sum(axis=0)
    own = {k: n[k][rank[k]] for k in range(order, 1, -1)} | {1: pairs[before, symbol], 0: empty[symbol]}
    total, distinct, ruled = {}, {}, {}
    for k in range(order, 1, -1):  # by context: all counts, symbols seen, and those symbols' counts in the shorter context
        _, context = np.unique(keys[k] >> _BITS, return_inverse=True)
        seen = n[k] > 0
        shorter = n[k - 1][np.searchsorted(keys[k - 1], keys[k] & _last(k))] if k > 2 else pairs[keys[k] >> _BITS & _last(1), keys[k] & _last(1)]
        for out, weight in ((total, n[k]), (distinct, seen), (ruled, shorter * seen)):
            out[k] = np.bincount(context, weight)[context][rank[k]]
    seen = pairs > 0
    total[1], distinct[1], ruled[1] = pairs.sum(axis=1)[before], seen.sum(axis=1)[before], (seen * empty).sum(axis=1)[before]
    total[0], distinct[0] = np.full(len(grams), empty.sum()), np.full(len(grams), (empty > 0).sum())

    price, todo = np.zeros(len(grams)), np.ones(len(grams), bool)
    for k in range(order, -1, -1):
        t, q = total[k].astype(float), distinct[k].astype(float)
        if k < order:  # a longer context that was never seen rules nothing out: its sums are 0
            t, q = t - ruled[k + 1], q - distinct[k + 1]
        hit = todo & (own[k] > 0)
        price[hit] += np.log10((own[k][hit] - 0.5) / t[hit])
        todo &= ~hit
        escape = todo & (q > 0)
        price[escape] += np.log10(q[escape] / 2 / t[escape])
    price[todo] -= np.log10(_SYMBOLS - 1 - distinct[0][todo])
    return price


def gram_prices(counted: DataFrame, order: int) -> DataFrame:
    """(gram, price) for every gram of (gram, n)."""
    spark = counted.sparkSession
    pairs = np.zeros((_SYMBOLS, _SYMBOLS), np.int64)
    last = counted.groupBy(F.shiftright("gram", _BITS).bitwiseAND(_last(1)).alias("before"), F.col("gram").bitwiseAND(_last(1)).alias("symbol")).agg(F.sum("n").alias("n"))
    for before, symbol, n in last.collect():  # at most 258 by 258 rows
        pairs[before, symbol] = n
    known = spark.sparkContext.broadcast(pairs)

    def price(shard: pd.DataFrame) -> pd.DataFrame:
        grams, counts = shard["gram"].to_numpy(np.int64), shard["n"].to_numpy(np.int64)
        return pd.DataFrame({"gram": grams, "price": price_grams(grams, counts, order, known.value)})

    shard = F.shiftright("gram", _BITS).bitwiseAND(_last(2)).alias("shard")
    return counted.groupBy(shard).applyInPandas(price, "gram bigint, price double")


def _asked(order: int):
    """(_chunk, gram, word): what a chunk needs to know."""
    def ask(chunk: pa.Table) -> pa.Table:
        held, fresh = np.zeros(0, np.int64), []
        words: set[bytes] = {END_WORD}
        for docs in _unpacked(chunk.column("_doc")):
            texts = docs.column("_text").to_pylist()
            fresh.append(_tally(grams_of(texts, order)[0])[0])
            if sum(map(len, fresh)) > max(HELD_GRAMS, len(held) // 2):  # seldom: each union sorts all that is held
                held, fresh = _union([held, *fresh]), []
            for t in texts:
                words.update(t.split())
        grams = _union([held, *fresh])  # ascending: neighbours share their high bytes, which shuffles small
        return pa.table({"_chunk": pa.repeat(pa.scalar(chunk.column("_chunk")[0].as_py(), pa.int32()), len(grams) + len(words)),
                         "gram": pa.concat_arrays([pa.array(grams), pa.nulls(len(words), pa.int64())]),
                         "word": pa.concat_arrays([pa.nulls(len(grams), pa.binary()), pa.array(words, pa.binary(), size=len(words))])})
    return ask


class _Prices:
    """What the answers to a chunk say: prices by gram, log counts by word."""

    def __init__(self):
        self.grams, self.prices, self.counts, self.ready = [], [], {}, False
        self.logs: dict[float, float] = {}  # one object for each count: most words share a few

    def add(self, answers: pa.RecordBatch) -> None:
        gram, value = (answers.column(c).to_numpy(zero_copy_only=False) for c in ("gram", "value"))
        word = gram < 0
        self.counts.update(zip(answers.column("word").filter(pa.array(word)).to_pylist(), (self.logs.setdefault(v, v) for v in np.log10(value[word] + 1).tolist())))
        self.grams.append(gram[~word].astype(np.int64))
        self.prices.append(value[~word])

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        """Grams, ascending, and their prices."""
        if not self.ready:
            # one column after the other: what is no longer needed goes before the next copy
            grams, self.grams = np.concatenate([np.zeros(0, np.int64), *self.grams]), []
            by = np.argsort(grams)
            self.grams.append(grams[by])
            del grams
            prices, self.prices = np.concatenate([np.zeros(0), *self.prices]), []
            self.prices.append(prices[by])
            self.ready = True
        return self.grams[0], self.prices[0]


def _score(order: int, tokens: int, distinct: int):
    def scored(docs: pa.RecordBatch, known: _Prices) -> pa.RecordBatch:
        grams, prices = known.arrays()
        scores, symbols, n_tokens, n_known, base = [], [], [], [], []
        texts = docs.column("_text").to_pylist()
        own, sizes = grams_of(texts, order)
        symbols += sizes.tolist()
        # sorted by gram, each with the document it came from in its low bits
        keyed = np.sort(own.astype(np.uint64) << np.uint64(_RUN_BITS) | np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes))
        own = (keyed >> np.uint64(_RUN_BITS)).astype(np.int64)
        at = _firsts(own)
        priced = np.repeat(prices[np.searchsorted(grams, own[at])], np.diff(np.r_[at, len(own)]))
        scores.append(np.bincount((keyed & np.uint64(_RUN - 1)).astype(np.int64), priced, len(sizes)))
        for t in texts:
            words = [*t.split(), END_WORD]
            got = list(filter(None, map(known.counts.get, words)))  # a word that has an answer was counted: its log is above 0
            n_tokens.append(len(words))
            n_known.append(len(got))
            base.append(sum(got) - len(words) * float(np.log10(tokens + distinct + 1)))
        return pa.RecordBatch.from_arrays([docs.column("_row"), docs.column("_out"), pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base, pa.float64()),
                                           pa.array(np.concatenate(scores)), pa.array(symbols, pa.int64())],
                                          names=["_row", "_out", "_tokens", "_known", "_base", "_score", "_symbols"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order: a chunk's answers, then its texts. Only the answers are held, as two arrays and a dictionary."""
        now, known = None, _Prices()
        for batch in batches:
            chunk, kind = batch.column("_chunk").to_numpy(), batch.column("_doc").is_valid().to_numpy(zero_copy_only=False).astype(np.int8)
            cuts = np.r_[0, np.flatnonzero((np.diff(chunk) != 0) | (np.diff(kind) != 0)) + 1, batch.num_rows]
            for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if start == end:
                    continue
                if chunk[start] != now:
                    now, known = chunk[start], _Prices()
                part = batch.slice(start, end - start)
                if kind[start] == 0:
                    known.add(part)
                else:
                    for docs in _unpacked(part.column("_doc")):
                        for some in _slices(docs.column("_text").to_pylist(), COUNT_BYTES):  # grams of a whole message would take 100 MB
                            yield scored(docs.slice(some.start, some.stop - some.start), known)
    return score


def ppm_scores(docs: DataFrame, held_out, text: str = "text", key: str = "doc_id", columns: list[str] | None = None, order: int = ORDER) -> DataFrame:
    """One row per document: its columns in struct ``_row``, ``_out`` (held out), ``_tokens``, ``_known``, ``_train_tokens``,
    ``_base``, ``_score`` (log10 probability) and ``_symbols`` (bytes and end). ``held_out`` is a boolean column: true doesn't train."""
    if not 2 < order < 6:
        raise ValueError("a gram of an order from 3 to 5 fits a long beside its text's number")
    python_tasks(docs.sparkSession)
    columns = docs.columns if columns is None else columns
    rows = docs.select(F.col(text).alias("_text"), held_out.alias("_out"), F.struct(*columns).alias("_row"),
                       chunk_of(F.xxhash64(key, text), chunk_count(docs, text, CHUNK_BYTES)).alias("_chunk"))  # also by text: many rows may share a null or repeated id
    counted = stored(rows.select("_text", "_out").mapInArrow(_count(order), "gram bigint, word binary, n bigint").groupBy("gram", "word").agg(F.sum("n").alias("n")))
    words = counted.filter("gram IS NULL").select("word", "n")
    tokens, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).head()
    prices = gram_prices(counted.filter("gram IS NOT NULL").select("gram", "n"), order)
    # one table of answers: a price by gram, a count by word
    values = stored(prices.select("gram", F.lit(None).cast("binary").alias("word"), F.col("price").alias("value"))
                    .unionByName(words.select(F.lit(None).cast("bigint").alias("gram"), "word", F.col("n").cast("double").alias("value"))))
    row = docs.select(*columns).schema.simpleString()[len("struct<"):-1]
    chunks = rows.mapInArrow(_packed, "_chunk int, _doc binary")
    asked = chunks.groupBy("_chunk").applyInArrow(_asked(order), "_chunk int, gram bigint, word binary")
    key = [F.coalesce("gram", F.lit(-1)).alias("_g"), F.coalesce("word", F.lit(b"")).alias("_w")]  # a gram is above 0; the end's word has none
    answers = asked.select("_chunk", *key).join(values.select(*key, "value"), ["_w", "_g"])
    # a chunk's answers, then its texts: the task that scores it reads them as a stream
    texts = chunks.select("_chunk", F.lit(None).cast("bigint").alias("gram"), F.lit(None).cast("binary").alias("word"), F.lit(None).cast("double").alias("value"), "_doc")
    both = answers.select("_chunk", F.col("_g").alias("gram"), F.col("_w").alias("word"), "value", F.lit(None).cast("binary").alias("_doc")).unionByName(texts)
    order_by = F.col("_chunk").cast("bigint") * 2 + F.col("_doc").isNotNull().cast("int")  # one number sorts fast
    return (both.repartition("_chunk").sortWithinPartitions(order_by)
            .mapInArrow(_score(order, tokens, distinct), f"_row struct<{row}>, _out boolean, _tokens bigint, _known bigint, _base double, _score double, _symbols bigint")
            .withColumn("_train_tokens", F.lit(tokens).cast("bigint")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))
    scored = ppm_scores(table(spark, sf_dir, "documents").select("doc_id", "text"), held_out, columns=["doc_id"])
    return scored.select(F.col("_row.doc_id").alias("doc_id"), F.col("_out").alias("held_out"), F.col("_tokens").alias("n_tokens"), F.col("_known").alias("n_known"),
                         F.col("_train_tokens").alias("train_tokens"), F.col("_base").alias("base_score"), F.col("_score").alias("score"), F.col("_symbols").alias("n_symbols"))
