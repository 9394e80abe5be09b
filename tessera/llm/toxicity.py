"""Toxicity by multiple-instance learning: sentences are instances, only documents carry labels.

A sentence scores ``p = sigmoid(bias + sum of the weights of its distinct words)``; a document
is toxic by a noisy-or over its sentences, ``P = 1 - (1 - leak) * prod(1 - p)``. The leak is
what wrong labels leave: without it every clean document that is labelled toxic would raise
all of its sentences, and long documents would add up to a toxic one. The fitted sentence
scores then locate what offends: ``toxic_sentences`` returns them with their spans.

Words are runs of ASCII letters (lower-cased), digits and bytes of other letters; a word and
its beginnings of ``STEM_BYTES`` bytes are hashed to ``FEATURES`` weights, so forms of one
stem share a weight. A sentence ends at ``.``, ``!``, ``?`` or a line end, and a longer one is
cut into instances of ``SENTENCE_WORDS`` words, so text without stops has no unbounded
instance. Texts over ``SPAN_BYTES`` are read in spans that end at a stop if there is one (else
between words); all words of all sentences count, at any length of text.

The fit reads about ``LABEL_ROWS`` labelled rows (those with the least hashes of the id: the
documented bound of the sample). Words in ``LEAST_DOCS`` sampled documents whose toxic share
stands ``LEAST_Z`` standard errors above the whole get a weight, from their log odds on; the
negative log likelihood with an L2 penalty is then minimised by limited-memory BFGS. A pass
is one Spark job over the stored sample, whose tasks (``FIT_TASKS`` at most) return one
gradient each. Scoring covers every document.

Defined results: a null or empty text has no sentence and scores the leak; a null ``doc_id``
counts as not held out and joins no label; a label row without a 0 or 1 teaches nothing; of
repeated label rows of one id the largest label counts; repeated documents score alike;
without any label, or with one class only, there are no weights and the score is the share
of toxic labels (0.0 where there are none).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tessera.llm.common import python_tasks, stored, table

#: Hashed weights; words of one instance; bytes of the beginnings that count beside the word.
FEATURES = 1 << 18
SENTENCE_WORDS = 32
STEM_BYTES = (4, 6)
#: Labelled rows of the fit, and its tasks; what a weighted word needs; L2 penalty; passes; bias at the start.
LABEL_ROWS = 40_000
FIT_TASKS = 24
LEAST_DOCS = 3
LEAST_Z = 4.0
PENALTY = 0.2
PASSES = 40
BIAS = -6.0
THRESHOLD = 0.3

_BYTE = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)
_WORD = ((_BYTE >= 48) & (_BYTE <= 57)) | ((_LOWER >= 97) & (_LOWER <= 122)) | (_BYTE >= 128)
_STOP = np.isin(_BYTE, np.frombuffer(b".!?\n", np.uint8))
#: Texts are read in pieces of about so many bytes, whatever the batch holds; a longer text in spans of at most so many.
PIECE_BYTES, SPAN_BYTES = 4 << 20, 1 << 20


def _pieces(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, offsets of their spans, the spans' rows, the spans' starts in their texts) of a string column, piece by piece."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    cuts, rows, starts, held = [], [], [], 0
    for row, (begin, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        at = begin
        while True:
            to = min(end, at + SPAN_BYTES)
            if to < end:
                window = data[at:to]
                good = np.flatnonzero(_STOP[window])
                good = good if len(good) else np.flatnonzero(~_WORD[window])
                to = at + int(good[-1]) + 1 if len(good) else to
            cuts.append(at)
            rows.append(row)
            starts.append(at - begin)
            held += to - at
            at = to
            if held >= PIECE_BYTES:
                edges = np.array([*cuts, at])
                yield data[edges[0]:at], edges - edges[0], np.array(rows), np.array(starts)
                cuts, rows, starts, held = [], [], [], 0
            if at >= end:
                break
    if cuts:
        edges = np.array([*cuts, offsets[-1]])
        yield data[edges[0]:edges[-1]], edges - edges[0], np.array(rows), np.array(starts)


def _number(h: np.ndarray, kind: int, features: int) -> np.ndarray:
    h = h ^ np.uint64((kind * 0x9E3779B97F4A7C15) & (2**64 - 1))
    h ^= h >> np.uint64(29)
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return ((h >> np.uint64(32)) % np.uint64(features)).astype(np.int64)


def instances(data: np.ndarray, offsets: np.ndarray, used: np.ndarray, features: int = FEATURES) -> dict[str, np.ndarray]:
    """Words and sentences of the spans of ``data`` between ``offsets``.

    ``span``, ``start`` and ``end`` (bytes) by sentence; ``sentence`` and ``word`` by distinct word of a sentence, in
    order, with the numbers that ``used`` gives to the features (-1: left out)."""
    low = _LOWER[data]
    inside = _WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True  # a word never runs into the next span
    begins = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]])))
    if not len(begins):
        none = np.zeros(0, np.int64)
        return {"span": none, "start": none, "end": none, "sentence": none, "word": none}
    ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    # a word's hash: its bytes times powers of a constant by their place in it, mixed
    length = ends - begins
    within = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    powers = np.cumprod(np.full(int(length.max()), 0x100000001B3, np.uint64))
    at = np.repeat(begins, length) + within
    terms = (low[at].astype(np.uint64) + np.uint64(1)) * powers[within]
    first = np.cumsum(length) - length
    numbers = [_number(np.add.reduceat(terms, first), 0, features)]
    for k in STEM_BYTES:  # inflected and compound forms share their beginning
        h = np.add.reduceat(np.where(within < k, terms, np.uint64(0)), first)
        numbers.append(np.where(length > k, _number(h, k, features), -1))
    # sentences: a stop or another text between two words, or too many words
    stops = np.cumsum(_STOP[data])
    span = np.searchsorted(offsets, begins, "right") - 1
    new = np.concatenate([[True], (np.diff(stops[begins]) > 0) | (np.diff(span) > 0)])
    run = np.flatnonzero(new)
    place = np.arange(len(begins)) - np.repeat(run, np.diff(np.concatenate([run, [len(begins)]])))
    new |= place % SENTENCE_WORDS == 0
    sentence = np.cumsum(new) - 1
    heads = np.flatnonzero(new)
    tails = np.concatenate([heads[1:], [len(begins)]]) - 1
    keys = [sentence[kept] * features + n[kept] for n in (np.where(n >= 0, used[n], -1) for n in numbers) for kept in [n >= 0]]
    pairs = np.unique(np.concatenate(keys))
    return {"span": span[heads], "start": begins[heads], "end": ends[tails], "sentence": pairs // features, "word": pairs % features}


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.maximum(x, 0) + np.log1p(np.exp(-np.abs(x)))


def _logits(found: dict[str, np.ndarray], weights: np.ndarray, bias: float) -> np.ndarray:
    return bias + np.bincount(found["sentence"], weights[found["word"]], minlength=len(found["start"]))


def loss_and_gradient(found: dict[str, np.ndarray], labels: np.ndarray, theta: np.ndarray) -> tuple[float, np.ndarray]:
    """Negative log likelihood of the documents' labels; ``doc`` is each sentence's document, theta: weights, bias, leak's logit."""
    weights, bias, leak = theta[:-2], theta[-2], theta[-1]
    logits = _logits(found, weights, bias)
    clean = -np.bincount(found["doc"], _softplus(logits), minlength=len(labels)) - _softplus(leak)  # log of (1 - leak) * prod(1 - p)
    clean = np.minimum(clean, -1e-12)
    toxic = np.log(-np.expm1(clean))
    pull = np.where(labels == 1, -np.exp(clean - toxic), 1.0)
    by_sentence = pull[found["doc"]] * np.exp(-_softplus(-logits))
    gradient = np.zeros(len(theta))
    gradient[:-2] = np.bincount(found["word"], by_sentence[found["sentence"]], minlength=len(weights))
    gradient[-2] = by_sentence.sum()
    gradient[-1] = (pull * np.exp(-_softplus(-leak))).sum()
    return -float(np.where(labels == 1, toxic, clean).sum()), gradient


def minimise(theta: np.ndarray, value, passes: int = PASSES, memory: int = 8, tolerance: float = 1e-4) -> np.ndarray:
    """Limited-memory BFGS with a halving line search; ``value(theta)`` gives loss and gradient."""
    loss, gradient = value(theta)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    used, least = 1, None
    while used < passes:
        step, alphas = gradient.copy(), []
        for s, y in reversed(pairs):
            alphas.append((s @ step) / (y @ s))
            step -= alphas[-1] * y
        step *= (pairs[-1][0] @ pairs[-1][1]) / (pairs[-1][1] @ pairs[-1][1]) if pairs else 1 / max(1.0, float(np.abs(gradient).max()))
        for (s, y), a in zip(pairs, reversed(alphas)):
            step += (a - (y @ step) / (y @ s)) * s
        slope, rate = float(gradient @ step), 1.0
        while True:
            moved = theta - rate * step
            new_loss, new_gradient = value(moved)
            used += 1
            if new_loss <= loss - 1e-4 * rate * slope or used >= passes:
                break
            rate /= 4
        if new_loss > loss:
            break
        s, y = moved - theta, new_gradient - gradient
        if s @ y > 1e-10:
            pairs = [*pairs, (s, y)][-memory:]
        least = loss - new_loss
        theta, loss, gradient = moved, new_loss, new_gradient
        if least <= tolerance * max(1.0, abs(loss)):
            break
    return theta


class Model(NamedTuple):
    """``used``: feature to weight (-1: none). ``bias`` None: there was nothing to tell apart, every text has the leak as score."""

    used: np.ndarray
    weights: np.ndarray
    bias: float | None
    leak: float


def _arrow(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, documents, toxic documents) of a task's rows (label, text)."""
    every, counts = np.arange(FEATURES), np.zeros((2, FEATURES), np.int64)
    for batch in batches:
        labels = batch.column("label").to_numpy()
        seen = []
        for data, offsets, rows, _ in _pieces(batch.column("text")):
            found = instances(data, offsets, every)
            seen.append(np.unique(rows[found["span"][found["sentence"]]] * FEATURES + found["word"]))
        pairs = np.unique(np.concatenate(seen)) if seen else np.zeros(0, np.int64)
        counts[0] += np.bincount(pairs % FEATURES, minlength=FEATURES)
        counts[1] += np.bincount((pairs % FEATURES)[labels[pairs // FEATURES] == 1], minlength=FEATURES)
    word = np.flatnonzero(counts[0])
    yield _arrow({"word": pa.array(word), "docs": pa.array(counts[0, word]), "toxic": pa.array(counts[1, word])})


def _reduced(used: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task's sample as sparse lists over the weighted words alone: one row per batch."""
        for batch in batches:
            docs, sentences, words, n = [], [], [], 0
            for data, offsets, rows, _ in _pieces(batch.column("text")):
                found = instances(data, offsets, used)
                docs.append(rows[found["span"]])
                sentences.append(found["sentence"] + n)
                words.append(found["word"])
                n += len(found["start"])
            lists = [batch.column("label").to_numpy().astype(np.int64), *(np.concatenate([np.zeros(0, np.int64), *x]) for x in (docs, sentences, words))]
            yield _arrow({c: pa.array([x], pa.list_(pa.int64())) for c, x in zip(("label", "doc", "sentence", "word"), lists)})
    return run


def _gradient(theta: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, total = 0.0, np.zeros(len(theta))
        for batch in batches:
            for k in range(batch.num_rows):
                label, doc, sentence, word = (batch.column(c)[k].values.to_numpy() for c in ("label", "doc", "sentence", "word"))
                part = loss_and_gradient({"doc": doc, "start": doc, "sentence": sentence, "word": word}, label, theta)
                loss, total = loss + part[0], total + part[1]
        yield _arrow({"loss": pa.array([loss]), "gradient": pa.array([total.tobytes()], pa.binary())})
    return run


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", rows: int = LABEL_ROWS) -> Model:
    """The model of documents joined with (key, label) rows; the caller leaves out what is held out."""
    spark = docs.sparkSession
    python_tasks(spark)
    known = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.max(label).cast("int").alias("label"))
    n = known.count()
    if n > rows:
        known = known.filter(F.pmod(F.xxhash64("_key"), F.lit(1 << 32)) < int(rows / n * (1 << 32)))
    # the sample is bounded by ``rows``, so its ids may be sent to all tasks
    sample = stored(docs.select(F.col(key).alias("_key"), F.col(text).alias("text")).join(F.broadcast(known), "_key").select("label", "text").repartition(FIT_TASKS))
    n, toxic = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).head()
    share = toxic / n if n else 0.0
    if not 0 < share < 1:
        return Model(np.full(FEATURES, -1), np.zeros(0), None, share)
    counts = sample.mapInArrow(_word_counts, "word bigint, docs bigint, toxic bigint").groupBy("word").agg(F.sum("docs").alias("docs"), F.sum("toxic").alias("toxic"))
    above = (F.col("toxic") - F.col("docs") * share) / F.sqrt(F.col("docs") * (share * (1 - share)))
    odds = F.log((F.col("toxic") + share) / (F.col("docs") - F.col("toxic") + (1 - share)) * ((1 - share) / share))
    found = counts.filter((F.col("docs") >= LEAST_DOCS) & (above > LEAST_Z)).select("word", F.least(odds, F.lit(-BIAS)).alias("odds")).orderBy("word").toPandas()
    used = np.full(FEATURES, -1)
    used[found["word"].to_numpy(np.int64)] = np.arange(len(found))
    sample = stored(sample.mapInArrow(_reduced(used), "label array<bigint>, doc array<bigint>, sentence array<bigint>, word array<bigint>"))

    def value(theta: np.ndarray) -> tuple[float, np.ndarray]:
        parts = sample.mapInArrow(_gradient(theta), "loss double, gradient binary").collect()
        parts.sort(key=lambda r: (r["loss"], bytes(r["gradient"])))  # a rerun adds in the same order
        weights = np.concatenate([theta[:-2], [0.0, 0.0]])
        return (sum(r["loss"] for r in parts) + PENALTY / 2 * float(weights @ weights),
                sum(np.frombuffer(r["gradient"], np.float64) for r in parts) + PENALTY * weights)

    theta = minimise(np.concatenate([found["odds"].to_numpy(np.float64), [BIAS, -4.0]]), value)
    return Model(used, theta[:-2], float(theta[-2]), float(np.exp(-_softplus(-theta[-1]))))


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = np.full(batch.num_rows, np.log1p(-min(model.leak, 1 - 1e-12)))
            if model.bias is not None:
                for data, offsets, rows, _ in _pieces(batch.column("_text")):
                    found = instances(data, offsets, model.used)
                    clean -= np.bincount(rows[found["span"]], _softplus(_logits(found, model.weights, model.bias)), minlength=batch.num_rows)
            yield _arrow({"_row": batch.column("_row"), "_score": pa.array(np.clip(-np.expm1(clean), 0.0, 1.0))})
    return run


def _locate(model: Model, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, offsets, rows, starts in _pieces(batch.column("_text")) if model.bias is not None else ():
                found = instances(data, offsets, model.used)
                p = np.exp(-_softplus(-_logits(found, model.weights, model.bias)))
                k = np.flatnonzero(p >= least)
                span, raw = found["span"][k], data.tobytes()
                shift = starts[span] - offsets[:-1][span]
                yield _arrow({"_row": batch.column("_row").take(pa.array(rows[span])), "_start": pa.array(found["start"][k] + shift), "_end": pa.array(found["end"][k] + shift),
                              "_sentence": pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(found["start"][k].tolist(), found["end"][k].tolist())], pa.string()),
                              "_score": pa.array(p[k])})
    return run


def toxicity_scores(docs: DataFrame, model: Model, text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """One row per document: its columns in struct ``_row``, and ``_score``."""
    python_tasks(docs.sparkSession)
    rows = docs.select(F.struct(*(columns or docs.columns)).alias("_row"), F.col(text).alias("_text"))
    return rows.mapInArrow(_score(model), StructType([rows.schema["_row"], StructField("_score", DoubleType())]))


def toxic_sentences(docs: DataFrame, model: Model, text: str = "text", columns: list[str] | None = None, least: float = THRESHOLD) -> DataFrame:
    """The sentences that score ``least`` or more: ``_row``, ``_start`` and ``_end`` (UTF-8 bytes), ``_sentence``, ``_score``."""
    python_tasks(docs.sparkSession)
    rows = docs.select(F.struct(*(columns or docs.columns)).alias("_row"), F.col(text).alias("_text"))
    return rows.mapInArrow(_locate(model, least), StructType([rows.schema["_row"], StructField("_start", LongType()), StructField("_end", LongType()),
                                                              StructField("_sentence", StringType()), StructField("_score", DoubleType())]))


def held_out(key: Column, parts: int = 4, part: int = 2) -> Column:
    """Rows that teach nothing: crc32 of the id as text leaves ``part`` (a null id: false)."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == part, F.lit(False))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = fit(docs, labels.filter(~held_out(F.col("doc_id"))))
    scored = toxicity_scores(docs, model, columns=["doc_id"])
    return scored.select(F.col("_row.doc_id").alias("doc_id"), held_out(F.col("_row.doc_id")).alias("held_out"), F.col("_score").alias("score"),
                         (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))
