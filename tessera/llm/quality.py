"""Quality rules as a short-circuit cascade.

Each rule is a boolean expression over a text that is true for a document to reject.
``plan_cascade`` runs every rule on a sample of about ``sample_rows`` documents, measures
its seconds and the share it rejects, and orders the rules by rejection per cost. The
verdict is one CASE expression in that order, so a document pays for rules up to the
first that rejects it. The sample sets the order only: every rule is a pure function of
the document, so whether it is kept never depends on the order.

All measures are column expressions (arrays and higher-order functions inside one row):
no shuffle, no Python, no state beside the row, and a hot source costs no more than any
other. Repeats of word windows are found by sorting (hash, position) pairs inside the row.

Defined results: a null or empty text has no words and fails; equal documents get equal
verdicts; a window's hash is 64 bits wide, compared within one text only; a document
column that happens to be called like a measure is not read.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import table

#: White space that parts words.
SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: Most words in repeated 3-word windows, in percent.
MAX_REPEAT_PERCENT = 50
#: Fewer repeated lines than this reject no document, however short.
MIN_DUP_LINES = 3
SAMPLE_ROWS = 2000


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def word_chars(text: Column) -> Column:
    return F.length(F.translate(F.coalesce(text, F.lit("")), SPACE, "")).cast("bigint")


def n_symbols(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint")


def worded_lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: F.translate(line, SPACE, "") != "")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def n_dup_lines(text: Column) -> Column:
    return _let(worded_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint")


def n_repeat_words(text_words: Column) -> Column:
    """Words inside 3-word windows that the text holds twice or more."""
    def covered(starts: Column) -> Column:
        return F.aggregate(F.transform(starts, lambda p, k: F.coalesce(F.least(F.lit(3), F.get(starts, k + 1) - p), F.lit(3))),
                           F.lit(0), lambda n, x: n + x)

    def starts(ordered: Column) -> Column:
        same = F.filter(ordered, lambda x, k: (F.get(ordered, k - 1)["h"] == x["h"]) | (F.get(ordered, k + 1)["h"] == x["h"]))
        return F.sort_array(F.transform(same, lambda x: x["i"]))

    def windows(w: Column) -> Column:
        return F.transform(F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))),
                           lambda a, i: F.struct(F.xxhash64(a, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))

    return _let(text_words, lambda w: _let(F.sort_array(windows(w)), lambda o: _let(starts(o), covered))).cast("bigint")


def rules(text: Column) -> dict[str, Column]:
    """Name and rejecting condition of every rule; the first two are the base rules."""
    body = F.coalesce(text, F.lit(""))
    letters = F.length(F.regexp_replace(body, "[^\\p{L}]+", ""))
    upper = F.length(F.regexp_replace(body, "[^\\p{Lu}]+", ""))
    return {
        "few_words": F.size(words(text)) < MIN_WORDS,
        "repeated_windows": _let(words(text), lambda w: 100 * n_repeat_words(w) > MAX_REPEAT_PERCENT * F.size(w)),
        "symbols": 10 * n_symbols(text) > word_chars(text),
        "repeated_lines": _let(worded_lines(text), lambda x: _let(F.size(x) - F.size(F.array_distinct(x)), lambda d: (d >= MIN_DUP_LINES) & (10 * d > 3 * F.size(x)))),
        "table_cells": _let(words(text), lambda w: 20 * F.size(F.filter(w, lambda x: x == "|")) > F.size(w)),
        "shouting": _let(F.struct(upper.alias("u"), letters.alias("l")), lambda x: 2 * x["u"] > x["l"]),
        "few_letters": 10 * letters < 6 * word_chars(text),
        "word_length": _let(F.struct(F.size(words(text)).alias("n"), word_chars(text).alias("c")),
                            lambda x: (x["c"] < 2 * x["n"]) | (x["c"] > 20 * x["n"])),
    }


def plan_cascade(docs: DataFrame, found: dict[str, Column], key: str, sample_rows: int = SAMPLE_ROWS) -> list[tuple[str, float, float]]:
    """(rule, share rejected, seconds on the sample), by rejection per second, most first."""
    n = docs.count()
    keep = max(1, n // sample_rows)
    sample = docs.filter(F.pmod(F.xxhash64(key), F.lit(keep)) == 0).persist()
    try:
        size = max(1, sample.count())
        measured = []
        for name, rule in found.items():
            began = time.perf_counter()
            rejected = sample.agg(F.sum(F.when(rule, 1).otherwise(0))).head()[0] or 0
            measured.append((name, rejected / size, time.perf_counter() - began))
    finally:
        sample.unpersist()
    return sorted(measured, key=lambda m: (-m[1] / m[2], m[2], m[0]))


def verdict(order: list[str], found: dict[str, Column]) -> Column:
    """The first rule in this order that rejects the document, else null."""
    first, *rest = order
    out = F.when(F.coalesce(found[first], F.lit(False)), F.lit(first))
    for name in rest:
        out = out.when(F.coalesce(found[name], F.lit(False)), F.lit(name))
    return out


def quality_filter(docs: DataFrame, text: str = "text", key: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that no rule rejects, all their columns unchanged."""
    found = rules(F.col(text))
    order = [name for name, _, _ in plan_cascade(docs.select(key, text), found, key, sample_rows)]
    return docs.filter(verdict(order, found).isNull())


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = rules(F.col("text"))
    planned = [name for name, _, _ in plan_cascade(docs, found, "doc_id")]
    # what the base columns measure anyway, the verdict reads from them
    text = F.col("text")
    measured = docs.select(
        "doc_id", "text", words(text).alias("_words"), word_chars(text).alias("word_chars"), n_symbols(text).alias("n_symbols"),
        n_dup_lines(text).alias("n_dup_lines"))
    measured = measured.select("*", F.size("_words").cast("bigint").alias("n_words"), n_repeat_words(F.col("_words")).alias("n_repeat_words"))
    known = found | {
        "few_words": F.col("n_words") < MIN_WORDS,
        "repeated_windows": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"),
        "symbols": 10 * F.col("n_symbols") > F.col("word_chars"),
        "table_cells": 20 * F.size(F.filter("_words", lambda x: x == "|")) > F.col("n_words"),
        "word_length": (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 20 * F.col("n_words")),
    }
    failed = known["few_words"] | known["repeated_windows"]
    return measured.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                           verdict(planned, known).isNull().alias("kept"))


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS p FROM w, unnest(range(1, len(ws) - 1)) AS r(i)),
d AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, p) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat FROM d, unnest(range(0, 3)) AS s(k) GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words,
             len(lines) AS n_lines, len(list_filter(ws, lambda x: x = '|')) AS n_cells, length(regexp_replace(text, '[^\p{L}]+', '', 'g')) AS letters, length(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) AS upper
      FROM w LEFT JOIN c USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > word_chars OR n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines OR 20 * n_cells > n_words
            OR 2 * upper > letters OR 10 * letters < 6 * word_chars OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM m
"""
