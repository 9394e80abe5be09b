"""Mixing sources to target weights by entropy balancing.

Every source gets a token target. Document rates minimise the entropy distance from
"every document once" under the source's token constraint and a ceiling of
``MAX_COPIES``: the dual has one multiplier a source, and the rate of a document is
``min(MAX_COPIES, exp(multiplier * size / mean size))``, an exponential tilt by size.

Documents of one source and size are alike, so the table is first reduced to cells
(source, size, number of documents). Newton iterations run on the cells as one
aggregation over all sources, with a bracket kept as a guard; multipliers stay a table
and only the largest gap comes to the driver. Rates are rounded to whole copies a cell by
error diffusion from the largest size down, so what is left of a source's target ends
below its smallest documents. Copies go to the documents of a cell by the rank of a hash,
counted in two steps, so a cell with a third of all rows is no single task.

Defined results: a null or empty text has size 0, one copy and takes nothing; a null
source is a source of its own, after all others; a table without words has targets of 0;
repeated rows are documents of their own (equal ids rank arbitrarily, with equal sizes).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import stored, table
from tessera.llm.quality import words

#: Weights of the sources in code point order, repeating; words to take, in parts of all words; copies of a document at most.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_COPIES = 2
#: Documents of one cell that one window task ranks, on average.
RANKED_ROWS = 1000
NEWTON_STEPS, GAP = 60, 1e-8
#: ``monotonically_increasing_id`` holds the partition above these bits, the row's place in it below.
PARTITION_BITS = 33


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, target): shares by weight, stopped at ``most`` times the source's size, the excess shared again."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # numbered by column expressions: a Python RDD would start a second set of Python workers beside the SQL ones
    ordered = stored(sizes.orderBy(F.col("source").asc_nulls_last()).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", PARTITION_BITS)
    before, offsets = 0, []
    for p, n in sorted(ordered.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()):
        offsets += [F.lit(p), F.lit(before % len(weights))]
        before += n
    at = F.col("_at").bitwiseAND((1 << PARTITION_BITS) - 1) + (F.element_at(F.create_map(*offsets), part) if offsets else F.lit(0))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (at % len(weights) + 1).cast("int"))
    sources = stored(ordered.select("source", "source_size", weight.alias("weight")))
    stop = most * F.col("source_size")
    total, level, last = sources.agg(F.sum("source_size")).head()[0] or 0, 0.0, None
    while True:
        full = stop < F.lit(level) * F.col("weight")
        taken, free, n = sources.agg(F.sum(F.when(full, stop).otherwise(0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))), F.count(F.when(full, 1))).head()
        if n == last or not free:
            break
        last, level = n, (share * total - taken) / free
    return sources.select("source", "source_size", F.least(stop.cast("double"), F.lit(level) * F.col("weight")).alias("target"))


def _rate(x: Column, multiplier: Column, most: int) -> Column:
    """exp(multiplier * x), at most ``most``; all at ``most`` where the target leaves no choice (null multiplier)."""
    return F.when(multiplier.isNull(), F.lit(float(most))).otherwise(F.exp(F.least(multiplier * x, F.lit(math.log(most)))))


def balance(cells: DataFrame, targets: DataFrame, most: int = MAX_COPIES, steps: int = NEWTON_STEPS, gap: float = GAP) -> DataFrame:
    """(source, multiplier, mean): Newton on the dual of all sources at once. ``cells`` holds sizes above 0."""
    mean = cells.groupBy("source").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"), F.sum(F.col("n") * F.col("size")).alias("words"))
    state = stored(mean.join(targets, mean["source"].eqNullSafe(targets["source"])).select(
        mean["source"].alias("_s"), "mean", "words", "target", F.when(F.col("target") >= most * F.col("words") * (1 - 1e-12), F.lit(None)).otherwise(F.lit(0.0)).cast("double").alias("at"),
        F.lit(-1e3).alias("low"), F.lit(1e3).alias("high")))
    for _ in range(steps):
        x = F.col("size") / F.col("mean")
        rate = _rate(x, F.col("at"), most)
        sums = (cells.join(state.select("_s", "mean", "at").filter("at IS NOT NULL"), F.col("source").eqNullSafe(F.col("_s"))).groupBy("_s")
                .agg(F.sum(F.col("n") * F.col("size") * rate).alias("got"),
                     F.sum(F.when(rate < most, F.col("n") * F.col("size") * x * rate).otherwise(0.0)).alias("slope"))
                .select(F.col("_s").alias("_t"), "got", "slope"))
        over = F.col("got") > F.col("target")
        low, high = F.when(over, F.col("low")).otherwise(F.col("at")), F.when(over, F.col("at")).otherwise(F.col("high"))
        newton = F.col("at") - (F.col("got") - F.col("target")) / F.when(F.col("slope") > 0, F.col("slope"))
        done = F.abs(F.col("got") - F.col("target")) <= gap * F.col("target")
        step = F.when(done, F.col("at")).when((newton > low) & (newton < high), newton).otherwise((low + high) / 2)
        state = stored(state.join(sums, F.col("_s").eqNullSafe(F.col("_t")), "left").select(
            "_s", "mean", "words", "target", F.when(F.col("at").isNotNull(), step).alias("at"), low.alias("low"), high.alias("high"),
            F.coalesce(F.abs(F.col("got") - F.col("target")) / F.col("target"), F.lit(0.0)).alias("gap")))
        if (state.agg(F.max("gap")).head()[0] or 0.0) <= gap:
            break
        state = state.drop("gap")
    # fewer digits than the sums have: a rerun that adds in another order gets the same rates
    return state.select(F.col("_s").alias("source"), F.round("at", 9).alias("multiplier"), "mean")


def _round_copies(most: int):
    def fit(cells: pd.DataFrame) -> pd.DataFrame:
        """Whole copies a cell, from the largest size down; the error of one cell goes to the next."""
        cells = cells.sort_values("size", ascending=False, kind="stable")
        copies, error = [], 0.0
        for size, n, rate in zip(cells["size"].tolist(), cells["n"].tolist(), cells["rate"].tolist()):
            wanted = n * rate + error / size
            k = int(min(most * n, max(0, math.floor(wanted + 0.5))))
            error = (wanted - k) * size
            copies.append(k)
        return cells[["source", "size", "n"]].assign(copies=np.array(copies, np.int64))
    return fit


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", columns: list[str] | None = None,
        weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MAX_COPIES) -> DataFrame:
    """One row per document: its columns in struct ``_row``, ``_size``, ``_source_size``, ``_target`` and ``_copies``."""
    columns = docs.columns if columns is None else columns
    sized = docs.select(F.xxhash64(key).alias("_hash"), F.col(key).alias("_key"), F.col(source).cast("string").alias("source"),
                        F.size(words(F.col(text))).cast("bigint").alias("size"))
    by_size = stored(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    targets = stored(source_targets(by_size.select("source", (F.col("size") * F.col("n")).alias("size")), weights, share, most))
    cells = by_size.filter("size > 0")
    dual = balance(cells, targets, most)
    rated = (cells.join(dual.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
             .select("source", "size", "n", _rate(F.col("size") / F.col("mean"), F.col("multiplier"), most).alias("rate")))
    copies = stored(rated.groupBy("source").applyInPandas(_round_copies(most), "source string, size bigint, n bigint, copies bigint"))

    # a cell's copies go to parts of it, then to the documents of a part
    parts = max(1, -(-docs.count() // RANKED_ROWS))
    part = F.pmod(F.xxhash64(F.lit(1), F.col("_hash")), F.lit(parts)).cast("int").alias("part")
    counted = sized.select("source", "size", part).groupBy("source", "size", "part").agg(F.count(F.lit(1)).alias("m"))
    before = Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    c = copies.select(F.col("source").alias("_s"), F.col("size").alias("_z"), "n", "copies")
    quota = counted.withColumn("before", F.coalesce(F.sum("m").over(before), F.lit(0))).join(c, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")), "left")
    extra = F.col("copies") % F.col("n")
    upto = lambda k: F.floor(k * extra / F.col("n"))
    t = targets.select(F.col("source").alias("_t"), "source_size", "target")
    quota = stored(quota.join(t, F.col("source").eqNullSafe(F.col("_t"))).select(
        F.col("source").alias("_s"), F.col("size").alias("_z"), F.col("part").alias("_p"), "source_size", "target",
        F.coalesce(F.floor(F.col("copies") / F.col("n")), F.lit(1)).alias("each"),
        F.coalesce(upto(F.col("before") + F.col("m")) - upto(F.col("before")), F.lit(0)).alias("more")))
    row = docs.select(F.struct(*columns).alias("_row"), F.xxhash64(key).alias("_hash"), F.col(key).alias("_key"), F.col(source).cast("string").alias("source"),
                      F.size(words(F.col(text))).cast("bigint").alias("size")).withColumn("part", part)
    placed = row.join(quota, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")) & (F.col("part") == F.col("_p")))
    rank = F.row_number().over(Window.partitionBy("source", "size", "part").orderBy("_hash", "_key"))
    return placed.withColumn("_rank", rank).select(
        "_row", F.col("size").alias("_size"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"),
        (F.col("each") + F.when(F.col("_rank") <= F.col("more"), 1).otherwise(0)).cast("bigint").alias("_copies"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), columns=["doc_id", "source"])
    return mixed.select(F.col("_row.doc_id").alias("doc_id"), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
                        F.col("_target").alias("target"), (F.col("_copies") * F.col("_size")).alias("taken"),
                        F.col("_row.source").alias("source"), F.col("_copies").alias("copies"))
