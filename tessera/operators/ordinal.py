"""Deterministic splits, folds, samples and distributed ordinals.

Rules held here (SURVEY §4.3): no un-partitioned window over raw rows, no
``rand()``/``randomSplit``/``monotonically_increasing_id`` (their values change
when a partition is recomputed), ties always broken by an explicit key.
A global order is built as a *distributed ordinal*: data-derived buckets,
a small table of bucket totals turned into offsets, and a window only within
each bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import HASH_SPACE, hash_key

HASH_BUCKETS = 1 << 14          # equal hash ranges: balanced, need no count
ROWS_PER_BUCKET = 2_000_000     # rows one window task sorts, at most about
MIN_BUCKETS = 16
QUANTILE_RESOLUTION = 1024      # value buckets per group, at most
DEFAULT_BUCKETS = HASH_BUCKETS


def _thresholds(fractions: Sequence[float]) -> list[int]:
    """Cumulative integer cut points on the 28-bit hash space."""
    out, acc = [], 0.0
    for f in fractions[:-1]:
        acc += f
        out.append(int(acc * HASH_SPACE))
    return out


def split_assign(df: DataFrame, id_col: str = "row_id", seed: int = 42,
                 fractions: Sequence[float] = (0.6, 0.2, 0.2),
                 names: Sequence[str] = ("train", "val", "test"),
                 out_col: str = "split") -> DataFrame:
    """E5: shuffled, non-stratified split by a keyed hash of the row id.

    A pure per-row projection: no shuffle, identical under any partitioning.
    Sizes follow the fractions in expectation; ``split_exact`` gives the
    reference's exact floor/ceil sizes at the cost of one ordinal pass.
    """
    h = hash_key(id_col, seed)
    cuts = _thresholds(fractions)
    expr = None
    for cut_, name in zip(cuts, names[:-1]):
        expr = F.when(h < cut_, F.lit(name)) if expr is None else expr.when(h < cut_, F.lit(name))
    return df.withColumn(out_col, expr.otherwise(F.lit(names[-1])))


def hash_ordinal(df: DataFrame, id_col: str = "row_id", seed: int = 42,
                 partition_cols: Sequence[str] = (), n_buckets: int | None = None,
                 out_col: str = "ordinal", purpose: str = "") -> DataFrame:
    """1-based position of each row in (hash, id) order, per ``partition_cols``.

    Rows are counted per fine bucket (2^14 equal ranges of the uniform hash,
    balanced whatever the keys). On that small table (groups x 2^14 rows at
    most) running totals give each fine bucket its offset and merge runs of
    consecutive fine buckets into windows of about ``ROWS_PER_BUCKET`` rows.
    The row-level window then sorts one such run per task, whatever the data
    size, and no job is spent sizing it.
    """
    part = list(partition_cols)
    fine = n_buckets or HASH_BUCKETS
    h = hash_key(id_col, seed, purpose)
    x = df.withColumns({"__h": h, "__f": (h * fine / HASH_SPACE).cast("int")})
    counts = x.groupBy(*part, "__f").agg(F.count(F.lit(1)).alias("__n"))
    w_off = Window.partitionBy(*part).orderBy("__f").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counts.withColumn("__off", F.coalesce(F.sum("__n").over(w_off), F.lit(0)))
                     .withColumn("__b", F.floor(F.col("__off") / ROWS_PER_BUCKET).cast("int")))
    # offset of a coarse run = offset of its first fine bucket
    offsets = offsets.withColumn("__start", F.min("__off").over(Window.partitionBy(*part, "__b")))
    w_in = Window.partitionBy(*part, "__b").orderBy("__h", id_col)
    # null-safe, so a row with a NULL group keeps its place in the NULL group
    keys = [*part, "__f"]
    o = offsets.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(keys)], "__b", "__start")
    on = F.lit(True)
    for i, c in enumerate(keys):
        on &= F.col(c).eqNullSafe(F.col(f"__k{i}"))
    ranked = x.join(o, on).drop(*[f"__k{i}" for i in range(len(keys))])
    return (ranked.withColumn(out_col, F.col("__start") + F.row_number().over(w_in))
                  .drop("__h", "__f", "__b", "__start"))


def split_exact(df: DataFrame, id_col: str = "row_id", seed: int = 42, train_size: float = 0.6,
                out_col: str = "split", n_buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """E5 with the reference's exact sizes: train floor(0.6 n); the remainder
    halves with val = floor(rem/2), test = ceil(rem/2)."""
    x = hash_ordinal(df, id_col, seed, (), n_buckets, "__ord")
    n = df.count()
    n_train = int(train_size * n)
    rem = n - n_train
    n_val = rem - (rem + 1) // 2
    return (x.withColumn(out_col, F.when(F.col("__ord") <= n_train, "train")
                         .when(F.col("__ord") <= n_train + n_val, "val").otherwise("test"))
             .drop("__ord"))


def fold_assign(df: DataFrame, k: int = 5, id_col: str = "row_id", seed: int = 42,
                out_col: str = "fold") -> DataFrame:
    """Shuffled k-fold ids, ``pmod(hash, k)``; a per-row projection."""
    return df.withColumn(out_col, F.pmod(hash_key(id_col, seed, "fold"), F.lit(k)).cast("int"))


def stratified_fold_assign(df: DataFrame, label_col: str = "label", k: int = 5,
                           id_col: str = "row_id", seed: int = 42, out_col: str = "fold",
                           n_buckets: int = DEFAULT_BUCKETS, group_cols: Sequence[str] = ()) -> DataFrame:
    """Folds balanced per class: ordinal within the class in hash order,
    taken modulo k, so every fold's class count differs by at most one.
    ``group_cols`` keeps independent copies (e.g. one per model) apart."""
    x = hash_ordinal(df, id_col, seed, [*group_cols, label_col], n_buckets, "__ord", "fold")
    return x.withColumn(out_col, F.pmod(F.col("__ord") - 1, F.lit(k)).cast("int")).drop("__ord")


def sample_rows(df: DataFrame, n: int, id_col: str = "row_id", seed: int = 42) -> DataFrame:
    """uniform sample of ``n`` rows without replacement, only above the cap.

    The sample is the ``n`` rows with the smallest keyed hash (ties by id), so
    it is repeatable and independent of partitioning. One aggregate counts
    rows under each power-of-two hash threshold; the smallest threshold
    holding at least ``n`` rows (about 2n, the hash being uniform) filters
    the rows and only those survivors are sorted. A sampling operator: the
    limit is the feature.
    """
    h = hash_key(id_col, seed, "sample")
    x = df.withColumn("__h", h)
    # one pass: rows below each power-of-two fraction of the hash space
    cuts = [HASH_SPACE >> j for j in range(0, 28)]
    counts = x.agg(*[F.sum((F.col("__h") < c).cast("long")).alias(f"c{j}") for j, c in enumerate(cuts)]).first()
    if counts["c0"] is None or counts["c0"] <= n:
        return df
    t = min(c for j, c in enumerate(cuts) if counts[f"c{j}"] >= n)
    return x.filter(F.col("__h") < t).orderBy("__h", id_col).limit(n).drop("__h")


def value_prefix_sums(df: DataFrame, part_cols: Sequence[str], value_col: str,
                      weight_cols: Sequence[str], descending: bool = False,
                      n_buckets: int | None = None, accuracy: int = 10000, few_groups: bool = False) -> DataFrame:
    """Running totals of ``weight_cols`` in value order within each group.

    ``df`` holds one row per (group, distinct value) with its weights (already
    aggregated, so a hot value is one row). Adds ``cum_<w>`` (inclusive) and
    ``before_<w>`` (exclusive). Buckets come from approximate quantiles of the
    value per group (count sized from the data when ``n_buckets`` is None);
    equal values always share a bucket, so the result is exact whatever the
    quantiles are. Only the bucket totals (groups x
    n_buckets rows) are ordered globally. With ``few_groups`` (a bounded number of
    them) boundaries and totals are broadcast and the rows move once.
    """
    part = list(part_cols)
    small = F.broadcast if few_groups else (lambda t: t)
    v = F.col(value_col)
    key = -v if descending else v
    x = df.withColumn("__k", key.cast("double"))
    if not part:                       # a single group: a constant key column
        x, part = x.withColumn("__g", F.lit(0)), ["__g"]
    if n_buckets is None:
        # one job: quantiles at a fixed resolution and the group's row count;
        # each group keeps every step-th boundary, step chosen from its count
        res = QUANTILE_RESOLUTION
        probs = [i / res for i in range(1, res)]
        bounds = x.groupBy(*part).agg(F.percentile_approx("__k", probs, accuracy).alias("__all"),
                                      F.count(F.lit(1)).alias("__cnt"))
        nb = F.least(F.lit(res), F.greatest(F.lit(MIN_BUCKETS), F.ceil(F.col("__cnt") / ROWS_PER_BUCKET)))
        step = F.floor(F.lit(res) / nb)
        bounds = bounds.select(*part, F.filter("__all", lambda b, i: F.pmod(i + 1, step) == 0).alias("__bounds"))
    else:
        probs = [i / n_buckets for i in range(1, n_buckets)]
        bounds = x.groupBy(*part).agg(F.percentile_approx("__k", probs, accuracy).alias("__bounds"))
    x = x.join(small(bounds), on=part, how="inner")
    x = x.withColumn("__b", F.size(F.filter("__bounds", lambda b: b < F.col("__k")))).drop("__bounds")
    tot = x.groupBy(*part, "__b").agg(*[F.sum(w).alias(f"__t_{w}") for w in weight_cols])
    w_off = Window.partitionBy(*part).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(*part, "__b", *[F.coalesce(F.sum(f"__t_{w}").over(w_off), F.lit(0)).alias(f"__o_{w}")
                                     for w in weight_cols])
    x = x.join(small(tot), on=[*part, "__b"], how="inner")
    w_in = (Window.partitionBy(*part, "__b").orderBy("__k")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cols = {}
    for w in weight_cols:
        cols[f"cum_{w}"] = F.col(f"__o_{w}") + F.sum(w).over(w_in)
    x = x.withColumns(cols)
    x = x.withColumns({f"before_{w}": F.col(f"cum_{w}") - F.col(w) for w in weight_cols})
    return x.drop("__k", "__b", "__g", *[f"__o_{w}" for w in weight_cols])
