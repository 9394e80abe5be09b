"""Encoding and scaling without leakage.

Vocabularies and scaling statistics are fitted on the training rows only and
applied to every split. Vocabularies are small model state: their size is
checked before they are broadcast to the row-side joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import nan_string
from ..session import stored


def fit_vocabulary(df: DataFrame, columns: Sequence[str], keep_missing: bool = True) -> DataFrame:
    """``(column, value, code)``: distinct values per column, sorted, coded 0..k-1.

    Values are the ``nan``-string form (X7), as the reference's
    ``astype(str)``. Distinct values (map-side combined, so a hot value is one
    row) are sorted by range over all tasks and numbered; a value's code is its
    number less the first of its column, so no task holds a column's
    vocabulary. The result is stored, as an ML fit is: lookups never re-run the
    input, and its known size decides between a broadcast and a shuffled join.
    ``keep_missing=False`` leaves missing out (one-hot: ``get_dummies``
    gives a missing value no dummy).
    """
    val = nan_string if keep_missing else (lambda c: F.col(c).cast("string"))
    long = (df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), val(c).alias("value"))
                                          for c in columns])).alias("kv"))
              .select("kv.column", "kv.value").where(F.col("value").isNotNull()).distinct())
    numbered = long.sort("column", "value").rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], x[1]))
    numbered = stored(df.sparkSession.createDataFrame(numbered, "column string, value string, number bigint"))
    first = numbered.groupBy("column").agg(F.min("number").alias("__first"))
    return stored(numbered.join(first, "column").select("column", "value", (F.col("number") - F.col("__first")).cast("int").alias("code")))


def _lookup(df: DataFrame, vocab: DataFrame, col: str, out_col: str, missing_code=-1) -> DataFrame:
    """Left join of one column to its vocabulary; unseen gets -1. No hint: the stored vocabulary's size decides."""
    v = (vocab.filter(F.col("column") == col)
              .select(F.col("value").alias("__v"), F.col("code").alias("__code")))
    j = df.join(v, nan_string(col) == F.col("__v"), "left")
    return j.withColumn(out_col, F.coalesce(F.col("__code"), F.lit(missing_code))).drop("__v", "__code")


def label_encode(df: DataFrame, vocab: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Categorical columns replaced by their train codes, unseen -1."""
    for c in columns:
        df = _lookup(df, vocab, c, c)
    return df


def encode_target(df: DataFrame, target_col: str = "income", out_col: str = "label"):
    """Sorted distinct target strings coded 0..k-1 (LabelEncoder).

    Returns the encoded frame and the ``(value, code)`` class table.
    """
    vocab = fit_vocabulary(df, [target_col])
    classes = vocab.select(F.col("value").alias(target_col), F.col("code").alias(out_col))
    encoded = _lookup(df, vocab, target_col, out_col)
    return encoded, classes


def one_hot_long(df: DataFrame, vocab: DataFrame, cat_cols: Sequence[str], n_numeric: int,
                 id_col: str = "row_id") -> DataFrame:
    """E3 in relational form: one row ``(row_id, feature_index, feature)`` per
    active dummy. Dummies follow the numeric columns, per column in order, per
    sorted train category; an unseen or missing value has no active dummy."""
    sizes = vocab.groupBy("column").agg(F.count(F.lit(1)).alias("k"))
    order = F.create_map(*[x for i, c in enumerate(cat_cols) for x in (F.lit(c), F.lit(i))])
    w = Window.orderBy("__ord").rowsBetween(Window.unboundedPreceding, -1)
    # one row per categorical column: bounded by the schema width
    offsets = (sizes.withColumn("__ord", order[F.col("column")])
                    .withColumn("offset", F.lit(n_numeric) + F.coalesce(F.sum("k").over(w), F.lit(0)))
                    .select("column", "offset"))
    v = (vocab.join(F.broadcast(offsets), "column")
              .select("column", "value", (F.col("offset") + F.col("code")).alias("feature_index"),
                                 F.concat(F.col("column"), F.lit("_"), F.col("value")).alias("feature")))
    long = df.select(id_col, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                                                 for c in cat_cols])).alias("kv")).select(id_col, "kv.*")
    return long.join(v, ["column", "value"], "inner").select(id_col, "feature_index", "feature")


def fit_standard_scaler(df: DataFrame, columns: Sequence[str]) -> dict:
    """A9 fit: population mean and sd per column in one aggregate; sd 0 -> 1.

    Not ``pyspark.ml.feature.StandardScaler``: that uses the sample sd.
    """
    if not columns:
        return {}
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}__m"), F.stddev_pop(x).alias(f"{c}__s")]
    row = df.agg(*aggs).first()
    out = {}
    for c in columns:
        m, s = row[f"{c}__m"], row[f"{c}__s"]
        out[c] = (m if m is not None else 0.0, s if s not in (None, 0.0) else 1.0)
    return out


def apply_standard_scaler(df: DataFrame, stats: dict, suffix: str = "") -> DataFrame:
    """A9 transform ``(x - mean) / sd`` with fitted literals (one projection)."""
    return df.withColumns({f"{c}{suffix}": (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
                           for c, (m, s) in stats.items()})


def standard_scale(df: DataFrame, columns: Sequence[str], fit_filter=None, suffix: str = "") -> DataFrame:
    """Fit on ``df.filter(fit_filter)`` (e.g. the train split), apply to all."""
    src = df.filter(fit_filter) if fit_filter is not None else df
    return apply_standard_scaler(df, fit_standard_scaler(src, columns), suffix)


def feature_pipeline(num_cols: Sequence[str], cat_cols: Sequence[str]) -> Pipeline:
    """Vector features for the models (B4 keeps both in the same row).

    ``features_tree``: numeric columns then ordinal codes (unseen -1 handled by
    ``tree_codes``). ``features_linear``: numeric then one-hot dummies;
    ``StringIndexer(keep)`` puts unseen and missing in the extra last index
    and ``OneHotEncoder(dropLast=True)`` drops exactly that slot, so they are
    all-zero rows as in the reference. Both fitted on train only.
    """
    idx = [f"{c}__idx" for c in cat_cols]
    oh = [f"{c}__oh" for c in cat_cols]
    stages = []
    if cat_cols:
        stages.append(StringIndexer(inputCols=list(cat_cols), outputCols=idx,
                                    stringOrderType="alphabetAsc", handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=idx, outputCols=oh, dropLast=True, handleInvalid="error"))
    return Pipeline(stages=stages)


def tree_codes(model: PipelineModel, df: DataFrame, cat_cols: Sequence[str]) -> DataFrame:
    """Ordinal codes for trees: indexer's extra slot (unseen/missing) -> -1."""
    if not cat_cols:
        return df
    indexer = model.stages[0]
    sizes = {c: len(l) for c, l in zip(cat_cols, indexer.labelsArray)}
    return df.withColumns({f"{c}__code": F.when(F.col(f"{c}__idx") >= sizes[c], F.lit(-1.0))
                           .otherwise(F.col(f"{c}__idx")) for c in cat_cols})


def assemble(df: DataFrame, cols: Sequence[str], out_col: str) -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out_col, handleInvalid="keep").transform(df)
