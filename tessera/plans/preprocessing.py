"""The reference's preprocessing run as one lazily planned job.

Order kept from the reference: target encoded first, imputation on all rows,
optional type narrowing, optional density-outlier filter, optional cluster feature, custom features,
split, then encoders fitted on the train split only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import nan_string, numeric_columns, string_columns
from ..functions.features import MARRIED_VALUES, add_custom_features
from ..operators.clean import apply_imputer, fill_values, reduce_mem_usage, replace_sentinel
from ..operators.ordinal import split_assign
from ..session import stored


@dataclass
class PrepConfig:
    target_col: str = "income"
    id_col: str = "row_id"
    seed: int = 42
    married_values: tuple = MARRIED_VALUES
    narrow: bool = False
    outliers: bool = False
    outlier_eps: float = 2.5
    outlier_min_samples: int = 3
    clusters: bool = False
    n_clusters: int = 5
    exact_split: bool = False
    materialize: bool = True
    drop: tuple = ("fnlwgt", "native_country")


def clean_and_engineer(df: DataFrame, cfg: PrepConfig) -> DataFrame:
    """Encode target, impute, (narrow types), (outliers), (clusters), custom features, split.

    With ``materialize`` the input is written once as Parquet to the shared
    folder: the fits below (target classes, fill values, later encoders) each
    read the columns they need, instead of re-running the joins that built it; it also bounds
    recomputation after a lost executor.
    """
    if cfg.materialize:
        df = stored(df)
    df = fit_and_encode(df, cfg)
    if cfg.narrow:
        df, _ = reduce_mem_usage(df, (cfg.id_col,))
    if cfg.outliers:
        from ..operators.outliers import dbscan_filter
        df = dbscan_filter(df, numeric_columns(df, (cfg.id_col,)), cfg.outlier_eps,
                           cfg.outlier_min_samples, id_col=cfg.id_col)
        if cfg.materialize:
            df = stored(df)  # the cluster fits and what reads the result don't filter again
    if cfg.clusters:
        from ..operators.cluster import add_clustering_features
        df = add_clustering_features(df, cfg.n_clusters, id_col=cfg.id_col, seed=cfg.seed)
    df = add_custom_features(df, cfg.married_values, cfg.drop)
    if cfg.exact_split:
        from ..operators.ordinal import split_exact
        return split_exact(df, cfg.id_col, cfg.seed)
    return split_assign(df, cfg.id_col, cfg.seed)


MAX_CLASSES = 10_000


def fit_and_encode(df: DataFrame, cfg: PrepConfig) -> DataFrame:
    """E1 + F1 + A1 + A2: the sorted target classes (from the raw target, as
    the reference encodes it before cleaning) and the median/mode fill values.
    The label is then a literal map lookup and the fills are literals: no join.

    Classes come from a distributed distinct; the target is a class label, and
    its number of values is checked before they reach the driver.
    """
    t = cfg.target_col
    cats = string_columns(df, (cfg.id_col, t))
    nums = numeric_columns(df, (cfg.id_col, t))
    found = df.select(nan_string(t).alias("c")).distinct().limit(MAX_CLASSES + 1).collect()
    if len(found) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} target classes")
    classes = sorted(r["c"] for r in found)
    codes = F.create_map(*[x for i, v in enumerate(classes) for x in (F.lit(v), F.lit(i))])
    fills = fill_values(replace_sentinel(df, columns=cats), nums, cats)
    return apply_imputer(df.withColumn("label", codes[nan_string(t)].cast("int")).drop(t), fills)


def feature_columns(df: DataFrame, cfg: PrepConfig) -> tuple[list[str], list[str]]:
    skip = (cfg.id_col, "label", "split", "fold", "is_val")
    return numeric_columns(df, skip), string_columns(df, skip)


def flagship(df: DataFrame, cfg: PrepConfig | None = None) -> DataFrame:
    """Positive rate and mean signed-log net capital by work type and split."""
    from ..functions.expressions import rnd
    cfg = cfg or PrepConfig()
    p = clean_and_engineer(df, cfg)
    return (p.groupBy("work_type", "split")
             .agg(F.count(F.lit(1)).alias("n_rows"),
                  rnd(F.avg("label"), 6).alias("positive_rate"),
                  rnd(F.avg("net_capital_log"), 4).alias("mean_net_capital_log")))
