"""Scoring a stream with a pipeline fitted in batch.

The reference has no stream source, window or state. What carries over is
that every fitted step after training is row-wise: sentinel replacement,
fill values, engineered features, vocabulary codes, scaling and the model
are projections (plus broadcast lookups of fitted state), so the same
functions apply unchanged to a ``readStream`` DataFrame. Nothing here keeps
state across micro-batches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import nan_string
from ..functions.features import add_custom_features
from ..operators.clean import apply_imputer, fit_imputer
from ..operators.encode import apply_standard_scaler, assemble, tree_codes
from ..plans.experiment import FeatureSet, build_feature_set
from ..plans.preprocessing import PrepConfig, clean_and_engineer


@dataclass
class FittedPreparation:
    cfg: PrepConfig
    classes: dict            # target value -> code
    fills: dict
    features: FeatureSet


def fit_preparation(batch: DataFrame, cfg: PrepConfig) -> FittedPreparation:
    """Fit every statistic on a batch table (the training data)."""
    # the class list is bounded by the number of classes
    values = sorted(r[0] for r in batch.select(nan_string(cfg.target_col)).distinct().collect())
    classes = {v: i for i, v in enumerate(values)}
    enc = batch.withColumn("label", F.create_map(*[x for k, v in classes.items() for x in (F.lit(k), F.lit(v))])
                           [nan_string(cfg.target_col)]).drop(cfg.target_col)
    fills = fit_imputer(enc, exclude=(cfg.id_col, "label"))
    prep = clean_and_engineer(batch, PrepConfig(**{**cfg.__dict__, "materialize": False}))
    return FittedPreparation(cfg, classes, fills, build_feature_set(prep, cfg))


def prepare_rows(df: DataFrame, fitted: FittedPreparation) -> DataFrame:
    """Row-wise application of the fitted preparation (stream or batch)."""
    cfg = fitted.cfg
    out = df
    if cfg.target_col in out.columns:
        out = out.withColumn("label", F.create_map(*[x for k, v in fitted.classes.items()
                                                     for x in (F.lit(k), F.lit(v))])[nan_string(cfg.target_col)])
        out = out.drop(cfg.target_col)
    out = apply_imputer(out, fitted.fills)
    out = add_custom_features(out, cfg.married_values, cfg.drop)
    fs = fitted.features
    cats = [c for c in fs.tree_names if c in out.columns and dict(out.dtypes)[c] == "string"]
    num = [c for c in fs.tree_names if c not in cats]
    x = tree_codes(fs.pipeline, fs.pipeline.transform(out), cats)
    x = assemble(x, [c if c in num else f"{c}__code" for c in fs.tree_names], "features_tree")
    x = apply_standard_scaler(x, fs.scaler, suffix="__z")
    return x


def score_stream(stream: DataFrame, fitted: FittedPreparation, model, name: str) -> DataFrame:
    """Predictions for a streaming (or batch) DataFrame of raw rows, with a
    model trained on ``features_tree``."""
    from ..operators.models import score
    x = prepare_rows(stream, fitted)
    out = score(model, x, name)
    keep = [c for c in (fitted.cfg.id_col, "label") if c in out.columns]
    return out.select(*keep, "prediction", "score")
