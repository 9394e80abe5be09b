"""Persistence (S2-S4): prepared bundles as partitioned Parquet, fitted
models through ML persistence, and a load-or-compute cache keyed by config.
"""

from __future__ import annotations

import hashlib
import json
import os

from pyspark.sql import DataFrame, SparkSession


def config_key(config: dict, input_path: str) -> str:
    """S3: cache key from the config and the input path (invalidates on change)."""
    blob = json.dumps({"config": config, "input": input_path}, sort_keys=True, default=str)
    return hashlib.sha256(blob.encode()).hexdigest()[:16]


def save_bundle(df: DataFrame, path: str, meta: dict | None = None) -> str:
    """One dataset partitioned by ``split`` (train/val/test prune on read),
    plus a small JSON sidecar (class list, feature names)."""
    df.write.mode("overwrite").partitionBy("split").parquet(f"{path}/rows")
    spark = df.sparkSession
    spark.createDataFrame([(json.dumps(meta or {}, default=str),)], "meta string") \
         .coalesce(1).write.mode("overwrite").json(f"{path}/meta")
    spark.createDataFrame([("ok",)], "status string").coalesce(1).write.mode("overwrite").json(f"{path}/_done")
    return path


def bundle_complete(spark: SparkSession, path: str) -> bool:
    try:
        return spark.read.json(f"{path}/_done").count() == 1
    except Exception:
        return False


def load_bundle(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    rows = spark.read.parquet(f"{path}/rows")
    meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
    return rows, meta


def load_or_compute(spark: SparkSession, root: str, config: dict, input_path: str, compute) -> tuple[DataFrame, dict]:
    """S3: reuse a complete bundle for the same (config, input), else build
    and save it. ``compute()`` returns ``(df, meta)``."""
    path = os.path.join(root, config_key(config, input_path))
    if bundle_complete(spark, path):
        return load_bundle(spark, path)
    df, meta = compute()
    save_bundle(df, path, meta)
    return load_bundle(spark, path)


def save_model(model, path: str) -> str:
    """Persist a fitted model (overwrite).

    ``pyspark.ml`` models use ML persistence. AdaBoost is its node tables and
    weights as one JSON document; blending/stacking models are a folder with
    each base model, the meta model and a manifest.
    """
    from ..operators.adaboost import AdaBoostModel
    from ..operators.boosting import BoostedTrees
    from ..operators.ensemble import BlendingModel
    spark = SparkSession.getActiveSession()
    if isinstance(model, AdaBoostModel):
        doc = {"kind": "adaboost", "trees": model.trees, "alphas": model.alphas, "task": model.task, "n_classes": model.n_classes,
               "featuresCol": model.featuresCol, "name": model.name,
               "importances": [list(map(float, i)) for i in model.importances]}
        spark.createDataFrame([(json.dumps(doc),)], "doc string").coalesce(1).write.mode("overwrite").text(path)
        return path
    if isinstance(model, BoostedTrees):
        doc = {"kind": "boosted", "tables": model.tables, "base": model.base, "task": model.task, "featuresCol": model.featuresCol, "name": model.name,
               "n_features": model.n_features, "trained": model.trained_rounds}
        spark.createDataFrame([(json.dumps(doc),)], "doc string").coalesce(1).write.mode("overwrite").text(path)
        return path
    if isinstance(model, BlendingModel):
        names = list(model.bases)
        for n in names:
            save_model(model.bases[n], f"{path}/base_{n}")
        model.meta.model.write().overwrite().save(f"{path}/meta")
        doc = {"kind": "ensemble", "name": model.name, "bases": names, "meta_cols": model.meta.cols,
               "base_kinds": {n: _kind(model.bases[n]) for n in names}}
        spark.createDataFrame([(json.dumps(doc),)], "doc string").coalesce(1).write.mode("overwrite").text(
            f"{path}/manifest")
        return path
    model.write().overwrite().save(path)
    return path


def _kind(model) -> str:
    from ..operators.adaboost import AdaBoostModel
    from ..operators.boosting import BoostedTrees
    if isinstance(model, AdaBoostModel):
        return "adaboost"
    if isinstance(model, BoostedTrees):
        return "boosted"
    return f"{type(model).__module__}.{type(model).__name__}"


def load_model(path: str, kind: str | None = None):
    """S4 round trip of ``save_model``."""
    import importlib
    from ..operators.adaboost import AdaBoostModel
    from ..operators.ensemble import BlendingModel, _MetaModel
    from pyspark.ml.classification import LogisticRegressionModel
    spark = SparkSession.getActiveSession()
    if kind is None:
        try:
            doc = json.loads(spark.read.text(f"{path}/manifest").first()[0])
            kind = "ensemble"
        except Exception:
            kind = "ml"
            try:
                doc = json.loads(spark.read.text(path).first()[0])
                kind = doc.get("kind", "ml")
            except Exception:
                pass
    if kind == "adaboost":
        doc = json.loads(spark.read.text(path).first()[0])
        trees = [[tuple(n) for n in t] for t in doc["trees"]]
        return AdaBoostModel(trees, doc["alphas"], doc["task"], doc["featuresCol"], doc["name"], doc["importances"], doc.get("n_classes", 2))
    if kind == "boosted":
        from ..operators.boosting import BoostedTrees
        doc = json.loads(spark.read.text(path).first()[0])
        return BoostedTrees([[tuple(n) for n in t] for t in doc["tables"]], doc["base"], doc["task"], doc["featuresCol"], doc["name"], doc["n_features"], doc["trained"])
    if kind == "ensemble":
        doc = json.loads(spark.read.text(f"{path}/manifest").first()[0])
        bases = {n: load_model(f"{path}/base_{n}", doc["base_kinds"][n] if doc["base_kinds"][n] in ("adaboost", "boosted") else None)
                 for n in doc["bases"]}
        meta = _MetaModel(LogisticRegressionModel.load(f"{path}/meta"), doc["meta_cols"])
        return BlendingModel(bases, meta, doc["name"])
    from pyspark.ml.util import DefaultParamsReader
    meta = DefaultParamsReader.loadMetadata(path, spark.sparkContext)
    module, cls = meta["class"].rsplit(".", 1)
    py_module = module.replace("org.apache.spark.ml", "pyspark.ml")
    return getattr(importlib.import_module(py_module), cls).load(path)
