"""Model families (M1-M8) as ``pyspark.ml`` estimators, and the booster presets.

Builders return an unfitted estimator reading ``features_tree`` or
``features_linear`` (B4: both vectors live in the same row) and writing
per-model output columns so several fitted models can be chained on one
DataFrame without name clashes.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark import SparkContext
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassificationModel, GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import Booster, fit_many

TREE_FEATURES = "features_tree"
LINEAR_FEATURES = "features_linear"
SEED = 42
MAX_DEPTH = 30  # Spark's limit; stands in for "unlimited"

# Fixed values that must equal the reference's: the tuning grids.
PARAM_GRIDS = {
    "logistic_regression": {"penalty": ["l2"], "C": [0.1, 1.0, 10.0], "solver": ["lbfgs"], "max_iter": [1000]},
    "decision_tree": {"max_depth": [None, 5, 10, 20], "min_samples_leaf": [1, 2, 4],
                      "criterion": ["gini", "entropy"]},
    "random_forest": {"n_estimators": [100, 200], "max_depth": [10, 15, 20], "min_samples_leaf": [5, 10],
                      "max_features": ["sqrt"], "bootstrap": [True]},
    "adaboost": {"n_estimators": [50, 100, 200], "learning_rate": [0.01, 0.1, 1.0]},
    "gradient_boosting": {"n_estimators": [100, 200, 300], "learning_rate": [0.01, 0.05, 0.1],
                          "max_depth": [3, 5, 8], "subsample": [0.8, 1.0], "min_samples_split": [2, 5, 10]},
    "xgboost": {"n_estimators": [100, 300, 500], "learning_rate": [0.01, 0.05, 0.1, 0.2],
                "max_depth": [3, 6, 9], "subsample": [0.7, 0.8, 1.0], "colsample_bytree": [0.7, 0.8, 1.0]},
    "lightgbm": {"n_estimators": [100, 300, 500], "learning_rate": [0.01, 0.05, 0.1],
                 "num_leaves": [31, 63, 127], "feature_fraction": [0.7, 0.8, 0.9]},
    "catboost": {"iterations": [100, 300, 500], "learning_rate": [0.01, 0.05, 0.1],
                 "depth": [4, 6, 8, 10], "l2_leaf_reg": [1, 3, 5, 7]},
}

# The reference's default parameters per family.
DEFAULT_PARAMS = {
    "logistic_regression": {"max_iter": 1000, "C": 1.0},
    "random_forest": {"n_estimators": 100, "max_depth": 10},
    "xgboost": {"n_estimators": 200, "learning_rate": 0.05, "max_depth": 6},
    "lightgbm": {"n_estimators": 200, "learning_rate": 0.05},
    "catboost": {"iterations": 200, "learning_rate": 0.05, "depth": 6},
}

# Relative loss change at which L-BFGS stops: tight enough that the coefficients are the optimum's.
LBFGS_TOL = 1e-8

TREE_KEYS = ("decision_tree", "random_forest", "adaboost", "gradient_boosting", "xgboost", "lightgbm",
             "catboost")
LINEAR_KEYS = ("logistic_regression",)
BOOSTER_KEYS = ("gradient_boosting", "xgboost", "lightgbm", "catboost")


def features_for(key: str) -> str:
    """Tree families read label codes, the linear family the one-hot vector."""
    return LINEAR_FEATURES if key in LINEAR_KEYS else TREE_FEATURES


def _out(est, name: str):
    cols = {"predictionCol": f"pred_{name}"}
    if est.hasParam("probabilityCol"):
        cols["probabilityCol"] = f"prob_{name}"
    if est.hasParam("rawPredictionCol"):
        cols["rawPredictionCol"] = f"raw_{name}"
    for k, v in cols.items():
        est.set(est.getParam(k), v)
    return est


# Tree induction settings: more nodes split per pass over the data (fewer
# passes for deep trees), node ids cached with periodic checkpoints.
TREE_TUNING = dict(maxBins=32, maxMemoryInMB=1024, cacheNodeIds=True, checkpointInterval=10)
BOOST_TUNING = dict(maxBins=32, maxMemoryInMB=1024)


def _depth(v):
    """None stands for "unlimited" and gives Spark's deepest tree; a deeper explicit value is an error."""
    if v is not None and int(v) > MAX_DEPTH:
        raise ValueError(f"max_depth {v}: Spark's trees end at {MAX_DEPTH}")
    return MAX_DEPTH if v is None else int(v)


def _leaf(v):
    return max(1, int(v))


def build_logistic_regression(task="classification", n_rows: int | None = None, name="logistic_regression",
                              **p):
    """M1: L2 logistic regression. The reference's ``C`` (sum of losses + ||w||^2 /
    2C) is Spark's ``regParam = 1 / (C n)`` (mean loss + regParam ||w||^2 / 2);
    features are already scaled, so ``standardization=False``."""
    if task != "classification":
        raise ValueError("logistic_regression is a classifier")
    C = float(p.get("C", 1.0))
    reg = 1.0 / (C * n_rows) if n_rows else 1.0 / C
    est = LogisticRegression(featuresCol=LINEAR_FEATURES, labelCol="label", maxIter=int(p.get("max_iter", 1000)),
                             regParam=reg, elasticNetParam=0.0, standardization=False, family="binomial",
                             tol=float(p.get("tol", LBFGS_TOL)))
    return _out(est, name)


def build_decision_tree(task="classification", name="decision_tree", **p):
    """M2."""
    kw = dict(featuresCol=TREE_FEATURES, labelCol="label", maxDepth=_depth(p.get("max_depth")),
              minInstancesPerNode=_leaf(p.get("min_samples_leaf", 1)), seed=SEED, **TREE_TUNING)
    if task == "classification":
        return _out(DecisionTreeClassifier(impurity=p.get("criterion", "gini"), **kw), name)
    return _out(DecisionTreeRegressor(**kw), name)


def build_random_forest(task="classification", name="random_forest", **p):
    """M3: bootstrap forest, sqrt features per split."""
    kw = dict(featuresCol=TREE_FEATURES, labelCol="label", numTrees=int(p.get("n_estimators", 100)),
              maxDepth=_depth(p.get("max_depth")), minInstancesPerNode=_leaf(p.get("min_samples_leaf", 1)),
              featureSubsetStrategy=str(p.get("max_features", "sqrt")), bootstrap=bool(p.get("bootstrap", True)),
              seed=SEED, **TREE_TUNING)
    if task == "classification":
        return _out(RandomForestClassifier(**kw), name)
    return _out(RandomForestRegressor(**kw), name)


def build_adaboost(task="classification", name="adaboost", **p):
    """M4: boosted stumps (classification) or depth-3 trees (regression)."""
    from .adaboost import AdaBoost
    return AdaBoost(task=task, n_estimators=int(p.get("n_estimators", 50)),
                    learning_rate=float(p.get("learning_rate", 1.0)), featuresCol=TREE_FEATURES, name=name)


def _gbt(task, name, iters, rate, depth, subsample=1.0, min_leaf=1):
    kw = dict(featuresCol=TREE_FEATURES, labelCol="label", maxIter=int(iters), stepSize=float(rate),
              maxDepth=_depth(depth), subsamplingRate=float(subsample), minInstancesPerNode=_leaf(min_leaf),
              seed=SEED, **BOOST_TUNING)
    est = GBTClassifier(**kw) if task == "classification" else GBTRegressor(**kw)
    return _out(est, name)


def build_gradient_boosting(task="classification", name="gradient_boosting", **p):
    """M5. ``min_samples_split`` has no Spark twin: ceil(v / 2) rows per leaf."""
    return _gbt(task, name, p.get("n_estimators", 100), p.get("learning_rate", 0.1), p.get("max_depth", 3),
                p.get("subsample", 1.0), math.ceil(p.get("min_samples_split", 2) / 2))


#: The presets that grow by histograms (``boosting``), each with its own growth and parameters.
PRESET_KEYS = ("xgboost", "lightgbm", "catboost")


def booster(key: str, params: dict, fold: int | None = None, patience: int | None = None) -> Booster:
    """M6: a preset's parameters; what is not given has the default of the library it stands for."""
    p = params
    if key == "xgboost":
        return Booster(int(p.get("n_estimators", 100)), float(p.get("learning_rate", 0.3)), "depth", depth=int(p.get("max_depth", 6)), l2=1.0, least_hessian=1.0,
                       rows=float(p.get("subsample", 1.0)), columns=float(p.get("colsample_bytree", 1.0)), patience=patience, fold=fold, seed=SEED)
    if key == "lightgbm":
        return Booster(int(p.get("n_estimators", 100)), float(p.get("learning_rate", 0.1)), "leaf", leaves=int(p.get("num_leaves", 31)), least_rows=20,
                       columns=float(p.get("feature_fraction", 1.0)), patience=patience, fold=fold, seed=SEED)
    return Booster(int(p.get("iterations", 100)), float(p.get("learning_rate", 0.03)), "symmetric", depth=int(p.get("depth", 6)), l2=float(p.get("l2_leaf_reg", 3.0)),
                   least_hessian=0.0, least_rows=0, patience=patience, fold=fold, seed=SEED)


class HistogramBooster:
    """An estimator of one preset."""

    def __init__(self, key: str, task: str, name: str, params: dict):
        self.key, self.task, self.name, self.params = key, task, name, params

    def fit(self, df: DataFrame):
        return fit_many(df, [booster(self.key, self.params)], self.task, TREE_FEATURES, name=self.name)[0]


def _preset(key: str) -> Callable:
    def make(task="classification", name=key, **p):
        return HistogramBooster(key, task, name, p)
    make.__doc__ = f"M6 preset {key}."
    return make


BUILDERS: dict[str, Callable] = {
    "logistic_regression": build_logistic_regression,
    "decision_tree": build_decision_tree,
    "random_forest": build_random_forest,
    "adaboost": build_adaboost,
    "gradient_boosting": build_gradient_boosting,
    **{key: _preset(key) for key in PRESET_KEYS},
}


def build(key: str, task: str = "classification", n_rows: int | None = None, name: str | None = None,
          **params):
    name = name or key
    if key == "logistic_regression":
        return build_logistic_regression(task, n_rows=n_rows, name=name, **params)
    return BUILDERS[key](task, name=name, **params)


# The families whose training stops early, and after how many rounds without gain.
PATIENCE_KEYS = ("lightgbm", "catboost")
PATIENCE = 50


def rounds_to_keep(losses, patience: int = PATIENCE) -> int:
    """Rounds up to the best one seen before ``patience`` rounds passed without a smaller loss."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def first_rounds(model, n: int):
    """The boosted model of the first ``n`` trees: what training would have held after ``n`` rounds."""
    java, gateway = model._java_obj, SparkContext._active_spark_context._gateway
    ml = gateway.jvm.org.apache.spark.ml
    trees, weights = gateway.new_array(ml.regression.DecisionTreeRegressionModel, n), gateway.new_array(gateway.jvm.double, n)
    for i, (tree, weight) in enumerate(zip(java.trees(), model.treeWeights[:n])):
        trees[i], weights[i] = tree, float(weight)
    if isinstance(model, GBTClassificationModel):
        cut = ml.classification.GBTClassificationModel(java.uid(), trees, weights, java.numFeatures(), java.numClasses())
    else:
        cut = ml.regression.GBTRegressionModel(java.uid(), trees, weights, java.numFeatures())
    return type(model)(java.copyValues(cut, ml.param.ParamMap.empty()))


def fit_booster(key: str, params: dict, train: DataFrame, val: DataFrame | None, task: str = "classification", name: str | None = None):
    """M7: all rounds asked for; the families in ``PATIENCE_KEYS`` end their training when patience on the
    validation loss is out, and keep the rounds up to the best."""
    if key in PRESET_KEYS:
        judged = val if key in PATIENCE_KEYS and val is not None and val.head(1) else None
        return fit_many(train, [booster(key, params, patience=PATIENCE if judged is not None else None)], task, TREE_FEATURES, val=judged, name=name or key)[0]
    model = build(key, task, name=name or key, **params).fit(train)
    if key not in PATIENCE_KEYS or val is None or not val.head(1):
        return model
    losses = list(model.evaluateEachIteration(val) if task == "classification" else model.evaluateEachIteration(val, "squared"))
    return first_rounds(model, rounds_to_keep(losses))


def score(model, df: DataFrame, name: str, task: str = "classification") -> DataFrame:
    """M8: prediction plus positive-class probability (or margin) as ``score``."""
    out = model.transform(df)
    pred = F.col(f"pred_{name}").cast("int" if task == "classification" else "double")
    if task != "classification":
        return out.withColumns({"prediction": pred, "score": F.lit(None).cast("double")})
    if f"prob_{name}" in out.columns:
        s = vector_to_array(f"prob_{name}")[1]
    elif f"raw_{name}" in out.columns:
        s = vector_to_array(f"raw_{name}")[1]
    else:
        s = F.lit(None).cast("double")
    return out.withColumns({"prediction": pred, "score": s})
