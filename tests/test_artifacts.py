"""Bundles, cache, model persistence round trips."""

import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators.adaboost import AdaBoost
from tessera.plans import experiment as XP
from tessera.plans.queries import WIDE_CFG, prepared
from tessera.sources import artifacts as A


def _same_scores(a, b, name):
    x = XP.predictions(a, b[0], name).select("row_id", F.col("score").alias("s1"), F.col("prediction").alias("p1"))
    y = XP.predictions(b[1], b[0], name).select("row_id", F.col("score").alias("s2"), F.col("prediction").alias("p2"))
    j = x.join(y, "row_id")
    return j.filter((F.col("p1") != F.col("p2")) | (F.abs(F.col("s1") - F.col("s2")) > 1e-12)).count() == 0


def test_bundle_and_cache(spark):
    root = tempfile.mkdtemp(prefix="tessera-art-", dir="/tmp")
    calls = []

    def compute():
        calls.append(1)
        return prepared(spark, SF_SMALL), {"classes": ["<=50K", ">50K"]}

    df1, meta1 = A.load_or_compute(spark, root, {"seed": 42}, SF_SMALL, compute)
    df2, meta2 = A.load_or_compute(spark, root, {"seed": 42}, SF_SMALL, compute)
    assert len(calls) == 1 and meta1 == meta2
    assert df1.count() == df2.count() == prepared(spark, SF_SMALL).count()
    assert df2.filter("split = 'val'").count() > 0          # partition column survives
    A.load_or_compute(spark, root, {"seed": 7}, SF_SMALL, compute)
    assert len(calls) == 2                                   # new config -> rebuilt


def test_model_round_trips(spark):
    from tessera.operators.ensemble import Blending
    fs = XP.build_feature_set(prepared(spark, SF_SMALL), WIDE_CFG)
    val = fs.df.filter("split = 'val'")
    root = tempfile.mkdtemp(prefix="tessera-models-", dir="/tmp")
    rf = XP.train_model("random_forest", {"n_estimators": 5, "max_depth": 4}, fs)
    assert _same_scores(rf, (val, A.load_model(A.save_model(rf, f"{root}/rf"))), "random_forest")
    ada = AdaBoost(n_estimators=3).fit(fs.df.filter("split = 'train'"))
    assert _same_scores(ada, (val, A.load_model(A.save_model(ada, f"{root}/ada"))), "adaboost")
    bases = {"logistic_regression": XP.train_model("logistic_regression", {"C": 1.0}, fs),
             "decision_tree": XP.train_model("decision_tree", {"max_depth": 3}, fs)}
    bl = Blending(bases).fit(val)
    test = fs.df.filter("split = 'test'")
    assert _same_scores(bl, (test, A.load_model(A.save_model(bl, f"{root}/blend"))), "blending_ensemble")
