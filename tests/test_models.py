"""Property tests for solver-dependent operators (P in SURVEY §2)."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators import cluster as K
from tessera.operators import explain as X
from tessera.operators.adaboost import AdaBoost
from tessera.operators.outliers import dbscan_flags
from tessera.operators.tuning import grid_size, random_search, sample_candidates
from tessera.plans import experiment as XP
from tessera.plans.queries import WIDE_CFG, prepared
from tessera.sources.fixtures import customer_wide


@pytest.fixture(scope="module")
def fs(spark):
    return XP.build_feature_set(prepared(spark, SF_SMALL), WIDE_CFG)


def test_feature_set_shapes(fs):
    r = fs.df.first()
    assert r.features_tree.size == len(fs.tree_names)
    assert r.features_linear.size == len(fs.linear_names)
    assert fs.df.select("split").distinct().count() == 3


def test_candidate_sampling():
    grid = {"a": [1, 2, 3], "b": [1, 2, 3, 4]}
    c = sample_candidates(grid, 10, 42)
    assert len(c) == 10 and len({tuple(sorted(x.items())) for x in c}) == 10
    assert sample_candidates(grid, 10, 42) == c
    assert len(sample_candidates({"C": [0.1, 1.0, 10.0]}, 10)) == 3 and grid_size(grid) == 12


def test_random_search_best_is_argmax(fs):
    s = random_search("decision_tree", fs.df.filter(F.col("split") == "train"),
                      {"max_depth": [2, 4], "min_samples_leaf": [1], "criterion": ["gini"]}, n_iter=10, k=3)
    rows = s.summary.collect()
    assert len(rows) == 2
    best = max(rows, key=lambda r: (r.f1, -r.candidate))
    assert s.best_params == s.candidates[best.candidate]
    assert s.results.count() == 2 * 3
    # metrics can be re-derived from the stored predictions: each train row once per candidate
    assert s.predictions.groupBy("candidate").count().select("count").distinct().count() == 1


def test_adaboost_rounds_and_probabilities(fs):
    tr = fs.df.filter(F.col("split") == "train")
    m = AdaBoost(n_estimators=5).fit(tr)
    assert 1 <= len(m.alphas) <= 5 and all(a > 0 for a in m.alphas)   # error < 1/2 each round
    p = m.transform(fs.df.filter(F.col("split") == "val")).select(vector_to_array("prob_adaboost").alias("p"))
    for r in p.limit(20).collect():
        assert abs(sum(r.p) - 1) < 1e-9 and 0 <= r.p[1] <= 1


def test_attribution_sums_to_model_output(fs):
    m = XP.train_model("random_forest", {"n_estimators": 10, "max_depth": 5}, fs)
    val = fs.df.filter(F.col("split") == "val")
    rc = X.row_contributions(val, m, fs.tree_names)
    p = m.transform(val).select("row_id", vector_to_array("prob_random_forest")[1].alias("p1"))
    j = rc.join(p, "row_id").select(
        (F.col("base") + F.aggregate("contributions", F.lit(0.0), lambda a, b: a + b) - F.col("p1")).alias("d"))
    assert j.agg(F.max(F.abs("d"))).first()[0] < 1e-9
    top = X.attribution(val, m, fs.tree_names).collect()
    assert len(top) == len(fs.tree_names) and top[0].mean_abs >= top[-1].mean_abs


def test_importance_sorted_and_normalised(spark, fs):
    m = XP.train_model("random_forest", {"n_estimators": 10, "max_depth": 5}, fs)
    imp = X.feature_importance(spark, m, fs.tree_names).collect()
    vals = [r.importance for r in imp]
    assert vals == sorted(vals, reverse=True) and abs(sum(vals) - 1) < 1e-9
    lr = XP.train_model("logistic_regression", {"C": 1.0}, fs)
    assert X.feature_importance(spark, lr, fs.linear_names).count() == len(fs.linear_names)


def test_stacking_and_blending_score_every_row(fs):
    from tessera.operators.ensemble import Blending, Stacking
    specs = {"logistic_regression": ("logistic_regression", {"C": 1.0}),
             "decision_tree": ("decision_tree", {"max_depth": 4})}
    st = Stacking(specs, n_splits=3).fit(fs.df.filter(F.col("split") == "train"))
    val = fs.df.filter(F.col("split") == "val")
    p = XP.predictions(st, val, "stacking_ensemble")
    assert p.count() == val.count() and p.filter("score < 0 OR score > 1").count() == 0
    bases = {n: XP.train_model(k, q, fs, name=n) for n, (k, q) in specs.items()}
    bl = Blending(bases).fit(val)
    assert XP.predictions(bl, fs.df.filter(F.col("split") == "test"), "blending_ensemble").count() > 0


def test_kmeans_best_of_not_worse_than_each_seed(spark, fs):
    from pyspark.ml.clustering import KMeans
    df = fs.df.select(F.col("features_linear").alias("v"))
    best = K.kmeans_best_of(df, "v", k=3, restarts=3, seed=7)
    for s in range(3):
        one = KMeans(k=3, seed=7 + s, featuresCol="v", maxIter=300).fit(df)
        assert best.summary.trainingCost <= one.summary.trainingCost + 1e-6


def test_pca_components_orthonormal(spark):
    df = spark.createDataFrame([(i, float(i % 7), float((i * 3) % 11), float(i % 5) * 2) for i in range(200)],
                               "row_id long, a double, b double, c double")
    out = K.pca_2d(df, ["a", "b", "c"])
    assert out.count() == 200
    m = np.array([[r.pc1, r.pc2] for r in out.collect()])
    assert abs(m[:, 0].mean()) < 1e-9 and m[:, 0].var() >= m[:, 1].var()
    assert abs(np.corrcoef(m[:, 0], m[:, 1])[0, 1]) < 1e-6


@pytest.mark.parametrize("eps,min_samples", [(0.3, 3), (0.75, 3), (2.5, 5)])
def test_dbscan_equals_brute_force(spark, eps, min_samples):
    cw = customer_wide(spark, SF_SMALL)
    cols = ["acctbal", "n_orders", "spend", "max_order"]
    pdf = cw.toPandas().sort_values("row_id")
    x = pdf[cols].to_numpy(dtype=float)
    sd = x.std(0)
    sd[sd == 0] = 1.0
    z = (x - x.mean(0)) / sd
    d2 = ((z[:, None, :] - z[None, :, :]) ** 2).sum(-1)
    nb = d2 <= eps * eps
    core = nb.sum(1) >= min_samples
    noise = ~core & ~(nb & core[None, :]).any(1)
    got = dbscan_flags(cw, cols, eps, min_samples).toPandas().sort_values("row_id")
    assert (got["is_core"].to_numpy() == core).all()
    assert (got["is_noise"].to_numpy() == noise).all()


def test_adaboost_rounds_read_persisted_weights(fs, monkeypatch):
    """A fit scans its rows several times: none may repeat the weights of the rounds before."""
    from tessera.operators import adaboost as A
    tr, seen = fs.df.filter(F.col("split") == "train"), []

    class Watched(A.DecisionTreeClassifier):
        def fit(self, data):
            plan = data._jdf.queryExecution().executedPlan().toString()
            seen.append(("InMemoryTableScan" in plan or "InMemoryRelation" in plan, data.schema["y"].metadata))
            return super().fit(data)
    monkeypatch.setattr(A, "DecisionTreeClassifier", Watched)
    longer = AdaBoost(n_estimators=12).fit(tr)
    assert len(seen) == 12 and all(cached and meta["ml_attr"]["num_vals"] == 2 for cached, meta in seen)
    shorter = AdaBoost(n_estimators=4).fit(tr)
    cut = longer.first(4)
    assert cut.trees == shorter.trees and cut.alphas == shorter.alphas


def test_adaboost_search_fits_each_chain_once(fs, monkeypatch):
    from tessera.operators import adaboost as A
    from tessera.operators.tuning import random_search
    tr, fitted, fit = fs.df.filter(F.col("split") == "train"), [], A.AdaBoost.fit
    monkeypatch.setattr(A.AdaBoost, "fit", lambda self, df: fitted.append(self.n) or fit(self, df))
    s = random_search("adaboost", tr, grid={"n_estimators": [2, 4], "learning_rate": [0.1, 1.0]}, n_iter=4, k=2, refit=False)
    assert fitted == [4] * 4
    assert s.results.count() == 8 and s.predictions.count() == 4 * tr.count()


def test_adaboost_multiclass(spark):
    rows = [(i, float(i % 3), [float(i % 3) + (i % 5) * 0.1, float(i % 7)]) for i in range(300)]
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("label", T.DoubleType()),
                           T.StructField("features_tree", VectorUDT())])
    df = spark.createDataFrame([(r[0], r[1], Vectors.dense(r[2])) for r in rows], schema)
    m = AdaBoost(n_estimators=4).fit(df)
    assert len(m.alphas) >= 1 and all(a > 0 for a in m.alphas)


def test_kmeans_restarts_share_their_passes(spark):
    rows = [(i, [float(i % 40) * 5 + (i * 7 % 11) * 0.1, float(i * i % 23)]) for i in range(400)]
    df = spark.createDataFrame(rows, "row_id long, x array<double>").select("row_id", array_to_vector("x").alias("v")).repartition(3)
    passes = []
    whole = K._sums
    K._sums = lambda blocks, centers: passes.append(len(centers)) or whole(blocks, centers)
    try:
        best = K.kmeans_best_of(df, "v", k=4, restarts=6)
    finally:
        K._sums = whole
    assert passes[0] == 6 and passes == sorted(passes, reverse=True) and best.rounds <= len(passes)
    x = np.array([r[1] for r in rows])
    d2 = ((x[:, None] - best.centers) ** 2).sum(axis=2)
    assert abs(best.cost - d2.min(axis=1).sum()) < 1e-6 * best.cost
    near = df.select(vector_to_array("v").alias("x")).selectExpr("x[0] AS a", "x[1] AS b").select("a", "b", best.nearest(["a", "b"]).alias("c")).collect()
    assert all(r.c == int(((np.array([r.a, r.b]) - best.centers) ** 2).sum(axis=1).argmin()) for r in near)
    same = spark.createDataFrame([(1.0,)] * 5 + [(2.0,)], "a double").select(array_to_vector(F.array("a")).alias("v"))
    assert sorted(c[0] for c in K.kmeans_best_of(same, "v", k=4, restarts=2).clusterCenters()) == [1.0, 2.0]


def test_folds_of_the_stability_check_fit_together(fs, monkeypatch):
    """Fits that don't depend on each other are submitted together: each of two waits here for the other."""
    import threading

    from tessera.operators.models import build
    met = threading.Barrier(2)

    class Meets:
        def __init__(self, *a, **b):
            self.est = build(*a, **b)

        def fit(self, df):
            met.wait(30)
            return self.est.fit(df)

    want = {r.metric: tuple(r) for r in XP.cross_validation_stability("decision_tree", {"max_depth": 3}, fs, k=2, parallelism=1).collect()}
    monkeypatch.setattr(XP, "build", Meets)
    got = {r.metric: tuple(r) for r in XP.cross_validation_stability("decision_tree", {"max_depth": 3}, fs, k=2).collect()}
    assert got == want


def test_bases_of_the_blender_train_together(monkeypatch):
    import threading
    met = threading.Barrier(3)

    def train(key, params, fs, name=None):
        met.wait(30)
        return key, params, name

    monkeypatch.setattr(XP, "train_model", train)
    specs = {n: (f"key_{n}", {"p": n}) for n in "abc"}
    got = XP.train_models(specs, None)
    assert list(got.items()) == [(n, (f"key_{n}", {"p": n}, n)) for n in "abc"]


def test_stacking_boosts_beside_the_other_bases(fs, monkeypatch):
    """Boosters of all folds and the fits of the other bases wait here for each other; a booster ends with the rounds asked for."""
    import threading

    from tessera.operators import ensemble
    boosted, begun = threading.Event(), threading.Event()
    fit_many, build = ensemble.fit_many, ensemble.build

    def boosts(*a, **b):
        assert begun.wait(30)
        boosted.set()
        return fit_many(*a, **b)

    class Waits:
        def __init__(self, *a, **b):
            self.est = build(*a, **b)

        def fit(self, df):
            begun.set()
            assert boosted.wait(30)
            return self.est.fit(df)

    monkeypatch.setattr(ensemble, "fit_many", boosts)
    monkeypatch.setattr(ensemble, "build", Waits)
    specs = {"decision_tree": ("decision_tree", {"max_depth": 3}), "xgboost": ("xgboost", {"n_estimators": 3, "max_depth": 2})}
    st = ensemble.Stacking(specs, n_splits=2).fit(fs.df.filter(F.col("split") == "train"))
    assert list(st.bases) == list(specs) and st.bases["xgboost"].getNumTrees == 3
