"""Histogram boosting against a plain NumPy version, growth policies, early stop, batched Newton fits."""
import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tessera.operators import boosting as B
from tessera.operators.ensemble import MetaLogistic, newton_fits
from tessera.operators.models import booster, fit_booster
from tessera.sources.artifacts import load_model, save_model


def table(spark, n=400, seed=1):
    some = np.random.default_rng(seed)
    x = np.round(some.normal(size=(n, 3)), 1)
    y = (x[:, 0] + 0.7 * x[:, 1] * (x[:, 2] > 0) + some.normal(scale=0.5, size=n) > 0).astype(int)
    df = spark.createDataFrame([(k, int(y[k]), k % 3, [float(v) for v in x[k]]) for k in range(n)], "row_id long, label int, fold int, x array<double>")
    return df.withColumn("features_tree", array_to_vector("x")).drop("x"), x, y


def plain(x, y, edges, b, own):
    """Margins of all rows after training on the rows ``own``, node by node."""
    bins = np.column_stack([np.searchsorted(e, x[:, k], "left") for k, e in enumerate(edges)])
    mean = y[own].mean()
    margin = np.full(len(y), np.log(mean / (1 - mean)))

    def search(rows, g, h):
        best = (1e-12, None, None)
        for f in range(x.shape[1]):
            for c in range(B.MAX_BINS):
                left = rows[bins[rows, f] <= c]
                right = rows[bins[rows, f] > c]
                if min(len(left), len(right)) < b.least_rows or min(h[left].sum(), h[right].sum()) < b.least_hessian:
                    continue
                gain = sum(s * g[r].sum() ** 2 / (h[r].sum() + b.l2) for s, r in ((1, left), (1, right), (-1, rows)))
                if gain > best[0] + 1e-9:
                    best = (gain, f, c)
        return best

    for _ in range(b.rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        leaves = [(own, np.arange(len(y)), 0)]
        if b.growth == "depth":
            for _ in range(b.depth):
                nxt = []
                for rows, every, depth in leaves:
                    _, f, c = search(rows, g, h)
                    sides = [(rows, every, depth)] if f is None else [(rows[bins[rows, f] <= c], every[bins[every, f] <= c], 0), (rows[bins[rows, f] > c], every[bins[every, f] > c], 0)]
                    nxt += sides
                leaves = nxt
        else:
            while len(leaves) < b.leaves:
                found = [search(rows, g, h) for rows, _, _ in leaves]
                k = max(range(len(leaves)), key=lambda i: found[i][0] if found[i][1] is not None else -1)
                if found[k][1] is None:
                    break
                (rows, every, _), (_, f, c) = leaves.pop(k), found[k]
                leaves += [(rows[bins[rows, f] <= c], every[bins[every, f] <= c], 0), (rows[bins[rows, f] > c], every[bins[every, f] > c], 0)]
        for rows, every, _ in leaves:
            margin[every] += b.rate * -g[rows].sum() / (h[rows].sum() + b.l2)
    return margin


@pytest.mark.parametrize("b", [B.Booster(4, 0.3, "depth", depth=3, l2=1.0, least_hessian=1.0), B.Booster(4, 0.3, "leaf", leaves=6, least_rows=20, fold=1)])
def test_trees_equal_a_plain_version(spark, b, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_ROWS", 100)  # several blocks
    monkeypatch.setattr(B, "STORE_ROUNDS", 2)
    df, x, y = table(spark)
    edges = B.bin_edges(df, "features_tree")
    own = np.arange(len(y)) if b.fold is None else np.flatnonzero(np.arange(len(y)) % 3 != b.fold)
    model, other = B.fit_many(df, [b, B.Booster(2, 0.1, "symmetric", depth=2, l2=3.0, least_rows=0, least_hessian=0.0)], fold_col="fold")
    want = plain(x, y, edges, b, own)
    assert np.allclose(model.margin(x), want, atol=1e-9) and model.getNumTrees == 4
    got = {r[0]: float(r[1][1]) for r in model.named("t").transform(df).select("row_id", "raw_t").collect()}
    assert np.allclose([got[k] for k in range(len(y))], want, atol=1e-9)
    for t in other.tables:  # symmetric: one split a level
        level = [0]
        while t[level[0]][1] >= 0:
            assert len({(t[k][1], t[k][2]) for k in level}) == 1
            level = [c for k in level for c in t[k][3:5]]


def test_leaves_and_columns(spark):
    df, x, y = table(spark)
    for b in (B.Booster(3, 0.1, "leaf", leaves=4, least_rows=1), B.Booster(3, 0.1, "depth", depth=2, columns=0.34)):
        (m,) = B.fit_many(df, [b])
        assert all(sum(n[1] < 0 for n in t) <= 4 for t in m.tables)
        if b.columns < 1:
            assert all(len({n[1] for n in t if n[1] >= 0}) <= 1 for t in m.tables)


def test_patience_ends_training(spark):
    df, _, _ = table(spark)
    val, _, _ = table(spark, 200, seed=2)
    asked = B.Booster(60, 0.9, "leaf", leaves=31, least_rows=1, patience=3)
    (stopped,) = B.fit_many(df, [asked], val=val)
    (full,) = B.fit_many(df, [B.Booster(60, 0.9, "leaf", leaves=31, least_rows=1)])
    assert stopped.trained_rounds <= stopped.getNumTrees + 3 < 60 and stopped.tables == full.tables[:stopped.getNumTrees]


def test_presets_differ_and_are_saved(spark, tmp_path):
    df, x, _ = table(spark)
    assert booster("catboost", {"l2_leaf_reg": 7, "depth": 4}).l2 == 7 and booster("lightgbm", {"num_leaves": 63}).leaves == 63
    model = fit_booster("xgboost", {"n_estimators": 3, "max_depth": 2}, df, None)
    save_model(model, str(tmp_path / "m"))
    assert np.allclose(load_model(str(tmp_path / "m")).margin(x), model.margin(x))


def test_without_rows_or_one_class(spark):
    df, x, _ = table(spark)
    (m,) = B.fit_many(df.withColumn("label", F.lit(1)), [B.Booster(2, 0.1)])
    assert np.isfinite(m.margin(x)).all() and (m.margin(x) > 0).all()
    (none,) = B.fit_many(df.limit(0), [B.Booster(2, 0.1)])
    assert none.getNumTrees == 0


def test_newton_equals_lbfgs(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    _, x, y = table(spark)
    df = spark.createDataFrame([(k, int(y[k]), k % 3, *map(float, x[k])) for k in range(len(y))], "row_id long, label int, fold int, a double, b double, c double")
    regs = [(1e-4, 0), (0.01, 1), (1.0, None)]
    got = newton_fits(df, ["a", "b", "c"], regs)
    v = VectorAssembler(inputCols=["a", "b", "c"], outputCol="v").transform(df)
    for (reg, fold), row in zip(regs, got):
        m = LogisticRegression(featuresCol="v", regParam=reg, standardization=False, tol=1e-12, maxIter=500).fit(v if fold is None else v.filter(F.col("fold") != fold))
        assert np.allclose(row, [*m.coefficients, m.intercept], atol=1e-6)
    meta = MetaLogistic()
    model = meta.fit(df.select("row_id", "label", "a", "b", "c"), ["a", "b", "c"])
    by_one = MetaLogistic()
    lr = LogisticRegression(featuresCol="meta_features", standardization=False, tol=1e-10, predictionCol="pred_meta")
    from tessera.operators.ordinal import stratified_fold_assign
    f = stratified_fold_assign(VectorAssembler(inputCols=["a", "b", "c"], outputCol="meta_features").transform(df.drop("fold")), "label", k=3, seed=42)
    jobs = [(c, k) for c in (0, 5, 9) for k in range(3)]
    acc = by_one._one_by_one(lr, f, jobs, len(y) * 2 / 3)
    assert [meta.cv_accuracy_[c] for c in (0, 5, 9)] == pytest.approx([sum(acc[c, k] for k in range(3)) / 3 for c in (0, 5, 9)], abs=1e-9)
    assert model.model.coefficients.size == 3


def test_blocks_follow_the_rows():
    """A pass costs a task for each block: few and large ones, but one for each of a dozen cores."""
    from tessera.operators import boosting as B
    assert [B._n_blocks(n) for n in (0, 1, 8_192, 20_000, 1_000_000, 5_400_000)] == [1, 1, 1, 3, 12, 42]


def test_histogram_by_feature():
    from tessera.operators import boosting as B
    rng = np.random.default_rng(3)
    bins, at, rows = rng.integers(0, 4, (50, 3)).astype(np.uint8), rng.integers(0, 2, 30), np.sort(rng.permutation(50)[:30])
    g, h = rng.normal(size=30), rng.random(30)
    got = B._sums(at, bins, rows, g, h, (2, 3, 4), np.array([False, True, False]))
    want = np.zeros((2, 3, 4, 3))
    for i, r in enumerate(rows):
        for f in (0, 1):
            want[at[i], f, bins[r, f]] += (g[i], h[i], 1)
    assert np.allclose(got, want)


def test_a_table_that_a_task_holds_needs_no_job_for_a_pass(spark, monkeypatch):
    """The rounds run inside a few jobs, over several blocks, and the trees are those of the passes over spread rows."""
    monkeypatch.setattr(B, "BLOCK_ROWS", 100)
    df, _, _ = table(spark)
    val = df.filter("row_id % 4 = 0")
    many = [B.Booster(12, 0.3, "depth", depth=3, l2=1.0, rows=0.7, columns=0.7), B.Booster(12, 0.2, "leaf", leaves=6, least_rows=5, patience=3, fold=1),
            B.Booster(12, 0.2, "symmetric", depth=3, l2=3.0, least_hessian=0.0, least_rows=0, patience=4), B.Booster(0, 0.1)]

    def fitted(group):
        spark.sparkContext.setJobGroup(group, group)
        try:
            models = B.fit_many(df.filter("row_id % 4 <> 0"), many, val=val, fold_col="fold")
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return models, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    held, jobs = fitted("held")
    assert jobs < 12  # a round takes several passes
    monkeypatch.setattr(B, "TASK_CELLS", 0)
    spread, more = fitted("spread")
    assert more > 36
    for a, b in zip(held, spread):
        assert (a.base, a.trained_rounds, len(a.tables)) == (b.base, b.trained_rounds, len(b.tables))
        for s, t in zip(a.tables, b.tables):
            assert [n[:5] for n in s] == [n[:5] for n in t]
            assert np.allclose([n[5:] for n in s], [n[5:] for n in t], atol=1e-12)
