"""Contracts of the verdict round: rounds kept by patience, NULL keys, independent hashes, correlation over present pairs."""
import math

import pytest
from pyspark.sql import functions as F

from tessera.operators import metrics as M
from tessera.operators.clean import fill_values
from tessera.operators.models import build, first_rounds, rounds_to_keep
from tessera.operators.ordinal import fold_assign, sample_rows, split_assign, stratified_fold_assign
from tessera.operators.profile import corr_matrix


def test_patience_on_a_loss_curve():
    assert rounds_to_keep([5, 4, 3, 3.5, 3.2, 2], patience=3) == 6
    assert rounds_to_keep([5, 4, 3, 3.5, 3.2, 3.1, 2], patience=3) == 3
    assert rounds_to_keep([1.0]) == 1
    assert rounds_to_keep(list(range(100, 0, -1))) == 100
    assert rounds_to_keep([1] + [2] * 200) == 1


def test_first_rounds_equal_a_shorter_training(spark):
    from pyspark.ml.functions import array_to_vector
    df = spark.range(400).select(F.col("id").alias("row_id"), ((F.col("id") % 7 + F.col("id") % 3) > 4).cast("int").alias("label"),
                                 array_to_vector(F.array((F.col("id") % 7).cast("double"), (F.col("id") % 5).cast("double"))).alias("features_tree"))
    params = {"n_estimators": 12, "learning_rate": 0.3, "max_depth": 2}
    model = build("gradient_boosting", **params).fit(df)
    assert model.getNumTrees == 12
    cut, short = first_rounds(model, 5), build("gradient_boosting", **params | {"n_estimators": 5}).fit(df)
    assert cut.getNumTrees == 5
    rows = lambda m: [r[0] for r in m.transform(df).orderBy("row_id").select("prob_gradient_boosting").collect()]
    assert rows(cut) == rows(short)


def test_null_labels_keep_their_rows(spark):
    df = spark.range(30).select(F.col("id").alias("row_id"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("label"))
    rows = stratified_fold_assign(df, k=5).collect()
    assert len(rows) == 30
    sizes = [sum(r.label is None and r.fold == k for r in rows) for k in range(5)]
    assert sizes == [2] * 5


def test_samples_folds_and_splits_are_independent(spark):
    df = fold_assign(split_assign(spark.range(5000).withColumnRenamed("id", "row_id")))
    shares = {r.split: r["count"] / 1000 for r in sample_rows(df, 1000).groupBy("split").count().collect()}
    assert abs(shares["train"] - 0.6) < 0.06 and abs(shares["test"] - 0.2) < 0.06
    cells = df.filter("split = 'train'").groupBy("fold").count().collect()
    assert len(cells) == 5 and all(abs(r["count"] - 600) < 100 for r in cells)


def test_null_score_is_an_error(spark):
    df = spark.createDataFrame([(1, 0.5), (0, None)], "label int, score double")
    with pytest.raises(Exception, match="NULL in score column"):
        M.roc_auc(df).collect()


def test_correlation_uses_pairs_that_are_present(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, None, 5.0), (3.0, 5.0, 5.0), (None, 9.0, 5.0), (7.0, 8.0, None), (100.0, None, 5.0)]
    got = {(r.col_a, r.col_b): r["corr"] for r in corr_matrix(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"]).collect()}
    x, y = [1, 3, 7], [2, 5, 8]
    mx, my = sum(x) / 3, sum(y) / 3
    want = sum((p - mx) * (q - my) for p, q in zip(x, y)) / math.sqrt(sum((p - mx) ** 2 for p in x) * sum((q - my) ** 2 for q in y))
    assert got["a", "b"] == pytest.approx(want, abs=1e-6) and got["a", "a"] == 1 and got["a", "c"] is None


def test_fill_values(spark):
    rows = [(1.0, "b", None), (3.0, "a", None), (2.0, "a", None), (10.0, "b", None), (None, None, None)]
    df = spark.createDataFrame(rows, "n double, s string, empty string").withColumn("none", F.lit(None).cast("double"))
    assert fill_values(df, ["n", "none"], ["s", "empty"]) == {"numeric": {"n": 2.5, "none": None}, "categorical": {"s": "a", "empty": None}}
    assert fill_values(df.limit(0), ["n"], ["s"]) == {"numeric": {"n": None}, "categorical": {"s": None}}


def test_csv_missing_values(spark, tmp_path):
    from tessera.sources.tables import load_csv
    (tmp_path / "a.csv").write_text("education.num,hours,name,gap,whole\n1,2.5,NA,,7\nNA,n/a,nan,None,8\n3,NaN,?,null,9\n")
    df = load_csv(spark, str(tmp_path / "a.csv"))
    assert df.dtypes == [("education_num", "double"), ("hours", "double"), ("name", "string"), ("gap", "string"), ("whole", "bigint")]
    assert [tuple(r) for r in df.collect()] == [(1.0, 2.5, None, None, 7), (None, None, None, None, 8), (3.0, None, "?", None, 9)]
    given = load_csv(spark, str(tmp_path / "a.csv"), "a double, b double, c string, d double, e int")
    assert [t for _, t in given.dtypes] == ["double", "double", "string", "double", "int"] and given.filter("education_num IS NULL").count() == 1


def test_adaboost_tells_three_classes_apart(spark):
    from pyspark.ml.functions import array_to_vector
    from tessera.operators.adaboost import AdaBoost
    df = spark.range(300).select(F.col("id").alias("row_id"), F.floor(F.col("id") / 100).cast("int").alias("label"),
                                 array_to_vector(F.array(F.col("id").cast("double"), (F.col("id") % 7).cast("double"))).alias("features_tree"))
    model = AdaBoost(n_estimators=12).fit(df)
    out = model.transform(df).select("label", F.col("pred_adaboost").cast("int").alias("p"), "prob_adaboost").collect()
    assert model.n_classes == 3 and sum(r.label == r.p for r in out) > 285
    assert all(len(r.prob_adaboost) == 3 and abs(sum(r.prob_adaboost) - 1) < 1e-9 for r in out)


def test_search_by_task(spark):
    from pyspark.ml.functions import array_to_vector
    from tessera.operators.tuning import random_search
    df = spark.range(200).select(F.col("id").alias("row_id"), (F.col("id") % 13 * 1.5).alias("label"),
                                 array_to_vector(F.array((F.col("id") % 13).cast("double"))).alias("features_tree"))
    found = random_search("decision_tree", df, {"max_depth": [1, 5], "min_samples_leaf": [1]}, task="regression", refit=False)
    assert found.best_params["max_depth"] == 5
