"""Hand-made edge rows (FIXTURES §4) and partition invariance."""

import math

from pyspark.sql import functions as F

from tessera.functions.expressions import cut
from tessera.functions.features import WORK_TYPE_EDGES, WORK_TYPE_LABELS, add_custom_features
from tessera.operators import clean as C
from tessera.operators import encode as EN
from tessera.operators import metrics as M
from tessera.operators import ordinal as O
from tessera.operators import profile as P


def test_work_type_bins_are_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (35.0,), (45.0,), (100.0,), (101.0,), (None,), (0.5,)], "h double")
    got = [r[0] for r in df.select(cut(F.col("h"), WORK_TYPE_EDGES, WORK_TYPE_LABELS)).collect()]
    assert got == ["nan", "part_time", "full_time", "overtime", "nan", "nan", "part_time"]


def test_sentinel_whole_cell_only(spark):
    df = spark.createDataFrame([("?",), (" ?",), ("a?",), (None,)], "s string")
    got = [r[0] for r in C.replace_sentinel(df).collect()]
    assert got == [None, " ?", "a?", None]


def test_mode_tie_takes_smallest_and_median_interpolates(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 2.0), ("a", None), ("b", 4.0), (None, 3.0)], "s string, x double")
    fills = C.fit_imputer(df, exclude=())
    assert fills["categorical"]["s"] == "a"
    assert fills["numeric"]["x"] == 2.5
    out = C.apply_imputer(df, fills).collect()
    assert [r.s for r in out] == ["b", "a", "a", "b", "a"]
    assert [r.x for r in out] == [1.0, 2.0, 2.5, 4.0, 3.0]


def test_all_null_column_stays_null(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    fills = C.fit_imputer(df, exclude=())
    assert fills["numeric"]["a"] is None
    assert C.null_census(C.apply_imputer(df, fills)).filter("column = '__total__'").first()["nulls"] == 2


def test_downcast_strict_bounds(spark):
    df = spark.createDataFrame([(126, 127, 128, -127, -128, 1.5)],
                               "a bigint, b bigint, c bigint, d bigint, e bigint, f double")
    plan = {r["column"]: r["new_type"] for r in C.downcast_plan(df).collect()}
    assert plan == {"a": "tinyint", "b": "smallint", "c": "smallint", "d": "tinyint", "e": "smallint",
                    "f": "float"}
    narrowed, _ = C.reduce_mem_usage(df)
    assert dict(narrowed.dtypes)["a"] == "tinyint"


def test_constant_column_scaler_and_corr(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, k double")
    stats = EN.fit_standard_scaler(df, ["x", "k"])
    assert stats["k"] == (5.0, 1.0)
    out = EN.apply_standard_scaler(spark.createDataFrame([(7.0, 6.0)], "x double, k double"), stats)
    assert out.first()["k"] == 1.0          # x - mean, not 0
    corr = {(r.col_a, r.col_b): r.corr for r in P.corr_matrix(df, ["x", "k"]).collect()}
    assert corr[("x", "x")] == 1.0 and corr[("x", "k")] is None


def test_unseen_category_gets_minus_one_and_no_dummy(spark):
    train = spark.createDataFrame([(1, "a"), (2, "b")], "row_id long, c string")
    test = spark.createDataFrame([(3, "z"), (4, "a"), (5, None)], "row_id long, c string")
    vocab = EN.fit_vocabulary(train, ["c"])
    codes = {r.row_id: r.c for r in EN.label_encode(test, vocab, ["c"]).collect()}
    assert codes == {3: -1, 4: 0, 5: -1}
    oh = EN.one_hot_long(test, EN.fit_vocabulary(train, ["c"], keep_missing=False), ["c"], 2).collect()
    assert [(r.row_id, r.feature_index, r.feature) for r in oh] == [(4, 2, "c_a")]


def test_feature_pipeline_unseen_is_all_zero(spark):
    from pyspark.ml.functions import vector_to_array
    train = spark.createDataFrame([("a",), ("b",), ("a",)], "c string")
    test = spark.createDataFrame([("z",), ("b",), (None,)], "c string")
    model = EN.feature_pipeline([], ["c"]).fit(train)
    rows = model.transform(test).select(vector_to_array("c__oh").alias("v")).collect()
    assert [list(r.v) for r in rows] == [[0.0, 0.0], [0.0, 1.0], [0.0, 0.0]]
    coded = EN.tree_codes(model, model.transform(test), ["c"]).select("c__code").collect()
    assert [r[0] for r in coded] == [-1.0, 1.0, -1.0]


def test_class_never_predicted_and_weighted_recall_is_accuracy(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0), (2, 0), (1, 1)], "label int, prediction int")
    r = M.classification_report(df).first()
    assert r.accuracy == r.recall == 0.6
    cm = M.confusion_matrix(df).collect()
    assert len(cm) == 9 and sum(x["count"] for x in cm) == 5


def test_auc_ties_and_all_tied(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.5), (0, 0.5)], "label int, score double")
    assert M.roc_auc(df).first().roc_auc == 0.5
    df2 = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, 0.4), (0, 0.4)], "label int, score double")
    assert M.roc_auc(df2).first().roc_auc == 0.875       # one tie counted half
    pts = sorted((r.fpr, r.tpr) for r in M.roc_points(df2).collect())
    assert pts[0] == (0.0, 0.0) and pts[-1] == (1.0, 1.0)


def test_binary_metrics_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "label int, prediction int")
    r = M.binary_metrics(df, 1).first()
    assert (r.precision, r.recall, r.f1) == (0.0, 0.0, 0.0)


def test_custom_features_missing_values(spark):
    df = spark.createDataFrame([(30.0, None, 40.0, None, 5.0, None, None, "x", 0.0)],
                               "age double, education_num double, hours_per_week double, capital_gain double, "
                               "capital_loss double, sex string, relationship string, marital_status string, "
                               "fnlwgt double")
    r = add_custom_features(df).first()
    assert r.has_capital_activity == 1 and r.is_married == 0 and r.work_type == "full_time"
    assert r.sex_rel_inter == "nan_nan" and "fnlwgt" not in df.drop("fnlwgt").columns
    assert r.net_capital is None


def test_split_and_folds_partition_invariant(spark):
    base = spark.range(0, 3000).withColumnRenamed("id", "row_id").withColumn("label", (F.col("row_id") % 3 == 0).cast("int"))
    a = O.stratified_fold_assign(O.split_assign(base.repartition(1)), "label", k=5).collect()
    b = O.stratified_fold_assign(O.split_assign(base.repartition(7)), "label", k=5).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    sizes = {}
    for r in a:
        sizes.setdefault((r.label, r.fold), 0)
        sizes[(r.label, r.fold)] += 1
    for lab in (0, 1):
        counts = [sizes[(lab, f)] for f in range(5)]
        assert max(counts) - min(counts) <= 1


def test_split_exact_sizes(spark):
    base = spark.range(0, 1001).withColumnRenamed("id", "row_id")
    got = {r.split: r["count"] for r in O.split_exact(base).groupBy("split").count().collect()}
    assert got == {"train": 600, "val": 200, "test": 201}


def test_sample_rows_cap_and_repeatable(spark):
    base = spark.range(0, 500).withColumnRenamed("id", "row_id")
    a = [r.row_id for r in O.sample_rows(base.repartition(3), 50).collect()]
    b = [r.row_id for r in O.sample_rows(base.repartition(5), 50).collect()]
    assert a == b and len(set(a)) == 50


def test_value_prefix_sums_exact_ranks(spark):
    rows = [(1, float(v), 1) for v in [3, 1, 2, 2, 5, 5, 5, 9]]
    df = spark.createDataFrame(rows, "g int, v double, w long").groupBy("g", "v").agg(F.sum("w").alias("w"))
    got = {r.v: r.before_w for r in O.value_prefix_sums(df, ["g"], "v", ["w"], n_buckets=3).collect()}
    assert got == {1.0: 0, 2.0: 1, 3.0: 3, 5.0: 4, 9.0: 7}


def test_mutual_info_independent_and_identical(spark):
    rows = [(i % 2, i % 2, (i // 2) % 2) for i in range(400)]
    df = spark.createDataFrame(rows, "label int, same int, indep int")
    mi = {r.feature: r.mutual_info for r in P.mutual_info(df, ["same", "indep"]).collect()}
    assert abs(mi["same"] - round(math.log(2), 6)) < 1e-6 and mi["indep"] == 0.0


def test_class_balance_topn_other(spark):
    rows = [(c,) for c, n in zip("abcdefghijkl", range(12, 0, -1)) for _ in range(n)]
    df = spark.createDataFrame(rows, "c string")
    out = {r["class"]: r["count"] for r in P.class_balance_topn(df, "c", 10).collect()}
    assert out["Other"] == 2 + 1 and len(out) == 11


def test_hash_ordinal_many_runs_equals_global_order(spark, monkeypatch):
    from pyspark.sql import Window
    monkeypatch.setattr(O, "ROWS_PER_BUCKET", 500)        # force many coarse windows
    base = spark.range(0, 6000).withColumnRenamed("id", "row_id").withColumn("label", (F.col("row_id") % 3 == 0).cast("int"))
    a = O.hash_ordinal(base, partition_cols=["label"])
    b = base.withColumn("h", O.hash_key("row_id", 42)).withColumn(
        "o2", F.row_number().over(Window.partitionBy("label").orderBy("h", "row_id")))
    assert a.join(b, ["row_id", "label"]).filter("ordinal != o2").count() == 0


def test_value_prefix_sums_default_buckets(spark, monkeypatch):
    monkeypatch.setattr(O, "ROWS_PER_BUCKET", 10)
    rows = [(g, float(v % 37), 1) for g in (1, 2) for v in range(500)]
    df = spark.createDataFrame(rows, "g int, v double, w long").groupBy("g", "v").agg(F.sum("w").alias("w"))
    got = {(r.g, r.v): r.before_w for r in O.value_prefix_sums(df, ["g"], "v", ["w"]).collect()}
    exp = {}
    for g in (1, 2):
        acc = 0
        for v in range(37):
            exp[(g, float(v))] = acc
            acc += sum(1 for x in range(500) if x % 37 == v)
    assert got == exp


def test_metrics_partition_invariant(spark):
    rows = [(i % 3, int((i * 7) % 5 < 2), int((i * 11) % 5 < 2), round(((i * 37) % 101) / 100, 2))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "model int, label int, prediction int, score double")

    def run(d):
        rep = sorted(map(tuple, M.classification_report(d, ["model"]).collect()))
        auc = sorted(map(tuple, M.roc_auc(d, ["model"]).collect()))
        pts = sorted(map(tuple, M.roc_points(d, ["model"]).collect()), key=str)
        return rep, auc, pts

    assert run(df.repartition(1)) == run(df.repartition(7)) == run(df.repartition(3, "score"))
