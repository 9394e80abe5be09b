"""Plan-shape guards: no registered query plans a cross join."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_no_cross_join(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(f in plan for f in FORBIDDEN), (name, plan[:2000])


def test_flagship_class_lookup_is_broadcast(spark):
    df = E.queries()["flagship"](spark, SF_SMALL)
    df.count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan        # the class lookup is a broadcast of a 2-row table


def test_model_queries_run_the_whole_job(monkeypatch):
    """All families, whole grids, presets and the defaults of the experiment."""
    from types import SimpleNamespace
    from unittest.mock import MagicMock

    from tessera.operators import ensemble, tuning
    from tessera.operators.models import DEFAULT_PARAMS
    from tessera.plans import queries as Q

    searched, trained, ran = [], [], []
    monkeypatch.setattr(Q, "feature_set", lambda *a: MagicMock())
    monkeypatch.setattr(Q, "prepared", lambda *a: "prepared")
    monkeypatch.setattr(Q, "F", MagicMock())
    monkeypatch.setattr(tuning, "random_search", lambda key, train, grid=None, n_iter=10, k=3, refit=True: searched.append((key, grid, n_iter, k)) or SimpleNamespace(results=MagicMock()))
    monkeypatch.setattr(tuning, "n_estimators_curve", lambda s: s)
    monkeypatch.setattr(Q.XP, "train_model", lambda key, params, fs, name=None: trained.append((key, params)))
    monkeypatch.setattr(Q.XP, "predictions", lambda *a: None)
    monkeypatch.setattr(Q.XP, "run_experiment", lambda *a, **b: ran.append((a, b)) or {"test_leaderboard": None})
    monkeypatch.setattr(ensemble, "Blending", MagicMock())
    monkeypatch.setattr(ensemble, "Stacking", lambda bases, n_splits: trained.extend(bases.values()) or MagicMock())
    for name in ("tuning_search", "n_trees_curve", "blending", "stacking", "experiment_run"):
        Q.QUERIES[name](None, None)
    families = ["decision_tree", "random_forest", "adaboost", "gradient_boosting", "xgboost", "lightgbm", "logistic_regression"]
    assert searched == [(k, None, 10, 3) for k in [*families, "random_forest"]]
    assert trained == 2 * [(k, DEFAULT_PARAMS[k]) for k in ("logistic_regression", "lightgbm", "random_forest")]
    assert ran == [(("prepared", Q.WIDE_CFG), {})]


def test_pipeline_prep_runs_every_stage(spark):
    """The rows that the density filter keeps, narrowed, with a cluster of five, features and a split."""
    got = E.queries()["pipeline_prep"](spark, SF_SMALL)
    types = dict(got.dtypes)
    assert types["age"] in ("tinyint", "float") and types["label"] == "tinyint"
    rows = got.select("row_id", "cluster_feature", "split", "net_capital_log").collect()
    kept = E.queries()["outlier_filter"](spark, SF_SMALL).select("row_id").collect()
    assert sorted(r.row_id for r in rows) == sorted(r.row_id for r in kept)
    assert {r.cluster_feature for r in rows} == set(range(5)) and {r.split for r in rows} == {"train", "val", "test"}
    from tessera.plans.queries import prepared
    plain = {r.row_id: r.net_capital_log for r in prepared(spark, SF_SMALL).select("row_id", "net_capital_log").collect()}
    assert all(abs(r.net_capital_log - plain[r.row_id]) < 1e-4 for r in rows)


def test_features_of_narrowed_columns(spark):
    from tessera.functions.features import add_custom_features
    df = spark.sql("SELECT 90Y AS age, 16Y AS education_num, 99Y AS hours_per_week, 32000S AS capital_gain, -32000S AS capital_loss, 'x' AS marital_status")
    r = add_custom_features(df).first()
    assert (r.edu_age_inter, r.work_hours_edu, r.net_capital) == (1440, 1584, 64000)


def test_feature_table_partitions_follow_the_rows(spark):
    """No partition of the table that the models read grows with the data, and a small one is spread too."""
    from tessera.plans.experiment import PARTITION_ROWS, fit_partitions
    assert [fit_partitions(n) for n in (0, 1, 4_097, 900_000)] == [1, 1, 2, 24]
    assert all(n / fit_partitions(n) <= PARTITION_ROWS for n in (9_000_000, 54_000_000))
