"""Classification and regression metrics.

Every metric is computed from an aggregated table keyed by the group columns
(model, fold, ...): the k x k confusion counts, or per distinct score the
positive/negative counts. Rows are touched once, in a map-side-combined
aggregate; no prediction is ever collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import rnd, safe_div
from .ordinal import value_prefix_sums

MAX_CLASSES = 1000


def confusion_counts(df: DataFrame, group_cols: Sequence[str] = (), label_col: str = "label",
                     pred_col: str = "prediction") -> DataFrame:
    """``(group..., label, prediction, n)`` for the cells that occur."""
    return (df.groupBy(*group_cols, F.col(label_col).alias("label"), F.col(pred_col).alias("prediction"))
              .agg(F.count(F.lit(1)).alias("n")))


def confusion_matrix(df: DataFrame, group_cols: Sequence[str] = (), label_col: str = "label",
                     pred_col: str = "prediction", classes: Sequence | None = None) -> DataFrame:
    """V5: every actual x predicted cell per group, zero cells included.

    The class list is the union of labels and predictions (at most
    ``MAX_CLASSES``, checked); the full grid is generated per group from that
    bounded list and left-joined to the counts.
    """
    g = list(group_cols)
    cells = confusion_counts(df, g, label_col, pred_col)
    if classes is None:
        cls = (cells.select(F.col("label").alias("c")).union(cells.select(F.col("prediction").alias("c")))
                    .distinct().limit(MAX_CLASSES + 1).collect())
        if len(cls) > MAX_CLASSES:
            raise ValueError("too many classes for a confusion matrix")
        classes = sorted(r["c"] for r in cls if r["c"] is not None)
    grid = F.array(*[F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"))
                     for a in classes for p in classes])
    groups = cells.select(*g).distinct() if g else cells.sparkSession.range(1).select()
    full = groups.select(*g, F.explode(grid).alias("cell")).select(*g, "cell.*")
    c = cells.select(*g, F.col("label").alias("actual"), F.col("prediction").alias("predicted"), "n")
    return (full.join(c, [*g, "actual", "predicted"], "left")
                .select(*g, "actual", "predicted", F.coalesce("n", F.lit(0)).cast("long").alias("count")))


def classification_report(df: DataFrame, group_cols: Sequence[str] = (), label_col: str = "label",
                          pred_col: str = "prediction", digits: int = 6) -> DataFrame:
    """V1: accuracy and support-weighted precision, recall, f1 per group.

    Classes are the union of labels and predictions; a 0/0 ratio counts 0
    (``zero_division=0``). f1 per class is ``2 tp / (support + predicted)``.
    """
    g = list(group_cols)
    cells = confusion_counts(df, g, label_col, pred_col)
    per_label = cells.groupBy(*g, F.col("label").alias("c")).agg(
        F.sum("n").alias("support"), F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n"))
                                            .otherwise(0)).alias("tp"))
    per_pred = cells.groupBy(*g, F.col("prediction").alias("c")).agg(F.sum("n").alias("npred"))
    pc = per_label.join(per_pred, [*g, "c"], "full")
    pc = pc.select(*g, F.coalesce("support", F.lit(0)).alias("support"), F.coalesce("tp", F.lit(0)).alias("tp"),
                   F.coalesce("npred", F.lit(0)).alias("npred"))
    agg = pc.groupBy(*g).agg(
        F.sum("support").alias("n"), F.sum("tp").alias("tp"),
        F.sum(F.col("support") * safe_div(F.col("tp"), F.col("npred"))).alias("wp"),
        F.sum(F.col("support") * safe_div(F.col("tp"), F.col("support"))).alias("wr"),
        F.sum(F.col("support") * safe_div(2 * F.col("tp"), F.col("support") + F.col("npred"))).alias("wf"))
    return agg.select(*g, rnd(safe_div(F.col("tp"), F.col("n")), digits).alias("accuracy"),
                      rnd(safe_div(F.col("wp"), F.col("n")), digits).alias("precision"),
                      rnd(safe_div(F.col("wr"), F.col("n")), digits).alias("recall"),
                      rnd(safe_div(F.col("wf"), F.col("n")), digits).alias("f1"))


def score_table(df: DataFrame, group_cols: Sequence[str] = (), label_col: str = "label",
                score_col: str = "score", positive=1) -> DataFrame:
    """Per group and distinct score: positives, negatives, and the running
    totals in descending score order (a hot score is one row)."""
    g = list(group_cols)
    # a row without a score has no rank: an error, not the top of the order
    known = F.coalesce(F.col(score_col).cast("double"), F.raise_error(F.lit(f"NULL in score column {score_col}")).cast("double"))
    t = (df.groupBy(*g, known.alias("score"))
           .agg(F.sum((F.col(label_col) == positive).cast("long")).alias("pos"),
                F.sum((F.col(label_col) != positive).cast("long")).alias("neg")))
    return value_prefix_sums(t, g, "score", ["pos", "neg"], descending=True)


def roc_auc(df: DataFrame, group_cols: Sequence[str] = (), label_col: str = "label",
            score_col: str = "score", digits: int = 6) -> DataFrame:
    """V3: exact ROC AUC with ties counted half:
    ``sum_s neg_s * (pos above s + pos_s / 2) / (P * N)``; NULL with one class."""
    g = list(group_cols)
    t = score_table(df, g, label_col, score_col)
    a = t.groupBy(*g).agg(F.sum(F.col("neg") * (F.col("before_pos") + F.col("pos") / 2.0)).alias("num"),
                          F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return a.select(*g, rnd(F.try_divide(F.col("num"), F.col("P") * F.col("N")), digits).alias("roc_auc"))


def roc_auc_ovr(df: DataFrame, classes: Sequence, score_cols: Sequence[str], group_cols: Sequence[str] = (),
                label_col: str = "label", digits: int = 6) -> DataFrame:
    """V3 over K classes: ``(group..., class, support, roc_auc)``, each class against the rest by its own score.

    A class that no row of the group has, or that all have, gets NULL. Rows without a label are left out.
    Every row gives K narrow rows, which collapse to one per class and distinct score before any shuffle."""
    g = [*group_cols, "class"]
    scores = F.array(*[F.struct(F.lit(c).alias("class"), F.col(s).cast("double").alias("score")) for c, s in zip(classes, score_cols)])
    long = (df.filter(F.col(label_col).isNotNull()).select(*group_cols, F.col(label_col).alias("__label"), F.explode(scores).alias("__s"))
              .select(*group_cols, "__s.class", "__s.score", (F.col("__label") == F.col("__s.class")).cast("int").alias("__is")))
    t = score_table(long, g, "__is")
    a = t.groupBy(*g).agg(F.sum(F.col("neg") * (F.col("before_pos") + F.col("pos") / 2.0)).alias("num"),
                          F.sum("pos").alias("support"), F.sum("neg").alias("rest"))
    return a.select(*g, "support", rnd(F.try_divide(F.col("num"), F.col("support") * F.col("rest")), digits).alias("roc_auc"))


def roc_auc_average(per_class: DataFrame, group_cols: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """Macro and support-weighted means of ``roc_auc_ovr`` rows, over the classes that have an AUC."""
    known = F.when(F.col("roc_auc").isNotNull(), F.col("support"))
    a = per_class.groupBy(*group_cols).agg(F.avg("roc_auc").alias("m"), F.sum(known * F.col("roc_auc")).alias("s"), F.sum(known).alias("n"))
    return a.select(*group_cols, rnd("m", digits).alias("macro_auc"), rnd(F.try_divide(F.col("s"), F.col("n")), digits).alias("weighted_auc"))


def roc_points(df: DataFrame, group_cols: Sequence[str] = (), label_col: str = "label",
               score_col: str = "score", digits: int = 6) -> DataFrame:
    """V4: ``(threshold, fpr, tpr)`` at every distinct score, plus the origin
    (threshold NULL). All points are kept (no collinear-point dropping)."""
    g = list(group_cols)
    t = score_table(df, g, label_col, score_col)
    if not g:
        t, g = t.withColumn("__g", F.lit(0)), ["__g"]
    # class totals per group by aggregation (one row per group), joined back
    tot = t.groupBy(*g).agg(F.sum("pos").alias("__P"), F.sum("neg").alias("__N"))
    t = t.join(tot, g)
    pts = t.select(*g, F.col("score").alias("threshold"),
                   rnd(F.try_divide(F.col("cum_neg"), F.col("__N")), digits).alias("fpr"),
                   rnd(F.try_divide(F.col("cum_pos"), F.col("__P")), digits).alias("tpr"))
    origin = tot.select(*g, F.lit(None).cast("double").alias("threshold"),
                        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    if g == ["__g"]:
        return pts.unionByName(origin).drop("__g")
    return pts.unionByName(origin)


def binary_metrics(df: DataFrame, positive, group_cols: Sequence[str] = (), label_col: str = "label",
                   pred_col: str = "prediction", digits: int = 6) -> DataFrame:
    """V8: precision, recall and f1 for one chosen positive class; 0/0 is 0."""
    g = list(group_cols)
    y, p = F.col(label_col) == positive, F.col(pred_col) == positive
    a = df.groupBy(*g).agg(F.sum((y & p).cast("long")).alias("tp"), F.sum((~y & p).cast("long")).alias("fp"),
                           F.sum((y & ~p).cast("long")).alias("fn"))
    return a.select(*g, rnd(safe_div(F.col("tp"), F.col("tp") + F.col("fp")), digits).alias("precision"),
                    rnd(safe_div(F.col("tp"), F.col("tp") + F.col("fn")), digits).alias("recall"),
                    rnd(safe_div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), digits).alias("f1"))


def regression_report(df: DataFrame, group_cols: Sequence[str] = (), label_col: str = "label",
                      pred_col: str = "prediction", digits: int = 4) -> DataFrame:
    """V2: rmse, mae, r2 in one aggregate (r2 NULL for a constant target)."""
    g = list(group_cols)
    e = F.col(pred_col).cast("double") - F.col(label_col).cast("double")
    a = df.groupBy(*g).agg(F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
                           F.sum(e * e).alias("sse"), F.count(F.lit(1)).alias("n"),
                           F.var_pop(F.col(label_col).cast("double")).alias("vy"))
    return a.select(*g, rnd(F.sqrt("mse"), digits).alias("rmse"), rnd("mae", digits).alias("mae"),
                    rnd(1 - F.try_divide(F.col("sse"), F.col("n") * F.col("vy")), digits).alias("r2"))


def summarize_scores(scores: DataFrame, group_cols: Sequence[str] = ("metric",), value_col: str = "value",
                     digits: int = 6) -> DataFrame:
    """Mean and population sd of per-fold scores."""
    return scores.groupBy(*group_cols).agg(rnd(F.avg(value_col), digits).alias("mean"),
                                           rnd(F.stddev_pop(value_col), digits).alias("std"))


LONG_METRICS = ("accuracy", "precision", "recall", "f1")


def metric_long_form(wide_metrics: DataFrame, id_col: str = "model",
                     metrics: Sequence[str] = LONG_METRICS) -> DataFrame:
    """H7: ``(model, metric, score)`` rows, metric names capitalised."""
    present = [m for m in metrics if m in wide_metrics.columns]
    long = wide_metrics.unpivot([id_col], present, "metric", "score")
    return long.withColumn("metric", F.initcap("metric"))
