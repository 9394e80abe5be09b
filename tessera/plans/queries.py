"""Queries registered for the driver: each reads the whole source tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name]`` (DuckDB SQL
over the source views) are kept side by side so every computed column has
the same alias in both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import cut, numeric_columns, rnd, string_columns
from ..functions.features import WORK_TYPE_EDGES, WORK_TYPE_LABELS
from ..operators import clean as C
from ..operators import cluster as K
from ..operators import encode as EN
from ..operators import evaluate as EV
from ..operators import explain as X
from ..operators import metrics as M
from ..operators import ordinal as O
from ..operators import profile as P
from ..operators.models import DEFAULT_PARAMS, LINEAR_KEYS
from ..operators.outliers import dbscan_clusters, dbscan_flags
from ..sources.fixtures import WIDE_MARRIED, customer_wide, scored_models, wide
from . import experiment as XP
from . import sql as S
from .preprocessing import PrepConfig, clean_and_engineer, flagship

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


WIDE_CFG = PrepConfig(married_values=WIDE_MARRIED)
PREP_CFG = PrepConfig(married_values=WIDE_MARRIED, narrow=True, outliers=True, clusters=True)


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_and_engineer(wide(spark, sf_dir), WIDE_CFG)


# ---------------------------------------------------------------- flagship
@register("flagship", "WITH " + S.PREP + """
SELECT work_type, split, count(*) AS n_rows,
       """ + S.rnd_sql("avg(label)", 6) + """ AS positive_rate,
       """ + S.rnd_sql("avg(net_capital_log)", 4) + """ AS mean_net_capital_log
FROM prep GROUP BY work_type, split""")
def q_flagship(spark, sf_dir):
    return flagship(wide(spark, sf_dir), WIDE_CFG)


@register("pipeline_prep")
def q_pipeline_prep(spark, sf_dir):
    """§3.2 with every stage, in the reference's order: target, imputation,
    narrowed types, density filter, cluster feature, custom features, split."""
    return clean_and_engineer(wide(spark, sf_dir), PREP_CFG)


# ---------------------------------------------------------------- frames

PREP_SKIP = ("row_id", "label", "split")


def tree_frame(spark, sf_dir):
    """Prepared frame with string columns label-encoded from the train split."""
    p = prepared(spark, sf_dir)
    cats = string_columns(p, PREP_SKIP)
    vocab = EN.fit_vocabulary(p.filter(F.col("split") == "train"), cats)
    return EN.label_encode(p, vocab, cats), numeric_columns(p, PREP_SKIP), cats


def _round_doubles(df, digits=6, skip=()):
    from pyspark.sql import types as T
    return df.select([rnd(F.col(f.name), digits).alias(f.name)
                      if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in skip
                      else F.col(f.name) for f in df.schema.fields])


def _union_sql(parts):
    return "\nUNION ALL\n".join(parts)


# ---------------------------------------------------------------- S1 / F1 / A1-A4
@register("load_profile", "WITH " + S.WIDE + "\n" + _union_sql([
    f"SELECT '{c}' AS column, '{t}' AS data_type, count(*) AS rows, count(*) - count({c}) AS nulls, "
    f"count(DISTINCT {c}) AS distinct_values FROM wide"
    for c, t in [("row_id", "bigint"), ("age", "double"), ("fnlwgt", "double"), ("education_num", "double"),
                 ("hours_per_week", "double"), ("capital_gain", "double"), ("capital_loss", "double"),
                 ("relationship", "string"), ("sex", "string"), ("marital_status", "string"),
                 ("native_country", "string"), ("income", "string")]]))
def q_load_profile(spark, sf_dir):
    return P.load_profile(wide(spark, sf_dir))


@register("clean_missing", "WITH " + S.IMPUTED + "\nSELECT row_id, label, "
          + ", ".join(f"{S.rnd_sql(c, 6)} AS {c}" for c in S.WIDE_NUM) + ", "
          + ", ".join(S.WIDE_STR) + " FROM imputed")
def q_clean_missing(spark, sf_dir):
    from ..session import cut_lineage
    df, _ = EN.encode_target(cut_lineage(wide(spark, sf_dir)), "income", "label")
    out = C.smart_impute(df.drop("income"), exclude=("row_id", "label"))
    return _round_doubles(out)


@register("null_census", "WITH " + S.WIDE + ",\nc AS (SELECT row_id, age, fnlwgt, education_num, hours_per_week, "
          "capital_gain, capital_loss, " + ", ".join(f"CASE WHEN {c} = '?' THEN NULL ELSE {c} END AS {c}"
                                                     for c in S.WIDE_STR + ("income",)) + " FROM wide)\n"
          + _union_sql([f"SELECT '{c}' AS column, CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM c"
                        for c in ("row_id",) + S.WIDE_NUM + S.WIDE_STR + ("income",)]
                       + ["SELECT '__total__' AS column, CAST(" + " + ".join(
                           f"(count(*) - count({c}))" for c in ("row_id",) + S.WIDE_NUM + S.WIDE_STR + ("income",))
                          + " AS BIGINT) AS nulls FROM c"]))
def q_null_census(spark, sf_dir):
    return C.null_census(C.replace_sentinel(wide(spark, sf_dir)))


_LI_NUM = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
           ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
           ("l_discount", "double"), ("l_tax", "double")]
_W = {"tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4, "double": 8}


def _downcast_sql():
    parts = []
    for c, t in _LI_NUM:
        lo, hi = f"(CAST(min({c}) AS DOUBLE) + 0.0)", f"(CAST(max({c}) AS DOUBLE) + 0.0)"
        if t in ("bigint", "int"):
            new = (f"CASE WHEN {lo} > -128 AND {hi} < 127 THEN 'tinyint' "
                   f"WHEN {lo} > -32768 AND {hi} < 32767 THEN 'smallint' "
                   f"WHEN {lo} > -2147483648 AND {hi} < 2147483647 THEN 'int' ELSE 'bigint' END")
        else:
            new = (f"CASE WHEN {lo} > -{C.FLOAT32_MAX!r} AND {hi} < {C.FLOAT32_MAX!r} "
                   f"THEN 'float' ELSE 'double' END")
        wmap = " ".join(f"WHEN '{k}' THEN {v}" for k, v in _W.items())
        parts.append(f"SELECT \"column\", old_type, new_type, min_value, max_value, rows, rows * {_W[t]} AS old_bytes, "
                     f"rows * CASE new_type {wmap} END AS new_bytes FROM (SELECT '{c}' AS column, '{t}' AS old_type, "
                     f"{new} AS new_type, {lo} AS min_value, {hi} AS max_value, count(*) AS rows FROM lineitem) x")
    return _union_sql(parts)


@register("downcast_report", _downcast_sql())
def q_downcast_report(spark, sf_dir):
    from ..sources.tables import read_table
    return C.downcast_plan(read_table(spark, sf_dir, "lineitem").drop("l_shipdate"))


# ---------------------------------------------------------------- E1 / X / E5-E7 / F9
@register("target_encode", "WITH " + S.WIDE + """
SELECT income, CAST(dense_rank() OVER (ORDER BY income) - 1 AS INTEGER) AS label, count(*) AS n_rows
FROM wide GROUP BY income""")
def q_target_encode(spark, sf_dir):
    enc, _classes = EN.encode_target(wide(spark, sf_dir), "income", "label")
    return enc.groupBy("income", "label").agg(F.count(F.lit(1)).alias("n_rows"))


_CUSTOM = ("edu_age_inter", "work_hours_edu", "net_capital", "has_capital_activity", "work_type",
           "sex_rel_inter", "is_married", "net_capital_log")


@register("custom_features", "WITH " + S.PREP + "\nSELECT row_id, " + ", ".join(
    f"{S.rnd_sql(c, 6)} AS {c}" if c in ("edu_age_inter", "work_hours_edu", "net_capital", "net_capital_log") else c
    for c in _CUSTOM) + " FROM prep")
def q_custom_features(spark, sf_dir):
    return _round_doubles(prepared(spark, sf_dir).select("row_id", *_CUSTOM))


@register("work_type_bins", "WITH " + S.WIDE + """
SELECT CASE WHEN hours_per_week > 0 AND hours_per_week <= 35 THEN 'part_time'
            WHEN hours_per_week > 35 AND hours_per_week <= 45 THEN 'full_time'
            WHEN hours_per_week > 45 AND hours_per_week <= 100 THEN 'overtime'
            ELSE 'nan' END AS work_type, count(*) AS n_rows
FROM wide GROUP BY 1""")
def q_work_type_bins(spark, sf_dir):
    w = wide(spark, sf_dir)
    return (w.select(cut(F.col("hours_per_week"), WORK_TYPE_EDGES, WORK_TYPE_LABELS).alias("work_type"))
             .groupBy("work_type").agg(F.count(F.lit(1)).alias("n_rows")))


def _scale_sql():
    stats = ", ".join(f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 OR stddev_pop({c}) IS NULL "
                      f"THEN 1.0 ELSE stddev_pop({c}) END AS s_{c}" for c in S.PREP_NUM)
    cols = ", ".join(f"{S.rnd_sql(f'(p.{c} - st.m_{c}) / st.s_{c}', 6)} AS {c}" for c in S.PREP_NUM)
    return ("WITH " + S.PREP + f",\nst AS (SELECT {stats} FROM prep WHERE split = 'train')\n"
            f"SELECT p.row_id, p.split, {cols} FROM prep p, st")


@register("standard_scale", _scale_sql())
def q_standard_scale(spark, sf_dir):
    p = prepared(spark, sf_dir)
    num = numeric_columns(p, PREP_SKIP)
    out = EN.standard_scale(p, num, F.col("split") == "train")
    return _round_doubles(out.select("row_id", "split", *num))


@register("split_assign", "WITH " + S.WIDE + f"\nSELECT row_id, {S.split_sql('row_id')} AS split FROM wide")
def q_split_assign(spark, sf_dir):
    return O.split_assign(wide(spark, sf_dir).select("row_id"))


@register("fold_assign", "WITH " + S.WIDE + f"\nSELECT row_id, CAST({S.hash_sql('row_id', '42|fold')} % 5 AS INTEGER) AS fold FROM wide")
def q_fold_assign(spark, sf_dir):
    return O.fold_assign(wide(spark, sf_dir).select("row_id"), k=5)


@register("stratified_fold_assign", "WITH " + S.PREP + f"""
SELECT row_id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY {S.hash_sql('row_id', '42|fold')}, row_id) - 1) % 5 AS INTEGER) AS fold
FROM prep WHERE split = 'train'""")
def q_stratified_fold_assign(spark, sf_dir):
    p = prepared(spark, sf_dir).filter(F.col("split") == "train").select("row_id", "label")
    return O.stratified_fold_assign(p, "label", k=5)


@register("sample_rows", "WITH " + S.WIDE + f"""
SELECT row_id, income, native_country FROM wide ORDER BY {S.hash_sql('row_id', '42|sample')}, row_id LIMIT 1000""")
def q_sample_rows(spark, sf_dir):
    return O.sample_rows(wide(spark, sf_dir).select("row_id", "income", "native_country"), 1000)


# ---------------------------------------------------------------- E2 / E3 / J1
@register("label_encode", "WITH " + S.PREP + ",\n" + S.vocab_sql(S.PREP_STR, "prep", "split = 'train'") + ",\n"
          + S.tree_sql() + "\nSELECT row_id, split, " + ", ".join(S.PREP_STR) + " FROM tree")
def q_label_encode(spark, sf_dir):
    t, _num, cats = tree_frame(spark, sf_dir)
    return t.select("row_id", "split", *cats)


def _one_hot_sql():
    order = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(S.PREP_STR))
    return ("WITH " + S.PREP + ",\n" + S.vocab_sql(S.PREP_STR, "prep", "split = 'train'") + f""",
sizes AS (SELECT "column", count(*) AS k, CASE "column" {order} END AS pos FROM vocab GROUP BY "column"),
offs AS (SELECT "column", {len(S.PREP_NUM)} + COALESCE(sum(k) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM sizes),
fv AS (SELECT v."column", v.value, CAST(o.off + v.code AS BIGINT) AS feature_index, v."column" || '_' || v.value AS feature
       FROM vocab v JOIN offs o ON o."column" = v."column"),
long AS (""" + _union_sql([f"SELECT row_id, '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM prep" for c in S.PREP_STR])
            + """)
SELECT l.row_id, fv.feature_index, fv.feature FROM long l JOIN fv ON fv."column" = l."column" AND fv.value = l.value""")


@register("one_hot", _one_hot_sql())
def q_one_hot(spark, sf_dir):
    p = prepared(spark, sf_dir)
    num, cats = numeric_columns(p, PREP_SKIP), string_columns(p, PREP_SKIP)
    vocab = EN.fit_vocabulary(p.filter(F.col("split") == "train"), cats, keep_missing=False)
    return EN.one_hot_long(p, vocab, cats, len(num)).withColumn("feature_index", F.col("feature_index").cast("long"))


# ---------------------------------------------------------------- A6 / A7 / A8 / L1
@register("class_balance", "WITH " + S.WIDE + """
SELECT CAST(income AS VARCHAR) AS class, count(*) AS count,
       """ + S.rnd_sql("count(*) / sum(count(*)) OVER () * 100", 2) + """ AS percent
FROM wide GROUP BY income""")
def q_class_balance(spark, sf_dir):
    return P.class_balance(wide(spark, sf_dir), "income")


@register("class_balance_topn", "WITH " + S.WIDE + """,
g AS (SELECT native_country, count(*) AS count FROM wide GROUP BY native_country),
r AS (SELECT *, row_number() OVER (ORDER BY count DESC, native_country NULLS FIRST) AS rn, count(*) OVER () AS k FROM g),
k AS (SELECT CASE WHEN k <= 10 OR rn <= 10 THEN CAST(native_country AS VARCHAR) ELSE 'Other' END AS class,
             CASE WHEN k <= 10 OR rn <= 10 THEN rn ELSE 11 END AS position, count FROM r)
SELECT class, sum(count) AS count, """ + S.rnd_sql("sum(count) / sum(sum(count)) OVER () * 100", 2)
          + """ AS percent, position FROM k GROUP BY class, position""")
def q_class_balance_topn(spark, sf_dir):
    out = P.class_balance_topn(wide(spark, sf_dir), "native_country", 10)
    return out.withColumn("position", F.col("position").cast("long"))


_CORR_COLS = ("age", "education_num", "hours_per_week", "capital_gain", "capital_loss", "relationship", "sex",
              "marital_status", "label", "edu_age_inter", "work_hours_edu", "net_capital", "has_capital_activity",
              "work_type", "sex_rel_inter", "is_married", "net_capital_log")


def _corr_sql():
    enc = ", ".join(f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS DOUBLE) AS {c}" if c in S.PREP_STR
                    else f"CAST({c} AS DOUBLE) AS {c}" for c in _CORR_COLS)
    cols = list(_CORR_COLS)
    aggs = [f"stddev_pop({c}) AS s{i}" for i, c in enumerate(cols)]
    for i in range(len(cols)):
        for j in range(i, len(cols)):
            aggs.append(f"covar_pop({cols[i]}, {cols[j]}) AS c{i}_{j}")
    parts = []
    for i in range(len(cols)):
        for j in range(len(cols)):
            a, b = min(i, j), max(i, j)
            parts.append(f"SELECT '{cols[i]}' AS col_a, '{cols[j]}' AS col_b, "
                         f"{S.rnd_sql(f'c{a}_{b} / NULLIF(s{i} * s{j}, 0)', 6)} AS corr FROM agg")
    return ("WITH " + S.PREP + f",\ncenc AS (SELECT {enc} FROM prep),\nagg AS (SELECT {', '.join(aggs)} FROM cenc)\n"
            + _union_sql(parts))


@register("corr_matrix", _corr_sql())
def q_corr_matrix(spark, sf_dir):
    p = prepared(spark, sf_dir).drop("row_id", "split")
    enc, _ = P.encode_for_correlation(p)
    return P.corr_matrix(enc, list(_CORR_COLS))


def _mi_sql():
    feats = S.PREP_NUM + S.PREP_STR
    long = _union_sql([f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, label AS y FROM tree WHERE split = 'train'"
                       for c in feats])
    return ("WITH " + S.PREP + ",\n" + S.vocab_sql(S.PREP_STR, "prep", "split = 'train'") + ",\n" + S.tree_sql() + f""",
long AS ({long}),
cells AS (SELECT feature, value, y, count(*) AS n_xy FROM long GROUP BY ALL),
vals AS (SELECT feature, value, sum(n_xy) AS n_v FROM cells GROUP BY ALL),
ranked AS (SELECT *, count(*) OVER (PARTITION BY feature) AS levels, sum(n_v) OVER (PARTITION BY feature) AS n,
                  COALESCE(sum(n_v) OVER (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
           FROM vals),
binned AS (SELECT feature, value, CASE WHEN levels > 32 THEN CAST(floor(32 * before / n) AS DOUBLE) ELSE value END AS xbin FROM ranked),
c2 AS (SELECT c.feature, b.xbin, c.y, sum(c.n_xy) AS n_xy FROM cells c JOIN binned b USING (feature, value) GROUP BY ALL),
t AS (SELECT feature, n_xy / sum(n_xy) OVER (PARTITION BY feature)
             * ln(n_xy * sum(n_xy) OVER (PARTITION BY feature)
                  / (sum(n_xy) OVER (PARTITION BY feature, xbin) * sum(n_xy) OVER (PARTITION BY feature, y))) AS t FROM c2),
mi AS (SELECT feature, {S.rnd_sql('greatest(sum(t), 0.0)', 6)} AS mutual_info FROM t GROUP BY feature)
SELECT feature, mutual_info, CASE WHEN mutual_info > 0.5 THEN 'HIGH' WHEN mutual_info > 0 THEN 'ok' ELSE 'zero' END AS alert,
       CAST(row_number() OVER (ORDER BY mutual_info DESC, feature) AS INTEGER) AS rank FROM mi""")


@register("mutual_info", _mi_sql())
def q_mutual_info(spark, sf_dir):
    t, num, cats = tree_frame(spark, sf_dir)
    return P.mutual_info(t.filter(F.col("split") == "train"), num + cats, "label")


# ---------------------------------------------------------------- metrics

SM = "WITH " + S.WIDE + ",\n" + S.scored_models_sql()


def _val(spark, sf_dir, split="val"):
    return scored_models(spark, sf_dir).filter(F.col("split") == split)


@register("confusion_matrix", SM + """,
v AS (SELECT * FROM sm WHERE split = 'val'),
cls AS (SELECT DISTINCT label AS c FROM v UNION SELECT DISTINCT prediction FROM v),
grid AS (SELECT m.model, a.c AS actual, p.c AS predicted FROM (SELECT DISTINCT model FROM v) m, cls a, cls p),
cnt AS (SELECT model, label AS actual, prediction AS predicted, count(*) AS n FROM v GROUP BY ALL)
SELECT g.model, g.actual, g.predicted, CAST(COALESCE(cnt.n, 0) AS BIGINT) AS count
FROM grid g LEFT JOIN cnt USING (model, actual, predicted)""")
def q_confusion_matrix(spark, sf_dir):
    return M.confusion_matrix(_val(spark, sf_dir), ["model"])


@register("classification_metrics", SM + "\nSELECT * FROM " + S.cls_report_sql("(SELECT * FROM sm WHERE split = 'val')", ["model"]) + " r")
def q_classification_metrics(spark, sf_dir):
    return M.classification_report(_val(spark, sf_dir), ["model"])


@register("roc_auc", SM + "\nSELECT * FROM " + S.auc_sql("(SELECT * FROM sm WHERE split = 'val')", ["model"]) + " r")
def q_roc_auc(spark, sf_dir):
    return M.roc_auc(_val(spark, sf_dir), ["model"])


@register("roc_points", SM + "\nSELECT model, score AS threshold, " + S.rnd_sql("cum_neg / sum(neg) OVER (PARTITION BY model)", 6)
          + " AS fpr, " + S.rnd_sql("cum_pos / sum(pos) OVER (PARTITION BY model)", 6) + " AS tpr FROM "
          + S.score_table_sql("(SELECT * FROM sm WHERE split = 'val')", ["model"])
          + " st\nUNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), 0.0, 0.0 FROM sm WHERE split = 'val'")
def q_roc_points(spark, sf_dir):
    return M.roc_points(_val(spark, sf_dir), ["model"])


_MINORITY_SQL = "(SELECT label FROM sm WHERE split = 'val' GROUP BY label ORDER BY count(*), label LIMIT 1)"


def _bin_sql(src, groups, pos):
    g = ", ".join(groups)
    return f"""(SELECT {g}, {S.rnd_sql(S.safe_div_sql('tp', 'tp + fp'), 6)} AS precision,
       {S.rnd_sql(S.safe_div_sql('tp', 'tp + fn'), 6)} AS recall,
       {S.rnd_sql(S.safe_div_sql('2 * tp', '2 * tp + fp + fn'), 6)} AS f1
FROM (SELECT {g}, sum(CASE WHEN label = {pos} AND prediction = {pos} THEN 1 ELSE 0 END) AS tp,
             sum(CASE WHEN label <> {pos} AND prediction = {pos} THEN 1 ELSE 0 END) AS fp,
             sum(CASE WHEN label = {pos} AND prediction <> {pos} THEN 1 ELSE 0 END) AS fn FROM {src} GROUP BY ALL) x)"""


@register("binary_metrics", SM + "\nSELECT b.*, " + _MINORITY_SQL + " AS positive_class FROM "
          + _bin_sql("(SELECT * FROM sm WHERE split = 'val')", ["model"], _MINORITY_SQL) + " b")
def q_binary_metrics(spark, sf_dir):
    v = _val(spark, sf_dir)
    pos = P.minority_class(v).first()["label"]      # one row: the class value
    return M.binary_metrics(v, pos, ["model"]).withColumn("positive_class", F.lit(pos))


def _fold_metrics_sql():
    pos = "(SELECT label FROM tr GROUP BY label ORDER BY count(*), label LIMIT 1)"
    return (SM + f""",
tr AS (SELECT * FROM sm WHERE split = 'train'),
f AS (SELECT *, CAST((row_number() OVER (PARTITION BY model, label ORDER BY {S.hash_sql('row_id', '42|fold')}, row_id) - 1) % 5 AS INTEGER) AS fold FROM tr),
acc AS (SELECT model, fold, 'accuracy' AS metric, accuracy AS value FROM {S.cls_report_sql('f', ['model', 'fold'], None)} r),
fb AS (SELECT model, fold, sum(CASE WHEN label = {pos} AND prediction = {pos} THEN 1 ELSE 0 END) AS tp,
              sum(CASE WHEN label <> {pos} AND prediction = {pos} THEN 1 ELSE 0 END) AS fp,
              sum(CASE WHEN label = {pos} AND prediction <> {pos} THEN 1 ELSE 0 END) AS fn FROM f GROUP BY ALL),
lng AS (SELECT * FROM acc
        UNION ALL SELECT model, fold, 'precision', {S.safe_div_sql('tp', 'tp + fp')} FROM fb
        UNION ALL SELECT model, fold, 'recall', {S.safe_div_sql('tp', 'tp + fn')} FROM fb
        UNION ALL SELECT model, fold, 'f1', {S.safe_div_sql('2 * tp', '2 * tp + fp + fn')} FROM fb)
SELECT model, metric, {S.rnd_sql('avg(value)', 6)} AS mean, {S.rnd_sql('stddev_pop(value)', 6)} AS std FROM lng GROUP BY ALL""")


@register("metrics_by_fold", _fold_metrics_sql())
def q_metrics_by_fold(spark, sf_dir):
    return fold_metrics(_val(spark, sf_dir, "train"), k=5)


def fold_metrics(preds, k=5):
    """V7's scoring half: per-fold accuracy and minority-class P/R/F1, then
    mean and population sd per model and metric."""
    f = O.stratified_fold_assign(preds, "label", k=k, group_cols=["model"])
    pos = P.minority_class(preds).first()["label"]
    acc = M.classification_report(f, ["model", "fold"], digits=None).select(
        "model", "fold", F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value"))
    b = M.binary_metrics(f, pos, ["model", "fold"], digits=None)
    long = acc.unionByName(b.unpivot(["model", "fold"], ["precision", "recall", "f1"], "metric", "value"))
    return M.summarize_scores(long, ["model", "metric"])


@register("leaderboard", SM + """,
t AS (SELECT * FROM sm WHERE split = 'test'),
m AS (SELECT r.*, a.roc_auc FROM """ + S.cls_report_sql("t", ["model"]) + " r LEFT JOIN " + S.auc_sql("t", ["model"])
          + """ a USING (model))
SELECT *, CAST(row_number() OVER (ORDER BY f1 DESC NULLS LAST, model) AS INTEGER) AS rank FROM m""")
def q_leaderboard(spark, sf_dir):
    return EV.leaderboard(_val(spark, sf_dir, "test"))


@register("winner", SM + """,
t AS (SELECT * FROM sm WHERE split = 'val')
SELECT model AS winner FROM """ + S.cls_report_sql("t", ["model"]) + """ r ORDER BY f1 DESC NULLS LAST, model LIMIT 1""")
def q_winner(spark, sf_dir):
    """T5: the model with the best validation f1, one row."""
    return EV.winner(M.classification_report(_val(spark, sf_dir), ["model"]))


@register("metric_long_form", SM + "\nSELECT model, metric, score FROM (SELECT * FROM "
          + S.cls_report_sql("(SELECT * FROM sm WHERE split = 'val')", ["model"]) + """ r)
UNPIVOT (score FOR metric IN (accuracy AS 'Accuracy', precision AS 'Precision', recall AS 'Recall', f1 AS 'F1'))""")
def q_metric_long_form(spark, sf_dir):
    return M.metric_long_form(M.classification_report(_val(spark, sf_dir), ["model"]))


THRESHOLDS = (0.3, 0.4, 0.5, 0.6, 0.7)


def _search_sql():
    vals = ", ".join(f"({i}, {t!r})" for i, t in enumerate(THRESHOLDS))
    return (SM + f""",
tr AS (SELECT * FROM sm WHERE split = 'train'),
f AS (SELECT *, CAST((row_number() OVER (PARTITION BY model, label ORDER BY {S.hash_sql('row_id', '42|fold')}, row_id) - 1) % 3 AS INTEGER) AS fold FROM tr),
c AS (SELECT * FROM (VALUES {vals}) v(candidate, threshold)),
x AS (SELECT f.model, f.label, f.fold, c.candidate, CAST(c.threshold AS DOUBLE) AS threshold,
             CAST(f.score >= c.threshold AS INTEGER) AS prediction FROM f, c),
pf AS (SELECT * FROM {S.cls_report_sql('x', ['model', 'candidate', 'threshold', 'fold'], None)} r),
search AS (SELECT model, candidate, threshold, {', '.join(S.rnd_sql(f'avg({m})', 6) + f' AS {m}' for m in ('accuracy', 'precision', 'recall', 'f1'))}
           FROM pf GROUP BY ALL)""")


@register("tuning_top3", _search_sql() + """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY f1 DESC, candidate) AS position FROM search) WHERE position <= 3""")
def q_tuning_top3(spark, sf_dir):
    s = EV.threshold_search(_val(spark, sf_dir, "train"), THRESHOLDS, k=3)
    return EV.top_candidates(s, "f1", 3).withColumn("position", F.col("position").cast("long"))


@register("param_curve", _search_sql() + "\nSELECT threshold, " + S.rnd_sql("avg(f1)", 6) + " AS mean_f1, "
          + S.rnd_sql("max(f1)", 6) + " AS max_f1, count(*) AS candidates FROM search GROUP BY threshold")
def q_param_curve(spark, sf_dir):
    s = EV.threshold_search(_val(spark, sf_dir, "train"), THRESHOLDS, k=3)
    return EV.param_curve(s, "threshold", "f1")


@register("regression_metrics", """
WITH x AS (SELECT l_returnflag, l_extendedprice AS label, l_quantity * p_retailprice AS prediction
           FROM lineitem JOIN part ON p_partkey = l_partkey)
SELECT l_returnflag, """ + S.rnd_sql("sqrt(avg((prediction - label) * (prediction - label)))", 4) + " AS rmse, "
          + S.rnd_sql("avg(abs(prediction - label))", 4) + " AS mae, "
          + S.rnd_sql("1 - sum((prediction - label) * (prediction - label)) / NULLIF(count(*) * var_pop(label), 0)", 4)
          + " AS r2 FROM x GROUP BY l_returnflag")
def q_regression_metrics(spark, sf_dir):
    from ..sources.tables import read_table
    li = read_table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", "l_quantity", "l_extendedprice")
    pt = read_table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    x = li.join(pt, li.l_partkey == pt.p_partkey).select(
        "l_returnflag", F.col("l_extendedprice").alias("label"),
        (F.col("l_quantity") * F.col("p_retailprice")).alias("prediction"))
    return M.regression_report(x, ["l_returnflag"])


# ---------------------------------------------------------------- O1

_CW_NUM = ("acctbal", "n_orders", "spend", "max_order")


def _dbscan_sql(eps=0.5, m=3):
    st = ", ".join(f"avg({c}) AS m{i}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s{i}"
                   for i, c in enumerate(_CW_NUM))
    z = ", ".join(f"(CAST({c} AS DOUBLE) - m{i}) / s{i} AS z{i}" for i, c in enumerate(_CW_NUM))
    d2 = " + ".join(f"(a.z{i} - b.z{i}) * (a.z{i} - b.z{i})" for i in range(len(_CW_NUM)))
    e2 = repr(eps * eps)
    return ("WITH " + S.CUSTOMER_WIDE + f""",
st AS (SELECT {st} FROM customer_wide),
z AS (SELECT row_id, {z} FROM customer_wide, st),
nb AS (SELECT a.row_id, count(*) AS n FROM z a JOIN z b ON {d2} <= {e2} GROUP BY a.row_id),
core AS (SELECT row_id FROM nb WHERE n >= {m}),
border AS (SELECT DISTINCT a.row_id FROM z a JOIN z b ON {d2} <= {e2} JOIN core c ON c.row_id = b.row_id)
SELECT z.row_id, z.row_id IN (SELECT row_id FROM core) AS is_core,
       NOT (z.row_id IN (SELECT row_id FROM core)) AND NOT (z.row_id IN (SELECT row_id FROM border)) AS is_noise
FROM z""")


@register("outlier_noise", _dbscan_sql())
def q_outlier_noise(spark, sf_dir):
    return dbscan_flags(customer_wide(spark, sf_dir), list(_CW_NUM), eps=0.5, min_samples=3)


def _clusters_sql(eps=0.5, m=3):
    """Core rows reachable from each other by steps of at most eps, by recursion over all pairs of core rows."""
    d2 = " + ".join(f"(a.z{i} - b.z{i}) * (a.z{i} - b.z{i})" for i in range(len(_CW_NUM)))
    start = _dbscan_sql(eps, m)
    flags = start[len("WITH "):start.rindex("SELECT z.row_id")].rstrip()
    return "WITH RECURSIVE " + flags + f""",
zc AS (SELECT z.* FROM z JOIN core USING (row_id)),
step AS (SELECT a.row_id AS a, b.row_id AS b FROM zc a JOIN zc b ON {d2} <= {eps * eps!r}),
reach AS (SELECT row_id, row_id AS root FROM core UNION SELECT s.b, r.root FROM reach r JOIN step s ON s.a = r.row_id WHERE r.root < s.b),
named AS (SELECT row_id, min(root) AS cluster_id FROM reach GROUP BY row_id),
edge AS (SELECT a.row_id, min(n.cluster_id) AS cluster_id FROM z a JOIN z b ON {d2} <= {eps * eps!r} JOIN named n ON n.row_id = b.row_id GROUP BY a.row_id)
SELECT z.row_id, CAST(coalesce(n.cluster_id, e.cluster_id, -1) AS BIGINT) AS cluster_id
FROM z LEFT JOIN named n ON n.row_id = z.row_id LEFT JOIN edge e ON e.row_id = z.row_id"""


@register("dbscan_clusters", _clusters_sql())
def q_dbscan_clusters(spark, sf_dir):
    """O2: the cluster of every customer, -1 for noise."""
    return dbscan_clusters(customer_wide(spark, sf_dir), list(_CW_NUM), eps=0.5, min_samples=3)


# ---------------------------------------------------------------- model-based (rows-only: solver-dependent values)


def feature_set(spark, sf_dir):
    return XP.build_feature_set(prepared(spark, sf_dir), WIDE_CFG)


def _val_predictions(spark, sf_dir, key, params):
    fs = feature_set(spark, sf_dir)
    model = XP.train_model(key, params, fs)
    return XP.predictions(model, fs.df.filter(F.col("split") == "val"), key)


@register("kmeans_clusters")
def q_kmeans_clusters(spark, sf_dir):
    p = clean_and_engineer(wide(spark, sf_dir), PrepConfig(married_values=WIDE_MARRIED))
    return K.add_clustering_features(p, 5, restarts=10).select("row_id", "cluster_feature")


@register("cluster_distribution")
def q_cluster_distribution(spark, sf_dir):
    return K.cluster_distribution(q_kmeans_clusters(spark, sf_dir))


@register("pca_2d")
def q_pca_2d(spark, sf_dir):
    p = prepared(spark, sf_dir)
    p = p.join(K.add_clustering_features(p, 5, restarts=10).select("row_id", "cluster_feature"), "row_id")
    cols = numeric_columns(p, ("row_id", "cluster_feature", "split"))
    return K.pca_2d(p, cols, "cluster_feature")


@register("logistic_regression")
def q_logistic_regression(spark, sf_dir):
    return _val_predictions(spark, sf_dir, "logistic_regression", DEFAULT_PARAMS["logistic_regression"])


@register("decision_tree")
def q_decision_tree(spark, sf_dir):
    return _val_predictions(spark, sf_dir, "decision_tree", {"max_depth": 10, "min_samples_leaf": 2})


@register("random_forest")
def q_random_forest(spark, sf_dir):
    return _val_predictions(spark, sf_dir, "random_forest", DEFAULT_PARAMS["random_forest"])


@register("adaboost")
def q_adaboost(spark, sf_dir):
    return _val_predictions(spark, sf_dir, "adaboost", {"n_estimators": 50, "learning_rate": 1.0})


@register("gradient_boosting")
def q_gradient_boosting(spark, sf_dir):
    return _val_predictions(spark, sf_dir, "gradient_boosting", {"n_estimators": 100, "learning_rate": 0.1,
                                                                 "max_depth": 3})


@register("booster_rounds", """
SELECT * FROM (VALUES ('gradient_boosting', 100, 100, 'all rounds'), ('xgboost', 200, 200, 'all rounds'))
AS t(family, asked, trained, stop_rule)""")
def q_booster_rounds(spark, sf_dir):
    """M5-M7: families without early stopping train every round asked for."""
    fs = feature_set(spark, sf_dir)
    rows = []
    for key in ("gradient_boosting", "xgboost"):
        params = {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3} if key == "gradient_boosting" else DEFAULT_PARAMS[key]
        rows.append((key, params["n_estimators"], XP.train_model(key, params, fs).getNumTrees, "all rounds"))
    return spark.createDataFrame(rows, "family string, asked int, trained int, stop_rule string")


@register("booster_presets")
def q_booster_presets(spark, sf_dir):
    """M6, M7: the three presets with their own growth and parameters, trained in the same passes."""
    from ..operators.boosting import fit_many
    from ..operators.models import PATIENCE, PATIENCE_KEYS, PRESET_KEYS, booster
    fs = feature_set(spark, sf_dir)
    train, val = (fs.df.filter(F.col("split") == s) for s in ("train", "val"))
    models = fit_many(train, [booster(k, DEFAULT_PARAMS[k], patience=PATIENCE if k in PATIENCE_KEYS else None) for k in PRESET_KEYS], val=val)
    out = None
    for key, m in zip(PRESET_KEYS, models):
        p = XP.evaluate_model(m.named(key), val, key)
        out = p if out is None else out.unionByName(p)
    return out


@register("tuning_search")
def q_tuning_search(spark, sf_dir):
    """H1 over every family of the experiment, each with its whole grid."""
    from ..operators.tuning import random_search
    train = feature_set(spark, sf_dir).df.filter(F.col("split") == "train")
    out = None
    for key in XP.EXPERIMENT_TREE_KEYS + LINEAR_KEYS:
        results = random_search(key, train, n_iter=10, k=3, refit=False).results
        out = results if out is None else out.unionByName(results)
    return out


@register("n_trees_curve")
def q_n_trees_curve(spark, sf_dir):
    from ..operators.tuning import n_estimators_curve, random_search
    fs = feature_set(spark, sf_dir)
    s = random_search("random_forest", fs.df.filter(F.col("split") == "train"), n_iter=10, k=3, refit=False)
    return n_estimators_curve(s)


_TOP3 = {k: (k, DEFAULT_PARAMS[k]) for k in ("logistic_regression", "lightgbm", "random_forest")}


@register("blending")
def q_blending(spark, sf_dir):
    from ..operators.ensemble import Blending
    fs = feature_set(spark, sf_dir)
    bases = XP.train_models(_TOP3, fs)
    model = Blending(bases).fit(fs.df.filter(F.col("split") == "val"))
    return XP.predictions(model, fs.df.filter(F.col("split") == "test"), "blending_ensemble")


@register("stacking")
def q_stacking(spark, sf_dir):
    from ..operators.ensemble import Stacking
    fs = feature_set(spark, sf_dir)
    model = Stacking(_TOP3, n_splits=5).fit(fs.df.filter(F.col("split") == "train"))
    return XP.predictions(model, fs.df.filter(F.col("split") == "val"), "stacking_ensemble")


@register("cv_stability")
def q_cv_stability(spark, sf_dir):
    fs = feature_set(spark, sf_dir)
    return XP.cross_validation_stability("random_forest", DEFAULT_PARAMS["random_forest"], fs, k=5,
                                         splits=("train", "val"))


@register("feature_importance")
def q_feature_importance(spark, sf_dir):
    fs = feature_set(spark, sf_dir)
    m = XP.train_model("random_forest", DEFAULT_PARAMS["random_forest"], fs)
    return X.feature_importance(spark, m, fs.tree_names, top_n=15)


@register("attribution")
def q_attribution(spark, sf_dir):
    fs = feature_set(spark, sf_dir)
    m = XP.train_model("random_forest", DEFAULT_PARAMS["random_forest"], fs)
    return X.attribution(fs.df.filter(F.col("split") == "val"), m, fs.tree_names, kind="mean").limit(10)


@register("shapley_additivity", "WITH " + S.WIDE + f"""
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_off FROM wide WHERE {S.split_sql('row_id')} = 'val'""")
def q_shapley_additivity(spark, sf_dir):
    """Base plus exact Shapley values is the tree's probability on every validation row."""
    from pyspark.ml.functions import vector_to_array
    fs = feature_set(spark, sf_dir)
    m = XP.train_model("decision_tree", {"max_depth": 10, "min_samples_leaf": 2}, fs)
    val = fs.df.filter(F.col("split") == "val")
    values = X.shapley(val, m, fs.tree_names)
    total = F.col("base") + F.aggregate("contributions", F.lit(0.0), lambda a, v: a + v)
    p = m.transform(val).select("row_id", vector_to_array("prob_decision_tree")[1].alias("p"))
    return values.join(p, "row_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum((F.abs(total - F.col("p")) > 1e-9).cast("long")).alias("n_off"))


@register("experiment_run")
def q_experiment_run(spark, sf_dir):
    """§3.1 end to end on the whole `wide` table with the whole grids: the
    test leaderboard of every family and both ensembles."""
    return XP.run_experiment(prepared(spark, sf_dir), WIDE_CFG)["test_leaderboard"]


@register("sample_by_split", "WITH " + S.WIDE + f"""
SELECT split, count(*) AS n_rows FROM (
  SELECT {S.split_sql('row_id')} AS split FROM wide ORDER BY {S.hash_sql('row_id', '42|sample')}, row_id LIMIT 1000) GROUP BY split""")
def q_sample_by_split(spark, sf_dir):
    """F9 against E5: a sample holds rows of every split, because the two hash with different purposes."""
    s = O.sample_rows(wide(spark, sf_dir).select("row_id"), 1000)
    return O.split_assign(s).groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


_NULL_COLS = ("age", "education_num", "hours_per_week", "capital_gain", "capital_loss")


@register("corr_matrix_nulls", "WITH " + S.WIDE + " " + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, floor(corr({a}, {b}) * 1e6 + 0.5) / 1e6 AS corr FROM wide"
    for a in _NULL_COLS for b in _NULL_COLS))
def q_corr_matrix_nulls(spark, sf_dir):
    """A8 on rows with missing values: each pair over the rows that hold both."""
    return P.corr_matrix(wide(spark, sf_dir), list(_NULL_COLS))


def _outlier_filter_sql(eps=2.5, m=3):
    """The same rule by plain self-join: rows with a core row within eps, over seven standardised columns."""
    dims = ("label",) + S.WIDE_NUM
    st = ", ".join(f"avg({c}) AS m{i}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s{i}" for i, c in enumerate(dims))
    z = ", ".join(f"(CAST({c} AS DOUBLE) - m{i}) / s{i} AS z{i}" for i, c in enumerate(dims))
    d2 = " + ".join(f"(a.z{i} - b.z{i}) * (a.z{i} - b.z{i})" for i in range(len(dims)))
    return ("WITH " + S.IMPUTED + f""",
st AS (SELECT {st} FROM imputed),
z AS (SELECT row_id, {z} FROM imputed, st),
core AS (SELECT a.* FROM z a JOIN (SELECT a.row_id FROM z a JOIN z b ON {d2} <= {eps * eps!r} GROUP BY a.row_id HAVING count(*) >= {m}) c USING (row_id)),
border AS (SELECT DISTINCT a.row_id FROM (SELECT * FROM z WHERE row_id NOT IN (SELECT row_id FROM core)) a JOIN core b ON {d2} <= {eps * eps!r})
SELECT * FROM imputed WHERE row_id IN (SELECT row_id FROM core) OR row_id IN (SELECT row_id FROM border)""")


@register("outlier_filter", _outlier_filter_sql())
def q_outlier_filter(spark, sf_dir):
    """O1 + F4 in the pipeline's setting: every numeric column of the imputed
    `wide` table (target included, as in the reference), eps 2.5, min 3."""
    from ..operators.outliers import dbscan_filter
    from ..session import stored
    df, _ = EN.encode_target(stored(wide(spark, sf_dir)), "income", "label")
    imp = C.smart_impute(df.drop("income"), exclude=("row_id", "label"))
    return dbscan_filter(imp, numeric_columns(imp, ("row_id",)), eps=2.5, min_samples=3)


@register("experiment_summary", SM + """,
v AS (SELECT * FROM sm WHERE split = 'val')
SELECT r.model, r.accuracy, r.f1, r.precision, r.recall, a.roc_auc FROM """ + S.cls_report_sql("v", ["model"])
          + " r LEFT JOIN " + S.auc_sql("v", ["model"]) + " a USING (model)")
def q_experiment_summary(spark, sf_dir):
    """H5: long (model, split, metric, value) rows pivoted to one row per model."""
    p = scored_models(spark, sf_dir)
    rep = EV.model_metrics(p, ["model", "split"])
    long = rep.unpivot(["model", "split"], list(EV.SUMMARY_METRICS), "metric", "value").withColumn(
        "train_time", F.lit(None).cast("double"))
    return EV.experiment_summary(long, "val").drop("train_time")


@register("mutual_info_knn")
def q_mutual_info_knn(spark, sf_dir):
    """L2: k-nearest-neighbour MI of every tree feature with the label, over
    the whole train split (the estimator the reference's leakage check uses;
    checked against brute force in tests/test_mi_knn.py)."""
    from ..operators.mi_knn import mutual_info_knn
    t, num, cats = tree_frame(spark, sf_dir)
    return mutual_info_knn(t.filter(F.col("split") == "train"), num + cats, "label", k=3)


@register("mutual_info_knn_regression")
def q_mutual_info_knn_regression(spark, sf_dir):
    """L2 with a continuous target: every other tree feature against the
    weekly hours, over the whole train split (checked against brute force in
    tests/test_mi_knn_regression.py)."""
    from ..operators.mi_knn_regression import mutual_info_knn_regression
    t, num, cats = tree_frame(spark, sf_dir)
    feats = [c for c in num + cats if c != "hours_per_week"]
    return mutual_info_knn_regression(t.filter(F.col("split") == "train"), feats, "hours_per_week", k=3)


#: One-vs-rest scorers of the weekly-hours band, as SQL that both engines read.
_BANDS = {"short": "1 / (1 + exp(0.02 * coalesce(age, 40.0) + 0.1 * coalesce(education_num, 8.0) - 2))",
          "usual": "1 / (1 + exp(0.1 * abs(coalesce(age, 40.0) - 42.0) - 1))",
          "long": "1 / (1 + exp(4 - 0.04 * coalesce(age, 40.0) - 0.2 * coalesce(education_num, 8.0)))"}
_BAND = "CASE WHEN hours_per_week < 40 THEN 'short' WHEN hours_per_week < 60 THEN 'usual' WHEN hours_per_week >= 60 THEN 'long' END"


@register("roc_auc_ovr", "WITH " + S.WIDE + f",\nb AS (SELECT {S.split_sql('row_id')} AS split, {_BAND} AS label, "
          + ", ".join(f"{S.rnd_sql(e, 4)} AS s_{c}" for c, e in _BANDS.items()) + " FROM wide),\nl AS ("
          + _union_sql([f"SELECT split, '{c}' AS class, s_{c} AS score, CASE WHEN label = '{c}' THEN 1 ELSE 0 END AS label FROM b WHERE label IS NOT NULL"
                        for c in _BANDS])
          + "),\nn AS (SELECT split, class, CAST(sum(label) AS BIGINT) AS support FROM l GROUP BY ALL)\n"
          + "SELECT n.split, n.class, n.support, a.roc_auc FROM n JOIN " + S.auc_sql("l", ["split", "class"]) + " a USING (split, class)")
def q_roc_auc_ovr(spark, sf_dir):
    """V3 over three classes: AUC of each class against the rest, by split."""
    b = O.split_assign(wide(spark, sf_dir)).select(
        "split", F.expr(_BAND).alias("label"), *[rnd(F.expr(e), 4).alias(f"s_{c}") for c, e in _BANDS.items()])
    return M.roc_auc_ovr(b, list(_BANDS), [f"s_{c}" for c in _BANDS], ["split"])
