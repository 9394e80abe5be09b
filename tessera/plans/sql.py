"""DuckDB-side SQL for the oracle check: the same fixtures and rules written
as plain SQL over the pre-registered source views."""

from __future__ import annotations

# Written out, not imported from the code under test: 7 hex digits of the hash, cut at 60 % and 80 % of 16^7.
HASH_DIGITS, TRAIN_BELOW, VAL_BELOW = 7, 161061273, 214748364


def rnd_sql(expr: str, digits: int) -> str:
    return f"(floor(CAST({expr} AS DOUBLE) * 1e{digits} + 0.5) / 1e{digits})"


def hash_sql(col: str, seed: int | str = 42) -> str:
    return (f"CAST('0x' || substr(md5(CAST({col} AS VARCHAR) || '|{seed}'), 1, {HASH_DIGITS}) AS BIGINT)")


def split_sql(col: str = "row_id", seed: int = 42) -> str:
    a, b = TRAIN_BELOW, VAL_BELOW
    h = hash_sql(col, seed)
    return f"CASE WHEN {h} < {a} THEN 'train' WHEN {h} < {b} THEN 'val' ELSE 'test' END"


WIDE = """wide AS (
  WITH li AS (
    SELECT l_orderkey, MIN(l_partkey) AS partkey, MAX(l_quantity) AS qty, MIN(l_linestatus) AS linestatus,
           MAX(CASE WHEN l_returnflag = 'R' AND l_quantity > 40 THEN l_extendedprice * l_discount ELSE 0.0 END) AS gain,
           MAX(CASE WHEN l_returnflag = 'A' AND l_quantity > 40 THEN l_extendedprice * l_tax ELSE 0.0 END) AS loss
    FROM lineitem GROUP BY l_orderkey)
  SELECT o.o_orderkey AS row_id,
    CAST(17 + (o.o_orderkey * 7 + li.partkey) % 60 AS DOUBLE) AS age,
    o.o_totalprice AS fnlwgt,
    CASE WHEN o.o_orderkey % 31 = 0 THEN NULL ELSE CAST(1 + p.p_size % 16 AS DOUBLE) END AS education_num,
    2 * li.qty + 1 AS hours_per_week,
    li.gain AS capital_gain,
    li.loss AS capital_loss,
    CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN '?' ELSE o.o_orderpriority END AS relationship,
    li.linestatus AS sex,
    c.c_mktsegment AS marital_status,
    n.n_name AS native_country,
    CASE WHEN COALESCE(p.p_size % 16, 0) + COALESCE(li.qty, 0) / 5 + (o.o_orderkey * 13) % 7 > 21
         THEN '>50K' ELSE '<=50K' END AS income
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
    JOIN nation n ON n.n_nationkey = c.c_nationkey
    LEFT JOIN li ON li.l_orderkey = o.o_orderkey
    LEFT JOIN part p ON p.p_partkey = li.partkey)"""

CUSTOMER_WIDE = """customer_wide AS (
  SELECT c.c_custkey AS row_id, MIN(c.c_acctbal) AS acctbal, COUNT(o.o_orderkey) AS n_orders,
         MIN(c.c_mktsegment) AS segment,
         COALESCE(CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE), 0) AS spend,
         COALESCE(MAX(o.o_totalprice), 0) AS max_order
  FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey
  GROUP BY c.c_custkey)"""

WIDE_NUM = ("age", "fnlwgt", "education_num", "hours_per_week", "capital_gain", "capital_loss")
WIDE_STR = ("relationship", "sex", "marital_status", "native_country")


def _mode(col: str, src: str) -> str:
    return (f"(SELECT {col} FROM {src} WHERE {col} IS NOT NULL GROUP BY {col} "
            f"ORDER BY count(*) DESC, {col} LIMIT 1)")


# wide -> encoded target -> sentinel -> median/mode fill (all rows)
IMPUTED = WIDE + """,
enc AS (SELECT w.*, CAST(dense_rank() OVER (ORDER BY income) - 1 AS INTEGER) AS label FROM wide w),
clean AS (SELECT row_id, label, """ + ", ".join(WIDE_NUM) + ", " + ", ".join(
    f"CASE WHEN {c} = '?' THEN NULL ELSE {c} END AS {c}" for c in WIDE_STR) + """ FROM enc),
fill AS (SELECT """ + ", ".join([f"median({c}) AS {c}" for c in WIDE_NUM]
                                + [f"{_mode(c, 'clean')} AS {c}" for c in WIDE_STR]) + """ FROM clean),
imputed AS (SELECT c.row_id, c.label, """ + ", ".join(
    f"COALESCE(c.{x}, f.{x}) AS {x}" for x in WIDE_NUM + WIDE_STR) + """ FROM clean c, fill f)"""


def features_sql(married=("BUILDING", "MACHINERY"), src: str = "imputed") -> str:
    ins = ", ".join(f"'{m}'" for m in married)
    return f"""feat AS (
  SELECT row_id, label, age, education_num, hours_per_week, capital_gain, capital_loss,
         relationship, sex, marital_status,
         education_num * age AS edu_age_inter,
         hours_per_week * education_num AS work_hours_edu,
         capital_gain - capital_loss AS net_capital,
         CAST((COALESCE(capital_gain > 0, false) OR COALESCE(capital_loss > 0, false)) AS INTEGER) AS has_capital_activity,
         CASE WHEN hours_per_week > 0 AND hours_per_week <= 35 THEN 'part_time'
              WHEN hours_per_week > 35 AND hours_per_week <= 45 THEN 'full_time'
              WHEN hours_per_week > 45 AND hours_per_week <= 100 THEN 'overtime'
              ELSE 'nan' END AS work_type,
         COALESCE(sex, 'nan') || '_' || COALESCE(relationship, 'nan') AS sex_rel_inter,
         CASE WHEN marital_status IN ({ins}) THEN 1 ELSE 0 END AS is_married,
         sign(capital_gain - capital_loss) * ln(1 + abs(capital_gain - capital_loss)) AS net_capital_log
  FROM {src}),
prep AS (SELECT feat.*, {split_sql('row_id')} AS split FROM feat)"""


PREP = IMPUTED + ",\n" + features_sql()


PREP_NUM = ("age", "education_num", "hours_per_week", "capital_gain", "capital_loss",
            "edu_age_inter", "work_hours_edu", "net_capital", "has_capital_activity",
            "is_married", "net_capital_log")
PREP_STR = ("relationship", "sex", "marital_status", "work_type", "sex_rel_inter")


def vocab_sql(cols, src: str, where: str = "TRUE", name: str = "vocab") -> str:
    """(column, value, code) from distinct values of ``src`` rows."""
    parts = [f"SELECT DISTINCT '{c}' AS \"column\", COALESCE(CAST({c} AS VARCHAR), 'nan') AS value "
             f"FROM {src} WHERE {where}" for c in cols]
    return (f"{name} AS (SELECT \"column\", value, CAST(row_number() OVER (PARTITION BY \"column\" ORDER BY value) - 1 AS INTEGER) AS code "
            f"FROM ({' UNION ALL '.join(parts)}) v)")


def tree_sql(src: str = "prep", vocab: str = "vocab", name: str = "tree") -> str:
    """Label-encoded frame: string columns replaced by train codes, unseen -1."""
    joins, sel = [], []
    for i, c in enumerate(PREP_STR):
        joins.append(f"LEFT JOIN {vocab} v{i} ON v{i}.\"column\" = '{c}' AND v{i}.value = COALESCE(CAST(p.{c} AS VARCHAR), 'nan')")
        sel.append(f"COALESCE(v{i}.code, -1) AS {c}")
    return (f"{name} AS (SELECT p.row_id, p.label, p.split, " + ", ".join(f"p.{c}" for c in PREP_NUM)
            + ", " + ", ".join(sel) + f" FROM {src} p " + " ".join(joins) + ")")


def safe_div_sql(a: str, b: str) -> str:
    return f"COALESCE(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0), 0.0)"


def cls_report_sql(src: str, groups, digits=6) -> str:
    """V1 as a subquery over ``src`` with label/prediction columns."""
    g = ", ".join(groups)
    gc = (g + ", ") if groups else ""
    r = (lambda e: rnd_sql(e, digits)) if digits is not None else (lambda e: e)
    return f"""(WITH cells AS (SELECT {gc}label, prediction, count(*) AS n FROM {src} GROUP BY ALL),
  pl AS (SELECT {gc}label AS c, sum(n) AS support, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp FROM cells GROUP BY ALL),
  pp AS (SELECT {gc}prediction AS c, sum(n) AS npred FROM cells GROUP BY ALL),
  pc AS (SELECT {gc}COALESCE(support, 0) AS support, COALESCE(tp, 0) AS tp, COALESCE(npred, 0) AS npred
         FROM pl FULL JOIN pp USING ({gc}c)),
  a AS (SELECT {gc}sum(support) AS n, sum(tp) AS tp,
               sum(support * {safe_div_sql('tp', 'npred')}) AS wp,
               sum(support * {safe_div_sql('tp', 'support')}) AS wr,
               sum(support * {safe_div_sql('2 * tp', 'support + npred')}) AS wf FROM pc GROUP BY ALL)
  SELECT {gc}{r(safe_div_sql('tp', 'n'))} AS accuracy, {r(safe_div_sql('wp', 'n'))} AS precision,
         {r(safe_div_sql('wr', 'n'))} AS recall, {r(safe_div_sql('wf', 'n'))} AS f1 FROM a)"""


def score_table_sql(src: str, groups) -> str:
    g = ", ".join(groups)
    gc = (g + ", ") if groups else ""
    part = f"PARTITION BY {g} " if groups else ""
    return f"""(WITH t AS (SELECT {gc}score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos,
                          sum(CASE WHEN label <> 1 THEN 1 ELSE 0 END) AS neg FROM {src} GROUP BY ALL)
  SELECT *, sum(pos) OVER ({part}ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
            sum(neg) OVER ({part}ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg
  FROM t)"""


def auc_sql(src: str, groups, digits=6) -> str:
    g = ", ".join(groups)
    gc = (g + ", ") if groups else ""
    return (f"(SELECT {gc}{rnd_sql('sum(neg * (cum_pos - pos + pos / 2.0)) / NULLIF(sum(pos) * sum(neg), 0)', digits)} "
            f"AS roc_auc FROM {score_table_sql(src, groups)} st GROUP BY ALL)")


def scored_models_sql() -> str:
    """(model, row_id, split, label, score, prediction) for the analytic scorers."""
    e, h, a = "COALESCE(education_num, 8.0)", "COALESCE(hours_per_week, 60.0)", "COALESCE(age, 40.0)"
    z = {"edu_hours": f"0.25 * {e} + 0.05 * {h} - 8", "edu_only": f"0.3 * {e} - 3",
         "hours_age": f"0.04 * {h} + 0.02 * {a} - 4"}
    parts = []
    for name, lin in z.items():
        sc = rnd_sql(f"1 / (1 + exp(-({lin})))", 4)
        parts.append(f"SELECT '{name}' AS model, row_id, {split_sql('row_id')} AS split, "
                     f"CASE WHEN income = '>50K' THEN 1 ELSE 0 END AS label, {sc} AS score FROM wide")
    return ("sm0 AS (" + " UNION ALL ".join(parts) + "),\n"
            "sm AS (SELECT *, CAST(score >= 0.5 AS INTEGER) AS prediction FROM sm0)")
