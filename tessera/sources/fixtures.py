"""Test tables derived from the star schema (FIXTURES.md §3).

All of them read the whole source tables; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import rnd
from .tables import read_table


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for the reference's source table: one row per order."""
    li = (read_table(spark, sf_dir, "lineitem")
          .groupBy("l_orderkey")        # partial aggregation before the shuffle
          .agg(F.min("l_partkey").alias("partkey"),
               F.max("l_quantity").alias("qty"),
               F.min("l_linestatus").alias("linestatus"),
               F.max(F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 40),
                            F.col("l_extendedprice") * F.col("l_discount")).otherwise(0.0)).alias("gain"),
               F.max(F.when((F.col("l_returnflag") == "A") & (F.col("l_quantity") > 40),
                            F.col("l_extendedprice") * F.col("l_tax")).otherwise(0.0)).alias("loss")))
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # nation is a fixed 25-row dimension: a broadcast of bounded size
    n = F.broadcast(read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_size")

    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(n, F.col("c_nationkey") == n.n_nationkey)
          .join(li, li.l_orderkey == o.o_orderkey, "left")
          .join(p, p.p_partkey == li.partkey, "left"))
    ok = F.col("o_orderkey")
    size16 = F.col("p_size") % 16
    income_score = (F.coalesce(size16, F.lit(0)) + F.coalesce(F.col("qty"), F.lit(0.0)) / 5
                    + (ok * 13) % 7)
    return j.select(
        ok.alias("row_id"),
        (17 + (ok * 7 + F.col("partkey")) % 60).cast("double").alias("age"),
        F.col("o_totalprice").alias("fnlwgt"),
        F.when(ok % 31 == 0, F.lit(None)).otherwise((1 + size16).cast("double")).alias("education_num"),
        (2 * F.col("qty") + 1).alias("hours_per_week"),
        F.col("gain").alias("capital_gain"),
        F.col("loss").alias("capital_loss"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("?"))
         .otherwise(F.col("o_orderpriority")).alias("relationship"),
        F.col("linestatus").alias("sex"),
        F.col("c_mktsegment").alias("marital_status"),
        F.col("n_name").alias("native_country"),
        F.when(income_score > 21, F.lit(">50K")).otherwise(F.lit("<=50K")).alias("income"),
    )


# Married set used with the `wide` fixture (its marital_status holds segments).
WIDE_MARRIED = ("BUILDING", "MACHINERY")


def customer_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: balance, order count and spend."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    o = (read_table(spark, sf_dir, "orders")
         .groupBy("o_custkey")          # aggregate orders first, then a 1:1 join
         .agg(F.count("o_orderkey").alias("n"),
              F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("s"),
              F.max("o_totalprice").alias("m")))
    return (c.join(o, c.c_custkey == o.o_custkey, "left")
             .select(F.col("c_custkey").alias("row_id"),
                     F.col("c_acctbal").alias("acctbal"),
                     F.coalesce(F.col("n"), F.lit(0)).alias("n_orders"),
                     F.col("c_mktsegment").alias("segment"),
                     F.coalesce(F.col("s").cast("double"), F.lit(0.0)).alias("spend"),
                     F.coalesce(F.col("m"), F.lit(0.0)).alias("max_order")))


def scored(spark: SparkSession, sf_dir: str, wide_df: DataFrame | None = None) -> DataFrame:
    """Labels and an analytic score that need no fitted model."""
    w = wide_df if wide_df is not None else wide(spark, sf_dir)
    z = (0.25 * F.coalesce(F.col("education_num"), F.lit(8.0))
         + 0.05 * F.coalesce(F.col("hours_per_week"), F.lit(60.0)) - 8)
    return w.select("row_id",
                    F.when(F.col("income") == ">50K", 1).otherwise(0).alias("label"),
                    rnd(1 / (1 + F.exp(-z)), 4).alias("score"))


def _sigmoid(z):
    return 1 / (1 + F.exp(-z))


# Analytic scorers over `wide` (no fitted model): name -> linear term.
SCORERS = (
    ("edu_hours", lambda e, h, a: 0.25 * e + 0.05 * h - 8),
    ("edu_only", lambda e, h, a: 0.3 * e - 3),
    ("hours_age", lambda e, h, a: 0.04 * h + 0.02 * a - 4),
)


def scored_models(spark: SparkSession, sf_dir: str, wide_df: DataFrame | None = None) -> DataFrame:
    """Long predictions ``(model, row_id, split, label, score, prediction)``
    for three analytic scorers; rows expand by a fixed factor of three."""
    from ..operators.ordinal import split_assign
    w = wide_df if wide_df is not None else wide(spark, sf_dir)
    e = F.coalesce(F.col("education_num"), F.lit(8.0))
    h = F.coalesce(F.col("hours_per_week"), F.lit(60.0))
    a = F.coalesce(F.col("age"), F.lit(40.0))
    arr = F.array(*[F.struct(F.lit(n).alias("model"), rnd(_sigmoid(fn(e, h, a)), 4).alias("score"))
                    for n, fn in SCORERS])
    x = split_assign(w.select("row_id", "education_num", "hours_per_week", "age", "income"))
    x = x.select("row_id", "split", F.when(F.col("income") == ">50K", 1).otherwise(0).alias("label"),
                 F.explode(arr).alias("m"))
    return x.select("m.model", "row_id", "split", "label", "m.score",
                    (F.col("m.score") >= 0.5).cast("int").alias("prediction"))
