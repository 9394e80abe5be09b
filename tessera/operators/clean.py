"""Cleaning: sentinel replacement (F1), imputation (A1, A2), null census (A3),
type narrowing (A4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import numeric_columns, string_columns
from .ordinal import value_prefix_sums

# Fixed value that must equal the reference's: the missing-value sentinel.
SENTINEL = "?"


def replace_sentinel(df: DataFrame, sentinel: str = SENTINEL,
                     columns: Sequence[str] | None = None) -> DataFrame:
    """a cell equal to the sentinel (whole cell only) becomes NULL."""
    cols = list(columns) if columns is not None else string_columns(df)
    return df.withColumns({c: F.when(F.col(c) == sentinel, F.lit(None).cast("string"))
                           .otherwise(F.col(c)) for c in cols})


def impute_statistics(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Fill values as ``(column, number, text)``: exact median per numeric column, mode per string column.

    Columns are unpivoted and counted per distinct value (partial sums), so a
    hot value is one row. The median is the mean of the values at the two
    middle positions, found by distributed prefix sums; the mode is the most
    frequent value, ties to the smallest, by one pre-aggregated minimum. No
    task holds a column's values.
    """
    out = None
    if numeric:
        long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                                             for c in numeric])).alias("kv")).select("kv.*").filter("value IS NOT NULL")
        counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        totals = counts.groupBy("column").agg(F.sum("n").alias("__total"))
        placed = value_prefix_sums(counts, ["column"], "value", ["n"]).join(totals, "column")
        holds = lambda k: (F.col("before_n") < k) & (F.col("cum_n") >= k)
        low, high = F.floor((F.col("__total") + 1) / 2), F.floor(F.col("__total") / 2) + 1
        out = (placed.groupBy("column").agg(F.max(F.when(holds(low), F.col("value"))).alias("a"), F.max(F.when(holds(high), F.col("value"))).alias("b"))
               .select("column", (0.5 * F.col("a") + 0.5 * F.col("b")).alias("number"), F.lit(None).cast("string").alias("text")))
    if categorical:
        long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                                             for c in categorical])).alias("kv")).select("kv.*").filter("value IS NOT NULL")
        counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        modes = (counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("m"))
                 .select("column", F.lit(None).cast("double").alias("number"), F.col("m.value").alias("text")))
        out = modes if out is None else out.unionByName(modes)
    return out


def fill_values(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> dict:
    """Fill values on the driver, one per column: model state bounded by the schema width. A column without values gives None."""
    rows = {r["column"]: r for r in impute_statistics(df, numeric, categorical).collect()} if numeric or categorical else {}
    return {"numeric": {c: rows[c]["number"] if c in rows else None for c in numeric},
            "categorical": {c: rows[c]["text"] if c in rows else None for c in categorical}}


def fit_imputer(df: DataFrame, exclude: Sequence[str] = ("row_id",), sentinel: str = SENTINEL) -> dict:
    """Fit A1/A2 on all rows."""
    df = replace_sentinel(df, sentinel)
    return fill_values(df, numeric_columns(df, exclude), string_columns(df, exclude))


def apply_imputer(df: DataFrame, fills: dict, sentinel: str = SENTINEL) -> DataFrame:
    """Apply fitted fill values as literals (constant-folded, no join)."""
    df = replace_sentinel(df, sentinel)
    out = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(v).cast("double"))
                          for c, v in fills["numeric"].items()})
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast("string"))
                            for c, v in fills["categorical"].items()})


def smart_impute(df: DataFrame, exclude: Sequence[str] = ("row_id",), sentinel: str = SENTINEL,
                 fit_df: DataFrame | None = None) -> DataFrame:
    """F1 + A1 + A2: sentinel to NULL, then median / mode fill.

    Numeric columns come out as double (as after ``SimpleImputer``). Fill values
    come from ``fit_df`` (default: the frame itself, as the reference does).
    """
    fills = fit_imputer(fit_df if fit_df is not None else df, exclude, sentinel)
    return apply_imputer(df, fills, sentinel)


def null_census(df: DataFrame) -> DataFrame:
    """A3: missing cells per column plus a ``__total__`` row, from one pass."""
    cols = df.columns
    counts = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    long = counts.unpivot([], cols, "column", "nulls")
    total = counts.select(F.lit("__total__").alias("column"),
                          sum((F.col(c) for c in cols), F.lit(0).cast("long")).alias("nulls"))
    return long.unionByName(total)


# Integer ranges of numpy int8/int16/int32 and the float32 limit.
INT_RANGES = (("tinyint", -128, 127), ("smallint", -32768, 32767),
              ("int", -2147483648, 2147483647))
FLOAT32_MAX = 3.4028234663852886e38
_WIDTH = {"tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4, "double": 8}
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _narrow_type_expr(kind: str, lo, hi):
    """Choose the narrowest type by strict bounds (a bound value forces wider)."""
    if kind == "int":
        expr = None
        for name, tmin, tmax in INT_RANGES:
            cond = (lo > tmin) & (hi < tmax)
            expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
        return expr.otherwise(F.lit("bigint"))
    return F.when((lo > -FLOAT32_MAX) & (hi < FLOAT32_MAX), F.lit("float")).otherwise(F.lit("double"))


def downcast_plan(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """A4 report: ``(column, old_type, new_type, min_value, max_value, rows,
    old_bytes, new_bytes)`` from one min/max aggregate over every column.

    Boolean and decimal columns take the float branch as in the reference;
    string columns are left as they are.
    """
    fields = [f for f in df.schema.fields if f.name not in exclude
              and not isinstance(f.dataType, (T.StringType, T.BinaryType))
              and isinstance(f.dataType, (T.NumericType, T.BooleanType))]
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for f in fields:
        c = F.col(f.name).cast("double")
        # "+ 0.0" folds a negative zero into 0.0 so reports compare equal
        aggs += [(F.min(c) + 0.0).alias(f"{f.name}__min"), (F.max(c) + 0.0).alias(f"{f.name}__max")]
    stats = df.agg(*aggs)
    rows = []
    for f in fields:
        kind = "int" if isinstance(f.dataType, _INTEGRAL) else "float"
        lo, hi = F.col(f"{f.name}__min"), F.col(f"{f.name}__max")
        rows.append(F.struct(F.lit(f.name).alias("column"),
                             F.lit(f.dataType.simpleString()).alias("old_type"),
                             F.coalesce(_narrow_type_expr(kind, lo, hi),
                                        F.lit("bigint" if kind == "int" else "double")).alias("new_type"),
                             lo.alias("min_value"), hi.alias("max_value")))
    widths = F.create_map(*[x for k, v in _WIDTH.items() for x in (F.lit(k), F.lit(v))])
    out = (stats.select(F.col("__rows").alias("rows"), F.explode(F.array(*rows)).alias("r"))
           .select("r.*", "rows"))
    old_w = F.coalesce(widths[F.col("old_type")], F.lit(8))
    return out.withColumns({"old_bytes": F.col("rows") * old_w,
                            "new_bytes": F.col("rows") * widths[F.col("new_type")]})


def reduce_mem_usage(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """A4: cast every numeric column to the type chosen by ``downcast_plan``.

    The plan is a one-row-per-column table (bounded by the schema width), so
    collecting it to build the projection is safe.
    """
    plan = downcast_plan(df, exclude)
    chosen = {r["column"]: r["new_type"] for r in plan.select("column", "new_type").collect()}
    return df.withColumns({c: F.col(c).cast(t) for c, t in chosen.items()}), plan
