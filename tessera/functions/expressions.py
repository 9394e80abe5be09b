"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH_DIGITS = 7          # hex digits of md5 kept: 28 bits
HASH_SPACE = 16 ** HASH_DIGITS


def rnd(c: Column | str, digits: int | None) -> Column:
    """Round half up as ``floor(x * 10^d + 0.5) / 10^d``.

    A single IEEE multiply, floor and divide give the same bits in every
    engine, unlike ``round``, which Spark applies to the shortest decimal
    string and other engines apply to the scaled double.
    """
    c = F.col(c) if isinstance(c, str) else c
    if digits is None:
        return c
    scale = float(10 ** digits)
    return (F.floor(c.cast("double") * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale))


def safe_div(num: Column, den: Column) -> Column:
    """Ratio with 0/0 (or x/0) giving 0, as the reference's ``zero_division=0``."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def hash_key(cols: Sequence[str] | str, seed: int = 42, purpose: str = "") -> Column:
    """Deterministic 28-bit hash of the key columns, a seed and a purpose.

    Uses that must not depend on each other (split, folds, samples) name
    different purposes: their hashes are independent under one seed.

    Computed from the row's own values, so a recomputed partition (lost
    executor, AQE re-plan) gets the same value; uniform, so ranges of it
    make balanced buckets.
    """
    if isinstance(cols, str):
        cols = [cols]
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in cols], F.lit(f"{seed}|{purpose}" if purpose else str(seed)))
    return F.conv(F.substring(F.md5(text), 1, HASH_DIGITS), 16, 10).cast("long")


def nan_string(c: Column | str) -> Column:
    """String form with missing shown as ``nan`` (pandas ``astype(str)``)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit("nan"))


def signed_log1p(c: Column) -> Column:
    return F.signum(c) * F.log1p(F.abs(c))


def cut(c: Column, edges: Sequence[float], labels: Sequence[str], right: bool = True,
        outside: str | None = "nan") -> Column:
    """Bin a numeric column into labelled intervals (pandas ``cut`` semantics).

    ``right=True`` gives (a, b] intervals; the first edge is excluded, values
    outside all intervals (and missing) get ``outside``.
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (c > lo) & (c <= hi) if right else (c >= lo) & (c < hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(outside))


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns by schema (pandas ``select_dtypes(np.number)``)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, _NUMERIC) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """String columns by schema (pandas ``select_dtypes('object')``)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]
