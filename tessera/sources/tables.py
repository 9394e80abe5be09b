"""Table sources (S1): Parquet test tables and the CSV loader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan; projections and filters above it reach the reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)


def sanitize_names(df: DataFrame) -> DataFrame:
    """Dotted CSV headers (``education.num``) become ``education_num``."""
    return df.toDF(*[c.strip().replace(".", "_").replace(" ", "_") for c in df.columns])


# Fixed values that must equal the reference's CSV reader: cells that are missing.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
           "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def load_csv(spark: SparkSession, path: str, schema=None, missing=MISSING) -> DataFrame:
    """S1 ``load_data``: CSV with a header; whole cells in ``missing`` are NULL.

    ``schema`` (a DDL string or StructType) names the column types and saves the
    inference pass. Without it one aggregate counts, per column, the present
    cells and those that read as integers and numbers: a column of integers
    without gaps is bigint, of numbers double, any other string. The ``?``
    sentinel stays text; ``clean.replace_sentinel`` (F1) turns it into NULL.
    """
    raw = sanitize_names(spark.read.option("header", True).option("ignoreLeadingWhiteSpace", False)
                         .option("ignoreTrailingWhiteSpace", False).csv(path))
    df = raw.withColumns({c: F.when(~F.col(c).isin(list(missing)), F.col(c)) for c in raw.columns})
    if schema is not None:
        types = [f.dataType for f in (T._parse_datatype_string(schema) if isinstance(schema, str) else schema).fields]
    else:
        found = df.agg(F.count(F.lit(1)).alias("rows"), *[a for i, c in enumerate(df.columns) for a in (
            F.count(c).alias(f"n{i}"), F.count(F.col(c).try_cast("double")).alias(f"d{i}"), F.count(F.col(c).try_cast("bigint")).alias(f"i{i}"))]).first()
        types = ["bigint" if found[f"i{i}"] == found["rows"] and found["rows"] else "double" if found[f"d{i}"] == found[f"n{i}"] and found[f"n{i}"] else "string"
                 for i in range(len(df.columns))]
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in zip(df.columns, types)])


def shape(df: DataFrame) -> DataFrame:
    """One-row (rows, columns) shape report, computed on executors."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))
