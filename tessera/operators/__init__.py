"""DataFrame operators and pyspark.ml estimators, one module per area."""
