"""tessera: Spark-native tabular classification analytics.

Every step is a DataFrame operator or a ``pyspark.ml`` Estimator/Transformer
whose work runs on executors. The driver only ever holds model-sized state:
vocabularies, one-row statistics, k x k tables and fitted models.
"""

__version__ = "0.1.0"
