"""A model fitted in batch scores a file stream with the same results."""

import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.plans import experiment as XP
from tessera.plans.queries import WIDE_CFG
from tessera.sources.fixtures import wide
from tessera.streaming import fit_preparation, score_stream


def test_stream_scores_match_batch(spark):
    w = wide(spark, SF_SMALL)
    fitted = fit_preparation(w, WIDE_CFG)
    model = XP.train_model("decision_tree", {"max_depth": 4}, fitted.features)
    batch = score_stream(w, fitted, model, "decision_tree")
    src = tempfile.mkdtemp(prefix="tessera-stream-src-", dir="/tmp")
    w.repartition(3).write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(w.schema).parquet(src)
    q = (score_stream(stream, fitted, model, "decision_tree").writeStream.format("memory")
         .queryName("scored_stream").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.table("scored_stream")
    assert got.count() == batch.count()
    diff = got.join(batch.withColumnRenamed("prediction", "p2").withColumnRenamed("score", "s2"), "row_id")
    assert diff.filter((F.col("prediction") != F.col("p2")) | (F.abs(F.col("score") - F.col("s2")) > 1e-12)).count() == 0
