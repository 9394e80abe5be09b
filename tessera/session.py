"""Session helpers.

Nothing here overrides a setting the cluster already made: every option is
applied only when the session has no value for it.
"""

from __future__ import annotations

import os
import shlex
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

# Defaults for a session this library creates itself (tests, bench). On a
# cluster the session comes from the platform and keeps its own values.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.driver.memory": "16g",
}


def _given() -> set[str]:
    """Settings that the platform names before the JVM starts: submit arguments and the defaults file."""
    words = shlex.split(os.environ.get("PYSPARK_SUBMIT_ARGS", ""))
    found = {b.split("=", 1)[0] for a, b in zip(words, words[1:]) if a in ("--conf", "-c")}
    found |= {"spark.driver.memory"} & ({"spark.driver.memory"} if "--driver-memory" in words else set())
    home = os.environ.get("SPARK_CONF_DIR") or os.path.join(os.environ.get("SPARK_HOME", ""), "conf")
    path = os.path.join(home, "spark-defaults.conf")
    if os.path.isfile(path):
        with open(path) as f:
            found |= {line.split()[0].split("=")[0] for line in f if line.strip() and not line.startswith("#")}
    return found


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tessera") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    own = dict(_DEFAULTS)
    if shuffle_partitions:
        own["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if SparkContext._active_spark_context is None:  # a running session keeps all its values
        for k in own.keys() - _given():
            builder = builder.config(k, own[k])
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is.
    Only when it is unset on a local master (tests) a scratch folder is created:
    on a cluster the driver's own disk would be out of the executors' reach.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not configured:
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df):
    """Reliable checkpoint (written to the shared checkpoint folder).

    Used inside iterative loops (boosting rounds, label propagation) so a
    lost executor recomputes from the written checkpoint, not from the start.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The table written as Parquet to the shared folder and read back.

    It cuts the lineage like a checkpoint, and readers prune columns and know
    the size. The folder belongs to the session's checkpoint folder, which the
    platform (or ``drop_stored``) clears.
    """
    folder = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def drop_stored(spark: SparkSession) -> int:
    """Delete the tables that ``stored`` wrote in this session, once nothing reads them any more."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark).rstrip("/") + "/table-*")
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    found = fs.globStatus(path) or []
    return sum(bool(fs.delete(f.getPath(), True)) for f in found)
