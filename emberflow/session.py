"""Session settings and shared-folder helpers."""

from __future__ import annotations

import gc
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants regardless of data size. Shuffle width is sized by
# the caller: ~cores locally, ~(input bytes / 128 MiB) on a cluster.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # no Python call-site capture on every Column call (plan building cost)
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "emberflow", extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and local runs."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "8g"))
    for k, v in {**_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster must name one on shared storage; where it is unset, only a local
    master (tests, single-machine runs) gets a folder of its own.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        current = tempfile.mkdtemp(prefix="emberflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder once; later reads start there."""
    ensure_checkpoint_dir(df.sparkSession)
    cut = df.checkpoint(eager=True)
    release_shuffles(df.sparkSession)
    return cut


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps.

    It does so once nothing refers to their plans, in Python and in the driver's
    JVM, and both have collected their garbage. A job of many steps would else
    hold the shuffles of all of them on disk.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
