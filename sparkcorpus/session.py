"""Session defaults and the shared folder used for checkpoints and hand-over tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_BATCH, _BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


def local_session(cores: str = "8", app: str = "sparkcorpus", memory: str = "12g") -> SparkSession:
    """A session on this machine alone, for tests and the benchmark; its checkpoint folder is local where none is set.
    On a cluster the submitter configures the session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.files.maxPartitionBytes", "32m")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(os.path.join(tempfile.gettempdir(), "sparkcorpus-checkpoints"))
    return spark


def bound_batches(spark: SparkSession) -> None:
    """At most a thousand texts an Arrow batch in this session: batches are counted in rows, and texts can be long."""
    spark.conf.set(_BATCH, str(min(int(spark.conf.get(_BATCH)), _BATCH_ROWS)))


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: the cluster's `spark.checkpoint.dir`, else the one given to
    `setCheckpointDir`. Without either there is no folder that a lost executor could not take along."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError(
            "No shared folder: set spark.checkpoint.dir, or call sparkContext.setCheckpointDir, to a path that the "
            "driver and all executors can reach."
        )
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, never handed out twice."""
    return f"{shared_dir(spark).rstrip('/')}/sparkcorpus/{label}-{uuid.uuid4().hex}"


def _hadoop(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    files, jvm_path = _hadoop(spark, path)
    return files.exists(jvm_path)


def delete_path(spark: SparkSession, path: str) -> None:
    files, jvm_path = _hadoop(spark, path)
    files.delete(jvm_path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so that a lost executor costs no replay of an iterative plan."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
