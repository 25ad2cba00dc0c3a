"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The reliable checkpoint folder, taken from the session.

    Only a local-mode session without one gets a temporary folder: on a cluster a
    machine-local path would be lost with its machine, so that is refused.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="spark-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage is cut, columns can be pruned, and
    the rows outlive any executor."""
    path = f"{shared_folder(df.sparkSession)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this session has written to the shared folder: settled tables, levels, indexes, stream state.

    The session's checkpoint folder is its own, so other sessions lose nothing. DataFrames that still read
    from it cannot be used afterwards; call it when results are stored.
    """
    folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        return
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for entry in files.listStatus(path):
        files.delete(entry.getPath(), True)
