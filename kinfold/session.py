"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = 8, app: str = "kinfold", memory: str = "16g") -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can read, taken from the session.

    Only a local master may fall back to a folder of this machine; on a cluster
    an unset `spark.checkpoint.dir` is an error, because executors could neither
    read nor re-read what another machine wrote.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="kinfold-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/kinfold/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write `df` to the shared folder and return a scan of it.

    This ends the lineage: a lost executor re-reads the table instead of
    replaying everything before it.
    """
    return read_stage(df, write_stage(df, label))


def write_stage(df: DataFrame, label: str) -> str:
    """Write `df` below the shared folder and free the shuffle files of the write.

    Nothing reads them again, since readers scan the table.  Left to the driver's garbage collection they would
    stay for several stages, as long as its heap has room.
    """
    conf, path = df.sparkSession.conf, scratch_path(df.sparkSession, label)
    before = conf.get(FREE_SHUFFLES, None)
    conf.set(FREE_SHUFFLES, "true")
    try:
        # Zstandard: uids are hexadecimal texts, which snappy leaves at their length.
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            conf.unset(FREE_SHUFFLES)
        else:
            conf.set(FREE_SHUFFLES, before)
    return path


def read_stage(df: DataFrame, path: str) -> DataFrame:
    """Scan a stage table with the schema of the frame that wrote it."""
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stage(spark: SparkSession, path: str) -> None:
    """Remove a stage table that no frame in use reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
