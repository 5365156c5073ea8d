"""Session for local work, and the shared folder for intermediate tables."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterable, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_FOLDER_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = 8, partitions: int = 8, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("shiftroll")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it."""
    folder = spark.conf.get(_FOLDER_CONF, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_FOLDER_CONF} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="shiftroll-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/shiftroll-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession) -> str:
    """A fresh path in this application's part of the shared folder."""
    return f"{_scratch_root(spark)}/{uuid.uuid4().hex}"


def materialise(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Cuts the lineage, survives the loss of executors, and leaves columnar
    files, so that later readers fetch only the columns they use.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_tables(spark: SparkSession) -> set[str]:
    """Names of this application's intermediate tables."""
    root = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return {f.getPath().getName() for f in files.listStatus(root)} if files.exists(root) else set()


def drop_scratch(spark: SparkSession, names: Iterable[str]) -> None:
    """Remove some of the intermediate tables, which nothing reads any more."""
    for name in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{_scratch_root(spark)}/{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_shuffles(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files of plans that nobody refers to."""
    gc.collect()
    spark._jvm.System.gc()


def release(*tables: DataFrame) -> None:
    """Remove the intermediate tables that these frames read, and the shuffle files of plans that nobody refers to."""
    names = {part for t in tables for f in t.inputFiles() for part in Path(f).parts}
    spark = tables[0].sparkSession
    drop_scratch(spark, names & scratch_tables(spark))
    drop_shuffles(spark)


def clear_scratch(spark: SparkSession) -> None:
    """Remove this application's intermediate tables once outputs are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
