"""Reading legacy tables and writing target and report tables."""

from __future__ import annotations

from collections.abc import Sequence
from threading import Lock
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftroll.operators.carry import DICTIONARY_SCHEMA

# the setting is the session's; several tables may be read at a time
_INFERENCE = Lock()

COLUMN_LIST_SCHEMA = T.StructType(
    [
        T.StructField("table_schema", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
    ]
)


def read_source(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A legacy table with the columns it has at run time.

    ``root`` is a database, or a folder with ``<table>/source_schema=<schema>``
    for each company.  Companies may differ in columns: a row has NULL in those
    its company lacks.  Types that differ are an error.  A schema named 007 is
    a name.
    """
    if "/" not in root:
        return spark.table(f"{root}.{table}")
    folder, inference = f"{root.rstrip('/')}/{table}", "spark.sql.sources.partitionColumnTypeInference.enabled"
    with _INFERENCE:
        known = spark.conf.get(inference)
        spark.conf.set(inference, "false")
        try:
            return spark.read.option("basePath", folder).option("mergeSchema", "true").parquet(folder)
        finally:
            spark.conf.set(inference, known)


def columns_by_schema(spark: SparkSession, root: str, table: str, column: str = "source_schema") -> dict[str, list[str]]:
    """The columns in the files of each legacy schema, from one footer a schema."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{table}")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    for child in files.listStatus(folder):
        name = child.getPath().getName()
        if name.startswith(f"{column}="):
            schema = unquote(name.removeprefix(f"{column}="))
            found[schema] = spark.read.parquet(child.getPath().toString()).columns
    return found


def read_driver_table(spark: SparkSession, folder: str, table: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{folder.rstrip('/')}/{table}.parquet")


def read_any(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table of a folder with the schema its files have."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table has been written.  A write without rows leaves just a marker file."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(target):
        return False
    return any(not child.getPath().getName().startswith(("_", ".")) for child in files.listStatus(target))


def append(df: DataFrame, path: str, partition_by: Sequence[str] = (), clustered: bool = False) -> None:
    """Append to a table.

    Rows of one partition are brought together first, so that not every task
    writes a file for every partition.  Rebalancing, unlike a repartition,
    splits large partitions over several tasks.  ``clustered`` rows come in
    the order of the partition and need none of this.
    """
    if partition_by and not clustered:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Write ``df`` in place of the partitions it has rows for; it must not read them."""
    writer = df.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def append_report(df: DataFrame, path: str) -> None:
    """Report tables come into being with the first append and are kept per tenant."""
    append(df, path, ["tenant"])


def write_csv(df: DataFrame, path: str, sort: Sequence[str] = (), drop: Sequence[str] = ()) -> None:
    """CSV parts with a header line; NULL is an empty field."""
    ordered = df.orderBy(*sort) if sort else df
    ordered.drop(*drop).write.mode("overwrite").option("header", True).csv(path)


def write_columns_csv(columns: DataFrame, path: str) -> None:
    """A list of columns (table_schema, table_name, column_name) without a header."""
    columns.select(*COLUMN_LIST_SCHEMA.names).write.mode("overwrite").csv(path)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """The dictionary of the source, one line a column, with a header."""
    return spark.read.schema(DICTIONARY_SCHEMA).option("header", True).csv(path)


def read_columns_csv(spark: SparkSession, path: str) -> DataFrame:
    """List of the columns a source really has: schema, table, column, no header."""
    return spark.read.schema(COLUMN_LIST_SCHEMA).csv(path).filter(F.col("column_name").isNotNull())


def write_drift(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
