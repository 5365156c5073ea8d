"""Where source tables differ from what the dictionary promises."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values.
IGNORED_COLUMNS = ("_updated_on",)
MISSING_TABLE = "missing_table"
MISSING_COLUMN = "missing_column"
UNEXPECTED_COLUMN = "unexpected_column"


def columns_of(spark: SparkSession, sources: Mapping[str, DataFrame]) -> DataFrame:
    pairs = [(table, column) for table, df in sources.items() for column in df.columns]
    return spark.createDataFrame(pairs, "table_name string, column_name string")


def column_drift(expected: DataFrame, actual: DataFrame, ignore: Sequence[str] = IGNORED_COLUMNS) -> DataFrame:
    """Differences between two (table, column) lists, for the expected tables."""
    pair = ["table_name", "column_name"]
    wanted = expected.select(*pair).distinct().withColumn("_wanted", F.lit(True))
    found = actual.select(*pair).distinct().withColumn("_found", F.lit(True))
    tables = wanted.select("table_name").distinct()
    absent = tables.join(found.select("table_name").distinct(), "table_name", "left_anti")
    kind = F.when(F.col("_found").isNull(), F.lit(MISSING_COLUMN)).otherwise(F.lit(UNEXPECTED_COLUMN))
    columns = (
        wanted.join(found, pair, "full")
        .filter(F.col("_wanted").isNull() | F.col("_found").isNull())
        .join(tables, "table_name", "left_semi")
        .join(absent, "table_name", "left_anti")
        .filter(F.col("_wanted").isNotNull() | ~F.col("column_name").isin(*ignore))
        .select(*pair, kind.alias("kind"))
    )
    return columns.unionByName(
        absent.select(
            "table_name", F.lit(None).cast("string").alias("column_name"), F.lit(MISSING_TABLE).alias("kind")
        )
    )


def _filled(table: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Non-NULL rows of each column, from one scan of just these columns."""
    counts = df.agg(*[F.count(c).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "non_null_rows").withColumn("table_name", F.lit(table))


def schema_drift(
    expected: DataFrame, sources: Mapping[str, DataFrame], ignore: Sequence[str] = IGNORED_COLUMNS
) -> DataFrame:
    """Drift of real tables, with the rows that each unexpected column would lose."""
    spark = expected.sparkSession
    drift = column_drift(expected, columns_of(spark, sources), ignore)
    # names only: as many rows as there are stray columns
    stray: dict[str, list[str]] = {}
    for row in drift.filter(F.col("kind") == UNEXPECTED_COLUMN).select("table_name", "column_name").collect():
        stray.setdefault(row["table_name"], []).append(row["column_name"])
    if not stray:
        return drift.withColumn("non_null_rows", F.lit(None).cast("long"))
    filled = reduce(DataFrame.unionByName, [_filled(t, sources[t], sorted(c)) for t, c in sorted(stray.items())])
    return drift.join(F.broadcast(filled), ["table_name", "column_name"], "left").select(
        "table_name", "column_name", "kind", "non_null_rows"
    )
