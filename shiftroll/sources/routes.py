"""Routing map: which legacy schema pair feeds which tenant and payroll."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftroll.functions.joins import lookup_join
from shiftroll.functions.writes import insert_if_absent
from shiftroll.params import RunParams

DEFAULT_PAYROLL_NUMBER = 1
#: Company of the route that brought a row; routes run in its order.
ORIGIN = "origin"

ROUTE_SCHEMA = T.StructType(
    [
        T.StructField("legacy_company_schema", T.StringType(), False),
        T.StructField("legacy_payroll_schema", T.StringType(), False),
        T.StructField("tenant_slug", T.StringType(), False),
        T.StructField("target_payroll_id", T.IntegerType(), False),
        T.StructField("legacy_payroll_number", T.IntegerType(), False),
    ]
)


def migration_map(spark: SparkSession, rows: Iterable[tuple], existing: DataFrame | None = None) -> DataFrame:
    """Map rows (the payroll number may be left out); a company mapped before is skipped."""
    full = [row if len(row) == len(ROUTE_SCHEMA) else (*row, DEFAULT_PAYROLL_NUMBER) for row in rows]
    return seed_map(spark.createDataFrame(full, ROUTE_SCHEMA), existing)


def seed_map(rows: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return insert_if_absent(rows, existing, ["legacy_company_schema"])


def routes(map_df: DataFrame) -> DataFrame:
    """Map rows in run order, with the name of the tenant schema."""
    return map_df.withColumn("tenant", F.concat(F.lit("tenant_"), F.col("tenant_slug"))).orderBy(
        "legacy_company_schema"
    )


def attach_route(table: DataFrame, map_df: DataFrame, schema_col: str, side: str = "company") -> DataFrame:
    """Give the rows of all legacy schemas the values of their route.

    One job then serves every tenant.  Rows of unmapped schemas take no part.
    """
    key = f"legacy_{side}_schema"
    keyed = map_df.select(
        F.col(key).alias(schema_col),
        F.concat(F.lit("tenant_"), F.col("tenant_slug")).alias("tenant"),
        "target_payroll_id",
        F.col("legacy_payroll_number").alias("payroll_number"),
        F.col("legacy_company_schema").alias(ORIGIN),
    )
    return lookup_join(table, keyed, [schema_col])


def route_params(cutover: str, system_user_id: int) -> RunParams:
    """Parameters for rows that carry their route (see ``attach_route``)."""
    return RunParams(
        cutover=cutover,
        system_user_id=system_user_id,
        row_values=("tenant", "target_payroll_id", "payroll_number"),
        scope=("tenant",),
    )
