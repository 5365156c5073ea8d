"""Linking rows of legacy tables to the loaded employees."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftroll.functions.joins import Lookup, lookup_join
from shiftroll.functions.scalars import legacy_number

LINK = "_empno"


def _link_type(table: DataFrame, number_column: str) -> T.DataType:
    found = table.schema[number_column].dataType
    return T.LongType() if isinstance(found, T.IntegralType) else T.StringType()


def link_column(table: DataFrame, number_column: str) -> Column:
    return F.col(number_column).cast(_link_type(table, number_column)).alias(LINK)


def employee_lookup(
    table: DataFrame,
    number_column: str,
    employees: DataFrame,
    columns: Sequence[str | Column] = (),
    how: str = "inner",
    scope: Sequence[str] = (),
) -> Lookup:
    """Lookup of loaded employees for rows that hold ``link_column``."""
    number = legacy_number("id", _link_type(table, number_column)).alias(LINK)
    people = employees.select(*scope, number, *columns).filter(F.col(LINK).isNotNull())
    return Lookup(people, [*scope, LINK], how)


def of_loaded_employees(
    table: DataFrame,
    employees: DataFrame,
    columns: Sequence[str | Column],
    scope: Sequence[str] = (),
    number_column: str = "employeeno",
) -> DataFrame:
    """Rows of loaded employees with their user id; rows of others drop out."""
    user = F.col("user_id").alias("employee_id")
    people = employee_lookup(table, number_column, employees, [user], "inner", scope)
    rows = table.select(*scope, link_column(table, number_column), *columns)
    return lookup_join(rows, *people).drop(LINK)
