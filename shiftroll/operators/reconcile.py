"""What the source has against what the dictionary promises, and what a run leaves behind.

The source's own list of columns (schema, table, column) says which promised
columns a company never had.  Only these may become NULL.  A column that is on
the list but not in a company's files was lost on the way and stops the run.
Columns without a target and rows without a loaded employee are not carried;
they are counted and reported.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftroll.functions.joins import lookup_join
from shiftroll.operators.carry import SOURCE_SCHEMA, Absent, CarriedTable
from shiftroll.operators.drift import IGNORED_COLUMNS
from shiftroll.operators.links import employee_lookup, link_column

# Reasons of the report.
NO_TARGET = "no_target_column"
NOT_LOADED = "employee_not_loaded"

REPORT_SCHEMA = "source_schema string, table_name string, column_name string, reason string, row_count long"


def expected_columns(spark: SparkSession, registry: Mapping[str, CarriedTable]) -> DataFrame:
    """Source columns that the carried tables need, one row each."""
    pairs = [(name, column) for name, table in registry.items() for column in table.sources]
    return spark.createDataFrame(pairs, "table_name string, column_name string")


def absent_columns(registry: Mapping[str, CarriedTable], listed: DataFrame) -> dict[str, dict[str, frozenset[str]]]:
    """For each table the promised columns that some schemas lack, with these schemas.

    ``listed`` is the source's list (table_schema, table_name, column_name).  A
    schema is asked only for tables it has.
    """
    names = listed.select("table_schema", "table_name", F.lower("column_name").alias("column_name"))
    tables = names.select("table_schema", "table_name").distinct()
    wanted = tables.join(F.broadcast(expected_columns(listed.sparkSession, registry)), "table_name")
    gaps = wanted.join(names, ["table_schema", "table_name", "column_name"], "left_anti")
    found: dict[str, dict[str, set[str]]] = {}
    # as many rows as there are gaps
    for row in gaps.collect():
        found.setdefault(row["table_name"], {}).setdefault(row["column_name"], set()).add(row["table_schema"])
    return {table: {c: frozenset(s) for c, s in columns.items()} for table, columns in found.items()}


def require_listed_gaps(table: CarriedTable, present: Mapping[str, Iterable[str]], absent: Absent) -> None:
    """Raise when a schema's files lack a column that is not listed as absent there."""
    for schema, columns in sorted(present.items()):
        have = {c.lower() for c in columns}
        for column in table.sources:
            gone = absent.get(column, frozenset())
            if column not in have and gone is not None and schema not in gone:
                raise ValueError(f"{table.spec.table}: {schema} lists column {column}, but its rows came without it")


def stray_columns(src: DataFrame, table: CarriedTable, own: Sequence[str] = ()) -> list[str]:
    """Source columns without a target; ``own`` are columns that the run added."""
    carried = {*table.sources, SOURCE_SCHEMA, *own, *IGNORED_COLUMNS}
    return sorted(c for c in src.columns if c.lower() not in carried)


def not_carried(
    src: DataFrame, table: CarriedTable, employees: DataFrame | None, scope: Sequence[str] = (), own: Sequence[str] = ()
) -> DataFrame:
    """What of ``src`` reaches no target: values without a column, rows without an employee.

    One scan of the stray columns and the employee number, whatever their
    count; one row for each company and cause, none where nothing is lost.
    """
    by = [*scope, SOURCE_SCHEMA]
    stray = stray_columns(src, table, (*scope, *own))
    marks = [F.col(c).isNotNull().alias(f"_c{i}") for i, c in enumerate(stray)]
    rows = src.select(*by, *marks)
    counted = {c: F.count_if(F.col(f"_c{i}")) for i, c in enumerate(stray)}
    if table.link and employees is not None:
        number = next(c for c in src.columns if c.lower() == table.link.source)
        rows = src.select(*by, *marks, link_column(src, number))
        known = F.lit(True).alias("_loaded")
        rows = lookup_join(rows, *employee_lookup(src, number, employees, [known], "left", scope))
        unlinked = F.count_if(F.col("_loaded").isNull())
    else:
        unlinked = F.lit(0).cast("long")
    totals = rows.groupBy(*by).agg(
        F.array(
            F.struct(F.lit(None).cast("string").alias("column_name"), F.lit(NOT_LOADED).alias("reason"), unlinked.alias("row_count")),
            *[F.struct(F.lit(c).alias("column_name"), F.lit(NO_TARGET).alias("reason"), n.alias("row_count")) for c, n in counted.items()],
        ).alias("causes")
    )
    return (
        totals.select(*by, F.lit(table.spec.table).alias("table_name"), F.inline("causes"))
        .filter(F.col("row_count") > 0)
    )
