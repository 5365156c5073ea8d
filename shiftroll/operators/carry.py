"""Carry a legacy table over 1:1: rename, scope, link, fill and skip repeats.

What is carried follows from the dictionary, a table of the source's own
columns that comes with every migration.  ``registry_of`` makes of it, for each
table in scope, the pairs of source and target column with their types and
their parts in the carry.  No column is matched by likeness of names: a column
that the dictionary promises is in the source, or it is listed as absent there,
or the run stops.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftroll.functions.joins import lookup_join
from shiftroll.functions.writes import insert_in_route_order
from shiftroll.operators.carried_tables import AUTO_KEY, CARRIED, NOT_CARRIED, CarrySpec
from shiftroll.operators.links import LINK, employee_lookup, link_column
from shiftroll.operators.naming import EMPLOYEE_LINK_NAME, target_names
from shiftroll.params import RunParams

AUTO_KEY_TYPE = "AUTO_KEY"
PAYROLL = "payroll"
#: Parts that a column can have in the carry.
PLAIN, LINKED, AUTO, GAINED = "plain", "link", "auto_key", "gained"
#: Legacy schema of a row, where one table holds the rows of several companies.
SOURCE_SCHEMA = "source_schema"

# Dictionary types, and a column whose dictionary type is wrong.
DICTIONARY_TYPES: dict[str, T.DataType] = {
    "BOOLEAN": T.BooleanType(),
    "TINYINT": T.ShortType(),
    "SMALLINT": T.ShortType(),
    "INTEGER": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "MONEY": T.DecimalType(19, 4),
    "ACCURATE": T.DecimalType(19, 10),
    "GUESS": T.DecimalType(9, 3),
    "TEXT": T.StringType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(),
    "TIMESTAMP_NOZ": T.TimestampNTZType(),
    "TIMESTAMP_TZ": T.TimestampType(),
    AUTO_KEY_TYPE: T.LongType(),
}
TYPE_OVERRIDES = {"pay_run_tax_audit.reportsection": "TEXT"}
# Schema types that are carried, and the source they stand for.
SCHEMA_TYPES = {"COMPANY": "company", "PAYROLL": "payroll"}

DICTIONARY_SCHEMA = (
    "table_name string, schema_type string, copy_data boolean, position int, "
    "column_name string, type string, key_pos int"
)

#: Source columns that are absent: everywhere (None), or in some legacy schemas.
Absent = Mapping[str, frozenset[str] | None]


class DictionaryColumn(NamedTuple):
    """One column as the dictionary describes it; ``key_pos`` 0 is no key."""

    name: str
    type: str
    key_pos: int = 0


class CarriedColumn(NamedTuple):
    """A target column and the source column that feeds it (none for a gained payroll)."""

    source: str | None
    target: str
    type: T.DataType
    part: str = PLAIN


@dataclass(frozen=True)
class CarriedTable:
    spec: CarrySpec
    columns: tuple[CarriedColumn, ...]

    @property
    def target(self) -> T.StructType:
        return T.StructType([T.StructField(c.target, c.type) for c in self.columns])

    @property
    def sources(self) -> list[str]:
        return [c.source for c in self.columns if c.source]

    @property
    def link(self) -> CarriedColumn | None:
        return next((c for c in self.columns if c.part == LINKED), None)


def plan_from_dictionary(
    table: str, source: str, columns: Iterable[DictionaryColumn], module: str = "core"
) -> CarriedTable:
    """Columns, types and key of a table that the dictionary describes."""
    columns = list(columns)
    auto = next((c.name for c in columns if c.type == AUTO_KEY_TYPE), None)
    names = target_names([c.name for c in columns], auto)
    carried, keys = [], []
    if source == "payroll" and PAYROLL not in names:
        carried.append(CarriedColumn(None, PAYROLL, T.IntegerType(), GAINED))
        keys.append(PAYROLL)
    for column, name in zip(columns, names, strict=True):
        type_name = TYPE_OVERRIDES.get(f"{table}.{column.name.lower()}", column.type)
        linked = name == EMPLOYEE_LINK_NAME
        part = LINKED if linked else AUTO if column.type == AUTO_KEY_TYPE else PLAIN
        data_type = T.LongType() if linked else DICTIONARY_TYPES[type_name]
        carried.append(CarriedColumn(column.name.lower(), name, data_type, part))
        if column.key_pos > 0:
            keys.append(name)
    spec = CarrySpec(table, source, module, AUTO_KEY if auto else tuple(keys))
    return CarriedTable(spec, tuple(carried))


def in_scope(dictionary: DataFrame) -> DataFrame:
    """Rows of tables that are copied and belong to a company or a payroll."""
    return dictionary.filter(F.col("copy_data") & F.col("schema_type").isin(*SCHEMA_TYPES))


def registry_of(dictionary: DataFrame) -> dict[str, CarriedTable]:
    """The carried tables of a dictionary (``DICTIONARY_SCHEMA``), by name.

    Tables with operators of their own stay out.  A table whose key differs from
    the one its target is known to have is an error.
    """
    columns: dict[str, list] = {}
    # as many rows as the source has columns
    for row in in_scope(dictionary).orderBy("table_name", "position").collect():
        columns.setdefault(row["table_name"], []).append(row)
    found = {}
    for table, rows in columns.items():
        if table in NOT_CARRIED:
            continue
        known = CARRIED.get(table)
        described = [DictionaryColumn(r["column_name"], r["type"], r["key_pos"] or 0) for r in rows]
        source = SCHEMA_TYPES[rows[0]["schema_type"]]
        plan = plan_from_dictionary(table, source, described, known.module if known else "core")
        if known and (set(plan.spec.keys), source) != (set(known.keys), known.source):
            raise ValueError(f"{table}: key {plan.spec.keys} of the {source}, known is {known.keys} of the {known.source}")
        found[table] = CarriedTable(known, plan.columns) if known else plan
    return found


def require_known_columns(table: CarriedTable, existing: DataFrame | None, scope: Sequence[str] = ()) -> None:
    """Raise when the target has columns that nothing would fill."""
    unknown = [] if existing is None else [c for c in existing.columns if c not in (*scope, *table.target.names)]
    if unknown:
        raise ValueError(f"{table.spec.table}: no source for the target columns {', '.join(sorted(unknown))}")


def _source_column(src: DataFrame, name: str) -> str | None:
    return next((c for c in src.columns if c.lower() == name), None)


def fill_missing(
    src: DataFrame, table: CarriedTable, p: RunParams, absent: Absent | None = None, origin: Sequence[str] = ()
) -> DataFrame:
    """The source in the columns and types of the target.

    A column listed as absent is NULL, an absent payroll is the run's; a column
    that is missing without being listed is an error.  Companies may differ:
    where only some lack a column, the rows of the others keep theirs.  The
    employee link stays out: it needs the loaded employees.
    """
    absent = absent or {}
    columns = []
    for column in table.columns:
        if column.part == LINKED:
            continue
        found = _source_column(src, column.source) if column.source else None
        if found is None and column.source and column.source not in absent:
            raise ValueError(f"{table.spec.table}: column {column.source} is missing and not listed as absent")
        value = F.lit(None) if found is None else F.col(found)
        if column.target == PAYROLL:
            lacking = absent.get(PAYROLL, frozenset())
            if found is None:
                value = p.col("payroll_number")
            elif lacking:
                value = F.when(F.col(SOURCE_SCHEMA).isin(*sorted(lacking)), p.col("payroll_number")).otherwise(value)
        columns.append(value.cast(column.type).alias(column.target))
    link = []
    if table.link:
        number = _source_column(src, table.link.source)
        if number is None:
            raise ValueError(f"{table.spec.table}: the employee number {table.link.source} is missing")
        link = [link_column(src, number)]
    return src.select(*p.scope, *origin, *columns, *link)


def carry_table(
    src: DataFrame,
    table: CarriedTable,
    employees: DataFrame | None,
    existing: DataFrame | None,
    p: RunParams,
    absent: Absent | None = None,
    origin: Sequence[str] = (),
) -> DataFrame:
    """Rows to insert into the carried table; of equal keys the first ``origin`` wins, then the smallest row."""
    rows = fill_missing(src, table, p, absent, origin)
    if LINK in rows.columns:
        if employees is None:
            raise ValueError(f"{table.spec.table} is linked to employees")
        user = F.col("user_id").alias(EMPLOYEE_LINK_NAME)
        number = _source_column(src, table.link.source)
        rows = lookup_join(rows, *employee_lookup(src, number, employees, [user], "inner", p.scope))
    rows = rows.select(*p.scope, *origin, *table.target.names)
    if not table.spec.keys:
        return rows.drop(*origin)
    # an id is unique in the whole target table of a tenant, payroll or not
    return insert_in_route_order(rows, existing, [*p.scope, *table.spec.keys], origin)


def unlinked_rows(src: DataFrame, table: CarriedTable, employees: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """How many rows of a linked table belong to no loaded employee."""
    number = _source_column(src, table.link.source)
    people = employee_lookup(src, number, employees, [], "left_anti", scope)
    left = lookup_join(src.select(*scope, link_column(src, number)), *people)
    return left.groupBy(*scope).agg(F.count(F.lit(1)).alias("unlinked_rows"))
