"""Values addressed by employee and ordinal: text, dates, precise numbers, third parties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftroll.functions.scalars import flag, iso_date, to_minor_or_zero
from shiftroll.functions.writes import insert_in_route_order
from shiftroll.operators.links import of_loaded_employees

# Source column of each catalogue column.
SLOT_SETTINGS = {
    "alpha": {"name": "alphaname"},
    "dates": {"name": "description"},
    "precision": {"name": "description", "code_type": "codetype", "limit_value": "codelimit"},
}


def import_slot_settings(
    kind: str,
    settings: DataFrame,
    existing: DataFrame | None,
    scope: Sequence[str] = (),
    origin: Sequence[str] = (),
) -> DataFrame:
    """Catalogue of the slots of one kind; an ordinal already there is skipped, the first ``origin`` wins."""
    columns = [F.col(source).alias(target) for target, source in SLOT_SETTINGS[kind].items()]
    rows = settings.select(*scope, *origin, F.col("ordinalno").alias("ordinal_no"), *columns)
    return insert_in_route_order(rows, existing, [*scope, "ordinal_no"], origin)


def _import_slots(
    table: DataFrame,
    employees: DataFrame,
    values: Sequence[Column],
    existing: DataFrame | None,
    scope: Sequence[str],
    origin: Sequence[str],
) -> DataFrame:
    rows = of_loaded_employees(table, employees, [F.col("ordinalno").alias("ordinal_no"), *values, *origin], scope)
    keys = [*scope, "employee_id", "ordinal_no"]
    ordered = rows.select(*keys, *[c for c in rows.columns if c not in keys])
    return insert_in_route_order(ordered, existing, keys, origin)


def import_alpha(
    alpha: DataFrame,
    employees: DataFrame,
    existing: DataFrame | None = None,
    scope: Sequence[str] = (),
    origin: Sequence[str] = (),
) -> DataFrame:
    return _import_slots(alpha, employees, [F.col("reference_v").alias("value")], existing, scope, origin)


def import_dates(
    dates: DataFrame,
    employees: DataFrame,
    existing: DataFrame | None = None,
    scope: Sequence[str] = (),
    origin: Sequence[str] = (),
) -> DataFrame:
    return _import_slots(dates, employees, [iso_date("date_d0").alias("value")], existing, scope, origin)


def import_precision(
    values: DataFrame,
    employees: DataFrame,
    existing: DataFrame | None = None,
    scope: Sequence[str] = (),
    origin: Sequence[str] = (),
) -> DataFrame:
    """Ten-decimal values go over unchanged."""
    return _import_slots(values, employees, [F.col("amount_m").alias("value")], existing, scope, origin)


def import_thirdparty(
    payments: DataFrame,
    employees: DataFrame,
    existing: DataFrame | None = None,
    scope: Sequence[str] = (),
    origin: Sequence[str] = (),
) -> DataFrame:
    columns = [
        F.col("agentkey").alias("agent_key"),
        to_minor_or_zero("agenthandlingfee").alias("agent_handling_fee_minor"),
        F.col("agenthandlingfeetype").alias("agent_handling_fee_type"),
        to_minor_or_zero("employerhandlingfee").alias("employer_handling_fee_minor"),
        F.col("employerhandlingfeetype").alias("employer_handling_fee_type"),
        to_minor_or_zero("monthlydeductionamount").alias("monthly_deduction_amount_minor"),
        flag("stopindicator").alias("stop_indicator"),
        iso_date("thirdpartydate").alias("third_party_date"),
        F.col("thirdpartyreference").alias("third_party_reference"),
    ]
    return _import_slots(payments, employees, columns, existing, scope, origin)
