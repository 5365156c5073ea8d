"""Employee import file with fixed amount slots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftroll.functions.joins import lookup_join
from shiftroll.functions.scalars import blank_to_null, email_or_synthetic, iso_date, to_minor_or_zero
from shiftroll.sources.tables import write_csv

# Amount code of each slot column.
SLOTS = {
    "salary_minor": "BASIC",
    "allowance_travel_minor": "TRAVEL",
    "allowance_housing_minor": "HOUSING",
    "allowance_cell_minor": "CELL",
    "deduction_retirement_minor": "RA",
    "deduction_medical_minor": "MEDICAL",
}
DEFAULT_CURRENCY = "ZA"


def _slot_amounts(amounts: DataFrame, settings: DataFrame) -> DataFrame:
    """One row per employee with the amount of each slot; repeats add up."""
    codes = settings.filter(F.col("description").isin(*SLOTS.values())).select("ordinalno", "description")
    coded = lookup_join(amounts.select("employeeno", "ordinalno", "amount_q"), codes, ["ordinalno"])
    return coded.groupBy("employeeno").agg(
        *[F.sum(F.when(F.col("description") == code, F.col("amount_q"))).alias(slot) for slot, code in SLOTS.items()]
    )


def _numbered_rows(employees: DataFrame, amounts: DataFrame, settings: DataFrame) -> DataFrame:
    currency = F.upper(F.coalesce(blank_to_null("taxcountrycode_f14"), F.lit(DEFAULT_CURRENCY)))
    slots = {name: to_minor_or_zero(name).alias(name) for name in SLOTS}
    return employees.join(_slot_amounts(amounts, settings), "employeeno", "left").select(
        "employeeno",
        F.col("employeeid_f01").alias("employee_code"),
        F.col("givennames_f21").alias("first_name"),
        F.col("surname_f02").alias("last_name"),
        email_or_synthetic("emailaddress_f40", "employeeid_f01").alias("email"),
        iso_date("engagedate_d931").alias("hired_at"),
        F.col("identity_f12").alias("id_number"),
        slots.pop("salary_minor"),
        currency.alias("currency"),
        *slots.values(),
    )


def export_import_rows(employees: DataFrame, amounts: DataFrame, settings: DataFrame) -> DataFrame:
    return _numbered_rows(employees, amounts, settings).drop("employeeno")


def export_import_csv(employees: DataFrame, amounts: DataFrame, settings: DataFrame, path: str) -> None:
    """The rows as CSV with a header, in the order of the employee number."""
    write_csv(_numbered_rows(employees, amounts, settings), path, sort=["employeeno"], drop=["employeeno"])
