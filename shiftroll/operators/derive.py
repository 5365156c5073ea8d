"""Bank details, tax status and payroll periods, derived from legacy tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftroll.functions.joins import lookup_join
from shiftroll.functions.keys import Base, dense_ids
from shiftroll.functions.scalars import (
    blank_to_null,
    clamp,
    first_chars,
    flag,
    iso_date,
    month_start,
    null_of,
    upper_or_null,
)
from shiftroll.functions.writes import insert_not_exists
from shiftroll.operators.links import of_loaded_employees
from shiftroll.params import RunParams

# Fixed values.
UNKNOWN_ACCOUNT_TYPE = "unknown"
DEFAULT_ACCOUNT_CURRENCY = "ZAR"
HOME_COUNTRIES = ("ZA", "ZAF")
MAX_DEPENDANTS = 50
NO_DISABILITY = 0
AGE_BAND = "derived"
PERIOD_CLOSED = "closed"
PERIOD_OPEN = "open"
PERIOD_KIND = "regular"

# order of rows that share employee and ordinal
# a total order, so that the ids of a repeated run are the same
_ACCOUNT_ORDER = [
    "employee_id", "ordinal_no", "account_number", "account_type", "account_name", "bank_sort_code", "currency", "pay_mode",
    "source_bank_account", "split_pay_code", "account_holder_status", "sars_bank_account", "iban",
]


def import_bank_details(
    accounts: DataFrame,
    employees: DataFrame,
    existing: DataFrame | None,
    base: Base,
    p: RunParams,
    origin: Sequence[str] = (),
) -> DataFrame:
    """Payment accounts of loaded employees, several per employee by ordinal."""
    text = {"account_name": "accountname_g2", "account_number": "accountnumber_g3", "bank_sort_code": "branchcode_g4"}
    rows = of_loaded_employees(
        accounts,
        employees,
        [
            F.col("ordinalno").alias("ordinal_no"),
            F.coalesce(blank_to_null("accounttype_g1"), F.lit(UNKNOWN_ACCOUNT_TYPE)).alias("account_type"),
            *[F.coalesce(F.col(source), F.lit("")).alias(target) for target, source in text.items()],
            first_chars(
                F.coalesce(upper_or_null("accountcurrency_g10"), F.lit(DEFAULT_ACCOUNT_CURRENCY)), 3
            ).alias("currency"),
            F.col("paymode_g0").alias("pay_mode"),
            F.col("sourcebankaccount_g5").alias("source_bank_account"),
            F.col("splitpaycode_g6").alias("split_pay_code"),
            F.col("accountholderstatus_g7").alias("account_holder_status"),
            flag("sarsbankaccount_g8").alias("sars_bank_account"),
            F.col("accountiban_g9").alias("iban"),
            *origin,
        ],
        p.scope,
    )
    added = insert_not_exists(rows, existing, [*p.scope, "employee_id", "ordinal_no"], origin)
    return dense_ids(added, _ACCOUNT_ORDER, base, "id", p.scope).select(
        *p.scope,
        "id",
        "employee_id",
        "ordinal_no",
        "account_type",
        "account_name",
        "account_number",
        "bank_sort_code",
        null_of("string").alias("swift_code"),
        "currency",
        "pay_mode",
        "source_bank_account",
        "split_pay_code",
        "account_holder_status",
        "sars_bank_account",
        "iban",
        p.col("cutover").alias("effective_from"),
        p.col("cutover").alias("recorded_at"),
        p.col("system_user_id").alias("created_by_user_id"),
    )


def build_tax_status(
    source: DataFrame, employees: DataFrame, existing: DataFrame | None, p: RunParams, origin: Sequence[str] = ()
) -> DataFrame:
    """Residence, dependants and the fixed parts of the tax status."""
    country = F.coalesce(upper_or_null("taxcountrycode_f14"), F.lit(HOME_COUNTRIES[-1]))
    dependants = F.coalesce(F.col("taxdependants_f08"), F.lit(0))
    rows = of_loaded_employees(
        source,
        employees,
        [
            F.when(country.isin(*HOME_COUNTRIES), F.lit(1)).otherwise(F.lit(0)).alias("resident"),
            clamp(dependants, 0, MAX_DEPENDANTS).alias("dependent_count"),
            F.lit(NO_DISABILITY).alias("disability"),
            F.lit(AGE_BAND).alias("age_band"),
            iso_date("engagedate_d931").alias("effective_from"),
            *origin,
        ],
        p.scope,
    )
    added = insert_not_exists(rows, existing, [*p.scope, "employee_id"], origin)
    return added.select(
        *p.scope,
        "employee_id",
        "resident",
        "dependent_count",
        "disability",
        "age_band",
        "effective_from",
        p.col("cutover").alias("recorded_at"),
        p.col("system_user_id").alias("created_by_user_id"),
    )


def _in_country(dated: DataFrame, payrolls: DataFrame, p: RunParams) -> DataFrame:
    """Periods of existing payrolls with the country of the payroll."""
    if "target_payroll_id" in p.row_values:
        known = payrolls.select(*p.scope, F.col("id").alias("payroll_id"), "country_code")
        return lookup_join(dated, known, [*p.scope, "payroll_id"])
    # a run for one payroll: a single row, known by its key
    payroll = payrolls.filter(F.col("id") == p.target_payroll_id).select("country_code").first()
    country = F.lit(payroll["country_code"] if payroll else None).cast("string")
    return dated.withColumn("country_code", country).filter(F.lit(payroll is not None))


def build_periods(calendar: DataFrame, payrolls: DataFrame, existing: DataFrame | None, p: RunParams) -> DataFrame:
    """Payroll periods from the carried calendar; months before the cutover are closed."""
    cutover_month = month_start(F.to_date(p.col("cutover")))
    status = F.when(F.col("run_date") < cutover_month, F.lit(PERIOD_CLOSED)).otherwise(F.lit(PERIOD_OPEN))
    dated = calendar.filter((F.col("payroll") == p.col("payroll_number")) & F.col("run_date").isNotNull()).select(
        *p.scope,
        p.col("target_payroll_id").alias("payroll_id"),
        iso_date(month_start("run_date")).alias("period_start"),
        iso_date("run_date").alias("period_end"),
        iso_date("run_date").alias("payday"),
        status.alias("status"),
    )
    placed = _in_country(dated, payrolls, p)
    added = insert_not_exists(placed, existing, [*p.scope, "payroll_id", "period_end"])
    return added.select(
        *p.scope,
        "payroll_id",
        "period_start",
        "period_end",
        "payday",
        "country_code",
        "status",
        p.col("cutover").alias("created_at"),
        F.lit(PERIOD_KIND).alias("period_kind"),
    )
