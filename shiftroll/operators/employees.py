"""Legacy employee rows to users, employees, contracts, assignments and status."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftroll.functions.joins import lookup_join
from shiftroll.functions.keys import Base, dense_ids, on_top_of
from shiftroll.functions.scalars import (
    blank_to_null,
    email_or_synthetic,
    employee_ref,
    first_chars,
    iso_date,
    null_of,
    upper_or_null,
)
from shiftroll.functions.writes import insert_if_absent
from shiftroll.params import RunParams

# Fixed values.
UNSPECIFIED = "unspecified"
GENDERS = {"M": "male", "F": "female"}
CURRENCY_SLOT = 1
UNUSABLE_PASSWORD = "!migrated-no-login"
RATE_TYPE = "monthly"
RATE_MINOR = 0
HOURS_PER_WEEK = "40.00"
STATUS_ACTIVE = "active"
STATUS_TERMINATED = "terminated"


def _gender(raw: Column) -> Column:
    initial = F.upper(first_chars(raw, 1))
    named = F.lit(UNSPECIFIED)
    for letter, word in GENDERS.items():
        named = F.when(initial == letter, F.lit(word)).otherwise(named)
    return named


def stage_employees(employees: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Normalise legacy employee rows; all conversions happen here.

    ``keep`` names columns to take along, such as the route of the row.
    """
    return employees.select(
        *keep,
        F.col("employeeno").cast("string").alias("legacy_empno"),
        F.col("employeeid_f01").cast("string").alias("employee_code"),
        F.col("surname_f02").alias("last_name"),
        F.col("givennames_f21").alias("first_name"),
        F.col("identity_f12").cast("string").alias("id_number"),
        iso_date("birthdate_d930").alias("date_of_birth"),
        iso_date("engagedate_d931").alias("hired_at"),
        blank_to_null(iso_date("dischargedate_d932")).alias("terminated_at"),
        F.col("title_f28").alias("title"),
        F.col("occupation_f11").alias("occupation"),
        F.col("category_f13").alias("category"),
        F.lit(UNSPECIFIED).alias("marital_status"),
        F.lit(CURRENCY_SLOT).alias("currency"),
        first_chars(upper_or_null("taxcountrycode_f14"), 3).alias("nationality_country_code"),
        _gender(F.col("gender_f22")).alias("gender"),
        email_or_synthetic("emailaddress_f40", "employeeid_f01").alias("email"),
    )


class Minted(NamedTuple):
    """Staged employees with their new user id, and what is stored of them."""

    rows: DataFrame
    users: DataFrame
    idmap: DataFrame


def mint_users(staged: DataFrame, base: int, p: RunParams) -> Minted:
    """One login user per staged employee, ids in the order of the legacy number.

    User ids run through all tenants.  ``mint_rank`` (1..n per scope) stays on
    the rows, so that tables with one row per employee get their own ids from
    it without another sort.
    """
    ranked = dense_ids(staged, ["legacy_empno"], 0, "mint_rank", p.scope, "_overall")
    rows = on_top_of(ranked, "_overall", base, (), "user_id").drop("_overall")
    users = rows.select(
        *p.scope,
        F.col("user_id").alias("id"),
        "email",
        F.lit(UNUSABLE_PASSWORD).alias("password_hash"),
        "first_name",
        "last_name",
        F.lit(1).alias("is_active"),
        p.col("cutover").alias("created_at"),
    )
    return Minted(rows, users, rows.select(*p.scope, "legacy_empno", "user_id"))


def attach_ids(staged: DataFrame, idmap: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Staged rows with the user ids of a stored map, when minting ran earlier."""
    return lookup_join(staged, idmap, [*scope, "legacy_empno"], "inner")


def build_employees(rows: DataFrame, existing: DataFrame | None, p: RunParams) -> DataFrame:
    """Employee records; a code already in use is skipped."""
    records = rows.select(
        *p.scope,
        employee_ref("legacy_empno").alias("id"),
        "user_id",
        "employee_code",
        "first_name",
        "last_name",
        "email",
        "id_number",
        "hired_at",
        "terminated_at",
        F.lit(0).cast("long").alias("salary_current_minor"),
        "currency",
        p.col("cutover").alias("created_at"),
        "date_of_birth",
        "gender",
        "title",
        "nationality_country_code",
        "marital_status",
        null_of("string").alias("preferred_name"),
        "occupation",
        "category",
    )
    return insert_if_absent(records, existing, [*p.scope, "employee_code"], ["user_id"])


def _one_row_ids(rows: DataFrame, base: Base, p: RunParams) -> DataFrame:
    """Ids for a table with one row per employee, in the order of the user id."""
    if "mint_rank" in rows.columns:
        return on_top_of(rows, "mint_rank", base, p.scope, "id")
    return dense_ids(rows, ["user_id"], base, "id", p.scope)


def _stamp(p: RunParams) -> list[Column]:
    return [p.col("cutover").alias("recorded_at"), p.col("system_user_id").alias("created_by_user_id")]


def build_contracts(rows: DataFrame, base: Base, p: RunParams) -> DataFrame:
    """One zero-rate contract per employee from the hire date on."""
    return _one_row_ids(rows, base, p).select(
        *p.scope,
        "id",
        F.col("user_id").alias("employee_id"),
        F.lit(RATE_TYPE).alias("rate_type"),
        F.lit(RATE_MINOR).cast("long").alias("rate_minor"),
        "currency",
        F.lit(HOURS_PER_WEEK).cast("decimal(5,2)").alias("hours_per_week"),
        null_of("long").alias("org_unit_id"),
        F.col("hired_at").alias("effective_from"),
        *_stamp(p),
    )


def build_assignments(rows: DataFrame, base: Base, p: RunParams) -> DataFrame:
    """Every employee on the route's payroll from the hire date on."""
    return _one_row_ids(rows, base, p).select(
        *p.scope,
        "id",
        F.col("user_id").alias("employee_id"),
        p.col("target_payroll_id").alias("payroll_id"),
        F.col("hired_at").alias("effective_from"),
        *_stamp(p),
    )


def build_status(rows: DataFrame, base: Base, p: RunParams) -> DataFrame:
    """Status history: active at hire, terminated at discharge if there is one."""
    steps = [(1, STATUS_ACTIVE, "hired_at"), (2, STATUS_TERMINATED, "terminated_at")]
    fan_out = F.inline(
        F.array(
            *[
                F.struct(F.lit(n).alias("step"), F.lit(status).alias("status"), F.col(day).alias("effective_from"))
                for n, status, day in steps
            ]
        )
    )
    history = rows.select(*p.scope, "user_id", fan_out).filter(F.col("effective_from").isNotNull())
    return dense_ids(history, ["user_id", "step"], base, "id", p.scope).select(
        *p.scope,
        "id",
        F.col("user_id").alias("employee_id"),
        "status",
        "effective_from",
        *_stamp(p),
    )
