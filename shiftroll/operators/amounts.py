"""Amount-code catalogue, and the routing of every amount by its code type."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftroll.functions.joins import Lookup, hot_keys, lookup_joins, spread_join
from shiftroll.functions.keys import Base, dense_ids
from shiftroll.functions.scalars import (
    EMPLOYEE_ID_PREFIX,
    MONEY_TYPE,
    flag,
    null_of,
    to_minor,
    to_minor_or_zero,
    upper_or_null,
)
from shiftroll.functions.writes import insert_in_route_order
from shiftroll.operators.links import LINK, employee_lookup, link_column
from shiftroll.params import RunParams
from shiftroll.session import materialise

# Code types and where they go.
EARNING = "E"
DEDUCTION = "D"
EMPLOYER_COST = "C"
BALANCES = ("B", "T")
YTD = "Y"
PLACED = (EARNING, DEDUCTION, EMPLOYER_COST, YTD, *BALANCES)
UNKNOWN_CODETYPE = "codetype_not_found"
ORPHAN = "employee_not_loaded"
# what holds the key of a skipped row
HELD_BY_TARGET = "target"
HELD_BY_BATCH = "batch"


def import_catalogue(
    settings: DataFrame, existing: DataFrame | None, scope: Sequence[str] = (), origin: Sequence[str] = ()
) -> DataFrame:
    """Amount-code definitions; an ordinal already there is skipped.

    ``origin`` names the company's columns where companies share a tenant; the
    first company's code wins.
    """
    codes = settings.select(
        *scope,
        *origin,
        F.col("ordinalno").alias("ordinal_no"),
        F.col("description").alias("name"),
        upper_or_null("codetype").alias("code_type"),
        "currency_code",
        to_minor_or_zero("codelimit").alias("code_limit_minor"),
        F.col("taxtype").alias("tax_type"),
        F.col("taxincasn").alias("tax_inc_asn"),
        F.col("consolcode").alias("consol_code"),
        F.col("adjustflag").alias("adjust_flag"),
        flag("manualdisplayind").alias("manual_display"),
        flag("prorataind").alias("prorata"),
        flag("qmfdisplayind").alias("qmf_display"),
    )
    return insert_in_route_order(codes, existing, [*scope, "ordinal_no"], origin)


def stage_amounts(
    amounts: DataFrame,
    settings: DataFrame,
    employees: DataFrame,
    scope: Sequence[str] = (),
    origin: Sequence[str] = (),
) -> DataFrame:
    """Non-zero amounts with their code and their employee, where these exist.

    Amounts meet only the codes of their own ``origin``, in which an ordinal
    must occur once.  Settings without the columns of scope and origin are a
    catalogue that all share.  The rows meet both lookups with their keys and
    the amount alone; what follows from these is added afterwards.
    """
    keep = [c for c in ("hired_at",) if c in employees.columns]
    owner = [c for c in (*scope, *origin) if c in settings.columns]
    codes = settings.select(
        *owner,
        F.col("ordinalno").alias("ordinal_no"),
        F.col("description").alias("name"),
        upper_or_null("codetype").alias("codetype"),
    )
    user = F.col("user_id").alias("employee_id")
    people = employee_lookup(amounts, "employeeno", employees, [user, *keep], "left", scope)
    rows = amounts.filter(F.col("amount_q") != 0).select(
        *scope,
        *origin,
        link_column(amounts, "employeeno"),
        F.col("ordinalno").alias("ordinal_no"),
        F.col("amount_q").cast(MONEY_TYPE).alias("amount_raw"),
    )
    linked = lookup_joins(rows, [Lookup(codes, [*owner, "ordinal_no"], "left"), people], write_first=True)
    return linked.select(
        *scope,
        *origin,
        F.col(LINK).cast("string").alias("legacy_empno"),
        "employee_id",
        *keep,
        "ordinal_no",
        "name",
        to_minor("amount_raw").alias("amount_minor"),
        "amount_raw",
        "codetype",
    )


def _loaded() -> Column:
    return F.col("employee_id").isNotNull()


def destinations() -> dict[str, Column]:
    """Condition of each destination.  They exclude each other and miss no row."""
    codetype = F.col("codetype")
    return {
        ORPHAN: ~_loaded(),
        UNKNOWN_CODETYPE: _loaded() & codetype.isNull(),
        "earnings": _loaded() & (codetype == EARNING),
        "deductions": _loaded() & (codetype == DEDUCTION),
        "employer_cost": _loaded() & (codetype == EMPLOYER_COST),
        "balances": _loaded() & codetype.isin(*BALANCES),
        "ytd_takeon": _loaded() & (codetype == YTD),
        "deprecated": _loaded() & codetype.isNotNull() & ~codetype.isin(*PLACED),
    }


def route(staged: DataFrame) -> DataFrame:
    """Name the destination of every staged amount in one pass."""
    destination = F.lit(None).cast("string")
    for name, condition in destinations().items():
        destination = F.when(condition, F.lit(name)).otherwise(destination)
    return staged.withColumn("destination", destination)


def _to(staged: DataFrame, destination: str) -> DataFrame:
    """Rows of one destination; a table written by destination is read in part."""
    if "destination" in staged.columns:
        return staged.filter(F.col("destination") == destination)
    return staged.filter(destinations()[destination])


# dense_ids sorts on these; the raw amount and the name make the order total
_LINE_ORDER = ["employee_id", "ordinal_no", "amount_raw", "name"]


def _lines(staged: DataFrame, destination: str, marks: dict[str, int], base: Base, p: RunParams) -> DataFrame:
    columns = [*p.scope, "employee_id", "ordinal_no", "name", "amount_minor", "amount_raw", "hired_at"]
    picked = _to(staged, destination).select(*columns)
    return dense_ids(picked, _LINE_ORDER, base, "id", p.scope).select(
        *p.scope,
        "id",
        "employee_id",
        F.col("name").alias("label"),
        "amount_minor",
        *[F.lit(value).alias(name) for name, value in marks.items()],
        F.col("hired_at").alias("effective_from"),
        p.col("cutover").alias("recorded_at"),
        p.col("system_user_id").alias("created_by_user_id"),
        null_of("string").alias("ended_at"),
        F.col("name").alias("payroll_code"),
    )


def route_earnings(staged: DataFrame, base: Base, p: RunParams) -> DataFrame:
    return _lines(staged, "earnings", {"taxable": 1, "uif_applicable": 1}, base, p)


def route_deductions(staged: DataFrame, base: Base, p: RunParams) -> DataFrame:
    return _lines(staged, "deductions", {"reduces_taxable": 0}, base, p)


def route_employer_cost(
    staged: DataFrame, existing: DataFrame | None, scope: Sequence[str] = (), origin: Sequence[str] = ()
) -> DataFrame:
    keys = [*scope, "employee_id", "ordinal_no"]
    return insert_in_route_order(_to(staged, "employer_cost").select(*keys, *origin, "amount_minor"), existing, keys, origin)


def route_balances(
    staged: DataFrame, existing: DataFrame | None, scope: Sequence[str] = (), origin: Sequence[str] = ()
) -> DataFrame:
    """Working balances keep their four decimals."""
    keys = [*scope, "employee_id", "ordinal_no"]
    rows = _to(staged, "balances").select(*keys, *origin, F.col("amount_raw").alias("amount"))
    return insert_in_route_order(rows, existing, keys, origin)


def route_deprecated(
    staged: DataFrame, existing: DataFrame | None, scope: Sequence[str] = (), origin: Sequence[str] = ()
) -> DataFrame:
    """Any other known code type, kept with the type."""
    keys = [*scope, "employee_id", "ordinal_no"]
    rows = _to(staged, "deprecated").select(*keys, *origin, "amount_minor", "codetype")
    return insert_in_route_order(rows, existing, keys, origin)


def route_ytd(staged: DataFrame, p: RunParams) -> DataFrame:
    """Year-to-date take-on lines for the report table."""
    return _to(staged, "ytd_takeon").select(
        p.col("tenant").alias("tenant"),
        "employee_id",
        "legacy_empno",
        F.col("name").alias("code"),
        "amount_minor",
        p.col("cutover").alias("loaded_at"),
    )


def _quarantine(staged: DataFrame, reason: str, p: RunParams) -> DataFrame:
    return _to(staged, reason).select(
        p.col("tenant").alias("tenant"),
        "legacy_empno",
        F.col("name").alias("code"),
        "codetype",
        "amount_minor",
        F.lit(reason).alias("reason"),
        p.col("cutover").alias("loaded_at"),
    )


def quarantine_unknown(staged: DataFrame, p: RunParams) -> DataFrame:
    return _quarantine(staged, UNKNOWN_CODETYPE, p)


def quarantine_orphans(staged: DataFrame, p: RunParams) -> DataFrame:
    return _quarantine(staged, ORPHAN, p)


def routing_summary(staged: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Rows and amount per destination and code type; the totals are the staged ones."""
    return (
        (staged if "destination" in staged.columns else route(staged))
        .groupBy(*scope, "destination", "codetype")
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum("amount_minor").alias("amount_minor"))
    )


# what decides among rows of one key, after the origin, as in the inserts above
_KEYED = ("employer_cost", "balances", "deprecated")


def keyed_outcomes(
    staged: DataFrame,
    existing: Mapping[str, DataFrame | None],
    scope: Sequence[str] = (),
    origin: Sequence[str] = (),
) -> DataFrame:
    """What became of the rows of the keyed destinations: how many were staged, added and skipped.

    One row for each distinct staged amount, with what holds its key: the
    target's own row, or the batch's with its amount.  ``existing`` are the
    target tables by destination as they were before the insert.  Repeats are
    counted in the map tasks, so a frequent key makes no large group.  The
    counted rows are written once; they and the keys of the targets give one
    table of keys, which meets the written rows again.
    """
    keys = [*scope, "destination", "employee_id", "ordinal_no"]
    values = [*origin, "codetype", "amount_minor", "amount_raw"]
    routed = staged if "destination" in staged.columns else route(staged)
    groups = materialise(
        routed.filter(F.col("destination").isin(*_KEYED)).groupBy(*keys, *values).agg(F.count(F.lit(1)).alias("staged_rows"))
    )
    types = {f.name: f.dataType for f in groups.schema.fields}
    raw = F.when(F.col("destination") == "balances", F.col("amount_raw")).otherwise(F.col("amount_minor"))
    kind = F.when(F.col("destination") == "deprecated", F.col("codetype"))
    order = F.struct(*origin, raw.alias("raw"), kind.alias("kind"), "codetype", "amount_minor", "amount_raw")
    holders = groups.select(*keys, order.alias("_order"), F.lit(False).alias("_held"))
    for name, table in existing.items():
        if table is not None:
            # a target may hold a key several times
            own = [F.lit(name).alias(c) if c == "destination" else F.col(c).cast(types[c]).alias(c) for c in keys]
            holders = holders.unionByName(table.select(*own, F.lit(True).alias("_held")), allowMissingColumns=True)
    holders = holders.groupBy(*keys).agg(F.min("_order").alias("_first"), F.max("_held").alias("_held"))
    [hot] = hot_keys(groups, [keys])
    ranked = spread_join(groups, holders, keys, "inner", hot)
    held = F.col("_held")
    won = ~held & order.eqNullSafe(F.col("_first"))
    added = F.when(won, F.lit(1)).otherwise(F.lit(0)).cast("long")
    return ranked.select(
        *keys,
        *values,
        "staged_rows",
        added.alias("added_rows"),
        (F.col("staged_rows") - added).alias("skipped_rows"),
        F.when(held, F.lit(HELD_BY_TARGET)).otherwise(F.lit(HELD_BY_BATCH)).alias("held_by"),
        F.when(~held, F.col("_first.amount_raw")).alias("held_amount"),
    )


def skipped_amounts(outcomes: DataFrame) -> DataFrame:
    """Staged amounts that the keyed inserts left out, with the row that won."""
    return outcomes.filter("skipped_rows > 0").drop("staged_rows", "added_rows")


def conservation(staged: DataFrame, outcomes: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Rows and amounts staged, added and skipped per destination and code type: staged = added + skipped.

    Destinations without a key add all they get.
    """
    by = [*scope, "destination", "codetype"]
    routed = staged if "destination" in staged.columns else route(staged)
    plain = routed.filter(~F.col("destination").isin(*_KEYED)).select(
        *by, "amount_minor", F.lit(1).cast("long").alias("staged_rows"), F.lit(1).cast("long").alias("added_rows")
    )
    every = plain.unionByName(outcomes.select(*by, "amount_minor", "staged_rows", "added_rows"))
    skipped = F.col("staged_rows") - F.col("added_rows")
    amount = F.col("amount_minor")
    return every.groupBy(*by).agg(
        F.sum("staged_rows").alias("staged_rows"),
        F.sum("added_rows").alias("added_rows"),
        F.sum(skipped).alias("skipped_rows"),
        F.sum(F.col("staged_rows") * amount).alias("staged_minor"),
        F.sum(F.col("added_rows") * amount).alias("added_minor"),
        F.sum(skipped * amount).alias("skipped_minor"),
    )


def refresh_salary(employees: DataFrame, earnings: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Set the salary on display to the sum of the employee's earning lines."""
    gross = earnings.groupBy(*scope, F.col("employee_id").alias("user_id")).agg(F.sum("amount_minor").alias("_gross"))
    migrated = F.col("id").startswith(EMPLOYEE_ID_PREFIX)
    salary = F.when(migrated, F.coalesce("_gross", F.lit(0))).otherwise(F.col("salary_current_minor"))
    return (
        employees.join(gross, [*scope, "user_id"], "left")
        .withColumn("salary_current_minor", salary.cast("long"))
        .select(*employees.columns)
    )
