"""Every operator as a query over the sample tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftroll.functions.joins import lookup_join, measured_once
from shiftroll.functions.keys import high_water, max_id
from shiftroll.operators import amounts, asof, derive, drift, employees, export, naming, reconcile, slots
from shiftroll.operators.carried_tables import CARRIED
from shiftroll.operators.carry import SOURCE_SCHEMA, carry_table, in_scope, plan_from_dictionary, unlinked_rows
from shiftroll.params import RunParams
from shiftroll.session import materialise, scratch_path
from shiftroll.sources import routes
from shiftroll.plans.migrate import ROUTE_COLUMNS
from shiftroll.sources.routes import ORIGIN
from shiftroll.sources.standins import DICTIONARY, USER_BASE, Standins
from shiftroll.sources.tables import (
    COLUMN_LIST_SCHEMA,
    append_report,
    read_any,
    read_columns_csv,
    read_source,
    write_columns_csv,
    write_drift,
)

Query = Callable[[SparkSession, str], DataFrame]

PARAMS = RunParams(
    cutover="2000-03-15T08:00:00+02:00",
    tenant="tenant_sample",
    target_payroll_id=1,
    payroll_number=1,
    system_user_id=7,
)
PAYDAY = "2024-01-15"
SAMPLE = "sample"
SAMPLE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TENANT_PARAMS = routes.route_params(PARAMS.cutover, PARAMS.system_user_id)

_QUERIES: dict[str, Query] = {}


def query(build: Callable[[Standins], DataFrame]) -> Callable[[Standins], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        with measured_once():  # the sample tables stay as they are
            return build(Standins(spark, folder))

    _QUERIES[build.__name__] = run
    return build


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


# ---- employees -----------------------------------------------------------


def _minted(s: Standins) -> employees.Minted:
    base = max_id(s.known_users(), "employee_id")
    return employees.mint_users(employees.stage_employees(s.employees()), base, PARAMS)


@query
def stage_employees(s: Standins) -> DataFrame:
    return employees.stage_employees(s.employees())


@query
def mint_users(s: Standins) -> DataFrame:
    return _minted(s).users


@query
def mint_idmap(s: Standins) -> DataFrame:
    return _minted(s).idmap


@query
def attach_ids(s: Standins) -> DataFrame:
    idmap = s.loaded_employees().select(F.substring("id", 5, 20).alias("legacy_empno"), "user_id")
    staged = employees.stage_employees(s.employees())
    return employees.attach_ids(staged, idmap).select("legacy_empno", "user_id", "employee_code", "hired_at")


@query
def build_employees(s: Standins) -> DataFrame:
    return employees.build_employees(_minted(s).rows, s.known_employees(), PARAMS)


@query
def build_contracts(s: Standins) -> DataFrame:
    base = max_id(s.table("events"), "event_id")
    return employees.build_contracts(_minted(s).rows, base, PARAMS)


@query
def build_assignments(s: Standins) -> DataFrame:
    return employees.build_assignments(_minted(s).rows, 0, PARAMS)


@query
def build_status(s: Standins) -> DataFrame:
    return employees.build_status(_minted(s).rows, 0, PARAMS)


# ---- amounts -------------------------------------------------------------


def _staged(s: Standins, hired: bool = False) -> DataFrame:
    return amounts.stage_amounts(s.amounts(), s.catalogue(), s.loaded_employees(hired))


@query
def import_catalogue(s: Standins) -> DataFrame:
    return amounts.import_catalogue(s.codes(), s.known_ordinals())


@query
def stage_amounts(s: Standins) -> DataFrame:
    return _staged(s, hired=True)


@query
def route_amounts(s: Standins) -> DataFrame:
    return amounts.route(_staged(s)).select(
        "legacy_empno", "employee_id", "ordinal_no", "codetype", "amount_minor", "destination"
    )


@query
def route_earnings(s: Standins) -> DataFrame:
    return amounts.route_earnings(_staged(s, hired=True), 0, PARAMS)


@query
def route_deductions(s: Standins) -> DataFrame:
    return amounts.route_deductions(_staged(s, hired=True), max_id(s.table("part"), "p_partkey"), PARAMS)


@query
def route_employer_cost(s: Standins) -> DataFrame:
    return amounts.route_employer_cost(_staged(s), None)


@query
def route_balances(s: Standins) -> DataFrame:
    return amounts.route_balances(_staged(s), None)


@query
def route_ytd(s: Standins) -> DataFrame:
    return amounts.route_ytd(_staged(s), PARAMS)


@query
def route_deprecated(s: Standins) -> DataFrame:
    return amounts.route_deprecated(_staged(s), None)


@query
def quarantine_unknown(s: Standins) -> DataFrame:
    return amounts.quarantine_unknown(_staged(s), PARAMS)


@query
def quarantine_orphans(s: Standins) -> DataFrame:
    return amounts.quarantine_orphans(_staged(s), PARAMS)


@query
def routing_summary(s: Standins) -> DataFrame:
    return amounts.routing_summary(_staged(s))


def _outcomes(s: Standins, staged: DataFrame) -> DataFrame:
    known = s.known_amounts()
    return amounts.keyed_outcomes(staged, {"balances": known, "deprecated": known, "employer_cost": None})


@query
def routing_conservation(s: Standins) -> DataFrame:
    """Staged, added and skipped rows and amounts of every destination and code type."""
    # read twice, so written once
    columns = ["destination", "employee_id", "ordinal_no", "codetype", "amount_minor", "amount_raw"]
    staged = materialise(amounts.route(_staged(s)).select(*columns))
    return amounts.conservation(staged, _outcomes(s, staged))


@query
def skipped_amounts(s: Standins) -> DataFrame:
    """Amounts that the keyed inserts leave out, and what holds their key."""
    return amounts.skipped_amounts(_outcomes(s, _staged(s)))


@query
def refresh_salary(s: Standins) -> DataFrame:
    earnings = amounts.route(_staged(s)).filter(F.col("destination") == "earnings")
    return amounts.refresh_salary(s.employees_on_display(), earnings.select("employee_id", "amount_minor"))


@query
def export_import_rows(s: Standins) -> DataFrame:
    return export.export_import_rows(s.employees(), s.amounts(), s.export_codes())


@query
def export_import_csv(s: Standins) -> DataFrame:
    """The export file, read back."""
    path = scratch_path(s.spark)
    export.export_import_csv(s.employees(), s.amounts(), s.export_codes(), path)
    written = export.export_import_rows(s.employees(), s.amounts(), s.export_codes()).schema
    return s.spark.read.schema(written).option("header", True).csv(path)


@query
def quarantine_report(s: Standins) -> DataFrame:
    """Both kinds of quarantined rows, appended to one report table."""
    path = scratch_path(s.spark)
    staged = _staged(s)
    append_report(amounts.quarantine_unknown(staged, PARAMS), path)
    append_report(amounts.quarantine_orphans(staged, PARAMS), path)
    return s.spark.read.parquet(path)


# ---- slots ---------------------------------------------------------------


@query
def import_alpha_settings(s: Standins) -> DataFrame:
    return slots.import_slot_settings("alpha", s.slot_settings(), s.known_ordinals())


@query
def import_date_settings(s: Standins) -> DataFrame:
    return slots.import_slot_settings("dates", s.slot_settings(), None)


@query
def import_precision_settings(s: Standins) -> DataFrame:
    return slots.import_slot_settings("precision", s.slot_settings(), None)


@query
def import_alpha(s: Standins) -> DataFrame:
    return slots.import_alpha(s.slots(), s.loaded_employees(), s.known_slots())


@query
def import_dates(s: Standins) -> DataFrame:
    return slots.import_dates(s.slots(), s.loaded_employees(), s.known_slots())


@query
def import_precision(s: Standins) -> DataFrame:
    return slots.import_precision(s.slots(), s.loaded_employees(), s.known_slots())


@query
def import_thirdparty(s: Standins) -> DataFrame:
    return slots.import_thirdparty(s.thirdparty_payments(), s.loaded_employees(), s.known_slots())


# ---- bank details, tax status, periods -----------------------------------


@query
def import_bank_details(s: Standins) -> DataFrame:
    base = max_id(s.table("part"), "p_partkey")
    return derive.import_bank_details(s.accounts(), s.loaded_employees(), s.known_accounts(), base, PARAMS)


@query
def build_tax_status(s: Standins) -> DataFrame:
    return derive.build_tax_status(s.employees(), s.loaded_employees(), s.known_users(), PARAMS)


@query
def build_periods(s: Standins) -> DataFrame:
    calendar = s.calendar().select(F.lit(1).alias("payroll"), F.col("rundate").alias("run_date"))
    return derive.build_periods(calendar, s.payrolls(), s.known_periods(1), PARAMS)


# ---- carried tables ------------------------------------------------------

CARRY_SOURCES: dict[str, str] = {
    "run_history": "run_history",
    "run_history_amounts": "run_history_amounts",
    "settings_calendar": "calendar",
    "settings_banks": "banks",
    "employee_increments": "increments",
    "settings_report_calcs": "report_calcs",
    "settings_currency": "currencies",
    "settings_zaf_uif_company": "uif_companies",
    "settings_table_values": "table_values",
    "pay_run_tax_audit": "tax_audit",
    "ratef": "rates",
    "settings_split_payment_code": "split_codes",
    "employee_thirdparty_transact": "thirdparty_transactions",
    "run_history_alpha": "run_texts",
}


def carried(s: Standins, table: str, existing: DataFrame | None = None) -> DataFrame:
    plan = plan_from_dictionary(table, *DICTIONARY[table])
    src = getattr(s, CARRY_SOURCES[table])()
    # the sample source lists the columns it has
    absent = dict.fromkeys(set(plan.sources) - set(src.columns))
    return carry_table(src, plan, s.loaded_employees(), existing, PARAMS, absent)


def _carry_query(table: str) -> None:
    def build(s: Standins) -> DataFrame:
        return carried(s, table)

    build.__name__ = f"carry_{table}"
    query(build)


for _table in CARRY_SOURCES:
    _carry_query(_table)


@query
def carry_ratef_again(s: Standins) -> DataFrame:
    """Ids that the target has are skipped."""
    return carried(s, "ratef", s.table("supplier").select(F.col("s_suppkey").alias("id")))


@query
def carry_unlinked_rows(s: Standins) -> DataFrame:
    plan = plan_from_dictionary("run_history", *DICTIONARY["run_history"])
    return unlinked_rows(s.run_history(), plan, s.loaded_employees())


@query
def high_water_increments(s: Standins) -> DataFrame:
    return high_water(carried(s, "employee_increments"))


# ---- schema tools --------------------------------------------------------


def _drift(s: Standins) -> DataFrame:
    tables = {name: s.table(name) for name in ("customer", "lineitem", "orders", "part", "supplier")}
    promised = {
        "customer": ["c_custkey", "c_name", "c_nationkey", "c_phone"],
        "lineitem": [c for c in tables["lineitem"].columns if c != "l_tax"],
        "orders": [*tables["orders"].columns, "o_clerk"],
        "part": tables["part"].columns,
        "partsupp": ["ps_partkey"],
        "supplier": ["s_suppkey", "s_name", "s_nationkey"],
    }
    pairs = [(table, column) for table, columns in promised.items() for column in columns]
    expected = s.spark.createDataFrame(pairs, "table_name string, column_name string")
    return drift.schema_drift(expected, tables)


@query
def schema_drift(s: Standins) -> DataFrame:
    return _drift(s)


@query
def drift_report(s: Standins) -> DataFrame:
    """The drift of the tables as JSON, read back."""
    path = scratch_path(s.spark)
    found = _drift(s)
    write_drift(found, path)
    return s.spark.read.schema(found.schema).json(path)


@query
def column_list_drift(s: Standins) -> DataFrame:
    """The list of all columns of the sample tables, through its file, against a dictionary with scopes.

    The dictionary promises a note in every table and an archive of every one
    whose name begins with p, and knows no keys; three tables are out of scope.
    """
    path = scratch_path(s.spark)
    found = [(SAMPLE, t, c) for t in SAMPLE_TABLES for c in read_any(s.spark, s.folder, t).columns]
    write_columns_csv(s.spark.createDataFrame(found, COLUMN_LIST_SCHEMA), path)
    listed = read_columns_csv(s.spark, path)
    tables = listed.select("table_name").distinct()
    promised = (
        listed.filter(~F.col("column_name").endswith("key"))
        .select("table_name", "column_name")
        .union(tables.select("table_name", F.concat("table_name", F.lit("_note"))))
        .union(tables.filter(F.col("table_name").startswith("p")).select(F.concat("table_name", F.lit("_archive")), F.lit("id")))
    )
    dictionary = promised.withColumns(
        {
            "schema_type": F.when(F.col("table_name") == "region", "SYSTEM")
            .when(F.col("table_name") < "m", "COMPANY")
            .otherwise("PAYROLL"),
            "copy_data": ~F.col("table_name").isin("nation", "events"),
        }
    )
    return drift.column_drift(in_scope(dictionary), listed)


@query
def read_two_companies(s: Standins) -> DataFrame:
    """Files of two companies with different columns, read as one table with its run-time schema."""
    root = scratch_path(s.spark)
    for schema, part in zip(("007", "co_b"), s.company_banks(), strict=True):
        part.drop("source_schema").write.parquet(f"{root}/settings_banks/{SOURCE_SCHEMA}={schema}")
    return read_source(s.spark, root, "settings_banks")


@query
def high_water_tables(s: Standins) -> DataFrame:
    """Next free id of the auto-key tables that the sample can feed."""
    tables = [t for t in CARRY_SOURCES if CARRIED[t].auto_key]
    marks = [high_water(carried(s, t)).select(F.lit(t).alias("table_name"), "next_id") for t in tables]
    return reduce(DataFrame.unionByName, marks)


@query
def normalise_columns(s: Standins) -> DataFrame:
    legacy = ["AutoNumber", "EventTS", "EmployeeNo", "Row", "RateValue", "EmployeeId"]
    raw = s.table("events").select("event_id", F.col("ts").cast("date"), "user_id", "event_type", "value", "props")
    return naming.normalise_columns(raw.toDF(*legacy), auto_key="AutoNumber")


# ---- routes and tenants --------------------------------------------------


@query
def migration_map(s: Standins) -> DataFrame:
    return routes.routes(routes.seed_map(s.route_rows()))


def _tenant_minted(s: Standins) -> employees.Minted:
    routed = routes.attach_route(s.employees(), s.region_routes(), SOURCE_SCHEMA)
    staged = employees.stage_employees(routed, ["tenant", "target_payroll_id"])
    return employees.mint_users(staged, USER_BASE, TENANT_PARAMS)


def _at_home(s: Standins, routes_of: DataFrame) -> DataFrame:
    """Loaded employees with the tenant of their company."""
    homes = routes.attach_route(s.companies(), routes_of, SOURCE_SCHEMA).select(
        "tenant", (F.col("employeeno") + USER_BASE).alias("user_id")
    )
    return lookup_join(s.loaded_employees(hired=True), homes, ["user_id"])


def _tenant_staged(s: Standins) -> DataFrame:
    """Amounts of all tenants; they share one catalogue here."""
    routed = routes.attach_route(s.tenant_amounts(), s.region_routes(), SOURCE_SCHEMA)
    return amounts.stage_amounts(routed, s.catalogue(), _at_home(s, s.region_routes()), ("tenant",))


def _shared_staged(s: Standins) -> DataFrame:
    """Amounts of companies that share tenants, each with its own catalogue."""
    mapped = s.shared_routes()
    routed = routes.attach_route(s.shared_amounts(), mapped, SOURCE_SCHEMA)
    codes = routes.attach_route(s.shared_codes(), mapped, SOURCE_SCHEMA)
    return amounts.stage_amounts(routed, codes, _at_home(s, mapped), ("tenant",), (ORIGIN,))


@query
def tenant_employees(s: Standins) -> DataFrame:
    return employees.build_employees(_tenant_minted(s).rows, None, TENANT_PARAMS)


@query
def tenant_assignments(s: Standins) -> DataFrame:
    return employees.build_assignments(_tenant_minted(s).rows, 0, TENANT_PARAMS)


@query
def tenant_status(s: Standins) -> DataFrame:
    return employees.build_status(_tenant_minted(s).rows, 0, TENANT_PARAMS)


@query
def tenant_earnings(s: Standins) -> DataFrame:
    return amounts.route_earnings(_tenant_staged(s), 0, TENANT_PARAMS)


@query
def tenant_routing_summary(s: Standins) -> DataFrame:
    return amounts.routing_summary(_tenant_staged(s), ("tenant",))


@query
def tenant_shared_catalogue(s: Standins) -> DataFrame:
    """Of the codes of companies in one tenant the first company's win."""
    codes = routes.attach_route(s.shared_codes(), s.shared_routes(), SOURCE_SCHEMA)
    return amounts.import_catalogue(codes, None, ("tenant",), (ORIGIN,))


@query
def tenant_shared_earnings(s: Standins) -> DataFrame:
    return amounts.route_earnings(_shared_staged(s), 0, TENANT_PARAMS)


@query
def tenant_shared_balances(s: Standins) -> DataFrame:
    """Companies compete for an employee's balances; the first route's stay."""
    return amounts.route_balances(_shared_staged(s), None, ("tenant",), (ORIGIN,))


@query
def tenant_shared_summary(s: Standins) -> DataFrame:
    return amounts.routing_summary(_shared_staged(s), ("tenant",))


@query
def tenant_shared_slots(s: Standins) -> DataFrame:
    """Companies compete for an employee's slots; the first route's stay."""
    mapped = s.shared_routes()
    routed = routes.attach_route(s.shared_slots(), mapped, SOURCE_SCHEMA)
    return slots.import_alpha(routed, _at_home(s, mapped), None, ("tenant",), (ORIGIN,))


@query
def tenant_shared_carry(s: Standins) -> DataFrame:
    """Banks of companies that differ in columns and compete for branch codes."""
    table = plan_from_dictionary("settings_banks", *DICTIONARY["settings_banks"])
    parts = s.company_banks()
    whole = parts[0].unionByName(parts[1], allowMissingColumns=True)
    names = [c["legacy_company_schema"] for c in s.shared_routes().select("legacy_company_schema").collect()]
    listed = s.spark.createDataFrame(
        [(n, "settings_banks", c) for n in names for c in parts[int(n.removeprefix("co_")) % 2].columns],
        COLUMN_LIST_SCHEMA,
    )
    absent = reconcile.absent_columns({"settings_banks": table}, listed)["settings_banks"]
    routed = routes.attach_route(whole, s.shared_routes(), SOURCE_SCHEMA)
    return carry_table(routed, table, None, None, TENANT_PARAMS, absent, (ORIGIN,))


@query
def not_carried_report(s: Standins) -> DataFrame:
    """What the carried run history leaves behind, by company and cause."""
    table = plan_from_dictionary("run_history", *DICTIONARY["run_history"])
    routed = routes.attach_route(s.company_run_history(), s.region_routes(), SOURCE_SCHEMA)
    loaded = _at_home(s, s.region_routes())
    return reconcile.not_carried(routed, table, loaded, ("tenant",), ROUTE_COLUMNS)


# ---- reads of a pay run --------------------------------------------------


@query
def as_of_snapshot(s: Standins) -> DataFrame:
    return asof.as_of(s.dated_rows(), ["employee_id"], PAYDAY)


@query
def run_worklist(s: Standins) -> DataFrame:
    return asof.worklist(s.dated_rows(), s.pending_transactions(), 1, PAYDAY)


@query
def payable_employees(s: Standins) -> DataFrame:
    work = asof.worklist(s.dated_rows(), s.pending_transactions(), 1, PAYDAY)
    return asof.payable(work, s.dated_rows(), PAYDAY)


@query
def rebuild_ledger(s: Standins) -> DataFrame:
    return asof.rebuild_ledger(s.facts())


@query
def ytd_basis(s: Standins) -> DataFrame:
    return asof.ytd_basis(s.ledger(), s.facts())
