"""A whole migration: all tenants of the routing map, table by table.

Legacy tables lie below one folder, ``<legacy>/<table>/source_schema=<schema>``,
target tables below another, ``<target>/<table>/tenant=<tenant>``.  Each step is
one job for all tenants.  An append is committed as a whole; steps that skip
known keys can be repeated, the others add their rows again.  Where companies
share a tenant, the rows of the earlier route win, as if routes ran in turn.

The carried tables follow from the dictionary and from the source's own list of
columns (see ``operators.carry`` and ``operators.reconcile``).
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftroll.functions.joins import lookup_join, measured_once
from shiftroll.functions.keys import high_water, max_id
from shiftroll.functions.writes import require_absent, require_unique
from shiftroll.operators import amounts, derive, drift, employees, reconcile, slots
from shiftroll.operators.carried_tables import CARRIED
from shiftroll.operators.carry import (
    SOURCE_SCHEMA,
    Absent,
    CarriedTable,
    carry_table,
    in_scope,
    registry_of,
    require_known_columns,
)
from shiftroll.params import RunParams
from shiftroll.session import clear_scratch, materialise
from shiftroll.sources import routes
from shiftroll.sources.routes import ORIGIN
from shiftroll.sources.tables import (
    append,
    append_report,
    columns_by_schema,
    read_source,
    replace_partitions,
    table_exists,
    write_drift,
)

TABLES_AT_A_TIME = 8
#: Columns that a run adds to the rows of a source.
ROUTE_COLUMNS = ("tenant", "target_payroll_id", "payroll_number", ORIGIN)


@dataclass
class Migration:
    """One run.

    ``dictionary`` (``carry.DICTIONARY_SCHEMA``) describes the carried tables,
    ``listed`` (schema, table, column) is the source's list of the columns it
    has.  Without the list the source must have all that the dictionary promises.
    """

    spark: SparkSession
    legacy: str
    target: str
    route_map: DataFrame
    cutover: str
    system_user_id: int = 1
    dictionary: DataFrame | None = None
    listed: DataFrame | None = None

    @property
    def p(self) -> RunParams:
        return routes.route_params(self.cutover, self.system_user_id)

    # ---- tables ----------------------------------------------------------

    @cached_property
    def registry(self) -> dict[str, CarriedTable]:
        return {} if self.dictionary is None else registry_of(self.dictionary)

    @cached_property
    def absent(self) -> Mapping[str, Absent]:
        return {} if self.listed is None else reconcile.absent_columns(self.registry, self.listed)

    def source(self, table: str, side: str = "company") -> DataFrame:
        """Rows of all mapped schemas with their route; ``origin`` is the company whose route brought them."""
        return routes.attach_route(read_source(self.spark, self.legacy, table), self.route_map, SOURCE_SCHEMA, side)

    def has_source(self, table: str) -> bool:
        return table_exists(self.spark, f"{self.legacy}/{table}")

    def path(self, table: str) -> str:
        return f"{self.target}/{table}"

    def existing(self, table: str) -> DataFrame | None:
        path = self.path(table)
        return self.spark.read.parquet(path) if table_exists(self.spark, path) else None

    def add(self, table: str, rows: DataFrame, clustered: bool = False) -> None:
        append(rows, self.path(table), ["tenant"], clustered)

    def report(self, table: str, rows: DataFrame) -> None:
        append_report(rows, self.path(table))

    def _base(self, table: str):
        return max_id(self.existing(table), "id", self.p.scope)

    # ---- steps -----------------------------------------------------------

    def load_employees(self) -> None:
        staged = employees.stage_employees(self.source("employees"), ["tenant", "target_payroll_id"])
        require_unique(staged, [*self.p.scope, "legacy_empno"])
        minted = employees.mint_users(staged, max_id(self.existing("core_users")), self.p)
        known = self.existing("employees")
        added = employees.build_employees(minted.rows, known, self.p)
        require_absent(added, known, [*self.p.scope, "id"])
        # numbered rows come sorted by tenant
        self.add("core_users", minted.users, clustered=True)
        self.add("employees", added)
        for table, build in (
            ("employee_contracts", employees.build_contracts),
            ("employee_payroll_assignments", employees.build_assignments),
            ("employee_status_history", employees.build_status),
        ):
            self.add(table, build(minted.rows, self._base(table), self.p), clustered=True)

    def load_amounts(self) -> None:
        # companies of one tenant each have a catalogue of their own
        scope, origin = self.p.scope, (ORIGIN,)
        settings = self.source("settings_employee_amounts")
        require_unique(settings, [*origin, "ordinalno"])
        catalogue = amounts.import_catalogue(settings, self.existing("settings_employee_amounts"), scope, origin)
        self.add("settings_employee_amounts", catalogue)
        lines = self.source("employee_amounts")
        staged = amounts.stage_amounts(lines, settings, self.existing("employees"), scope, origin)
        # read once per destination below
        staged = materialise(amounts.route(staged), ["destination"])
        before = {d: self.existing(f"employee_amount_{d}") for d in ("employer_cost", "balances", "deprecated")}
        outcomes = materialise(amounts.keyed_outcomes(staged, before, scope, origin))
        self.report("report_amount_conservation", amounts.conservation(staged, outcomes, scope))
        self.report("report_skipped_amounts", amounts.skipped_amounts(outcomes))
        for table, numbered in (
            ("employee_amount_earnings", amounts.route_earnings),
            ("employee_amount_deductions", amounts.route_deductions),
        ):
            self.add(table, numbered(staged, self._base(table), self.p), clustered=True)
        for table, keyed in (
            ("employee_amount_employer_cost", amounts.route_employer_cost),
            ("employee_amount_balances", amounts.route_balances),
            ("employee_amount_deprecated", amounts.route_deprecated),
        ):
            self.add(table, keyed(staged, self.existing(table), scope, origin))
        self.report("report_ytd_takeon", amounts.route_ytd(staged, self.p))
        self.report("report_amount_quarantine", amounts.quarantine_unknown(staged, self.p))
        self.report("report_amount_quarantine", amounts.quarantine_orphans(staged, self.p))
        self.report("report_amount_routing", amounts.routing_summary(staged, scope))
        self.refresh_salaries()

    def refresh_salaries(self) -> None:
        earnings = self.existing("employee_amount_earnings")
        if earnings is None:
            earnings = self.spark.createDataFrame([], "tenant string, employee_id long, amount_minor long")
        # tenants that take no part in the run stay as they are
        tenants = self.route_map.select(F.concat(F.lit("tenant_"), "tenant_slug").alias("tenant")).distinct()
        loaded = lookup_join(self.existing("employees"), tenants, ["tenant"], "left_semi")
        refreshed = amounts.refresh_salary(loaded, earnings, self.p.scope)
        replace_partitions(materialise(refreshed), self.path("employees"), ["tenant"])

    def load_slots(self) -> None:
        # the employees are looked up by every table, and no table here is read after it is written
        with measured_once():
            self._load_slots()

    def _load_slots(self) -> None:
        scope, origin = self.p.scope, (ORIGIN,)
        loaded = self.existing("employees")
        for kind, table in (
            ("alpha", "settings_employee_alpha"),
            ("dates", "settings_employee_dates"),
            ("precision", "settings_employee_precision_amounts"),
        ):
            if self.has_source(table):
                rows = slots.import_slot_settings(kind, self.source(table), self.existing(table), scope, origin)
                self.add(table, rows)
        for table, fill in (
            ("employee_alpha", slots.import_alpha),
            ("employee_dates", slots.import_dates),
            ("employee_precision_amounts", slots.import_precision),
            ("employee_thirdparty_payments", slots.import_thirdparty),
        ):
            if self.has_source(table):
                self.add(table, fill(self.source(table), loaded, self.existing(table), scope, origin))

    @cached_property
    def _mapped(self) -> dict[str, set[str]]:
        rows = self.route_map.select("legacy_company_schema", "legacy_payroll_schema").collect()
        return {side: {r[f"legacy_{side}_schema"] for r in rows} for side in ("company", "payroll")}

    def check_columns(self, table: CarriedTable) -> None:
        """Raise when the table could not be carried whole."""
        name = table.spec.table
        present = columns_by_schema(self.spark, self.legacy, name)
        mapped = {s: c for s, c in present.items() if s in self._mapped[table.spec.source]}
        reconcile.require_listed_gaps(table, mapped, self.absent.get(name, {}))
        require_known_columns(table, self.existing(name), self.p.scope)

    def carry(self, table: CarriedTable) -> None:
        name, absent = table.spec.table, self.absent.get(table.spec.table, {})
        rows, people = self.source(name, table.spec.source), self.existing("employees")
        self.add(name, carry_table(rows, table, people, self.existing(name), self.p, absent, (ORIGIN,)))

    def report_losses(self, table: CarriedTable) -> None:
        rows = self.source(table.spec.table, table.spec.source)
        if table.link or reconcile.stray_columns(rows, table, ROUTE_COLUMNS):
            lost = reconcile.not_carried(rows, table, self.existing("employees"), self.p.scope, ROUTE_COLUMNS)
            self.report("report_not_carried", lost)

    def carry_tables(self) -> None:
        """Carry all tables of the dictionary; nothing is written unless every table passes its checks.

        Most of these tables are small, so several are carried at a time.
        """
        names = [name for name in sorted({*CARRIED, *self.registry}) if self.has_source(name)]
        unknown = [
            name
            for name in names
            if name not in self.registry and not self.source(name, CARRIED[name].source).isEmpty()
        ]
        if unknown:
            raise ValueError(f"tables with rows that the dictionary lacks: {', '.join(unknown)}")
        tables = [self.registry[name] for name in names if name in self.registry]
        _ = self.absent, self._mapped
        with ThreadPoolExecutor(TABLES_AT_A_TIME) as pool:
            list(pool.map(self.check_columns, tables))
            list(pool.map(self.carry, tables))
        # one report table: its appends must not overlap
        for table in tables:
            self.report_losses(table)

    def report_drift(self) -> None:
        """Where the source's list differs from the dictionary's tables in scope, both ways."""
        expected = in_scope(self.dictionary).select("table_name", F.lower("column_name").alias("column_name"))
        found = self.listed.select("table_name", F.lower("column_name").alias("column_name"))
        write_drift(drift.column_drift(expected, found), self.path("report_drift"))

    def next_ids(self) -> dict[str, DataFrame]:
        """Next free id per tenant of each auto-key table, for its sequence."""
        tables = [t for t, spec in CARRIED.items() if spec.auto_key]
        found = {t: self.existing(t) for t in tables}
        return {t: high_water(df, "id", self.p.scope) for t, df in found.items() if df is not None}

    def load_accounts(self) -> None:
        table = "employee_bank_details"
        rows = derive.import_bank_details(
            self.source("employee_accounts"),
            self.existing("employees"),
            self.existing(table),
            self._base(table),
            self.p,
            (ORIGIN,),
        )
        self.add(table, rows, clustered=True)

    def load_tax_status(self) -> None:
        table = "employee_tax_status"
        self.add(
            table,
            derive.build_tax_status(
                self.source("employees"), self.existing("employees"), self.existing(table), self.p, (ORIGIN,)
            ),
        )

    def load_periods(self) -> None:
        table = "payroll_periods"
        routed = self.route_map.select(
            F.concat(F.lit("tenant_"), "tenant_slug").alias("tenant"),
            F.col("legacy_payroll_number").alias("payroll"),
            F.col("legacy_payroll_number").alias("payroll_number"),
            "target_payroll_id",
        )
        calendar = lookup_join(self.existing("settings_calendar"), routed, ["tenant", "payroll"])
        rows = derive.build_periods(calendar, self.existing("payrolls"), self.existing(table), self.p)
        self.add(table, rows)

    def run(self) -> None:
        try:
            self.load_employees()
            self.load_amounts()
            self.load_slots()
            if self.dictionary is not None and self.listed is not None:
                self.report_drift()
            self.carry_tables()
            if self.has_source("employee_accounts"):
                self.load_accounts()
            self.load_tax_status()
            if self.existing("settings_calendar") is not None and self.existing("payrolls") is not None:
                self.load_periods()
        finally:
            clear_scratch(self.spark)
