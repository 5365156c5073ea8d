"""A whole run over two companies, written and read back."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shiftroll.operators.carry import DICTIONARY_SCHEMA
from shiftroll.plans.migrate import Migration
from shiftroll.sources.routes import migration_map
from shiftroll.sources.standins import DICTIONARY
from tests.test_amounts import SETTINGS
from tests.test_employees import COLUMNS, person

DAY = datetime.date


def dictionary_of(spark, *tables):
    rows = [
        (t, DICTIONARY[t][0].upper(), True, i, c.name, c.type, c.key_pos)
        for t in tables
        for i, c in enumerate(DICTIONARY[t][1])
    ]
    return spark.createDataFrame(rows, DICTIONARY_SCHEMA)


def columns_list(spark, rows):
    return spark.createDataFrame(rows, "table_schema string, table_name string, column_name string")


@pytest.fixture(scope="module")
def migration(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("migration")
    legacy, target = str(root / "legacy"), str(root / "target")

    def put(table, schema, rows, columns):
        spark.createDataFrame(rows, columns).write.parquet(f"{legacy}/{table}/source_schema={schema}")

    for company, payroll, shift in (("co_a", "pay_a", 0), ("co_b", "pay_b", 1)):
        put("employees", company, [person(1), person(2, dischargedate_d932=DAY(2024, 1, 1))][: 2 - shift], COLUMNS)
        codes = [(1, "basic", "E"), (2, "fund", "D"), (3, "odd", "H"), (4, "bal", "B"), (5, "cost", "C"), (6, "ytd", "Y")]
        put("settings_employee_amounts", company,
            [(n, d, t, "1", None, "", "", "", "", True, True, True) for n, d, t in codes], SETTINGS)
        amounts = [(1, n, Decimal(n + 10 * shift)) for n in range(1, 7)]
        put("employee_amounts", company, [*amounts, (1, 9, Decimal(1)), (44, 1, Decimal(2)), (1, 1, Decimal(0))],
            "employeeno int, ordinalno int, amount_q decimal(19,4)")
        put("employee_accounts", company, [(1, 1, "", "n", "1", None, "usd", "m", "s", "p", "h", True, "i")],
            "employeeno int, ordinalno int, accounttype_g1 string, accountname_g2 string, accountnumber_g3 string, "
            "branchcode_g4 string, accountcurrency_g10 string, paymode_g0 string, sourcebankaccount_g5 string, "
            "splitpaycode_g6 string, accountholderstatus_g7 string, sarsbankaccount_g8 boolean, accountiban_g9 string")  # fmt: skip
        put("settings_employee_alpha", company, [(1, "n")], "ordinalno int, alphaname string")
        put("employee_alpha", company, [(1, 1, "v"), (1, 1, "w"), (50, 1, "x")],
            "employeeno int, ordinalno int, reference_v string")
        put("employee_increments", company, [(5, 1, DAY(2020, 1, 1), Decimal(3)), (5, 1, DAY(2020, 1, 2), Decimal(4))],
            "autonumber long, employeeno int, date_d8 date, amount_u decimal(19,4)")
        put("settings_calendar", payroll, [(1, DAY(2026, 7, 31)), (2, DAY(2026, 8, 31)), (3, None)],
            "ordinalno int, rundate date")
    payrolls = spark.createDataFrame(
        [("tenant_one", 11, "ZA"), ("tenant_two", 12, "KE"), ("tenant_two", 13, "NA")], "tenant string, id int, country_code string"
    )
    payrolls.write.partitionBy("tenant").parquet(f"{target}/payrolls")
    tables = ("employee_increments", "settings_calendar")
    listed = [(s, "settings_calendar", c) for s in ("pay_a", "pay_b") for c in ("ordinalno", "rundate")]
    listed += [(s, "employee_increments", c) for s in ("co_a", "co_b") for c in ("AutoNumber", "employeeno", "date_d8", "amount_u")]
    sources = (dictionary_of(spark, *tables), columns_list(spark, listed))
    mapped = migration_map(spark, [("co_a", "pay_a", "one", 11, 1), ("co_b", "pay_b", "two", 12, 4)])
    done = Migration(spark, legacy, target, mapped, "2026-08-15T10:00:00+02:00", 3, *sources)
    done.run()
    return done


def test_run(migration, rows):
    def read(table):
        return migration.existing(table)

    assert rows(read("core_users"), "id", "tenant") == [(1, "tenant_one"), (2, "tenant_one"), (3, "tenant_two")]
    assert rows(read("employees"), "tenant", "id", "user_id", "salary_current_minor") == [
        ("tenant_one", "emp-1", 1, 100), ("tenant_one", "emp-2", 2, 0), ("tenant_two", "emp-1", 3, 1100),
    ]
    assert rows(read("employee_contracts"), "tenant", "id", "employee_id") == [
        ("tenant_one", 1, 1), ("tenant_one", 2, 2), ("tenant_two", 1, 3),
    ]
    assert rows(read("employee_payroll_assignments"), "tenant", "payroll_id", "employee_id") == [
        ("tenant_one", 11, 1), ("tenant_one", 11, 2), ("tenant_two", 12, 3),
    ]
    assert rows(read("employee_status_history"), "tenant", "id", "status") == [
        ("tenant_one", 1, "active"), ("tenant_one", 2, "active"), ("tenant_one", 3, "terminated"), ("tenant_two", 1, "active"),
    ]
    assert rows(read("employee_amount_earnings"), "tenant", "id", "amount_minor") == [
        ("tenant_one", 1, 100), ("tenant_two", 1, 1100),
    ]
    assert rows(read("employee_amount_balances"), "tenant", "amount") == [
        ("tenant_one", Decimal("4.0000")), ("tenant_two", Decimal("14.0000")),
    ]
    assert rows(read("employee_amount_deprecated"), "codetype", "amount_minor") == [("H", 1300), ("H", 300)]
    assert read("report_ytd_takeon").count() == 2
    assert rows(read("report_amount_quarantine").filter("tenant = 'tenant_one'"), "legacy_empno", "reason") == [
        ("1", "codetype_not_found"), ("44", "employee_not_loaded"),
    ]
    assert read("report_amount_routing").agg(F.sum("row_count")).first()[0] == 16
    assert rows(read("employee_alpha"), "tenant", "employee_id", "value") == [("tenant_one", 1, "v"), ("tenant_two", 3, "v")]
    # the same id in two tenants is no conflict
    assert rows(read("employee_increments"), "tenant", "id", "amount_u") == [
        ("tenant_one", 5, Decimal("3.0000")), ("tenant_two", 5, Decimal("3.0000")),
    ]
    assert rows(migration.next_ids()["employee_increments"]) == [("tenant_one", 6), ("tenant_two", 6)]
    assert rows(read("settings_calendar"), "tenant", "payroll", "ordinal_no")[3:] == [("tenant_two", 4, n) for n in (1, 2, 3)]
    assert rows(read("payroll_periods"), "tenant", "payroll_id", "period_end", "status", "country_code") == [
        ("tenant_one", 11, "2026-07-31", "closed", "ZA"), ("tenant_one", 11, "2026-08-31", "open", "ZA"),
        ("tenant_two", 12, "2026-07-31", "closed", "KE"), ("tenant_two", 12, "2026-08-31", "open", "KE"),
    ]
    assert read("employee_tax_status").count() == 3
    assert rows(read("employee_bank_details"), "tenant", "id", "employee_id", "account_type", "currency") == [
        ("tenant_one", 1, 1, "unknown", "USD"), ("tenant_two", 1, 3, "unknown", "USD"),
    ]


def test_second_run(migration):
    """Keyed and guarded tables stay as they are; unguarded ones repeat, as documented."""
    keyed = ["employees", "employee_alpha", "employee_amount_balances", "employee_tax_status", "payroll_periods",
             "employee_increments", "settings_calendar", "settings_employee_amounts",
             "employee_bank_details"]
    before = {t: migration.existing(t).count() for t in keyed}
    migration.run()
    assert {t: migration.existing(t).count() for t in keyed} == before
    contracts = migration.existing("employee_contracts")
    assert contracts.count() == 6
    assert contracts.filter("tenant = 'tenant_one'").select("id").distinct().count() == 4
    assert migration.existing("core_users").agg(F.max("id")).first()[0] == 6


def test_destinations_without_rows(spark, tmp_path):
    """Nothing to route to most tables: later runs find them empty, not broken."""
    legacy = str(tmp_path / "legacy")
    tables = {
        "employees": ([person(1)], COLUMNS),
        "settings_employee_amounts": ([(3, "odd", "H", "1", None, "", "", "", "", True, True, True)], SETTINGS),
        "employee_amounts": ([(1, 3, Decimal(2))], "employeeno int, ordinalno int, amount_q decimal(19,4)"),
    }
    for table, (data, columns) in tables.items():
        spark.createDataFrame(data, columns).write.parquet(f"{legacy}/{table}/source_schema=co_a")
    mapped = migration_map(spark, [("co_a", "pay_a", "one", 11, 1)])
    migration = Migration(spark, legacy, str(tmp_path / "target"), mapped, "2026-08-15T10:00:00+02:00")
    for _ in range(2):
        migration.load_employees()
        migration.load_amounts()
    assert migration.existing("employee_amount_earnings") is None
    assert migration.existing("employee_amount_deprecated").count() == 1
    assert migration.existing("employees").first()["salary_current_minor"] == 0


def test_repeated_legacy_number_stops_the_run(spark, tmp_path):
    legacy = str(tmp_path / "legacy")
    spark.createDataFrame([person(1), person(1)], COLUMNS).write.parquet(f"{legacy}/employees/source_schema=co_a")
    mapped = migration_map(spark, [("co_a", "pay_a", "one", 11, 1)])
    migration = Migration(spark, legacy, str(tmp_path / "target"), mapped, "2026-08-15T10:00:00+02:00")
    with pytest.raises(ValueError, match="legacy_empno=1"):
        migration.load_employees()
    assert migration.existing("core_users") is None


def test_changed_code_of_a_known_employee_stops_the_run(spark, tmp_path):
    legacy = str(tmp_path / "legacy")
    spark.createDataFrame([person(1)], COLUMNS).write.parquet(f"{legacy}/employees/source_schema=co_a")
    mapped = migration_map(spark, [("co_a", "pay_a", "one", 11, 1)])
    migration = Migration(spark, legacy, str(tmp_path / "target"), mapped, "2026-08-15T10:00:00+02:00")
    migration.load_employees()
    known = migration.existing("employees").drop("tenant").withColumn("employee_code", F.lit("another"))
    known.coalesce(1).write.parquet(str(tmp_path / "changed/employees/tenant=tenant_one"))
    again = Migration(spark, legacy, str(tmp_path / "changed"), mapped, "2026-08-15T10:00:00+02:00")
    with pytest.raises(ValueError, match="key in use"):
        again.load_employees()
    assert again.existing("core_users") is None


def test_carry_refuses_rows_without_target_columns(spark, tmp_path):
    legacy = str(tmp_path / "legacy")
    spark.createDataFrame([(1, "x")], "ordinalno int, note string").write.parquet(f"{legacy}/settings_calendar/source_schema=007")
    mapped = migration_map(spark, [("co_a", "007", "one", 11, 1)])
    migration = Migration(spark, legacy, str(tmp_path / "target"), mapped, "2026-08-15T10:00:00+02:00")
    with pytest.raises(ValueError, match="settings_calendar"):
        migration.carry_tables()


def test_columns_of_all_companies_are_read(spark, tmp_path):
    legacy = str(tmp_path / "legacy")
    spark.createDataFrame([(1,)], "ordinalno int").write.parquet(f"{legacy}/settings_banks/source_schema=co_a")
    spark.createDataFrame([(1, "b")], "ordinalno int, bank string").write.parquet(f"{legacy}/settings_banks/source_schema=co_b")
    mapped = migration_map(spark, [("co_a", "pay_a", "one", 11, 1), ("co_b", "pay_b", "two", 12, 4)])
    migration = Migration(spark, legacy, str(tmp_path / "target"), mapped, "2026-08-15T10:00:00+02:00")
    found = {r["tenant"]: r["bank"] for r in migration.source("settings_banks").collect()}
    assert found == {"tenant_one": None, "tenant_two": "b"}


AMOUNTS = "employeeno int, ordinalno int, amount_q decimal(19,4)"


def _shared(spark, root, first, second):
    """Two companies of one tenant, each with an employee, codes and one amount of 5.00 for ordinal 1."""
    legacy = str(root / "legacy")
    for company, number, codes in (("co_a", 1, first), ("co_b", 2, second)):
        settings = [(n, d, t, "1", None, "", "", "", "", True, True, True) for n, d, t in codes]
        for table, data, columns in (
            ("employees", [person(number)], COLUMNS),
            ("settings_employee_amounts", settings, SETTINGS),
            ("employee_amounts", [(number, n, Decimal(5)) for n, _, _ in codes], AMOUNTS),
        ):
            spark.createDataFrame(data, columns).write.parquet(f"{legacy}/{table}/source_schema={company}")
    mapped = migration_map(spark, [("co_a", "pay_a", "one", 11, 1), ("co_b", "pay_b", "one", 12, 2)])
    migration = Migration(spark, legacy, str(root / "target"), mapped, "2026-08-15T10:00:00+02:00")
    migration.load_employees()
    return migration


def test_companies_of_one_tenant_keep_their_own_codes(spark, tmp_path, rows):
    migration = _shared(spark, tmp_path, [(1, "zz", "E")], [(1, "aa", "E"), (2, "fund", "D")])
    migration.load_amounts()
    assert rows(migration.existing("employee_amount_earnings"), "id", "label", "amount_minor") == [(1, "zz", 500), (2, "aa", 500)]
    assert rows(migration.existing("employee_amount_deductions"), "label", "amount_minor") == [("fund", 500)]
    assert rows(migration.existing("employees"), "id", "salary_current_minor") == [("emp-1", 500), ("emp-2", 500)]
    # the first route's code wins although the other is smaller
    assert rows(migration.existing("settings_employee_amounts"), "ordinal_no", "name") == [(1, "zz"), (2, "fund")]


def test_repeated_ordinal_of_a_company_stops_the_run(spark, tmp_path):
    migration = _shared(spark, tmp_path, [(1, "a", "E"), (1, "b", "E")], [(1, "c", "E")])
    with pytest.raises(ValueError, match="ordinalno=1"):
        migration.load_amounts()
    assert migration.existing("employee_amount_earnings") is None


def test_salaries_of_other_tenants_stay(spark, tmp_path, rows):
    migration = _shared(spark, tmp_path, [(1, "a", "E")], [(1, "b", "E")])
    known = migration.existing("employees").drop("tenant").withColumn("salary_current_minor", F.lit(7).cast("long"))
    known.write.parquet(f"{migration.path('employees')}/tenant=tenant_other")
    migration.load_amounts()
    found = rows(migration.existing("employees"), "tenant", "salary_current_minor")
    assert found == [("tenant_one", 500)] * 2 + [("tenant_other", 7)] * 2
