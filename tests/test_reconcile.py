"""The dictionary as registry, companies that differ in columns, and what is not carried."""

import datetime
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from shiftroll.operators import reconcile
from shiftroll.operators.carried_tables import CARRIED
from shiftroll.operators.carry import DICTIONARY_SCHEMA, DICTIONARY_TYPES, DictionaryColumn, carry_table, registry_of, require_known_columns
from shiftroll.operators.naming import target_name
from shiftroll.params import RunParams
from shiftroll.plans.migrate import Migration
from shiftroll.sources.routes import migration_map, route_params
from shiftroll.sources.tables import read_columns_csv, read_dictionary, write_columns_csv
from tests.test_carry import own_columns
from tests.test_migration import columns_list

VALUES = {
    "BOOLEAN": True, "TINYINT": 1, "SMALLINT": 2, "INTEGER": 3, "BIGINT": 4, "DOUBLE": 1.5, "MONEY": Decimal("1.2345"),
    "ACCURATE": Decimal("0.0123456789"), "GUESS": Decimal("9.125"), "TEXT": "t", "DATE": datetime.date(2020, 1, 2),
    "DATETIME": datetime.datetime(2020, 1, 2, 3), "TIMESTAMP_NOZ": datetime.datetime(2020, 1, 2, 4),
    "TIMESTAMP_TZ": datetime.datetime(2020, 1, 2, 5, tzinfo=datetime.UTC),
}


def described(spec):
    """Every carried table: its key, the employee number where an id is its key, and a column of every type."""
    linked = [DictionaryColumn("EmployeeNo", "INTEGER")] if spec.auto_key and spec.table != "ratef" else []
    return [*own_columns(spec), *linked, *[DictionaryColumn(f"{t.title()}Value1", t) for t in VALUES]]


def rows_of(spec):
    return [
        (spec.table, spec.source.upper(), True, i, c.name, c.type, c.key_pos) for i, c in enumerate(described(spec))
    ]


@pytest.fixture(scope="module")
def dictionary(spark):
    extra = [
        ("system_table", "SYSTEM", True, 0, "A", "TEXT", 1),
        ("settings_leftover", "COMPANY", False, 0, "A", "TEXT", 1),
        ("employee_alpha", "COMPANY", True, 0, "EmployeeNo", "INTEGER", 1),
    ]
    return spark.createDataFrame([r for spec in CARRIED.values() for r in rows_of(spec)] + extra, DICTIONARY_SCHEMA)


def test_registry_of_all_tables(spark, dictionary, tmp_path):
    dictionary.write.option("header", True).csv(str(tmp_path / "dictionary"))
    registry = registry_of(read_dictionary(spark, str(tmp_path / "dictionary")))
    assert set(registry) == set(CARRIED)
    assert sum(len(t.columns) for t in registry.values()) >= 1041
    for name, table in registry.items():
        assert table.spec == CARRIED[name]
        columns = described(table.spec)
        gained = [c for c in table.columns if c.part == "gained"]
        assert len(gained) == (table.spec.source == "payroll" and "Payroll" not in [c.name for c in columns])
        assert [(c.source, c.target) for c in table.columns if c.source] == [
            (c.name.lower(), target_name(c.name, "AutoNumber")) for c in columns
        ]
        types = {c.source: c.type for c in table.columns if c.part == "plain"}
        assert all(types[c.name.lower()] == DICTIONARY_TYPES[c.type] for c in columns if c.name.lower() in types)
        assert set(table.spec.keys) <= set(table.target.names)


def test_a_key_that_differs_from_the_known_one_is_an_error(spark):
    rows = [("settings_banks", "COMPANY", True, 0, "BankName", "TEXT", 1)]
    with pytest.raises(ValueError, match="settings_banks"):
        registry_of(spark.createDataFrame(rows, DICTIONARY_SCHEMA))


def test_all_tables_end_to_end(spark, dictionary, tmp_path):
    """A run over all carried tables that knows nothing but the dictionary."""
    legacy, target = tmp_path / "legacy", str(tmp_path / "target")
    for spec in CARRIED.values():
        schema = "co_a" if spec.source == "company" else "pay_a"
        columns = [c for c in described(spec)]
        data = {c.name.lower(): [VALUES.get(c.type, 1)] * 2 for c in columns}
        for c in columns:
            if c.key_pos or c.name == "EmployeeNo":
                data[c.name.lower()] = ["k", "k"] if c.type == "TEXT" else [1, 1]
        folder = legacy / spec.table / f"source_schema={schema}"
        folder.mkdir(parents=True)
        money = {"MONEY": pa.decimal128(19, 4), "ACCURATE": pa.decimal128(19, 10), "GUESS": pa.decimal128(9, 3)}
        arrays = [pa.array(data[c.name.lower()], type=money.get(c.type)) for c in columns]
        pq.write_table(pa.Table.from_arrays(arrays, [c.name.lower() for c in columns]), folder / "part.parquet", coerce_timestamps="us")
    spark.createDataFrame([("emp-1", 77)], "id string, user_id long").write.parquet(f"{target}/employees/tenant=tenant_one")
    mapped = migration_map(spark, [("co_a", "pay_a", "one", 11, 5)])
    migration = Migration(spark, str(legacy), target, mapped, "2026-08-15T10:00:00+02:00", 1, dictionary)
    migration.carry_tables()
    for name, table in migration.registry.items():
        found = migration.existing(name).collect()
        assert len(found) == (1 if table.spec.keys else 2), name
        assert set(found[0].asDict()) == {*table.target.names, "tenant"}
        assert all(found[0][c.target] is not None for c in table.columns), name
        assert all(found[0][c.target] == 77 for c in table.columns if c.part == "link")
        assert all(found[0][c.target] == 5 for c in table.columns if c.part == "gained")
    assert migration.existing("report_not_carried") is None
    assert {t: d.first()["next_id"] for t, d in migration.next_ids().items()} == {t: 2 for t, s in CARRIED.items() if s.auto_key}


BANKS = [("settings_banks", "COMPANY", True, i, c, "TEXT", 1 - min(i, 1)) for i, c in enumerate(["BranchCode", "BankName", "BranchName"])]
HISTORY = [
    ("run_history", "PAYROLL", True, i, c, t, k)
    for i, (c, t, k) in enumerate([("RunYear", "SMALLINT", 1), ("RunPeriod", "SMALLINT", 2), ("EmployeeNo", "INTEGER", 3), ("Payroll", "INTEGER", 0)])
]


@pytest.fixture
def two_companies(spark, tmp_path):
    """Company a has no branch name, company b has one column too many, and c is not mapped."""
    legacy = str(tmp_path / "legacy")

    def put(table, schema, rows, columns):
        spark.createDataFrame(rows, columns).write.parquet(f"{legacy}/{table}/source_schema={schema}")

    put("settings_banks", "co_a", [("1", "z", None), ("2", "y", None)], "branchcode string, bankname string, _updated_on string")
    put("settings_banks", "co_b", [("1", "a", "n", 3.5), ("3", "x", "m", None)], "branchcode string, bankname string, branchname string, fee double")
    put("settings_banks", "co_c", [("9", "a")], "branchcode string, other string")
    put("run_history", "pay_a", [(2020, 1, 1), (2020, 1, 8)], "runyear int, runperiod int, employeeno int")
    put("run_history", "pay_b", [(2020, 2, 1, 6)], "runyear int, runperiod int, employeeno int, payroll int")
    target = str(tmp_path / "target")
    spark.createDataFrame([("emp-1", 77)], "id string, user_id long").write.parquet(f"{target}/employees/tenant=tenant_one")
    listed = [("co_a", "settings_banks", c) for c in ("branchcode", "BANKNAME")]
    listed += [("co_b", "settings_banks", c) for c in ("branchcode", "bankname", "branchname", "fee")]
    listed += [("pay_a", "run_history", c) for c in ("runyear", "runperiod", "employeeno")]
    listed += [("pay_b", "run_history", c) for c in ("runyear", "runperiod", "employeeno", "payroll")]
    mapped = migration_map(spark, [("co_b", "pay_b", "one", 12, 2), ("co_a", "pay_a", "one", 11, 1)])
    dictionary = spark.createDataFrame(BANKS + HISTORY, DICTIONARY_SCHEMA)
    return Migration(spark, legacy, target, mapped, "2026-08-15T10:00:00+02:00", 1, dictionary, columns_list(spark, listed))


def test_companies_that_differ_in_columns(two_companies, rows):
    two_companies.carry_tables()
    # branch 1 is the earlier route's, although the other row is smaller
    assert rows(two_companies.existing("settings_banks"), "branch_code", "bank_name", "branch_name") == [
        ("1", "z", None), ("2", "y", None), ("3", "x", "m"),
    ]
    # the payroll that a company lacks is its route's number
    assert rows(two_companies.existing("run_history"), "run_period", "employee_id", "payroll") == [(1, 77, 1), (2, 77, 6)]
    report = two_companies.existing("report_not_carried")
    assert rows(report, "tenant", "source_schema", "table_name", "column_name", "reason", "row_count") == [
        ("tenant_one", "co_b", "settings_banks", "fee", "no_target_column", 1),
        ("tenant_one", "pay_a", "run_history", None, "employee_not_loaded", 1),
    ]


def test_a_column_lost_on_the_way_stops_the_run(spark, two_companies):
    more = columns_list(spark, [("co_a", "settings_banks", "branchname")])
    two_companies.listed = two_companies.listed.unionByName(more)
    with pytest.raises(ValueError, match="co_a lists column branchname"):
        two_companies.carry_tables()
    assert two_companies.existing("settings_banks") is None


def test_without_a_list_nothing_may_be_missing(two_companies):
    two_companies.listed = None
    with pytest.raises(ValueError, match="column"):
        two_companies.carry_tables()


def test_a_target_column_without_a_source_stops_the_run(spark, two_companies, rows):
    spark.createDataFrame([("0", "b", "c")], "branch_code string, bank_name string, colour string").write.parquet(
        f"{two_companies.path('settings_banks')}/tenant=tenant_one"
    )
    with pytest.raises(ValueError, match="colour"):
        two_companies.carry_tables()
    assert two_companies.existing("run_history") is None
    require_known_columns(two_companies.registry["settings_banks"], None)


def test_drift_of_a_run(spark, two_companies, rows):
    two_companies.report_drift()
    found = spark.read.json(two_companies.path("report_drift"))
    assert rows(found, "table_name", "column_name", "kind") == [("settings_banks", "fee", "unexpected_column")]


def test_column_list_survives_its_file(spark, two_companies, tmp_path, rows):
    write_columns_csv(two_companies.listed, str(tmp_path / "list"))
    again = read_columns_csv(spark, str(tmp_path / "list"))
    assert rows(again) == rows(two_companies.listed)
    absent = reconcile.absent_columns(two_companies.registry, again)
    assert absent == {"settings_banks": {"branchname": frozenset({"co_a"})}, "run_history": {"payroll": frozenset({"pay_a"})}}


def test_nothing_lost_gives_no_report(spark, rows):
    registry = registry_of(spark.createDataFrame(BANKS, DICTIONARY_SCHEMA))
    src = spark.createDataFrame([("co", "1", "b", "n", "late")], "source_schema string, branchcode string, bankname string, branchname string, _updated_on string")
    assert reconcile.not_carried(src, registry["settings_banks"], None).count() == 0
    p = RunParams(cutover="2026-08-15T10:00:00+02:00")
    assert rows(carry_table(src, registry["settings_banks"], None, None, p)) == [("1", "b", "n")]
    assert route_params("x", 1).scope == ("tenant",)
