import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftroll.operators.carried_tables import CARRIED, NOT_CARRIED
from shiftroll.operators.carry import (
    DICTIONARY_TYPES,
    CarriedTable,
    DictionaryColumn,
    carry_table,
    fill_missing,
    plan_from_dictionary,
    unlinked_rows,
)
from shiftroll.operators.naming import RESERVED_WORDS, normalise_columns, snake_case, target_name, target_names
from shiftroll.sources.standins import DICTIONARY


@pytest.fixture
def people(spark):
    return spark.createDataFrame([("emp-1", 101), ("emp-2", 102)], "id string, user_id long")


def test_inventory():
    assert len(CARRIED) == 98
    assert sum(s.source == "company" for s in CARRIED.values()) == 63
    modules = [s.module for s in CARRIED.values()]
    assert [modules.count(m) for m in ("core", "za", "neighbour", "zw")] == [60, 21, 16, 1]
    assert sum(s.auto_key for s in CARRIED.values()) == 6
    assert [s.table for s in CARRIED.values() if not s.keys] == ["settings_zaf_uif_company"]
    assert not set(NOT_CARRIED) & set(CARRIED)


def described(table, *columns):
    """The table with these dictionary columns (name, type, place in the key) and its known key."""
    plan = plan_from_dictionary(table, CARRIED[table].source, [DictionaryColumn(*c) for c in columns])
    assert plan.spec.keys == CARRIED[table].keys
    return CarriedTable(CARRIED[table], plan.columns)


def raw_name(target):
    """A dictionary name that becomes the target name."""
    fixed = {"id": "AutoNumber", "employee_id": "EmployeeNo", "row_no": "Row"}
    return fixed.get(target) or "".join(part.capitalize() for part in target.split("_"))


def own_columns(spec):
    """The key columns of a table as its dictionary has them."""
    numbers = {"id": "AUTO_KEY", "employee_id": "INTEGER", "payroll": "INTEGER"}
    gained = spec.source == "payroll" and "payroll" in spec.keys[:-1]
    keys = [k for k in spec.keys if not (gained and k == "payroll")]
    columns = [DictionaryColumn(raw_name(k), numbers.get(k, "TEXT"), i + 1) for i, k in enumerate(keys)]
    if spec.source == "payroll" and "payroll" not in spec.keys and not spec.auto_key:
        columns.append(DictionaryColumn("Payroll", "INTEGER"))
    return columns


@pytest.mark.parametrize("table", list(CARRIED))
def test_every_table_is_carried(spark, people, params, table, rows):
    spec = CARRIED[table]
    columns = own_columns(spec)
    if spec.auto_key:
        columns.append(DictionaryColumn("EmployeeNo", "INTEGER"))
    plan = plan_from_dictionary(table, spec.source, [*columns, DictionaryColumn("NoteText", "TEXT")])
    assert plan.spec.keys == spec.keys

    def row(key, note):
        return tuple(note if c == "notetext" else key for c in plan.sources)

    named = ", ".join(f"{c} string" if c == "notetext" else f"{c} int" for c in plan.sources)
    src = spark.createDataFrame([row(1, "b"), row(1, "a"), row(2, "c"), row(9, "d")], named)
    got = carry_table(src, plan, people, None, params)
    assert got.columns == plan.target.names
    linked = "employee_id" in plan.target.names
    found = got.collect()
    expected = ["a", "b", "c", "d"] if not spec.keys else ["a", "c", "d"]
    assert sorted(r["note_text"] for r in found) == [n for n in expected if not (linked and n == "d")]
    if linked:
        assert {r["employee_id"] for r in found} == {101, 102}


def test_second_carry_adds_nothing(spark, people, params):
    plan = described("employee_interim_items", ("EmployeeNo", "INTEGER", 1), ("OrdinalNo", "INTEGER", 2), ("QmfCode", "TEXT"))
    src = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (2, 1, "c")], "employeeno int, ordinalno int, qmfcode string")
    first = carry_table(src, plan, people, None, params)
    assert first.count() == 2
    assert carry_table(src, plan, people, first, params).count() == 0


CALCS = [("Payroll", "INTEGER", 1), ("ReportNo", "INTEGER", 2), ("OrdinalNo", "INTEGER", 3), ("CalcTime", "TEXT"), ("Op1_N", "INTEGER")]


def test_missing_columns_are_filled(spark, params, rows):
    plan = described("settings_report_calcs", *CALCS)
    src = spark.createDataFrame([(1, 2, 3)], "reportno int, ordinalno int, op1_n int")
    absent = {"payroll": None, "calctime": None}
    assert rows(fill_missing(src, plan, params, absent)) == [(1, 1, 2, None, 3)]


def test_a_missing_column_must_be_listed(spark, params):
    plan = described("settings_report_calcs", *CALCS)
    src = spark.createDataFrame([(1, 2, 3)], "reportno int, ordinalno int, op1_n int")
    with pytest.raises(ValueError, match="calctime"):
        fill_missing(src, plan, params, {"payroll": None})


def test_own_payroll_column_wins(spark, params, rows):
    plan = plan_from_dictionary(
        "settings_exceptions", "payroll", [DictionaryColumn("Payroll", "INTEGER", 1), DictionaryColumn("OrdinalNo", "INTEGER", 2), DictionaryColumn("Mess", "TEXT")]
    )
    src = spark.createDataFrame([(5, 2, "m")], "payroll int, ordinalno int, mess string")
    assert rows(carry_table(src, plan, None, None, params)) == [(5, 2, "m")]


def test_reserved_word_and_employee_code(spark, people, params, rows):
    plan = described("settings_table_values", ("OrdinalNo", "INTEGER", 1), ("Row", "INTEGER", 2), ("Item", "TEXT"))
    src = spark.createDataFrame([(1, 4, "i")], "ordinalno int, row int, item string")
    assert rows(carry_table(src, plan, None, None, params)) == [(1, 1, 4, "i")]
    plan = described("run_history", *HISTORY, ("EmployeeId", "TEXT"))
    src = spark.createDataFrame([(2020, 1, 2, 1, "c")], "runyear int, runperiod int, employeeno int, payroll int, employeeid string")
    assert rows(carry_table(src, plan, people, None, params)) == [(2020, 1, 102, 1, "c")]


HISTORY = [("RunYear", "SMALLINT", 1), ("RunPeriod", "SMALLINT", 2), ("EmployeeNo", "INTEGER", 3), ("Payroll", "INTEGER")]


def test_number_column_under_its_other_name(spark, people, params, rows):
    plan = described("zaf_sars_work", ("EmpNo", "INTEGER", 1), ("Surname", "TEXT"))
    src = spark.createDataFrame([(1, "s"), (7, "t")], "empno int, surname string")
    assert rows(carry_table(src, plan, people, None, params)) == [(101, "s")]
    assert unlinked_rows(src, plan, people).first()["unlinked_rows"] == 1


def test_linked_table_needs_employees(spark, params):
    src = spark.createDataFrame([(1, "s")], "employeeno int, surname string")
    plan = described("zaf_sars_work", ("EmployeeNo", "INTEGER", 1), ("Surname", "TEXT"))
    with pytest.raises(ValueError):
        carry_table(src, plan, None, None, params)
    with pytest.raises(ValueError, match="employeeno"):
        carry_table(src.drop("employeeno"), plan, None, None, params, {"employeeno": None})


def test_key_collision_across_payrolls_is_skipped(spark, people, params, rows):
    """The history key leaves the payroll out: the second payroll's row is lost, as the key list says."""
    plan = described("run_history", *HISTORY)
    src = spark.createDataFrame([(2020, 1, 1, 2), (2020, 1, 1, 1)], "runyear int, runperiod int, employeeno int, payroll int")
    assert rows(carry_table(src, plan, people, None, params)) == [(2020, 1, 101, 1)]


def test_dictionary_plans():
    for table, (source, columns) in DICTIONARY.items():
        plan = plan_from_dictionary(table, source, columns)
        assert plan.spec.keys == CARRIED[table].keys, table
        assert plan.spec.source == CARRIED[table].source
        assert len(set(plan.target.names)) == len(plan.target.names)
    audit = plan_from_dictionary("pay_run_tax_audit", *DICTIONARY["pay_run_tax_audit"]).target
    assert audit["report_section"].dataType == T.StringType()
    money = plan_from_dictionary("t", "company", [DictionaryColumn("A", "MONEY"), DictionaryColumn("B", "GUESS")]).target
    assert [f.dataType.simpleString() for f in money.fields] == ["decimal(19,4)", "decimal(9,3)"]
    assert len(DICTIONARY_TYPES) == 15


@pytest.mark.parametrize(
    "raw, name",
    [("EmployeeNo", "employee_id"), ("EmpNo", "employee_id"), ("EmployeeId", "employee_code"), ("Row", "row_no"),
     ("OrdinalNo", "ordinal_no"), ("Op1_A", "op1_a"), ("UIFCoNo", "uif_co_no"), ("IncludeZeroPayCurrentEEs", "include_zero_pay_current_e_es"),
     ("A__B", "a_b"), ("Default", "default_no"), ("plain", "plain")],
)
def test_target_names(raw, name):
    assert target_name(raw) == name


def test_names_must_stay_distinct(spark):
    with pytest.raises(ValueError, match="employee_id"):
        target_names(["EmployeeNo", "EmpNo"])
    with pytest.raises(ValueError):
        normalise_columns(spark.range(1).select(F.lit(1).alias("OrdinalNo"), F.lit(2).alias("Ordinal_No")))
    assert normalise_columns(spark.range(1).toDF("AutoNumber"), auto_key="AutoNumber").columns == ["id"]
    assert snake_case("HTTPServer2X") == "http_server2_x"
    assert len(RESERVED_WORDS) == 42
