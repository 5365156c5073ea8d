import datetime
from decimal import Decimal

import pytest

from shiftroll.operators import derive, slots
from tests.test_employees import COLUMNS, person

DAY = datetime.date


@pytest.fixture
def people(spark):
    return spark.createDataFrame([("emp-1", 101), ("emp-2", 102)], "id string, user_id long")


def test_slot_settings(spark, rows):
    settings = spark.createDataFrame(
        [(1, "b", "d", "c", Decimal(2)), (1, "a", "d", "c", Decimal(1)), (2, "x", None, None, None)],
        "ordinalno int, alphaname string, description string, codetype string, codelimit decimal(19,4)",
    )
    known = spark.createDataFrame([(2,)], "ordinal_no int")
    assert rows(slots.import_slot_settings("alpha", settings, None)) == [(1, "a"), (2, "x")]
    assert rows(slots.import_slot_settings("dates", settings, known)) == [(1, "d")]
    assert rows(slots.import_slot_settings("precision", settings, known)) == [(1, "d", "c", Decimal("1.0000"))]


def test_slot_values(spark, people, rows):
    values = spark.createDataFrame(
        [(1, 1, "b", DAY(2020, 1, 2), Decimal("1.0000000001")), (1, 1, "a", None, Decimal(5)), (2, 3, "c", None, None),
         (9, 1, "orphan", None, None)],
        "employeeno int, ordinalno int, reference_v string, date_d0 date, amount_m decimal(19,10)",
    )
    assert rows(slots.import_alpha(values, people)) == [(101, 1, "a"), (102, 3, "c")]
    assert rows(slots.import_dates(values, people)) == [(101, 1, None), (102, 3, None)]
    assert rows(slots.import_precision(values, people))[0] == (101, 1, Decimal("1.0000000001"))
    known = spark.createDataFrame([(102, 3)], "employee_id long, ordinal_no int")
    assert rows(slots.import_alpha(values, people, known)) == [(101, 1, "a")]


def test_thirdparty(spark, people, rows):
    payments = spark.createDataFrame(
        [(1, 1, "k", Decimal("1.005"), "P", None, "F", Decimal("2"), None, DAY(2021, 2, 3), "r")],
        "employeeno int, ordinalno int, agentkey string, agenthandlingfee decimal(19,4), agenthandlingfeetype string, "
        "employerhandlingfee decimal(19,4), employerhandlingfeetype string, monthlydeductionamount decimal(19,4), "
        "stopindicator boolean, thirdpartydate date, thirdpartyreference string",
    )
    assert rows(slots.import_thirdparty(payments, people)) == [
        (101, 1, "k", 101, "P", 0, "F", 200, 0, "2021-02-03", "r")
    ]


def test_bank_details(spark, people, params, rows):
    accounts = spark.createDataFrame(
        [(2, 1, "", None, None, None, "", "m", "s", "p", "h", True, "i"),
         (1, 2, "9", "n", "1", "b", "usd", "m", "s", "p", "h", None, "i"),
         (1, 1, "9", "n", "1", "b", "zarx", "m", "s", "p", "h", False, "i"),
         (1, 1, "9", "n", "2", "b", None, "m", "s", "p", "h", False, "i"),
         (7, 1, "9", "n", "2", "b", None, "m", "s", "p", "h", False, "i")],
        "employeeno int, ordinalno int, accounttype_g1 string, accountname_g2 string, accountnumber_g3 string, "
        "branchcode_g4 string, accountcurrency_g10 string, paymode_g0 string, sourcebankaccount_g5 string, "
        "splitpaycode_g6 string, accountholderstatus_g7 string, sarsbankaccount_g8 boolean, accountiban_g9 string",
    )
    got = derive.import_bank_details(accounts, people, None, 10, params)
    assert len(got.columns) == 18
    # repeats inside the batch stay
    assert rows(got, "id", "employee_id", "ordinal_no", "account_type", "account_number", "currency", "sars_bank_account") == [
        (11, 101, 1, "9", "1", "ZAR", 0),
        (12, 101, 1, "9", "2", "ZAR", 0),
        (13, 101, 2, "9", "1", "USD", 0),
        (14, 102, 1, "unknown", "", "ZAR", 1),
    ]
    assert derive.import_bank_details(accounts, people, got, 0, params).count() == 0


@pytest.mark.parametrize(
    "country, resident, dependants, kept",
    [("", 1, -5, 0), ("za", 1, None, 0), ("ZAF", 1, 64, 50), ("KEN", 0, 3, 3), (None, 1, 50, 50)],
)
def test_tax_status(spark, people, params, rows, country, resident, dependants, kept):
    legacy = spark.createDataFrame([person(1, taxcountrycode_f14=country, taxdependants_f08=dependants)], COLUMNS)
    got = derive.build_tax_status(legacy, people, None, params)
    assert rows(got, "employee_id", "resident", "dependent_count", "age_band", "effective_from") == [
        (101, resident, kept, "derived", "2020-03-04")
    ]
    assert derive.build_tax_status(legacy, people, got, params).count() == 0


def test_periods(spark, params, rows):
    calendar = spark.createDataFrame(
        [(1, DAY(2026, 7, 31)), (1, DAY(2026, 8, 31)), (1, DAY(2026, 8, 31)), (1, None), (2, DAY(2026, 7, 31)),
         (1, DAY(2026, 6, 30))],
        "payroll int, run_date date",
    )
    payrolls = spark.createDataFrame([(1, "ZA"), (2, "KE")], "id int, country_code string")
    known = spark.createDataFrame([(1, "2026-06-30"), (2, "2026-07-31")], "payroll_id int, period_end string")
    got = derive.build_periods(calendar, payrolls, known, params)
    assert rows(got, "period_start", "period_end", "status", "country_code") == [
        ("2026-07-01", "2026-07-31", "closed", "ZA"),
        ("2026-08-01", "2026-08-31", "open", "ZA"),
        ("2026-08-01", "2026-08-31", "open", "ZA"),
    ]
    # without the payroll there are no periods
    assert derive.build_periods(calendar, payrolls.filter("id = 2"), None, params).count() == 0
