from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shiftroll.operators import amounts as A

SETTINGS = (
    "ordinalno int, description string, codetype string, currency_code string, codelimit decimal(19,4), taxtype string, "
    "taxincasn string, consolcode string, adjustflag string, manualdisplayind boolean, prorataind boolean, "
    "qmfdisplayind boolean"
)


@pytest.fixture
def settings(spark):
    types = {1: "e", 2: "D", 3: "C", 4: "T", 5: "B", 6: "H", 7: "Y", 8: "J", 9: "", 10: None}
    return spark.createDataFrame(
        [
            (n, f"code{n}", t, "1", Decimal("1.005") if n == 1 else None, "", "", "", "", True, False, None)
            for n, t in types.items()
        ],
        SETTINGS,
    )


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [("emp-1", 101, "2020-01-01"), ("emp-2", 102, "2021-01-01"), ("x", 5, None)],
        "id string, user_id long, hired_at string",
    )


@pytest.fixture
def staged(spark, settings, people):
    rows = [
        (1, 1, "12.3450"), (1, 1, "-12.3450"), (1, 2, "1"), (1, 3, "2"), (1, 4, "7.1234"), (1, 5, "3"), (1, 6, "12.45"),
        (1, 7, "4"), (2, 8, "5"), (1, 9, "6"), (1, 10, "6.5"), (1, 99, "7"), (3, 1, "8"), (3, 99, "9"), (1, 1, "0"),
        (1, 2, None), (2, 3, "2"), (2, 3, "1"),
    ]
    amounts = spark.createDataFrame(
        [(e, o, Decimal(a) if a else None) for e, o, a in rows], "employeeno int, ordinalno int, amount_q decimal(19,4)"
    )
    return A.stage_amounts(amounts, settings, people)


def test_catalogue(spark, settings, rows):
    known = spark.createDataFrame([(2,)], "ordinal_no int")
    got = A.import_catalogue(settings, known)
    assert got.count() == 9
    assert rows(got.filter("ordinal_no in (1, 9)"), "ordinal_no", "code_type", "code_limit_minor", "manual_display",
                "prorata", "qmf_display") == [(1, "E", 101, 1, 0, 0), (9, None, 0, 1, 0, 0)]


def test_zero_and_missing_amounts_are_dropped(staged):
    assert staged.count() == 16


def test_routes(staged, params, rows):
    assert rows(A.route_earnings(staged, 10, params), "id", "employee_id", "amount_minor", "effective_from") == [
        (11, 101, -1235, "2020-01-01"),
        (12, 101, 1235, "2020-01-01"),
    ]
    assert rows(A.route_deductions(staged, 0, params), "id", "label", "reduces_taxable") == [(1, "code2", 0)]
    assert rows(A.route_employer_cost(staged, None)) == [(101, 3, 200), (102, 3, 100)]
    assert rows(A.route_balances(staged, None)) == [(101, 4, Decimal("7.1234")), (101, 5, Decimal("3.0000"))]
    assert rows(A.route_ytd(staged, params), "tenant", "legacy_empno", "code", "amount_minor") == [
        ("tenant_a", "1", "code7", 400)
    ]
    assert rows(A.route_deprecated(staged, None)) == [(101, 6, 1245, "H"), (102, 8, 500, "J")]
    assert rows(A.quarantine_unknown(staged, params), "code", "amount_minor") == [
        ("code10", 650), ("code9", 600), (None, 700),
    ]
    # an orphan with an unknown code shows up once, as an orphan
    assert rows(A.quarantine_orphans(staged, params), "legacy_empno", "codetype", "amount_minor") == [
        ("3", "E", 800), ("3", None, 900),
    ]


def test_every_staged_row_has_one_destination(staged):
    routed = A.route(staged)
    assert routed.filter(F.col("destination").isNull()).count() == 0
    for name, condition in A.destinations().items():
        assert routed.filter(condition & (F.col("destination") != name)).count() == 0
    totals = A.routing_summary(staged).agg(F.sum("row_count"), F.sum("amount_minor")).first()
    assert tuple(totals) == tuple(staged.agg(F.count("*"), F.sum("amount_minor")).first())


def test_routes_read_a_table_with_destinations_alike(staged, params, rows):
    routed = A.route(staged)
    assert rows(A.route_balances(routed, None)) == rows(A.route_balances(staged, None))
    assert rows(A.routing_summary(routed)) == rows(A.routing_summary(staged))


def test_known_slots_are_skipped(staged):
    first = A.route_balances(staged, None)
    assert A.route_balances(staged, first).count() == 0


def test_salary(spark, rows):
    people = spark.createDataFrame(
        [("emp-1", 101, 9), ("emp-2", 102, 9), ("app", 103, 9)], "id string, user_id long, salary_current_minor long"
    )
    earnings = spark.createDataFrame([(101, 5), (101, 6), (103, 7)], "employee_id long, amount_minor long")
    assert rows(A.refresh_salary(people, earnings)) == [("app", 103, 9), ("emp-1", 101, 11), ("emp-2", 102, 0)]


def test_conservation_through_the_keyed_inserts(spark, rows):
    columns = "origin string, employee_id long, legacy_empno string, ordinal_no int, name string, amount_minor long, amount_raw decimal(19,4), codetype string"
    staged = spark.createDataFrame(
        [("a", 1, "1", 1, "x", m * 100, Decimal(m), t) for m, t in ((9, "B"), (9, "B"), (3, "T"))]
        + [("b", 1, "1", 1, "x", 100, Decimal(1), "B"), ("a", 1, "1", 2, "x", 200, Decimal(2), "H"),
           ("a", 2, "2", 5, "x", 500, Decimal(5), "C"), ("a", 2, "2", 6, "x", 600, Decimal(6), "E"),
           ("a", None, "3", 6, "x", 700, Decimal(7), "E")],
        columns,
    )
    known = spark.createDataFrame([(1, 2)], "employee_id long, ordinal_no int")
    outcomes = A.keyed_outcomes(staged, {"deprecated": known, "balances": None, "employer_cost": None}, (), ("origin",))
    skipped = A.skipped_amounts(outcomes)
    assert rows(skipped, "destination", "origin", "codetype", "amount_minor", "skipped_rows", "held_by", "held_amount") == [
        ("balances", "a", "B", 900, 2, "batch", Decimal("3.0000")),
        ("balances", "b", "B", 100, 1, "batch", Decimal("3.0000")),
        ("deprecated", "a", "H", 200, 1, "target", None),
    ]
    summary = A.conservation(staged, outcomes)
    assert rows(summary, "destination", "codetype", "staged_rows", "added_rows", "skipped_rows", "skipped_minor") == sorted(
        [("balances", "B", 3, 0, 3, 1900), ("balances", "T", 1, 1, 0, 0), ("deprecated", "H", 1, 0, 1, 200),
         ("earnings", "E", 1, 1, 0, 0), ("employee_not_loaded", "E", 1, 1, 0, 0), ("employer_cost", "C", 1, 1, 0, 0)], key=repr
    )
    added = A.route_balances(staged, None, (), ("origin",))
    assert rows(added) == [(1, 1, Decimal("3.0000"))]


def test_outcomes_evaluate_the_staged_rows_once(spark, tmp_path, rows):
    columns = "employee_id long, legacy_empno string, ordinal_no int, name string, amount_minor long, amount_raw decimal(19,4), codetype string"
    made = [(e % 3, "1", 1, "x", e * 100, Decimal(e), "B") for e in range(9)]
    spark.createDataFrame(made, columns).write.parquet(str(tmp_path / "staged"))
    spark.createDataFrame([(2, 1), (2, 1), (7, 1), (None, 1)], "employee_id int, ordinal_no long").write.parquet(str(tmp_path / "known"))
    staged, known = (spark.read.parquet(str(tmp_path / t)) for t in ("staged", "known"))
    outcomes = A.keyed_outcomes(staged, {"balances": known, "deprecated": None, "employer_cost": None})
    # what reads the written groups instead doesn't join and shuffle the staged rows again
    assert not [f for f in outcomes.inputFiles() if f"{tmp_path}/staged" in f]
    assert rows(outcomes, "employee_id", "amount_minor", "added_rows", "skipped_rows", "held_by") == sorted(
        [(e % 3, e * 100, int(e < 2), int(e >= 2), "target" if e % 3 == 2 else "batch") for e in range(9)], key=repr
    )
