import csv
from decimal import Decimal
from pathlib import Path

from shiftroll.operators import export
from tests.test_employees import COLUMNS, person


def inputs(spark):
    people = spark.createDataFrame(
        [person(2, emailaddress_f40="", identity_f12=None), person(1, taxcountrycode_f14="ke"), person(10)], COLUMNS
    )
    settings = spark.createDataFrame([(1, "BASIC"), (2, "RA"), (3, "BONUS")], "ordinalno int, description string")
    amounts = spark.createDataFrame(
        [(1, 1, Decimal("10.0050")), (1, 1, Decimal("1")), (1, 3, Decimal("99")), (2, 2, Decimal("5.5")), (1, 8, Decimal("7"))],
        "employeeno int, ordinalno int, amount_q decimal(19,4)",
    )
    return people, amounts, settings


def test_slots(spark, rows):
    got = export.export_import_rows(*inputs(spark))
    assert got.columns == [
        "employee_code", "first_name", "last_name", "email", "hired_at", "id_number", "salary_minor", "currency",
        "allowance_travel_minor", "allowance_housing_minor", "allowance_cell_minor", "deduction_retirement_minor",
        "deduction_medical_minor",
    ]
    assert rows(got, "employee_code", "salary_minor", "deduction_retirement_minor", "currency") == [
        (1001, 1101, 0, "KE"), (1002, 0, 550, "ZA"), (1010, 0, 0, "ZA"),
    ]


def test_csv_is_sorted_with_header(spark, tmp_path):
    path = tmp_path / "out"
    export.export_import_csv(*inputs(spark), str(path))
    parts = sorted(Path(path).glob("part-*.csv"))
    lines = [row for part in parts for row in csv.reader(part.open())]
    header = lines[0]
    body = [dict(zip(header, row, strict=True)) for row in lines if row != header]
    assert [r["employee_code"] for r in body] == ["1001", "1002", "1010"]
    assert body[1]["email"] == "1002@migrated.invalid"
    assert body[1]["id_number"] == ""
