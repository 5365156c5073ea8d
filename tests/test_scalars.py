from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftroll.functions import scalars as S


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "amount, cents",
    [("12.3450", 1235), ("-12.3450", -1235), ("12.3449", 1234), ("0.0050", 1), ("-0.0050", -1), ("0.0049", 0),
     ("999999999999999.9950", 100000000000000000), (None, None)],
)
def test_to_minor_rounds_half_away_from_zero(spark, amount, cents):
    value = F.lit(Decimal(amount) if amount else None).cast("decimal(19,4)")
    assert one(spark, S.to_minor(value)) == cents


def test_to_minor_or_zero(spark):
    assert one(spark, S.to_minor_or_zero(F.lit(None).cast("decimal(19,4)"))) == 0


def test_text_rules(spark):
    assert one(spark, S.blank_to_null(F.lit(""))) is None
    assert one(spark, S.upper_or_null(F.lit("za"))) == "ZA"
    assert one(spark, S.first_chars(F.lit("zarx"), 3)) == "zar"
    assert one(spark, S.email_or_synthetic(F.lit(""), F.lit(1007))) == "1007@migrated.invalid"
    assert one(spark, S.email_or_synthetic(F.lit(None).cast("string"), F.lit(7))) == "7@migrated.invalid"
    assert one(spark, S.employee_ref(F.lit(7))) == "emp-7"
    assert one(spark, S.employee_ref(F.lit(None).cast("int"))) is None


@pytest.mark.parametrize("value, expected", [(-5, 0), (0, 0), (64, 50), (12, 12)])
def test_clamp(spark, value, expected):
    assert one(spark, S.clamp(F.lit(value), 0, 50)) == expected


def test_flag_counts_null_as_no(spark):
    assert [one(spark, S.flag(F.lit(v).cast("boolean"))) for v in (True, False, None)] == [1, 0, 0]


@pytest.mark.parametrize(
    "employee_id, number", [("emp-12", 12), ("emp-0", 0), ("emp-007", None), ("emp-x", None), ("app-5", None)]
)
def test_legacy_number_undoes_employee_ref(spark, employee_id, number):
    assert one(spark, S.legacy_number(F.lit(employee_id), T.LongType())) == number


def test_legacy_number_of_text_numbers(spark):
    assert one(spark, S.legacy_number(F.lit("emp-007"), T.StringType())) == "007"
    assert one(spark, S.legacy_number(F.lit("other"), T.StringType())) is None


def test_dates(spark):
    assert one(spark, S.iso_date(F.lit("2026-08-15 10:00:00").cast("timestamp_ntz"))) == "2026-08-15"
    assert one(spark, S.iso_date(S.month_start(F.to_date(F.lit("2026-08-15T10:00:00+02:00"))))) == "2026-08-01"
