"""Column helpers shared by the operators.  All stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
EMPLOYEE_ID_PREFIX = "emp-"
SYNTHETIC_EMAIL_SUFFIX = "@migrated.invalid"
MONEY_TYPE = "decimal(19,4)"
MINOR_PER_MAJOR = 100


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def blank_to_null(col: str | Column) -> Column:
    return F.nullif(_c(col), F.lit(""))


def upper_or_null(col: str | Column) -> Column:
    """Upper-cased text, NULL when blank."""
    return F.upper(blank_to_null(col))


def to_minor(col: str | Column) -> Column:
    """Money to whole cents, rounding half away from zero.

    The amount goes through a decimal first: a double would round 1.005 down.
    A cast between decimals rounds half up, a cast to a whole number cuts off.
    """
    cents = _c(col).cast(MONEY_TYPE) * F.lit(MINOR_PER_MAJOR)
    return cents.cast("decimal(20,0)").cast("long")


def to_minor_or_zero(col: str | Column) -> Column:
    return F.coalesce(to_minor(col), F.lit(0).cast("long"))


def flag(col: str | Column) -> Column:
    """Boolean to 1/0, NULL counting as 0."""
    return F.when(_c(col), F.lit(1)).otherwise(F.lit(0))


def first_chars(col: str | Column, n: int) -> Column:
    return F.substring(_c(col), 1, n)


def iso_date(col: str | Column) -> Column:
    """Date as ISO text; the modernised tables keep dates as text."""
    return _c(col).cast("date").cast("string")


def clamp(col: str | Column, low: int, high: int) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), _c(col)))


def month_start(col: str | Column) -> Column:
    return F.trunc(_c(col), "month")


def employee_ref(empno: str | Column) -> Column:
    """Record id of the employee with this legacy number."""
    return F.concat(F.lit(EMPLOYEE_ID_PREFIX), _c(empno).cast("string"))


def legacy_number(employee_id: str | Column, data_type: T.DataType) -> Column:
    """Legacy number inside an employee id, in the type of the number column.

    NULL for ids of other making.  Joining on it equals joining on
    ``employee_ref``, and spares large tables the text.
    """
    text = F.substr(_c(employee_id), F.lit(len(EMPLOYEE_ID_PREFIX) + 1))
    of_ours = _c(employee_id).startswith(EMPLOYEE_ID_PREFIX)
    if not isinstance(data_type, T.IntegralType):
        return F.when(of_ours, text).cast(data_type)
    number = text.try_cast("long")
    return F.when(of_ours & (number.cast("string") == text), number)


def email_or_synthetic(email: str | Column, code: str | Column) -> Column:
    fallback = F.concat(_c(code).cast("string"), F.lit(SYNTHETIC_EMAIL_SUFFIX))
    return F.coalesce(blank_to_null(email), fallback)


def null_of(type_name: str) -> Column:
    return F.lit(None).cast(type_name)
