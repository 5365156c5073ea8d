"""Column names of legacy tables in the target schema."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

# Names with a meaning of their own, and words that cannot be column names.
AUTO_KEY_NAME = "id"
EMPLOYEE_NUMBER_COLUMNS = ("employeeno", "empno")
EMPLOYEE_LINK_NAME = "employee_id"
EMPLOYEE_CODE_COLUMN = "employeeid"
EMPLOYEE_CODE_NAME = "employee_code"
RESERVED_SUFFIX = "_no"
RESERVED_WORDS = frozenset(
    """
    row user order group default check primary references table column select
    where from to desc asc limit offset both case cast collate do else end for
    grant in into not null on or then union unique using when with all and any
    """.split()
)

_WORD_STARTS = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])")


def snake_case(name: str) -> str:
    return re.sub("_{2,}", "_", _WORD_STARTS.sub("_", name).lower())


def target_name(name: str, auto_key: str | None = None) -> str:
    plain = name.lower()
    if auto_key is not None and plain == auto_key.lower():
        return AUTO_KEY_NAME
    if plain in EMPLOYEE_NUMBER_COLUMNS:
        return EMPLOYEE_LINK_NAME
    if plain == EMPLOYEE_CODE_COLUMN:
        return EMPLOYEE_CODE_NAME
    spelled = snake_case(name)
    return spelled + RESERVED_SUFFIX if spelled in RESERVED_WORDS else spelled


def target_names(names: list[str], auto_key: str | None = None) -> list[str]:
    targets = [target_name(name, auto_key) for name in names]
    repeated = sorted({t for t in targets if targets.count(t) > 1})
    if repeated:
        raise ValueError(f"several columns would be named {', '.join(repeated)}")
    return targets


def normalise_columns(df: DataFrame, auto_key: str | None = None) -> DataFrame:
    return df.toDF(*target_names(df.columns, auto_key))
