"""Reads of a pay run on the effective-dated tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftroll.functions.joins import lookup_join
from shiftroll.operators.employees import STATUS_ACTIVE


def as_of(df: DataFrame, keys: Sequence[str], payday: str) -> DataFrame:
    """The row of each key in force on ``payday``.

    The latest effective date wins, then the latest record, then the largest
    id.  Map tasks keep one row per key before the shuffle.
    """
    latest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in ("effective_from", "recorded_at", "id")])
    return (
        df.filter(F.col("effective_from") <= F.lit(payday))
        .withColumn("_nth", F.row_number().over(latest))
        .filter("_nth = 1")
        .drop("_nth")
    )


def worklist(
    assignments: DataFrame, transactions: DataFrame, payroll_id: int, payday: str, scope: Sequence[str] = ()
) -> DataFrame:
    """Employees on the payroll on ``payday``, and those with pending transactions."""
    who = [*scope, "employee_id"]
    assigned = as_of(assignments, who, payday).filter(F.col("payroll_id") == payroll_id).select(*who)
    return assigned.union(transactions.select(*who)).distinct()


def payable(work: DataFrame, status: DataFrame, payday: str, scope: Sequence[str] = ()) -> DataFrame:
    """The worklist with the status on ``payday`` and whether it is paid; no status counts as active."""
    who = [*scope, "employee_id"]
    current = as_of(status, who, payday).select(*who, "status")
    known = F.coalesce("status", F.lit(STATUS_ACTIVE))
    return work.join(current, who, "left").select(
        *who, known.alias("status"), F.when(known == STATUS_ACTIVE, F.lit(1)).otherwise(F.lit(0)).alias("payable")
    )


def rebuild_ledger(facts: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Year-to-date total per employee and code."""
    return facts.groupBy(*scope, "employee_id", "code").agg(F.sum("amount_minor").alias("amount_minor"))


def ytd_basis(ledger: DataFrame, facts: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Ledger rows; employees without any fall back to the totals of their facts."""
    who = [*scope, "employee_id"]
    columns = [*who, "code", "amount_minor"]
    # facts of employees with a ledger go before anything is added up
    fallback = rebuild_ledger(lookup_join(facts, ledger.select(*who).distinct(), who, "left_anti"), scope)
    return ledger.select(*columns, F.lit("ledger").alias("basis")).unionByName(
        fallback.select(*columns, F.lit("facts").alias("basis"))
    )
