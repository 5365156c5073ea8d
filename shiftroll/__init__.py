"""Payroll and HR data-migration operators on Spark DataFrames."""

from shiftroll.params import RunParams

__all__ = ["RunParams"]
