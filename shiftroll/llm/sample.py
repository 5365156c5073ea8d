"""Bounded samples of rows, chosen by the hash of their id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rows_by_hash(table: DataFrame, most: int, per: Sequence[str] = (), key: str = "doc_id") -> DataFrame:
    """Up to ``most`` rows, or as many for each value of ``per``, with the smallest hashes of ``key``."""
    if not per:
        return table.orderBy(F.xxhash64(key), key).limit(most)
    order = Window.partitionBy(*per).orderBy(F.xxhash64(key), key)
    return table.withColumn("_nth", F.row_number().over(order)).filter(F.col("_nth") <= most).drop("_nth")


def texts_of(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The texts of a bounded number of ``chosen`` rows (by doc_id), one for each row of ``chosen``."""
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return found.groupBy(*chosen.columns).agg(F.min("text").alias("text"))
