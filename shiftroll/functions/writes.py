"""Insert rules of keyed target tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftroll.functions.joins import lookup_join


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Let the job fail when a key column holds NULL."""
    checked = {}
    for key in keys:
        if df.schema[key].nullable:
            failure = F.raise_error(F.lit(f"NULL in key column {key}"))
            checked[key] = F.coalesce(F.col(key), failure)
    return df.withColumns(checked) if checked else df


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a key occurs twice, as a primary key would."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").first()
    if repeated is not None:
        raise ValueError(f"repeated key {', '.join(f'{k}={repeated[k]}' for k in keys)}")


def require_absent(new: DataFrame, existing: DataFrame | None, keys: Sequence[str]) -> None:
    """Raise when a key of ``new`` is in ``existing`` already, as a primary key would."""
    if existing is None:
        return
    found = new.select(*keys).join(existing.select(*keys), list(keys), "left_semi").first()
    if found is not None:
        raise ValueError(f"key in use {', '.join(f'{k}={found[k]}' for k in keys)}")


def first_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str] | None = None) -> DataFrame:
    """Keep the smallest row of each key.

    The rank filter runs inside the map tasks too, so a frequent key sends one
    row per map task through the shuffle.
    """
    order = order_cols or [c for c in df.columns if c not in keys]
    ranking = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in (order or keys)])
    return df.withColumn("_nth", F.row_number().over(ranking)).filter("_nth = 1").drop("_nth")


def insert_if_absent(
    new: DataFrame,
    existing: DataFrame | None,
    keys: Sequence[str],
    order_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of ``new`` that a keyed insert with skip-on-conflict would add."""
    added = first_per_key(require_keys(new, keys), keys, order_cols)
    if existing is None:
        return added
    return added.join(existing.select(*keys), list(keys), "left_anti").select(*new.columns)


def insert_in_route_order(
    new: DataFrame, existing: DataFrame | None, keys: Sequence[str], origin: Sequence[str] = ()
) -> DataFrame:
    """Keyed insert in which the row of the first ``origin`` wins, then the smallest.

    Routes run one after the other in the order of their company, so what an
    earlier one brought is there when the next one inserts.
    """
    order = [*origin, *[c for c in new.columns if c not in (*keys, *origin)]]
    return insert_if_absent(new, existing, keys, order).drop(*origin)


def insert_not_exists(
    new: DataFrame, existing: DataFrame | None, keys: Sequence[str], origin: Sequence[str] = ()
) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing``; repeats inside ``new`` stay.

    With ``origin`` a key belongs to the first route that has it: its rows stay,
    later routes find them there.
    """
    if origin:
        first = new.groupBy(*keys).agg(F.min(F.struct(*origin)).alias("_first"))
        mine = F.struct(*origin).eqNullSafe(F.col("_first"))
        new = lookup_join(new, first, keys).filter(mine).drop("_first", *origin)
    if existing is None:
        return new
    return lookup_join(new, existing.select(*keys), keys, "left_anti").select(*new.columns)
