"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftroll.functions.joins import lookup_join
from shiftroll.session import materialise

_ROW_BITS = 33  # monotonically_increasing_id keeps the row's place in the low 33 bits

Base = int | DataFrame


def max_id(existing: DataFrame | None, id_col: str = "id", scope: Sequence[str] = ()) -> Base:
    """Largest id in use, 0 where there is none; one row per scope if scoped."""
    if existing is None:
        return 0
    top = F.coalesce(F.max(id_col), F.lit(0)).cast("long").alias("base")
    if scope:
        return existing.groupBy(*scope).agg(top)
    return existing.agg(top).first()["base"]


def high_water(df: DataFrame, id_col: str = "id", scope: Sequence[str] = ()) -> DataFrame:
    """Next free id of an auto-key table (1 when empty)."""
    return df.groupBy(*scope).agg((F.coalesce(F.max(id_col), F.lit(0)) + 1).cast("long").alias("next_id"))


def on_top_of(df: DataFrame, rank: str | Column, base: Base, scope: Sequence[str], id_col: str) -> DataFrame:
    """Add ``id_col`` = the scope's base + rank."""
    rank = F.col(rank) if isinstance(rank, str) else rank
    if isinstance(base, int):
        return df.withColumn(id_col, (rank + F.lit(base)).cast("long"))
    joined = lookup_join(df, base.select(*scope, F.col("base").alias("_base")), list(scope), "left")
    return joined.withColumn(id_col, (rank + F.coalesce("_base", F.lit(0))).cast("long")).drop("_base")


def dense_ids(
    df: DataFrame,
    order_cols: Sequence[str],
    base: Base = 0,
    id_col: str = "id",
    scope: Sequence[str] = (),
    overall_col: str | None = None,
) -> DataFrame:
    """Number the rows base+1, base+2, ... in the order of ``order_cols``.

    With ``scope`` each scope is numbered by itself; ``overall_col`` then also
    gives the place (1..n) among the rows of all scopes.

    A global sort spreads the rows over tasks by range; the sorted rows are
    written once, each with its sort task and its place there.  The ids then
    need only the row counts of each scope and task, so no task ever sees all rows.  The
    source partition closes the sort key: rows with equal keys can still be
    split over several tasks.
    """
    clash = {"_part", "_place", "_from"} & set(df.columns)
    if clash:
        raise ValueError(f"reserved column names: {sorted(clash)}")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    ordered = materialise(
        df.withColumn("_from", F.spark_partition_id())
        .orderBy(*[F.col(c).asc_nulls_first() for c in (*scope, *order_cols)], "_from")
        .drop("_from")
        .withColumns({"_part": F.spark_partition_id(), "_place": place})
    )
    counts = ordered.groupBy(*scope, "_part").agg(F.count(F.lit(1)).alias("n"), F.min("_place").alias("_first"))
    if scope:
        # a sort task holds the rows of a scope in one piece, so these counts give all offsets
        counts = materialise(counts)
    # one row per sort task
    sizes = (counts if scope else ordered).groupBy("_part").agg((F.sum("n") if scope else F.count(F.lit(1))).alias("n"))
    totals = sorted((r["_part"], r["n"]) for r in sizes.collect())
    starts = accumulate((n for _, n in totals), initial=0)
    offsets = df.sparkSession.createDataFrame(
        [(part, start) for (part, _), start in zip(totals, starts, strict=False)], "_part int, _start long"
    )
    if scope:
        before = Window.partitionBy(*scope).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        earlier = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("_first")
        places = counts.withColumn("_earlier", earlier).join(F.broadcast(offsets), "_part").drop("n", "_first")
        ranked = lookup_join(ordered, places, [*scope, "_part"])
    else:
        ranked = ordered.join(F.broadcast(offsets), "_part")
    if overall_col:
        ranked = ranked.withColumn(overall_col, F.col("_start") + F.col("_place") + 1)
    ranked = ranked.withColumn("_rank", F.col("_earlier" if scope else "_start") + F.col("_place") + 1)
    numbered = on_top_of(ranked, "_rank", base, scope, id_col)
    extra = [overall_col] if overall_col else []
    return numbered.select(id_col, *extra, *[c for c in df.columns if c != id_col])
