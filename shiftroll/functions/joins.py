"""Joining a large table to a keyed one, whatever the size and the skew.

A keyed side that is measured to be small is broadcast.  Any other goes
through a shuffle, in which rows of very frequent keys are spread over several
tasks and the keyed rows they need are repeated for each of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftroll.session import materialise

BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
# Below this many rows a frequent key is no burden for one task.
HOT_KEY_MIN_ROWS = 5_000_000
MAX_HOT_KEYS = 1_000
# Sketches are merged within this many groups of tasks.
SKETCH_GROUPS = 256


class Lookup(NamedTuple):
    """A table with one row per key, joined on equally named columns."""

    keyed: DataFrame
    on: Sequence[str]
    how: str = "inner"


def _bytes(value: Column, kind: T.DataType) -> Column | None:
    """Bytes that a value takes beyond 16, None for a type that takes no more."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.octet_length(value).cast("long")
    if isinstance(kind, T.ArrayType):
        fixed = 8 * (len(kind.elementType.fields) if isinstance(kind.elementType, T.StructType) else 1)
        if _bytes(F.lit(None), kind.elementType) is None:
            return F.size(value).cast("long") * fixed
        return F.aggregate(
            value,
            F.lit(0).cast("long"),
            lambda total, x: total + fixed + F.coalesce(_bytes(x, kind.elementType), F.lit(0)),
        )
    if isinstance(kind, T.MapType):
        return _bytes(F.map_entries(value), T.ArrayType(T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])))
    if isinstance(kind, T.StructType):
        inner = [(value.getField(f.name), f.dataType) for f in kind.fields]
        found = [F.coalesce(b, F.lit(0)) for b in (_bytes(v, t) for v, t in inner) if b is not None]
        return reduce(lambda a, b: a + b, found, F.lit(16 * len(inner)).cast("long"))
    return None


def _measure(df: DataFrame) -> DataFrame:
    """Rows and an upper estimate of the bytes of ``df``, as one row."""
    rows = F.count(F.lit(1))
    size = rows * (16 * len(df.columns))
    for field in df.schema.fields:
        more = _bytes(F.col(f"`{field.name}`"), field.dataType)
        if more is not None:
            size = size + F.coalesce(F.sum(more), F.lit(0))
    return df.agg(rows.alias("n"), size.cast("long").alias("bytes"))


class Statistics:
    """Sizes and frequent keys of the tables that one build has asked for.

    Tables are told apart by what they compute, so a lookup that several joins
    share is measured once.  Valid as long as the files under the tables stay
    as they are: one build of a query, or one step of a run.
    """

    def __init__(self) -> None:
        self._known: dict[tuple, list[tuple[DataFrame, object]]] = {}

    def get(self, df: DataFrame, what: tuple = ()) -> object | None:
        for other, value in self._known.get((df.semanticHash(), what), []):
            if other.sameSemantics(df):
                return value
        return None

    def put(self, df: DataFrame, value: object, what: tuple = ()) -> None:
        self._known.setdefault((df.semanticHash(), what), []).append((df, value))


_statistics: ContextVar[Statistics | None] = ContextVar("statistics", default=None)


@contextmanager
def measured_once() -> Iterator[Statistics]:
    """Within it, equal tables are measured once.  Their files must not change meanwhile."""
    token = _statistics.set(Statistics())
    try:
        yield _statistics.get()
    finally:
        _statistics.reset(token)


def small_enough(dfs: Sequence[DataFrame], max_rows: int | None = None) -> list[bool]:
    """Which of the tables are small enough to broadcast, measured in one job."""
    max_rows = BROADCAST_MAX_ROWS if max_rows is None else max_rows
    if not max_rows:
        return [False] * len(dfs)
    known = _statistics.get() or Statistics()
    asked = [df for df in dfs if known.get(df) is None]
    if asked:
        measured = reduce(DataFrame.unionAll, [_measure(df).withColumn("i", F.lit(i)) for i, df in enumerate(asked)])
        for r in measured.collect():
            known.put(asked[r["i"]], (r["n"], r["bytes"]))
    sizes = [known.get(df) for df in dfs]
    return [n <= max_rows and size <= BROADCAST_MAX_BYTES for n, size in sizes]


def hot_keys(df: DataFrame, keys: Sequence[Sequence[str]], min_rows: int | None = None) -> list[list[tuple[int, int]]]:
    """Frequent values of each key as (hash of key, number of tasks to spread over).

    Found with top-k sketches in one pass over the key columns, so nothing is
    shuffled by key.  The sketches have a bounded size and are merged per group
    of tasks; the frequent keys of the groups are then added up.  The error of a sketch can only
    change how rows are spread, never the result.  A NULL key counts as a key:
    a left join gathers its rows too.
    """
    min_rows = HOT_KEY_MIN_ROWS if min_rows is None else min_rows
    known, asked = _statistics.get(), (tuple(tuple(on) for on in keys), min_rows)
    found = known.get(df, asked) if known else None
    if found is None:
        found = _hot_keys(df, keys, min_rows)
        if known:
            known.put(df, found, asked)
    return found


def _hot_keys(df: DataFrame, keys: Sequence[Sequence[str]], min_rows: int) -> list[list[tuple[int, int]]]:
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    k = max(1, min(tasks, MAX_HOT_KEYS))
    hashes = df.select(*[F.xxhash64(*on).alias(f"h{i}") for i, on in enumerate(keys)])
    per_group = hashes.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("task_group")).agg(
        F.array(F.struct(F.lit(0).cast("long").alias("item"), F.count(F.lit(1)).alias("count"))).alias("every"),
        *[F.expr(f"approx_top_k(h{i}, {k}, {4 * k})").alias(f"h{i}") for i in range(len(keys))],
    )
    # the row count goes along as one more item, the largest
    found = (
        per_group.unpivot([], ["every", *hashes.columns], "key", "items")
        .select("key", F.inline("items"))
        .groupBy("key", "item")
        .agg(F.sum("count").alias("n"))
        .orderBy(F.desc("n"))
        .limit(1 + k * len(keys))
        .collect()
    )
    rows = next((r["n"] for r in found if r["key"] == "every"), 0)
    per_task = max(rows / tasks, 1)
    limit = max(2 * per_task, min_rows)
    return [
        [(r["item"], math.ceil(r["n"] / per_task)) for r in found if r["key"] == name and r["n"] > limit]
        for name in hashes.columns
    ]


def spread_join(
    fact: DataFrame,
    keyed: DataFrame,
    on: Sequence[str],
    how: str,
    hot: list[tuple[int, int]],
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Shuffle join with the rows of the ``hot`` keys spread over several tasks.

    Rows spread by their input task and the columns ``spread_by``.  Both stay
    the same when a lost task runs again, copies of a row get apart, and no
    column is read just for this.
    """
    if not hot:
        return fact.join(keyed, list(on), how)
    # the most frequent key comes first, so most hot rows find their entry at once
    tasks_of = F.create_map(*[F.lit(x) for pair in hot for x in pair])
    types = {f.name: f.dataType for f in fact.schema.fields}

    def is_hot() -> Column:
        return F.xxhash64(*on).isin([key for key, _ in hot])

    def tasks() -> Column:
        return F.element_at(tasks_of, F.xxhash64(*on))

    salt = F.pmod(F.xxhash64(F.spark_partition_id(), *spread_by), tasks())
    salted = fact.withColumn("_salt", F.when(is_hot(), salt).otherwise(F.lit(0)).cast("int"))
    salts = F.when(is_hot(), F.sequence(F.lit(0), tasks() - 1)).otherwise(F.array(F.lit(0)))
    repeated = keyed.withColumns({c: F.col(c).cast(types[c]) for c in on}).withColumn("_salt", F.explode(salts))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")


def lookup_joins(
    fact: DataFrame,
    lookups: Sequence[Lookup],
    max_rows: int | None = None,
    min_hot_rows: int | None = None,
    write_first: bool = False,
) -> DataFrame:
    """Join ``fact`` to each of the keyed tables, the small ones by broadcast.

    The keys must be columns of ``fact``.  With ``write_first`` a fact whose
    frequent keys are wanted is written once, which for a joined one is less
    than shuffling it for the keys and again for the rows.
    """
    small = small_enough([x.keyed for x in lookups], max_rows)
    shuffled = [x for x, fits in zip(lookups, small, strict=True) if not fits]
    if shuffled and write_first:
        fact = materialise(fact)
    hot = iter(hot_keys(fact, [x.on for x in shuffled], min_hot_rows) if shuffled else [])
    for lookup, fits in zip(lookups, small, strict=True):
        on, how = list(lookup.on), lookup.how
        if fits:
            fact = fact.join(F.broadcast(lookup.keyed), on, how)
        else:
            # an anti join may get repeated keys; one of each will do
            keyed = lookup.keyed.select(*on).distinct() if how == "left_anti" else lookup.keyed
            # keys of the other lookups are read anyway
            others = [c for x in lookups for c in x.on if c not in on]
            fact = spread_join(fact, keyed, on, how, next(hot), others)
    return fact


def lookup_join(
    fact: DataFrame,
    keyed: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    max_rows: int | None = None,
    min_hot_rows: int | None = None,
) -> DataFrame:
    return lookup_joins(fact, [Lookup(keyed, on, how)], max_rows, min_hot_rows)
