"""Mixing sources to target weights by pivotal dependent rounding.

A source's target divided by its size is the number of copies that each of its
documents should get.  The whole part is given at once; the fractions are
rounded together: two documents exchange words, in a random direction that
leaves both expectations as they are, until one of the fractions is 0 or 1.
Blocks of a source are rounded apart, each leaves at most one open fraction,
and these are combined in a reduction tree.  A source's last open fraction is
rounded at random, and smaller documents of the tree's root make up for the
words that this adds or takes.  So a source's taken words differ from its
target by less than one document.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftroll.functions.joins import lookup_join
from shiftroll.functions.keys import dense_ids
from shiftroll.session import materialise

WORD = r"[^\x20\x09-\x0D]++"
MOST_COPIES = 3
BLOCK_ROWS = 4096
FAN_IN = 64
SEED = 20240611


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source and the number of words; NULL text has none."""
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def targets(rows: DataFrame) -> DataFrame:
    """One row a source: its size, target and rows.

    Sources in code point order, NULL last, weigh 1, 2, 3, repeating.  Targets
    stop at MOST_COPIES times the size; the excess goes to the others by
    weight.  A source stops when its ratio of bound to weight is below the
    water level, so each round needs one small aggregate.
    """
    per_source = materialise(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows")))
    ordered = per_source.withColumn("_null", F.col("source").isNull())
    table = materialise(
        dense_ids(ordered, ["_null", "source"], base=-1, id_col="_place")
        .withColumn("weight", (F.col("_place") % 3 + 1).cast("double"))
        .withColumn("bound", F.col("source_size").cast("double") * MOST_COPIES)
        .drop("_null", "_place")
    )
    level = 0.0
    while True:
        stopped = F.col("bound") < F.col("weight") * level
        got = table.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(stopped, F.col("bound"))).alias("given"),
            F.sum(F.when(~stopped, F.col("weight"))).alias("weight"),
        ).first()
        if not got["all"] or not got["weight"]:
            break
        higher = (got["all"] - (got["given"] or 0.0)) / got["weight"]
        if higher <= level:
            break
        level = higher
    return table.select(
        "source", "source_size", "source_rows", F.least(F.col("bound"), F.col("weight") * level).alias("target")
    )


def pivot(size: np.ndarray, share: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, int]:
    """Round ``share`` in the given order, keeping sum(size * share): rounded shares, place of the open one or -1."""
    out, size = share.tolist(), size.tolist()
    held = -1
    for j in range(len(out)):
        if not 0.0 < out[j] < 1.0:
            continue
        if held < 0:
            held = j
            continue
        i, ratio = held, size[j] / size[held]
        up = min(1.0 - out[i], out[j] * ratio)
        down = min(out[i], (1.0 - out[j]) * ratio)
        change = up if draws[j] * (up + down) < down else -down
        out[i] += change
        out[j] -= change / ratio
        for k in (i, j):
            out[k] = 0.0 if out[k] < 1e-12 else 1.0 if out[k] > 1.0 - 1e-12 else out[k]
        held = next((k for k in (j, i) if 0.0 < out[k] < 1.0), -1)
    return np.array(out), held


def _close(size: np.ndarray, share: np.ndarray, held: int, draw: float) -> None:
    """Round a source's last open share; smaller documents then make up for the words it changes."""
    closed = float(draw < share[held])
    missing = (share[held] - closed) * size[held]
    share[held] = closed
    for k in range(len(share)):  # largest first
        if k != held and size[k] <= abs(missing) and share[k] == float(missing < 0):
            share[k] = 1.0 - share[k]
            missing -= size[k] if missing > 0 else -size[k]


def _round_block(last: bool):
    def rounded(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["size", "draw"], ascending=False, kind="stable", ignore_index=True)
        draws = (block["draw"].to_numpy().view(np.uint64) >> np.uint64(11)) / float(1 << 53)
        share, held = pivot(block["size"].to_numpy(), block["share"].to_numpy(), draws)
        if last and held >= 0:
            _close(block["size"].to_numpy(), share, held, draws[held])
        return block.assign(share=share)

    return rounded


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken of every document.

    Documents without words and sources without words are taken 0 times.
    Repeated rows are rows of their own, told apart by a running number, so
    reruns agree.  An empty table gives an empty one.
    """
    rows = materialise(sizes(docs))
    per_source = targets(rows)
    # copies of a row are counted before they are numbered, so a repeated one meets in no single task
    numbered = (
        rows.groupBy("doc_id", "source", "size")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n"))))
        .drop("_n")
    )
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))
    joined = lookup_join(numbered.withColumn("_src", key), per_source.withColumn("_src", key).drop("source"), ["_src"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    blocks = F.ceil(F.col("source_rows") / BLOCK_ROWS)
    draw = F.xxhash64(F.lit(SEED), "doc_id", "size", "_copy")
    open_rows = materialise(
        joined.withColumn("_rate", rate)
        .withColumn("whole", F.when(F.col("size") > 0, F.floor("_rate")).otherwise(0).cast("long"))
        .withColumn("share", F.when(F.col("size") > 0, F.col("_rate") - F.floor("_rate")).otherwise(F.lit(0.0)))
        .withColumn("draw", draw)
        .withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "draw"), blocks).cast("long"))
        .select("doc_id", "source", "_src", "size", "source_size", "target", "whole", "share", "draw", "block")
    )
    is_open = (F.col("share") > 0) & (F.col("share") < 1)
    settled, current = [open_rows.filter(~is_open)], open_rows.filter(is_open)
    top = current.agg(F.max("block").alias("top")).first()["top"]
    while top is not None:
        last = top == 0
        done = materialise(current.groupBy("_src", "block").applyInPandas(_round_block(last), current.schema))
        settled.append(done.filter(~is_open))
        current = done.filter(is_open).withColumn("block", F.floor(F.col("block") / FAN_IN))
        top = None if last else top // FAN_IN
    copies = F.col("whole") + F.col("share").cast("long")
    return reduce(DataFrame.unionByName, settled).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, each document as often as the mix takes it.

    Rows alike in doc_id, source and size share their copies; the first few of
    them get one more.
    """
    key = F.xxhash64("doc_id", "source", "_size")
    picked = materialise(
        mix(docs)
        .withColumnRenamed("size", "_size")
        .groupBy("doc_id", "source", "_size")
        .agg(F.sum("copies").alias("_all"), F.count(F.lit(1)).alias("_same"))
        .select(key.alias("_key"), F.col("doc_id").alias("_id"), F.col("source").alias("_source"), "_size", "_all", "_same")
    )
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    left = docs.withColumn("_size", size).withColumn("_key", key)
    alike = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source"))
    found = left.join(picked.filter("_all > 0"), ["_key", "_size"]).filter(alike)

    def repeated(rows: DataFrame, times: Column) -> DataFrame:
        return rows.withColumn("_time", F.explode(F.sequence(F.lit(1), times.cast("int")))).select(*docs.columns)

    once = repeated(found.filter("_same = 1"), F.col("_all"))
    if picked.filter("_same > 1").isEmpty():
        return once
    # numbered without gathering a repeated row in one task
    nth = dense_ids(found.filter("_same > 1"), ["_key"], id_col="_nth", scope=["_key"])
    whole = F.floor(F.col("_all") / F.col("_same"))
    times = whole + F.when(F.col("_nth") <= F.col("_all") - whole * F.col("_same"), 1).otherwise(0)
    return once.unionByName(repeated(nth.withColumn("_times", times).filter("_times > 0"), F.col("_times")))
