"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns several places (virtual nodes) on a ring of ``BINS`` bins.  A
row hashes to a bin and belongs to the shard of the next virtual node
clockwise.  A shard takes rows up to its bound; what overflows continues
clockwise to the next shard with room.  Rows a shard owns come before rows
that overflow into it, so few rows move.

Which rows overflow needs only the number of rows per bin, at most ``BINS``
numbers whatever the size of the data; the driver walks the ring over these.
A row's shard then follows from its bin and its rank in the ring's order.

Only DataFrame functions; no Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftroll.functions.keys import dense_ids
from shiftroll.session import materialise

BINS = 1 << 14
VIRTUAL_NODES = 64


def bin_of(*key: Column) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(BINS)).cast("int")


def ring(spark, shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """(bin, shard) of all virtual nodes, clockwise; shards x virtual_nodes rows."""
    nodes = spark.range(shards * virtual_nodes).select(
        (F.col("id") % shards).cast("int").alias("shard"), F.floor(F.col("id") / shards).cast("int").alias("copy")
    )
    placed = nodes.select(bin_of(F.lit("node"), F.col("shard"), F.col("copy")).alias("bin"), "shard", "copy")
    return [(r["bin"], r["shard"]) for r in placed.orderBy("bin", "copy", "shard").collect()]


def bounds_of(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Most rows of each shard: an equal share, or that times 1 + slack."""
    if slack:
        return [-int(-(rows * (1 + slack)) // shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def walk(nodes: Sequence[tuple[int, int]], rows_in: dict[int, int], bounds: Sequence[int]) -> list[tuple[int, int, int, int, int]]:
    """Deal the rows of the bins clockwise: (bin, first rank in bin, end rank, shard, first slot)."""
    room, filled = list(bounds), [0] * len(bounds)
    pending, at = [], 0
    for b in sorted(rows_in):
        while at < len(nodes) and nodes[at][0] < b:
            at += 1
        pending.append((b, 0, rows_in[b], at % len(nodes)))
    dealt = []
    while pending:
        moved = []
        for b, first, end, node in pending:
            shard = nodes[node][1]
            taken = min(room[shard], end - first)
            if taken:
                dealt.append((b, first, first + taken, shard, filled[shard]))
                room[shard] -= taken
                filled[shard] += taken
            if first + taken < end:
                moved.append((b, first + taken, end, node))
        pending = []
        for b, first, end, node in moved:  # on to the next node with room
            step = next(k for k in range(1, len(nodes) + 1) if room[nodes[(node + k) % len(nodes)][1]])
            pending.append((b, first, end, (node + step) % len(nodes)))
    return dealt


def shard_rows(
    df: DataFrame, key: Sequence[str], order: Sequence[str], shards: int, slack: float = 0.0, virtual_nodes: int = VIRTUAL_NODES
) -> DataFrame:
    """``df`` with shard int and slot long (gapless from 0 within a shard).

    ``key`` decides the place on the ring, a NULL being a key like any other;
    rows of one bin rank by ``key`` and ``order``.  Repeated rows are rows of
    their own.  With ``slack`` 0 the shards' counts are at most one apart.
    ``df`` should hold little more than key and order.  Columns named shard or
    slot are replaced; an empty table stays empty.
    """
    kept = [c for c in df.columns if c not in ("shard", "slot")]
    narrow = materialise(df.select(*kept, bin_of(*[F.col(c) for c in key]).alias("_bin")))
    counts = {r["_bin"]: r["n"] for r in narrow.groupBy("_bin").agg(F.count(F.lit(1)).alias("n")).collect()}
    spark, rows = df.sparkSession, sum(counts.values())
    dealt = walk(ring(spark, shards, virtual_nodes), counts, bounds_of(rows, shards, slack))
    before, starts = 0, {}
    for b in sorted(counts):
        starts[b] = before
        before += counts[b]
    segments = spark.createDataFrame(
        [(b, starts[b] + first, starts[b] + end, shard, slot - first - starts[b]) for b, first, end, shard, slot in dealt],
        "_bin int, _first long, _end long, shard int, _shift long",
    )
    ranked = dense_ids(narrow, ["_bin", *key, *order], base=-1, id_col="_rank")
    hit = (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_end"))
    # at most BINS segments and one more for each time a shard fills up
    return (
        ranked.join(F.broadcast(segments), "_bin")
        .filter(hit)
        .select(*kept, "shard", (F.col("_rank") + F.col("_shift")).alias("slot"))
    )


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Documents' ids, sizes and checksums with their shards; NULL text has size 16 and no checksum."""
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
    )
    placed = shard_rows(rows, ["doc_id"], ["text_crc32", "size"], shards)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
