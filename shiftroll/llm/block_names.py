"""Exact dedup by deterministic block naming.

The bytes of a text are cut into blocks of a fixed size.  The distinct blocks of
the whole corpus are sorted and a block's place in that order is its name, an
integer.  Then adjacent names are paired, the distinct pairs are sorted and
numbered in their turn, and so on until every document has one name.  Two
documents have the same name on the same level just when their texts are equal.

Blocks are sorted by their 64-bit hash first and by their bytes where different
blocks share a hash.  So the sort, the naming and the join back move eight bytes
a block.  One aggregate, combined in the map tasks, compares the bytes of all
blocks of a hash and finds the hashes that need their bytes; no name rests on
the hash alone.

Only DataFrame functions; no Python runs on the executors.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftroll.functions.joins import lookup_join
from shiftroll.functions.keys import dense_ids
from shiftroll.session import materialise

BLOCK_BYTES = 4096
ALONE = -1  # partner of a last name without one
NO_BYTES = b""


def normalised(text: Column) -> Column:
    """NULL as empty text, A-Z in lower case, nothing else changed."""
    text = F.coalesce(text, F.lit(""))
    # in a text of ASCII letters lower() changes just these, and faster
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).cast("binary").alias("_data"))


def _blocks(block_bytes: int) -> Column:
    """The blocks of ``_data``; an empty text is one empty block."""
    last = F.greatest(F.ceil(F.octet_length("_data") / block_bytes).cast("int"), F.lit(1)) - 1
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(F.col("_data"), i * block_bytes + 1, block_bytes))


def shared_hashes(blocks: DataFrame) -> DataFrame:
    """Hashes (h) that different blocks share."""
    spans = blocks.groupBy("h").agg(F.min("block").alias("least"), F.max("block").alias("most"))
    return spans.filter(F.col("least") != F.col("most")).select("h")


def _named(rows: DataFrame, key: list[str]) -> DataFrame:
    """``name``: the place of a row's key among the sorted distinct keys."""
    names = dense_ids(rows.select(*key).distinct(), key, base=-1, id_col="name")
    return lookup_join(rows, names, key)


def _first_names(texts: DataFrame, block_bytes: int, hashed) -> DataFrame:
    """The blocks of all texts (row, pos, n) with their names; doc_id and text_sha256 stand with the first block."""
    cut = texts.withColumn("_blocks", _blocks(block_bytes))
    every = cut.select(F.explode("_blocks").alias("block")).select(hashed(F.col("block")).alias("h"), "block")
    shared = materialise(shared_hashes(every))
    pieces = (
        cut.withColumn("text_sha256", F.sha2("_data", 256))
        .withColumn("row", F.monotonically_increasing_id())
        .select("row", "doc_id", "text_sha256", F.size("_blocks").alias("n"), F.posexplode("_blocks").alias("pos", "block"))
    )
    first = F.col("pos") == 0
    rows = pieces.select(
        "row", "pos", "n", F.when(first, F.col("doc_id")).alias("doc_id"),
        F.when(first, F.col("text_sha256")).alias("text_sha256"), hashed(F.col("block")).alias("h"), "block",
    )
    if shared.isEmpty():
        rows = rows.withColumn("block", F.lit(NO_BYTES))
    else:
        marked = lookup_join(rows, shared.withColumn("_shared", F.lit(True)), ["h"], "left")
        rows = marked.withColumn("block", F.when(F.col("_shared"), F.col("block")).otherwise(F.lit(NO_BYTES))).drop("_shared")
    return materialise(_named(materialise(rows), ["h", "block"]).drop("h", "block"))


def identities(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, hashed=F.xxhash64
) -> DataFrame:
    """doc_id, text_sha256, row (a number of its own) and the identity (level, name) of every row."""
    names = _first_names(_texts(docs, id_col, text_col), block_bytes, hashed)
    longest = names.agg(F.max("n")).first()[0] or 1
    level, done = 0, []
    while True:
        done.append(names.filter("n = 1").select("doc_id", "text_sha256", "row", F.lit(level).alias("level"), "name"))
        if longest == 1:
            break
        place = F.col("pos") % 2
        pairs = (
            names.filter("n > 1")
            .groupBy("row", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
            .agg(
                F.max("doc_id").alias("doc_id"),
                F.max("text_sha256").alias("text_sha256"),
                F.max(F.ceil(F.col("n") / 2)).cast("int").alias("n"),
                F.max(F.when(place == 0, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(place == 1, F.col("name"))), F.lit(ALONE)).cast("long").alias("right"),
            )
        )
        names = materialise(_named(materialise(pairs), ["left", "right"]).drop("left", "right"))
        level, longest = level + 1, (longest + 1) // 2
    return reduce(DataFrame.unionByName, done)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row, dropped ones too.

    Of rows with equal texts (A-Z in lower case, NULL as empty) the one with the
    largest id stays, a NULL id being the smallest; of rows that repeat that id
    one stays.  Long texts are whole; other columns are left out, whatever their
    names.  An empty table gives no rows.
    """
    rows = identities(docs, id_col, text_col, block_bytes)
    best = F.max(F.struct("doc_id", "row"))
    groups = rows.groupBy("level", "name").agg(F.count(F.lit(1)).alias("group_size"), best.alias("_best"))
    flat = groups.select("level", "name", "group_size", F.col("_best.doc_id").alias("keep_id"), F.col("_best.row").alias("_row"))
    return lookup_join(rows, flat, ["level", "name"]).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("_row")).alias("kept"), "text_sha256"
    )
