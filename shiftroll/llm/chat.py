"""Conversations from reply trees, in one template with a loss mask.

A tree's messages name their parent.  Root-to-leaf paths are found from the
leaves up by self-joins that double their reach, so a chain of n messages
takes log2(n) joins of ids; texts are joined once at the end.  Branches are
ranked by score and each chosen path becomes one conversation.

A turn is ``<|im_start|>role``, a line end, its text, ``<|im_end|>`` and a line
end.  In roles and texts a backslash is doubled and ``<|`` becomes ``<\\|``, so
no text can hold a control string, and the way back is unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftroll.session import materialise

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\n"), F.lit("\n")))


def paths_of(messages: DataFrame) -> DataFrame:
    """tree, leaf, node, depth (0 at the leaf) for every message on every path to a leaf.

    ``messages`` has tree, node and parent, unique by tree and node; a message
    whose parent is NULL or missing is a root.  Messages that answer each other in
    a circle are an error where a path leads into it; a circle without a way in
    has no leaf and so no path.
    """
    ids = materialise(messages.select("tree", "node", "parent"))
    largest = ids.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    parents = ids.filter("parent is not null").select("tree", F.col("parent").alias("node")).distinct()
    up = materialise(ids.filter("parent is not null").join(ids.select("tree", F.col("node").alias("parent")), ["tree", "parent"]))
    leaves = ids.join(parents, ["tree", "node"], "left_anti")
    found = [materialise(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("depth")))]
    reach = 1
    while True:
        lower = found[0]
        for more in found[1:]:
            lower = lower.unionByName(more)
        higher = materialise(
            lower.join(up, ["tree", "node"]).select("tree", "leaf", F.col("parent").alias("node"), (F.col("depth") + reach).alias("depth"))
        )
        if higher.isEmpty():
            return lower
        if reach >= largest:  # longer than any way without a circle
            raise ValueError(f"messages answer each other in a circle, in tree {higher.first()['tree']}")
        found.append(higher)
        reach *= 2
        further = up.select("tree", F.col("node").alias("parent"), F.col("parent").alias("further"))
        up = materialise(up.join(further, ["tree", "parent"]).select("tree", "node", F.col("further").alias("parent")))


def conversations(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """tree, rank, score, n_turns and formatted, one row a chosen path.

    ``messages`` has tree, node, parent, role, text and score.  A path's score
    is the sum of its messages' scores (NULL: 0); the ``branches`` best of each
    tree are chosen, all by default, ties going to the smaller leaf.  NULL
    texts and roles are empty.
    """
    scored = messages.select(
        "tree", "node", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    paths = materialise(paths_of(messages))
    ranked = paths.join(scored.select("tree", "node", "score"), ["tree", "node"]).groupBy("tree", "leaf").agg(F.sum("score").alias("path_score"))
    place = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("path_score"), "leaf"))
    chosen = ranked.withColumn("rank", place)
    if branches is not None:
        chosen = chosen.filter(F.col("rank") <= branches)
    turn = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"), escape(F.col("text")), F.lit(END))
    turns = paths.join(chosen, ["tree", "leaf"]).join(scored.drop("score"), ["tree", "node"])
    pieces = F.sort_array(F.collect_list(F.struct((-F.col("depth")).alias("place"), turn.alias("turn"))))
    return (
        turns.groupBy("tree", "leaf", "rank", "path_score")
        .agg(pieces.alias("pieces"))
        .select("tree", "rank", F.col("path_score").alias("score"), F.size("pieces").cast("long").alias("n_turns"),
                F.concat_ws("", F.transform("pieces", lambda p: p["turn"])).alias("formatted"))
    )


def parsed(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of role and text."""
    parts = F.split(formatted, r"<\|im_end\|>\n")
    turns = F.filter(parts, lambda p: p.startswith(START))

    def turn(part: Column) -> Column:
        body = F.substring(part, len(START) + 1, 1 << 30)
        line = F.instr(body, "\n")
        return F.struct(
            unescape_role(F.substring_index(body, "\n", 1)).alias("role"),
            unescape(F.substr(body, line + F.lit(1))).alias("text"),
        )

    return F.transform(turns, turn)


def loss_text(turns: Column) -> Column:
    """The text under the loss mask: that of the assistant's turns."""
    return F.concat_ws("", F.transform(F.filter(turns, lambda t: t["role"] == "assistant"), lambda t: t["text"]))


def as_trees(rows: DataFrame) -> DataFrame:
    """Rows of conv_id, turn, role, text as reply trees: each answers the one before it; ties by role and text."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"))
    placed = rows.select("conv_id", "turn", "role", "text").withColumn("node", F.row_number().over(order).cast("long"))
    # a conversation without an id is a tree of its own
    tree = F.coalesce("conv_id", F.lit(-(1 << 63)))
    return placed.select(
        tree.alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(1.0).alias("score")
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations hold, read back from them."""
    read = formatted.withColumn("turns", parsed(F.col("formatted"))).withColumn("loss", loss_text(F.col("turns")))
    whole = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return read.select(
        F.when(F.col("tree") != -(1 << 63), F.col("tree")).alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
