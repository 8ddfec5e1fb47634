"""Chat formatting of reply trees, in DataFrame operations only.

Messages are nodes of trees. Iterative self-joins enumerate every path from the root to a
leaf: each round doubles the reach of the ancestor pointers, so a thread of n turns takes
log2(n) rounds. Paths are ranked by the sum of their messages' scores and each chosen path
becomes one conversation.

Template: ``<|im_start|>role\\n text <|im_end|>\\n`` for each turn, without the spaces. A
control string inside a text gets a backslash after its first character, one more if it
already has some, which ``unescaped`` takes back. Loss is on texts of assistants.

Null roles and texts are empty, a null tree id is a tree of its own, an empty table gives
none. Rows that tie in tree and turn become consecutive messages by role, then text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from laborloom.llm.shared import saved, text_or_empty

START, END, LOSS_ROLE = "<|im_start|>", "<|im_end|>\n", "assistant"
#: Control strings of this and other public chat templates, after their first character.
CONTROL = r"(\|im_start\|>|\|im_end\|>|/?s>|/?INST\]|</?SYS>>)"
TURNS_PER_BLOCK = 1024


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + CONTROL, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + CONTROL, "$1$2$3")


def _role_escaped(role: Column) -> Column:
    """The role on one line."""
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _role_unescaped(role: Column) -> Column:
    # Doubled backslashes are set aside while \n turns into a line feed.
    parts = F.split(unescaped(role), r"\\\\")
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def linear_trees(rows: DataFrame) -> DataFrame:
    """Conversations given as numbered turns, as trees in which each turn answers the one before.

    Turns are numbered anew inside blocks and the blocks then offset, so that a long
    conversation is not ordered by one task.
    """
    tree = F.when(F.col("conv_id").isNull(), F.lit("")).otherwise(F.col("conv_id").cast("string"))
    plain = rows.select(
        tree.alias("tree"), F.col("conv_id").alias("tree_id"), "turn",
        F.coalesce(F.floor(F.col("turn") / TURNS_PER_BLOCK), F.lit(-1 << 62)).alias("block"),
        text_or_empty("role").alias("role"), text_or_empty("text").alias("text"))
    inside = W.partitionBy("tree", "block").orderBy("turn", "role", "text")
    placed = plain.withColumn("place", F.row_number().over(inside))
    before = W.partitionBy("tree").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    sizes = plain.groupBy("tree", "block").agg(F.count(F.lit(1)).alias("turns"))
    offsets = sizes.select("tree", "block", F.coalesce(F.sum("turns").over(before), F.lit(0)).alias("earlier"))
    node = (F.col("earlier") + F.col("place")).cast("long")
    return placed.join(offsets, ["tree", "block"]).select(
        "tree", "tree_id", node.alias("node"), F.when(node > 1, node - 1).alias("parent"),
        "role", "text", F.lit(0.0).alias("score"))


def paths(messages: DataFrame) -> DataFrame:
    """(tree, leaf, distance, node): every message on the way from each leaf to its root.

    ``messages`` has tree, node and parent, null for a root. Only ids take part.
    """
    links = messages.select("tree", "node", "parent")
    parents = links.where("parent IS NOT NULL").select("tree", F.col("parent").alias("node")).distinct()
    leaves = links.join(parents, ["tree", "node"], "left_anti")
    found = saved(leaves.select("tree", F.col("node").alias("leaf"), F.lit(0).cast("long").alias("distance"), "node"))
    jumps = saved(links.where("parent IS NOT NULL").select("tree", "node", F.col("parent").alias("up")))
    reach = 1
    while not jumps.isEmpty():
        further = found.join(jumps, ["tree", "node"]).select(
            "tree", "leaf", (F.col("distance") + reach).alias("distance"), F.col("up").alias("node"))
        found = saved(found.unionByName(further))
        onward = jumps.select("tree", F.col("node").alias("up"), F.col("up").alias("far"))
        jumps = saved(jumps.join(onward, ["tree", "up"]).select("tree", "node", F.col("far").alias("up")))
        reach *= 2
    return found


def ranked_leaves(on_paths: DataFrame, messages: DataFrame, branches: int | None) -> DataFrame:
    """(tree, leaf, path_score), the ``branches`` best of each tree or all; ties go to the smaller leaf."""
    scores = on_paths.join(messages.select("tree", "node", "score"), ["tree", "node"])
    leaves = scores.groupBy("tree", "leaf").agg(F.sum("score").alias("path_score"))
    if branches is None:
        return leaves
    # The best of each salted part first, so that a tree with very many branches is not ranked by one task.
    for key in (["tree", F.pmod(F.xxhash64("leaf"), F.lit(64))], ["tree"]):
        best = W.partitionBy(*key).orderBy(F.col("path_score").desc(), "leaf")
        leaves = leaves.withColumn("place", F.row_number().over(best)).where(F.col("place") <= branches).drop("place")
    return leaves


def conversations(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """One row per chosen path: tree_id, leaf, path_score, formatted, segments.

    ``segments`` is ``formatted`` cut where the loss mask changes: structs of text and loss.
    """
    messages = saved(messages)
    on_paths = paths(messages)
    chosen = ranked_leaves(on_paths, messages, branches)
    if branches is not None:
        on_paths = on_paths.join(chosen, ["tree", "leaf"], "left_semi")
    head = F.concat(F.lit(START), _role_escaped(F.col("role")), F.lit("\n"))
    turn = F.array(
        F.struct(head.alias("text"), F.lit(False).alias("loss")),
        F.struct(escaped(F.col("text")).alias("text"), (F.col("role") == LOSS_ROLE).alias("loss")),
        F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")))
    pieces = on_paths.join(messages, ["tree", "node"]).select(
        "tree", "leaf", "tree_id", F.struct((-F.col("distance")).alias("at"), turn.alias("turn")).alias("piece"))
    gathered = pieces.groupBy("tree", "leaf").agg(
        F.first("tree_id").alias("tree_id"), F.sort_array(F.collect_list("piece")).alias("pieces"))
    segments = F.flatten(F.col("pieces")["turn"])
    return gathered.join(chosen, ["tree", "leaf"]).select(
        "tree_id", "leaf", "path_score", F.array_join(segments["text"], "").alias("formatted"),
        segments.alias("segments"))


def turns_read(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    turns = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, 1 << 30)
    return F.transform(turns, lambda t: F.struct(
        _role_unescaped(F.substring_index(t, "\n", 1)).alias("role"),
        unescaped(F.substring_index(t.substr(F.instr(t, "\n") + 1, F.length(t)), END, 1)).alias("text")))


def loss_read(segments: Column) -> Column:
    """All text under the loss mask, unescaped piece by piece."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")
