"""Reply trees as conversations: the best paths from root to leaf, formatted.

A message names its parent in the same tree. Jump pointers are doubled by
self-joins, so a path of n messages needs about log2(n) rounds; the pointers then
enumerate the paths of the chosen leaves. A branch's score is the sum of the
scores on its path; ties go to the longer path, then to the smaller leaf.

A null text or role is empty, a null score 0, and a null tree a tree of its own.
A message without parent, or whose parent is missing, is a root. Of rows with the
same tree and node the smallest (parent, role, text) counts. A message without
node has no place in a tree and is left out; messages on a cycle, or below one,
are on no path from a root. Other columns are not looked at. One conversation is
one output row, so its text meets in one task, in pieces of ``CHUNK`` turns that
are put together before.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotelake.llm.common import settle

TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"
CHUNK = 64


def escaped(text: Column) -> Column:
    """A backslash more in every ``<|``, so that no control string is left."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def escaped_role(role: Column) -> Column:
    """As ``escaped``, on one line."""
    one_line = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return escaped(one_line)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    turns = []
    for part in formatted.split(TURN_END + "\n")[:-1]:
        role, _, text = part[len(TURN_START) :].partition("\n")
        turns.append((unescape_role(role), unescape(text)))
    return turns


def read_loss(formatted: str, runs: list) -> list[str]:
    """The texts under the mask: ``runs`` are (characters to skip, to learn)."""
    texts, at = [], 0
    for skip, learn in runs:
        at += skip
        if learn:
            texts.append(unescape(formatted[at : at + learn]))
        at += learn
    return texts


def _same(left: DataFrame, right: DataFrame, of: str) -> Column:
    return left["tree"].eqNullSafe(right["up_tree"]) & (left[of] == right["up_node"])


def _as_target(steps: DataFrame) -> DataFrame:
    return steps.select([F.col(c).alias(f"up_{c}") for c in steps.columns])


def jump_pointers(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Jumps ``tree, node, above``, the k-th by 2^k messages, and the rooted nodes.

    A rooted node has the number and the score of the messages up to its root as
    ``hops`` and ``total``. A round works on the nodes whose root it has not reached.
    """
    nodes = messages.select("tree", "node", "parent", "score")
    known = nodes.select(F.col("tree").alias("up_tree"), F.col("node").alias("up_node"))
    steps = nodes.join(known, _same(nodes, known, "parent"), "left").select(
        "tree", "node", F.col("up_node").alias("above"), F.lit(1).cast("long").alias("hops"), F.col("score").alias("total")
    )
    steps = settle(steps, "chat-steps")
    rooted = steps.where("above is null")
    jumps, left_before = [], None
    while True:
        climbing = steps.where("above is not null")
        left = climbing.count()
        # A round reaches some root unless only cycles are left.
        if left == 0 or left == left_before:
            return jumps, rooted.drop("above")
        left_before = left
        jumps.append(climbing.select("tree", "node", "above"))
        up = _as_target(climbing.unionByName(rooted))
        steps = climbing.join(up, _same(climbing, up, "above")).select(
            "tree",
            "node",
            F.col("up_above").alias("above"),
            (F.col("hops") + F.col("up_hops")).alias("hops"),
            (F.col("total") + F.col("up_total")).alias("total"),
        )
        steps = settle(steps, "chat-steps")
        rooted = rooted.unionByName(steps.where("above is null"))


def best_paths(messages: DataFrame, best: int | None = 1) -> DataFrame:
    """``tree, leaf, rank, node, place``: the messages of the best paths in order.

    ``best`` is the number of paths for each tree, None for all.
    """
    jumps, ends = jump_pointers(messages)
    parents = messages.select(F.col("tree").alias("up_tree"), F.col("parent").alias("up_node"))
    parents = parents.where("up_node is not null").distinct()
    leaves = ends.join(parents, _same(ends, parents, "node"), "left_anti")
    order = Window.partitionBy("tree").orderBy(F.desc("total"), F.desc("hops"), "node")
    leaves = leaves.withColumn("rank", F.row_number().over(order))
    if best is not None:
        leaves = leaves.where(F.col("rank") <= best)
    path = leaves.select(
        "tree", F.col("node").alias("leaf"), "rank", "node", F.lit(0).cast("long").alias("height"), "hops"
    )
    path = settle(path, "chat-leaves")
    for power, jump in enumerate(jumps):
        up = _as_target(jump)
        higher = path.join(up, _same(path, up, "node")).select(
            "tree", "leaf", "rank", F.col("up_above").alias("node"), (F.col("height") + (1 << power)).alias("height"), "hops"
        )
        path = settle(path.union(higher), "chat-paths")
    return path.select("tree", "leaf", "rank", "node", (F.col("hops") - F.col("height") - 1).alias("place"))


def format_trees(messages: DataFrame, best: int | None = 1, learn_role: str = "assistant") -> DataFrame:
    """``tree, leaf, rank, formatted, loss_runs`` for the best paths of each tree.

    ``messages`` has ``tree, node, parent, role, text, score``. The mask in
    ``loss_runs`` is one (skip, learn) pair of code points for each turn to learn.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    whole = messages.select(
        "tree", "node", "parent", role.alias("role"), text.alias("text"), F.coalesce("score", F.lit(0.0)).cast("double").alias("score")
    )
    named = whole.where("node is not null").groupBy("tree", "node")
    one = named.agg(F.min(F.struct("parent", "role", "text", "score")).alias("row")).select("tree", "node", "row.*")
    one = settle(one, "chat-messages")
    path = best_paths(one.select("tree", "node", "parent", "score"), best)

    texts = one.select(F.col("tree").alias("up_tree"), F.col("node").alias("up_node"), "role", "text")
    turns = path.join(texts, _same(path, texts, "node")).select("tree", "leaf", "rank", "place", "role", "text")
    body = escaped(F.col("text"))
    head = F.concat(F.lit(TURN_START), escaped_role(F.col("role")), F.lit("\n"))
    tail = TURN_END + "\n"
    learn = F.when(F.col("role") == learn_role, F.length(body)).otherwise(-1)
    pieces = turns.select(
        "tree",
        "leaf",
        "rank",
        "place",
        F.concat(head, body, F.lit(tail)).alias("piece"),
        F.length(head).alias("lead"),
        learn.alias("learn"),
    )
    chunk = F.floor(F.col("place") / CHUNK)
    parts = pieces.groupBy("tree", "leaf", "rank", chunk.alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct("place", "piece", "lead", "learn"))).alias("turns")
    )
    parts = parts.select(
        "tree",
        "leaf",
        "rank",
        F.struct(
            "chunk",
            F.array_join(F.col("turns.piece"), "").alias("text"),
            F.transform(
                "turns", lambda t: F.struct(F.length(t["piece"]).alias("size"), t["lead"].alias("lead"), t["learn"].alias("learn"))
            ).alias("marks"),
        ).alias("part"),
    )
    whole = parts.groupBy("tree", "leaf", "rank").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    return whole.select(
        "tree",
        "leaf",
        "rank",
        F.array_join(F.col("parts.text"), "").alias("formatted"),
        F.flatten(F.col("parts.marks")).alias("marks"),
    ).select("tree", "leaf", "rank", "formatted", _runs(F.col("marks")).alias("loss_runs"))


def _runs(marks: Column) -> Column:
    """Two (skip, learn) pairs for a turn to learn, one for any other."""

    def runs(mark: Column) -> Column:
        def pair(skip: Column, learn: Column) -> Column:
            return F.struct(skip.cast("long").alias("skip"), learn.cast("long").alias("learn"))

        zero = F.lit(0)
        learned = pair(mark["lead"], mark["learn"])
        after = pair(mark["size"] - mark["lead"] - mark["learn"], zero)
        return F.when(mark["learn"] >= 0, F.array(learned, after)).otherwise(F.array(pair(mark["size"], zero)))

    return F.flatten(F.transform(marks, runs))


def turns_as_tree(conversations: DataFrame) -> DataFrame:
    """Each turn replies to the one before: by turn, then role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.withColumn("node", F.row_number().over(order).cast("long")).select(
        F.col("conv_id").alias("tree"),
        "node",
        F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )
