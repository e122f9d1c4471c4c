"""Chat formatting of reply trees.

Iterative self-joins follow the replies to their parents with doubled strides, so that a tree of depth d takes log2(d)
joins: they give every message its depth and the summed score of its path. Leaves are ranked within their tree, and
the chosen ones are followed back to the root with the same strides, the largest first, which enumerates their paths.
Texts join only then. Only SQL functions are used.

A conversation is written as turns ``<|im_start|>role\\n text <|im_end|>\\n`` (without the spaces). Texts and roles
can't contain ``<|``: each ``<``, backslashes and ``|`` in a row get one backslash more, and lose it again when read.
A newline in a role becomes ``<|nl|>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestone.session import stage

START, END, NEWLINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
#: The roles whose texts are under the loss mask.
LOSS_ROLES = ("assistant",)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*+)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*+)\|", r"<$1|")


def reply_chains(conversations: DataFrame) -> DataFrame:
    """Conversations by turn (conv_id, turn, role, text) as reply trees of a single branch.

    Each row replies to the one before it, in the order of turn, role and text (nulls first); rows with a null conv_id
    are one conversation. Repeated rows are turns of their own. Returns the messages that :func:`format_paths` takes,
    and ``conv_id``.
    """
    rows = conversations.select("conv_id", "turn", "role", "text")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumn("_n", F.row_number().over(order))
    tree = F.coalesce(F.col("conv_id").cast("string"), F.lit("none"))
    return rows.select(
        "conv_id",
        F.concat_ws("/", tree, "_n").alias("message_id"),
        F.when(F.col("_n") > 1, F.concat_ws("/", tree, F.col("_n") - 1)).alias("parent_id"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )


def _strides(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(node, root, depth, path_score) of all nodes (node, up, score) below a root, and the strides (node, up) of
    1, 2, 4, ... replies.

    A node's state is the sum over the nodes from it up to, but without, ``up``; null ``up``: up to the root. Nodes on
    or below a cycle never get there; when no node of those left gets nearer in a round, they are left out.
    """
    state = nodes.select("node", "up", F.lit(1).cast("long").alias("depth"), F.col("score").alias("path_score"), F.col("node").alias("top"))
    state = stage(state, "replies")
    strides, left = [], None
    while True:
        pending = state.where("up IS NOT NULL")
        n = pending.count()
        if n == 0 or n == left:
            break
        left = n
        strides.append(pending.select("node", "up"))
        above = state.select(
            F.col("node").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"),
            F.col("path_score").alias("more_score"), F.col("top").alias("next_top"),
        )
        moved = pending.join(above, "up").select(
            "node", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"),
            (F.col("path_score") + F.col("more_score")).alias("path_score"), F.col("next_top").alias("top"),
        )
        state = stage(state.where("up IS NULL").unionByName(moved), "replies")
    done = state.where("up IS NULL").select("node", F.col("top").alias("root"), "depth", "path_score")
    return done, strides


def format_paths(messages: DataFrame, branches: int | None = 1, loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """(root_id, leaf_id, rank, path_score, n_turns, formatted, loss_turns): conversations of the best ``branches``
    root-to-leaf paths of each tree, or of all paths if None.

    ``messages`` has message_id, parent_id, role, text and score; other columns are ignored. Paths rank by the mean
    score of their messages, higher first, then by leaf id. A message whose parent is null or isn't there is a root.
    Of rows that repeat a message_id one counts, the smallest by parent, role and text; a null message_id is one id
    like others, but nothing replies to it. Messages on or below a cycle are on no path. Null roles, texts and scores
    count as empty and 0. ``loss_turns`` has an entry for each turn: whether its text is under the loss mask.
    """
    fields = F.struct("parent_id", "role", "text", "score")
    rows = messages.select("message_id", "parent_id", "role", "text", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    rows = rows.groupBy("message_id").agg(F.min(fields).alias("m"))
    kept = rows.select(
        F.coalesce(F.col("message_id").cast("string"), F.lit("null")).alias("node"), "message_id",
        F.col("m.parent_id").cast("string").alias("parent"), F.coalesce("m.role", F.lit("")).alias("role"),
        F.coalesce("m.text", F.lit("")).alias("text"), "m.score",
    )
    kept = stage(kept, "messages")
    known = kept.where("message_id IS NOT NULL").select(F.col("node").alias("up"))
    linked = kept.join(known, kept["parent"] == known["up"], "left").select("node", "up", "score")
    paths, strides = _strides(linked)
    parents = linked.where("up IS NOT NULL").select(F.col("up").alias("node"))
    leaves = paths.join(parents, "node", "left_anti").withColumn("path_score", F.col("path_score") / F.col("depth"))
    order = Window.partitionBy("root").orderBy(F.desc("path_score"), "node")
    ranked = leaves.withColumn("rank", F.row_number().over(order))
    if branches is not None:
        ranked = ranked.where(F.col("rank") <= branches)
    ranked = stage(ranked, "leaves")
    on_path = ranked.select(F.col("node").alias("leaf"), "node")
    for stride in reversed(strides):
        # the state of a stride's round may end before the root: its ups are exactly so many replies above
        above = on_path.join(stride, "node").select("leaf", F.col("up").alias("node"))
        # written each time, as the plan would double with every stride
        on_path = stage(on_path.unionByName(above), "paths")
    depths = paths.select("node", "depth")
    turns = on_path.join(depths, "node").join(kept.select("node", "role", "text"), "node")
    role = F.replace(escaped(F.col("role")), F.lit("\n"), F.lit(NEWLINE))
    turn = F.concat(F.lit(START), role, F.lit("\n"), escaped(F.col("text")), F.lit(END + "\n"))
    entry = F.struct("depth", turn.alias("turn"), F.col("role").isin(*loss_roles).alias("loss"))
    made = turns.groupBy("leaf").agg(F.array_sort(F.collect_list(entry)).alias("turns"))
    return made.join(ranked, made["leaf"] == ranked["node"]).select(
        F.col("root").alias("root_id"), F.col("leaf").alias("leaf_id"), "rank", "path_score",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join("turns.turn", "").alias("formatted"),
        F.col("turns.loss").alias("loss_turns"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, unescaped."""
    parts = F.split(formatted, r"<\|im_start\|>", -1)
    parts = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        at = F.char_length(role) + 2
        text = F.substr(part, at, F.char_length(part) - at + 1 - len(END + "\n"))
        role = unescaped(F.replace(role, F.lit(NEWLINE), F.lit("\n")))
        return F.struct(role.alias("role"), unescaped(text).alias("text"))

    return F.transform(parts, turn)


def read_back(conversations: DataFrame) -> DataFrame:
    """(root_id, leaf_id, n_turns, turns, loss_text, formatted_chars) of the output of :func:`format_paths`, from its
    text: ``turns`` (role, text), and all text under the loss mask with nothing between."""
    rows = conversations.withColumn("turns", read_turns(F.col("formatted")))
    masked = F.filter(F.arrays_zip("turns", "loss_turns"), lambda t: t["loss_turns"])
    return rows.select(
        "root_id", "leaf_id", F.size("turns").cast("long").alias("n_turns"), "turns",
        F.array_join(F.transform(masked, lambda t: t["turns"]["text"]), "").alias("loss_text"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
