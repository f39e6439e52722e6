"""Reply trees as conversations: root-to-leaf paths, branches ranked by score, one text per chosen path.

Only DataFrame functions are used. A message has a tree, a node (unique in its tree), a parent, a role, a text and a
score. Paths are enumerated by self-joins with doubled strides: after round k every node knows the ancestor 2^k steps
up and the score between, so a path of n messages takes log2(n) rounds. Each round is written to the shared folder.

The template is ``<turn role>\\ntext\\n</turn>\\n``. In roles and texts ``&``, ``<`` and ``>`` become entities, so no
text can hold a mark, and unescaping gives back what was there. The loss mask lists the spans of assistant texts.

Defined cases: a NULL tree is a tree of its own; NULL roles, texts and scores count as empty and 0; a parent that does
not exist makes its node a root; nodes on or below a cycle have no root and belong to no path; equal scores rank the
smaller leaf first. A conversation is one row of the result, so its texts have to fit one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulseframe.sources.staging import stage

OPEN, HEAD_END, CLOSE = "<turn ", ">\n", "\n</turn>\n"
LOSS_ROLE = "assistant"


def escape(x: Column) -> Column:
    return F.replace(F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def unescape(x: Column) -> Column:
    return F.replace(F.replace(F.replace(x, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")), F.lit("&amp;"), F.lit("&"))


def strides(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Ancestor tables by stride, and of every node that reaches a root its depth and the score of its path.

    ``messages`` holds tree, node, parent and score. Table k holds (tree, node, up) with the ancestor 2^k steps up.
    """
    nodes = messages.select("tree", "node", "parent", "score")
    known = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("exists"))
    step = nodes.join(known, ["tree", "parent"], "left").select(
        "tree", "node", F.when(F.col("exists"), F.col("parent")).alias("up"), F.lit(1).cast("long").alias("depth"),
        F.coalesce("score", F.lit(0.0)).alias("total"),
    )
    tables, finished, open_before = [], [], None
    while True:  # a round only moves the nodes that have not reached a root yet
        table = stage(step, "strides")
        moving = table.where("up IS NOT NULL")
        finished.append(table.where("up IS NULL"))
        still_open = moving.count()
        if still_open == 0 or still_open == open_before:
            return tables, reduce(DataFrame.unionByName, finished).select("tree", "node", "depth", "total")
        tables.append(moving.select("tree", "node", "up"))
        open_before = still_open
        above = reduce(DataFrame.unionByName, [*finished, moving]).select(
            "tree", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("depth2"),
            F.col("total").alias("total2"),
        )
        step = moving.join(above, ["tree", "up"]).select(
            "tree", "node", F.col("up2").alias("up"), (F.col("depth") + F.col("depth2")).alias("depth"),
            (F.col("total") + F.col("total2")).alias("total"),
        )


def paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """The messages of the best ``branches`` root-to-leaf paths of every tree: tree, leaf, rank, node, depth."""
    tables, reached = strides(messages)
    parents = messages.where("parent IS NOT NULL").select("tree", F.col("parent").alias("node")).distinct()
    ranked = Window.partitionBy("tree").orderBy(F.desc("total"), "node")
    chosen = (
        reached.join(parents, ["tree", "node"], "left_anti")
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= branches)
        .select("tree", F.col("node").alias("leaf"), "rank", "node")
    )
    for table in reversed(tables):  # the longest strides first: every distance is a sum of some of them
        on_path = stage(chosen, "paths")
        higher = on_path.join(table, ["tree", "node"]).select("tree", "leaf", "rank", F.col("up").alias("node"))
        chosen = on_path.unionByName(higher)
    return chosen.join(reached.select("tree", "node", "depth"), ["tree", "node"])


def formatted(messages: DataFrame, branches: int = 1) -> DataFrame:
    """One row per chosen path: tree, leaf, rank, ``formatted`` text and ``loss_mask``, an array of (start, end)."""
    keyed = messages.withColumn("tree", F.struct(F.col("tree").alias("key")))  # equal to itself in joins if NULL
    return formatted_trees(keyed, branches).withColumn("tree", F.col("tree.key"))


def formatted_trees(messages: DataFrame, branches: int = 1) -> DataFrame:
    """``formatted`` for trees that are not NULL."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(OPEN), escape(role), F.lit(HEAD_END))
    turns = paths(messages, branches).join(
        messages.select("tree", "node", head.alias("head"), escape(text).alias("body"),
                        (role == LOSS_ROLE).alias("learned")),
        ["tree", "node"],
    )
    along = Window.partitionBy("tree", "leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("head") + F.length("body") + len(CLOSE)
    placed = turns.withColumn("start", F.coalesce(F.sum(size).over(along), F.lit(0)) + F.length("head"))
    span = F.when(F.col("learned"), F.struct("start", (F.col("start") + F.length("body")).alias("end")))
    return (
        placed.groupBy("tree", "leaf")
        .agg(
            F.first("rank").alias("rank"),
            F.array_sort(F.collect_list(
                F.struct("depth", F.concat("head", "body", F.lit(CLOSE)).alias("turn"), span.alias("span"))
            )).alias("turns"),
        )
        .select(
            "tree", "leaf", "rank",
            F.concat_ws("", F.col("turns.turn")).alias("formatted"),
            F.array_compact(F.col("turns.span")).alias("loss_mask"),
        )
    )


def turns_of(text: Column) -> Column:
    """Read a formatted text back: an array of (role, text)."""

    def turn(part: Column) -> Column:
        head = F.instr(part, HEAD_END)
        body = F.substring(part, head + len(HEAD_END), F.length(part) - head - len(HEAD_END) + 1 - len(CLOSE))
        return F.struct(
            unescape(F.substring(part, F.lit(1), head - 1)).alias("role"), unescape(body).alias("text")
        )

    parts = F.split(text, OPEN)
    return F.transform(F.slice(parts, F.lit(2), F.size(parts)), turn)


def learned_text(text: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped."""
    piece = lambda span: unescape(F.substring(text, span["start"].cast("int") + 1, (span["end"] - span["start"]).cast("int")))
    return F.concat_ws("", F.transform(mask, piece))


def conversation_messages(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as trees in which every row replies to the one before.

    Rows of a conversation are ordered by turn, then role, then text, NULLs first; repeated rows are turns of their own.
    """
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    keyed = rows.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("tree"), "turn", "role", "text")
    return keyed.withColumn("node", F.row_number().over(order).cast("long")).select(
        "tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text",
        F.lit(0.0).alias("score"),
    )


def conversation_digests(rows: DataFrame) -> DataFrame:
    """Format all conversations and describe what is read back from the formatted texts."""
    messages = stage(conversation_messages(rows), "messages")
    read = formatted_trees(messages).select(
        F.nullif(F.col("tree"), F.lit("")).cast("long").alias("conv_id"), "formatted",
        turns_of(F.col("formatted")).alias("turns"),
        learned_text(F.col("formatted"), F.col("loss_mask")).alias("learned"),
    )
    told = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
