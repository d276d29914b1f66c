"""Chat formatting: reply trees to training conversations, with DataFrame functions only.

Every message names its parent. Self-joins of the ancestor relation, doubled
each round, reach any root in log2(depth) rounds; they give each leaf its
branch score, rank the leaves of a tree, and then enumerate the path of each
chosen leaf. A path is formatted as one conversation, with the spans of the
text that a loss is taken on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import release, table

#: The template's marks, and what counts as a control string inside a text.
START, END = "<|im_start|>", "<|im_end|>\n"
CONTROL = r"([<\[])(\\*)(\||/?s>|/?INST\])"
ESCAPED = r"([<\[])\\(\\*)(\||/?s>|/?INST\])"


def escape(text: Column) -> Column:
    """Puts a backslash behind the first character of every control string; a string that has some gets one more."""
    return F.regexp_replace(text, CONTROL, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    """Takes back what escape() did."""
    return F.regexp_replace(text, ESCAPED, r"$1$2$3")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    back = F.regexp_replace(unescape(role), r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return F.replace(back, F.lit("\\\\"), F.lit("\\"))


def chain(conversations: DataFrame) -> DataFrame:
    """The reply tree of plain conversations (conv_id, turn, role, text): each row answers the row before it.

    Rows go by turn, then role and text, nulls first; repeated rows stay and follow each other. The rows of a null
    conv_id are one conversation.
    """
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = conversations.select(F.col("conv_id").alias("tree"), "turn", "role", "text")
    return rows.withColumn("node", F.row_number().over(order).cast("long")).select(
        "tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score")
    )


def _ancestors(nodes: DataFrame) -> list[DataFrame]:
    """ups[k]: (tree, node, above, gain) for each node with an ancestor 2**k steps up; gain: the scores on the way."""
    parents = nodes.select("tree", F.col("node").alias("above"), F.col("score").alias("gain"))
    first = nodes.where("parent is not null").select("tree", "node", F.col("parent").alias("above"))
    ups = [table(first.join(parents, ["tree", "above"]).select("tree", "node", "above", "gain"), "up0")]
    most = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    while 2 ** len(ups) <= most:
        low = ups[-1]
        high = low.select("tree", F.col("node").alias("above"), F.col("above").alias("top"), F.col("gain").alias("more"))
        step = table(
            low.join(high, ["tree", "above"]).select("tree", "node", F.col("top").alias("above"), (F.col("gain") + F.col("more")).alias("gain")),
            f"up{len(ups)}",
        )
        if step.isEmpty():
            release(step)
            break
        ups.append(step)
    return ups


def branches(messages: DataFrame, keep: int | None = None) -> DataFrame:
    """Root-to-leaf paths: (tree, leaf, branch, branch_score, pos, node), pos from 0 at the root.

    messages: (tree, node, parent, score); node is unique in its tree. A branch's score is the sum of its messages'
    scores (null: 0); branch numbers rank a tree's leaves by score, ties to the smaller leaf. keep: how many
    branches of a tree to return, None for all. A parent that is null or missing makes a root. Messages that only
    reach a cycle belong to no root and are left out. A null tree counts as one tree.
    """
    return _unkeyed(_branches(_keyed(messages), keep))


def _keyed(messages: DataFrame) -> DataFrame:
    """messages with a struct in place of tree, which is not null where tree is and then equals itself in joins."""
    return messages.withColumn("tree", F.struct(F.col("tree").isNull().alias("none"), F.col("tree").alias("id")))


def _unkeyed(df: DataFrame) -> DataFrame:
    return df.withColumn("tree", F.col("tree.id"))


def _branches(messages: DataFrame, keep: int | None) -> DataFrame:
    """branches() of trees that are not null."""
    nodes = messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    ups = _ancestors(nodes)
    inner = ups[0].select("tree", F.col("above").alias("node")).distinct()
    ends = nodes.join(inner, ["tree", "node"], "left_anti").select("tree", F.col("node").alias("leaf"), F.col("node").alias("at"), F.col("score").alias("total"))
    for up in reversed(ups):
        jump = up.select("tree", F.col("node").alias("at"), "above", "gain")
        ends = ends.join(jump, ["tree", "at"], "left").select("tree", "leaf", F.coalesce("above", "at").alias("at"), (F.col("total") + F.coalesce("gain", F.lit(0.0))).alias("total"))
    roots = nodes.join(ups[0].select("tree", "node"), ["tree", "node"], "left_anti").select("tree", F.col("node").alias("at"))
    rank = Window.partitionBy("tree").orderBy(F.desc("total"), "leaf")
    chosen = ends.join(roots, ["tree", "at"], "left_semi").select("tree", "leaf", F.col("total").alias("branch_score"), F.row_number().over(rank).alias("branch"))
    if keep is not None:
        chosen = chosen.where(F.col("branch") <= keep)
    paths, before = chosen.select("*", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("up")), None
    for k, up in reversed(list(enumerate(ups))):  # the first table written has read all ups
        higher = paths.join(up.select("tree", "node", "above"), ["tree", "node"]).select(
            "tree", "leaf", "branch_score", "branch", F.col("above").alias("node"), (F.col("up") + 2**k).alias("up")
        )
        paths = table(paths.select("tree", "leaf", "branch_score", "branch", "node", "up").unionByName(higher), f"paths{k}")
        for old in (up, before):
            if old is not None:
                release(old)
        before = paths
    return paths


def format_trees(messages: DataFrame, keep: int | None = None, loss_role: str = "assistant") -> DataFrame:
    """One row for each chosen branch: (tree, leaf, branch, branch_score, n_turns, formatted, loss_spans).

    messages: (tree, node, parent, role, text, score); other columns are not looked at. Null role or text: empty.
    loss_spans: code points [start, end) of formatted that hold the text of loss_role's messages, in order.
    No messages give no rows. A null tree counts as one tree.
    """
    messages = _keyed(messages)
    paths = _branches(messages, keep)
    said = messages.select("tree", "node", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    head = F.concat(F.lit(START), _escape_role(F.col("role")), F.lit("\n"))
    whole = Window.partitionBy("tree", "leaf").orderBy(F.desc("up"))
    turns = (
        paths.join(said, ["tree", "node"])
        .select("tree", "leaf", "branch", "branch_score", "up", "role", head.alias("head"), escape(F.col("text")).alias("body"))
        .withColumn("size", F.length("head") + F.length("body") + len(END))
        .withColumn("start", F.sum("size").over(whole) - F.length("body") - len(END))
    )
    span = F.struct(F.col("start").alias("start"), (F.col("start") + F.length("body")).alias("end"))
    piece = F.struct((-F.col("up")).alias("pos"), F.concat("head", "body", F.lit(END)).alias("piece"), F.when(F.col("role") == loss_role, span).alias("span"))
    return _unkeyed(
        turns.groupBy("tree", "leaf")
        .agg(F.first("branch").alias("branch"), F.first("branch_score").alias("branch_score"), F.sort_array(F.collect_list(piece)).alias("pieces"))
        .select(
            "tree", "leaf", "branch", "branch_score", F.size("pieces").cast("long").alias("n_turns"),
            F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"),
            F.filter(F.transform("pieces", lambda p: p["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
        )
    )


def read_turns(formatted: Column) -> Column:
    """The turns in a formatted conversation: array<struct<role, text>>."""
    parts = F.split(formatted, r"<\|im_end\|>\n", -1)

    def turn(part: Column) -> Column:
        inner = F.substr(part, F.lit(len(START) + 1))
        role = F.substring_index(inner, "\n", 1)
        return F.struct(_unescape_role(role).alias("role"), unescape(F.substr(inner, F.length(role) + 2)).alias("text"))

    return F.transform(F.slice(parts, 1, F.size(parts) - 1), turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int")))), "")
