"""Conversations from reply trees.

Messages point to the message they answer. Self-joins on the ancestor link, each doubling the distance, enumerate the
root-to-leaf paths without ever holding a path in a row: after round k every message knows its ancestor 2^k steps up
and the summed score on the way. Leaves are ranked by their path's score; the best one's ancestors, found by going back
through the same links, are the conversation.

A turn is written as ``<turn role>text</turn>`` and a line end. Inside texts and roles a backslash, ``<`` and ``>`` are
written ``\\b``, ``\\l``, ``\\g``, so no text can hold a control string, and reading back restores it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.session import settle

ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))
CLOSE = "</turn>\n"


def escape(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def reply_chain(turns: DataFrame) -> DataFrame:
    """Messages ``tree, msg, parent, role, text, score`` of linear conversations: each row answers the one before.

    Rows stand by turn; rows of one turn by role and text. Null turns come first, null texts and roles are empty.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    chained = turns.select(
        F.col("conv_id").alias("tree"),
        F.row_number().over(order).cast("long").alias("msg"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.lit(1.0).alias("score"),
    )
    return chained.withColumn("parent", F.when(F.col("msg") > 1, F.col("msg") - 1))


def best_paths(messages: DataFrame) -> DataFrame:
    """The messages of each tree's best root-to-leaf path, with their ``depth`` from 0.

    ``messages``: ``tree, msg, parent, role, text, score``; ``msg`` is unique in its tree. A message without a parent,
    or whose parent is missing, is a root. Paths rank by the sum of their scores (null: 0), then length, then the
    leaf's ``msg``, smallest last. Messages on a cycle reach no root and are no path.
    """
    spark = messages.sparkSession
    same = [F.col("up.tree").eqNullSafe(F.col("x.tree"))]
    nodes = settle(messages.select("tree", "msg", "parent", F.coalesce("score", F.lit(0.0)).alias("score")))
    known = nodes.select("tree", F.col("msg").alias("parent"), F.lit(True).alias("found"))
    x, up = nodes.alias("x"), known.alias("up")
    linked = x.join(up, same[0] & (F.col("x.parent") == F.col("up.parent")), "left")
    jump = settle(linked.select("x.tree", "x.msg", F.when(F.col("up.found"), F.col("x.parent")).alias("up"), F.lit(1).cast("long").alias("steps"), F.col("x.score").alias("total")))
    rounds, total, size = [jump], jump, jump.count()
    while (1 << (len(rounds) - 1)) < max(size, 1) and not total.where("up is not null").isEmpty():
        # Messages whose path is known are done; only the others go on.
        x, up = total.where("up is not null").alias("x"), total.select("tree", F.col("msg").alias("at"), F.col("up").alias("next"), F.col("steps").alias("more"), F.col("total").alias("sum")).alias("up")
        joined = x.join(up, same[0] & (F.col("x.up") == F.col("up.at")))
        further = joined.select("x.tree", "x.msg", F.col("up.next").alias("up"), (F.col("x.steps") + F.col("up.more")).alias("steps"), (F.col("x.total") + F.col("up.sum")).alias("total"))
        total = settle(total.where("up is null").unionAll(further))
        rounds.append(total)
    # ``rounds[k]`` links a message to its ancestor 2^k up; where that is null its steps and total reach to the root.
    rooted = total.where("up is null")
    parents = jump.where("up is not null").select("tree", F.col("up").alias("at")).distinct().alias("up")
    leaves = rooted.alias("x").join(parents, same[0] & (F.col("x.msg") == F.col("up.at")), "left_anti")
    best = leaves.groupBy("tree").agg(F.max_by("msg", F.struct("total", "steps", F.negative("msg"))).alias("msg"))
    marked = settle(best)
    for links in reversed(rounds):
        x, up = marked.alias("x"), links.where("up is not null").select("tree", F.col("msg").alias("at"), F.col("up").alias("next")).alias("up")
        above = x.join(up, same[0] & (F.col("x.msg") == F.col("up.at"))).select("x.tree", F.col("up.next").alias("msg"))
        marked = settle(marked.unionAll(above).distinct())
    on_path = marked.alias("m").join(total.alias("t"), F.col("m.tree").eqNullSafe(F.col("t.tree")) & (F.col("m.msg") == F.col("t.msg"))).select("m.tree", "m.msg", (F.col("t.steps") - 1).alias("depth"))
    p = messages.alias("p")
    return p.join(on_path.alias("o"), F.col("p.tree").eqNullSafe(F.col("o.tree")) & (F.col("p.msg") == F.col("o.msg"))).select("p.*", "o.depth")


def format_paths(paths: DataFrame) -> DataFrame:
    """``tree, formatted``: the turns by depth, written one after the other."""
    turn = F.concat(F.lit("<turn "), escape(F.coalesce("role", F.lit(""))), F.lit(">"), escape(F.coalesce("text", F.lit(""))), F.lit(CLOSE))
    turns = paths.groupBy("tree").agg(F.array_sort(F.collect_list(F.struct("depth", turn.alias("turn")))).alias("turns"))
    return turns.select("tree", F.concat_ws("", F.transform("turns", lambda t: t["turn"])).alias("formatted"))


def read_back(formatted: Column) -> Column:
    """The turns ``array<struct<role, text>>`` a formatted conversation holds."""
    written = F.filter(F.split(formatted, CLOSE), lambda t: t != "")
    head = F.lit(len("<turn ") + 1)
    return F.transform(
        written,
        lambda t: F.struct(
            unescape(F.substring_index(F.substr(t, head), ">", 1)).alias("role"),
            unescape(F.substring_index(t, ">", -1)).alias("text"),
        ),
    )


def format_conversations(turns: DataFrame, trained: str = "assistant") -> DataFrame:
    """``conv_id, formatted, turns, loss`` per conversation; ``loss`` is the text of the ``trained`` role's turns.

    Rows without a conversation id are one conversation, with a null id. Null texts and roles are empty; repeated rows
    are turns of their own. An empty table gives none; other columns are not read.
    """
    messages = settle(reply_chain(turns.select("conv_id", "turn", "role", "text")))
    formatted = format_paths(best_paths(messages))
    read = formatted.withColumn("turns", read_back(F.col("formatted")))
    loss = F.concat_ws("", F.transform(F.filter("turns", lambda t: t["role"] == trained), lambda t: t["text"]))
    return read.select(F.col("tree").alias("conv_id"), "formatted", "turns", loss.alias("loss"))
