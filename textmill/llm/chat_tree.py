"""Chat formatting of reply trees, in DataFrame operations only.

Messages point to the message that they answer.  Self-joins that double their
reach give every message its root, its depth and the sum of scores above it,
so the number of joins grows with the logarithm of the deepest path.  Leaves
are ranked by the score of their path, and the path of each chosen leaf is
gathered by the same doubling steps and written as one conversation.

Template: every turn is ``### role: text</turn>`` and a line feed.  Inside
roles and texts a backslash becomes two, ``#`` becomes ``\\h``, ``<`` becomes
``\\l`` and, in roles, ``:`` becomes ``\\c``; so no control string can stand
inside them and unescaping restores them exactly.  The loss mask holds the
spans (first character, length) of the texts of the chosen roles.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

OPEN, COLON, CLOSE = "### ", ": ", "</turn>\n"


def escape(c: Column, role: bool = False) -> Column:
    out = F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("#"), F.lit("\\h")), F.lit("<"), F.lit("\\l"))
    return F.replace(out, F.lit(":"), F.lit("\\c")) if role else out


def unescape(c: Column) -> Column:
    """Doubled backslashes are found from the left, where escapes are whole;
    what stands between them is then free of doubt."""
    def plain(x: Column) -> Column:
        for code, char in (("\\h", "#"), ("\\l", "<"), ("\\c", ":")):
            x = F.replace(x, F.lit(code), F.lit(char))
        return x
    return F.array_join(F.transform(F.split(c, r"\\\\", -1), plain), "\\")


def paths(nodes: DataFrame, top: int) -> DataFrame:
    """(tree, leaf, rank, node, pos) of the ``top`` root-to-leaf paths of each
    tree.  ``nodes``: tree and node (not null, node unique in its tree),
    parent (null at a root), score (double).  A parent that does not exist
    makes its message a root.  Ties of the score go to the smaller leaf."""
    above = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    state = nodes.join(above, ["tree", "parent"], "left").select(
        "tree", "node", F.when(F.col("known"), F.col("parent")).alias("up"), F.col("score").alias("total"), F.lit(1).alias("depth"))
    state = stored(state, "chat-up-0")
    leaves_of = state.where("up is not null").select("tree", F.col("up").alias("node")).distinct()
    leaf = state.join(leaves_of, ["tree", "node"], "left_anti").select("tree", "node")
    deepest = state.count()
    done, open_ = [state.where("up is null")], state.where("up is not null")
    jumps = []  # jumps[k]: the message 2^k answers above
    while open_.limit(1).count():  # messages that have reached their root take no further part
        jumps.append(open_.select("tree", "node", "up"))
        if 1 << len(jumps) > 2 * deepest:  # no path is longer than all messages
            raise ValueError("the replies form a cycle")
        far = functools.reduce(DataFrame.unionByName, done, open_).select(
            "tree", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("total").alias("more"), F.col("depth").alias("steps"))
        state = stored(open_.join(far, ["tree", "up"]).select(
            "tree", "node", F.col("up2").alias("up"), (F.col("total") + F.col("more")).alias("total"),
            (F.col("depth") + F.col("steps")).alias("depth")), f"chat-up-{len(jumps)}")
        done, open_ = [*done, state.where("up is null")], state.where("up is not null")
    state = functools.reduce(DataFrame.unionByName, done)
    order = Window.partitionBy("tree").orderBy(F.desc("total"), "node")
    chosen = (state.join(leaf, ["tree", "node"], "left_semi").withColumn("rank", F.row_number().over(order))
              .where(F.col("rank") <= top).select("tree", F.col("node").alias("leaf"), "rank", "node", F.col("depth").alias("pos")))
    for k, jump in enumerate(jumps):
        higher = chosen.join(jump, ["tree", "node"]).select("tree", "leaf", "rank", F.col("up").alias("node"), (F.col("pos") - (1 << k)).alias("pos"))
        chosen = stored(chosen.unionByName(higher), f"chat-path-{k}")
    return chosen


def format_paths(messages: DataFrame, turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(tree, leaf, rank, n_turns, formatted, loss): one conversation for each
    path of ``turns`` (see paths).  ``messages``: tree, node, role, text; null
    roles and texts count as empty.  loss: array of (first, size) in
    characters of ``formatted``, first counted from 1, in order."""
    text, role = (F.coalesce(F.col(c), F.lit("")) for c in ("text", "role"))
    head = F.concat(F.lit(OPEN), escape(role, True), F.lit(COLON))
    body = escape(text)
    parts = turns.join(messages.select("tree", "node", "role", "text"), ["tree", "node"]).select(
        "tree", "leaf", "rank", "pos", F.concat(head, body, F.lit(CLOSE)).alias("part"),
        F.char_length(head).alias("lead"), F.char_length(body).alias("size"), role.isin(*loss_roles).alias("learn"))
    before = F.sum(F.char_length("part")).over(Window.partitionBy("tree", "leaf").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("first", (F.coalesce(before, F.lit(0)) + F.col("lead") + 1).cast("int"))
    row = F.struct("pos", "part", "first", "size", "learn")
    return (parts.groupBy("tree", "leaf", "rank").agg(F.sort_array(F.collect_list(row)).alias("r"))
            .select("tree", "leaf", "rank", F.size("r").cast("long").alias("n_turns"), F.array_join("r.part", "").alias("formatted"),
                    F.transform(F.filter("r", lambda x: x["learn"]), lambda x: F.struct(x["first"], x["size"])).alias("loss")))


def read_back(formatted: Column) -> Column:
    """The turns, array of (role, text), of a formatted conversation."""
    parts = F.split(formatted, CLOSE, -1)

    def turn(p: Column) -> Column:
        end = F.locate(COLON, p)
        role = F.substring(p, F.lit(len(OPEN) + 1), end - len(OPEN) - 1)
        return F.struct(unescape(role).alias("role"), unescape(F.substring(p, end + len(COLON), F.char_length(p))).alias("text"))

    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), turn)


def learned_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(formatted, s["first"], s["size"]))), "")


def reply_chain(conversations: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Linear conversations as reply trees: (tree, conv, node, parent, score,
    role, text).  Rows are ordered by turn (nulls first), ties by role and
    text, and each answers the one before.  Null ids form one conversation.
    Repeated rows are turns of their own."""
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    return (conversations.select(F.coalesce(F.concat(F.lit("c"), F.col(id_col).cast("string")), F.lit("none")).alias("tree"),
                                 F.col(id_col).alias("conv"), "turn", "role", "text")
            .withColumn("node", F.row_number().over(order).cast("long"))
            .select("tree", "conv", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), F.lit(0.0).alias("score"), "role", "text"))


def format_conversations(conversations: DataFrame, id_col: str = "conv_id", loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(id, n_turns, formatted, loss), one row per conversation.  An empty
    table gives an empty result; other columns are not read."""
    messages = stored(reply_chain(conversations, id_col), "chat-messages")
    ids = messages.where("node = 1").select("tree", F.col("conv").alias(id_col))
    out = format_paths(messages, paths(messages, top=1), loss_roles)
    return out.join(ids, "tree").select(id_col, "n_turns", "formatted", "loss")
