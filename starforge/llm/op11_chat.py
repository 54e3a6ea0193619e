"""Chat formatting of reply trees.

Every message knows the message it answers, so the messages of a tree hold
many conversations, one per root-to-leaf path. Iterative self-joins enumerate
them by pointer doubling: after round k a message knows its ancestor 2**k
steps up and the scores between, so a path of n messages takes log2(n) rounds,
on narrow rows without texts. Branches are then ranked by score, the chosen
leaves jump back down the written rounds to name every message of their path,
and each path becomes one formatted conversation.

Template: a turn is ``<turn role>text</turn>`` and a line feed. Inside a text
the control strings ``<turn`` and ``</turn`` get a backslash behind their
``<`` (one more, if there are some), so that no text can hold one; taking one
away restores the text. Roles are URL-encoded.

Defined results: a null text or role counts as empty. In ``from_turns`` rows
are ordered by turn, role and text, null first, and repeated rows are turns of
their own; rows with a null tree id form one tree. In ``from_replies`` rows of
one tree with the same id, null included, are one message (the smallest by
parent, role, text and score); a message whose parent is missing is a root,
and of a cycle of replies the smallest id becomes one. Branches that tie on score
rank the longer first, then the smaller leaf; a branch without scores comes
last. Empty tables give no conversations; other columns are ignored.

A conversation becomes one string, so it has to fit into one row; nothing else
of a tree is gathered: ranking first keeps the best branches of each slice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: Slices of a tree's branches that are ranked on their own first.
SALTS = 64


# ---- template

def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)(/?turn)", r"<\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)(/?turn)", r"<$1$2")


def head(role: Column) -> Column:
    return F.concat(F.lit("<turn "), F.url_encode(role), F.lit(">"))


TAIL = "</turn>\n"


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of (role, text)."""
    parts = F.split(formatted, "</turn>\n")
    return F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda p: F.struct(
        F.url_decode(F.substring_index(F.substr(p, F.lit(7)), ">", 1)).alias("role"),
        unescape(F.substr(p, F.instr(p, ">") + 1)).alias("text")))


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, joined without anything between. Spans
    are in UTF-8 bytes, so cutting one out needs no scan of the string."""
    data = F.encode(formatted, "utf-8")
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.decode(F.substr(data, s["start"] + 1, s["length"]), "utf-8"))), "")


# ---- messages

def from_turns(df: DataFrame, tree_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Messages of linear conversations: each turn answers the one before."""
    rows = df.select(df[tree_col].alias("tree"), df[turn_col].alias("turn"), df[role_col].alias("role"), df[text_col].alias("text"))
    node = F.row_number().over(Window.partitionBy("tree").orderBy("turn", "role", "text")).cast("long")
    return rows.select("tree", node.alias("node"), F.when(node > 1, node - 1).alias("parent"), "role", "text",
                       F.lit(None).cast("double").alias("score"))


def from_replies(df: DataFrame, tree_col: str = "tree_id", id_col: str = "message_id", parent_col: str = "parent_id",
                 role_col: str = "role", text_col: str = "text", score_col: str | None = None) -> DataFrame:
    """Messages of reply trees, one per id."""
    score = df[score_col].cast("double") if score_col else F.lit(None).cast("double")
    first = F.min(F.struct(df[parent_col].alias("parent"), df[role_col].alias("role"), df[text_col].alias("text"), score.alias("score")))
    return df.groupBy(df[tree_col].alias("tree"), df[id_col].alias("node")).agg(first.alias("m")).select("tree", "node", "m.*")


# ---- paths

def doubled(now: DataFrame, ended: list[DataFrame], name: str) -> DataFrame:
    """The rows of ``now`` that have an ancestor, twice as far up. Rows without
    one stay out of the join, so no task gathers them."""
    known = reduce(DataFrame.unionByName, ended, now).select(
        F.col("tree").alias("to_tree"), F.col("node").alias("to"), F.col("up").alias("next"), F.col("n").alias("more"), F.col("total").alias("sum"),
        F.col("scored").alias("count"), F.col("low").alias("least"))
    a = now.where("up IS NOT NULL")
    return materialize(
        a.join(known, a["tree"].eqNullSafe(known["to_tree"]) & (a["up"] == known["to"]), "left")
        .select("tree", "node", F.col("next").alias("up"), (F.col("n") + F.coalesce("more", F.lit(0))).alias("n"),
                (F.col("total") + F.coalesce("sum", F.lit(0.0))).alias("total"), (F.col("scored") + F.coalesce("count", F.lit(0))).alias("scored"),
                F.least("low", "least").alias("low")), name)


def climb(links: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Pointer doubling over (tree, node, parent, score): the rounds' jumps,
    and per message length, scores and sum of scores of its path to the root.
    Messages that never end lie on a cycle of replies or below one: the cycle is
    cut at its smallest id and climbing starts again."""
    first = links.select("tree", "node", F.col("parent").alias("up"), F.lit(1).cast("long").alias("n"), F.coalesce("score", F.lit(0.0)).alias("total"),
                         F.col("score").isNotNull().cast("long").alias("scored"), F.col("node").alias("low"))
    rounds, ended, now, rows = [], [], materialize(first, "reply-links"), None
    while True:
        rounds.append(now.where("up IS NOT NULL").select("tree", "node", "up"))
        ended.append(now.where("up IS NULL"))
        if rounds[-1].isEmpty():
            return rounds[:-1], reduce(DataFrame.unionByName, ended)
        rows = rows or now.count()
        if 2 ** (len(rounds) - 1) > rows:
            on = now.where("up IS NOT NULL").select("tree", F.col("up").alias("node")).distinct()
            cut = on.join(now.select("tree", "node", "low").withColumnsRenamed({"tree": "t", "node": "x"}),
                          F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("x"))).where("low = node").select("tree", "node")
            marked = cut.select(F.col("tree").alias("t"), F.col("node").alias("x"), F.lit(True).alias("goes"))
            left = links.join(marked, links["tree"].eqNullSafe(marked["t"]) & links["node"].eqNullSafe(marked["x"]), "left")
            return climb(materialize(left.select("tree", "node", F.when(F.col("goes").isNull(), F.col("parent")).alias("parent"), "score"), "reply-cut"))
        now = doubled(now, ended[:-1], f"reply-round-{len(rounds)}")


def chosen_leaves(links: DataFrame, path: DataFrame, branches: int) -> DataFrame:
    """(tree, leaf, rank, score) of each tree's best branches: first ranked in
    slices of a tree, so that a tree with most of the rows isn't one task."""
    parents = links.where("parent IS NOT NULL").select(F.col("tree").alias("t"), F.col("parent").alias("p"))
    leaf = path.join(parents, path["tree"].eqNullSafe(parents["t"]) & path["node"].eqNullSafe(parents["p"]), "left_anti")
    leaf = leaf.select("tree", F.col("node").alias("leaf"), F.when(F.col("scored") > 0, F.col("total") / F.col("scored")).alias("score"), "n")
    order = [F.col("score").desc_nulls_last(), F.col("n").desc(), F.col("leaf")]
    part = F.pmod(F.xxhash64("leaf"), F.lit(SALTS))
    best = (leaf.withColumn("slice", part).withColumn("rank", F.row_number().over(Window.partitionBy("tree", "slice").orderBy(*order)))
            .where(F.col("rank") <= branches))
    return (best.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(*order)))
            .where(F.col("rank") <= branches).select("tree", "leaf", "rank", "score"))


def steps_of(leaves: DataFrame, rounds: list[DataFrame]) -> DataFrame:
    """(tree, leaf, rank, score, node, far) for every message of the chosen
    paths: the longest jumps first, each message of a round staying and jumping."""
    steps = leaves.select("tree", "leaf", "rank", "score", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("far"))
    for k in reversed(range(len(rounds))):
        jump = rounds[k].select(F.col("tree").alias("t"), F.col("node").alias("x"), "up")
        both = steps.join(jump, steps["tree"].eqNullSafe(jump["t"]) & steps["node"].eqNullSafe(jump["x"]), "left")
        stay, go = F.struct("node", "far"), F.struct(F.col("up").alias("node"), (F.col("far") + 2 ** k).alias("far"))
        steps = (both.select("tree", "leaf", "rank", "score", F.explode(F.when(F.col("up").isNull(), F.array(stay)).otherwise(F.array(stay, go))).alias("s"))
                 .select("tree", "leaf", "rank", "score", "s.*"))
    return steps


def format_paths(messages: DataFrame, branches: int = 1, loss_role: str = "assistant") -> DataFrame:
    """One row per chosen path: tree, leaf, rank, score, n_turns, formatted,
    loss_spans (start and length in UTF-8 bytes of each text of ``loss_role``)."""
    messages = materialize(messages, "reply-messages")
    links = messages.select("tree", "node", "parent", "score")
    rounds, path = climb(links)
    steps = steps_of(chosen_leaves(links, path, branches), rounds)
    said = messages.select(F.col("tree").alias("t"), F.col("node").alias("x"), F.coalesce("role", F.lit("")).alias("role"),
                           escape(F.coalesce("text", F.lit(""))).alias("text"))
    turns = (steps.join(said, steps["tree"].eqNullSafe(said["t"]) & steps["node"].eqNullSafe(said["x"]))
             .withColumn("piece", F.concat(head(F.col("role")), "text", F.lit(TAIL))))
    path_key = Window.partitionBy("tree", "leaf")
    before = F.sum(F.octet_length("piece").cast("long")).over(path_key.orderBy(F.col("far").desc()).rowsBetween(Window.unboundedPreceding, -1))
    size = F.octet_length("text").cast("long")
    span = F.when(F.col("role") == loss_role, F.struct((F.coalesce(before, F.lit(0)) + F.octet_length(head(F.col("role")))).alias("start"), size.alias("length")))
    rows = turns.withColumn("span", span).groupBy("tree", "leaf").agg(
        F.first("rank").alias("rank"), F.first("score").alias("score"),
        F.sort_array(F.collect_list(F.struct((-F.col("far")).alias("at"), "piece", "span"))).alias("turns"))
    return rows.select("tree", "leaf", "rank", "score", F.size("turns").cast("long").alias("n_turns"),
                       F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
                       F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans"))


def digests(formatted: DataFrame, tree_col: str = "conv_id") -> DataFrame:
    """What each formatted conversation holds, read back from it."""
    turns, loss = read_turns(F.col("formatted")), read_loss(F.col("formatted"), F.col("loss_spans"))
    told = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return formatted.select(F.col("tree").alias(tree_col), F.size(turns).cast("long").alias("n_turns"),
                            F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"), F.char_length(loss).cast("long").alias("loss_chars"),
                            F.sha2(loss, 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"))
