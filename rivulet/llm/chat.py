"""Chat formatting of reply trees.

Root-to-leaf paths come from iterative self-joins by pointer doubling: after
round k every (leaf, ancestor) pair up to 2^(k+1) - 1 steps apart is known, so a
tree of depth d takes log2(d) joins and in all as many rows as its paths have
turns.  Branches are ranked by score; each chosen path is one conversation.

A turn is ``### role: text</turn>`` and a line feed.  Roles are URL-encoded;
texts double backslashes and get one inside ``</turn>`` and between any two
adjacent ``#``, so that neither control string occurs inside a text; unescaping
removes one backslash from each pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scratch import Scratch

HEAD, END = "### ", "</turn>\n"


def escape(text: Column) -> Column:
    text = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(F.replace(text, F.lit("</turn>"), F.lit("<\\/turn>")), "#(?=#)", r"#\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def chains(turns: DataFrame, tree: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows of plain conversations as reply trees: (tree, node, parent, score,
    role, text), each turn answering the one before.  Ties of a turn go by role,
    then text (nulls first); repeated rows are turns of their own."""
    w = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = turns.select(F.col(tree).alias("tree"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    node = F.row_number().over(w).cast("long")
    return rows.select("tree", node.alias("node"), "role", "text").select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), F.lit(0.0).alias("score"), "role", "text")


def paths(nodes: DataFrame, scratch: Scratch, branches: int = 1) -> DataFrame:
    """(tree, leaf, node, back, rank) for the ``branches`` best leaves of each
    tree: ``back`` counts the steps from the leaf.  A branch's score is the sum
    of its nodes' scores (null: 0); ties go to the smaller leaf.

    ``nodes``: tree, node (unique in its tree), parent (null: a root), score.
    A parent that is missing makes its child a root.  Null trees are one tree.
    Parents must not form a cycle.
    """
    same = lambda a, x, b, y: F.col(f"{a}.tree").eqNullSafe(F.col(f"{b}.tree")) & (F.col(f"{a}.{x}") == F.col(f"{b}.{y}"))
    inner = nodes.where("parent is not null").select("tree", F.col("parent").alias("node")).distinct()
    pairs = scratch.cut(nodes.alias("a").join(inner.alias("b"), same("a", "node", "b", "node"), "left_anti").select("tree", F.col("node").alias("leaf"), "node", F.lit(0).alias("back")), "leaves")
    up = scratch.cut(nodes.alias("a").join(nodes.alias("b"), same("a", "parent", "b", "node")).select("a.tree", "a.node", F.col("b.node").alias("above")), "up")
    step = 1
    while up.limit(1).count():
        more = pairs.alias("a").join(up.alias("b"), same("a", "node", "b", "node")).select("a.tree", "a.leaf", F.col("b.above").alias("node"), (F.col("a.back") + step).alias("back"))
        longer = scratch.cut(pairs.unionByName(more), "pairs")
        higher = scratch.cut(up.alias("a").join(up.alias("b"), same("a", "above", "b", "node")).select("a.tree", "a.node", "b.above"), "up")
        scratch.drop(pairs, up)
        pairs, up, step = longer, higher, 2 * step
    scored = pairs.alias("a").join(nodes.alias("b"), same("a", "node", "b", "node")).select("a.*", F.coalesce("b.score", F.lit(0.0)).alias("score"))
    leaves = scored.groupBy("tree", "leaf").agg(F.sum("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "leaf"))
    best = leaves.select("tree", "leaf", rank.alias("rank")).where(F.col("rank") <= branches)
    return pairs.alias("a").join(best.alias("b"), same("a", "leaf", "b", "leaf")).select("a.*", "b.rank")


def format_trees(nodes: DataFrame, branches: int = 1, trained: str = "assistant") -> DataFrame:
    """One row per chosen path: tree, rank, formatted, and ``loss_spans``, the
    array of (start, length) in code points of the escaped texts of turns by
    ``trained`` inside ``formatted``.  Null roles and texts count as empty.  No
    rows give no rows.
    """
    scratch = Scratch(nodes.sparkSession, "chat")
    nodes = scratch.cut(nodes, "nodes")
    chosen = paths(nodes.select("tree", "node", "parent", "score"), scratch, branches)
    same = F.col("a.tree").eqNullSafe(F.col("b.tree")) & (F.col("a.node") == F.col("b.node"))
    rows = chosen.alias("a").join(nodes.alias("b"), same).select("a.tree", "a.rank", "a.back", "b.role", "b.text")
    head = F.concat(F.lit(HEAD), F.url_encode(F.coalesce("role", F.lit(""))), F.lit(": "))
    rows = rows.withColumn("head", head).withColumn("body", escape(F.col("text")))
    size = F.length("head") + F.length("body") + len(END)
    w = Window.partitionBy("tree", "rank").orderBy(F.desc("back"))
    start = F.coalesce(F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.length("head")
    rows = rows.select("tree", "rank", (-F.col("back")).alias("pos"), F.concat("head", "body", F.lit(END)).alias("out"), F.when(F.col("role") == trained, F.struct(start.alias("start"), F.length("body").cast("long").alias("length"))).alias("span"))
    turns = F.array_sort(F.collect_list(F.struct("pos", "out", "span")))
    spans = F.filter(F.transform("turns", lambda t: t.span), lambda s: s.isNotNull())
    return rows.groupBy("tree", "rank").agg(turns.alias("turns")).select("tree", "rank", F.array_join(F.transform("turns", lambda t: t.out), "").alias("formatted"), spans.alias("loss_spans"))


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> read back from a formatted conversation."""
    parts = F.filter(F.split(formatted, r"\Q" + END + r"\E", -1), lambda p: p != "")

    def turn(p: Column) -> Column:
        colon = F.instr(p, ": ")
        return F.struct(F.url_decode(F.substring(p, F.lit(len(HEAD) + 1), colon - len(HEAD) - 1)).alias("role"), unescape(F.substring(p, colon + 2, F.length(p))).alias("text"))

    return F.transform(parts, turn)


def masked(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped and joined."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s.start + 1).cast("int"), s.length.cast("int")))), "")
