"""Reply trees to training conversations, with built-in functions only.

A reply tree is a table of nodes with a parent.  Its branches (root-to-leaf paths) are enumerated
by self-joins that double the distance they bridge: first node to ancestor 1, 2, 4, ... steps up,
then from the leaves down through the same tables, so that a tree of depth d takes about
2 log2(d) joins and never more rows than the paths themselves have.  Branches are ranked by
score, and each chosen one is written as one conversation.

Template: ``<turn>role<text>text</turn>`` and a line end, per turn.  In roles and texts a
backslash is written ``\\b``, ``<`` ``\\l`` and ``>`` ``\\g``, so no text can imitate a mark, and
undoing ``\\g``, ``\\l`` and then ``\\b`` gives it back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.workspace import store

OPEN, MIDDLE, CLOSE = "<turn>", "<text>", "</turn>\n"


def escape(text: Column) -> Column:
    for raw, code in (("\\", "\\b"), ("<", "\\l"), (">", "\\g")):
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for raw, code in ((">", "\\g"), ("<", "\\l"), ("\\", "\\b")):
        text = F.replace(text, F.lit(code), F.lit(raw))
    return text


def branches(nodes: DataFrame, trees: str = "tree", node: str = "node", parent: str = "parent") -> DataFrame:
    """(tree, leaf, node, up) for every node on every root-to-leaf path; ``up`` counts from the leaf.

    A root has a null parent or one that is not in its tree.  Nodes are unique in a tree.  A cycle
    is an error.  Null trees are left out; give them a value first.
    """
    known = store(nodes.select(F.col(trees).alias("tree"), F.col(node).alias("node"), F.col(parent).alias("parent")))
    heads = known.select("tree", F.col("node").alias("parent"))
    step = store(known.join(heads, ["tree", "parent"]).select("tree", "node", F.col("parent").alias("above")))
    steps, most = [], known.count()
    while not step.isEmpty():
        if 2 ** len(steps) >= most:
            raise ValueError("the replies form a cycle")
        steps.append(step)
        further = step.select("tree", F.col("node").alias("above"), F.col("above").alias("_next"))
        step = store(step.join(further, ["tree", "above"]).select("tree", "node", F.col("_next").alias("above")))

    above = known.select("tree", F.col("parent").alias("node")).distinct()
    leaves = known.join(above, ["tree", "node"], "left_anti")
    found = store(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")))
    for power in reversed(range(len(steps))):
        onward = found.join(steps[power], ["tree", "node"]).select(
            "tree", "leaf", F.col("above").alias("node"), (F.col("up") + 2**power).alias("up")
        )
        found = store(found.unionByName(onward))
    return found


def format_conversations(
    nodes: DataFrame, top: int | None = None, score: Column | None = None, trained_role: str = "assistant"
) -> DataFrame:
    """One conversation a chosen branch of (tree, node, parent, role, text).

    Returns tree, leaf, place (rank of the branch in its tree), n_turns, formatted and loss_spans
    (start and length in code points of every ``trained_role`` text within ``formatted``).
    ``score`` is an aggregate over the rows of a branch, by default the length of its trained
    texts; ties go to the smaller leaf.  ``top`` keeps the best branches of each tree, None all.

    Null roles and texts count as empty.  An empty table gives no rows.  A branch is one output
    value, so its turns meet in one task; nothing larger does.
    """
    told = nodes.select(
        "tree", "node", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    paths = branches(nodes).join(told, ["tree", "node"])
    if top is not None:
        worth = F.sum(F.when(F.col("role") == trained_role, F.length("text")).otherwise(0)) if score is None else score
        ranked = paths.groupBy("tree", "leaf").agg(worth.alias("_score"))
        order = Window.partitionBy("tree").orderBy(F.col("_score").desc(), "leaf")
        chosen = ranked.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top).drop("_score")
        paths = paths.join(chosen, ["tree", "leaf"])
    else:
        paths = paths.withColumn("place", F.lit(None).cast("int"))

    lead = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(MIDDLE))
    body = escape(F.col("text"))
    turn = paths.select(
        "tree", "leaf", "place", (-F.col("up")).alias("at"), "role",
        F.concat(lead, body, F.lit(CLOSE)).alias("turn"), F.length(lead).alias("lead"), F.length(body).alias("body"),
    )
    before = Window.partitionBy("tree", "leaf").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    placed = turn.withColumn("start", F.coalesce(F.sum(F.length("turn")).over(before), F.lit(0)) + F.col("lead"))
    span = F.struct("at", F.col("start").cast("long").alias("start"), F.col("body").cast("long").alias("length"))
    return (
        placed.groupBy("tree", "leaf", "place")
        .agg(
            F.count("*").alias("n_turns"),
            F.sort_array(F.collect_list(F.struct("at", "turn"))).alias("_turns"),
            F.sort_array(F.collect_list(F.when(F.col("role") == trained_role, span))).alias("_spans"),
        )
        .select(
            "tree", "leaf", "place", "n_turns",
            F.array_join(F.transform("_turns", lambda t: t["turn"]), "").alias("formatted"),
            F.transform("_spans", lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length"))).alias("loss_spans"),
        )
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of (role, text)."""
    pieces = F.filter(F.split(formatted, CLOSE), lambda piece: piece != "")
    marked = F.transform(pieces, lambda piece: F.split(F.substring(piece, len(OPEN) + 1, 2**31 - 1), MIDDLE))
    return F.transform(marked, lambda part: F.struct(unescape(part[0]).alias("role"), unescape(part[1]).alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped, in order."""
    pieces = F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return F.array_join(pieces, "")


def linear_trees(turns: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """(tree, conv_id, node, parent, role, text) of a table of turns: each turn replies to the one before.

    Turns with the same number are ordered by role and text, nulls first.  Rows with a null
    conv_id form one conversation.
    """
    picked = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    if extra is not None:
        picked = picked.unionByName(extra)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return picked.withColumn("node", F.row_number().over(order).cast("long")).select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("none")).alias("tree"),
        "conv_id", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text",
    )
