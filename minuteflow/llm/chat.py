"""Chat formatting of reply trees.

Native: everything on the path is DataFrame expressions.

A message names its tree, itself, its parent and a score. Self-joins that double
their reach list the path from every leaf up to its root; the branches of a tree
are ranked by the sum of their scores, and each chosen path becomes one
conversation.

Template: a prompt turn is ``[INST]role newline text[/INST]``, an assistant turn
is ``<s>role newline text</s>``. Inside roles and texts, backslash, ``<`` and
``[`` become ``\\0``, ``\\1`` and ``\\2``, so no control string can occur there
and the escape can be undone; a newline in a role becomes ``\\3``, a null role
is ``\\4``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from minuteflow.llm.common import kept

TOP_BRANCHES = 1
LEARNT = "assistant"


def escape(text: Column) -> Column:
    for plain, code in (("\\", "\\0"), ("<", "\\1"), ("[", "\\2")):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in (("[", "\\2"), ("<", "\\1"), ("\\", "\\0")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _role_out(role: Column) -> Column:
    return F.coalesce(F.replace(escape(role), F.lit("\n"), F.lit("\\3")), F.lit("\\4"))


def _role_in(role: Column) -> Column:
    plain = unescape(F.replace(role, F.lit("\\3"), F.lit("\n")))
    return F.when(role == "\\4", F.lit("")).otherwise(plain)


def linear_messages(turns: DataFrame) -> DataFrame:
    """Messages of plain conversations: every turn answers the one before it.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``. Equal turn numbers
    are ordered by role, then text; null turn numbers come first. Rows without
    a ``conv_id`` are one conversation.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = turns.select(
        F.col("conv_id").alias("tree"), F.row_number().over(order).alias("node"), "role", "text"
    )
    return numbered.select(
        "tree",
        F.col("node").cast("long").alias("node"),
        F.when(F.col("node") > 1, F.col("node") - 1).cast("long").alias("parent"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )


def leaf_paths(links: DataFrame) -> DataFrame:
    """(``tree``, ``leaf``, ``node``, ``up``): the path of every leaf, ``up`` steps above it.

    ``links`` has ``tree``, ``node`` and ``parent`` (null at roots). Each round joins
    the path rows with the links of reach 2^k, and the links with themselves,
    until no link is that long: as many rounds as the depth has binary digits.
    Each round adds the rows it reaches, and each row is made once. A parent that is not a message
    of its tree ends a path as a root does; links in a circle have no leaf.
    """
    links = links.select("tree", "node", "parent").distinct()
    own = links.select("tree", "node")
    parents = links.where("parent is not null").select("tree", F.col("parent").alias("node"))
    # Null trees are a tree of their own, so the joins are null-safe.
    same = lambda a, b, x, y: a["tree"].eqNullSafe(b["tree"]) & (a[x] == b[y])
    leaves = own.join(parents, same(own, parents, "node", "node"), "left_anti")
    leaves = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).alias("up"))
    paths = [kept(leaves, "leaves")]
    there = own.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    jumps = links.where("parent is not null").join(
        there, F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("n")), "left_semi"
    )
    jumps = kept(jumps.select("tree", "node", F.col("parent").alias("above")), "jumps-0")
    reach = 1
    while not jumps.isEmpty():
        step = jumps.select(F.col("tree").alias("t"), F.col("node").alias("n"), "above")
        longer = reduce(DataFrame.unionByName, paths).join(
            step, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n"))
        )
        longer = longer.select(
            "tree", "leaf", F.col("above").alias("node"), (F.col("up") + reach).alias("up")
        )
        paths.append(kept(longer, f"paths-{reach}"))
        # A jump of twice the reach: from a node to what its own jump's end jumps to.
        ends = jumps.select(
            F.col("tree").alias("t"), F.col("node").alias("n"), F.col("above").alias("far")
        )
        jumps = jumps.join(
            ends, F.col("tree").eqNullSafe(F.col("t")) & (F.col("above") == F.col("n"))
        ).select("tree", "node", F.col("far").alias("above"))
        reach *= 2
        jumps = kept(jumps, f"jumps-{reach}")
    return reduce(DataFrame.unionByName, paths)


def chosen_paths(messages: DataFrame, top: int = TOP_BRANCHES) -> DataFrame:
    """The messages on the ``top`` branches of every tree, with ``leaf``, ``branch`` and ``up``.

    Branches rank by the sum of their scores (null: 0), then by the smaller leaf.
    """
    paths = leaf_paths(messages)
    p = paths.select(F.col("tree").alias("t"), "leaf", F.col("node").alias("n"), "up")
    on = F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n"))
    scores = (
        p.join(messages.select("tree", "node", "score"), on)
        .groupBy("t", "leaf")
        .agg(F.sum(F.coalesce("score", F.lit(0.0))).alias("total"))
    )
    rank = Window.partitionBy("t").orderBy(F.desc("total"), "leaf")
    best = scores.withColumn("branch", F.row_number().over(rank)).where(F.col("branch") <= top)
    best = best.select(F.col("t").alias("bt"), F.col("leaf").alias("bl"), "branch")
    winners = p.join(best, F.col("t").eqNullSafe(F.col("bt")) & (F.col("leaf") == F.col("bl")))
    return winners.select("t", "leaf", "n", "up", "branch").join(messages, on).drop("t", "n")


def formatted(messages: DataFrame, top: int = TOP_BRANCHES) -> DataFrame:
    """One conversation per chosen path: ``tree``, ``branch``, ``n_turns``, ``formatted``, ``loss``.

    ``messages`` has ``tree``, ``node``, ``parent``, ``role``, ``text`` and ``score``; further
    columns are ignored. ``loss`` lists the ranges (``start``, ``length``, in code
    points of ``formatted``) of assistant texts. A null text is empty. Rows
    with a null ``node`` are left out. Repeated (tree, node) rows give
    repeated turns, ordered by role and text. A tree has one output row per
    path, so a path must fit into a row.
    """
    rows = chosen_paths(messages.where("node is not null"), top)
    learnt = F.coalesce(F.col("role") == LEARNT, F.lit(False))
    head = F.concat(F.when(learnt, "<s>").otherwise("[INST]"), _role_out(F.col("role")), F.lit("\n"))
    body = escape(F.coalesce("text", F.lit("")))
    tail = F.when(learnt, "</s>").otherwise("[/INST]")
    pieces = rows.select(
        "tree",
        "branch",
        (-F.col("up")).alias("at"),
        "role",
        "text",
        learnt.alias("learnt"),
        F.concat(head, body, tail).alias("piece"),
        F.length(head).alias("before"),
        F.length(body).alias("length"),
    )
    earlier = (
        Window.partitionBy("tree", "branch")
        .orderBy("at", "role", "text")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    begins = F.coalesce(F.sum(F.length("piece")).over(earlier), F.lit(0))
    placed = pieces.withColumn("start", (begins + F.col("before")).cast("int"))
    turn = F.struct("at", "role", "text", "start", "length", "piece", "learnt")
    joined = placed.groupBy("tree", "branch").agg(
        F.sort_array(F.collect_list(turn)).alias("turns")
    )
    return joined.select(
        "tree",
        "branch",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(
            F.filter("turns", lambda t: t["learnt"]),
            lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length")),
        ).alias("loss"),
    )


def parsed(text: Column) -> Column:
    """The turns of a formatted text as an array of (``role``, ``text``)."""
    pieces = F.regexp_extract_all(
        text, F.lit(r"\[INST\]([^\[<]*+)\[/INST\]|<s>([^\[<]*+)</s>"), F.lit(0)
    )

    def turn(piece: Column) -> Column:
        inner = F.regexp_replace(piece, r"^(\[INST\]|<s>)|(\[/INST\]|</s>)$", "")
        line = F.instr(inner, F.lit("\n"))
        return F.struct(
            _role_in(F.substring(inner, F.lit(1), line - 1)).alias("role"),
            unescape(F.substring(inner, line + 1, F.length(inner))).alias("text"),
        )

    return F.transform(pieces, turn)


def loss_texts(text: Column, loss: Column) -> Column:
    """The unescaped text of every range; one fixed-width copy makes each cut direct."""
    wide = F.encode(text, "UTF-32")
    return F.transform(
        loss,
        lambda s: unescape(
            F.decode(F.substring(wide, s["start"] * 4 + 1, s["length"] * 4), "UTF-32")
        ),
    )
