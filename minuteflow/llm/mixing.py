"""Mixing sources to target weights by Sainte-Laguë apportionment.

The mix is made of blocks of equally many words. Blocks are allocated to sources
one after the other, each to the source with the highest quotient target/(2n+1)
after n blocks; a shard of the mix is a run of that sequence, so its quotas are
whole numbers and add up over the shards. A source's documents are laid out in
seeded order and cut into blocks; shard after shard takes as many blocks as its
quota from where the last one stopped, as often round as it needs.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from minuteflow.llm.common import kept, running_sums, small_table

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
BLOCK_WORDS = 32
SHARDS = 16
SEED = 17


def size_in_words(text: Column) -> Column:
    """Number of words; null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def capped_targets(
    sizes: list[int], weights: list[float], total: float, max_repeats: int = MAX_REPEATS
) -> list[float]:
    """Shares of ``total`` by weight, none above ``max_repeats`` times its size.

    What a capped source can't take is shared anew among the others.
    """
    targets = [0.0] * len(sizes)
    open_ = [i for i, s in enumerate(sizes) if s > 0]
    left = float(total)
    while open_:
        weight = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / weight > max_repeats * sizes[i]]
        if not over:
            for i in open_:
                targets[i] = left * weights[i] / weight
            break
        for i in over:
            targets[i] = float(max_repeats * sizes[i])
        left -= sum(targets[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return targets


def sainte_lague(votes: list[float], seats: int, most: list[int]) -> list[int]:
    """Seats by highest quotients votes/(2n+1), ties to the earlier party, ``most`` at most each.

    The bulk is given at once: with divisor d a party has round(votes/d) seats,
    and all of these come before any quotient below d/2. Only the last few are given
    one by one.
    """
    seats = min(seats, sum(most))
    if seats <= 0 or not any(votes):
        return [0] * len(votes)
    v, m = np.array(votes), np.array(most)
    at = lambda d: np.minimum(np.floor(v / d + 0.5).astype(np.int64), m)
    low, high = 1e-12, 4.0 * v.max()  # at low there are too many, at high none
    for _ in range(200):
        middle = (low + high) / 2
        if at(middle).sum() <= seats:
            high = middle
        else:
            low = middle
    given = [int(x) for x in at(high)]
    heap = [(-votes[i] / (2 * g + 1), i) for i, g in enumerate(given) if g < most[i] and votes[i]]
    heapq.heapify(heap)
    for _ in range(seats - sum(given)):
        _, i = heapq.heappop(heap)
        given[i] += 1
        if given[i] < most[i]:
            heapq.heappush(heap, (-votes[i] / (2 * given[i] + 1), i))
    return given


def plan(
    sources: list[tuple[str | None, int]],
    weights: tuple[float, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    block: int = BLOCK_WORDS,
    shards: int = SHARDS,
) -> list[dict]:
    """Target and quotas of every (source, size); quotas are blocks per shard of the mix."""
    order = sorted(sources, key=lambda s: (s[0] is None, s[0] or ""))
    sizes = [s for _, s in order]
    total = sum(sizes)
    own = [weights[i % len(weights)] for i in range(len(order))]
    targets = capped_targets(sizes, own, total, max_repeats)
    blocks = -(-total // block)
    most = [max_repeats * -(-s // block) for s in sizes]
    upto = [
        sainte_lague(targets, blocks * (s + 1) // shards, most) for s in range(shards)
    ]
    return [
        {
            "source": name,
            "size": size,
            "target": targets[i],
            "quotas": [int(q) for q in np.diff([0, *(u[i] for u in upto)])],
        }
        for i, (name, size) in enumerate(order)
    ]


def shard_ranges(size: int, quotas: list[int], block: int = BLOCK_WORDS) -> list[tuple[int, int, int]]:
    """(shard, first, end): the words of a source's order that each shard takes.

    Shards take their blocks one after the other, round and round; a range ends at a
    round's end, so there is one per shard and round at most.
    """
    n_blocks, at, out = -(-size // block), 0, []
    for shard, quota in enumerate(quotas):
        while quota:
            first = at % n_blocks
            n = min(quota, n_blocks - first)
            out.append((shard, first * block, min((first + n) * block, size)))
            at, quota = at + n, quota - n
    return out


def mixed(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    block: int = BLOCK_WORDS,
    shards: int = SHARDS,
    seed: int = SEED,
) -> DataFrame:
    """Per row what the mix takes: ``doc_id``, ``source``, ``size``, ``source_size``, ``target``,
    ``taken``, ``shards`` (the words each shard takes of it), ``start`` (its place in the source's
    order) and ``row_key``.

    Sources rank by code point, null last, and weigh ``weights`` in turn. Null
    texts have no words and are never taken. A source without words has target 0.
    Equal rows are rows of their own, next to each other in the seeded order, which depends on the
    seed, id and text alone. Very long texts are cut by blocks like others. Further columns are
    ignored; an empty table gives no rows.

    The driver holds one row per source, as many as there are weights to give.
    """
    rows = docs.select(
        "doc_id",
        "source",
        size_in_words(F.col("text")).alias("size"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("row_key"),
    )
    placed = running_sums(rows, ["source", "row_key", "doc_id"], ["size"], "mix")
    sizes = placed.groupBy("source").agg(F.sum("size").alias("size")).collect()
    quotas = plan([(r.source, r["size"]) for r in sizes], weights, max_repeats, block, shards)
    # The range order has null first, then code points.
    table, at = [], 0
    for q in sorted(quotas, key=lambda q: (q["source"] is not None, q["source"] or "")):
        ranges = shard_ranges(q["size"], q["quotas"], block)
        table.append((q["source"], q["size"], q["target"], ranges, at))
        at += q["size"]
    kinds = (
        "s string, source_size long, target double,"
        " ranges array<struct<shard:int,first:long,end:long>>, base long"
    )
    lookup = F.broadcast(small_table(docs.sparkSession, table, kinds))
    joined = placed.join(lookup, F.col("source").eqNullSafe(F.col("s")))
    start = F.col("size_before") - F.col("base")
    end = start + F.col("size")
    parts = F.transform(
        F.filter("ranges", lambda r: (r["first"] < end) & (r["end"] > start)),
        lambda r: F.struct(
            r["shard"].alias("shard"),
            (F.least(r["end"], end) - F.greatest(r["first"], start)).alias("words"),
        ),
    )
    return joined.select(
        "doc_id", "source", "size", "source_size", "target",
        parts.alias("shards"), start.alias("start"), "row_key",
    ).select(
        "doc_id", "source", "size", "source_size", "target",
        F.aggregate("shards", F.lit(0).cast("long"), lambda a, x: a + x["words"]).alias("taken"),
        "shards", "start", "row_key",
    )


def whole_copies(docs: DataFrame, **options) -> DataFrame:
    """``doc_id``, ``row_key``, ``copies``: the mix in whole documents.

    A document is given as often as all its words are taken. What the mix takes of the one document at
    which a source's last round stops is made up by the documents that follow it in the source's order,
    passing by those larger than what is to be made up; the last one is given where that comes
    nearer to the target, and the document itself where that comes nearer still. A source of which the
    mix takes anything is never left empty: if nothing fits, its smallest document is given.

    The driver holds one row per source.
    """
    rows = mixed(docs, **options).where("size > 0")
    rows = kept(
        rows.select(
            "doc_id", "row_key", "source", "size", "start",
            F.floor(F.col("taken") / F.col("size")).alias("copies"),
            (F.col("taken") % F.col("size")).alias("part"),
        ),
        "whole",
    )
    begun = F.when(F.col("part") > 0, F.struct("start", "size", "part"))
    ends = rows.groupBy("source").agg(
        F.max(begun).alias("last"),
        F.sum(F.col("copies") * F.col("size")).alias("words"),
        F.min(F.struct("size", "start")).alias("least"),
    )
    ends = [r for r in ends.collect() if r.last is not None]
    kinds = "s string, at long, missing long"
    table = [(r.source, r.last.start, r.last.part) for r in ends]
    lookup = F.broadcast(small_table(docs.sparkSession, table, kinds))
    open_ = rows.join(lookup, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    open_ = open_.where("size <= missing").withColumn("wrapped", F.col("start") < F.col("at"))
    order = ["source", "wrapped", "start"]
    after = running_sums(open_, order, ["size"], "made-up")
    bases = {
        r.source: r.base
        for r in after.groupBy("source").agg(F.min("size_before").alias("base")).collect()
    }
    table = [(r.source, bases.get(r.source)) for r in ends]
    bases = F.broadcast(small_table(docs.sparkSession, table, "b string, base long"))
    after = after.join(bases, F.col("source").eqNullSafe(F.col("b")))
    before = F.col("size_before") - F.col("base")
    over = before + F.col("size") - F.col("missing")
    more = after.where((over <= 0) | ((before < F.col("missing")) & (over < F.col("missing") - before)))
    more = more.select("source", "start", "size")
    filled = {r.source: r.n for r in more.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    instead = []
    for r in ends:
        short = abs(r.last.part - filled.get(r.source, 0))
        if r.last["size"] - r.last.part < short:
            instead.append((r.source, r.last.start))
        elif not r.words and r.source not in filled:
            instead.append((r.source, r.least.start))
    instead = F.broadcast(small_table(docs.sparkSession, instead, "o string, o_start long"))
    more = more.select(F.col("source").alias("m"), F.col("start").alias("m_start"))
    more = more.join(instead.select("o").distinct(), F.col("m").eqNullSafe(F.col("o")), "left_anti")
    more = more.unionByName(instead.toDF("m", "m_start"))
    same = F.col("source").eqNullSafe(F.col("m")) & (F.col("start") == F.col("m_start"))
    given = rows.join(more, same, "left")
    n = F.col("copies") + F.col("m_start").isNotNull().cast("long")
    return (
        given.groupBy("doc_id", "row_key").agg(F.sum(n).cast("int").alias("copies")).where("copies > 0")
    )


def mixed_documents(docs: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """The rows of ``docs``, whole, as often as :func:`whole_copies` says.

    Columns of any name are handed on. Null and empty texts are gone, null ids and sources take part,
    equal rows share their copies, and an empty table gives none.
    """
    copies = whole_copies(docs, seed=seed, **options).select(
        F.col("doc_id").alias("taken_id"), F.col("row_key").alias("taken_key"), "copies"
    )
    packed = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col("doc_id").alias("id"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("key"),
    ).dropDuplicates(["id", "key"])
    same = F.col("id").eqNullSafe(F.col("taken_id")) & (F.col("key") == F.col("taken_key"))
    each = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return packed.join(copies, same).select("row", each).select("row.*")
