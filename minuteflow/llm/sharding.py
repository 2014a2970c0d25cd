"""Sharding by minimax contiguous partition.

Rows with equal texts are one atomic group. Groups are put in order of their
smallest ``doc_id``; the shards are runs of that order. The smallest capacity for
which greedy filling needs no more than ``shards`` shards is found by binary
search, and the order is cut where that filling cuts it (law ``bytes``).

Sizes and their running sums stay in a table. The greedy check needs, for each
shard, the last group end within the capacity, and for all capacities still in
question those ends lie in short windows of the running sum. When the windows
hold at most ``limit`` ends, these come to the driver and the search runs there;
until then a round of evenly spaced capacities is checked on the table and
narrows the range.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from minuteflow.llm.common import kept, running_sums

SHARDS = 16
LIMIT = 500_000
ROUND = 32


def row_size(text: Column) -> Column:
    """UTF-8 bytes plus one; null has no bytes."""
    return (F.octet_length(F.coalesce(text, F.lit(""))) + 1).cast("long")


def _ordered(groups: DataFrame) -> DataFrame:
    return running_sums(groups, ["first_id", "grp"], ["bytes", "n_rows"], "groups")


def _ends(ordered: DataFrame) -> DataFrame:
    return ordered.select((F.col("bytes_before") + F.col("bytes")).alias("end"))


def _greedy(ends: np.ndarray, capacity: int, shards: int, total: int) -> list[int] | None:
    """Where greedy filling cuts, or None where it needs more than ``shards`` shards.

    ``ends`` are the group ends near every cut in question.
    """
    cuts, at = [], 0
    for _ in range(shards):
        if total - at <= capacity:
            return cuts
        k = int(np.searchsorted(ends, at + capacity, "right")) - 1
        if k < 0 or ends[k] <= at:
            return None
        at = int(ends[k])
        cuts.append(at)
    return None


def _windows(low: int, high: int, largest: int, shards: int) -> list[tuple[int, int]]:
    """Where the i-th cut can lie for capacities from ``low`` to ``high``."""
    return [(i * (low - largest), i * high) for i in range(1, shards)]


def _in(windows: list[tuple[int, int]]) -> Column:
    hit = F.lit(False)
    for a, b in windows:
        hit = hit | ((F.col("end") > a) & (F.col("end") <= b))
    return hit


def _greedy_on_table(ends: DataFrame, capacities: list[int], shards: int, total: int) -> list[bool]:
    """Which capacities suffice, checked on the table, one pass per shard for all of them."""
    at = [0] * len(capacities)
    for _ in range(shards):
        targets = [a + c for a, c in zip(at, capacities, strict=True)]
        if all(t >= total for t in targets):
            break
        reached = ends.agg(
            *(F.max(F.when(F.col("end") <= t, F.col("end"))).alias(f"c{i}") for i, t in enumerate(targets))
        ).first()
        at = [total if t >= total else (r or 0) for t, r in zip(targets, reached, strict=True)]
    return [a >= total for a in at]


def smallest_capacity(
    ends: DataFrame, total: int, largest: int, shards: int, limit: int = LIMIT
) -> tuple[int, list[int]]:
    """The smallest capacity that suffices, and the cuts of its greedy filling.

    A capacity of the mean plus the largest group always suffices, and none
    below the mean or the largest group does.
    """
    low = max(largest, -(-total // shards))
    high = max(low, -(-total // shards) + largest)
    while low < high and ends.where(_in(_windows(low, high, largest, shards))).count() > limit:
        step = max(1, (high - low) // ROUND)
        trial = list(range(low, high, step))
        enough = _greedy_on_table(ends, trial, shards, total)
        if any(enough):
            k = enough.index(True)
            high = trial[k]
            low = trial[k - 1] + 1 if k else low
        else:
            low = trial[-1] + 1
    windows = _windows(low, high, largest, shards)
    if low == high:
        # One capacity is left: each cut is one look at the table.
        cuts, at = [], 0
        while total - at > low:
            at = ends.where(F.col("end") <= at + low).agg(F.max("end")).first()[0]
            cuts.append(at)
        return low, cuts
    near = np.sort(
        np.array([r.end for r in ends.where(_in(windows)).select("end").collect()], np.int64)
    )
    while low < high:
        middle = (low + high) // 2
        if _greedy(near, middle, shards, total) is None:
            low = middle + 1
        else:
            high = middle
    return low, _greedy(near, low, shards, total)


def sharded(docs: DataFrame, shards: int = SHARDS, limit: int = LIMIT) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard`` of every row.

    Equal texts share a shard; a null text counts as an empty one. Null ids come
    first among equal texts, and a group without any id comes first. ``slot``
    numbers the rows of a shard by group, then id, from 0. Repeated rows are rows
    of their own. ``grown_shard`` is null: this law moves rows when shards are
    added. Further columns are ignored, and an empty table gives no rows.
    """
    whole = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        row_size(F.col("text")).alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
        F.sha2(whole, 256).alias("grp"),
    )
    rows = kept(rows, "rows")
    groups = rows.groupBy("grp").agg(
        F.min("doc_id").alias("first_id"), F.sum("size").alias("bytes"), F.count("*").alias("n_rows")
    )
    ordered = _ordered(groups)
    ends = _ends(ordered)
    all_of = ordered.agg(F.sum("bytes").alias("total"), F.max("bytes").alias("largest")).first()
    cuts: list[int] = []
    if all_of.total:
        _, cuts = smallest_capacity(ends, all_of.total, all_of.largest, shards, limit)
    # A group belongs to the shard after as many cuts as lie at or before its start.
    shard = sum(
        ((F.col("bytes_before") >= cut).cast("int") for cut in cuts), F.lit(0)
    ).cast("int")
    dealt = ordered.select("grp", "first_id", shard.alias("shard"))
    placed = rows.join(dealt, "grp").select(
        "doc_id", "size", "text_crc32", "grp", "first_id", "shard", F.lit(1).cast("long").alias("one")
    )
    numbered = running_sums(placed, ["shard", "first_id", "grp", "doc_id"], ["one"], "slots")
    # One row per shard.
    starts, at = [], 0
    for r in sorted(numbered.groupBy("shard").count().collect(), key=lambda r: r.shard):
        starts.append(F.when(F.col("shard") == r.shard, at))
        at += r["count"]
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("one_before") - F.coalesce(*starts, F.lit(0))).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
