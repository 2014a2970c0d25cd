"""Near-duplicate groups with SuperMinHash signatures.

A document's set holds the hashes of its word shingles. In a SuperMinHash
signature every element visits the slots in an order of its own and leaves
rank + fraction there; a slot keeps the smallest value. Ranks are visited level
by level, and a document stops at the level where all its slots are filled,
since later ranks are larger: long texts take one or two levels.

Equal sets are one node. Nodes that agree in all slots of a band are
candidates; these are confirmed on their full sets, and linked nodes are
united. First every member of a band's bucket is compared with the bucket's
smallest node. Then, in buckets whose members are still in different groups, all
pairs across groups are compared by parity sketches, in blocks, and those that
may be linked are confirmed. A sketch has one bit per hash class of elements, set if
the set has an odd number of them; two sketches differ in no more bits than the
sets in elements, so no link is ruled out. A large group of copies
costs one comparison per member and band, and no pair that shares a band is left out.

With 32 bands of 4 slots a pair with 80 % common shingles shares no band with
probability (1 - 0.8^4)^32 = 5e-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from minuteflow.llm.common import (
    arrow_schema,
    few_tasks,
    kept,
    mixed,
    slices,
    text_bytes,
    window_hashes,
    word_hashes,
)
from minuteflow.llm.graph import components

SHINGLE = 5
PERCENT = 80
BANDS = 32
ROWS = 4
BLOCK = 1_000
_SKETCH_BITS = 2048
_SETS_AT_ONCE = 500
_EMPTY_SLOT = np.uint64(0xFFFFFFFFFFFFFFFF)
_GOLDEN_INT = 0x9E3779B97F4A7C15
_GOLDEN = np.uint64(_GOLDEN_INT)


def shingles(text: bytes, length: int = SHINGLE) -> np.ndarray:
    """The sorted hashes of a text's different shingles.

    A-Z are lower-cased. Fewer than ``length`` words are one shingle; none, no shingle.
    """
    h = word_hashes(text.lower().split())
    return np.unique(window_hashes(h, min(length, max(1, len(h)))))


def super_minhash(sets: list[np.ndarray], size: int) -> np.ndarray:
    """A row of ``size`` (at most 256) slots per set: rank in the top byte, fraction below.

    The slots of an empty set stay at the largest number.
    """
    out = np.full(len(sets) * size, _EMPTY_SLOT)
    elements = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    swaps: list[np.ndarray] = []
    for rank in range(size):
        state = mixed(elements + np.uint64(_GOLDEN_INT * (2 * rank + 1) % (1 << 64)))
        # The rank-th step of a Fisher-Yates shuffle of the slots, for every element.
        swap = (rank + (state >> np.uint64(32)) % np.uint64(size - rank)).astype(np.int64)
        slot = swap.copy()
        for k in range(rank - 1, -1, -1):
            slot[slot == swaps[k]] = k
        fraction = mixed(state + _GOLDEN) >> np.uint64(8)
        np.minimum.at(out, owner * size + slot, fraction | np.uint64(rank << 56))
        open_ = (out.reshape(-1, size) == _EMPTY_SLOT).any(1)[owner]
        if not open_.any():
            break
        swaps = [s[open_] for s in (*swaps, swap)]
        elements, owner = elements[open_], owner[open_]
    return out.reshape(-1, size)


def parity_sketch(elements: np.ndarray) -> bytes:
    classes = (mixed(elements) % np.uint64(_SKETCH_BITS)).astype(np.int64)
    return np.packbits(np.bincount(classes, minlength=_SKETCH_BITS) & 1).tobytes()


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A hash per signature and band; equal slots of one band give equal keys."""
    keys = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(signatures), 1))
    for r in range(rows):
        keys = mixed(keys * _GOLDEN + signatures[:, r::rows][:, :bands])
    return keys


_SIGNED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("row_key", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("node", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType(), False)),
        T.StructField("sketch", T.BinaryType()),
    ]
)


def _with_row_key(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), "text")


def signed(
    docs: DataFrame, length: int = SHINGLE, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """Per row its set's size, hash (``node``), band keys and parity sketch."""
    schema = arrow_schema(_SIGNED)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, _SETS_AT_ONCE):
            sets = [shingles(t, length) for t in text_bytes(batch.column(2))]
            signatures = super_minhash(sets, bands * rows)
            keys = band_keys(signatures, bands, rows).view(np.int64)
            nodes = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            listed = pa.ListArray.from_arrays(
                pa.array(np.arange(len(sets) + 1) * bands, pa.int32()),
                pa.array(keys.reshape(-1)),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(nodes, pa.binary()),
                    listed.cast(schema.field("bands").type),
                    pa.array([parity_sketch(s) for s in sets], pa.binary()),
                ],
                schema=schema,
            )

    return _with_row_key(docs).mapInArrow(sign, _SIGNED)


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sets have at least ``percent`` of their union in common."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def confirmed(
    pairs: DataFrame, nodes: DataFrame, docs: DataFrame, length: int, percent: int
) -> DataFrame:
    """Of ``pairs`` (``a``, ``b``), those linked by their full sets.

    ``nodes`` names a row of ``docs`` per node (``row_key``). Texts are dealt once
    to fetch those of the nodes in question, then brought together pair by pair.
    """
    asked = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    keys = asked.join(nodes.select("node", "row_key"), "node")
    texts = _with_row_key(docs).drop("doc_id").join(keys, "row_key").dropDuplicates(["node"])
    texts = kept(texts.select("node", "text"), "texts")
    first = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    together = pairs.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lefts, rights = text_bytes(batch.column(2)), text_bytes(batch.column(3))
            known: dict[bytes, np.ndarray] = {}

            def own(text: bytes) -> np.ndarray:
                if text not in known:
                    if len(known) > 200:
                        known.clear()
                    known[text] = shingles(text, length)
                return known[text]

            good = [linked(own(x), own(y), percent) for x, y in zip(lefts, rights, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return kept(together.mapInArrow(check, pairs.schema), "links")


def _star_pairs(buckets: DataFrame) -> DataFrame:
    pivots = buckets.groupBy("key").agg(F.min("node").alias("a"))
    stars = buckets.join(pivots, "key").where("a != node")
    return stars.select("a", F.col("node").alias("b")).distinct()


_LIKELY_PAIRS = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])


def _cross_pairs(
    buckets: DataFrame, roots: DataFrame, sketches: DataFrame, percent: int, block: int
) -> DataFrame:
    """Pairs of nodes of different groups that share a bucket and whose sketches allow a link.

    A pair is given in the first band it shares, hence once.

    Buckets with one group need nothing. A large bucket is cut into blocks of about ``block`` nodes,
    and every pair of blocks is a task's group of its own.
    """
    labelled = buckets.join(roots, "node", "left").select(
        "key", "node", F.coalesce("root", "node").alias("root")
    )
    open_ = (
        labelled.groupBy("key")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("rows"))
        .where("low != high")
        .select("key", F.ceil(F.col("rows") / block).cast("int").alias("blocks"))
    )
    members = labelled.join(open_, "key").join(sketches, "node")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    spread = members.withColumn("own", own).select(
        "key",
        "node",
        "root",
        "sketch",
        "n",
        "bands",
        "own",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    )
    dealt = spread.select(
        F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("task"),
        "node",
        "root",
        "sketch",
        "n",
        "bands",
        "key",
    )
    sorted_ = dealt.repartition("task").sortWithinPartitions("task")

    def compare(rows: list[tuple]) -> Iterator[tuple[bytes, bytes]]:
        roots_ = np.array([int.from_bytes(r[2], "big") for r in rows], object)
        names, codes = np.unique(roots_, return_inverse=True)
        if len(names) < 2:
            return
        matrix = np.frombuffer(b"".join(r[3] for r in rows), np.uint64).reshape(len(rows), -1)
        sizes = np.array([r[4] for r in rows])
        bands = np.array([r[5] for r in rows])
        here = int(np.argmax(bands[0] == rows[0][6]))
        largest = np.bincount(codes).argmax()
        # Every pair across groups has a member outside the largest group.
        for i in np.flatnonzero(codes != largest):
            apart = np.bitwise_count(matrix ^ matrix[i]).sum(1, dtype=np.int64)
            apart = np.maximum(apart, np.abs(sizes - sizes[i]))
            # With d elements apart, (n + m - d) / (n + m + d) is the share in common.
            both = sizes + sizes[i]
            may = 100 * (both - apart) >= percent * (both + apart)
            may &= ~(bands[:, :here] == bands[i, :here]).any(1)
            for j in np.flatnonzero(may & (codes != codes[i])):
                if codes[j] == largest or j > i:
                    yield tuple(sorted((rows[i][1], rows[j][1])))

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, found = [], set()

        def made() -> pa.RecordBatch:
            lists = list(zip(*found, strict=True)) if found else [[], []]
            return pa.RecordBatch.from_arrays(
                [pa.array(x, pa.binary()) for x in lists], names=["a", "b"]
            )

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and group[-1][0] != row[0]:
                    found.update(compare(group))
                    group = []
                group.append(row)
            if len(found) > 100_000:
                yield made()
                found.clear()
        if group:
            found.update(compare(group))
        yield made()

    return sorted_.mapInArrow(cross, _LIKELY_PAIRS).distinct()


def near_duplicates(
    docs: DataFrame,
    length: int = SHINGLE,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """Per row ``doc_id``, ``row_key``, ``n_shingles``, ``component_id`` and ``kept``.

    Rows are linked if they have at least ``percent`` of their shingles of
    ``length`` words in common; ``component_id`` is the smallest id of the rows
    reached. ``kept`` marks the rows of the group's first text with that id, so
    repeated rows are all marked. Null and empty texts are linked with nothing.
    Rows without an id take part; a group without any id has a null
    ``component_id``, and its first text is kept. Further columns are ignored.
    """
    table = kept(signed(docs, length, bands, rows), "signatures")
    full = table.where("node is not null")
    nodes = full.groupBy("node").agg(
        F.min("doc_id").alias("first_id"),
        F.min("row_key").alias("row_key"),
        F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch"),
        F.first("n_shingles").alias("n"),
    )
    nodes = kept(nodes, "nodes")
    members = nodes.select("node", F.explode("bands").alias("key"))
    shared = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    buckets = kept(members.join(shared, "key"), "buckets")
    pairs = kept(few_tasks(_star_pairs(buckets)), "pairs")
    links = confirmed(pairs, nodes, docs, length, percent)
    roots = components(links)
    sketches = nodes.select("node", "sketch", "n", "bands")
    across = _cross_pairs(buckets, roots, sketches, percent, block)
    across = kept(across.join(pairs, ["a", "b"], "left_anti"), "cross-pairs")
    if not across.isEmpty():
        more = confirmed(across, nodes, docs, length, percent)
        joined = more.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        roots = components(joined)
    grouped = nodes.select("node", "first_id").join(roots, "node", "left")
    grouped = grouped.withColumn("root", F.coalesce("root", "node"))
    # The group's first text: the one of the smallest id, or of the smallest node.
    first = grouped.groupBy("root").agg(
        F.min("first_id").alias("component_id"),
        F.min(F.struct(F.col("first_id").isNull().alias("none"), "first_id", "node")).alias("head"),
    )
    placed = grouped.join(first, "root").select(
        "node", "component_id", (F.col("head")["node"] == F.col("node")).alias("is_head")
    )
    columns = ["doc_id", "row_key", "n_shingles", "component_id", "kept"]
    own = F.col("doc_id").eqNullSafe(F.col("component_id")) & F.col("is_head")
    done = full.join(placed, "node").withColumn("kept", own).select(*columns)
    alone = table.where("node is null")
    alone = alone.withColumns({"component_id": F.col("doc_id"), "kept": F.lit(True)})
    return done.unionByName(alone.select(*columns))


def one_of_each(docs: DataFrame, **options: int) -> DataFrame:
    """The rows of ``docs`` without near copies: of each group its first text stays, once.

    Columns of any name are handed on. Null and empty texts are linked with nothing and stay, as do
    rows without an id that are linked with nothing; of rows equal in id and text one stays; very
    long texts are compared whole; an empty table gives no rows.
    """
    stay = near_duplicates(docs, **options).where("kept")
    stay = stay.select(F.col("doc_id").alias("kept_id"), F.col("row_key").alias("kept_key"))
    packed = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col("doc_id").alias("id"),
        F.xxhash64("doc_id", "text").alias("key"),
    )
    same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("key") == F.col("kept_key"))
    # Repeated rows are marked alike; one of them stays.
    return packed.join(stay, same, "left_semi").dropDuplicates(["id", "key"]).select("row.*")
