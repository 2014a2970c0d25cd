"""Vector code compression: one small codebook per part, fitted over metric trees.

Vectors become whole numbers and are cut into equal parts. Every block of vectors keeps, for each
part, a tree of balls built by the anchors hierarchy, middle out: anchors are chosen farthest
first and take over the points nearer to them (the triangle inequality tells which points need
not be looked at); each anchor's points are split again the same way; then the anchors are
joined in pairs, smallest ball first, up to the root. A ball holds its pivot, radius, count and sums.

A round walks all trees with the entries of the codebook as candidates. An entry that loses
to the one nearest to the pivot everywhere in the ball leaves the list, and the rest is
inherited by the ball's halves. A ball with one candidate left is owned by it: its cached sums
and count are added without looking at its points. What is left at the leaves is compared
point by point. All comparisons that decide are between whole numbers, and an entry leaves a list
only if it loses by more than rounding, so the result is that of comparing every point.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from minuteflow.llm.common import arrow_schema, kept
from minuteflow.session import work_dir

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
BLOCK = 2048
LEAF = 48
# Whole numbers beyond this count as this; squared distances then fit 64 bits.
LARGEST = 1 << 27
_FILE_BLOCK = 16 << 20


@dataclass
class Tree:
    """Balls in the order root first; ``order`` lists the points so that each ball is a run of it."""

    left: np.ndarray  # -1 at a leaf
    right: np.ndarray
    first: np.ndarray
    last: np.ndarray
    radius: np.ndarray
    pivot: np.ndarray
    sums: np.ndarray
    order: np.ndarray
    points: np.ndarray  # in that order


def squared(points: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Squared distances of ``points`` (n, d) from ``other`` (d) or (k, d)."""
    if other.ndim == 1:
        return ((points - other) ** 2).sum(1)
    out = np.zeros((len(points), len(other)), np.int64)
    for c in range(points.shape[1]):
        out += (points[:, c, None] - other[None, :, c]) ** 2
    return out


def anchored(points: np.ndarray, n_anchors: int) -> np.ndarray:
    """The anchor of every point: anchors are chosen farthest first, and points go to the nearest.

    A point nearer to its anchor than half the way to a new one cannot change over.
    """
    owner = np.zeros(len(points), np.int64)
    away = squared(points, points[0])
    chosen = [0]
    for k in range(1, n_anchors):
        new = int(away.argmax())
        if not away[new]:
            break
        gap = squared(points[chosen], points[new])
        far = np.flatnonzero(4 * away > gap[owner])
        there = squared(points[far], points[new])
        taken = there < away[far]
        owner[far[taken]] = k
        away[far[taken]] = there[taken]
        chosen.append(new)
    return owner


def _joined(nodes: list[tuple], points: np.ndarray) -> tuple:
    """One node of many: the two with the smallest common ball are joined, again and again."""
    if len(nodes) == 1:
        return nodes[0]
    n = len(nodes)
    own = [points[_members(x)] for x in nodes]
    centre = np.array([p.mean(0) for p in own])
    reach = np.array([np.sqrt(((p - c) ** 2).sum(1).max()) for p, c in zip(own, centre, strict=True)])
    count = np.array([len(p) for p in own], float)
    gap = np.sqrt(((centre[:, None] - centre[None]) ** 2).sum(-1))
    cost = np.maximum((gap + reach[:, None] + reach[None]) / 2, np.maximum(reach[:, None], reach[None]))
    np.fill_diagonal(cost, np.inf)
    made = list(nodes)
    for _ in range(n - 1):
        a, b = divmod(int(cost.argmin()), n)
        made[a], made[b] = (made[a], made[b], _size(made[a]) + _size(made[b])), None
        radius = cost[a, b]
        centre[a] = (centre[a] * count[a] + centre[b] * count[b]) / (count[a] + count[b])
        count[a] += count[b]
        reach[a] = radius
        cost[b, :] = cost[:, b] = np.inf
        gap = np.sqrt(((centre - centre[a]) ** 2).sum(1))
        row = np.maximum((gap + reach + radius) / 2, np.maximum(reach, radius))
        alive = np.array([m is not None for m in made])
        alive[a] = False
        cost[a, :] = cost[:, a] = np.where(alive, row, np.inf)
    return next(m for m in made if m is not None)


def _size(node) -> int:
    return len(node) if isinstance(node, np.ndarray) else node[2]


def _members(node) -> np.ndarray:
    """The points of a node: an array at a leaf, else two nodes and the number of points."""
    if isinstance(node, np.ndarray):
        return node
    out, stack = [], [node]
    while stack:
        x = stack.pop()
        if isinstance(x, np.ndarray):
            out.append(x)
        else:
            stack += [x[1], x[0]]
    return np.concatenate(out)


def _grown(points: np.ndarray, own: np.ndarray):
    if len(own) <= LEAF:
        return own
    owner = anchored(points[own], max(2, int(np.sqrt(len(own)))))
    by_anchor = np.argsort(owner, kind="stable")
    cuts = np.flatnonzero(np.diff(owner[by_anchor])) + 1
    groups = np.split(own[by_anchor], cuts)
    if len(groups) == 1:  # all points are equal
        return own
    return _joined([_grown(points, g) for g in groups], points)


def build_tree(points: np.ndarray) -> Tree:
    """The tree of ``points`` (n, d), n at least 1."""
    root = _grown(points, np.arange(len(points)))
    order = _members(root)
    ordered = points[order]
    left, right, first, last = [], [], [], []
    stack = [(root, 0, -1, 0)]
    while stack:
        node, start, parent, side = stack.pop()
        at = len(left)
        if parent >= 0:
            (left if side == 0 else right)[parent] = at
        left.append(-1)
        right.append(-1)
        first.append(start)
        last.append(start + _size(node))
        if not isinstance(node, np.ndarray):
            cut = _size(node[0])
            stack.append((node[1], start + cut, at, 1))
            stack.append((node[0], start, at, 0))
    first, last = np.array(first), np.array(last)
    upto = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(ordered, 0)])
    sums = upto[last] - upto[first]
    pivot = sums // (last - first)[:, None]
    far = [squared(ordered[a:b], p).max() for a, b, p in zip(first, last, pivot, strict=True)]
    return Tree(
        np.array(left), np.array(right), first, last, np.sqrt(np.array(far, float)),
        pivot, sums, order, ordered,
    )


def walk(tree: Tree, book: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Assign every point to the nearest entry of ``book``, ties to the lower one.

    Adds each entry's points to ``sums`` and ``counts``; gives the entries in tree order.
    """
    between = np.sqrt(squared(book, book).astype(float))
    chosen = np.zeros(len(tree.points), np.int64)
    nodes, alive = np.array([0]), np.ones((1, len(book)), bool)
    never = np.iinfo(np.int64).max
    while len(nodes):
        away = np.where(alive, squared(tree.pivot[nodes], book), never)
        best = away.argmin(1)
        lead = away[np.arange(len(nodes)), best]
        # Over the ball, the difference of two squared distances moves by this much at most.
        slack = 2 * tree.radius[nodes, None] * between[best]
        alive &= ~((away - lead[:, None]).astype(float) > slack * (1 + 1e-9) + 1e-6)
        alone = alive.sum(1) == 1
        own = nodes[alone]
        np.add.at(sums, best[alone], tree.sums[own])
        np.add.at(counts, best[alone], tree.last[own] - tree.first[own])
        for node, entry in zip(own.tolist(), best[alone].tolist(), strict=True):
            chosen[tree.first[node] : tree.last[node]] = entry
        leaf = ~alone & (tree.left[nodes] < 0)
        if leaf.any():
            sizes = (tree.last - tree.first)[nodes[leaf]]
            begins = np.repeat(tree.first[nodes[leaf]] - (np.cumsum(sizes) - sizes), sizes)
            rows = np.arange(sizes.sum()) + begins
            near = np.where(
                np.repeat(alive[leaf], sizes, 0), squared(tree.points[rows], book), never
            ).argmin(1)
            chosen[rows] = near
            np.add.at(sums, near, tree.points[rows])
            np.add.at(counts, near, 1)
        inner = ~alone & ~leaf
        nodes = np.concatenate([tree.left[nodes[inner]], tree.right[nodes[inner]]])
        alive = np.concatenate([alive[inner], alive[inner]])
    return chosen


def _stored_tree(tree: Tree) -> dict[str, bytes]:
    small = lambda a: a.astype("<i4").tobytes()
    return {
        "nodes": small(np.stack([tree.left, tree.right, tree.first, tree.last], 1)),
        "radius": tree.radius.astype("<f8").tobytes(),
        "pivot": small(tree.pivot),
        "sums": tree.sums.astype("<i8").tobytes(),
        "order": small(tree.order),
        "points": small(tree.points),
    }


def _read_tree(row: dict[str, bytes], width: int) -> Tree:
    small = lambda name: np.frombuffer(row[name], "<i4").astype(np.int64)
    left, right, first, last = small("nodes").reshape(-1, 4).T
    return Tree(
        left, right, first, last,
        np.frombuffer(row["radius"], "<f8"),
        small("pivot").reshape(-1, width),
        np.frombuffer(row["sums"], "<i8").reshape(-1, width),
        small("order"),
        small("points").reshape(-1, width),
    )


def whole_numbers(vectors: pa.ListArray, dim: int) -> np.ndarray:
    """(n, ``dim``) of floor(SCALE * x); shorter vectors end in zeros."""
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.clip(np.floor(SCALE * flat), -LARGEST, LARGEST).astype(np.int64)
    out = np.zeros((len(sizes), dim), np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = whole
    return out


def _usable(vector: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad)


_TREE = T.StructType(
    [
        T.StructField(name, T.BinaryType(), False)
        for name in ("nodes", "radius", "pivot", "sums", "order", "points")
    ]
)


def tree_blocks(
    vectors: DataFrame, dim: int, parts: int = PARTS, block: int = BLOCK
) -> DataFrame:
    """One row per ``block`` vectors of a task: ``members``, what is known of each vector, and
    ``trees``, one per part. ``vectors`` has ``member`` (a struct) and ``embedding``.
    """
    schema = T.StructType(
        [
            T.StructField("members", T.ArrayType(vectors.schema["member"].dataType)),
            T.StructField("trees", T.ArrayType(_TREE)),
        ]
    )
    arrow = arrow_schema(schema)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(table: pa.Table) -> pa.RecordBatch:
            whole = whole_numbers(table["embedding"].combine_chunks(), dim)
            trees = [_stored_tree(build_tree(p)) for p in np.split(whole, parts, 1)]
            members = table["member"].combine_chunks()
            cuts = pa.array([0, len(members)], pa.int32())
            columns = [pa.ListArray.from_arrays(cuts, members), pa.array([trees], arrow.field(1).type)]
            return pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
            )

        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            while n >= block:
                table = pa.Table.from_batches(held)
                yield made(table.slice(0, block))
                held, n = table.slice(block).to_batches(), n - block
        if n:
            yield made(pa.Table.from_batches(held))

    made = vectors.select("member", "embedding").mapInArrow(blocks, schema)
    # Small row groups, so that a task that reads trees holds few of them at once.
    path = work_dir(vectors.sparkSession, "trees")
    made.write.option("parquet.block.size", _FILE_BLOCK).parquet(path)
    return vectors.sparkSession.read.schema(schema).parquet(path)


def _round(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round. A task gives one row per number of a codebook."""
    parts, entries, width = books.shape

    def tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros_like(books), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for trees in batch.column(0):
                for p, tree in enumerate(trees.as_py()):
                    walk(_read_tree(tree, width), books[p], sums[p], counts[p])
        cells = np.concatenate([sums, counts[:, :, None]], 2).ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(cells))), pa.array(cells)], names=["cell", "value"]
        )

    cells = blocks.select("trees").mapInArrow(tallied, "cell long, value long")
    total = np.zeros((parts, entries, width + 1), np.int64)
    for row in cells.groupBy("cell").agg(F.sum("value").alias("value")).collect():
        total.ravel()[row.cell] = row.value
    counts = total[:, :, -1:]
    return np.where(counts > 0, total[:, :, :-1] // np.maximum(counts, 1), books)


def fit_codebooks(
    vectors: DataFrame,
    blocks: DataFrame,
    dim: int,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> np.ndarray:
    """(parts, entries, width): begun with the vectors of the smallest ids, then ``rounds`` rounds.

    Fewer vectors than ``entries`` make that many entries. The driver holds the codebooks alone.
    """
    order = [F.col("member.vec_id").asc_nulls_last(), "embedding"]
    first = [list(r.embedding) for r in vectors.orderBy(*order).limit(entries).collect()]
    begun = whole_numbers(pa.array(first, pa.list_(pa.float64())), dim)
    books = begun.reshape(len(first), parts, dim // parts).transpose(1, 0, 2)
    for _ in range(rounds if first else 0):
        books = _round(blocks, np.ascontiguousarray(books))
    return np.ascontiguousarray(books)


def compressed(
    embeddings: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    block: int = BLOCK,
) -> tuple[DataFrame, np.ndarray]:
    """(``vec_id``, ``label``, ``code``, ``error``) of every usable row, and the codebooks.

    Rows whose ``embedding`` is null or holds a null or a number that is not finite are dropped.
    Numbers beyond ``LARGEST / SCALE`` count as that. Vectors shorter than the longest, or than a multiple
    of ``parts``, end in zeros. ``code`` has two hex digits a part; ``entries`` may be 256 at most.

    Null and repeated ids and repeated rows are vectors like others; of the vectors that begin the
    codebooks, null ids come last and equal ids go by their numbers. Further columns are ignored. An
    empty table gives no rows. Rows are neither shuffled nor gathered: a task works on ``block``
    vectors at a time, and gives one row per number of the codebooks.
    """
    if not 1 <= entries <= 256:
        raise ValueError(f"entries must be 1 to 256, not {entries}")
    vectors = embeddings.where(_usable(F.col("embedding"))).select(
        F.struct("vec_id", "label").alias("member"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    longest = vectors.agg(F.max(F.size("embedding"))).first()[0] or 1
    dim = -(-longest // parts) * parts
    schema = T.StructType(
        [
            *embeddings.select("vec_id", "label").schema.fields,
            T.StructField("code", T.StringType(), False),
            T.StructField("error", T.LongType(), False),
        ]
    )
    arrow = arrow_schema(schema)
    blocks = tree_blocks(vectors, dim, parts, block)
    books = fit_codebooks(vectors, blocks, dim, parts, entries, rounds)
    width = dim // parts

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for members, trees in zip(batch.column(0), batch.column(1), strict=True):
                members = members.values
                codes = np.zeros((len(members), parts), np.uint8)
                error = np.zeros(len(members), np.int64)
                for p, row in enumerate(trees.as_py()):
                    tree, book = _read_tree(row, width), books[p]
                    chosen = walk(tree, book, np.zeros_like(book), np.zeros(len(book), np.int64))
                    codes[tree.order, p] = chosen
                    error[tree.order] += ((tree.points - book[chosen]) ** 2).sum(1)
                columns = [
                    members.field(0),
                    members.field(1),
                    pa.array([c.tobytes().hex() for c in codes], pa.string()),
                    pa.array(error),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return blocks.mapInArrow(coded, schema), books


def codebooks_sha256(books: np.ndarray) -> str:
    """Hex digest of all numbers by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compressed_with_errors(embeddings: DataFrame, **options: int) -> DataFrame:
    """:func:`compressed` with ``label_error``, the error of all rows of a label (nulls together), and
    ``codebooks_sha256``. Labels are summed per task first, and the sums are stored, so that Spark
    broadcasts them where they are small and else splits the rows of a hot label.
    """
    rows, books = compressed(embeddings, **options)
    rows = kept(rows, "codes")
    sums = rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    joined = rows.join(kept(sums, "label-errors"), F.col("label").eqNullSafe(F.col("of")))
    return joined.select(
        "vec_id", "label", "code", "error", "label_error",
        F.lit(codebooks_sha256(books)).alias("codebooks_sha256"),
    )
