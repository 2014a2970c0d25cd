"""Codebooks over metric trees against comparing every point."""

import hashlib
import math

import numpy as np
import pytest

from minuteflow.llm import vector_codes as vc


def brute_force(rows, parts, entries, rounds):
    """[(vec_id, code, error)], codebooks digest; rows are (vec_id, label, vector)."""
    good = [r for r in rows if r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    dim = -(-max(len(r[2]) for r in good) // parts) * parts
    limit = vc.LARGEST
    whole = [
        [min(max(math.floor(4096 * x), -limit), limit) for x in r[2]] + [0] * (dim - len(r[2])) for r in good
    ]
    w = dim // parts
    cut = [[v[p * w : (p + 1) * w] for p in range(parts)] for v in whole]
    books = [[list(v[p]) for v in cut[:entries]] for p in range(parts)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v, p: min(range(len(books[p])), key=lambda e: (away(v, books[p][e]), e))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            own = [near(v[p], p) for v in cut]
            book = []
            for e, old in enumerate(books[p]):
                mine = [v[p] for v, k in zip(cut, own) if k == e]
                book.append([sum(c) // len(mine) for c in zip(*mine)] if mine else old)
            new.append(book)
        books = new
    out = []
    for r, v in zip(good, cut):
        codes = [near(v[p], p) for p in range(parts)]
        error = sum(away(v[p], books[p][c]) for p, c in enumerate(codes))
        out.append((r[0], r[1], "".join(f"{c:02x}" for c in codes), error))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return out, digest


@pytest.mark.parametrize("spread", [3, 500, 1 << 26])
def test_walk_is_comparing_every_point(spread):
    rng = np.random.default_rng(spread)
    points = np.floor(rng.normal(size=(1500, 8)) * spread).astype(np.int64)
    points[:200] = points[0]
    points[300:900] += 7 * spread
    tree = vc.build_tree(points)
    assert sorted(tree.order.tolist()) == list(range(1500))
    for entries in (1, 5, 16):
        book = points[rng.integers(0, 1500, entries)]
        book[-1] = book[0]  # a tie goes to the lower entry
        sums, counts = np.zeros_like(book), np.zeros(entries, np.int64)
        chosen = vc.walk(tree, book, sums, counts)
        want = vc.squared(points[tree.order], book).argmin(1)
        assert (chosen == want).all()
        assert (counts == np.bincount(want, minlength=entries)).all()
        for e in range(entries):
            assert (sums[e] == points[tree.order][want == e].sum(0)).all()


def test_balls_are_nested_and_cached():
    rng = np.random.default_rng(2)
    points = rng.integers(-1000, 1000, size=(700, 4))
    tree = vc.build_tree(points)
    for k, (left, right, first, last) in enumerate(zip(tree.left, tree.right, tree.first, tree.last)):
        own = tree.points[first:last]
        assert (tree.sums[k] == own.sum(0)).all()
        assert vc.squared(own, tree.pivot[k]).max() <= tree.radius[k] ** 2 + 1e-6
        if left >= 0:
            assert (tree.first[left], tree.last[left], tree.last[right]) == (first, tree.first[right], last)
        else:
            assert last - first <= vc.LEAF
    equal = vc.build_tree(np.ones((100, 4), np.int64))
    assert len(equal.left) == 1 and equal.radius[0] == 0


def test_anchors_own_their_nearest_points():
    points = np.random.default_rng(5).integers(-50, 50, size=(400, 3))
    owner = vc.anchored(points, 12)
    anchors = [0]
    away = vc.squared(points, points[0])
    for _ in range(11):
        anchors.append(int(away.argmax()))
        away = np.minimum(away, vc.squared(points, points[anchors[-1]]))
    assert (vc.squared(points, points[anchors])[np.arange(400), owner] == away).all()


def test_owned_balls_are_not_opened(monkeypatch):
    """Well separated clusters: nearly all points are counted by the sums of their balls."""
    rng = np.random.default_rng(8)
    centres = rng.integers(-100_000, 100_000, size=(16, 8))
    points = np.concatenate([c + rng.integers(-20, 20, size=(128, 8)) for c in centres])
    tree, looked = vc.build_tree(points), []
    plain = vc.squared
    monkeypatch.setattr(vc, "squared", lambda p, o: looked.append(len(p)) or plain(p, o))
    vc.walk(tree, centres, np.zeros_like(centres), np.zeros(16, np.int64))
    assert sum(looked) < len(points) / 4


HARD = [
    (5, 1, [0.5, -0.25, 1.0, 2.0, 0.1]),
    (3, None, [0.5, -0.25, 1.0, 2.0, 0.1]),
    (3, None, [0.5, -0.25, 1.0, 2.0, 0.1]),
    (None, 2, [1e30, -1e30, 0.0, 0.0, 0.0]),
    (1, 1, [0.0, float("nan"), 0.0, 0.0, 0.0]),
    (2, 1, [0.0, float("inf"), 0.0, 0.0, 0.0]),
    (4, 1, None),
    (6, 2, [0.0, None, 0.0, 0.0, 0.0]),
    (7, 2, [0.3, 0.2]),
    (8, None, []),
    (9, 2, [-0.3, 0.2, 0.9, -7.5, 0.00001]),
]


@pytest.mark.parametrize("entries", [2, 16])
def test_hard_rows(spark, entries):
    kind = "vec_id long, label int, embedding array<double>, member string, code int"
    frame = spark.createDataFrame([(*r, "x", 1) for r in HARD], kind).repartition(3)
    want, digest = brute_force(HARD, 2, entries, 3)
    got = vc.compressed_with_errors(frame, parts=2, entries=entries, rounds=3, block=4).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(((r.vec_id, r.label, r.code, r.error) for r in got), key=key) == sorted(want, key=key)
    totals = {}
    for _, label, _, error in want:
        totals[label] = totals.get(label, 0) + error
    assert all(r.label_error == totals[r.label] and r.codebooks_sha256 == digest for r in got)
    assert vc.compressed_with_errors(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        vc.compressed(frame, entries=257)


def test_blocks_do_not_change_codes(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.label, r.embedding) for r in frame.collect()]
    want, digest = brute_force(rows, 8, 16, 2)
    for n, block in ((1, 2048), (5, 70)):
        got = vc.compressed_with_errors(frame.repartition(n), rounds=2, block=block).collect()
        assert sorted((r.vec_id, r.label, r.code, r.error) for r in got) == sorted(want)
        assert {r.codebooks_sha256 for r in got} == {digest}
