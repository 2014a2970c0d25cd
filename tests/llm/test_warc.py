"""The fixity audit against a plain comparison of two replicas."""

import hashlib
import random

import pytest

from minuteflow.llm import warc

KIND = "archive string, start long, length long, digest binary"


def row(archive, start, body):
    return archive, start, len(body), hashlib.sha256(body).digest()


def replicas(seed):
    rng = random.Random(seed)
    first, second = [], []
    for a in range(5):
        at = 0
        for _ in range(rng.randint(1, 40)):
            body = rng.randbytes(rng.randint(1, 60_000))
            kind = rng.random()
            if kind < 0.95:
                first.append(row(f"a{a}", at, body))
            if kind < 0.05:
                body = body[:-1] + b"?!"
            if kind < 0.85 or kind >= 0.9:
                second.append(row(f"a{a}", at, body))
            at += len(body) * rng.choice([1, 1, 1, 1000, 10**9])
    return first, second


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_finds_every_difference(spark, seed):
    first, second = replicas(seed)
    mine = {r[:2]: r[3] for r in first}
    other = {r[:2]: r[3] for r in second}
    want = {
        (*k, "extra" if k not in mine else "missing" if k not in other else "altered")
        for k in mine | other
        if mine.get(k) != other.get(k)
    }
    # Repeated rows change nothing.
    frames = spark.createDataFrame(first + first[:7], KIND), spark.createDataFrame(second, KIND)
    got = warc.audit(*frames).collect()
    assert {(r.archive, r.start, r.status) for r in got} == want and len(got) == len(want)
    for r in got:
        key = (r.archive, r.start)
        assert (r.digest, r.other_digest) == (mine.get(key), other.get(key))
    assert warc.audit(frames[0], frames[0]).count() == 0


def test_roots_see_order_and_place(spark):
    a, b = row("a", 0, b"x"), row("a", 1, b"y")
    moved = spark.createDataFrame([("a", 0, *b[2:]), ("a", 1, *a[2:])], KIND)
    assert warc.audit(spark.createDataFrame([a, b], KIND), moved).count() == 2


def test_hard_records(spark):
    first = spark.createDataFrame(
        [
            row(None, 0, b"lost"),
            row("a", None, b"lost"),
            ("a", 5, 0, None),
            row("a", 9, b"one"),
            row("a", 9, b"two"),
            row("b", 0, b""),
        ],
        KIND,
    ).withColumn("side", warc.F.lit("x")).withColumn("at", warc.F.lit(1))
    got = sorted((r.archive or "", r.start or 0, r.status) for r in warc.audit(first, first).collect())
    unplaced = [("", 0, "unplaced"), ("a", 0, "unplaced")]
    assert got == sorted([*unplaced, *unplaced, ("a", 9, "contested")])
    none = first.limit(0)
    assert warc.audit(none, none).count() == 0
    assert {r.status for r in warc.audit(first, none).collect()} == {"unplaced", "missing", "contested"}
    assert {r.status for r in warc.audit(none, first).collect()} == {"unplaced", "extra", "contested"}


def test_hard_pages(spark):
    rows = [
        (1, "http://a\r\nX: y", "<p>é漢</p>"),
        (1, "http://a\r\nX: y", "<p>é漢</p>"),
        (2, None, None),
        (3, "http://b", ""),
        (None, None, "x" * 200_000),
        (None, None, None),
    ] + [(10 + i, f"http://c/{i}", f"<p>{i}</p>" * 50) for i in range(300)]
    kind = "page_id long, url string, html string"
    pages = spark.createDataFrame(rows, kind).selectExpr(
        "*", "1 AS archive", "2 AS start", "3 AS length", "4 AS status", "5 AS digest"
    )
    got = warc.audited_pages(pages, archive_bytes=50_000).collect()
    assert sorted(r.page_id or 0 for r in got) == sorted(r[0] or 0 for r in rows)
    ends = {}
    for r in sorted(got, key=lambda r: (r.archive, r.start)):
        assert r.start == ends.get(r.archive, 0)
        ends[r.archive] = r.start + r.length
        kind = r.digest[0]
        want = "altered" if kind < 6 else "missing" if kind < 8 else "same"
        assert r.status == want and (r.copy_digest == r.digest) == (want == "same")
    assert len(ends) > 2 and {r.status for r in got} == {"altered", "missing", "same"}
    assert warc.audited_pages(pages.limit(0)).count() == 0
