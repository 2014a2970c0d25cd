import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from minuteflow.operators import checkpoint as cp
from minuteflow.operators import ranges
from minuteflow.operators.positions import consume

T0 = datetime(2024, 3, 1, 10, 50)
ONE = timedelta(minutes=1)
SCHEMA = (
    "cluster string, collector string, minute timestamp, file_minute timestamp, file_id int,"
    " file_dir string, file_mtime timestamp, file_name string, line_no bigint"
)


def make_stream(minutes=8, files=3, lines=4, clusters=("c0",), skip=()):
    """Rows in stream order; within a minute mtime decides, not the name."""
    rows = []
    for cluster in clusters:
        for m in range(minutes):
            if m in skip:
                continue
            at = T0 + m * ONE
            for f in range(files):
                for n in range(1, lines + 1):
                    rows.append(
                        (cluster, "k", at, at, f, at.strftime("%Y/%m/%d/%H/%M"),
                         at + timedelta(seconds=100 + f), f"file{files - f}", n)
                    )
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def keys(df):
    return sorted((r.cluster, r.minute, r.file_mtime, r.file_name, r.line_no) for r in df.collect())


def expected(rows):
    return sorted((r[0], r[2], r[6], r[7], r[8]) for r in rows)


def mark(minute, file=None, line=0, cluster="c0"):
    """A checkpoint row: file is (mtime second, name)."""
    key = None
    if file is not None:
        key = (minute.strftime("%Y/%m/%d/%H/%M"), minute + timedelta(seconds=100 + file), f"file{3 - file}")
    return (cluster, minute.minute, minute, key, line)


CP_SCHEMA = (
    "cluster string, minute_of_hour int, minute timestamp,"
    " file_key struct<file_dir:string,file_mtime:timestamp,file_name:string>, line_no bigint"
)


def checkpoint(spark, marks):
    return spark.createDataFrame(marks, CP_SCHEMA)


def walk(rows, marks):
    """Read a stream file by file the way a consumer does after a reset."""
    by_minute = {(m[0], m[1]): m for m in marks if m[2] is not None}
    least = {}
    for m in by_minute.values():
        least[m[0]] = min(least.get(m[0], m[2]), m[2])
    out = []
    for row in sorted(rows, key=lambda r: (r[0], r[2], r[6], r[7], r[8])):
        cluster, minute = row[0], row[2]
        if cluster in least and minute < least[cluster]:
            continue
        seen = by_minute.get((cluster, minute.minute))
        if seen is not None:
            if minute < seen[2] or (minute == seen[2] and seen[4] == -1):
                continue
            if minute == seen[2] and seen[3] is not None:
                position = (seen[3][1], seen[3][2])
                here = (row[6], row[7])
                if here < position or (here == position and row[8] <= seen[4]):
                    continue
        out.append(row)
    return out


M = [T0 + i * ONE for i in range(8)]
CASES = {
    "no checkpoint": [],
    "start checkpoint": [mark(M[0])],
    "inside a file": [mark(M[0], 1, 2)],
    "end of a file": [mark(M[0], 1, 4)],
    "missing file": [(*mark(M[1], 1, 2)[:3], ("2024/03/01/10/51", M[1] + timedelta(seconds=101), "file0"), 2)],
    "missing last file": [(*mark(M[1], 1, 2)[:3], ("2024/03/01/10/51", M[1] + timedelta(hours=1), "z"), 2)],
    "single minute": [mark(M[3], 2, 1)],
    "several minutes": [mark(M[0], 0, 3), mark(M[1], 2, 2), mark(M[4], 1, 1)],
    "all minutes": [mark(m, i % 3, i % 4 + 1) for i, m in enumerate(M)],
    "one fully read": [mark(M[0], 2, -1)],
    "two fully read": [mark(M[0], 2, -1), mark(M[1], None, -1)],
    "several fully read": [mark(m, None, -1) for m in M[:5]],
    "fully read then inside": [mark(M[0], 2, -1), mark(M[1], 2, -1), mark(M[2], 1, 3)],
    "gap of fully read": [mark(M[0], 2, -1), mark(M[3], 2, -1)],
    "fully read and missing": [
        mark(M[0], 2, -1),
        (*mark(M[1], 0, 1)[:3], ("2024/03/01/10/51", M[1] + timedelta(seconds=99), "gone"), 1),
    ],
    "everything read": [mark(m, 2, -1) for m in M],
}


@pytest.mark.parametrize("name", CASES)
def test_resume_cases(spark, name):
    rows = make_stream()
    got = cp.resume(frame(spark, rows), checkpoint(spark, CASES[name]))
    want = walk(rows, CASES[name])
    assert keys(got) == expected(want)
    assert (len(want) == 0) == (name == "everything read")
    assert got.columns == SCHEMA.replace(" string", "").replace(" timestamp", "").replace(
        " int", "").replace(" bigint", "").split(", ")


def test_resume_after_the_hour_and_random(spark):
    rng = random.Random(7)
    rows = make_stream(minutes=75, files=2, lines=2, clusters=("c0", "c1"), skip=(5, 6, 30))
    minutes = sorted({r[2] for r in rows})
    for _ in range(4):
        marks = {}
        for cluster in ("c0", "c1")[: rng.randint(1, 2)]:
            for minute in rng.sample(minutes, 25):
                line = rng.choice([-1, 0, 1, 2])
                file = None if line == 0 else rng.randint(0, 1)
                key = None
                if file is not None:
                    key = (minute.strftime("%Y/%m/%d/%H/%M"), minute + timedelta(seconds=100 + file), f"file{2 - file}")
                marks[(cluster, minute.minute)] = (cluster, minute.minute, minute, key, line)
        marks = list(marks.values())
        got = cp.resume(frame(spark, rows), checkpoint(spark, marks))
        assert keys(got) == expected(walk(rows, marks))


def test_half_and_half(spark):
    """Every prefix and the rows resumed from its checkpoint make up the stream."""
    rows = make_stream(minutes=6)
    df = frame(spark, rows)
    ordered = sorted(rows, key=lambda r: (r[2], r[6], r[7], r[8]))
    for n in (1, 5, 12, 13, 40, len(rows)):
        taken = consume(df, n)
        assert keys(taken) == expected(ordered[:n])
        assert sorted(r.message_no for r in taken.collect()) == list(range(1, n + 1))
        rest = cp.resume(df, cp.build_checkpoint(taken))
        assert keys(rest) == expected(ordered[n:])


def test_checkpoint_rows(spark):
    taken = frame(spark, [r for r in make_stream(minutes=3) if r[2] < M[2] or r[4] == 0])
    marks = {r.minute_of_hour: r for r in cp.build_checkpoint(taken).collect()}
    assert {k: v.line_no for k, v in marks.items()} == {50: -1, 51: -1, 52: 4}
    assert marks[52].file_key.file_name == "file3"


def test_collector_checkpoint_and_resume(spark):
    rows = make_stream(minutes=4)
    df = frame(spark, rows)
    for n in (0, 3, 4, 20, len(rows)):
        taken = consume(df, n, "collector")
        rest = cp.resume(df, cp.build_checkpoint(taken, "collector"), "collector")
        assert taken.count() == n
        assert keys(taken.unionByName(rest, allowMissingColumns=True)) == expected(rows)
    whole = cp.build_checkpoint(consume(df, 8, "collector"), "collector").withColumn("line_no", F.lit(-1))
    assert cp.resume(df, whole, "collector").count() == len(rows) - 8


def test_fill_checkpoint(spark):
    marks = [mark(M[0], 2, -1), mark(M[2], 1, 3), mark(T0 + timedelta(minutes=65), 1, 2)]
    filled = cp.fill_checkpoint(checkpoint(spark, marks), M[1], M[7], group="1/1")
    out = {r.minute_of_hour: r for r in filled.collect()}
    # 10:55 keeps its later position 11:55; 10:52 is replaced; 10:57 itself is not filled.
    assert {k: (v.minute, v.line_no) for k, v in out.items()} == {
        50: (M[0], -1), 51: (M[1], -1), 52: (M[2], -1), 53: (M[3], -1), 54: (M[4], -1),
        55: (T0 + timedelta(minutes=65), 2), 56: (M[6], -1),
    }
    assert out[52].file_key is None and out[50].file_key.file_name == "file1"
    stop = cp.fill_checkpoint(checkpoint(spark, marks[:1]), M[1], M[3], "2/2", inclusive=True)
    assert sorted(r.minute_of_hour for r in stop.collect()) == [50, 51, 53]
    long = cp.fill_checkpoint(checkpoint(spark, marks[:1]), M[1], M[1] + timedelta(hours=30))
    assert long.count() == 60 and long.filter("line_no <> -1").count() == 0
    assert long.agg(F.max("minute")).first()[0] == M[0] + timedelta(hours=30)


def test_start_checkpoint(spark):
    clusters = spark.createDataFrame([("c0",), ("c1",)], "cluster string")
    marks = cp.start_checkpoint(clusters, T0 + timedelta(seconds=30), "1/2", checkpoint(spark, [mark(M[0], 1, 1)]))
    rows = marks.collect()
    assert len(rows) == 59 and all(r.line_no == 0 and r.file_key is None for r in rows)
    df = frame(spark, make_stream(minutes=4))
    started = cp.start_checkpoint(clusters, M[2])
    assert cp.resume(df, started).count() == 24


def test_store_versions_and_merge(spark, tmp_path):
    store = str(tmp_path)
    assert cp.load_checkpoint(spark, store, "c", "t") is None
    first = checkpoint(spark, [mark(M[0], 1, 1), mark(M[1], 1, 1)])
    assert cp.save_checkpoint(first, store, "c", "t") == 1
    newer = cp.merge_checkpoints(cp.load_checkpoint(spark, store, "c", "t"), checkpoint(spark, [mark(M[1], 2, 4)]))
    assert cp.save_checkpoint(newer, store, "c", "t") == 2
    (tmp_path / "c_t" / "v0000000003").mkdir()  # a writer that died
    out = {r.minute_of_hour: r.line_no for r in cp.load_checkpoint(spark, store, "c", "t").collect()}
    assert out == {50: 1, 51: 4}
    assert cp.save_checkpoint(first, store, "c", "t") == 4
    assert cp.load_checkpoint(spark, store, "other", "t") is None


def test_rename_and_least(spark):
    marks = checkpoint(spark, [mark(M[1], 1, 1), mark(M[0], 1, 1, "x"), mark(M[3], 1, 1)])
    renamed = cp.rename_clusters(marks, {"c0": "west"})
    assert sorted({r.cluster for r in renamed.collect()}) == ["west", "x"]
    assert {r.cluster: r.least for r in cp.least_checkpoint(renamed).collect()} == {"west": M[1], "x": M[0]}
    assert cp.rename_clusters(marks, {}).collect() == marks.collect()


@pytest.mark.parametrize("group", ["0/2", "3/2", "1", "a/b", "-1/2", "1/61", "1/2/3"])
def test_bad_groups(group):
    with pytest.raises(ValueError):
        ranges.parse_group(group)


def test_groups_cover_each_minute_once(spark):
    df = frame(spark, make_stream(minutes=70, files=1, lines=1))
    parts = [{r.minute for r in ranges.consumer_group(df, f"{k}/3").collect()} for k in (1, 2, 3)]
    assert sum(map(len, parts)) == 70 and len(set.union(*parts)) == 70
    assert {m.minute % 2 for m in (r.minute for r in ranges.consumer_group(df, "1/2").collect())} == {0}


def test_gate(spark):
    def dirs(*offsets):
        return spark.createDataFrame([("c0", T0 + i * ONE) for i in offsets], "cluster string, minute timestamp")

    def complete(df, **kwargs):
        return sorted((r.minute - T0) // ONE for r in ranges.complete_minutes(df, **kwargs).collect())

    assert complete(dirs(0, 1, 2)) == [0, 1]
    assert complete(dirs(0, 1, 3, 4, 5)) == [0]
    assert complete(dirs(0)) == []
    assert complete(dirs(0, 1, 3, 4, 5), start=T0 + 2 * ONE) == [3, 4]


def test_start_precedence(spark):
    parts = spark.createDataFrame([("c0",), ("c1",)], "cluster string")
    marks = checkpoint(spark, [mark(M[0], 1, 1)])
    now = datetime(2024, 3, 2)

    def kinds(**kwargs):
        rows = ranges.resolve_start(parts, now=now, **kwargs).collect()
        return {r.cluster: (r.start_kind, r.start_minute) for r in rows}

    hour_ago = now - timedelta(hours=1)
    assert kinds(checkpoint=marks, relative_minutes=60, start=T0) == {
        "c0": ("checkpoint", None), "c1": ("relative", hour_ago)}
    assert kinds(retention_hours=1)["c0"] == ("relative", hour_ago)
    assert kinds(retention_hours=1, relative_minutes=5)["c0"] == ("relative", now - 5 * ONE)
    assert kinds(start=T0 + timedelta(seconds=20), start_of_stream=True)["c1"] == ("absolute", T0)
    assert kinds(start_of_stream=True)["c1"] == ("stream", None)
    for bad in (
        {}, {"checkpoint": marks}, {"start": now + ONE},
        {"start": T0, "stop": T0 - ONE},
    ):
        with pytest.raises(ValueError):
            kinds(**bad)
