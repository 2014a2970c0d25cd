import time
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest
from conftest import encoded, texts_of

from minuteflow.consumer import Consumer
from minuteflow.operators import checkpoint as cp
from minuteflow.operators import metrics
from minuteflow.operators.positions import mark_points, number_messages, with_positions
from minuteflow.sources import collectors, oplog
from minuteflow.sources.minutes import read_minutes, read_sequence_values
from minuteflow.streaming.minute_source import stream_minutes
from minuteflow.streaming.stats import ReaderStats, observed

T0 = datetime(2024, 3, 1, 10, 58)
ONE = timedelta(minutes=1)


@pytest.fixture
def filled(stream):
    for i in (0, 1, 2, 4, 5):
        stream.commit(T0 + i * ONE, [f"m{i}-{n}" for n in range(4)])
    stream.minute_dir(T0 + 3 * ONE)
    stream.minute_dir(T0 + 6 * ONE)
    return stream


def texts(*minutes):
    return sorted(f"m{i}-{n}" for i in minutes for n in range(4))


def make(spark, stream, tmp_path, **kwargs):
    kwargs = {"start_of_stream": True, **kwargs}
    return Consumer(spark, stream.topic, "c1", str(stream.root), str(tmp_path / "store"), **kwargs)


def test_mark_reset_and_crash(spark, filled, tmp_path):
    consumer = make(spark, filled, tmp_path)
    assert texts_of(consumer.read(6)) == sorted(texts(0) + ["m1-0", "m1-1"])
    consumer.mark()
    rest = sorted(["m1-2", "m1-3"] + texts(2, 4, 5))
    assert texts_of(consumer.read()) == rest
    consumer.reset()
    assert texts_of(consumer.read()) == rest
    again = make(spark, filled, tmp_path, start_of_stream=False)  # a new process
    assert texts_of(again.read(3)) == ["m1-2", "m1-3", "m2-0"]
    again.mark()
    assert again.read().count() == 11
    again.mark()
    assert again.read().count() == 0
    filled.commit(T0 + 7 * ONE, ["new"])
    assert again.read().count() == 0  # its minute is not complete yet
    filled.minute_dir(T0 + 8 * ONE)
    assert texts_of(again.read()) == ["new"]


def test_consumption_is_logged(spark, filled, tmp_path):
    log = str(tmp_path / "log")
    assert oplog.consumed_log(spark, log).count() == 0
    consumer = make(spark, filled, tmp_path, log=log)
    consumer.read(6)
    consumer.mark()
    consumer.read()
    consumer.reset()
    consumer.read()
    consumer.mark()
    other = make(spark, filled, tmp_path, log=log)  # nothing left: a timeout
    other.read()
    other.mark()
    stats = metrics.consumer_stats(oplog.consumed_log(spark, log)).collect()
    assert [tuple(r) for r in stats] == [(filled.topic, "c1", 20, 3, 1, 1)]


def test_gap_minutes_count_as_read(spark, filled, tmp_path):
    consumer = make(spark, filled, tmp_path)
    consumer.read()
    consumer.mark()
    marks = cp.load_checkpoint(spark, consumer.store, "c1", filled.topic).collect()
    lines = {r.minute: r.line_no for r in marks}
    assert lines == {**{T0 + i * ONE: -1 for i in range(5)}, T0 + 5 * ONE: 4}


def test_start_options(spark, filled, tmp_path):
    late = make(spark, filled, tmp_path, start=T0 + 2 * ONE, start_of_stream=False)
    assert texts_of(late.read()) == texts(2, 4, 5)
    relative = make(
        spark, filled, tmp_path, start_of_stream=False, relative_minutes=3, now=T0 + 7 * ONE
    )
    assert texts_of(relative.read()) == texts(4, 5)
    stop = make(spark, filled, tmp_path, stop=T0 + 2 * ONE)
    assert texts_of(stop.read()) == texts(0, 1, 2)
    with pytest.raises(ValueError):
        make(spark, filled, tmp_path, start_of_stream=False).read()
    with pytest.raises(ValueError):
        make(spark, filled, tmp_path).mark()
    with pytest.raises(ValueError):
        make(spark, filled, tmp_path, group="3/2")


def test_mark_before_the_first_message(spark, filled, tmp_path):
    early = make(spark, filled, tmp_path, start=T0 + 6 * ONE, start_of_stream=False)
    assert early.read().count() == 0
    early.mark()
    filled.commit(T0 + 6 * ONE, ["first"])
    filled.minute_dir(T0 + 7 * ONE)
    assert texts_of(make(spark, filled, tmp_path, start_of_stream=True).read()) == ["first"]


def test_groups_share_the_stream(spark, filled, tmp_path):
    parts = []
    for k in (1, 2):
        one = member(spark, filled, str(tmp_path / "store"), k)
        taken = texts_of(one.read(5))
        one.mark()
        parts += taken + texts_of(one.read())
    assert sorted(parts) == texts(0, 1, 2, 4, 5)


def member(spark, filled, store, k, total=2, **options):
    return Consumer(
        spark, filled.topic, "bill", str(filled.root), store,
        group=f"{k}/{total}", **{"start_of_stream": True, **options},
    )


def own(k, total=2, minutes=range(6)):
    return sorted(t for i in minutes if i % total == k - 1 and i != 3 for t in texts(i))


@pytest.mark.parametrize("order", [(1, 2), (2, 1)])
def test_members_of_one_name_mark_in_any_order(spark, filled, tmp_path, order):
    store = str(tmp_path / "store")
    first = {k: member(spark, filled, store, k) for k in (1, 2)}
    for k in (1, 2):
        assert texts_of(first[k].read()) == own(k)
    for k in order:
        first[k].mark()
    for k in (1, 2):
        again = member(spark, filled, store, k)
        assert texts_of(again.read()) == []
        again.mark()
    filled.commit(T0 + 6 * ONE, ["six"])
    filled.commit(T0 + 7 * ONE, ["seven"])
    filled.minute_dir(T0 + 8 * ONE)
    assert texts_of(member(spark, filled, store, 1).read()) == ["six"]
    assert texts_of(member(spark, filled, store, 2).read()) == ["seven"]


def test_member_without_marks_starts_by_its_options(spark, filled, tmp_path):
    """Positions of the other member neither skip nor repeat anything of this one's."""
    store = str(tmp_path / "store")
    one, two = (member(spark, filled, store, k) for k in (1, 2))
    one.read().count()
    two.read().count()
    two.mark()
    late = member(spark, filled, store, 1)
    assert texts_of(late.read(5)) == texts(0)[:4] + texts(2)[:1]
    late.mark()
    assert texts_of(member(spark, filled, store, 2).read()) == []
    assert sorted(texts(0)[:4] + texts(2)[:1] + texts_of(member(spark, filled, store, 1).read())) == own(1)


def test_group_gets_another_number_of_members(spark, filled, tmp_path):
    store = str(tmp_path / "store")
    taken = []
    for k in (1, 2):
        one = member(spark, filled, store, k, stop=T0 + 2 * ONE)
        taken += texts_of(one.read())
        one.mark()
    for k in (1, 2, 3):
        taken += texts_of(member(spark, filled, store, k, total=3).read())
    assert sorted(taken) == texts(0, 1, 2, 4, 5)


def test_marks_at_the_same_time_are_all_kept(spark, tmp_path):
    """Four members go on from the same version; each finds the others' positions and adds its own."""
    store, name = cp.FileCheckpointStore(str(tmp_path / "store"), keep=4), ("bill", "t")
    kind = (
        "cluster string, minute_of_hour int, minute timestamp,"
        " file_key struct<file_dir:string,file_mtime:timestamp,file_name:string>, line_no long"
    )

    def mark(k):
        for i in (k, k + 30):
            row = spark.createDataFrame([("c", i, T0 + i * ONE, None, k)], kind)
            store.merge(row, *name, "local")

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(mark, range(4)))
    rows = store.load(spark, *name).collect()
    assert sorted((r.minute_of_hour, r.line_no) for r in rows) == sorted(
        (i, k) for k in range(4) for i in (k, k + 30)
    )
    names = [p.name for p in (tmp_path / "store" / "bill_t").iterdir()]
    versions = sorted(n for n in names if n.startswith("v"))
    assert versions == [f"v{n:010d}" for n in range(5, 9)]
    assert len([n for n in names if n.startswith("positions-")]) == 4
    assert not [n for n in names if n.startswith("_")]


def test_a_mark_that_comes_second_is_merged(spark, filled, tmp_path, monkeypatch):
    """Between reading a version and writing the next one the other member marks."""
    store = str(tmp_path / "store")
    one, two = (member(spark, filled, store, k) for k in (1, 2))
    one.read().count()
    two.read().count()
    commit, late = cp.FileCheckpointStore._commit, []

    def slow(self, checkpoint, path, version):
        if not late:
            late.append(version)
            two.mark()
        return commit(self, checkpoint, path, version)

    monkeypatch.setattr(cp.FileCheckpointStore, "_commit", slow)
    assert one.mark() == 2 and late == [1]
    for k in (1, 2):
        assert texts_of(member(spark, filled, store, k).read()) == []


class MemoryStore:
    """A store of the user's own."""

    def __init__(self):
        self.rows = {}

    def load(self, spark, consumer, topic):
        kept = self.rows.get((consumer, topic))
        return spark.createDataFrame(*kept) if kept else None

    def save(self, checkpoint, consumer, topic):
        self.rows[consumer, topic] = checkpoint.collect(), checkpoint.schema
        return len(self.rows)

    def merge(self, changed, consumer, topic, stream_type):
        old = self.load(changed.sparkSession, consumer, topic)
        return self.save(cp.merge_checkpoints(old, changed, stream_type), consumer, topic)


def test_store_of_ones_own(spark, filled):
    store = MemoryStore()
    for k in (1, 2):
        one = member(spark, filled, store, k)
        assert texts_of(one.read()) == own(k)
        one.mark()
    assert [texts_of(member(spark, filled, store, k).read()) for k in (1, 2)] == [[], []]


def test_stitched_consumer(spark, stream, tmp_path):
    stream.commit(T0 + ONE, ["a", "b"], file_minute=T0)
    path = stream.collect(T0 + ONE, ["c", "d"])
    stream.collect(T0 + ONE, ["x"], collector="collector2")
    consumer = make(spark, stream, tmp_path, stream_type="stitched")
    assert texts_of(consumer.read(3)) == ["a", "b", "c"]
    consumer.mark()
    assert consumer.pending_bytes() == path.stat().st_size + len(encoded(["x"]))
    assert texts_of(consumer.read()) == ["d", "x"]
    # The file moves; reading goes on in its committed copy.
    stream.commit(T0 + 2 * ONE, ["c", "d", "e"], file_minute=T0 + ONE)
    path.unlink()
    assert texts_of(consumer.read()) == ["d", "e", "x"]
    consumer.mark()
    stream.collect(T0 + 5 * ONE, ["f"])
    assert texts_of(consumer.read()) == ["f"]


def test_increments_list_only_what_came_since(spark, stream, tmp_path, monkeypatch):
    """After a mark neither minute directories before it nor files read whole are looked at."""
    hours = [T0 + timedelta(hours=h) for h in range(5)]
    for i, minute in enumerate(hours):
        stream.commit(minute, [f"m{i}"], file_minute=minute - ONE)
    stream.collect(hours[-1], ["n0"])
    done = stream.collect(hours[-1] - ONE, ["old"], collector="collector2")
    consumer = make(spark, stream, tmp_path, stream_type="stitched")
    assert texts_of(consumer.read(2)) == ["m0", "m1"]
    consumer.mark()  # a limited read leaves older files, so all of them are listed again
    assert texts_of(consumer.read()) == ["m2", "m3", "m4", "n0", "old"]
    consumer.mark()
    listed = []
    plain = collectors.read_minutes

    def watched(*args, **options):
        frame = plain(*args, **options)
        listed.extend(frame.inputFiles())
        return frame

    monkeypatch.setattr(collectors, "read_minutes", watched)
    # The old file may not be opened again; a broken file in an old directory is not seen.
    done.unlink()
    done.mkdir()
    (stream.minute_dir(hours[1]) / "broken").write_bytes(b"\x1f\x8b")
    stream.commit(hours[-1] + ONE, ["n0", "n1"], file_minute=hours[-1])
    stream.collector_file(hours[-1]).unlink()
    stream.commit(hours[-1] + 2 * ONE, ["late"], collector="collector9", file_minute=hours[0])
    again = make(spark, stream, tmp_path, stream_type="stitched")
    assert texts_of(again.read()) == ["late", "n1"]
    assert len(listed) == 3 and not any("broken" in path for path in listed)
    again.mark()
    # What was listed is a row beside the positions.
    store = cp.FileCheckpointStore(str(tmp_path / "store"))
    kept = store.load(spark, "c1", stream.topic)
    assert sorted(r.collector for r in kept.collect()) == ["", "collector1", "collector2", "collector9"]


def test_new_collector_starts_by_the_options(spark, stream, tmp_path):
    stream.collect(T0 + 2 * ONE, ["a"])
    consumer = make(spark, stream, tmp_path, stream_type="collector")
    assert texts_of(consumer.read()) == ["a"]
    consumer.mark()
    stream.collect(T0, ["old"], collector="collector2")
    stream.collect(T0 + 3 * ONE, ["new"], collector="collector2")
    assert texts_of(consumer.read()) == ["new", "old"]
    timed = make(
        spark, stream, tmp_path, stream_type="collector", start_of_stream=False, start=T0 + ONE
    )
    assert texts_of(timed.read()) == ["new"]


def test_two_clusters_and_rename(spark, filled, tmp_path):
    from conftest import Stream

    other = Stream(tmp_path / "other")
    other.commit(T0, ["o1", "o2"])
    other.minute_dir(T0 + ONE)
    roots = [str(filled.root), str(other.root)]
    consumer = Consumer(spark, filled.topic, "c1", roots, str(tmp_path / "store"), start_of_stream=True)
    consumer.read(5)
    consumer.mark()
    marks = cp.load_checkpoint(spark, consumer.store, "c1", filled.topic)
    names = {"cluster0": "west", "cluster1": "east"}
    cp.save_checkpoint(cp.rename_clusters(marks, names), consumer.store, "c1", filled.topic)
    renamed = dict(zip(["west", "east"], roots))
    after = Consumer(spark, filled.topic, "c1", renamed, consumer.store)
    # Read: four lines of the first cluster's minute and one of the second's.
    assert texts_of(after.read()) == sorted(texts(1, 2, 4, 5) + ["o2"])


def test_mark_points(spark, filled):
    lines = with_positions(read_minutes(spark, str(filled.root), filled.topic))
    points = mark_points(number_messages(lines), every=7).select("minute", "line_no", "message_no")
    assert sorted(tuple(r) for r in points.collect()) == [(T0 + ONE, 3, 7), (T0 + 4 * ONE, 2, 14)]


def test_sequence_files(spark, tmp_path):
    for i in (0, 1):
        rdd = spark.sparkContext.parallelize([(n, f"v{i}-{n}") for n in range(5)], 2)
        rdd.saveAsSequenceFile(str(tmp_path / "root" / (T0 + i * ONE).strftime("%Y/%m/%d/%H/%M")))
    root = str(tmp_path / "root")
    values = read_sequence_values(spark, root, "t")
    assert sorted(r.value for r in values.collect()) == [f"v{i}-{n}" for i in (0, 1) for n in range(5)]
    assert read_sequence_values(spark, root, "t", start=T0 + ONE, stop=T0 + ONE).count() == 5


def test_streaming_reader_stats(spark, filled, tmp_path):
    stats = ReaderStats()
    spark.streams.addListener(stats)
    try:
        (filled.minute_dir(T0) / "extra").write_bytes(b"*bad*\n")
        frame = observed(stream_minutes(spark, str(filled.root), filled.topic), ["cluster0"])
        writer = frame.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ck"))
        writer.trigger(availableNow=True).start().awaitTermination()
        for _ in range(50):
            if stats.counts:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(stats)
    assert stats.counts == {"read:cluster0": 21, "errors:cluster0": 1}
    assert stats.last_minute == "2024-03-01 11:03"


def test_plain_lines(spark, stream, tmp_path):
    """Text that is no Base64 is read as it is, marked and gone on with."""
    for i in range(3):
        text = f"plain {i}\nnot = base64 {i}\n\n"
        (stream.minute_dir(T0 + i * ONE) / "f").write_text(text)

    def member(fmt="text"):
        return Consumer(
            spark, stream.topic, "plain", str(stream.root), str(tmp_path / "marks"),
            start_of_stream=True, fmt=fmt,
        )

    first = member()
    taken = [r.value for r in first.read(max_messages=2).collect()]
    first.mark()
    assert sorted(taken) == ["not = base64 0", "plain 0"]
    rest = [r.value for r in member().read().collect()]
    assert sorted(rest) == ["", "", "not = base64 1", "plain 1"]
    with pytest.raises(ValueError):
        member("avro")
