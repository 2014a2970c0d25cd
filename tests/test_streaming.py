import gzip
from base64 import b64decode, b64encode
from datetime import datetime, timedelta

import pytest
from conftest import encoded, texts_of
from pyspark.sql import functions as F

from minuteflow.operators import audit, checkpoint
from minuteflow.operators.positions import with_positions
from minuteflow.sources import layout
from minuteflow.sources.minutes import decode_messages, read_messages, read_minutes
from minuteflow.streaming import minute_source, tail_source
from minuteflow.streaming.sinks import audit_stream, read_packets
from minuteflow.streaming.lines import file_lines, last_newline, next_line_start
from minuteflow.streaming.minute_source import MinuteReader, drain_minutes, stream_minutes
from minuteflow.streaming.tail_source import TailReader, stream_collectors

T0 = datetime(2024, 3, 1, 10, 57)
ONE = timedelta(minutes=1)


class Drain:
    """Runs a stream to its end, again and again, with one checkpoint."""

    def __init__(self, spark, tmp_path):
        self.spark, self.out, self.ck = spark, str(tmp_path / "out"), str(tmp_path / "ck")

    def __call__(self, stream):
        writer = stream.writeStream.format("parquet").option("checkpointLocation", self.ck)
        writer.trigger(availableNow=True).start(self.out).awaitTermination()
        return texts_of(self.spark.read.parquet(self.out))


@pytest.fixture
def drain(spark, tmp_path):
    return Drain(spark, tmp_path)


def test_minutes_arrive_as_they_complete(spark, stream, drain):
    def run():
        return drain(stream_minutes(spark, str(stream.root), stream.topic))

    stream.commit(T0, ["a"])
    stream.commit(T0 + ONE, ["b"])
    assert run() == ["a"]
    stream.minute_dir(T0 + 2 * ONE)
    assert run() == ["a", "b"]
    stream.commit(T0 + 4 * ONE, ["d"])  # 10:60 is missing, so nothing more
    assert run() == ["a", "b"]
    stream.commit(T0 + 3 * ONE, ["c"])
    stream.minute_dir(T0 + 5 * ONE)
    assert run() == ["a", "b", "c", "d"]
    assert run() == ["a", "b", "c", "d"]


def test_minutes_options(spark, stream, drain):
    for i in range(10):
        stream.commit(T0 + i * ONE, [f"m{i}"])
    frame = stream_minutes(
        spark, str(stream.root), stream.topic,
        start=(T0 + 2 * ONE).isoformat(), stop=(T0 + 6 * ONE).isoformat(), group="1/2",
    )
    owned = [i for i in range(2, 7) if (T0 + i * ONE).minute % 2 == 0]
    assert drain(frame) == [f"m{i}" for i in owned]


def test_drain_goes_on_past_the_limit(spark, stream, tmp_path):
    for i in range(8):
        stream.commit(T0 + i * ONE, [f"m{i}"])
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")

    def start():
        frame = stream_minutes(spark, str(stream.root), stream.topic, maxMinutesPerBatch=3)
        writer = frame.writeStream.format("parquet").option("checkpointLocation", ck)
        return writer.trigger(availableNow=True).start(out)

    assert drain_minutes(start) == 3
    assert texts_of(spark.read.parquet(out)) == [f"m{i}" for i in range(7)]


def reader(stream, **options):
    import json

    return MinuteReader(
        {"topic": stream.topic, "roots": json.dumps({"c0": str(stream.root)}), **options}
    )


def column(source, part, name):
    return [v for batch in source.read(part) for v in batch[name].to_pylist()]


def test_minute_limit_and_order(stream):
    for i in range(6):
        stream.commit(T0 + i * ONE, [f"m{i}"], number=1)
        stream.commit(T0 + i * ONE, [f"n{i}"], number=2)
    source = reader(stream, maxminutesperbatch="2")
    offset, seen = source.initialOffset(), []
    for _ in range(4):
        latest = source.latestOffset()
        parts = source.partitions(offset, latest)
        names = [(p.first[-2:], n) for p in parts for n in column(source, p, "file_name")]
        assert len({minute for minute, _ in names}) <= 2
        seen += [(minute, name[-8:-3]) for minute, name in names]
        offset = latest
    minutes = ["57", "58", "59", "00", "01"]
    assert seen == [(m, number) for m in minutes for number in ("00001", "00002")]
    again = reader(stream, maxminutesperbatch="2")
    assert again.partitions(offset, offset) == []
    assert again.latestOffset() == offset


@pytest.mark.parametrize("tasks", [1, 2, 7, 64])
@pytest.mark.parametrize("size", [30, 1000, 100_000])
def test_parts_of_a_minute(stream, monkeypatch, tasks, size):
    """Any number of tasks and any size of ranges give each line once, with its number."""
    long = "x" * 500
    texts = {"f1": [f"message {i}" for i in range(200)], "f2": ["a", long, "b"], "f3": []}
    for name, part in texts.items():
        (stream.minute_dir(T0) / name).write_bytes(encoded(part))
    gz = stream.commit(T0, [f"zipped {i}" for i in range(90)], number=4)
    texts[gz] = [f"zipped {i}" for i in range(90)]
    (stream.minute_dir(T0) / "_hidden").write_bytes(encoded(["no"]))
    stream.minute_dir(T0 + ONE)
    monkeypatch.setattr(minute_source, "MAX_PARTITION_BYTES", size)
    source = reader(stream, tasks=str(tasks))
    parts = source.partitions(source.initialOffset(), source.latestOffset())
    assert len(parts) == tasks
    rows = [
        row for p in parts for batch in source.read(p) for row in batch.to_pylist()
    ]
    got = sorted((r["file_name"], r["line_no"], r["value"]) for r in rows)
    wanted = [
        (name, i, b64encode(t.encode()).decode())
        for name, part in texts.items()
        for i, t in enumerate(part, 1)
    ]
    assert got == sorted(wanted)
    if tasks == 7 and size == 30:
        assert sum(bool(column(source, p, "value")) for p in parts) > 3


def test_long_catch_up_is_few_tasks(stream, monkeypatch):
    for i in range(0, 60 * 30):
        stream.minute_dir(T0 + i * ONE)
    listed = []
    plain = minute_source.storage.subdirs
    monkeypatch.setattr(
        minute_source.storage, "subdirs", lambda path: listed.append(path) or plain(path)
    )
    source = reader(stream, tasks="8")
    parts = source.partitions(source.initialOffset(), source.latestOffset())
    assert len(parts) == 8
    # Hours and the way to the first and last minute, no minutes.
    assert len(listed) < 60
    assert sum(len(source._minutes(*map(layout.parse_minute_path, (p.first, p.last)))) for p in parts) == 1799


def test_checkpoint_from_a_stream(spark, stream, tmp_path):
    """A batch read resumes after what a stream has read."""
    for i in range(5):
        stream.commit(T0 + i * ONE, [f"m{i}", f"n{i}"])
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    rows = stream_minutes(spark, str(stream.root), stream.topic, stop=(T0 + ONE).isoformat())
    writer = rows.writeStream.format("parquet").option("checkpointLocation", ck)
    writer.trigger(availableNow=True).start(out).awaitTermination()
    streamed = spark.read.parquet(out)
    batch = with_positions(read_minutes(spark, str(stream.root), stream.topic))
    keys = ["cluster", "collector", "minute", "file_minute", "file_id", "file_dir", "file_name",
            "file_mtime", "line_no"]
    early = batch.filter(F.col("minute") <= F.lit(T0 + ONE))
    assert sorted(streamed.select(keys).collect()) == sorted(early.select(keys).collect())
    mark = checkpoint.build_checkpoint(streamed.filter("line_no < 2 or minute < '2024-03-01 10:58'"))
    left = checkpoint.resume(batch, mark)
    assert texts_of(decode_messages(left)) == ["m2", "m3", "m4", "n1", "n2", "n3", "n4"]


def test_plain_text_minutes(spark, stream, tmp_path):
    for i in range(2):
        (stream.minute_dir(T0 + i * ONE) / "f").write_bytes(b"plain %d\r\nnot = base64\n\n\xff" % i)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    rows = stream_minutes(spark, str(stream.root), stream.topic, fmt="text")
    writer = rows.writeStream.format("parquet").option("checkpointLocation", ck)
    writer.trigger(availableNow=True).start(out).awaitTermination()
    got = spark.read.parquet(out).orderBy("line_no").select("line_no", "value").collect()
    assert [tuple(r) for r in got] == [(1, "plain 0"), (2, "not = base64"), (3, ""), (4, "\ufffd")]
    with pytest.raises(ValueError):
        stream_minutes(spark, str(stream.root), stream.topic, fmt="other")


def test_start_before_and_inside_gap(stream):
    stream.commit(T0, ["a"])
    stream.commit(T0 + 4 * ONE, ["b"])
    stream.minute_dir(T0 + 5 * ONE)
    early = reader(stream, start=(T0 - timedelta(hours=3)).isoformat())
    assert early.latestOffset() == {"c0": "2024/03/01/07/56"}
    inside = reader(stream, start=(T0 + 2 * ONE).isoformat())
    assert inside.latestOffset() == {"c0": "2024/03/01/11/01"}


def test_file_lines(tmp_path):
    data = b"".join(b"line %d\n" % i for i in range(1000)) + b"partial"
    (tmp_path / "f").write_bytes(data)
    (tmp_path / "f.gz").write_bytes(gzip.compress(data))
    cut = data.index(b"line 500")
    for name in ("f", "f.gz"):
        path = str(tmp_path / name)
        got = [line for batch in file_lines(path, cut, closed=False) for line in batch]
        assert got == data[cut:].split(b"\n")[:-1]
        got = [line for batch in file_lines(path) for line in batch]
        assert got == data.split(b"\n")
        got = [line for batch in file_lines(path, 0, cut) for line in batch]
        assert got == data[:cut].split(b"\n")[:-1]
        assert list(file_lines(path, len(data) + 5)) == []
    assert last_newline(str(tmp_path / "f"), 0) == data.rindex(b"\n") + 1
    assert last_newline(str(tmp_path / "f"), len(data)) == len(data)
    assert next_line_start(str(tmp_path / "f"), cut, len(data)) == cut
    assert next_line_start(str(tmp_path / "f"), cut + 1, len(data)) == data.index(b"line 501")


def test_tail_growing_file(spark, stream, drain):
    def run():
        return drain(stream_collectors(spark, str(stream.root), stream.topic))

    path = stream.collect(T0, ["a", "b"])
    line = b64encode(b"cut in two") + b"\n"
    with path.open("ab") as out:
        out.write(line[:5])
    assert run() == ["a", "b"]
    with path.open("ab") as out:
        out.write(line[5:])
    assert run() == ["a", "b", "cut in two"]
    with path.open("ab") as out:
        out.write(b"dropped")  # no newline before the next file begins
    stream.collect(T0 + ONE, ["d"])
    stream.collect(T0, ["other"], collector="collector2")  # discovered by itself
    assert run() == ["a", "b", "cut in two", "d", "other"]
    (path.parent / f"{stream.topic}_stats").write_bytes(encoded(["no"]))
    assert run() == ["a", "b", "cut in two", "d", "other"]


def move(stream, minute, collector="collector1", number=0, delay=1):
    """Commit a collector file: compress it into its minute directory, drop the source."""
    path = stream.collector_file(minute, collector, number)
    name = f"{collector}-{path.name}.gz"
    (stream.minute_dir(minute + delay * ONE) / name).write_bytes(gzip.compress(path.read_bytes()))
    path.unlink()


def test_tail_follows_moved_files(spark, stream, drain):
    def run():
        return drain(stream_collectors(spark, str(stream.root), stream.topic))

    stream.collect(T0, ["a", "b"])
    assert run() == ["a", "b"]
    stream.collect(T0, ["c"])
    move(stream, T0)
    assert run() == ["a", "b", "c"]
    # Two files come and go between two runs, a third is still open.
    for i in (1, 2):
        stream.collect(T0 + i * ONE, [f"f{i}"])
        move(stream, T0 + i * ONE, delay=5)
    stream.collect(T0 + 3 * ONE, ["open"])
    assert run() == ["a", "b", "c", "f1", "f2", "open"]
    move(stream, T0 + 3 * ONE)
    assert run() == ["a", "b", "c", "f1", "f2", "open"]


def test_tail_without_committed_part(spark, stream, drain):
    stream.commit(T0 + ONE, ["committed"])
    stream.collect(T0 + ONE, ["x"])
    frame = stream_collectors(spark, str(stream.root), stream.topic, local="false")
    assert drain(frame) == ["x"]


def test_tail_splits_long_files(stream, monkeypatch):
    import json

    texts = [f"message {i}" for i in range(400)]
    stream.collect(T0, texts)
    monkeypatch.setattr(tail_source, "MAX_SPLIT_BYTES", 1000)
    source = TailReader({"topic": stream.topic, "roots": json.dumps({"c0": str(stream.root)})})
    parts = source.partitions(source.initialOffset(), source.latestOffset())
    assert len(parts) > 5
    lines = [v for p in parts for batch in source.read(p) for v in batch["value"].to_pylist()]
    assert lines == [b64encode(t.encode()).decode() for t in texts]


def tail(stream, **options):
    import json

    return TailReader(
        {"topic": stream.topic, "roots": json.dumps({"c0": str(stream.root)}), **options}
    )


def batch_of(source, offset):
    """One batch: its new offset and its (file, line number, text) rows."""
    latest = source.latestOffset()
    rows = [
        (r["file_name"][-11:], r["line_no"], b64decode(r["value"]).decode())
        for p in source.partitions(offset, latest)
        for batch in source.read(p)
        for r in batch.to_pylist()
    ]
    return latest, rows


def test_tail_line_numbers_go_on(stream, monkeypatch):
    monkeypatch.setattr(tail_source, "MAX_SPLIT_BYTES", 40)
    source = tail(stream)
    offset, seen = source.initialOffset(), []
    for n in range(3):
        stream.collect(T0, [f"{n} {'y' * i}" for i in range(30)])
        offset, rows = batch_of(source, offset)
        seen += rows
    name = stream.collector_file(T0).name[-11:]
    assert [(f, n) for f, n, _ in seen] == [(name, n) for n in range(1, 91)]
    # Planned over the open file, read from its compressed copy.
    stream.collect(T0, [f"late {i}" for i in range(30)])
    latest = source.latestOffset()
    parts = source.partitions(offset, latest)
    move(stream, T0)
    assert len(parts) > 3
    assert [n for p in parts for n in column(source, p, "line_no")] == [*range(91, 121)]


def test_tail_stop_and_limit(stream):
    for i in range(6):
        stream.collect(T0 + i * ONE, [f"f{i}"])
    for i in range(2):
        move(stream, T0 + i * ONE)
    source = tail(stream, stop=(T0 + 4 * ONE).isoformat(), maxfilespercollector="2")
    offset, seen, sizes = source.initialOffset(), [], []
    for _ in range(4):
        offset, rows = batch_of(source, offset)
        seen += [text for _, _, text in rows]
        sizes.append(len(rows))
    assert seen == [f"f{i}" for i in range(5)] and sizes == [2, 2, 1, 0]
    again = tail(stream, stop=(T0 + 4 * ONE).isoformat(), maxfilespercollector="2")
    assert again.partitions(offset, offset) == [] and again.latestOffset() == offset


def test_tail_dead_collector_costs_nothing(stream, monkeypatch):
    """One collector ends on the first day; later batches list the newest hours alone."""
    stream.collect(T0, ["last words"], collector="dead")
    move(stream, T0, collector="dead")
    source = tail(stream)
    offset, rows = batch_of(source, source.initialOffset())
    assert len(rows) == 1
    for h in range(1, 49):
        minute = T0 + timedelta(hours=h)
        stream.collect(minute, [f"h{h}"], collector="alive")
        move(stream, minute, collector="alive")
    offset, rows = batch_of(source, offset)
    assert len(rows) == 48
    listed = []
    plain = tail_source.storage.children
    monkeypatch.setattr(
        tail_source.storage, "children",
        lambda path, recursive=False: (recursive and listed.append(path)) or plain(path, recursive),
    )
    for reader in (source, tail(stream)):
        reader.partitions(offset, offset)
        minute = T0 + timedelta(hours=49)
        stream.collect(minute, ["more"], collector="alive")
        latest, rows = batch_of(reader, offset)
        assert [text for _, _, text in rows][:1] == ["more"]
    assert 0 < len(listed) <= 8


def test_tail_file_moves_after_planning(stream):
    import json

    stream.collect(T0, ["a", "b"])
    source = TailReader({"topic": stream.topic, "roots": json.dumps({"c0": str(stream.root)})})
    parts = source.partitions(source.initialOffset(), source.latestOffset())
    move(stream, T0)
    lines = [v for p in parts for batch in source.read(p) for v in batch["value"].to_pylist()]
    assert lines == [b64encode(t).decode() for t in (b"a", b"b")]


def test_audit_packets_add_up_over_batches(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    stream = spark.readStream.schema("topic string, ts_ms bigint").json(str(source))
    for n in range(2):
        rows = [("t", 60_000 * (i % 3)) for i in range(10 + n)]
        spark.createDataFrame(rows, "topic string, ts_ms bigint").write.mode("append").json(str(source))
        writer = audit_stream(stream, str(tmp_path / "root"), "q", "publisher", "host")
        writer = writer.option("checkpointLocation", str(tmp_path / "ck"))
        writer.trigger(availableNow=True).start().awaitTermination()
    packets = read_packets(read_messages(spark, str(tmp_path / "root"), audit.AUDIT_TOPIC))
    assert packets.count() == 2 and {p.hostname for p in packets.collect()} == {"host"}
    totals = {r.window_ms: r.received for r in audit.packet_counts(packets).collect()}
    assert totals == {0: 8, 60_000: 7, 120_000: 6}
