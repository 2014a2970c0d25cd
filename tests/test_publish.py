from datetime import datetime, timedelta

import pytest
from conftest import texts_of
from pyspark.sql import functions as F

import minuteflow.sources.publish as sink
from minuteflow.operators import metrics, ranges
from minuteflow.sources import layout, oplog
from minuteflow.sources.collectors import read_collectors
from minuteflow.sources.listing import minute_dirs
from minuteflow.sources.minutes import decode_messages, read_messages, read_minutes
from minuteflow.streaming.sinks import publish_stream

T0 = datetime(2024, 3, 1, 10, 0)
ONE = timedelta(minutes=1)


def messages(spark, rows):
    df = spark.createDataFrame(rows, "topic string, text string, at int")
    base = F.lit(T0.isoformat(" ")).cast("timestamp")
    return df.select(
        "topic", F.col("text").cast("binary").alias("payload"), "at",
        F.timestamp_add("MINUTE", "at", base).alias("minute"),
    )


def test_round_trip_keeps_order_and_marks_end(spark, tmp_path):
    rows = [("t1", f"m{i:03d}", i % 3) for i in range(30)] + [("t2", "x", 1)]
    done = sink.publish(
        messages(spark, rows), str(tmp_path), minute=F.col("minute"), order_by=("payload",)
    )
    assert (done.accepted, done.rejected) == (31, 0)
    assert texts_of(read_messages(spark, str(tmp_path), "t1")) == [f"m{i:03d}" for i in range(30)]
    dirs = {r.minute: r.n_files for r in minute_dirs(spark, str(tmp_path), "t1").collect()}
    assert dirs == {T0: 1, T0 + ONE: 1, T0 + 2 * ONE: 1, T0 + 3 * ONE: 0}
    lines = read_messages(spark, str(tmp_path), "t1", start=T0, stop=T0)
    assert [bytes(r.payload).decode() for r in lines.collect()] == [f"m{i:03d}" for i in range(0, 30, 3)]


def test_default_minute_is_now(spark, tmp_path):
    before = layout.to_minute(layout.utc_now())
    sink.publish(messages(spark, [("t", "a", 0)]), str(tmp_path))
    row = read_messages(spark, str(tmp_path), "t").first()
    assert before <= row.minute <= layout.to_minute(layout.utc_now())


def test_late_rows_go_to_the_open_minute(spark, tmp_path):
    root = str(tmp_path)
    sink.publish(messages(spark, [("t", "a", 0), ("t", "b", 5)]), root, minute=F.col("minute"))
    # 10:06 exists and is open; 10:00..10:05 are complete.
    sink.publish(
        messages(spark, [("t", "late", 1), ("t", "next", 8), ("u", "new", 1)]), root,
        minute=F.col("minute"),
    )
    at = {bytes(r.payload).decode(): r.minute for r in read_messages(spark, root, "t").collect()}
    assert at == {"a": T0, "b": T0 + 5 * ONE, "late": T0 + 6 * ONE, "next": T0 + 8 * ONE}
    minutes = [r.minute for r in minute_dirs(spark, root, "t").orderBy("minute").collect()]
    assert minutes == [T0 + i * ONE for i in range(10)]
    assert ranges.read_bounds(minute_dirs(spark, root, "t")) == {"cluster0": T0 + 8 * ONE}
    assert read_messages(spark, root, "u").first().minute == T0 + ONE


def test_second_publish_adds_files(spark, tmp_path):
    root = str(tmp_path)
    minute = F.lit((T0 + ONE).isoformat(" ")).cast("timestamp")
    for text in ("a", "b", "c"):
        sink.publish(messages(spark, [("t", text, 1)]), root, minute=minute, stream_type="collector")
    rows = decode_messages(read_collectors(spark, root, "t"))
    assert texts_of(rows) == ["a", "b", "c"]
    assert sorted(r.file_id for r in rows.collect()) == [0, 1, 2]


def test_rejections_are_counted_and_kept(spark, tmp_path):
    rows = [(None, "a", 0), ("t", None, 0), ("t", "x" * 60, 0), ("t", "ok", 0)]
    done = sink.publish(
        messages(spark, rows).withColumn("ms", F.lit(1704067200000)), str(tmp_path / "root"),
        minute=F.col("minute"), max_size=70, audit_ts="ms", rejected_to=str(tmp_path / "bad"),
    )
    assert (done.accepted, done.rejected) == (1, 3)
    reasons = spark.read.parquet(str(tmp_path / "bad")).select("reason").collect()
    assert sorted(r.reason for r in reasons) == ["EXCEEDED_MSG_SIZE", "NULL_MESSAGE", "NULL_TOPIC"]
    assert texts_of(read_messages(spark, str(tmp_path / "root"), "t")) == ["ok"]


def test_nothing_accepted(spark, tmp_path):
    done = sink.publish(messages(spark, [(None, "a", 0)]), str(tmp_path))
    assert (done.accepted, done.rejected, done.files.count()) == (0, 1, 0)


def test_same_tag_is_published_once(spark, tmp_path):
    df = messages(spark, [("t", "a", 0), ("t", "b", 1)])
    for _ in range(2):
        done = sink.publish(df, str(tmp_path), minute=F.col("minute"), tag="batch-1")
        assert done.accepted == 2 and done.files.count() == 2
    assert texts_of(read_messages(spark, str(tmp_path), "t")) == ["a", "b"]


@pytest.mark.parametrize("stream_type", ["local", "collector"])
@pytest.mark.parametrize("fail_at", [0, 1, 2])
@pytest.mark.parametrize("after", [False, True])
def test_retry_after_a_crash(spark, tmp_path, monkeypatch, stream_type, fail_at, after):
    """Die before or after each rename step, publish the tag again: whole, no doubles."""
    df = messages(spark, [("t", f"m{i}", i % 4) for i in range(12)])
    kwargs = dict(minute=F.col("minute"), tag="b", stream_type=stream_type)
    original, calls = sink._on_executors, []

    def dying(*args):
        calls.append(args)
        if len(calls) - 1 == fail_at and not after:
            raise RuntimeError("lost driver")
        original(*args)
        if len(calls) - 1 == fail_at:
            raise RuntimeError("lost driver")

    monkeypatch.setattr(sink, "_on_executors", dying)
    crashes = not (stream_type == "collector" and fail_at > 0)
    if crashes:
        with pytest.raises(RuntimeError):
            sink.publish(df, str(tmp_path), **kwargs)
    monkeypatch.setattr(sink, "_on_executors", original)
    assert sink.publish(df, str(tmp_path), **kwargs).accepted == 12
    if stream_type == "collector":
        rows = decode_messages(read_collectors(spark, str(tmp_path), "t"))
    else:
        rows = read_messages(spark, str(tmp_path), "t")
        assert ranges.read_bounds(minute_dirs(spark, str(tmp_path), "t")) == {"cluster0": T0 + 3 * ONE}
    assert texts_of(rows) == sorted(f"m{i}" for i in range(12))


def test_odd_topic_names_and_routing(spark, tmp_path):
    df = messages(spark, [("a-b.c", "x", 0), ("p q+r", "y", 0)])
    done = sink.publish(df, str(tmp_path), minute=F.col("minute"))
    assert sorted(r.topic for r in done.files.collect()) == ["a-b.c", "p q+r"]
    assert texts_of(read_messages(spark, str(tmp_path), "a-b.c")) == ["x"]
    routed = sink.route(df, lambda d: F.when(d.topic == "a-b.c", F.concat("topic", F.lit("-0"))))
    assert sorted(r.topic for r in routed.collect()) == ["a-b.c-0", "p q+r"]
    assert sink.route(df).collect() == df.collect()


def test_publish_text(spark, tmp_path):
    (tmp_path / "in.txt").write_text("one\ntwo\n\nfour\n")
    sink.publish_text(spark, str(tmp_path / "in.txt"), "lines", str(tmp_path / "root"))
    assert texts_of(read_messages(spark, str(tmp_path / "root"), "lines")) == ["", "four", "one", "two"]


def test_stream_publish_appends_batches(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    stream = spark.readStream.text(str(source)).select(
        F.lit("t").alias("topic"), F.col("value").cast("binary").alias("payload")
    )
    for n in range(2):
        (source / f"{n}.txt").write_text(f"a{n}\nb{n}\n")
        writer = publish_stream(stream, str(tmp_path / "root"), "q")
        writer = writer.option("checkpointLocation", str(tmp_path / "ck"))
        writer.trigger(availableNow=True).start().awaitTermination()
    assert texts_of(read_messages(spark, str(tmp_path / "root"), "t")) == ["a0", "a1", "b0", "b1"]


def test_hot_topic_is_split_over_files(spark, tmp_path):
    """AQE cuts a topic that holds most rows; every row is written once."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(40_000, numPartitions=8).select(
            F.when(F.col("id") % 10 == 0, F.concat(F.lit("t"), F.col("id") % 3)).otherwise("hot").alias("topic"),
            F.sha2(F.col("id").cast("string"), 256).cast("binary").alias("payload"),
        )
        minute = F.lit(T0.isoformat(" ")).cast("timestamp")
        done = sink.publish(rows, str(tmp_path), minute=minute)
    finally:
        for key in settings:
            spark.conf.unset(key)
    files = {r.topic: r["count"] for r in done.files.groupBy("topic").count().collect()}
    assert files["hot"] > 3 and max(files[t] for t in ("t0", "t1", "t2")) <= files["hot"]
    hot = read_messages(spark, str(tmp_path), "hot")
    assert hot.count() == 36_000 and hot.select("payload").distinct().count() == 36_000


def test_streams_of_one_name_each_add_their_rows(spark, tmp_path):
    """A batch under the same checkpoint is stored once, another checkpoint's batch beside it."""
    source, root = tmp_path / "in", tmp_path / "root"
    rows = spark.range(5).selectExpr("'t' AS topic", "CAST(id AS string) AS payload")
    rows.write.parquet(str(source))

    def run(checkpoint):
        stream = spark.readStream.schema("topic string, payload string").parquet(str(source))
        stream = stream.selectExpr("topic", "CAST(payload AS binary) AS payload")
        writer = publish_stream(stream, str(root), "q")
        writer = writer.option("checkpointLocation", str(tmp_path / checkpoint))
        writer.trigger(availableNow=True).start().awaitTermination()
        return read_minutes(spark, str(root), "t", "local").count()

    assert run("one") == 5
    for name in ("0", ".0.crc"):  # as if the driver had died before it noted the commit
        (tmp_path / "one" / "commits" / name).unlink(missing_ok=True)
    assert run("one") == 5
    assert run("two") == 10


def test_outcomes_are_logged_once_per_tag(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    assert oplog.published_log(spark, root).count() == 0
    rows = [("a", "m", 0), ("a", "x" * 60, 0), ("b c", "m", 0), ("a", None, 0), (None, "m", 0), ("big", "y" * 70, 0)]
    send = lambda tag, of=rows: sink.publish(
        messages(spark, of), root, minute=F.col("minute"), max_size=50, tag=tag, publisher="p1"
    )
    commit = sink._commit

    def fail(*args):
        commit(*args)
        raise OSError("lost after the files were moved")

    monkeypatch.setattr(sink, "_commit", fail)
    with pytest.raises(OSError):
        send("one")
    assert oplog.published_log(spark, root).count() == 0
    monkeypatch.undo()
    send("one")
    send("one")
    send("two", [("a", "m", 0)] * 3)
    done = send("none", [("a", None, 0)])
    assert (done.accepted, done.rejected) == (0, 1)
    log = oplog.published_log(spark, root)
    stats = {r.topic: (r.invocations, r.success, r.exceeded_size, r.in_flight) for r in metrics.publish_stats(log).collect()}
    assert stats == {"a": (5, 4, 1, 1), "b c": (1, 1, 0, 0), "big": (1, 0, 1, 1)}
    assert {r.publisher for r in log.collect()} == {"p1"}
    total = metrics.publish_totals(log).filter("level = 3").first()
    assert (total.invocations, total.success) == (7, 5) and total.cumulative_nanos > 0
