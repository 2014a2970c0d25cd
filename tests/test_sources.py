from datetime import datetime, timedelta

import pytest
from conftest import encoded, texts_of
from pyspark.sql import functions as F

from minuteflow.operators import checkpoint, ranges
from minuteflow.operators.positions import consume, with_positions
from minuteflow.sources.collectors import read_collectors, read_stitched
from minuteflow.sources.listing import list_files, minute_dirs
from minuteflow.sources.minutes import decode_messages, read_messages, read_minutes

T0 = datetime(2024, 3, 1, 10, 0)
ONE = timedelta(minutes=1)


def files_opened(df) -> int:
    """Files the scan of an executed plan selected."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    total, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if node.metrics().contains("numFiles"):
            total += node.metrics().apply("numFiles").value()
        children = node.children().iterator()
        while children.hasNext():
            todo.append(children.next())
    return total


def test_scan_nested_hidden_and_empty(spark, stream):
    stream.commit(T0, ["a", "b"])
    stream.commit(T0 + ONE, [])
    nested = stream.minute_dir(T0 + 2 * ONE) / "part" / "deep"
    nested.mkdir(parents=True)
    (nested / "datafile").write_bytes(encoded(["c"]))
    (stream.minute_dir(T0) / "_tmp").write_bytes(encoded(["no"]))
    out = read_messages(spark, str(stream.root), stream.topic)
    assert texts_of(out) == ["a", "b", "c"]
    dirs = {r.file_dir for r in out.select("file_dir").distinct().collect()}
    assert dirs == {"2024/03/01/10/00", "2024/03/01/10/02/part/deep"}


def test_absent_stream_is_empty(spark, stream):
    assert read_messages(spark, str(stream.root), "none").count() == 0
    assert list_files(spark, str(stream.root), "none").count() == 0
    assert minute_dirs(spark, str(stream.root), "none").count() == 0
    assert read_stitched(spark, str(stream.root), "none").count() == 0


def test_range_and_group_open_only_their_files(spark, stream):
    for i in range(20):
        stream.commit(T0 + i * ONE, [f"m{i:02d}"])
    root = str(stream.root)
    part = read_minutes(
        spark, root, stream.topic, start=T0 + 3 * ONE + timedelta(seconds=30), stop=T0 + 7 * ONE
    )
    assert files_opened(part) == 5
    assert texts_of(decode_messages(part)) == [f"m{i:02d}" for i in range(3, 8)]
    member = read_minutes(spark, root, stream.topic, group="2/4")
    assert files_opened(member) == 5
    assert texts_of(decode_messages(member)) == [f"m{i:02d}" for i in range(20) if i % 4 == 1]
    late = read_minutes(spark, root, stream.topic, start=T0 + 18 * ONE)
    assert files_opened(late) == 2
    with pytest.raises(ValueError):
        read_minutes(spark, root, stream.topic, start=T0 + ONE, stop=T0)


def test_merged_takes_one_root(spark, stream):
    with pytest.raises(ValueError):
        read_minutes(spark, ["/a", "/b"], stream.topic, "merged")


def test_generic_stream(spark, stream):
    (stream.minute_dir(T0, base="") / "datafile1").write_bytes(encoded(["x"]))
    rows = decode_messages(read_minutes(spark, str(stream.root), "any", "generic"))
    assert texts_of(rows) == ["x"] and rows.first().minute == T0


def test_listing_and_empty_dirs(spark, stream):
    stream.commit(T0, ["a"])
    stream.commit(T0, ["b"], collector="collector2")
    stream.minute_dir(T0 + ONE)
    (stream.minute_dir(T0) / "_tmp").write_text("")
    dirs = {r.minute: r.n_files for r in minute_dirs(spark, str(stream.root), stream.topic).collect()}
    assert dirs == {T0: 2, T0 + ONE: 0}
    files = list_files(spark, str(stream.root), stream.topic).collect()
    assert sorted(f.collector for f in files) == ["collector1", "collector2"]
    assert all(f.file_minute == T0 - ONE and f.length > 0 for f in files)


def test_collectors_skip_open_and_stats_files(spark, stream):
    stream.collect(T0, ["a"])
    stream.collect(T0 + ONE, ["b"], collector="collector2")
    folder = stream.root / "data" / stream.topic / "collector1"
    for name in (f"{stream.topic}_current", f"{stream.topic}_stats", "collector_stats"):
        (folder / name).write_bytes(encoded(["no"]))
    rows = decode_messages(read_collectors(spark, str(stream.root), stream.topic))
    assert texts_of(rows) == ["a", "b"]
    early = read_collectors(spark, str(stream.root), stream.topic, stop=T0)
    assert texts_of(decode_messages(early)) == ["a"]


def test_stitching_reads_each_file_once(spark, stream):
    stream.commit(T0 + ONE, ["moved"], file_minute=T0)
    stream.commit(T0 + 2 * ONE, ["both"], file_minute=T0 + ONE)
    stream.collect(T0 + ONE, ["both"])
    stream.collect(T0 + 2 * ONE, ["new"])
    stream.collect(T0 + ONE, ["other"], collector="collector2")
    rows = read_stitched(spark, str(stream.root), stream.topic)
    assert texts_of(decode_messages(rows)) == ["both", "moved", "new", "other"]
    late = read_stitched(spark, str(stream.root), stream.topic, start=T0 + ONE, stop=T0 + ONE)
    assert texts_of(decode_messages(late)) == ["both", "other"]
    alone = read_stitched(spark, str(stream.root), stream.topic, local=False)
    assert texts_of(decode_messages(alone)) == ["both", "new", "other"]


def test_a_line_still_being_written_waits(spark, stream):
    path = stream.collect(T0, ["first", "second"])
    whole = encoded(["third"])
    with path.open("ab") as out:
        out.write(whole[:4])
    only = stream.collector_file(T0 + ONE)
    only.write_bytes(whole[:4])
    before = read_collectors(spark, str(stream.root), stream.topic)
    assert texts_of(decode_messages(before)) == ["first", "second"]
    with path.open("ab") as out:
        out.write(whole[4:] + encoded(["fourth"]))
    # The first read has its end fixed; a new one sees whole lines.
    assert texts_of(decode_messages(before)) == ["first", "second"]
    after = read_stitched(spark, str(stream.root), stream.topic)
    assert texts_of(decode_messages(after)) == ["first", "fourth", "second", "third"]


@pytest.mark.parametrize("keep", [True, False])
def test_files_that_move_after_the_listing(spark, stream, keep):
    """Copied, or moved, once the read is planned: every line once, also across ranges."""
    texts = [f"m{i:04d}" for i in range(500)]
    path = stream.collect(T0, texts)
    stream.commit(T0, ["old"], file_minute=T0 - ONE)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        lines = read_stitched(spark, str(stream.root), stream.topic)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    stream.commit(T0 + ONE, texts, file_minute=T0)
    if not keep:
        path.unlink()
    assert texts_of(decode_messages(lines)) == [*texts, "old"]


def test_an_increment_opens_only_unread_files(spark, stream):
    for i in range(20):
        stream.commit(T0 + i * ONE, [f"m{i:02d}"])
    scan = read_minutes(spark, {"c0": str(stream.root)}, stream.topic)
    first = with_positions(scan).filter(F.col("minute") <= F.lit(str(T0 + 17 * ONE)).cast("timestamp"))
    mark = checkpoint.build_checkpoint(first)
    unread = scan.filter(checkpoint.unread_files(mark))
    assert files_opened(unread) == 3
    rest = checkpoint.resume(with_positions(unread), mark)
    assert texts_of(decode_messages(rest)) == ["m18", "m19"]
    # By collector; one without a position is read from its start.
    stream.commit(T0 + ONE, ["new"], collector="collector2")
    scan = read_stitched(spark, {"c0": str(stream.root)}, stream.topic)
    mark = checkpoint.build_checkpoint(
        with_positions(scan.filter("collector = 'collector1'")), "collector"
    )
    where = checkpoint.unread_files(mark, "stitched")
    unread = read_stitched(spark, {"c0": str(stream.root)}, stream.topic, where=where)
    assert files_opened(unread) == 2
    rest = checkpoint.resume(with_positions(unread), mark, "stitched")
    assert texts_of(decode_messages(rest)) == ["new"]


def test_other_session_zones_are_refused(spark, stream):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        for read in (read_minutes, read_collectors, list_files):
            with pytest.raises(ValueError, match="UTC"):
                read(spark, str(stream.root), stream.topic)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_bounded_reads_refuse_gaps(spark, stream):
    stream.collect(T0, ["a", "b", "c"])
    lines = with_positions(read_collectors(spark, str(stream.root), stream.topic))
    assert consume(lines, 2, "collector").count() == 2
    with pytest.raises(Exception, match="filtered out"):
        consume(lines.filter("line_no <> 2"), 2, "collector").count()


def test_line_numbers_across_splits(spark, stream):
    sizes = {0: 5000, 1: 1, 2: 700}
    for number, n in sizes.items():
        stream.collect(T0, [f"{number}:{i:06d}" for i in range(1, n + 1)], number=number)
    stream.commit(T0, [f"9:{i:06d}" for i in range(1, 301)], file_minute=T0, collector="c9")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = read_stitched(spark, str(stream.root), stream.topic)
        assert lines.rdd.getNumPartitions() > 10
        rows = decode_messages(with_positions(lines)).select("payload", "line_no").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == sum(sizes.values()) + 300
    assert all(int(bytes(r.payload).decode().split(":")[1]) == r.line_no for r in rows)


def test_gate_on_real_directories(spark, stream):
    for i in (0, 1, 2, 4, 5):
        stream.commit(T0 + i * ONE, [f"m{i}"])
    root = {"c0": str(stream.root)}
    dirs = minute_dirs(spark, root, stream.topic)
    bounds = ranges.read_bounds(dirs)
    assert bounds == {"c0": T0 + ONE}
    rows = ranges.gate(read_minutes(spark, root, stream.topic), bounds)
    assert texts_of(decode_messages(rows)) == ["m0", "m1"]
    stream.minute_dir(T0 + 3 * ONE)
    bounds = ranges.read_bounds(minute_dirs(spark, root, stream.topic))
    assert bounds == {"c0": T0 + 4 * ONE}
    bounds = ranges.read_bounds(minute_dirs(spark, root, stream.topic), start=T0 + 5 * ONE)
    assert bounds == {"c0": T0 + 4 * ONE}


def test_names_that_need_escaping(spark, tmp_path):
    from conftest import Stream

    odd = Stream(tmp_path / "a b%20c#d")
    odd.topic = "t [1]+x"
    odd.commit(T0, ["committed"], collector="my host", file_minute=T0)
    odd.collect(T0 + ONE, ["in flight"], collector="host2")
    root = str(odd.root)
    row = read_messages(spark, root, odd.topic).first()
    assert (row.minute, row.collector, bytes(row.payload)) == (T0, "my host", b"committed")
    assert [f.minute for f in list_files(spark, root, odd.topic).collect()] == [T0]
    rows = decode_messages(read_stitched(spark, root, odd.topic))
    assert texts_of(rows) == ["committed", "in flight"]


def test_open_end_is_the_streams_own_last_minute(spark, stream):
    """Neither the clock's year nor 1970 bounds a range that is open."""
    stream.commit(datetime(2031, 12, 31, 23, 59), ["a"])
    stream.commit(datetime(2033, 1, 2, 3, 4), ["b"])
    root = str(stream.root)
    read = lambda **k: read_minutes(spark, root, stream.topic, "local", **k).count()
    assert read() == read(start=datetime(2020, 1, 1)) == read(stop=datetime(2040, 1, 1)) == 2
    assert read(start=datetime(2032, 1, 1)) == read(stop=datetime(2032, 1, 1)) == 1
    assert read(start=datetime(2034, 1, 1)) == read(stop=datetime(2030, 1, 1)) == 0


def test_absent_root_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_minutes(spark, str(tmp_path / "mistyped"), "t", "local")
    with pytest.raises(FileNotFoundError):
        read_collectors(spark, str(tmp_path / "mistyped"), "t")
