from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from minuteflow.operators import audit, metrics, validate

T0 = datetime(2024, 3, 1, 10, 0)
ONE = timedelta(minutes=1)


def test_counts_and_packets(spark):
    rows = [("a", 61_000), ("a", 119_999), ("a", 120_000), ("b", 5)]
    df = spark.createDataFrame(rows, "topic string, ts_ms bigint")
    counts = audit.audit_counts(df)
    assert sorted((r.topic, r.window_ms, r.received) for r in counts.collect()) == [
        ("a", 60_000, 2), ("a", 120_000, 1), ("b", 0, 1)]
    packets = audit.audit_packets(counts, "publisher", "h", 7)
    row = packets.filter("topic = 'a'").first()
    assert (row.timestamp, row.tier, row.hostname, row.window_size) == (7, "publisher", "h", 60)
    assert row.received == {60_000: 2, 120_000: 1} and row.sent == {} and row.tags == {}
    assert audit.audit_packets(counts.withColumn("received", F.lit(0)), "p", "h", 7).count() == 0
    cut = audit.audit_packets(counts, "publisher", "h", 7, max_windows=2)
    assert cut.count() == 3
    assert sorted(audit.packet_counts(cut).collect()) == sorted(counts.collect())


def test_reconcile_and_delta(spark):
    rows = [("publisher", "a", 5), ("storage", "a", 5), ("publisher", "b", 3), ("storage", "b", 2), ("storage", "c", 1)]
    df = spark.createDataFrame(rows, "tier string, topic string, value bigint")
    out = {r.topic: (r.publisher, r.storage, r.storage_diff, r.matches) for r in
           audit.reconcile(df, ["publisher", "storage"]).collect()}
    assert out == {"a": (5, 5, 0, True), "b": (3, 2, -1, False), "c": (0, 1, 1, False)}
    before = spark.createDataFrame([("a", 2), ("b", 4)], "k string, value bigint")
    after = spark.createDataFrame([("a", 7), ("c", 1)], "k string, value bigint")
    delta = {r.k: r.delta for r in audit.counter_delta(before, after, ["k"]).collect()}
    assert delta == {"a": 5, "b": -4, "c": 1}


FILES = "stream_type string, cluster string, collector string, minute timestamp, file_minute timestamp, file_id int, length bigint"


def listing(spark, in_flight=(), committed=()):
    rows = [("collector", "c0", "k", None, T0 + i * ONE, 0, n) for i, n in in_flight]
    rows += [("local", "c0", "k", T0 + (i + 1) * ONE, T0 + i * ONE, 0, n) for i, n in committed]
    return spark.createDataFrame(rows, FILES)


def position(spark, offset):
    at = T0 + offset * ONE
    return spark.createDataFrame(
        [("c0", "k", at, (at, 0), 3)],
        "cluster string, collector string, minute timestamp,"
        " file_key struct<file_minute:timestamp,file_id:int>, line_no bigint",
    )


def pending(df):
    rows = df.collect()
    return rows[0].pending_bytes if rows else 0


def test_backlog(spark):
    two = listing(spark, [(0, 9300), (1, 9300), (2, 9300)])
    assert pending(metrics.backlog(two)) == 27900
    assert pending(metrics.backlog(two, position(spark, 1))) == 18600
    assert pending(metrics.backlog(two, position(spark, 1), stop=T0 + ONE)) == 9300
    both = listing(spark, [(2, 9300), (3, 9300)], [(0, 101), (1, 103)])
    # The current file has moved: its minute and later, compressed, plus what is in flight.
    assert pending(metrics.backlog(both, position(spark, 1))) == int(103 * 3.8) + 18600
    assert pending(metrics.backlog(both, position(spark, 0))) == int(204 * 3.8) + 18600
    # The current file is in flight: committed ones are behind it.
    assert pending(metrics.backlog(both, position(spark, 2))) == 18600
    overlap = listing(spark, [(1, 50), (2, 70)], [(0, 10), (1, 20)])
    assert pending(metrics.backlog(overlap, position(spark, 0))) == int(30 * 3.8) + 120
    generic = listing(spark, (), [(0, 10), (1, 20)]).withColumn("stream_type", F.lit("generic"))
    assert pending(metrics.backlog(generic)) == 30


def test_lag(spark):
    rows = [("c0", T0, -1), ("c0", T0 + ONE, -1), ("c0", T0 + 2 * ONE, 4), ("c1", T0, 1)]
    df = spark.createDataFrame(rows, "cluster string, minute timestamp, line_no bigint")
    out = {r.cluster: (r.latest_minute, r.lag_minutes) for r in metrics.directory_lag(df, T0 + 11 * ONE).collect()}
    assert out == {"c0": (T0 + ONE, 10), "c1": (None, -1)}


def log(spark, rows):
    return spark.createDataFrame(rows, "topic string, publisher string, kind string, nanos bigint")


def test_publish_stats_and_verdict(spark):
    good = [("t", "p", k, 5) for k in ("INVOCATION", "SUCCESS")] * 3
    stats = metrics.publish_stats(log(spark, good))
    row = metrics.run_verdict(stats, 3).first()
    assert (row.failed, row.warned, row.reasons) == (False, False, "")
    assert metrics.run_verdict(stats, 4).first().reasons == "unexpected total"
    bad = good + [("u", "p", k, 1) for k in ("INVOCATION", "LOST", "RETRY", "INVOCATION", "EXCEEDED_MSG_SIZE", "REJECT", "INVOCATION")]
    stats = metrics.publish_stats(log(spark, bad))
    u = stats.filter("topic = 'u'").first()
    assert (u.invocations, u.lost, u.retry, u.reject, u.exceeded_size, u.in_flight) == (3, 1, 1, 1, 1, 1)
    row = metrics.run_verdict(stats, 3).first()
    assert row.failed and row.warned and "in flight" in row.reasons
    audit_rows = log(spark, good + [("_audit", "p", "INVOCATION", 1)])
    totals = {(r.topic, r.publisher): r.invocations for r in metrics.publish_totals(audit_rows).collect()}
    assert totals == {("t", "p"): 3, ("t", None): 3, (None, None): 3}


def test_metric_lines(spark, tmp_path):
    stats = spark.createDataFrame([("t", 3, 4)], "topic string, a bigint, b bigint")
    lines = metrics.to_metric_lines(stats, prefix="x.", epoch_sec=9)
    assert sorted(r.line for r in lines.collect()) == ["x.t.a 3 9", "x.t.b 4 9"]
    text = metrics.to_metric_lines(stats, "text")
    assert sorted(tuple(r) for r in text.collect()) == [("context-topic_t", "a:3"), ("context-topic_t", "b:4")]
    metrics.write_metric_lines(text, str(tmp_path / "m"))
    assert spark.read.text(str(tmp_path / "m")).count() == 2
    with pytest.raises(ValueError):
        metrics.to_metric_lines(stats, "xml")


def test_partition_stats_switches(spark):
    rows = [("c0", "k", t, T0 + i * ONE, 0, f"f{i}", None, i == 1) for i, t in enumerate(
        ["local", "local", "collector", "local", "collector"])]
    df = spark.createDataFrame(
        rows * 2,
        "cluster string, collector string, stream_type string, file_minute timestamp, file_id int,"
        " file_name string, minute timestamp, corrupt boolean",
    )
    row = metrics.partition_stats(df).first()
    assert (row.messages_read, row.messages_delivered, row.errors, row.files) == (10, 8, 2, 5)
    assert (row.switches_to_collector, row.switches_to_committed) == (2, 1)
    assert row.last_minute == T0 + 4 * ONE


def arrivals(spark, payloads):
    rows = [(bytearray(p.encode()), 1000 + i) for i, p in enumerate(payloads)]
    return validate.parse_sequence(spark.createDataFrame(rows, "payload binary, arrival_ms bigint"))


CASES = [
    # payloads, producers, top -> duplicates, missing, unexpected, mismatches, corrupt
    (["1/t5/tAA", "2/t5/tAA", "3/t5/tAA"], 1, 3, (0, 0, 0, 0, 0)),
    (["1/t5/tAA", "1/t5/tAA", "2/t5/tAA", "2/t5/tAA"], 2, 2, (0, 0, 0, 0, 0)),
    (["1/t5/tAA", "2/t5/tAA", "2/t5/tAA"], 1, 2, (1, 0, 0, 0, 0)),
    (["1/t5/tAA", "3/t5/tAA"], 1, 3, (0, 1, 0, 0, 0)),
    (["1/t5/tAA", "2/t5/tAA", "2/t5/tAA"], 2, 2, (0, 1, 0, 0, 0)),
    (["1/t5/tAB", "2/t5/tAA"], 1, 2, (0, 0, 0, 1, 0)),
    (["1/t5/tAA", "x/t5/tAA"], 1, 2, (0, 1, 0, 0, 1)),
    (["1/t5/tAA", "2/tx/tAA"], 1, 2, (0, 0, 0, 0, 1)),
    (["1/t5/tAA", "2/t5"], 1, 2, (0, 0, 0, 0, 1)),
    (["1\t5\tAA", ""], 1, 1, (0, 1, 0, 0, 2)),
    (["1/t5/tAA", "9/t5/tAA"], 1, 1, (0, 0, 1, 0, 0)),
]


@pytest.mark.parametrize("payloads, producers, top, want", CASES)
def test_verdicts(spark, payloads, producers, top, want):
    parsed = arrivals(spark, payloads)
    row = validate.validate(parsed, top, producers, "AA", "arrival_ms").first()
    got = (row.duplicates, row.missing, row.unexpected, row.mismatches, row.corrupt)
    assert got == want and row.success == (sum(want) == 0) and row.received == len(payloads)
    assert validate.duplicates(parsed, producers).first().duplicates == want[0]
    assert validate.missing(parsed, top, producers).count() == want[1]


@pytest.mark.parametrize("parts", [1, 3])
def test_missing_as_ranges(spark, parts):
    arrived = [2, 2, 3, 7, 8, 9, 9, 9, 20, 500, 700] * 1 + [None]
    parsed = spark.createDataFrame([(n,) for n in arrived], "seq long").repartition(parts)
    ranges = validate.missing_ranges(parsed, 600, 2).collect()
    got = sorted((n, r.arrivals) for r in ranges for n in range(r["first"], r["last"] + 1))
    want = [(n, arrived.count(n)) for n in range(1, 601) if arrived.count(n) < 2]
    assert got == want
    assert (21, 499, 0) in {tuple(r) for r in ranges}
    assert [tuple(r) for r in validate.missing_ranges(parsed.limit(0), 5, 1).collect()] == [(1, 5, 0)]
    assert validate.missing(parsed, 600, 2).count() == len(want)


def test_latency_counts_first_arrivals(spark):
    parsed = arrivals(spark, ["1/t900/tA", "1/t0/tA", "2/t990/tA", "bad"])
    row = validate.validate(parsed, 2, 1, "A", "arrival_ms").first()
    assert row.mean_latency_ms == ((1000 - 900) + (1002 - 990)) // 4


def test_latency_cuts_groups_before_the_shuffle(spark):
    often = arrivals(spark, ["1/t0/tA", "1/t1/tA", "1/t2/tA"])
    plan = validate.latency(often, 2)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_latency_orders_only_numbers_that_came_too_often(spark):
    rows = [(n, k * 7 % 50, 100 + k * k % 83) for n in range(1, 8) for k in range(n)] + [(None, 1, 9), (1, None, 9)]
    parsed = spark.createDataFrame(rows, "seq long, sent_ms long, arrival_ms long")
    for producers in (1, 3, 7, 9):
        want = 0
        for n in range(1, 8):
            own = sorted((r[2], r[1]) for r in rows if r[0] == n and r[1] is not None)
            want += sum(at - sent for at, sent in own[:producers])
        assert validate.latency(parsed, producers).first()[0] == want
    plan = validate.latency(parsed, 7)._jdf.queryExecution().toString()
    assert "Window" not in plan and "delays" in plan  # sums per number suffice
    assert validate.latency(parsed.limit(0), 1).first()[0] == 0
