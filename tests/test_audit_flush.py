import time
from pathlib import Path

import pytest

from minuteflow.operators import audit
from minuteflow.sources.minutes import read_messages
from minuteflow.streaming import audit_flush
from minuteflow.streaming.audit_flush import close_audit, stop_when_idle, timed_audit_stream
from minuteflow.streaming.sinks import read_packets

SCHEMA = "topic string, ts_ms bigint"
NAMES = ("publisher", "host")


class Flow:
    """A stream of json rows into audit packets."""

    def __init__(self, spark, folder):
        self.spark, self.source = spark, str(folder / "in")
        self.root, self.checkpoint = str(folder / "root"), str(folder / "ck")
        (folder / "root").mkdir()
        self.sent = []

    def add(self, rows):
        self.sent += rows
        frame = self.spark.createDataFrame(rows, SCHEMA).repartition(3)
        frame.write.mode("append").json(self.source)

    def writer(self, flush_sec):
        rows = self.spark.readStream.schema(SCHEMA).json(self.source)
        return timed_audit_stream(
            rows, self.root, "flow", self.checkpoint, *NAMES, flush_sec=flush_sec
        )

    def run(self, flush_sec=3600):
        query = self.writer(flush_sec).trigger(processingTime="100 milliseconds").start()
        stop_when_idle(query, 0.1)

    def close(self):
        close_audit(self.spark, self.root, "flow", self.checkpoint, *NAMES)

    def packets(self):
        return read_packets(read_messages(self.spark, self.root, audit.AUDIT_TOPIC))

    def totals(self):
        return sorted(map(tuple, audit.packet_counts(self.packets()).collect()))

    def wanted(self):
        whole = self.spark.createDataFrame(self.sent, SCHEMA).dropna()
        return sorted(map(tuple, audit.audit_counts(whole).collect()))


@pytest.fixture
def flow(spark, tmp_path):
    return Flow(spark, tmp_path)


def rows_of(n):
    return [("hot" if i % 3 else f"t{i % 4}", 20_000 * (i % 7)) for i in range(n)]


def test_last_packets_and_going_on(flow):
    flow.add(rows_of(50) + [(None, 5), ("t1", None)])
    flow.run()
    assert flow.totals() == []  # no period has passed
    flow.close()
    assert flow.totals() == flow.wanted()
    flow.close()
    assert flow.totals() == flow.wanted()
    # Going on within the same period sends only what is new.
    flow.add(rows_of(31))
    flow.run()
    flow.close()
    assert flow.totals() == flow.wanted()


def test_one_packet_a_topic_and_period(flow):
    for n in range(3):
        flow.add([("a", 60_000 * n), ("a", 0), ("b", 0)])
        flow.run()
    flow.close()
    assert sorted(p.topic for p in flow.packets().collect()) == ["a", "b"]
    assert flow.totals() == flow.wanted()


def test_timer_without_messages(flow):
    flow.add(rows_of(20))
    flow.run(flush_sec=3)
    flow.close()  # the period goes on, and what it sends later leaves this out
    flow.add(rows_of(7))
    query = flow.writer(flush_sec=3).trigger(processingTime="500 milliseconds").start()
    try:
        until = time.monotonic() + 60
        while flow.totals() != flow.wanted() and time.monotonic() < until:
            assert query.exception() is None
            time.sleep(0.5)
        assert flow.totals() == flow.wanted()
    finally:
        query.stop()
    flow.close()
    assert flow.totals() == flow.wanted()


def test_broken_closing_is_made_up_for(flow, monkeypatch):
    flow.add(rows_of(20))
    flow.run()

    def fail(*args):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(audit_flush, "_publish_closing", fail)
        with pytest.raises(OSError):
            flow.close()
    flow.add(rows_of(9))
    flow.run()
    flow.close()
    assert flow.totals() == flow.wanted()


def test_stopped_after_a_flush(flow, monkeypatch):
    """The batch that flushed is not committed: closing sends its packets, once."""
    flow.add(rows_of(20))
    flow.run()

    def fail(*args):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(audit_flush, "_publish_flush", fail)
        flow.add(rows_of(5))
        query = flow.writer(0).trigger(processingTime="100 milliseconds").start()
        with pytest.raises(Exception, match="lost"):
            query.awaitTermination(60)
    flow.close()
    with pytest.raises(ValueError):
        flow.writer(3600)
    flow.run(flush_sec=0)
    flow.close()
    assert flow.totals() == flow.wanted()


def test_another_period_after_an_idle_batch(flow):
    """A batch that was stopped before it flushed anything may run again with another period."""
    flow.add(rows_of(20))
    flow.run()
    commits = Path(flow.checkpoint, "commits")
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        (commits / name).unlink(missing_ok=True)
    flow.add(rows_of(5))
    flow.run(flush_sec=0)
    flow.close()
    assert flow.totals() == flow.wanted()


def test_closing_before_any_batch(flow):
    flow.close()
    flow.add(rows_of(1))
    flow.run()
    flow.close()
    assert flow.totals() == flow.wanted()
