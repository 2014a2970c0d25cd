"""Audit packets by time: counts are kept per topic and sent once a flush period has passed."""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from minuteflow.operators import audit
from minuteflow.sources import storage
from minuteflow.sources.publish import publish
from minuteflow.streaming.sinks import packet_lines

DEFAULT_FLUSH_SEC = 60

_COUNTS = "topic string, window_ms bigint, received bigint"
_STATE = "windows array<bigint>, counts array<bigint>, since bigint"
_FLUSHED = "topic string, since bigint, window_ms bigint, received bigint"
_TABLES_AT_ONCE = 64


def _add_up(tables: list[pa.Table]) -> list[pa.Table]:
    whole = pa.concat_tables(tables).group_by(["topic", "window_ms"])
    summed = whole.aggregate([("received", "sum")])
    return [summed.rename_columns(["topic", "window_ms", "received"])]


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per topic and window of a task, so a hot topic is small before it is dealt."""
    tables: list[pa.Table] = []
    for batch in batches:
        counts = pa.Table.from_batches([batch]).group_by(["topic", "window_ms"])
        counts = counts.aggregate([([], "count_all")])
        tables.append(counts.rename_columns(["topic", "window_ms", "received"]))
        if len(tables) == _TABLES_AT_ONCE:
            tables = _add_up(tables)
    if tables:
        yield from _add_up(tables)[0].to_batches()


def _keeper(flush_ms: int):
    def keep(
        key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        windows, counts, since = state.get if state.exists else ([], [], now)
        kept = dict(zip(windows, counts))
        if not state.hasTimedOut:
            for frame in frames:
                for window, n in zip(frame["window_ms"], frame["received"]):
                    kept[int(window)] = kept.get(int(window), 0) + int(n)
        left = since + flush_ms - now
        if state.hasTimedOut or left <= 0:
            if state.exists:
                state.remove()
            rows = {"topic": key[0], "since": since}
            yield pd.DataFrame({"window_ms": list(kept), "received": list(kept.values())}).assign(
                **rows
            )[["topic", "since", "window_ms", "received"]]
            return
        state.update((list(kept), list(kept.values()), since))
        # Each call sets the timer anew, so it is set to what is left of the period.
        state.setTimeoutDuration(left)

    return keep


def timed_audit_stream(
    df: DataFrame,
    root: str,
    query: str,
    checkpoint: str,
    tier: str,
    hostname: str,
    flush_sec: int = DEFAULT_FLUSH_SEC,
    window_sec: int = audit.DEFAULT_WINDOW_SEC,
    ts_ms: str = "ts_ms",
    **kwargs,
) -> DataStreamWriter:
    """A writer that publishes one audit packet per topic and flush period to ``_audit``.

    The period of a topic begins with its first message after a packet, whatever the
    trigger; without messages there is no packet. A batch counts messages per task first, then
    the state of each topic, a count per window, adds them up. Rows without a topic or a
    time are not counted. Run it with a processing-time trigger (see :func:`stop_when_idle`), and
    after it has been stopped call :func:`close_audit` for the counts that wait for their
    period to end. What is flushed is written beside the checkpoint before it is published.
    """
    spark = df.sparkSession
    checkpoint = storage.qualify(spark, checkpoint)
    window = audit.window_start(F.col(ts_ms).cast("long"), window_sec).alias("window_ms")
    rows = df.select(F.col("topic").cast("string").alias("topic"), window)
    counted = rows.dropna().mapInArrow(_count_task, _COUNTS)
    flushed = counted.groupBy("topic").applyInPandasWithState(
        _keeper(flush_sec * 1000), _FLUSHED, _STATE, "append", GroupStateTimeout.ProcessingTimeTimeout
    )
    send = _sender(root, tier, hostname, window_sec, kwargs)

    def write(batch: DataFrame, batch_id: int) -> None:
        # All of it is made once: a part of a batch would leave states behind.
        batch = batch.persist()
        try:
            if batch.count():
                path = f"{checkpoint}/audit_flushed/{batch_id}"
                if not storage.exists(f"{path}/_SUCCESS"):
                    batch.write.mode("overwrite").parquet(path)
                _publish_flush(batch.sparkSession, checkpoint, query, batch_id, send)
                for number in _numbers(f"{checkpoint}/audit_flushed"):
                    if number < batch_id:  # committed, so never asked for again
                        storage.delete_dir(f"{checkpoint}/audit_flushed/{number}")
        finally:
            batch.unpersist()

    _keep_period(checkpoint, flush_sec)
    for number in _done(checkpoint, "audit_closed")[-1:]:
        _publish_closing(spark, checkpoint, query, number, send)
    writer = flushed.writeStream.queryName(query).foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint)


def stop_when_idle(query: StreamingQuery, poll_sec: float = 0.5) -> None:
    """Stop a query after the first batch without new rows, other than one an earlier run had begun.

    Timers need batches without rows too, so neither ``availableNow`` nor
    ``processAllAvailable`` ever ends on a stream that has them.
    """
    first = None
    while query.isActive:
        progress = query.lastProgress
        if progress:
            # The first batch may be one that was stopped, so it may lack rows that wait by now.
            first = query.recentProgress[0]["batchId"] if first is None else first
            if progress["numInputRows"] == 0 and progress["batchId"] > first:
                break
        time.sleep(poll_sec)
    if query.exception() is not None:
        raise query.exception()
    query.stop()


def close_audit(
    spark: SparkSession,
    root: str,
    query: str,
    checkpoint: str,
    tier: str,
    hostname: str,
    window_sec: int = audit.DEFAULT_WINDOW_SEC,
    **kwargs,
) -> None:
    """Publish the counts that a stopped stream still holds, as its last packets.

    What was sent is written beside the checkpoint first. Should the stream be started
    again, its next packets leave that out, and a closing that was broken off is
    published. So neither closing twice nor going on counts anything twice.
    """
    checkpoint = storage.qualify(spark, checkpoint)
    last = max(_numbers(f"{checkpoint}/commits"), default=None)
    if last is None:
        return
    held = spark.read.format("statestore").option("batchId", last).load(checkpoint)
    kept = F.col("value.groupState")
    zipped = F.zip_with(
        kept["windows"], kept["counts"], lambda w, n: F.struct(w.alias("w"), n.alias("n"))
    )
    pair = F.explode(zipped)
    counts = held.select(
        F.col("key.topic").alias("topic"), kept["since"].alias("since"), pair.alias("pair")
    ).select("topic", "since", F.col("pair.w").alias("window_ms"), F.col("pair.n").alias("received"))
    send = _sender(root, tier, hostname, window_sec, kwargs)
    sent = [_closed(spark, checkpoint, before=last)]
    if last + 1 in _done(checkpoint, "audit_flushed"):
        # The stream was stopped in a batch that had flushed: it counts as sent, and is.
        _publish_flush(spark, checkpoint, query, last + 1, send)
        sent.append(_stored(spark, checkpoint, "audit_flushed", [last + 1]))
    sent = [frame for frame in sent if frame is not None]
    rest = _without(counts, reduce(DataFrame.unionByName, sent) if sent else None)
    rest.write.mode("overwrite").parquet(f"{checkpoint}/audit_closed/{last}")
    _publish_closing(spark, checkpoint, query, last, send)


def _sender(root: str, tier: str, hostname: str, window_sec: int, kwargs: dict):
    def send(counts: DataFrame, tag: str) -> None:
        totals = counts.groupBy("topic", "window_ms").agg(F.sum("received").alias("received"))
        lines = packet_lines(totals, tier, hostname, window_sec)
        done = publish(lines, root, tag=tag, **kwargs)
        if done.rejected:
            raise ValueError(f"{done.rejected} audit packets are larger than a message may be")

    return send


def _without(counts: DataFrame, closed: DataFrame | None) -> DataFrame:
    """Counts less what closings have sent of the same periods."""
    if closed is None:
        return counts
    periods = counts.select("topic", "since").distinct()
    sent = closed.join(periods, ["topic", "since"], "left_semi")
    both = counts.unionByName(sent.withColumn("received", -F.col("received")))
    left = both.groupBy("topic", "since", "window_ms").agg(F.sum("received").alias("received"))
    return left.filter("received > 0")


def _numbers(folder: str) -> list[int]:
    return sorted(int(e.base_name) for e in storage.children(folder) if e.base_name.isdigit())


def _keep_period(checkpoint: str, flush_sec: int) -> None:
    """Refuse another period while a batch that has flushed waits to run again: it has to flush the same."""
    path = f"{checkpoint}/audit_flush_sec"
    begun = _numbers(f"{checkpoint}/offsets")[-1:]
    pending = begun > _numbers(f"{checkpoint}/commits")[-1:]
    flushed = pending and begun[0] in _done(checkpoint, "audit_flushed")
    if flushed and storage.exists(path) and int(storage.read_text(path)) != flush_sec:
        raise ValueError(f"a batch is pending; start with {storage.read_text(path)} seconds first")
    storage.write_text(path, str(flush_sec))


def _done(checkpoint: str, kind: str) -> list[int]:
    """Batches of which all rows of a kind are written."""
    folder = f"{checkpoint}/{kind}"
    return [n for n in _numbers(folder) if storage.exists(f"{folder}/{n}/_SUCCESS")]


def _stored(spark: SparkSession, checkpoint: str, kind: str, numbers: list[int]) -> DataFrame:
    return spark.read.schema(_FLUSHED).parquet(*[f"{checkpoint}/{kind}/{n}" for n in numbers])


def _closed(spark: SparkSession, checkpoint: str, before: int | None = None) -> DataFrame | None:
    numbers = _done(checkpoint, "audit_closed")
    numbers = [n for n in numbers if before is None or n < before]
    return _stored(spark, checkpoint, "audit_closed", numbers) if numbers else None


def _publish_flush(spark: SparkSession, checkpoint: str, query: str, number: int, send) -> None:
    """Publish what a batch flushed, less what closings sent of it; once, by its tag."""
    rows = _stored(spark, checkpoint, "audit_flushed", [number])
    closed = _closed(spark, checkpoint, before=number)
    send(_without(rows, closed), f"{query}-{_run(checkpoint)}-{number:010d}")


def _publish_closing(spark: SparkSession, checkpoint: str, query: str, number: int, send) -> None:
    """Publish what a closing wrote; its tag makes a second time do nothing."""
    rows = _stored(spark, checkpoint, "audit_closed", [number])
    send(rows, f"{query}-{_run(checkpoint)}-closed-{number:010d}")


def _run(checkpoint: str) -> str:
    return json.loads(storage.read_text(f"{checkpoint}/metadata"))["id"]
