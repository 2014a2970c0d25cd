"""Streaming publish and the audit stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from minuteflow.operators import audit
from minuteflow.sources.publish import publish


def publish_stream(df: DataFrame, root: str, query: str, **kwargs) -> DataStreamWriter:
    """A writer that publishes every micro-batch.

    The tag of a commit is the id of the streaming query, which its checkpoint
    keeps, and the batch id. A batch that runs again after a failure repeats the
    same renames or does nothing, so each is stored once; another query or a new
    checkpoint adds its own rows, whatever its name.
    Set ``checkpointLocation`` and a trigger, then start it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        publish(batch, root, tag=_tag(batch, query, batch_id), **kwargs)

    return df.writeStream.queryName(query).foreachBatch(write)


def _tag(batch: DataFrame, query: str, batch_id: int) -> str:
    # Spark sets the property for the thread that runs a stream's batches.
    run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not run:
        raise RuntimeError("a batch outside a streaming query has no id to be stored under")
    return f"{query}-{run}-{batch_id:010d}"


def audit_stream(
    df: DataFrame,
    root: str,
    query: str,
    tier: str,
    hostname: str,
    window_sec: int = audit.DEFAULT_WINDOW_SEC,
    ts_ms: str = "ts_ms",
    **kwargs,
) -> DataStreamWriter:
    """A writer that publishes audit packets of each micro-batch to ``_audit``.

    Counters cover one flush, so the trigger interval is the flush period and a
    late message just opens its window again; readers add the packets up. No
    state is kept between batches.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = audit.audit_counts(batch, window_sec, ts_ms=ts_ms)
        lines = packet_lines(counts, tier, hostname, window_sec)
        done = publish(lines, root, tag=_tag(batch, query, batch_id), **kwargs)
        if done.rejected:
            raise ValueError(f"{done.rejected} audit packets are larger than a message may be")

    return df.writeStream.queryName(query).foreachBatch(write)


def packet_lines(
    counts: DataFrame, tier: str, hostname: str, window_sec: int = audit.DEFAULT_WINDOW_SEC
) -> DataFrame:
    """Counts per topic and window as messages of the audit topic."""
    packets = audit.audit_packets(counts, tier, hostname, _now_ms(), window_sec)
    return packets.select(
        F.lit(audit.AUDIT_TOPIC).alias("topic"),
        F.to_json(F.struct("*")).cast("binary").alias("payload"),
    )


def _now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


# JSON keys are strings; the windows become numbers again after parsing.
PACKET_SCHEMA = (
    "timestamp bigint, topic string, tier string, hostname string, window_size int,"
    " received map<string,bigint>, sent map<string,bigint>, filenames array<string>,"
    " tags map<string,string>"
)


def read_packets(messages: DataFrame) -> DataFrame:
    """Audit packets from the messages of the ``_audit`` topic."""
    packet = F.from_json(F.col("payload").cast("string"), PACKET_SCHEMA)
    packets = messages.select(packet.alias("packet")).select("packet.*")
    return packets.withColumns(
        {
            name: F.transform_keys(name, lambda key, _: key.cast("bigint"))
            for name in ("received", "sent")
        }
    )


def windowed_counts(df: DataFrame, delay: str, window_sec: int = 60, ts: str = "ts") -> DataFrame:
    """Final counts per topic and window of a stream, once the watermark passes."""
    window = F.window(ts, f"{window_sec} seconds")
    counts = df.withWatermark(ts, delay).groupBy("topic", window).agg(F.count("*").alias("received"))
    return counts.select(
        "topic", F.unix_millis("window.start").alias("window_ms"), "received"
    )
