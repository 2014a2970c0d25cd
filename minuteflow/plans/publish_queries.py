"""Queries over publishing: topics, checks, sizes, routing and payloads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from minuteflow.functions import codec
from minuteflow.operators import audit, metrics
from minuteflow.plans import tables
from minuteflow.plans.registry import MESSAGES_SQL, query
from minuteflow.session import work_dir
from minuteflow.sources import oplog
from minuteflow.sources import publish as sink
from minuteflow.sources.minutes import read_messages
from minuteflow.streaming.audit_flush import close_audit, stop_when_idle, timed_audit_stream
from minuteflow.streaming.sinks import audit_stream, publish_stream, read_packets, windowed_counts

TOPICS = ["click", "error", "purchase", "signup", "view"]
STREAM_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
    " props string"
)


def _read_topics(spark, root, topics) -> DataFrame:
    frames = [read_messages(spark, root, topic) for topic in topics]
    return reduce(DataFrame.unionByName, frames)


def published_counts(spark, sf_dir) -> DataFrame:
    """Publish all events with audit headers, read them back and count per minute."""
    root = work_dir(spark, "flagship")
    rows = tables.events(spark, sf_dir)
    sink.publish(
        rows, root, minute=tables.block_minute(F.col("ts")), audit_ts="ts_ms",
        order_by=("event_id",),
    )
    return audit.audit_counts(_read_topics(spark, root, TOPICS), ts_ms="audit_ts")


@query(
    "flagship_publish_read_count",
    f"""SELECT topic, ts_ms - ts_ms % 60000 AS window_ms, count(*) AS received
        FROM {MESSAGES_SQL} GROUP BY ALL""",
)
def flagship(spark, sf_dir):
    return published_counts(spark, sf_dir)


@query(
    "k1_publish_topics",
    f"SELECT topic, event_id, props, ts_ms AS audit_ts FROM {MESSAGES_SQL}",
)
def k1_publish_topics(spark, sf_dir):
    """Publish to five topics and read every message back."""
    root = work_dir(spark, "topics")
    rows = tables.events(spark, sf_dir)
    sink.publish(rows, root, minute=tables.block_minute(F.col("ts")), audit_ts="ts_ms")
    read = tables.message_fields(_read_topics(spark, root, TOPICS))
    return read.select("topic", "event_id", "props", "audit_ts")


def _event_stream(spark, sf_dir) -> DataFrame:
    """The events table as a stream of messages."""
    reader = spark.readStream.schema(STREAM_SCHEMA).option("pathGlobFilter", "events.parquet")
    ts = F.col("ts").cast("timestamp")
    return reader.parquet(sf_dir).select(
        F.col("event_type").alias("topic"),
        ts.alias("ts"),
        F.unix_millis(ts).alias("ts_ms"),
        F.concat_ws("|", "event_id", "user_id", "props").cast("binary").alias("payload"),
    )


def _drain(writer, spark, name: str) -> None:
    writer = writer.option("checkpointLocation", work_dir(spark, name))
    writer.trigger(availableNow=True).start().awaitTermination()


@query(
    "k2_publish_stream",
    f"""SELECT topic, event_id, ts_ms AS audit_ts
        FROM {MESSAGES_SQL}, (SELECT unnest([1, 2]) AS stream)""",
)
def k2_publish_stream(spark, sf_dir):
    """Publish two streams of one name; starting the first again adds nothing."""
    root = work_dir(spark, "streamed")
    stream = _event_stream(spark, sf_dir)
    first, second = work_dir(spark, "first"), work_dir(spark, "second")
    for checkpoint in (first, first, second):
        writer = publish_stream(stream, root, "events", audit_ts="ts_ms")
        writer = writer.option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()
    read = tables.message_fields(_read_topics(spark, root, TOPICS))
    return read.select("topic", "event_id", "audit_ts")


@query(
    "k3_input_checks",
    """SELECT CASE WHEN event_type = 'error' THEN 'NULL_TOPIC' WHEN value < 1 THEN 'NULL_MESSAGE'
       END AS reason, count(*) AS messages FROM events GROUP BY ALL""",
)
def k3_input_checks(spark, sf_dir):
    rows = tables.table(spark, sf_dir, "events").select(
        F.nullif("event_type", F.lit("error")).alias("topic"),
        F.when(F.col("value") >= 1, F.col("props").cast("binary")).alias("payload"),
    )
    return sink.check_messages(rows).groupBy("reason").agg(F.count(F.lit(1)).alias("messages"))


@query(
    "k4_size_guard",
    """SELECT doc_id, CAST(octet_length(encode(text)) + 16 AS BIGINT) AS size,
       CASE WHEN octet_length(encode(text)) + 16 > 8192 THEN 'EXCEEDED_MSG_SIZE' END AS outcome,
       octet_length(encode(text)) + 16 > 51200 AS over_default FROM documents""",
)
def k4_size_guard(spark, sf_dir):
    """Sizes with the audit header, at a small limit and at the default one."""
    docs = codec.to_payload(tables.table(spark, sf_dir, "documents"), "text")
    docs = codec.attach_header(docs.withColumn("ms", F.lit(1704067200000)), "ms")
    both = sink.size_guard(docs).withColumn("over_default", F.col("outcome").isNotNull())
    return sink.size_guard(both, 8192).select(
        "doc_id", F.octet_length("payload").cast("long").alias("size"), "outcome", "over_default"
    )


@query(
    "m5_published_log",
    """SELECT topic, CAST(count(*) AS BIGINT) AS invocations,
       CAST(count(*) FILTER (NOT over) AS BIGINT) AS success,
       CAST(count(*) FILTER (over) AS BIGINT) AS exceeded_size,
       CAST(count(*) FILTER (over) AS BIGINT) AS in_flight
       FROM (SELECT source AS topic, octet_length(encode(text)) + 16 > 8192 AS over FROM documents
             WHERE source IS NOT NULL AND text IS NOT NULL AND doc_id % 7 <> 0) GROUP BY topic""",
)
def m5_published_log(spark, sf_dir):
    """Statistics from the log that two publishes left, with null and oversized messages among them;
    a third with the tag of the second adds nothing.
    """
    root = work_dir(spark, "logged")
    docs = tables.table(spark, sf_dir, "documents").select(
        F.col("source").alias("topic"),
        F.when(F.col("doc_id") % 7 != 0, F.col("text").cast("binary")).alias("payload"),
        F.lit(1704067200000).alias("ms"),
        (F.col("doc_id") % 2 == 0).alias("even"),
    )
    for even, tag in ((True, "even"), (False, "odd"), (False, "odd")):
        sink.publish(
            docs.filter(F.col("even") == even), root, audit_ts="ms", max_size=8192,
            minute=F.lit("2024-01-01").cast("timestamp"), tag=tag, publisher="pages",
        )
    stats = metrics.publish_stats(oplog.published_log(spark, root))
    return stats.select("topic", "invocations", "success", "exceeded_size", "in_flight")


@query(
    "k5_route",
    """SELECT CASE event_type WHEN 'click' THEN 'click' || (user_id % 2)
                              WHEN 'view' THEN 'view' || (user_id % 3) ELSE event_type END AS topic,
       count(*) AS messages, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY ALL""",
)
def k5_route(spark, sf_dir):
    """Spread two logical topics over physical ones; others keep their name."""
    rule = {
        "click": F.concat(F.lit("click"), F.col("user_id") % 2),
        "view": F.concat(F.lit("view"), F.col("user_id") % 3),
    }
    routed = sink.route(tables.events(spark, sf_dir), rule)
    return routed.groupBy("topic").agg(
        F.count(F.lit(1)).alias("messages"), F.sum("event_id").alias("ids")
    )


@query(
    "k6_publish_text",
    """SELECT props AS line, count(*) AS messages FROM events GROUP BY ALL""",
)
def k6_publish_text(spark, sf_dir):
    """Publish the lines of text files."""
    text, root = work_dir(spark, "text"), work_dir(spark, "published_text")
    tables.table(spark, sf_dir, "events").select("props").write.text(text)
    sink.publish_text(spark, text, "lines", root)
    read = read_messages(spark, root, "lines")
    line = F.col("payload").cast("string").alias("line")
    return read.groupBy(line).agg(F.count(F.lit(1)).alias("messages"))


@query(
    "k7_payload",
    """SELECT o_orderkey, o_orderpriority AS text_payload,
       '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"' ||
       o_orderstatus || '"}' AS json_payload FROM orders""",
)
def k7_payload(spark, sf_dir):
    """A string column and a structured row as payload bytes."""
    orders = tables.table(spark, sf_dir, "orders")
    both = codec.to_payload(orders, "o_orderpriority", "t")
    both = codec.to_payload(both, ["o_orderkey", "o_custkey", "o_orderstatus"], "j")
    return both.select(
        "o_orderkey",
        F.col("t").cast("string").alias("text_payload"),
        F.col("j").cast("string").alias("json_payload"),
    )


@query(
    "a7_audit_stream",
    f"""SELECT topic, ts_ms - ts_ms % 60000 AS window_ms, count(*) AS received
        FROM {MESSAGES_SQL} GROUP BY ALL""",
)
def a7_audit_stream(spark, sf_dir):
    """Audit packets of a stream, published to the audit topic and added up again."""
    root = work_dir(spark, "audited")
    stream = _event_stream(spark, sf_dir)
    _drain(audit_stream(stream, root, "audit", "publisher", "host0"), spark, "audit")
    packets = read_packets(read_messages(spark, root, audit.AUDIT_TOPIC))
    return audit.packet_counts(packets)


@query(
    "a7_timed_flush",
    f"""SELECT topic, ts_ms - ts_ms % 60000 AS window_ms, count(*) AS received
        FROM {MESSAGES_SQL} GROUP BY ALL""",
)
def a7_timed_flush(spark, sf_dir):
    """Packets by time of a stream that is stopped, closed, gone on with and closed again."""
    root, checkpoint = work_dir(spark, "timed"), work_dir(spark, "timed_checkpoint")
    whole = spark.read.parquet(f"{sf_dir}/events.parquet")
    source = work_dir(spark, "timed_source")
    early = F.col("event_id") % 2 == 0
    for part in (whole.filter(early), whole.filter(~early)):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(part.schema).parquet(source).select(
            F.col("event_type").alias("topic"),
            F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
        )
        writer = timed_audit_stream(stream, root, "timed", checkpoint, "publisher", "host0")
        stop_when_idle(writer.trigger(processingTime="1 second").start())
        close_audit(spark, root, "timed", checkpoint, "publisher", "host0")
    packets = read_packets(read_messages(spark, root, audit.AUDIT_TOPIC))
    return audit.packet_counts(packets)


@query(
    "a7_windowed_stream",
    f"""SELECT topic, ts_ms - ts_ms % 86400000 AS window_ms, count(*) AS received
        FROM {MESSAGES_SQL}
        WHERE ts_ms - ts_ms % 86400000 + 86400000
              <= (SELECT max(ts_ms) - 3600000 FROM {MESSAGES_SQL}) GROUP BY ALL""",
)
def a7_windowed_stream(spark, sf_dir):
    """Final counts of the day windows that the watermark has closed."""
    out = work_dir(spark, "windowed")
    counts = windowed_counts(_event_stream(spark, sf_dir), "1 hour", window_sec=86400)
    writer = counts.writeStream.outputMode("append").format("parquet").option("path", out)
    _drain(writer, spark, "windowed_checkpoint")
    return spark.read.parquet(out)
