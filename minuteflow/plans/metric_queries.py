"""Queries over backlog, lag, statistics, verdicts and metric lines."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from minuteflow.operators import checkpoint as cp
from minuteflow.operators import metrics
from minuteflow.plans import tables
from minuteflow.plans.position_queries import CHECKPOINT_SQL, MINUTE, _whole_checkpoint
from minuteflow.plans.registry import LOG_SQL, MESSAGES_SQL, query
from minuteflow.sources.collectors import read_stitched
from minuteflow.sources.minutes import decode_messages

COUNTERS_SQL = """count(*) FILTER (kind = 'INVOCATION') AS invocations,
  count(*) FILTER (kind = 'SUCCESS') AS success,
  count(*) FILTER (kind = 'UNHANDLED_FAILURE') AS unhandled,
  count(*) FILTER (kind = 'GRACEFUL_FAILURE') AS graceful,
  count(*) FILTER (kind = 'LOST') AS lost, count(*) FILTER (kind = 'RETRY') AS retry,
  count(*) FILTER (kind = 'REJECT') AS reject, count(*) FILTER (kind = 'RECONNECT') AS reconnects,
  count(*) FILTER (kind = 'EXCEEDED_MSG_SIZE') AS exceeded_size,
  CAST(sum(nanos) AS BIGINT) AS cumulative_nanos"""

STATS_SQL = f"""(
  SELECT *, invocations - (success + lost + graceful + reject) AS in_flight
  FROM (SELECT topic, {COUNTERS_SQL} FROM {LOG_SQL} GROUP BY topic))"""


def _file_sizes(spark, sf_dir) -> DataFrame:
    """A listing: each collector's bytes per hour, the older half already committed."""
    hour = F.date_trunc("hour", "ts")
    sizes = tables.events(spark, sf_dir).groupBy(
        "cluster", "collector", hour.alias("file_minute")
    ).agg(F.sum(F.octet_length("payload")).alias("length"))
    committed = F.col("file_minute") < F.lit("2024-01-16").cast("timestamp")
    return sizes.select(
        F.when(committed, "local").otherwise("collector").alias("stream_type"),
        "cluster", "collector",
        F.when(committed, F.col("file_minute") + F.expr("interval 1 minute")).alias("minute"),
        "file_minute", F.lit(0).alias("file_id"), "length",
    )


SIZES_SQL = f"""(
  SELECT cluster, collector, date_trunc('hour', ts) AS file_minute,
         CAST(sum(octet_length(encode(payload))) AS BIGINT) AS length,
         date_trunc('hour', ts) < TIMESTAMP '2024-01-16' AS committed
  FROM {MESSAGES_SQL} GROUP BY ALL)"""


def _marks(spark, sf_dir, until: str) -> DataFrame:
    """Positions in the hourly files of the listing."""
    rows = tables.events(spark, sf_dir).filter(F.col("ts") < F.lit(until).cast("timestamp"))
    rows = rows.withColumns(
        {"file_minute": F.date_trunc("hour", "ts"), "file_id": F.lit(0), "line_no": F.col("event_id")}
    )
    return cp.build_checkpoint(rows, "collector")


@query(
    "m1_backlog_committed",
    f"""WITH cur AS (SELECT cluster, collector, date_trunc('hour', max(ts)) AS at
          FROM {MESSAGES_SQL} WHERE ts < TIMESTAMP '2024-01-08' GROUP BY ALL),
        s AS (SELECT f.*, cur.at FROM {SIZES_SQL} f JOIN cur USING (cluster, collector)
              WHERE f.file_minute >= cur.at)
        SELECT cluster, collector, plain_bytes, committed_bytes,
          plain_bytes + CAST(trunc(CAST(committed_bytes AS DOUBLE) * 3.8) AS BIGINT) AS pending_bytes
        FROM (SELECT cluster, collector,
          CAST(coalesce(sum(length) FILTER (NOT committed), 0) AS BIGINT) AS plain_bytes,
          CAST(coalesce(sum(length) FILTER (committed), 0) AS BIGINT) AS committed_bytes
          FROM s GROUP BY ALL)""",
)
def m1_backlog_committed(spark, sf_dir):
    """Readers stand in committed files."""
    return metrics.backlog(_file_sizes(spark, sf_dir), _marks(spark, sf_dir, "2024-01-08"))


@query(
    "m1_backlog_in_flight",
    f"""WITH cur AS (SELECT cluster, collector, date_trunc('hour', max(ts)) AS at
          FROM {MESSAGES_SQL} WHERE ts < TIMESTAMP '2024-01-24' GROUP BY ALL)
        SELECT f.cluster, f.collector, CAST(sum(length) AS BIGINT) AS plain_bytes,
          CAST(0 AS BIGINT) AS committed_bytes, CAST(sum(length) AS BIGINT) AS pending_bytes
        FROM {SIZES_SQL} f JOIN cur USING (cluster, collector)
        WHERE f.file_minute >= cur.at GROUP BY ALL""",
)
def m1_backlog_in_flight(spark, sf_dir):
    """Readers stand in collector files."""
    return metrics.backlog(_file_sizes(spark, sf_dir), _marks(spark, sf_dir, "2024-01-24"))


@query(
    "m2_directory_lag",
    f"""SELECT cluster, strftime(max(minute) FILTER (line_no = -1), '%Y-%m-%d %H:%M')
          AS latest_minute,
        coalesce(date_diff('minute', max(minute) FILTER (line_no = -1),
                 TIMESTAMP '2024-01-31 12:00:00'), -1) AS lag_minutes
        FROM {CHECKPOINT_SQL} GROUP BY cluster""",
)
def m2_directory_lag(spark, sf_dir):
    lag = metrics.directory_lag(_whole_checkpoint(spark, sf_dir), datetime(2024, 1, 31, 12))
    return lag.select(
        "cluster", F.date_format("latest_minute", MINUTE).alias("latest_minute"), "lag_minutes"
    )


@query(
    "m3_consumer_stats",
    """SELECT 't' || (user_id % 3) AS topic, 'consumer' || (user_id % 5) AS consumer,
       count(*) FILTER (event_type IN ('click', 'view')) AS messages_consumed,
       count(*) FILTER (event_type = 'purchase') AS mark_calls,
       count(*) FILTER (event_type = 'signup') AS reset_calls,
       count(*) FILTER (event_type = 'error') AS timeouts FROM events GROUP BY ALL""",
)
def m3_consumer_stats(spark, sf_dir):
    kind = (
        F.when(F.col("event_type") == "purchase", "MARK")
        .when(F.col("event_type") == "signup", "RESET")
        .when(F.col("event_type") == "error", "TIMEOUT")
        .otherwise("MESSAGE")
    )
    log = tables.table(spark, sf_dir, "events").select(
        F.concat(F.lit("t"), F.col("user_id") % 3).alias("topic"),
        F.concat(F.lit("consumer"), F.col("user_id") % 5).alias("consumer"),
        kind.alias("kind"),
    )
    return metrics.consumer_stats(log)


@query(
    "m4_partition_stats",
    f"""SELECT cluster, collector, count(*) AS messages_read, count(*) AS messages_delivered,
        CAST(0 AS BIGINT) AS errors, CAST(CASE WHEN bool_or(minute(block) < 4)
        AND bool_or(minute(block) >= 4) THEN 1 ELSE 0 END AS BIGINT) AS switches_to_collector,
        CAST(0 AS BIGINT) AS switches_to_committed
        FROM (SELECT * REPLACE ('c0' AS cluster) FROM {MESSAGES_SQL}) GROUP BY ALL""",
)
def m4_partition_stats(spark, sf_dir):
    """Statistics of a stitched read: each collector moves once from committed to in flight."""
    rows = decode_messages(read_stitched(spark, tables.stitched_root(spark, sf_dir), tables.TOPIC))
    return metrics.partition_stats(rows).drop("files", "last_minute")


@query("m5_publish_stats", f"SELECT * FROM {STATS_SQL}")
def m5_publish_stats(spark, sf_dir):
    return metrics.publish_stats(tables.publish_log(spark, sf_dir))


@query("m6_in_flight", f"SELECT topic, invocations, in_flight FROM {STATS_SQL}")
def m6_in_flight(spark, sf_dir):
    stats = metrics.publish_stats(tables.publish_log(spark, sf_dir))
    return stats.select("topic", "invocations", "in_flight")


@query(
    "m7_publish_totals",
    f"""SELECT *, invocations - (success + lost + graceful + reject) AS in_flight
        FROM (SELECT topic, publisher, CAST(grouping_id(topic, publisher) AS INTEGER) AS level,
              {COUNTERS_SQL} FROM {LOG_SQL} WHERE topic <> '_audit'
              GROUP BY ROLLUP (topic, publisher))""",
)
def m7_publish_totals(spark, sf_dir):
    return metrics.publish_totals(tables.publish_log(spark, sf_dir))


@query(
    "m8_run_verdict",
    f"""SELECT CAST(sum(invocations) AS BIGINT) AS invocations,
        CAST(sum(success) AS BIGINT) AS success,
        concat_ws('; ',
          CASE WHEN sum(success) <> (SELECT count(*) FROM events) THEN 'unexpected total' END,
          CASE WHEN sum(invocations) <> sum(success) THEN 'invocations differ from success' END,
          CASE WHEN NOT bool_and(invocations = success)
               THEN 'invocations differ from success in a topic' END,
          CASE WHEN NOT bool_and(in_flight = 0) THEN 'messages in flight' END) AS reasons,
        sum(success) <> (SELECT count(*) FROM events) OR sum(invocations) <> sum(success)
          OR NOT bool_and(invocations = success) OR NOT bool_and(in_flight = 0) AS failed,
        sum(graceful) <> 0 OR sum(lost) <> 0 OR sum(reconnects) <> 0 OR sum(retry) <> 0
          OR sum(unhandled) <> 0 AS warned FROM {STATS_SQL}""",
)
def m8_run_verdict(spark, sf_dir):
    """The run lost messages, so it fails with reasons."""
    stats = metrics.publish_stats(tables.publish_log(spark, sf_dir))
    return metrics.run_verdict(stats, tables.table(spark, sf_dir, "events").count())


@query(
    "m9_metric_lines",
    f"""SELECT 'app.' || topic || '.' || metric || ' ' || value || ' 1706745600' AS line
        FROM (UNPIVOT (SELECT * FROM {STATS_SQL}) ON COLUMNS(* EXCLUDE topic)
              INTO NAME metric VALUE value)""",
)
def m9_metric_lines(spark, sf_dir):
    stats = metrics.publish_stats(tables.publish_log(spark, sf_dir))
    return metrics.to_metric_lines(stats, prefix="app.", epoch_sec=1706745600)


@query(
    "m9_metric_text",
    f"""SELECT 'context-topic_' || topic AS context, metric || ':' || value AS line
        FROM (UNPIVOT (SELECT * FROM {STATS_SQL}) ON COLUMNS(* EXCLUDE topic)
              INTO NAME metric VALUE value)""",
)
def m9_metric_text(spark, sf_dir):
    stats = metrics.publish_stats(tables.publish_log(spark, sf_dir))
    return metrics.to_metric_lines(stats, "text")
