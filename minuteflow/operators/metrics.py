"""Backlog, lag, consumer and publisher statistics, and metric lines."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from minuteflow.operators.audit import AUDIT_TOPIC
from minuteflow.operators.checkpoint import FULLY_READ
from minuteflow.operators.ranges import minute_literal
from minuteflow.session import broadcast_if_small

# Fixed value: how much larger a committed file is when uncompressed.
COMPRESSION_FACTOR = 3.8

# Outcome -> name of its counter.
OUTCOME_COUNTERS = {
    "INVOCATION": "invocations",
    "SUCCESS": "success",
    "UNHANDLED_FAILURE": "unhandled",
    "GRACEFUL_FAILURE": "graceful",
    "LOST": "lost",
    "RETRY": "retry",
    "REJECT": "reject",
    "RECONNECT": "reconnects",
    "EXCEEDED_MSG_SIZE": "exceeded_size",
}


def backlog(
    files: DataFrame,
    checkpoint: DataFrame | None = None,
    stop: datetime | None = None,
) -> DataFrame:
    """Unread bytes of each partition, from a file listing and a checkpoint.

    While the current file lies in the collector directory, collector files
    from its minute on count, the current file whole. Once it has moved, the
    committed files from its directory minute on count, times the compression
    factor and cut to a whole number, plus collector files not older than the
    last committed one. Generic files from the current minute on count as they
    are. Partitions without checkpoint are wholly unread.
    """
    if stop is not None:
        files = files.filter(F.coalesce("file_minute", "minute") <= minute_literal(stop))
    null = F.lit(None)
    if checkpoint is None:
        files = files.withColumns(
            {"_minute": null.cast("timestamp"), "_id": null.cast("int")}
        )
    else:
        on = [c for c in ("cluster", "collector") if c in checkpoint.columns]
        by_file = "collector" in on
        current = checkpoint.groupBy(*on).agg(
            F.max("minute").alias("_minute"),
            (F.max("file_key.file_id") if by_file else null.cast("int")).alias("_id"),
        )
        files = files.join(broadcast_if_small(current), on, "left")
    in_flight = F.col("stream_type") == "collector"
    committed = F.col("stream_type") == "local"
    is_current = (F.col("file_minute") == F.col("_minute")) & (F.col("file_id") == F.col("_id"))
    states = files.groupBy("cluster", F.col("collector").alias("_collector")).agg(
        F.coalesce(F.bool_or(in_flight & is_current), F.lit(False)).alias("_in_flight"),
        F.min(F.when(committed & is_current, F.col("minute"))).alias("_dir"),
        F.max(F.when(committed, F.col("file_minute"))).alias("_last_committed"),
    )
    states = states.withColumnRenamed("cluster", "_cluster")
    same = (F.col("cluster") == F.col("_cluster")) & F.col("collector").eqNullSafe(
        F.col("_collector")
    )
    from_minute = F.when(F.col("_in_flight"), F.col("_minute")).otherwise(
        F.coalesce(F.greatest("_last_committed", "_minute"), F.col("_minute"))
    )
    from_dir = F.coalesce("_dir", "_minute")
    unread = (
        F.when(in_flight, from_minute.isNull() | (F.col("file_minute") >= from_minute))
        .when(committed, ~F.col("_in_flight") & (from_dir.isNull() | (F.col("minute") >= from_dir)))
        .otherwise(F.col("_minute").isNull() | (F.col("minute") >= F.col("_minute")))
    )
    sizes = (
        files.join(states, same)
        .filter(unread)
        .groupBy("cluster", "collector")
        .agg(
            F.coalesce(F.sum(F.when(~committed, F.col("length"))), F.lit(0)).alias("plain_bytes"),
            F.coalesce(F.sum(F.when(committed, F.col("length"))), F.lit(0)).alias("committed_bytes"),
        )
    )
    adjusted = (F.col("committed_bytes").cast("double") * COMPRESSION_FACTOR).cast("long")
    return sizes.withColumn("pending_bytes", F.col("plain_bytes") + adjusted)


def directory_lag(checkpoint: DataFrame, now: datetime) -> DataFrame:
    """Latest fully read minute of each cluster and the minutes since; -1 for none."""
    read = F.max(F.when(F.col("line_no") == FULLY_READ, F.col("minute")))
    minutes = F.timestamp_diff("MINUTE", F.col("latest_minute"), minute_literal(now))
    return (
        checkpoint.groupBy("cluster")
        .agg(read.alias("latest_minute"))
        .withColumn("lag_minutes", F.coalesce(minutes, F.lit(-1)).cast("long"))
    )


def _events(log: DataFrame, kind: str) -> Column:
    """Number of events of a kind in a log of single events, or of summed rows with ``n``."""
    if "n" not in log.columns:
        return F.count_if(F.col("kind") == kind)
    return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0))


def consumer_stats(log: DataFrame) -> DataFrame:
    """Counters of a consumption log ``topic, consumer, kind``, with ``n`` events a row if it has ``n``."""
    names = {
        "MESSAGE": "messages_consumed",
        "MARK": "mark_calls",
        "RESET": "reset_calls",
        "TIMEOUT": "timeouts",
    }
    counters = [_events(log, kind).alias(name) for kind, name in names.items()]
    return log.groupBy("topic", "consumer").agg(*counters)


def partition_stats(messages: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Messages read, delivered and in error per partition, files and last minute.

    A stitched stream also counts how often reading moves between collector and
    committed files. Those moves are found on file rows, one per file.
    """
    by = by or ["cluster", "collector"]
    error = F.col("corrupt") if "corrupt" in messages.columns else F.lit(False)
    files = messages.groupBy(*by, "stream_type", "file_minute", "file_id", "file_name").agg(
        F.count(F.lit(1)).alias("_read"),
        F.count_if(error).alias("_errors"),
        F.max(F.coalesce("minute", "file_minute")).alias("_minute"),
    )
    return _file_stats(files, by)


def _file_stats(files: DataFrame, by: list[str]) -> DataFrame:
    order = Window.partitionBy(*by).orderBy("file_minute", "file_id", "file_name")
    previous = F.lag("stream_type").over(order)
    moved = files.withColumn("_from", previous)
    to_committed = (F.col("_from") == "collector") & (F.col("stream_type") == "local")
    to_collector = (F.col("_from") == "local") & (F.col("stream_type") == "collector")
    return moved.groupBy(*by).agg(
        F.sum("_read").alias("messages_read"),
        (F.sum("_read") - F.sum("_errors")).alias("messages_delivered"),
        F.sum("_errors").alias("errors"),
        F.count(F.lit(1)).alias("files"),
        F.max("_minute").alias("last_minute"),
        F.count_if(to_committed).alias("switches_to_committed"),
        F.count_if(to_collector).alias("switches_to_collector"),
    )


def _outcome_columns(log: DataFrame) -> list[Column]:
    counters = [_events(log, k).alias(v) for k, v in OUTCOME_COUNTERS.items()]
    return [*counters, F.coalesce(F.sum("nanos"), F.lit(0)).alias("cumulative_nanos")]


def _in_flight() -> Column:
    done = F.col("success") + F.col("lost") + F.col("graceful") + F.col("reject")
    return F.col("invocations") - done


def publish_stats(log: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Outcome counters of a publish log ``topic, publisher, kind, nanos``, with ``n`` events a row if it
    has ``n``.

    ``in_flight`` is what was invoked and has no final outcome; oversized and
    unhandled messages stay in flight.
    """
    stats = log.groupBy(*(by or ["topic"])).agg(*_outcome_columns(log))
    return stats.withColumn("in_flight", _in_flight())


def publish_totals(log: DataFrame) -> DataFrame:
    """Counters per topic and publisher, per topic and in all, without audit messages."""
    own = log.filter(F.col("topic") != AUDIT_TOPIC)
    stats = own.rollup("topic", "publisher").agg(
        F.grouping_id().cast("int").alias("level"), *_outcome_columns(own)
    )
    return stats.withColumn("in_flight", _in_flight())


def run_verdict(stats: DataFrame, expected: int) -> DataFrame:
    """Judge a run from its counters per topic: one row with reasons and warnings."""
    total = {c: F.sum(c) for c in ("invocations", "success")}
    bad = ["graceful", "lost", "reconnects", "retry", "unhandled"]
    sums = stats.agg(
        total["invocations"].alias("invocations"),
        total["success"].alias("success"),
        F.bool_and(F.col("invocations") == F.col("success")).alias("_each"),
        F.bool_and(F.col("in_flight") == 0).alias("_landed"),
        *[F.sum(c).alias(c) for c in bad],
    )
    reasons = F.array_compact(
        F.array(
            F.when(F.col("success") != expected, "unexpected total"),
            F.when(F.col("invocations") != F.col("success"), "invocations differ from success"),
            F.when(~F.col("_each"), "invocations differ from success in a topic"),
            F.when(~F.col("_landed"), "messages in flight"),
        )
    )
    warn = F.lit(False)
    for c in bad:
        warn = warn | (F.col(c) != 0)
    return sums.select(
        "invocations",
        "success",
        F.array_join(reasons, "; ").alias("reasons"),
        (F.size(reasons) > 0).alias("failed"),
        warn.alias("warned"),
    )


def long_metrics(stats: DataFrame, ids: list[str]) -> DataFrame:
    """Counters as rows ``ids..., metric, value``."""
    names = [c for c in stats.columns if c not in ids]
    typed = stats.select(*ids, *[F.col(c).cast("long").alias(c) for c in names])
    return typed.unpivot(ids, names, "metric", "value")


def to_metric_lines(
    stats: DataFrame,
    fmt: str = "graphite",
    ids: tuple[str, ...] = ("topic",),
    prefix: str = "",
    epoch_sec: int = 0,
) -> DataFrame:
    """Metric text lines.

    ``graphite``: ``<prefix><topic>.<metric> <value> <epoch seconds>``.
    ``text``: ``<metric>:<value>`` under a ``context`` made of the id columns.
    """
    rows = long_metrics(stats, list(ids))
    if fmt == "graphite":
        name = F.concat(F.lit(prefix), F.col(ids[0]), F.lit("."), F.col("metric"))
        return rows.select(
            F.concat_ws(" ", name, F.col("value").cast("string"), F.lit(str(epoch_sec))).alias("line")
        )
    if fmt == "text":
        context = F.concat(
            F.lit("context"), *[F.concat(F.lit(f"-{i}_"), F.col(i)) for i in ids]
        )
        line = F.concat_ws(":", F.col("metric"), F.col("value").cast("string"))
        return rows.select(context.alias("context"), line.alias("line"))
    raise ValueError(f"unknown metric format {fmt}")


def write_metric_lines(lines: DataFrame, path: str, append: bool = True) -> None:
    """Store metric lines as text, one folder per context if there is one."""
    writer = lines.write.mode("append" if append else "overwrite")
    if "context" in lines.columns:
        writer = writer.partitionBy("context")
    writer.text(path)
