"""Messages, logs and published streams derived from the shared tables."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from minuteflow.functions import filenames
from minuteflow.session import work_dir
from minuteflow.sources import layout, storage
from minuteflow.sources.publish import publish

TOPIC = "events"
FIRST = datetime(2024, 1, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def block_minute(ts: Column) -> Column:
    """Replay minute of an event: five days of the month per minute."""
    block = F.floor((F.dayofmonth(ts) - 1) / 5).cast("int")
    return F.timestamp_add("MINUTE", block, F.lit("2024-01-01 00:00:00").cast("timestamp"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages, with cluster, collector, minute and time in ms."""
    ts = F.col("ts")
    return (
        table(spark, sf_dir, "events")
        .withColumn("ts", ts.cast("timestamp"))
        .withColumns(
            {
                "topic": F.col("event_type"),
                "cluster": F.concat(F.lit("c"), F.col("user_id") % 2),
                "collector": F.concat(F.lit("collector"), F.col("user_id") % 4),
                "minute": F.date_trunc("minute", ts),
                "ts_ms": F.unix_millis(ts),
                "payload": F.concat_ws("|", "event_id", "user_id", "props").cast("binary"),
            }
        )
    )


def positioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the position columns of a minute-directory stream.

    Each collector has one file per minute; ids rise along every file, so they
    serve as line numbers.
    """
    minute = F.col("minute")
    stem = filenames.collector_file_name(F.lit(TOPIC), minute, F.lit(0))
    return events(spark, sf_dir).withColumns(
        {
            "file_minute": minute,
            "file_id": F.lit(0),
            "file_dir": F.date_format(minute, layout.MINUTE_DIR_FORMAT),
            "file_mtime": minute + F.expr("interval 90 seconds"),
            "file_name": filenames.committed_file_name(F.col("collector"), stem),
            "line_no": F.col("event_id") + 1,
        }
    )


def publish_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One invocation and one outcome per event, and a reconnect for costly ones."""
    outcome = (
        F.when(F.col("event_type") == "purchase", "GRACEFUL_FAILURE")
        .when(F.col("event_type") == "error", "LOST")
        .when(F.col("event_type") == "signup", "RETRY")
        .otherwise("SUCCESS")
    )
    kinds = F.array_compact(
        F.array(F.lit("INVOCATION"), outcome, F.when(F.col("value") > 50, "RECONNECT"))
    )
    lane = F.col("user_id") % 3
    return events(spark, sf_dir).select(
        F.when(lane == 2, "_audit").otherwise(F.concat(F.lit("t"), lane)).alias("topic"),
        F.concat(F.lit("p"), F.col("user_id") % 4).alias("publisher"),
        "ts_ms",
        F.explode(kinds).alias("kind"),
        F.floor(F.col("value") * 1000).cast("long").alias("nanos"),
    )


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered messages from order lines: the order is the number.

    Orders have one to many lines, so numbers arrive too often or too rarely;
    lines without tax lose their delimiters and cannot be parsed.
    """
    sent = F.unix_millis(F.col("l_shipdate").cast("timestamp"))
    parts = [F.col("l_orderkey").cast("string"), sent.cast("string"), F.col("l_returnflag")]
    delimiter = F.when(F.col("l_tax") == 0, "-").otherwise("/t")
    payload = F.concat(parts[0], delimiter, parts[1], delimiter, parts[2])
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        payload.cast("binary").alias("payload"),
        (sent + F.floor(F.col("l_quantity") * 1000).cast("long")).alias("arrival_ms"),
    )


_cache: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, kind: str, build):
    """Publish a fixture once per session and table folder."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _cache:
        _cache[key] = build()
    return _cache[key]


def _publish_roots(spark: SparkSession, sf_dir: str, stream_type: str) -> dict[str, str]:
    base = work_dir(spark, stream_type)
    rows = events(spark, sf_dir).withColumn("topic", F.lit(TOPIC))
    block = block_minute(F.col("ts"))
    roots = {}
    for cluster in ("c0", "c1"):
        roots[cluster] = f"{base}/{cluster}"
        publish(
            rows.filter(F.col("cluster") == cluster),
            roots[cluster],
            collector=F.col("collector"),
            minute=block + F.expr("interval 1 minute") if stream_type == "local" else block,
            file_minute=block,
            stream_type=stream_type,
            audit_ts="ts_ms",
            order_by=("event_id",),
        )
    return roots


def local_roots(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """All events as a local stream of two clusters; a file is committed a minute later."""
    return _once(spark, sf_dir, "local", lambda: _publish_roots(spark, sf_dir, "local"))


def collector_roots(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """All events in the collector directories of two clusters."""
    return _once(spark, sf_dir, "collector", lambda: _publish_roots(spark, sf_dir, "collector"))


def _commit_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compress collector files into their minute directories; drop the moved ones."""
    for batch in batches:
        for row in batch.to_pylist():
            filesystem, source = storage.open_fs(row["source"])
            target = storage.open_fs(row["target"])[1]
            filesystem.create_dir(target.rsplit("/", 1)[0], recursive=True)
            with (
                filesystem.open_input_stream(source, compression=None) as src,
                filesystem.open_output_stream(target, compression="gzip") as out,
            ):
                while chunk := src.read(4 << 20):
                    out.write(chunk)
            if row["moved"]:
                filesystem.delete_file(source)
        yield batch.select(["source"])


def stitched_root(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """One cluster whose older files were moved, newer ones not yet.

    Files of the first two minutes have moved, those of the next two are in
    both places, and the last two are only in the collector directories.
    """

    def build():
        root = storage.qualify(spark, work_dir(spark, "stitched"))
        rows = events(spark, sf_dir).withColumn("topic", F.lit(TOPIC))
        block = block_minute(F.col("ts"))
        done = publish(
            rows, root, collector=F.col("collector"), minute=block, stream_type="collector",
            audit_ts="ts_ms", order_by=("event_id",),
        )
        at = F.col("file_minute")
        dir_minute = F.date_format(at + F.expr("interval 1 minute"), layout.MINUTE_DIR_FORMAT)
        copies = done.files.filter(F.minute(at) < 4).select(
            F.concat("target_dir", F.lit("/"), "file_name").alias("source"),
            F.concat(
                F.lit(f"{root}/streams_local/{TOPIC}/"),
                dir_minute,
                F.lit("/"),
                filenames.committed_file_name(F.col("collector"), F.col("file_name")),
            ).alias("target"),
            (F.minute(at) < 2).alias("moved"),
        )
        copies.repartition(4).mapInArrow(_commit_copies, "source string").count()
        return {"c0": root}

    return _once(spark, sf_dir, "stitched", build)


def message_fields(messages: DataFrame) -> DataFrame:
    """Split the payload of a published event."""
    parts = F.split(F.col("payload").cast("string"), r"\|", 3)
    return messages.withColumns(
        {
            "event_id": parts[0].cast("long"),
            "user_id": parts[1].cast("long"),
            "props": parts[2],
        }
    )


def dense_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positioned events whose lines count from 1 in each file.

    A file here is one collector's minute, so its window stays small.
    """
    file = Window.partitionBy("cluster", "collector", "minute").orderBy("event_id")
    return positioned(spark, sf_dir).withColumn("line_no", F.row_number().over(file))
