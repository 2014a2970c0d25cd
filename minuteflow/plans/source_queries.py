"""Queries over published streams: scans, stitching, listings and streaming reads."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from minuteflow.functions import codec, filenames
from minuteflow.operators.positions import with_positions
from minuteflow.plans import tables
from minuteflow.plans.registry import MESSAGES_SQL, query
from minuteflow.session import work_dir
from minuteflow.sources import storage
from minuteflow.sources.collectors import read_collectors, read_stitched
from minuteflow.sources.listing import list_files, minute_dirs
from minuteflow.sources.minutes import decode_messages, read_messages, read_minutes
from minuteflow.sources.publish import publish
from minuteflow.streaming.minute_source import stream_minutes
from minuteflow.streaming.tail_source import stream_collectors

MINUTE = "yyyy-MM-dd HH:mm"


def _run(stream: DataFrame, spark: SparkSession, name: str) -> str:
    """Drain a stream into a parquet table and return its path."""
    out = work_dir(spark, name)
    _append(stream, out, f"{out}-checkpoint")
    return out


def _append(stream: DataFrame, out: str, checkpoint: str) -> None:
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start(out).awaitTermination()


@query(
    "s1_minute_scan",
    f"""SELECT event_id, user_id, props, cluster, collector,
        strftime(block + INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M') AS minute FROM {MESSAGES_SQL}""",
)
def s1_minute_scan(spark, sf_dir):
    """Scan both clusters of a local stream and decode every line."""
    rows = read_messages(spark, tables.local_roots(spark, sf_dir), tables.TOPIC)
    return tables.message_fields(rows).select(
        "event_id", "user_id", "props", "cluster", "collector",
        F.date_format("minute", MINUTE).alias("minute"),
    )


@query(
    "s1_minute_scan_range",
    f"""SELECT event_id FROM {MESSAGES_SQL} WHERE block + INTERVAL 1 MINUTE BETWEEN
        TIMESTAMP '2024-01-01 00:02:00' AND TIMESTAMP '2024-01-01 00:04:00'""",
)
def s1_minute_scan_range(spark, sf_dir):
    """The same scan limited to a range, so only these directories are listed."""
    rows = read_messages(
        spark, tables.local_roots(spark, sf_dir), tables.TOPIC,
        start=datetime(2024, 1, 1, 0, 2), stop=datetime(2024, 1, 1, 0, 4),
    )
    return tables.message_fields(rows).select("event_id")


@query(
    "s2_record_format",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(TIMESTAMP '2024-01-01' + INTERVAL 1 MINUTE * quarter(o_orderdate),
                '%Y-%m-%d %H:%M') AS minute FROM orders""",
)
def s2_record_format(spark, sf_dir):
    """Parquet records in generic minute directories, one per quarter of the order date."""
    root = work_dir(spark, "generic")
    orders = tables.table(spark, sf_dir, "orders")
    for quarter in range(1, 5):
        part = orders.filter(F.quarter("o_orderdate") == quarter)
        part.write.parquet(f"{root}/2024/01/01/00/0{quarter}")
    rows = read_minutes(spark, root, "orders", "generic", fmt="parquet")
    return rows.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.date_format("minute", MINUTE).alias("minute"),
    )


@query(
    "s3_base64_decode",
    f"""SELECT event_id, event_type = 'error' AS corrupt,
        CASE WHEN event_type <> 'error' THEN payload END AS strict_text, payload AS lenient_text
        FROM {MESSAGES_SQL}""",
)
def s3_base64_decode(spark, sf_dir):
    """Decode Base64 lines of which those of one topic carry a stray character."""
    line = codec.encode_line(F.col("payload"))
    line = F.when(F.col("topic") == "error", F.concat(F.lit("*"), line)).otherwise(line)
    rows = tables.events(spark, sf_dir).select("event_id", line.alias("value"))
    strict = codec.decode_lines(rows, name="strict")
    both = codec.decode_lines(strict, name="lenient", lenient=True)
    return both.select(
        "event_id", "corrupt",
        F.col("strict").cast("string").alias("strict_text"),
        F.col("lenient").cast("string").alias("lenient_text"),
    )


@query(
    "s4_message_table",
    f"""SELECT cluster, collector, count(*) AS messages, min(ts_ms) AS first_ms,
        max(ts_ms) AS last_ms, CAST(sum(octet_length(encode(payload))) AS BIGINT) AS bytes,
        count(DISTINCT md5(payload)) AS payloads FROM {MESSAGES_SQL} GROUP BY ALL""",
)
def s4_message_table(spark, sf_dir):
    """Counts and digests of the message table of a local stream."""
    rows = read_messages(spark, tables.local_roots(spark, sf_dir), tables.TOPIC)
    return rows.groupBy("cluster", "collector").agg(
        F.count(F.lit(1)).alias("messages"),
        F.min("audit_ts").alias("first_ms"),
        F.max("audit_ts").alias("last_ms"),
        F.sum(F.octet_length("payload")).alias("bytes"),
        F.count_distinct(F.md5("payload")).alias("payloads"),
    )


@query(
    "s5_collector_scan",
    f"""SELECT cluster, collector, strftime(block, '%Y-%m-%d %H:%M') AS file_minute,
        count(*) AS messages, min(event_id) AS first_id, max(event_id) AS last_id
        FROM {MESSAGES_SQL} GROUP BY ALL""",
)
def s5_collector_scan(spark, sf_dir):
    """Scan the collector directories of two clusters."""
    rows = read_collectors(spark, tables.collector_roots(spark, sf_dir), tables.TOPIC)
    return (
        tables.message_fields(decode_messages(rows))
        .groupBy("cluster", "collector", F.date_format("file_minute", MINUTE).alias("file_minute"))
        .agg(
            F.count(F.lit(1)).alias("messages"),
            F.min("event_id").alias("first_id"),
            F.max("event_id").alias("last_id"),
        )
    )


def _add_half_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            filesystem, inner = storage.open_fs(path)
            with filesystem.open_input_file(inner) as source:
                whole = source.read()
            with filesystem.open_output_stream(inner) as out:
                out.write(whole + b"aGFsZiBhIGxpb")
        yield batch


@query("s5_growing_file", f"SELECT event_id, collector FROM {MESSAGES_SQL}")
def s5_growing_file(spark, sf_dir):
    """Every collector file ends in half a line; whole lines are read and nothing else."""
    root = work_dir(spark, "growing")
    rows = tables.events(spark, sf_dir).withColumn("topic", F.lit(tables.TOPIC))
    done = publish(
        rows, root, collector=F.col("collector"), minute=tables.block_minute(F.col("ts")),
        stream_type="collector",
    )
    paths = done.files.select(F.concat("target_dir", F.lit("/"), "file_name").alias("path"))
    paths.mapInArrow(_add_half_lines, "path string").count()
    lines = decode_messages(read_collectors(spark, root, tables.TOPIC))
    return tables.message_fields(lines).select("event_id", "collector")


@query(
    "s6_multi_cluster_union",
    f"""SELECT cluster, event_type, count(*) AS messages, CAST(sum(user_id) AS BIGINT) AS users
        FROM {MESSAGES_SQL} GROUP BY ALL""",
)
def s6_multi_cluster_union(spark, sf_dir):
    """Union of two roots; joined to the events for their type."""
    rows = read_messages(spark, tables.local_roots(spark, sf_dir), tables.TOPIC)
    read = tables.message_fields(rows).select("cluster", "event_id", "user_id")
    kinds = tables.table(spark, sf_dir, "events").select("event_id", "event_type")
    return (
        read.join(kinds, "event_id")
        .groupBy("cluster", "event_type")
        .agg(F.count(F.lit(1)).alias("messages"), F.sum("user_id").alias("users"))
    )


@query(
    "s7_stitched_read",
    f"""SELECT event_id, collector,
        CASE WHEN minute(block) < 4 THEN 'local' ELSE 'collector' END AS stream_type
        FROM {MESSAGES_SQL}""",
)
def s7_stitched_read(spark, sf_dir):
    """Read files once that are moved, half moved or still in flight."""
    rows = read_stitched(spark, tables.stitched_root(spark, sf_dir), tables.TOPIC)
    return tables.message_fields(decode_messages(rows)).select(
        "event_id", "collector", "stream_type"
    )


@query(
    "s7_collector_only",
    f"SELECT event_id, collector FROM {MESSAGES_SQL} WHERE minute(block) >= 2",
)
def s7_collector_only(spark, sf_dir):
    """The stitched read with its committed part switched off."""
    rows = read_stitched(spark, tables.stitched_root(spark, sf_dir), tables.TOPIC, local=False)
    return tables.message_fields(decode_messages(rows)).select("event_id", "collector")


@query(
    "s9_stream_minutes",
    f"""SELECT event_id, cluster, strftime(block + INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M') AS minute
        FROM {MESSAGES_SQL}""",
)
def s9_stream_minutes(spark, sf_dir):
    """Stream all complete minutes of two clusters."""
    stream = stream_minutes(spark, tables.local_roots(spark, sf_dir), tables.TOPIC)
    rows = spark.read.parquet(_run(stream, spark, "minutes"))
    return tables.message_fields(rows).select(
        "event_id", "cluster", F.date_format("minute", MINUTE).alias("minute")
    )


@query(
    "s10_stream_collector_tail",
    f"SELECT event_id, cluster, collector FROM {MESSAGES_SQL}",
)
def s10_stream_collector_tail(spark, sf_dir):
    """Tail the collector files of two clusters."""
    stream = stream_collectors(spark, tables.collector_roots(spark, sf_dir), tables.TOPIC)
    rows = spark.read.parquet(_run(stream, spark, "tail"))
    return tables.message_fields(rows).select("event_id", "cluster", "collector")


@query(
    "s9_stream_positions",
    f"""SELECT cluster, collector, strftime(block, '%Y-%m-%d %H:%M') AS file_minute,
               count(*) AS n_lines, count(*) AS last_line
        FROM {MESSAGES_SQL} GROUP BY ALL""",
)
def s9_stream_positions(spark, sf_dir):
    """Lines and the last line number per file minute, from streamed rows."""
    stream = stream_minutes(spark, tables.local_roots(spark, sf_dir), tables.TOPIC)
    rows = spark.read.parquet(_run(stream, spark, "positions"))
    files = rows.groupBy("cluster", "collector", "file_minute", "file_dir", "file_name").agg(
        F.count("*").alias("n"), F.max("line_no").alias("last")
    )
    return files.groupBy(
        "cluster", "collector", F.date_format("file_minute", MINUTE).alias("file_minute")
    ).agg(F.sum("n").alias("n_lines"), F.sum("last").alias("last_line"))


@query(
    "s10_stream_until",
    f"""SELECT event_id, cluster, collector FROM {MESSAGES_SQL}
        WHERE block <= (SELECT max(block) - INTERVAL 2 MINUTE FROM {MESSAGES_SQL})""",
)
def s10_stream_until(spark, sf_dir):
    """Tail collector files up to a stop time, two minutes before the last file."""
    roots = tables.collector_roots(spark, sf_dir)
    blocks = tables.events(spark, sf_dir).select(tables.block_minute(F.col("ts")).alias("block"))
    last = blocks.agg(F.max("block") - F.expr("interval 2 minutes")).first()[0]
    stream = stream_collectors(spark, roots, tables.TOPIC, stop=last.isoformat())
    rows = spark.read.parquet(_run(stream, spark, "until"))
    return tables.message_fields(rows).select("event_id", "cluster", "collector")


@query("s11_collector_discovery", f"SELECT event_id, collector FROM {MESSAGES_SQL}")
def s11_collector_discovery(spark, sf_dir):
    """Two collectors first, two more after the stream has run: the next run finds them."""
    root = work_dir(spark, "discovery")
    rows = tables.events(spark, sf_dir).withColumn("topic", F.lit(tables.TOPIC))
    out, early = work_dir(spark, "discovered"), F.col("collector") < "collector2"
    for part in (rows.filter(early), rows.filter(~early)):
        publish(
            part, root, collector=F.col("collector"), minute=tables.block_minute(F.col("ts")),
            stream_type="collector",
        )
        _append(stream_collectors(spark, root, tables.TOPIC), out, f"{out}-checkpoint")
    return tables.message_fields(spark.read.parquet(out)).select("event_id", "collector")


@query(
    "s12_file_listing",
    f"""SELECT cluster, collector, strftime(block, '%Y-%m-%d %H:%M') AS file_minute
        FROM {MESSAGES_SQL} GROUP BY ALL""",
)
def s12_file_listing(spark, sf_dir):
    """Collectors and file minutes that have at least one non-empty file."""
    files = list_files(spark, tables.local_roots(spark, sf_dir), tables.TOPIC)
    return (
        files.filter(F.col("length") > 0)
        .select("cluster", "collector", F.date_format("file_minute", MINUTE).alias("file_minute"))
        .distinct()
    )


@query(
    "s12_minute_dirs",
    f"""WITH spans AS (
          SELECT cluster, min(block) AS lo, max(block) AS hi FROM {MESSAGES_SQL} GROUP BY cluster),
        used AS (SELECT DISTINCT cluster, block FROM {MESSAGES_SQL}),
        dirs AS (SELECT cluster, unnest(generate_series(lo + INTERVAL 1 MINUTE,
                        hi + INTERVAL 2 MINUTE, INTERVAL 1 MINUTE)) AS minute FROM spans)
        SELECT d.cluster, strftime(d.minute, '%Y-%m-%d %H:%M') AS minute, u.block IS NULL AS empty
        FROM dirs d LEFT JOIN used u
          ON u.cluster = d.cluster AND u.block + INTERVAL 1 MINUTE = d.minute""",
)
def s12_minute_dirs(spark, sf_dir):
    """All minute directories, also the empty one after the last commit."""
    dirs = minute_dirs(spark, tables.local_roots(spark, sf_dir), tables.TOPIC)
    return dirs.select(
        "cluster",
        F.date_format("minute", MINUTE).alias("minute"),
        (F.col("n_files") == 0).alias("empty"),
    )


@query(
    "s13_file_names",
    f"""SELECT event_id, event_type <> 'error' AS valid,
        CASE WHEN event_type <> 'error' THEN 'a-' || event_type END AS stream,
        CASE WHEN event_type <> 'error' THEN collector || '-x' END AS collector,
        CASE WHEN event_type <> 'error' THEN strftime(minute, '%Y-%m-%d %H:%M') END AS file_minute,
        CASE WHEN event_type <> 'error' THEN CAST(event_id AS INTEGER) END AS file_id,
        CASE WHEN event_type <> 'error' THEN 'gz' END AS ext FROM {MESSAGES_SQL}""",
)
def s13_file_names(spark, sf_dir):
    """Print and parse committed file names; streams and collectors contain dashes."""
    stream = F.concat(F.lit("a-"), F.col("topic"))
    printed = filenames.committed_file_name(
        F.concat("collector", F.lit("-x")),
        filenames.collector_file_name(stream, F.col("minute"), F.col("event_id")),
    )
    broken = F.regexp_replace(printed, r"_(\d+)\.", r"-$1.")
    names = tables.events(spark, sf_dir).select(
        "event_id",
        stream.alias("topic"),
        F.when(F.col("topic") == "error", broken).otherwise(printed).alias("file_name"),
    )
    parsed = filenames.parse_file_names(names, "file_name", stream="topic")
    return parsed.select(
        "event_id", "valid", "stream", "collector",
        F.date_format("file_minute", MINUTE).alias("file_minute"), "file_id", "ext",
    )


@query(
    "p6_line_numbers",
    f"""SELECT cluster, strftime(block, '%Y-%m-%d %H:%M') AS file_minute, count(*) AS messages,
        count(*) AS last_lines, count(*) AS distinct_lines FROM {MESSAGES_SQL} GROUP BY ALL""",
)
def p6_line_numbers(spark, sf_dir):
    """Line numbers are 1..n in every file: the last number is the count."""
    lines = with_positions(
        read_collectors(spark, tables.collector_roots(spark, sf_dir), tables.TOPIC)
    )
    files = lines.groupBy("cluster", "collector", "file_minute", "file_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("line_no").alias("last"),
        F.count_distinct("line_no").alias("d"),
    )
    return files.groupBy("cluster", F.date_format("file_minute", MINUTE).alias("file_minute")).agg(
        F.sum("n").alias("messages"),
        F.sum("last").alias("last_lines"),
        F.sum("d").alias("distinct_lines"),
    )
