"""Publishing DataFrames to topics.

Executors write Base64 lines with Spark's text writer into a staging folder of
the root. A commit then renames the files into place:

1. the list of renames is written as a table, so a retry repeats the same list;
2. files are renamed to their final names inside staged minute directories;
3. each new minute directory is renamed as a whole, so it appears complete;
4. missing minutes up to the one after the last are created empty, which tells
   readers that everything before is complete;
5. a marker closes the batch. Publishing the same tag again does nothing.

One publisher at a time may write a topic of a root.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from minuteflow.functions import codec, filenames
from minuteflow.operators.ranges import minute_literal
from minuteflow.session import broadcast_if_small, require_utc
from minuteflow.sources import layout, oplog, storage

MAX_MESSAGE_SIZE = 50 * 1024
_KEY_FORMAT = "yyyyMMddHHmm"


@dataclass(frozen=True)
class Published:
    """What a publish did. ``files`` holds one row per file written."""

    tag: str
    accepted: int
    rejected: int
    files: DataFrame


def check_messages(df: DataFrame, topic: str = "topic", payload: str = "payload") -> DataFrame:
    """Add ``reason``: NULL for a message that can be published."""
    reason = F.when(F.col(topic).isNull(), "NULL_TOPIC").when(
        F.col(payload).isNull(), "NULL_MESSAGE"
    )
    return df.withColumn("reason", reason)


def size_guard(
    df: DataFrame, max_size: int = MAX_MESSAGE_SIZE, payload: str = "payload"
) -> DataFrame:
    """Add ``outcome``: EXCEEDED_MSG_SIZE for payloads over the limit, else NULL.

    Apply it after the audit header, whose 16 bytes count.
    """
    over = F.octet_length(payload) > max_size
    return df.withColumn("outcome", F.when(over, "EXCEEDED_MSG_SIZE"))


def route(
    df: DataFrame,
    rule: Column | Callable[[DataFrame], Column] | dict[str, Column] | None = None,
    topic: str = "topic",
) -> DataFrame:
    """Replace the logical topic by the physical one a rule selects.

    The rule is a Column, a function of the frame, or one Column per logical
    topic. Topics without a rule, and rules that give NULL, keep their name.
    """
    if rule is None:
        return df
    if isinstance(rule, dict):
        chosen = F.coalesce(
            *[F.when(F.col(topic) == name, target) for name, target in rule.items()]
        )
    else:
        chosen = rule(df) if callable(rule) else rule
    return df.withColumn(topic, F.coalesce(chosen, F.col(topic)))


def _open_minutes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        last = [layout.edge_minute(path, last=True) for path in batch["path"].to_pylist()]
        utc = pa.array(last, pa.timestamp("us")).cast(pa.timestamp("us", "UTC"))
        yield pa.RecordBatch.from_arrays([batch["topic"], utc], ["topic", "open_minute"])


def open_minutes(spark: SparkSession, root: str, stream_type: str) -> DataFrame:
    """Topic -> its last minute directory, the only one that still takes files."""
    base = f"{storage.qualify(spark, root)}/{layout.BASE_DIRS[stream_type]}"
    topics = [(name, f"{base}/{name}") for name in storage.subdirs(base, True)]
    known = spark.createDataFrame(topics, "topic string, path string")
    return known.mapInArrow(_open_minutes, "topic string, open_minute timestamp").filter(
        F.col("open_minute").isNotNull()
    )


def _last_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Highest file id already used in each target directory, -1 if none."""
    for batch in batches:
        ids = []
        for row in batch.to_pylist():
            prefix = row["prefix"] + "_"
            names = [e.base_name for e in storage.children(row["target_dir"])]
            used = [int(n[len(prefix) :].split(".")[0]) for n in names if n.startswith(prefix)]
            ids.append(max(used, default=-1))
        yield batch.append_column("last_id", pa.array(ids, pa.int64()))


def _move_staged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            # A file that an earlier attempt brought to its final place stays there.
            if not storage.exists(row["final"]):
                storage.move(row["source"], row["target"])
        yield batch.select(["source"])


def _move_dirs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            storage.move_dir(row["source"], row["target"])
        yield batch.select(["source"])


def _make_dirs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch["source"].to_pylist():
            storage.make_dir(path)
        yield batch.select(["source"])


def _on_executors(df: DataFrame, action, rows: int) -> None:
    """Run a file-system action for every row, at most a few hundred rows per task."""
    tasks = max(1, min(rows // 256, 4 * df.sparkSession.sparkContext.defaultParallelism))
    done = df.repartition(tasks).mapInArrow(action, "source string")
    done.write.format("noop").mode("overwrite").save()


def _path_value(path: Column, key: str) -> Column:
    raw = F.regexp_extract(path, rf"/{key}=([^/]*)/", 1)
    return F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))


def _write_lines(df: DataFrame, stage: str, columns: dict[str, Column], codec_name, compact, order):
    lines = df.select(
        *[c.alias(k) for k, c in columns.items()],
        codec.encode_line(F.col("_payload")).alias("value"),
        *[F.col(c).alias(f"_order{i}") for i, c in enumerate(order)],
    )
    keys = [k for k in columns]
    if compact:
        # AQE merges small groups into one file and splits hot ones over many tasks.
        lines = lines.hint("rebalance", *keys)
    if order:
        lines = lines.sortWithinPartitions(*keys, *[f"_order{i}" for i in range(len(order))])
    lines.select(*keys, "value").write.partitionBy(*keys).mode("overwrite").option(
        "compression", codec_name
    ).text(f"{stage}/lines")


def _plan(spark, root, stage, stream_type) -> DataFrame:
    """One row per staged file with its final place."""
    staged = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "part-*")
        .load(layout.range_path(f"{stage}/lines"))
        .select(F.col("path").alias("source"))
    )
    path = F.col("source")
    parts = staged.select(
        "source",
        _path_value(path, "topic").alias("topic"),
        _path_value(path, "collector").alias("collector"),
        F.to_timestamp(_path_value(path, "minute"), _KEY_FORMAT).alias("minute"),
        F.to_timestamp(_path_value(path, "file_minute"), _KEY_FORMAT).alias("file_minute"),
    )
    stem = F.concat(
        "topic", F.lit("-"), F.date_format("file_minute", filenames.FILE_MINUTE_FORMAT)
    )
    base = f"{root}/{layout.BASE_DIRS[stream_type]}/"
    if stream_type == "collector":
        target_dir = F.concat(F.lit(base), "topic", F.lit("/"), "collector")
        prefix, ext = stem, F.lit("")
    else:
        minute_dir = F.date_format("minute", layout.MINUTE_DIR_FORMAT)
        target_dir = F.concat(F.lit(base), "topic", F.lit("/"), minute_dir)
        prefix, ext = F.concat("collector", F.lit("-"), stem), F.lit(".gz")
    parts = parts.withColumn("target_dir", target_dir).withColumn("prefix", prefix)
    targets = ["target_dir", "prefix"]
    if storage.exists(base):
        used = parts.select(*targets).distinct()
        used = used.mapInArrow(_last_ids, "target_dir string, prefix string, last_id long")
        parts = parts.join(used, targets)
    else:
        parts = parts.withColumn("last_id", F.lit(-1))
    rank = F.row_number().over(Window.partitionBy(*targets).orderBy("source"))
    parts = parts.withColumn("file_id", (rank + F.col("last_id")).cast("int"))
    number = F.format_string("%05d", "file_id")
    return parts.withColumn("file_name", F.concat("prefix", F.lit("_"), number, ext)).select(
        "source", "topic", "collector", "minute", "file_minute", "file_id", "file_name",
        "target_dir",
    )


def _commit(spark, root, stage, stream_type, plan: DataFrame) -> None:
    final = F.concat("target_dir", F.lit("/"), "file_name")
    n_files = plan.count()
    if stream_type == "collector":
        moves = plan.select("source", final.alias("target"), final.alias("final"))
        _on_executors(moves, _move_staged, n_files)
        return
    base = f"{root}/{layout.BASE_DIRS[stream_type]}"
    relative = F.substring(F.col("target_dir"), F.lit(len(base) + 2), F.length("target_dir"))
    staged_dir = F.concat(F.lit(f"{stage}/minutes/"), relative)
    staged_file = F.concat(staged_dir, F.lit("/"), "file_name")
    moves = plan.select("source", staged_file.alias("target"), final.alias("final"))
    _on_executors(moves, _move_staged, n_files)
    dirs = plan.select(staged_dir.alias("source"), F.col("target_dir").alias("target")).distinct()
    _on_executors(dirs, _move_dirs, n_files)

    minute = F.expr("interval 1 minute")
    edges = plan.groupBy("topic").agg(
        F.min("from_minute").alias("first"), F.max("minute").alias("last")
    )
    span = F.explode(F.sequence("first", F.col("last") + minute, minute))
    minute_dir = F.date_format("minute", layout.MINUTE_DIR_FORMAT)
    path = F.concat(F.lit(f"{base}/"), "topic", F.lit("/"), minute_dir)
    minutes = edges.select("topic", span.alias("minute")).select(path.alias("source"))
    _on_executors(minutes, _make_dirs, minutes.count())


def publish(
    df: DataFrame,
    root: str,
    *,
    topic: str = "topic",
    payload: str = "payload",
    collector: str | Column = "publisher0",
    minute: Column | datetime | None = None,
    file_minute: Column | None = None,
    stream_type: str = "local",
    audit_ts: str | None = None,
    max_size: int = MAX_MESSAGE_SIZE,
    order_by: tuple[str, ...] = (),
    compact: bool | None = None,
    tag: str | None = None,
    rejected_to: str | None = None,
    publisher: str | None = None,
) -> Published:
    """Append messages to topics as Base64 lines.

    ``minute`` is the directory minute: now by default, or a column for a
    back-fill. A minute that is already complete is replaced by the topic's
    open minute. ``audit_ts`` names a column of ms to put in an audit header.
    NULL topics, NULL payloads and oversized messages are counted, not
    published; ``rejected_to`` keeps them as a parquet table with a reason.
    With ``publisher`` the outcomes per topic are logged under that name, once per tag (see
    :func:`oplog.published_log`). Successes are counted in the lines written; oversized messages
    are counted in ``df`` again if there are any. ``nanos`` of a success is the time of the whole batch.
    """
    if stream_type not in ("collector", "local", "merged"):
        raise ValueError(f"cannot publish to stream type {stream_type}")
    spark = df.sparkSession
    require_utc(spark)
    root = storage.qualify(spark, root)
    tag = tag or uuid.uuid4().hex
    stage = f"{root}/_staging/{tag}"
    began = time.perf_counter_ns()
    if storage.exists(f"{stage}/_COMMITTED"):
        counts = json.loads(storage.read_text(f"{stage}/counts.json"))
        files = spark.read.parquet(layout.range_path(f"{stage}/plan"))
        return Published(tag, counts["accepted"], counts["rejected"], files)

    if not storage.exists(f"{stage}/plan/_SUCCESS"):
        body = F.col(payload)
        if audit_ts is not None:
            body = codec.with_header(body, F.col(audit_ts))
        checked = check_messages(df, topic, payload).withColumn("_payload", body)
        checked = size_guard(checked, max_size, "_payload")
        checked = checked.withColumn("reason", F.coalesce("reason", "outcome")).drop("outcome")
        if rejected_to is not None:
            refused = checked.filter(F.col("reason").isNotNull()).drop("_payload")
            refused.write.mode("overwrite").parquet(f"{rejected_to}/tag={tag}")
        seen, totals = Observation(), [
            F.count_if(F.col("reason").isNull()).alias("accepted"),
            F.count_if(F.col("reason").isNotNull()).alias("rejected"),
        ]
        unobserved, checked = checked, checked.observe(seen, *totals)
        good = checked.filter(F.col("reason").isNull())
        backfill = isinstance(minute, Column)
        when = minute if backfill else minute_literal(minute or layout.utc_now())
        when = F.date_trunc("minute", when)
        if stream_type != "collector":
            good, when = _to_open_minute(spark, root, stream_type, good, topic, when)
        columns = {
            "topic": F.col(topic),
            "minute": F.date_format(when, _KEY_FORMAT),
            "collector": F.lit(collector) if isinstance(collector, str) else collector,
            "file_minute": F.date_format(when if file_minute is None else file_minute, _KEY_FORMAT),
        }
        codec_name = "none" if stream_type == "collector" else "gzip"
        compact = backfill if compact is None else compact
        _write_lines(good, stage, columns, codec_name, compact, order_by)
        counts = _observed(seen) or unobserved.agg(*totals).first().asDict()
        storage.write_text(f"{stage}/counts.json", json.dumps(counts))
        if publisher is not None:
            _count_outcomes(spark, stage, unobserved, topic, counts)
        plan = _plan(spark, root, stage, stream_type) if counts["accepted"] else _no_files(spark)
        plan = _with_start(spark, root, stream_type, plan)
        plan.write.mode("overwrite").parquet(f"{stage}/plan")

    plan = spark.read.parquet(layout.range_path(f"{stage}/plan"))
    counts = json.loads(storage.read_text(f"{stage}/counts.json"))
    if counts["accepted"]:
        _commit(spark, root, stage, stream_type, plan)
    if publisher is not None:
        done = spark.read.parquet(layout.range_path(f"{stage}/outcomes"))
        nanos = F.when(F.col("kind") == "SUCCESS", time.perf_counter_ns() - began).otherwise(0)
        entry = done.withColumns({"publisher": F.lit(publisher), "nanos": nanos.cast("long")})
        oplog.write_entry(entry, oplog.publish_folder(root), tag)
    storage.write_text(f"{stage}/_COMMITTED", tag)
    return Published(tag, counts["accepted"], counts["rejected"], plan)


def _observed(seen: Observation) -> dict[str, int] | None:
    """What was counted, or None: a plan found empty while it runs loses its observation."""
    try:
        return {k: int(v) for k, v in seen.get.items()}
    except Py4JJavaError:
        return None


def _count_outcomes(spark, stage, checked: DataFrame, topic: str, counts: dict[str, int]) -> None:
    """Store ``topic, kind, n`` of a batch before its files leave the staging folder."""
    none = spark.createDataFrame([], "topic string, n long")
    count = F.count(F.lit(1)).alias("n")
    accepted = oversized = none
    if counts["accepted"]:
        lines = spark.read.option("recursiveFileLookup", "true").text(layout.range_path(f"{stage}/lines"))
        path = F.col("_metadata.file_path")
        accepted = lines.groupBy(_path_value(path, "topic").alias("topic")).agg(count)
    if counts["rejected"]:
        refused = checked.filter(F.col("reason") == "EXCEEDED_MSG_SIZE")
        oversized = refused.groupBy(F.col(topic).alias("topic")).agg(count)
    oplog.outcomes(accepted, oversized).coalesce(1).write.mode("overwrite").parquet(f"{stage}/outcomes")


def _to_open_minute(spark, root, stream_type, good, topic, when):
    if not storage.exists(f"{root}/{layout.BASE_DIRS[stream_type]}"):
        return good, when
    latest = broadcast_if_small(open_minutes(spark, root, stream_type))
    latest = latest.withColumnRenamed("topic", "_open_topic")
    good = good.join(latest, good[topic] == F.col("_open_topic"), "left")
    return good, F.greatest(when, F.col("open_minute"))


def _no_files(spark) -> DataFrame:
    return spark.createDataFrame(
        [],
        "source string, topic string, collector string, minute timestamp, file_minute timestamp,"
        " file_id int, file_name string, target_dir string",
    )


def _with_start(spark, root, stream_type, plan: DataFrame) -> DataFrame:
    """Add ``from_minute``: where the run of minute directories must begin."""
    if stream_type == "collector" or not storage.exists(f"{root}/{layout.BASE_DIRS[stream_type]}"):
        return plan.withColumn("from_minute", F.col("minute"))
    latest = open_minutes(spark, root, stream_type)
    first = F.least(F.col("minute"), F.coalesce("open_minute", "minute"))
    plan = plan.join(latest, "topic", "left").withColumn("from_minute", first)
    return plan.drop("open_minute")


def publish_text(spark: SparkSession, path: str, topic: str, root: str, **kwargs) -> Published:
    """Publish each line of text files as one message."""
    lines = spark.read.text(path).select(
        F.lit(topic).alias("topic"), F.col("value").cast("binary").alias("payload")
    )
    return publish(lines, root, **kwargs)
