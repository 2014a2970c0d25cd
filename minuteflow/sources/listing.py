"""File and directory inventories of streams, listed by the executors."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from minuteflow.functions import filenames
from minuteflow.operators.ranges import check_range, time_range
from minuteflow.session import require_utc
from minuteflow.sources import layout, storage
from minuteflow.sources.minutes import inner_path, load_or_empty, minute_of_dir, path_below

_DIR_SCHEMA = pa.schema({"cluster": pa.string(), "dir": pa.string(), "n_files": pa.int64()})
_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def list_files(
    spark: SparkSession,
    roots: layout.Roots,
    topic: str,
    stream_type: str = "local",
    start: datetime | None = None,
    stop: datetime | None = None,
) -> DataFrame:
    """One row per file: partition, minute, name, length and mtime.

    Uses the ``binaryFile`` reader without its content column, so no file is opened.
    """
    return located_files(spark, roots, topic, stream_type, start, stop).drop("path")


def located_files(
    spark: SparkSession,
    roots: layout.Roots,
    topic: str,
    stream_type: str = "local",
    start: datetime | None = None,
    stop: datetime | None = None,
) -> DataFrame:
    """``list_files`` with the ``path`` of each file."""
    check_range(start, stop)
    require_utc(spark)
    frames = []
    for cluster, root in layout.named_roots(roots, stream_type).items():
        base = layout.stream_dir(storage.qualify(spark, root), topic, stream_type)
        by_dir = stream_type != "collector"
        path = layout.range_path(base, start, stop) if by_dir else layout.range_path(base)
        raw = load_or_empty(spark, "binaryFile", path, {}, _FILE_SCHEMA)
        name = F.element_at(F.split("path", "/"), -1)
        below = path_below(F.col("path"), inner_path(base, encoded=False))
        dir_size = F.length(below) - F.length(name) - 1
        file_dir = F.substring(below, F.lit(1), dir_size) if by_dir else F.lit(None).cast("string")
        if stream_type == "collector":
            collector = F.element_at(F.split("path", "/"), -2)
        elif stream_type == "generic":
            collector = F.lit(None).cast("string")
        else:
            collector = filenames.collector_of(name, topic)
        generic = stream_type == "generic"
        null = F.lit(None)
        frames.append(
            raw.select(
                F.lit(stream_type).alias("stream_type"),
                F.lit(topic).alias("topic"),
                F.lit(cluster).alias("cluster"),
                collector.alias("collector"),
                minute_of_dir(file_dir).alias("minute"),
                (null.cast("timestamp") if generic else filenames.file_minute_of(name)).alias(
                    "file_minute"
                ),
                (null.cast("int") if generic else filenames.file_id_of(name)).alias("file_id"),
                file_dir.alias("file_dir"),
                name.alias("file_name"),
                "length",
                F.col("modificationTime").alias("mtime"),
                "path",
            )
        )
    files = reduce(DataFrame.unionByName, frames)
    if stream_type == "collector":
        open_file = F.col("file_name").endswith("_current") | F.col("file_name").endswith("_stats")
        files = files.filter(~open_file & F.col("file_minute").isNotNull())
        return time_range(files, start, stop, axis="file_minute")
    return time_range(files.filter(F.col("minute").isNotNull()), start, stop)


def _list_hours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            hour_dir = f"{row['base']}/{row['hour']}"
            prefix = storage.open_fs(hour_dir)[1]
            counts: dict[str, int] = {}
            for entry in storage.children(hour_dir, recursive=True):
                minute, *rest = entry.path[len(prefix) :].strip("/").split("/")
                if len(minute) != 2 or not minute.isdigit():
                    continue
                is_file = entry.type == fs.FileType.File
                visible = bool(rest) and not any(map(storage.hidden, rest))
                counts[minute] = counts.get(minute, 0) + (is_file and visible)
            rows += [
                {"cluster": row["cluster"], "dir": f"{row['hour']}/{minute}", "n_files": n}
                for minute, n in counts.items()
            ]
        yield pa.RecordBatch.from_pylist(rows, _DIR_SCHEMA)


def _hours_between(first: str, last: str) -> int:
    span = datetime.fromisoformat(last) - datetime.fromisoformat(first)
    return int(span.total_seconds() // 3600) + 1


def minute_dirs(
    spark: SparkSession,
    roots: layout.Roots,
    topic: str,
    stream_type: str = "local",
    start: datetime | None = None,
    stop: datetime | None = None,
) -> DataFrame:
    """Every minute directory that exists, also empty ones, with its file count.

    The driver only looks for the first and last minute, level by level. The
    hours between are spread over the executors, one listing per hour.
    """
    check_range(start, stop)
    bounds = []
    for cluster, root in layout.named_roots(roots, stream_type).items():
        base = layout.stream_dir(storage.qualify(spark, root), topic, stream_type)
        first, last = layout.edge_minute(base), layout.edge_minute(base, last=True)
        if first is None or last is None:
            continue
        first = max(first, layout.to_minute(start)) if start else first
        last = min(last, layout.to_minute(stop)) if stop else last
        if first <= last:
            bounds.append((cluster, base, first.isoformat(" "), last.isoformat(" ")))
    edges = spark.createDataFrame(bounds, "cluster string, base string, first string, last string")
    span = F.sequence(
        F.date_trunc("hour", F.col("first").cast("timestamp")),
        F.col("last").cast("timestamp"),
        F.expr("interval 1 hour"),
    )
    hours = edges.select("cluster", "base", F.explode(span).alias("hour")).select(
        "cluster", "base", F.date_format("hour", "yyyy/MM/dd/HH").alias("hour")
    )
    n_hours = sum(_hours_between(first, last) for _, _, first, last in bounds)
    tasks = max(1, min(n_hours // 16, 4 * spark.sparkContext.defaultParallelism))
    listed = hours.repartition(tasks, "cluster", "hour").mapInArrow(
        _list_hours, "cluster string, dir string, n_files long"
    )
    dirs = listed.select(
        F.lit(topic).alias("topic"),
        "cluster",
        F.try_to_timestamp("dir", F.lit(layout.MINUTE_DIR_FORMAT)).alias("minute"),
        "n_files",
    ).filter(F.col("minute").isNotNull())
    return time_range(dirs, start, stop)
