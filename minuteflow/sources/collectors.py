"""Batch reads of collector directories, alone or stitched with committed files."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from minuteflow.operators.ranges import check_range, time_range
from minuteflow.session import require_utc, stored
from minuteflow.sources import layout, storage
from minuteflow.sources.listing import located_files
from minuteflow.sources.minutes import POSITION_COLUMNS, inner_path, path_below, read_minutes
from minuteflow.streaming.lines import file_lines, last_newline, next_line_start
from minuteflow.streaming.tail_source import committed_files

FILE_KEY = ["cluster", "collector", "file_minute", "file_id"]


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where the last whole line of each file ends now; a file that has moved ends at its length."""
    for batch in batches:
        ends = []
        for row in batch.select(["path", "length"]).to_pylist():
            try:
                ends.append(last_newline(row["path"], 0))
            except FileNotFoundError:
                ends.append(row["length"])
        yield batch.append_column("end", pa.array(ends, pa.int64()))


def in_flight_files(
    spark: SparkSession,
    roots: layout.Roots,
    topic: str,
    start: datetime | None = None,
    stop: datetime | None = None,
    where: Column | None = None,
) -> DataFrame:
    """A written table with one row per collector file that has a whole line.

    Files that ``where`` leaves out are listed, but not opened. The table holds the position columns and ``end``, the offset after the last newline.
    Whatever reads by this table reads the same lines, however the files grow.
    """
    require_utc(spark)
    named = layout.named_roots(roots, "collector")
    bases = {
        cluster: layout.stream_dir(storage.existing(spark, root), topic, "collector")
        for cluster, root in named.items()
    }
    below = F.lit(None).cast("string")
    root_of = F.lit(None).cast("string")
    for cluster, base in bases.items():
        here = F.col("cluster") == cluster
        inner = inner_path(base, encoded=False)
        below = F.when(here, path_below(F.col("path"), inner)).otherwise(below)
        root_of = F.when(here, F.lit(storage.qualify(spark, named[cluster]))).otherwise(root_of)
    listed = located_files(spark, roots, topic, "collector", start, stop)
    direct = F.concat_ws("/", "collector", "file_name") == below
    files = listed.filter(direct).select(
        "topic", "stream_type", "cluster", "collector", "minute", "file_minute", "file_id",
        "file_dir", "file_name", F.col("mtime").alias("file_mtime"), "path", "length",
        root_of.alias("root"),
    )
    files = files if where is None else files.filter(where)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema)
    ended = files.mapInArrow(_with_end, f"{kinds}, end long")
    return stored(ended.filter("end > 0"), "in_flight")


def _lines_in(path: str, begin: int, stop: int, end: int) -> Iterator[list[bytes]]:
    """Lines that start at ``begin`` or later and before ``stop``."""
    first = next_line_start(path, begin, end) if begin else 0
    last = next_line_start(path, stop, end) if stop < end else end
    if first < last:
        yield from file_lines(path, first, last, closed=False)


def _lines_of_copy(path: str, begin: int, stop: int, end: int) -> Iterator[list[bytes]]:
    """The same lines of a copy that may be compressed, by reading up to them."""
    at = 0
    for lines in file_lines(path, 0, end, closed=False):
        inside = []
        for line in lines:
            if begin <= at < stop:
                inside.append(line)
            at += len(line) + 1
        if inside:
            yield inside
        if at >= stop:
            return


def _range_lines(row: dict, stop: int) -> Iterator[list[bytes]]:
    started = False
    try:
        for lines in _lines_in(row["path"], row["begin"], stop, row["end"]):
            started = True
            yield lines
    except FileNotFoundError:
        if started:
            raise
        # Committed since the files were listed: same bytes, other place.
        moved = committed_files(row["root"], row["topic"], row["file_minute"].replace(tzinfo=None))
        place = moved.get(row["collector"], {}).get(row["file_name"])
        if place is None:
            raise
        yield from _lines_of_copy(place[0], row["begin"], stop, row["end"])


def _scan(files: DataFrame) -> DataFrame:
    """Lines of ``in_flight_files``, by ranges of about a split's size."""
    spark = files.sparkSession
    size = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    total = files.agg(F.sum("end")).first()[0] or 0
    tasks = max(2 * spark.sparkContext.defaultParallelism, -(-total // size))
    zero, step = F.lit(0).cast("long"), F.lit(size).cast("long")
    ranges = (
        files.withColumn("begin", F.explode(F.sequence(zero, F.col("end") - 1, step)))
        .withColumns({"file_path": F.col("path"), "split_start": F.col("begin")})
        .repartition(tasks)
    )
    kinds = ", ".join(
        f"`{c}` {ranges.schema[c].dataType.simpleString()}" for c in POSITION_COLUMNS
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, row in enumerate(batch.to_pylist()):
                for lines in _range_lines(row, min(row["begin"] + size, row["end"])):
                    values = [x.decode("utf-8", "replace").rstrip("\r") for x in lines]
                    same = [pa.repeat(batch.column(c)[k], len(values)) for c in POSITION_COLUMNS]
                    yield pa.RecordBatch.from_arrays(
                        [*same, pa.array(values, pa.string())], names=[*POSITION_COLUMNS, "value"]
                    )

    return ranges.mapInArrow(read, f"{kinds}, value string")


def read_collectors(
    spark: SparkSession,
    roots: layout.Roots,
    topic: str,
    start: datetime | None = None,
    stop: datetime | None = None,
) -> DataFrame:
    """Lines of ``<root>/data/<topic>/<collector>/<file>``; time is the file-name minute.

    The end of every file is fixed when this is called, after its last whole line.
    """
    check_range(start, stop)
    return _scan(in_flight_files(spark, roots, topic, start, stop))


def read_stitched(
    spark: SparkSession,
    roots: layout.Roots,
    topic: str,
    local: bool = True,
    start: datetime | None = None,
    stop: datetime | None = None,
    where: Column | None = None,
    committed_from: datetime | None = None,
) -> DataFrame:
    """Collector files and their committed copies, each file once.

    Collector files are listed first, committed ones second, and a file in both
    lists is read from its committed copy. One that is moved later is followed to
    its copy when it is read. ``where`` leaves out files, by the columns of ``FILE_KEY``, before
    they are opened. Minute directories before ``committed_from`` are not even listed.
    """
    check_range(start, stop)
    files = in_flight_files(spark, roots, topic, start, stop, where)
    if not local:
        return _scan(files)
    # A file is committed to its own minute or a later one, so only the lower
    # bound can prune directories; the file-name minute decides.
    lowest = max(filter(None, [start, committed_from]), default=None)
    committed = read_minutes(spark, roots, topic, "local", start=lowest)
    committed = time_range(committed, start, stop, axis="file_minute")
    committed = committed if where is None else committed.filter(where)
    columns = [*POSITION_COLUMNS, "value"]
    oldest = files.agg(F.date_format(F.min("file_minute"), "yyyy-MM-dd HH:mm")).first()[0]
    if oldest is None:
        return committed.select(*columns)
    # Copies lie in minutes not before their file's. They are asked of the scan
    # itself, so the scan and this list can't differ.
    recent = committed.filter(F.col("minute") >= F.lit(oldest).cast("timestamp"))
    copies = recent.select(*FILE_KEY).distinct()
    waiting = stored(files.join(copies, FILE_KEY, "left_anti"), "waiting")
    return committed.select(*columns).unionByName(_scan(waiting).select(*columns))
