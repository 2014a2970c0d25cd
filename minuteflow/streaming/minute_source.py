"""Streaming source ``minutes``: complete minutes of a stream, in order."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from minuteflow.functions import codec, filenames
from minuteflow.operators.ranges import parse_group
from minuteflow.sources import layout, storage
from minuteflow.streaming.lines import (
    SCHEMA, count_lines, line_batches, next_line_start, stamp_of,
)

_ONE = timedelta(minutes=1)
MAX_PARTITION_BYTES = 128 << 20
MAX_TASKS = 256
_HOURS_AT_ONCE = 64


@dataclass
class MinuteRun(InputPartition):
    """A run of minutes of one cluster, or one of several parts of a single minute."""

    cluster: str
    first: str
    last: str
    part: int = 0
    parts: int = 1


@dataclass
class FileRange:
    """Lines that start between two byte offsets of a file; the last range ends with it."""

    folder: str
    name: str
    path: str
    mtime_ns: int
    start: int
    stop: int
    last: bool


def _ranges(file: FileRange) -> list[FileRange]:
    """A large uncompressed file in ranges of the partition size, found without opening it."""
    if file.path.endswith(".gz") or file.stop <= MAX_PARTITION_BYTES:
        return [file]
    starts = range(0, file.stop, MAX_PARTITION_BYTES)
    return [
        replace(file, start=s, stop=min(s + MAX_PARTITION_BYTES, file.stop), last=s == starts[-1])
        for s in starts
    ]


def _share(ranges: list[FileRange], part: int, parts: int) -> list[FileRange]:
    """The ranges whose middle byte lies in one of ``parts`` equal stretches of the minute.

    Every task of a minute works this out from the same listing, so each range has one task.
    """
    total = sum(r.stop - r.start for r in ranges)
    taken, at = [], 0
    for r in ranges:
        size = r.stop - r.start
        if (2 * at + size) * parts // max(2 * total, 1) in (part, part + (part == parts - 1)):
            taken.append(r)
        at += size
    return taken


class MinuteReader(DataSourceStreamReader):
    """Offsets are the last minute emitted per cluster.

    A minute is complete once the next minute directory exists. A restart
    replays the last offset through ``partitions``, which brings the cursor back.
    The driver lists hours, to see which minutes are there; the files of a minute
    are listed, ordered and shared out in the tasks that read them, since nothing
    is added to a complete minute.
    """

    def __init__(self, options: dict[str, str]) -> None:
        self.topic = options["topic"]
        self.stream_type = options.get("streamtype", "local")
        self.roots = json.loads(options["roots"])
        self.start = options.get("start")
        self.stop = options.get("stop")
        self.limit = int(options.get("maxminutesperbatch", 0))
        self.tasks = int(options.get("tasks", 32))
        self.numbered = options.get("linenumbers", "true").lower() == "true"
        self.group = parse_group(options["group"]) if options.get("group") else None
        self.cursor: dict[str, str] | None = None

    def _base(self, cluster: str) -> str:
        return layout.stream_dir(self.roots[cluster], self.topic, self.stream_type)

    def initialOffset(self) -> dict:
        before = ""
        if self.start:
            first = layout.to_minute(datetime.fromisoformat(self.start))
            before = layout.minute_path(first - _ONE)
        self.cursor = {cluster: before for cluster in self.roots}
        return dict(self.cursor)

    def _advance(self, cluster: str, done: str) -> str:
        """The furthest minute reachable without a gap after ``done``."""
        base = self._base(cluster)
        last = layout.edge_minute(base, last=True)
        if last is None:
            return done
        if self.stop:
            last = min(last, layout.to_minute(datetime.fromisoformat(self.stop)) + _ONE)
        if done:
            minute = layout.parse_minute_path(done) + _ONE
        else:
            minute = layout.edge_minute(base)
        emitted, taken = done, 0
        present: dict[datetime, set[str]] = {}
        ahead = min(self.limit // 60 + 2, _HOURS_AT_ONCE) if self.limit else _HOURS_AT_ONCE

        def there(ts: datetime) -> bool:
            hour = ts.replace(minute=0)
            if hour not in present:
                end = min(hour + (ahead - 1) * timedelta(hours=1), last.replace(minute=0))
                n = (end - hour) // timedelta(hours=1) + 1
                hours = [hour + i * timedelta(hours=1) for i in range(max(n, 1))]
                paths = [f"{base}/{h:%Y/%m/%d/%H}" for h in hours]
                with ThreadPoolExecutor(32) as pool:
                    present.update(zip(hours, map(set, pool.map(storage.subdirs, paths))))
            return ts.strftime("%M") in present[hour]

        # Minutes before the first directory are skipped; from there on the
        # first missing minute ends the run.
        while minute < last and not (self.limit and taken == self.limit):
            if there(minute):
                if not there(minute + _ONE):
                    break
                emitted, taken = layout.minute_path(minute), taken + 1
            minute += _ONE
        return emitted

    def latestOffset(self) -> dict:
        if self.cursor is None:
            self.initialOffset()
        return {cluster: self._advance(cluster, done) for cluster, done in self.cursor.items()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.cursor = dict(end)
        wanted: dict[str, list[datetime]] = {}
        for cluster, done in end.items():
            begun = start.get(cluster, "")
            if not done or done <= begun:
                continue
            if begun:
                minute = layout.parse_minute_path(begun) + _ONE
            else:
                minute = layout.edge_minute(self._base(cluster))
            wanted[cluster] = self._minutes(minute, layout.parse_minute_path(done))
        n = sum(map(len, wanted.values()))
        run, parts = -(-n // self.tasks), self.tasks // max(n, 1)
        return [
            MinuteRun(
                cluster,
                layout.minute_path(minutes[i]),
                layout.minute_path(minutes[i : i + run][-1]),
                part,
                max(parts, 1),
            )
            for cluster, minutes in wanted.items()
            for i in range(0, len(minutes), run)
            for part in range(max(parts, 1))
        ]

    def _minutes(self, minute: datetime, last: datetime) -> list[datetime]:
        span = (last - minute) // _ONE + 1
        return [m for m in (minute + i * _ONE for i in range(span)) if self._owned(m)]

    def _owned(self, minute: datetime) -> bool:
        if not self.group:
            return True
        number, total = self.group
        return minute.minute % total == number - 1

    def _files(self, cluster: str, minute: str) -> list[FileRange]:
        """Files of a minute in stream order: directory, modification time, name."""
        base = self._base(cluster)
        prefix = storage.open_fs(base)[1]
        files = []
        for entry in storage.children(f"{base}/{minute}", recursive=True):
            inner = entry.path[len(prefix) :].strip("/")
            below = inner[len(minute) :].strip("/").split("/")
            if entry.type != fs.FileType.File or any(map(storage.hidden, below)):
                continue
            folder, path = inner.rpartition("/")[0], f"{base}/{inner}"
            file = FileRange(folder, entry.base_name, path, entry.mtime_ns, 0, entry.size, True)
            files.append(((folder, stamp_of(entry.mtime_ns), entry.base_name), file))
        return [file for _, file in sorted(files, key=lambda f: f[0])]

    def read(self, partition: MinuteRun) -> Iterator[pa.RecordBatch]:
        first, last = map(layout.parse_minute_path, (partition.first, partition.last))
        for minute in self._minutes(first, last):
            files = self._files(partition.cluster, layout.minute_path(minute))
            ranges = [r for file in files for r in _ranges(file)]
            if partition.parts > 1:
                ranges = _share(ranges, partition.part, partition.parts)
            yield from self._lines(ranges, partition.cluster, minute)

    def _lines(
        self, ranges: list[FileRange], cluster: str, minute: datetime
    ) -> Iterator[pa.RecordBatch]:
        end, lines = None, None
        for r in ranges:
            whole = r.start == 0 and r.last
            begin = next_line_start(r.path, r.start, None) if r.start else 0
            stop = None if r.last else next_line_start(r.path, r.stop, None)
            # Lines before a range are counted, unless this task has just read them.
            if end != (r.path, begin):
                lines = count_lines(r.path, begin) if self.numbered and not whole else 0
            position = {
                "topic": self.topic,
                "cluster": cluster,
                "minute": minute.replace(tzinfo=timezone.utc),
                "file_dir": r.folder,
                "file_name": r.name,
                "file_mtime": stamp_of(r.mtime_ns),
            }
            before = lines if self.numbered else None
            lines = yield from line_batches(r.path, position, begin, stop, before=before)
            end = (r.path, stop)


class MinuteSource(DataSource):
    """``spark.readStream.format("minutes")``.

    Options: ``topic``, ``roots`` (JSON object cluster -> root), ``streamType``,
    ``start``, ``stop`` (ISO times), ``group`` (k/n), ``maxMinutesPerBatch``, ``tasks``
    (tasks of a batch, about), ``lineNumbers`` (default true; the numbers of a file
    longer than 128 MB cost another look at what lies before each part of it).
    """

    @classmethod
    def name(cls) -> str:
        return "minutes"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return MinuteReader(self.options)


def drain_minutes(start: Callable[[], StreamingQuery]) -> int:
    """Run until no complete minute is left, and return the number of runs.

    ``start`` starts the query with ``availableNow`` on a checkpoint of its own.
    With ``maxMinutesPerBatch`` one such run ends after a batch, so runs are repeated
    until the offset stands still.
    """
    runs, last = 0, None
    while True:
        query = start()
        query.awaitTermination()
        progress = query.lastProgress
        offset = progress["sources"][0]["endOffset"] if progress else last
        if offset == last:
            return runs
        runs, last = runs + 1, offset


def stream_minutes(
    spark: SparkSession,
    roots: layout.Roots,
    topic: str,
    stream_type: str = "local",
    fmt: str = "base64",
    **options,
) -> DataFrame:
    """Stream the messages of a topic, one complete minute after the other.

    Rows carry the positions a batch read has, ``line_no`` too, so a checkpoint can be
    built from them. ``fmt`` is ``base64`` for messages or ``text`` for plain lines,
    which come as ``value``.
    """
    if fmt not in ("base64", "text"):
        raise ValueError(f"unknown record format {fmt}")
    spark.dataSource.register(MinuteSource)
    named = {
        cluster: storage.qualify(spark, root)
        for cluster, root in layout.named_roots(roots, stream_type).items()
    }
    # More tasks than that would only list the same minute over and over.
    options.setdefault("tasks", min(spark.sparkContext.defaultParallelism, MAX_TASKS))
    reader = spark.readStream.format("minutes").options(
        topic=topic, streamType=stream_type, roots=json.dumps(named), **options
    )
    rows, name = reader.load().withColumn("stream_type", F.lit(stream_type)), F.col("file_name")
    if stream_type == "generic":
        named_by = {"file_minute": F.lit(None).cast("timestamp"), "file_id": F.lit(None).cast("int")}
    else:
        named_by = {
            "collector": filenames.collector_of(name, topic),
            "file_minute": filenames.file_minute_of(name),
            "file_id": filenames.file_id_of(name),
        }
    rows = rows.withColumns(named_by)
    return rows if fmt == "text" else codec.strip_header(codec.decode_lines(rows).drop("value"))
