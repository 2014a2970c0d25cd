"""Streaming source ``collector_tail``: files that collectors are still writing.

A position is (file, byte offset just after the last newline) per collector, in
bytes of the uncompressed file. It stays valid when the file is committed, so a
file that moves between two batches goes on at the same byte.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from minuteflow.functions import codec, filenames
from minuteflow.sources import layout, storage
from minuteflow.streaming.lines import (
    SCHEMA, count_lines, file_lines, last_newline, line_batches, next_line_start, stamp_of,
)

WHOLE = -1
MAX_SPLIT_BYTES = 128 << 20
_HOUR = timedelta(hours=1)
# The newest minute directory at a listing, kept in place of a collector.
LISTED = ""

# File name -> (path, size, modification time).
Files = dict[str, tuple[str, int, int]]

# Fixed format of collector file names, without and with the committed ending.
_NAME = re.compile(r"-(\d{4}-\d{2}-\d{2}-\d{2}-\d{2})_(\d+)$")


def file_order(name: str) -> tuple[datetime, int] | None:
    """(minute, id) of a collector file name; None for other names."""
    match = _NAME.search(name)
    if match is None:
        return None
    try:
        return datetime.strptime(match[1], "%Y-%m-%d-%H-%M"), int(match[2])
    except ValueError:
        return None


def in_flight_files(root: str, topic: str, collector: str) -> Files:
    """The files in a collector directory."""
    folder = f"{layout.stream_dir(root, topic, 'collector')}/{collector}"
    return {
        e.base_name: (f"{folder}/{e.base_name}", e.size, e.mtime_ns)
        for e in storage.children(folder)
        if e.type == fs.FileType.File and file_order(e.base_name) is not None
    }


def committed_files(root: str, topic: str, since: datetime) -> dict[str, Files]:
    """Collector -> its committed files in minute directories from the hour of ``since``."""
    base = layout.stream_dir(root, topic, "local")
    first, last = layout.edge_minute(base), layout.edge_minute(base, last=True)
    found: dict[str, Files] = {}
    if first is None or last is None:
        return found
    hour = max(first, since).replace(minute=0)
    n_hours = max((last - hour) // _HOUR + 1, 0)
    folders = [f"{base}/{hour + i * _HOUR:%Y/%m/%d/%H}" for i in range(n_hours)]
    marker = f"-{topic}-"
    scheme = base[: len(base) - len(storage.open_fs(base)[1])]
    with ThreadPoolExecutor(32) as pool:
        for entries in pool.map(lambda f: storage.children(f, recursive=True), folders):
            for entry in entries:
                stem = entry.base_name.removesuffix(".gz")
                if entry.type != fs.FileType.File or file_order(stem) is None:
                    continue
                prefix = stem[: _NAME.search(stem).start() + 1]
                if prefix.endswith(marker) and len(prefix) > len(marker):
                    collector = prefix[: -len(marker)]
                    name = stem[len(collector) + 1 :]
                    place = (scheme + entry.path, entry.size, entry.mtime_ns)
                    found.setdefault(collector, {})[name] = place
    return found


@dataclass
class FileRange(InputPartition):
    """Lines that start between two byte offsets of one file; ``stop`` -1 means its end.

    Ends inside a file's new bytes are ``cut`` by size: the task moves them to line starts.
    """

    cluster: str
    collector: str
    name: str
    path: str
    mtime_ns: int
    start: int
    stop: int
    cut_start: bool = False
    cut_stop: bool = False


class TailReader(DataSourceStreamReader):
    """Offsets are a position per collector, and per cluster how far minutes were listed.

    A file that was not committed when minutes were listed is committed to the newest minute
    directory of then or a later one. So only directories from that one on are listed
    again, whichever collectors are still alive.
    """

    def __init__(self, options: dict[str, str]) -> None:
        self.topic = options["topic"]
        self.roots = json.loads(options["roots"])
        self.local = options.get("local", "true").lower() == "true"
        self.numbered = options.get("linenumbers", "true").lower() == "true"
        self.limit = int(options.get("maxfilespercollector", 0))
        start, stop = options.get("start"), options.get("stop")
        self.since = layout.to_minute(datetime.fromisoformat(start)) if start else datetime.min
        self.until = layout.to_minute(datetime.fromisoformat(stop)) if stop else datetime.max
        self.cursor: dict[str, list] | None = None
        self.listed: dict[str, datetime] = {}

    def initialOffset(self) -> dict:
        self.cursor = {}
        return {}

    def _listing(self, cluster: str, since: datetime) -> dict[str, Files]:
        """Collector -> files. New collector directories appear here by themselves.

        A file in both places is taken from its committed copy.
        """
        root = self.roots[cluster]
        folder = layout.stream_dir(root, self.topic, "collector")
        collectors = storage.subdirs(folder)
        with ThreadPoolExecutor(32) as pool:
            found = pool.map(lambda c: in_flight_files(root, self.topic, c), collectors)
            files = dict(zip(collectors, found))
        if self.local:
            for collector, names in committed_files(root, self.topic, since).items():
                files.setdefault(collector, {}).update(names)
        return {
            collector: {
                n: p for n, p in names.items() if self.since <= file_order(n)[0] <= self.until
            }
            for collector, names in files.items()
        }

    def _positions(self, offset: dict, cluster: str) -> tuple[dict[str, list], datetime]:
        """Positions of a cluster's collectors, and the minute from which to list."""
        prefix = f"{cluster}/"
        known = {k[len(prefix) :]: v for k, v in offset.items() if k.startswith(prefix)}
        listed = known.pop(LISTED, None)
        since = layout.parse_minute_path(listed) if listed else datetime.min
        return known, max(since, self.since)

    def latestOffset(self) -> dict:
        if self.cursor is None:
            self.initialOffset()
        offset = dict(self.cursor)
        for cluster, root in self.roots.items():
            known, since = self._positions(self.cursor, cluster)
            since = max(since, self.listed.get(cluster, since))
            base = layout.stream_dir(root, self.topic, "local")
            edge = layout.edge_minute(base, last=True) if self.local else None
            listing = self._listing(cluster, since)
            with ThreadPoolExecutor(32) as pool:
                ends = list(pool.map(lambda c: self._end(listing[c], known.get(c)), listing))
            moved = {f"{cluster}/{c}": end for c, (end, _) in zip(listing, ends) if end}
            offset.update(moved)
            # Files that are left for a later batch have to be listed again.
            if edge is not None and all(whole for _, whole in ends):
                self.listed[cluster] = max(edge, since)
                if moved:
                    offset[f"{cluster}/{LISTED}"] = layout.minute_path(self.listed[cluster])
        return offset

    def _end(self, files: Files, known: list | None) -> tuple[list | None, bool]:
        """A collector's new position, if it has one, and whether no file is left beyond it."""
        done, at = known or [None, 0]
        if done is not None:
            files = {n: f for n, f in files.items() if file_order(n) >= file_order(done)}
        names = sorted(files, key=file_order)
        if not names:
            return None, True
        taken = [n for n in names if n != done][: self.limit] if self.limit else names
        name = taken[-1] if taken else names[-1]
        last = name == names[-1]
        begun = at if name == done else 0
        if begun == WHOLE:
            return None, last
        path = files[name][0]
        end = last_newline(path, begun) if last and not path.endswith(".gz") else WHOLE
        new = [name, end] if (end != 0 or done is not None) and [name, end] != known else None
        return new, last

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.cursor = dict(end)
        parts: list[InputPartition] = []
        for cluster in self.roots:
            begun, since = self._positions(start, cluster)
            ended, _ = self._positions(end, cluster)
            changed = {c: v for c, v in ended.items() if begun.get(c) != v}
            if not changed:
                continue
            listing = self._listing(cluster, since)
            for collector, (last, stop) in changed.items():
                first, at = begun.get(collector, [None, 0])
                files = listing.get(collector, {})
                for name in sorted(files, key=file_order):
                    order = file_order(name)
                    if order > file_order(last) or (first and order < file_order(first)):
                        continue
                    from_byte = at if name == first else 0
                    to_byte = stop if name == last else WHOLE
                    if from_byte != WHOLE and from_byte != to_byte:
                        parts += _split(cluster, collector, name, files[name], from_byte, to_byte)
        return parts

    def read(self, partition: FileRange) -> Iterator[pa.RecordBatch]:
        path, start, stop = partition.path, partition.start, partition.stop
        minute = file_order(partition.name)[0]
        if not storage.exists(path):
            # Committed after this batch was planned: same bytes, other place.
            moved = committed_files(self.roots[partition.cluster], self.topic, minute)
            path = moved[partition.collector][partition.name][0]
        packed = path.endswith(".gz")
        if partition.cut_start:
            start = _cut(path, start, packed)
        if partition.cut_stop:
            stop = _cut(path, stop, packed)
        position = {
            "topic": self.topic,
            "cluster": partition.cluster,
            "collector": partition.collector,
            "minute": minute.replace(tzinfo=timezone.utc),
            "file_name": partition.name,
            "file_mtime": stamp_of(partition.mtime_ns),
        }
        before = count_lines(path, start) if self.numbered else None
        yield from line_batches(
            path, position, start, None if stop == WHOLE else stop, closed=False, before=before
        )


def _cut(path: str, offset: int, packed: bool) -> int:
    """The first line start at or after an offset, also of a file that was compressed meanwhile."""
    if not packed:
        return next_line_start(path, offset, None)
    at = offset - 1
    for lines in file_lines(path, at, closed=False):
        return at + len(lines[0]) + 1
    return offset


def _split(
    cluster: str, collector: str, name: str, file: tuple[str, int, int], start: int, stop: int
) -> list[FileRange]:
    """Ranges of the split size of a long uncompressed stretch, so it spreads over tasks."""
    path, size, mtime = file
    end = size if stop == WHOLE else stop
    if path.endswith(".gz") or end - start <= MAX_SPLIT_BYTES:
        return [FileRange(cluster, collector, name, path, mtime, start, stop)]
    cuts = [*range(start, end, MAX_SPLIT_BYTES)]
    return [
        FileRange(
            cluster, collector, name, path, mtime, cut,
            stop if cut == cuts[-1] else cut + MAX_SPLIT_BYTES,
            cut_start=cut != start, cut_stop=cut != cuts[-1],
        )
        for cut in cuts
    ]


class TailSource(DataSource):
    """``spark.readStream.format("collector_tail")``.

    Options: ``topic``, ``roots`` (JSON object cluster -> root), ``local``
    (follow files into the committed stream, default true), ``start``, ``stop`` (ISO times of
    file minutes, both inclusive), ``maxFilesPerCollector`` (files a batch begins, of each
    collector), ``lineNumbers`` (default true; the lines before a position are counted again
    in the file it lies in).
    """

    @classmethod
    def name(cls) -> str:
        return "collector_tail"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return TailReader(self.options)


def stream_collectors(
    spark: SparkSession, roots: layout.Roots, topic: str, **options
) -> DataFrame:
    """Stream the messages of collector files while they grow, move and rotate.

    Rows carry the positions of a batch read, so a checkpoint can be built from them.
    """
    spark.dataSource.register(TailSource)
    named = {
        cluster: storage.qualify(spark, root)
        for cluster, root in layout.named_roots(roots, "collector").items()
    }
    reader = spark.readStream.format("collector_tail").options(
        topic=topic, roots=json.dumps(named), **options
    )
    rows = reader.load().withColumns(
        {
            "stream_type": F.lit("collector"),
            "file_minute": filenames.file_minute_of(F.col("file_name")),
            "file_id": filenames.file_id_of(F.col("file_name")),
        }
    )
    return codec.strip_header(codec.decode_lines(rows).drop("value"))
