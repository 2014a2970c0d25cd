"""Lines of one file as Arrow batches, for the streaming sources."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.compute as pc

from minuteflow.sources import storage

SCHEMA = (
    "topic string, cluster string, collector string, minute timestamp, file_dir string,"
    " file_name string, file_mtime timestamp, line_no long, value string"
)
_STAMP = pa.timestamp("us", "UTC")
BATCH_SCHEMA = pa.schema(
    [
        ("topic", pa.string()),
        ("cluster", pa.string()),
        ("collector", pa.string()),
        ("minute", _STAMP),
        ("file_dir", pa.string()),
        ("file_name", pa.string()),
        ("file_mtime", _STAMP),
        ("line_no", pa.int64()),
        ("value", pa.string()),
    ]
)
_CHUNK = 4 << 20


def file_lines(
    path: str, start: int = 0, stop: int | None = None, closed: bool = True
) -> Iterator[list[bytes]]:
    """Lines between two byte offsets of the uncompressed file.

    Offsets lie at line starts. The bytes after the last newline are a line of
    a ``closed`` file, and left out of one still being written. Compressed files
    are told by their extension and skipped forward by reading.
    """
    filesystem, inner = storage.open_fs(path)
    left = None if stop is None else stop - start
    if inner.endswith(".gz"):
        source = filesystem.open_input_stream(inner, compression="gzip")
        skip = start
        while skip > 0:
            got = len(source.read(min(skip, _CHUNK)))
            if not got:
                return
            skip -= got
    else:
        source = filesystem.open_input_file(inner)
        source.seek(start)
    rest = b""
    with source:
        while left is None or left > 0:
            chunk = source.read(_CHUNK if left is None else min(_CHUNK, left))
            if not chunk:
                break
            left = None if left is None else left - len(chunk)
            *lines, rest = (rest + chunk).split(b"\n")
            if lines:
                yield lines
    if rest and closed:
        yield [rest]


def count_lines(path: str, stop: int) -> int:
    """Newlines in the first ``stop`` bytes of the uncompressed file."""
    filesystem, inner = storage.open_fs(path)
    packed = "gzip" if inner.endswith(".gz") else None
    lines = 0
    with filesystem.open_input_stream(inner, compression=packed) as source:
        while stop > 0:
            chunk = source.read(min(stop, _CHUNK))
            if not chunk:
                break
            lines += chunk.count(b"\n")
            stop -= len(chunk)
    return lines


def stamp_of(mtime_ns: int) -> datetime:
    """A modification time in whole milliseconds, as Spark's readers give it."""
    return datetime.fromtimestamp(mtime_ns // 1_000_000 / 1000, timezone.utc)


def _texts(lines: list[bytes]) -> pa.Array:
    raw = pa.array(lines, pa.binary())
    try:
        texts = raw.cast(pa.string())
    except pa.ArrowInvalid:
        texts = pa.array([line.decode("utf-8", "replace") for line in lines], pa.string())
    return pc.utf8_rtrim(texts, characters="\r")


def line_batches(
    path: str,
    position: dict[str, object],
    start: int = 0,
    stop: int | None = None,
    closed: bool = True,
    before: int | None = None,
) -> Iterator[pa.RecordBatch]:
    """Batches of lines with the columns of ``position``, and their numbers from 1 in the file.

    ``before`` is the number of lines that lie before ``start``; without it the lines
    have no numbers. The generator returns the number of lines up to its end.
    """
    for lines in file_lines(path, start, stop, closed):
        n = len(lines)
        if before is None:
            numbers = pa.nulls(n, pa.int64())
        else:
            numbers = pa.array(range(before + 1, before + n + 1), pa.int64())
            before += n
        given = {"line_no": numbers, "value": _texts(lines)}
        columns = [
            given[field.name]
            if field.name in given
            else pa.repeat(pa.scalar(position.get(field.name), field.type), n)
            for field in BATCH_SCHEMA
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=BATCH_SCHEMA)
    return before


def next_line_start(path: str, offset: int, stop: int | None) -> int:
    """Offset of the first line that starts at or after ``offset``, ``stop`` or the end at most."""
    filesystem, inner = storage.open_fs(path)
    with filesystem.open_input_file(inner) as source:
        stop = source.size() if stop is None else stop
        source.seek(offset - 1)
        at = offset - 1
        while at < stop:
            chunk = source.read(65536)
            if not chunk:
                break
            found = chunk.find(b"\n")
            if found >= 0:
                return at + found + 1
            at += len(chunk)
    return stop


def last_newline(path: str, start: int) -> int:
    """Offset just after the last newline of a growing file, at least ``start``."""
    filesystem, inner = storage.open_fs(path)
    with filesystem.open_input_file(inner) as source:
        end = source.size()
        while end > start:
            begin = max(start, end - 65536)
            source.seek(begin)
            found = source.read(end - begin).rfind(b"\n")
            if found >= 0:
                return begin + found + 1
            end = begin
    return start
