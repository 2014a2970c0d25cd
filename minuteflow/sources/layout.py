"""Directory layouts of streams and the paths that cover a time range."""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone

from minuteflow.sources import storage

# Fixed base directories of the stream types; a generic stream is its own root.
BASE_DIRS = {"collector": "data", "local": "streams_local", "merged": "streams", "generic": ""}
MINUTE_DIR_FORMAT = "yyyy/MM/dd/HH/mm"

Roots = str | list[str] | dict[str, str]


def stream_dir(root: str, topic: str, stream_type: str) -> str:
    base = BASE_DIRS[stream_type]
    return "/".join([root.rstrip("/"), base, topic]) if base else root.rstrip("/")


def named_roots(roots: Roots, stream_type: str) -> dict[str, str]:
    """Cluster name -> root directory; unnamed roots get ``cluster0, cluster1, ...``."""
    if isinstance(roots, str):
        roots = [roots]
    if not isinstance(roots, dict):
        roots = {f"cluster{i}": root for i, root in enumerate(roots)}
    if not roots:
        raise ValueError("at least one root directory is needed")
    if stream_type not in BASE_DIRS:
        raise ValueError(f"unknown stream type {stream_type}")
    if stream_type == "merged" and len(roots) > 1:
        raise ValueError("a merged stream has exactly one root directory")
    return roots


def to_minute(ts: datetime) -> datetime:
    """Truncate to the minute, as a naive UTC time."""
    if ts.tzinfo is not None:
        ts = ts.astimezone(timezone.utc).replace(tzinfo=None)
    return ts.replace(second=0, microsecond=0)


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def minute_path(minute: datetime) -> str:
    return minute.strftime("%Y/%m/%d/%H/%M")


def parse_minute_path(path: str) -> datetime:
    return datetime.strptime(path, "%Y/%m/%d/%H/%M")


def _next(ts: datetime, unit: str) -> datetime:
    if unit == "year":
        return ts.replace(year=ts.year + 1)
    if unit == "month":
        return ts.replace(year=ts.year + ts.month // 12, month=ts.month % 12 + 1)
    return ts + {"day": timedelta(1), "hour": timedelta(hours=1), "minute": timedelta(minutes=1)}[unit]


_UNITS = [
    ("year", "%Y", lambda t: (t.month, t.day, t.hour, t.minute) == (1, 1, 0, 0)),
    ("month", "%Y/%m", lambda t: (t.day, t.hour, t.minute) == (1, 0, 0)),
    ("day", "%Y/%m/%d", lambda t: (t.hour, t.minute) == (0, 0)),
    ("hour", "%Y/%m/%d/%H", lambda t: t.minute == 0),
    ("minute", "%Y/%m/%d/%H/%M", lambda t: True),
]


def covering_dirs(start: datetime, stop: datetime) -> list[str]:
    """The fewest directories that hold exactly the minutes start..stop.

    At most about 250 paths for any range, so only these are listed.
    """
    start, stop = to_minute(start), to_minute(stop)
    dirs = []
    while start <= stop:
        for unit, fmt, aligned in _UNITS:
            after = _next(start, unit) if aligned(start) else None
            if after is not None and after - timedelta(minutes=1) <= stop:
                dirs.append(start.strftime(fmt))
                start = after
                break
    return dirs


def range_path(base: str, start: datetime | None = None, stop: datetime | None = None) -> str:
    """A glob below ``base`` that matches only directories of the range.

    An open end is the stream's own first or last minute, not a date of the clock.
    """
    plain, base = base, re.sub(r"([{}\[\]*?\\])", r"\\\1", base)
    if start is None and stop is None:
        return base
    if start is None or stop is None:
        edge = edge_minute(plain, last=stop is None)
        if edge is None:
            return base
        # A range beyond the stream is one directory that isn't there.
        start, stop = (start, max(start, edge)) if stop is None else (min(edge, stop), stop)
    dirs = covering_dirs(start, stop)
    if not dirs:
        raise ValueError("the range holds no minute")
    return f"{base}/{{{','.join(dirs)}}}" if len(dirs) > 1 else f"{base}/{dirs[0]}"


def _edge(path: str, depth: int, last: bool) -> str | None:
    if depth == 0:
        return ""
    names = [n for n in storage.subdirs(path) if n.isdigit()]
    for name in reversed(names) if last else names:
        below = _edge(f"{path}/{name}", depth - 1, last)
        if below is not None:
            return f"{name}/{below}".rstrip("/")
    return None


def edge_minute(base: str, last: bool = False) -> datetime | None:
    """The first (or last) minute directory, found level by level."""
    path = _edge(base, 5, last)
    return parse_minute_path(path) if path else None
