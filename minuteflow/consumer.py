"""A consumer: reads what is new since its last mark, as DataFrames.

It puts the operators together: start position, range, complete minutes,
group, line numbers, resume and checkpoint store.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from minuteflow.operators import checkpoint as cp
from minuteflow.operators import metrics, ranges
from minuteflow.operators.positions import consume, partition_key, with_positions
from minuteflow.session import broadcast_if_small, stored
from minuteflow.sources import layout, oplog, storage
from minuteflow.sources.collectors import read_stitched
from minuteflow.sources.listing import list_files, minute_dirs
from minuteflow.sources.minutes import decode_messages, read_minutes


_TEXT = "yyyy-MM-dd HH:mm:ss"


@dataclass(frozen=True)
class _Plan:
    """What a read starts from: start minute, minutes with files, last complete minutes."""

    begin: datetime | None
    minutes: DataFrame | None
    bounds: dict[str, datetime | None]


@dataclass
class Consumer:
    """One member of a consumer group on one topic.

    Members of a group share ``name`` and ``store``, a folder or any :class:`cp.CheckpointStore`.
    Each sees and marks the positions of its own minutes of the hour alone, so members may
    mark and restart in any order, and a group may be given another number of members.

    ``stream_type``: ``local``, ``merged`` or ``generic`` minute directories,
    ``stitched`` collector and committed files, or ``collector`` files alone.
    The start is the stored checkpoint, else ``relative_minutes``, else
    ``start``, else ``start_of_stream``.

    ``log`` is a folder for counts of what the consumer did (see :func:`oplog.consumed_log`): messages
    are counted when they are marked, resets when they are asked for, and a marked read without
    messages is a timeout.

    ``fmt`` is ``base64`` for messages, or ``text`` for plain lines, which come as ``value``.
    """

    spark: SparkSession
    topic: str
    name: str
    roots: layout.Roots
    store: str | cp.CheckpointStore
    stream_type: str = "local"
    group: str = "1/1"
    start: datetime | None = None
    relative_minutes: int | None = None
    retention_hours: int | None = None
    start_of_stream: bool = False
    stop: datetime | None = None
    now: datetime | None = None
    log: str | None = None
    fmt: str = "base64"
    _checkpoint: DataFrame | None = field(default=None, init=False)
    _taken: DataFrame | None = field(default=None, init=False)
    _since: datetime | None = field(default=None, init=False)
    # Of stitched streams: last minute directories before a read, and those of the last mark.
    _seen: dict[str, datetime] = field(default_factory=dict, init=False)
    _listed: dict[str, datetime] = field(default_factory=dict, init=False)

    def __post_init__(self) -> None:
        layout.named_roots(self.roots, self._directory_type)
        ranges.parse_group(self.group)
        if self.fmt not in ("base64", "text"):
            raise ValueError(f"unknown record format {self.fmt}")
        self._load()

    @property
    def _by_minute(self) -> bool:
        return self.stream_type not in ("collector", "stitched")

    @property
    def _directory_type(self) -> str:
        return "collector" if self.stream_type == "stitched" else self.stream_type

    def reset(self) -> None:
        """Go back to the last mark: the next read delivers from there again."""
        self._load()
        if self.log is not None:
            self._write_log(f"reset-{uuid.uuid4().hex}", {"RESET": 1})

    def _write_log(self, entry: str, kinds: dict[str, int]) -> None:
        oplog.log_consumption(self.spark, self.log, entry, self.topic, self.name, kinds)

    def _load(self) -> None:
        marks = cp.load_checkpoint(self.spark, self.store, self.name, self.topic)
        if marks is not None and self._by_minute:
            marks = cp.owned_positions(marks, self.group)
            # Positions of other members alone are none of ours.
            marks = None if marks.isEmpty() else marks
        elif marks is not None:
            self._listed = cp.listed_until(marks)
            marks = marks.filter(F.col("collector") != cp.LISTED)
        self._checkpoint = marks
        self._taken = None

    def _last_minutes(self) -> dict[str, datetime]:
        """Cluster -> its last minute directory now. Whatever is committed later lies there or beyond."""
        last = {}
        for cluster, root in layout.named_roots(self.roots, "collector").items():
            base = layout.stream_dir(storage.qualify(self.spark, root), self.topic, "local")
            last[cluster] = layout.edge_minute(base, last=True)
        return {cluster: minute for cluster, minute in last.items() if minute is not None}

    def _committed_from(self) -> datetime | None:
        """Before this minute every committed file was read, in all clusters."""
        names = layout.named_roots(self.roots, "collector")
        if self.stream_type != "stitched" or not set(names) <= set(self._listed):
            return None
        return min(self._listed[name] for name in names)

    def _files(self, kind: str) -> DataFrame:
        first = self._committed_from() if kind == "local" and not self._by_minute else None
        return list_files(self.spark, self.roots, self.topic, kind, first)

    def _clusters(self) -> DataFrame:
        names = [(name,) for name in layout.named_roots(self.roots, self._directory_type)]
        return self.spark.createDataFrame(names, "cluster string")

    def _begin(self) -> tuple[datetime | None, bool]:
        """Start minute of partitions without checkpoint, and if some begin at stream start.

        Collectors come and go, so one without a position may always appear.
        """
        options = (self.relative_minutes, self.retention_hours, self.start)
        timed = any(option is not None for option in options)
        starts = ranges.resolve_start(
            self._clusters(),
            self._checkpoint if self._by_minute or not timed else None,
            now=self.now,
            relative_minutes=self.relative_minutes,
            retention_hours=self.retention_hours,
            start=self.start,
            start_of_stream=self.start_of_stream,
            stop=self.stop,
        )
        begin, whole = starts.agg(
            F.date_format(F.min("start_minute"), _TEXT), F.bool_or(F.col("start_kind") == "stream")
        ).first()
        whole = bool(whole) or not (self._by_minute or timed)
        return datetime.fromisoformat(begin) if begin else None, whole

    def _least(self) -> datetime | None:
        if self._checkpoint is None:
            return None
        least = self._checkpoint.agg(F.date_format(F.min("minute"), _TEXT)).first()[0]
        return datetime.fromisoformat(least) if least else None

    def _plan(self, limited: bool) -> _Plan:
        begin, whole = self._begin()
        earliest = min(filter(None, [self._least(), begin]), default=None)
        self._since = None if whole else earliest
        if not self._by_minute:
            kinds = ["collector", "local"] if self.stream_type == "stitched" else ["collector"]
            self._seen = self._last_minutes() if self.stream_type == "stitched" else {}
            if not limited:
                return _Plan(begin, None, {})
            files = [self._files(kind) for kind in kinds]
            used = reduce(DataFrame.unionByName, files).select(F.col("file_minute").alias("minute"))
            return _Plan(begin, stored(used.distinct(), "minutes"), {})
        until = self.stop + timedelta(minutes=1) if self.stop else None
        dirs = minute_dirs(
            self.spark, self.roots, self.topic, self.stream_type, self._since, until
        )
        dirs = stored(dirs, "minutes")
        bounds = ranges.read_bounds(dirs)
        used = ranges.consumer_group(ranges.gate(dirs, bounds), self.group)
        return _Plan(begin, used.filter(F.col("n_files") > 0).select("minute").distinct(), bounds)

    def _unread(self, plan: _Plan, until: datetime | None) -> DataFrame:
        """Unread lines with positions, of minutes up to ``until``."""
        on = partition_key(self.stream_type)
        unread = None
        if self._checkpoint is not None:
            unread = cp.unread_files(self._checkpoint, self.stream_type)
        if self._by_minute:
            lines = read_minutes(
                self.spark, self.roots, self.topic, self.stream_type,
                start=self._since, stop=until, group=self.group,
            )
            lines = lines if unread is None else lines.filter(unread)
            lines, axis = ranges.gate(lines, plan.bounds), "minute"
        else:
            local = self.stream_type == "stitched"
            lines, axis = read_stitched(
                self.spark, self.roots, self.topic, local, self._since, until,
                where=unread, committed_from=self._committed_from(),
            ), "file_minute"
        lines = with_positions(lines)
        if self._checkpoint is None:
            return ranges.time_range(lines, plan.begin, None, axis)
        left = cp.resume(lines, self._checkpoint, self.stream_type)
        if plan.begin is None:
            return left
        # Partitions without a checkpoint start at ``begin``; the others ignore it.
        known = self._checkpoint.select(*on, F.lit(True).alias("_known")).distinct()
        left = left.join(broadcast_if_small(known), on, "left")
        keep = F.col("_known") | (F.col(axis) >= ranges.minute_literal(plan.begin))
        return left.filter(keep).drop("_known")

    def read(self, max_messages: int | None = None) -> DataFrame:
        """The next messages: all that can be read now, or the first ``max_messages``.

        A limited read looks at the first minute that has files, then at four
        times as many, until the messages suffice. It never opens later files.
        """
        plan = self._plan(max_messages is not None)
        if max_messages is None:
            lines = self._unread(plan, self.stop)
        else:
            lines = self._first(plan, max_messages)
        if max_messages is not None or self.stop is not None:
            self._seen = {}  # something older may be left
        self._taken = lines
        return lines if self.fmt == "text" else decode_messages(lines)

    def _first(self, plan: _Plan, max_messages: int) -> DataFrame:
        ahead = ranges.time_range(plan.minutes, self._since, self.stop)
        minutes = 1
        while True:
            window = ahead.orderBy("minute").limit(minutes)
            last, found = window.agg(
                F.date_format(F.max("minute"), _TEXT), F.count(F.lit(1))
            ).first()
            whole = found < minutes
            until = self.stop if whole else datetime.fromisoformat(last)
            lines = self._unread(plan, until)
            if whole or lines.limit(max_messages).count() == max_messages:
                return consume(lines, max_messages, self.stream_type).drop("message_no")
            minutes *= 4

    def mark(self) -> int:
        """Store the position after the messages of the last read, beside those of other members.

        Owned minutes between the first and the last minute that had no file
        count as read. Without any message the positions before the start are
        stored, so a later start option has no effect.
        """
        if self._taken is None:
            raise ValueError("nothing was read since the last reset")
        seen, taken = Observation(), self._taken
        if self.log is not None:
            taken = taken.observe(seen, F.count(F.lit(1)).alias("n"))
        new = stored(cp.build_checkpoint(taken, self.stream_type), "positions")
        merged = cp.merge_checkpoints(self._checkpoint, new, self.stream_type)
        if self._by_minute:
            merged = self._fill(merged, new)
        store = cp.checkpoint_store(self.store)
        changed = stored(merged if self._by_minute else cp.with_listed(new, self._seen), "changed")
        version = store.merge(changed, self.name, self.topic, self.stream_type)
        if self.log is not None:
            # A read without any line may have no plan left to be observed.
            n = 0 if new.isEmpty() else int(seen.get["n"])
            kinds = {"MESSAGE": n, "MARK": 1, "TIMEOUT": int(n == 0)}
            self._write_log(f"mark-{self.name}-{self.topic}-{version}", kinds)
        self._load()
        return version

    def _fill(self, merged: DataFrame, new: DataFrame) -> DataFrame:
        if new.isEmpty():
            if self._since is None or self._checkpoint is not None:
                return merged
            return cp.start_checkpoint(self._clusters(), self._since, self.group)
        # Each cluster is filled up to its own last minute. There are as many as roots.
        spans = new.groupBy("cluster").agg(
            F.date_format(F.min("minute"), _TEXT).alias("first"),
            F.date_format(F.max("minute"), _TEXT).alias("last"),
        )
        filled = merged.join(spans, "cluster", "left_anti").select(*merged.columns)
        for row in spans.collect():
            own = merged.filter(F.col("cluster") == row.cluster)
            begin = min(filter(None, [self._since, datetime.fromisoformat(row["first"])]))
            last = datetime.fromisoformat(row.last)
            filled = filled.unionByName(cp.fill_checkpoint(own, begin, last, self.group))
        return filled

    def pending_bytes(self) -> int:
        """Unread bytes over all partitions, by the stored checkpoint."""
        kinds = ["collector", "local"] if self.stream_type == "stitched" else [self.stream_type]
        files = reduce(DataFrame.unionByName, map(self._files, kinds))
        sizes = metrics.backlog(files, self._checkpoint, self.stop)
        return sizes.agg(F.coalesce(F.sum("pending_bytes"), F.lit(0))).first()[0]
