"""Start positions, time ranges, complete minutes and consumer groups."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from minuteflow.sources.layout import to_minute, utc_now

MAX_GROUP = 60


def check_range(start: datetime | None, stop: datetime | None) -> None:
    if start is not None and stop is not None and to_minute(stop) < to_minute(start):
        raise ValueError("the stop time lies before the start time")


def minute_literal(ts: datetime) -> Column:
    return F.lit(to_minute(ts).isoformat(" ")).cast("timestamp")


def time_range(
    df: DataFrame, start: datetime | None, stop: datetime | None, axis: str = "minute"
) -> DataFrame:
    """Keep start..stop, both inclusive at minute grain.

    ``axis`` is the directory minute, or ``file_minute`` for collector and
    stitched streams.
    """
    check_range(start, stop)
    if start is not None:
        df = df.filter(F.col(axis) >= minute_literal(start))
    if stop is not None:
        df = df.filter(F.col(axis) < minute_literal(stop + timedelta(minutes=1)))
    return df


def parse_group(group: str) -> tuple[int, int]:
    """``k/n`` with 0 < k <= n <= 60."""
    try:
        number, total = (int(part) for part in group.split("/"))
    except ValueError as error:
        raise ValueError(f"bad consumer group {group!r}") from error
    if not 0 < number <= total <= MAX_GROUP:
        raise ValueError(f"bad consumer group {group!r}")
    return number, total


def owned(minute: Column, group: str) -> Column:
    """True for minutes of the hour that member ``k`` of ``n`` reads."""
    number, total = parse_group(group)
    return F.minute(minute) % total == number - 1


def consumer_group(df: DataFrame, group: str, minute_col: str = "minute") -> DataFrame:
    return df.filter(owned(F.col(minute_col), group))


def stream_start(files: DataFrame, by: str = "cluster", axis: str = "minute") -> DataFrame:
    """First minute of each cluster."""
    return files.groupBy(by).agg(F.min(axis).alias("start"))


def first_gaps(dirs: DataFrame, keys: list[str]) -> DataFrame:
    """Per stream, the first minute whose next minute directory is missing.

    Each directory states its own minute and vouches for the one before, so
    one aggregation finds the minutes that nobody vouches for.
    """
    minute = F.col("minute")
    claims = F.array(
        F.struct(minute.alias("minute"), F.lit(True).alias("here")),
        F.struct((minute - F.expr("interval 1 minute")).alias("minute"), F.lit(False).alias("here")),
    )
    minutes = (
        dirs.select(*keys, F.explode(claims).alias("claim"))
        .groupBy(*keys, F.col("claim.minute").alias("minute"))
        .agg(F.bool_or("claim.here").alias("here"), F.bool_or(~F.col("claim.here")).alias("followed"))
    )
    gaps = minutes.filter(F.col("here") & ~F.col("followed"))
    return gaps.groupBy(*keys).agg(F.min("minute").alias("first_gap"))


def complete_minutes(
    dirs: DataFrame, keys: list[str] | None = None, start: datetime | None = None
) -> DataFrame:
    """Minute directories that may be read.

    Minute m is complete if directory m+1 exists; the first minute where it
    does not stops the stream there. Everything before that minute is an
    unbroken run, so the gate is one bound per stream and needs no ordered
    window over the whole stream.
    """
    keys = keys or ["cluster"]
    dirs = time_range(dirs, start, None)
    return dirs.join(first_gaps(dirs, keys), keys).filter(F.col("minute") < F.col("first_gap"))


def read_bounds(dirs: DataFrame, start: datetime | None = None) -> dict[str, datetime | None]:
    """Cluster -> last complete minute (None if there is none).

    One row per cluster comes to the driver: as many as there are root
    directories.
    """
    dirs = time_range(dirs, start, None)
    last = F.date_format(F.col("first_gap") - F.expr("interval 1 minute"), "yyyy-MM-dd HH:mm")
    bounds = {}
    for row in first_gaps(dirs, ["cluster"]).select("cluster", last.alias("last")).collect():
        bounds[row.cluster] = datetime.strptime(row.last, "%Y-%m-%d %H:%M")
    return bounds


def gate(df: DataFrame, bounds: dict[str, datetime | None]) -> DataFrame:
    """Keep rows of complete minutes; the bound prunes files at listing."""
    keep = F.lit(False)
    for cluster, last in bounds.items():
        if last is not None:
            keep = keep | ((F.col("cluster") == cluster) & (F.col("minute") <= minute_literal(last)))
    return df.filter(keep)


def resolve_start(
    partitions: DataFrame,
    checkpoint: DataFrame | None = None,
    *,
    now: datetime | None = None,
    relative_minutes: int | None = None,
    retention_hours: int | None = None,
    start: datetime | None = None,
    start_of_stream: bool = False,
    stop: datetime | None = None,
    keys: tuple[str, ...] = ("cluster",),
) -> DataFrame:
    """Where each partition starts: checkpoint, relative, absolute or stream start.

    Adds ``start_kind`` and ``start_minute`` (NULL for checkpoint and stream
    start). ``retention_hours`` counts only without ``relative_minutes``.
    """
    now = now or utc_now()
    if start is not None and start > now:
        raise ValueError("the start time lies in the future")
    if relative_minutes is None and retention_hours is not None:
        relative_minutes = retention_hours * 60
    if relative_minutes is not None:
        kind, begin = "relative", now - timedelta(minutes=relative_minutes)
    elif start is not None:
        kind, begin = "absolute", start
    elif start_of_stream:
        kind, begin = "stream", None
    else:
        kind, begin = None, None

    if checkpoint is None:
        found = partitions.withColumn("_marked", F.lit(False))
    else:
        marked = (
            checkpoint.filter(F.col("minute").isNotNull())
            .select(*keys)
            .distinct()
            .withColumn("_marked", F.lit(True))
        )
        found = partitions.join(marked, list(keys), "left")
    marked_col = F.coalesce(F.col("_marked"), F.lit(False))
    if kind is None:
        if checkpoint is None or not found.filter(~marked_col).isEmpty():
            raise ValueError(
                "give a checkpoint, a relative start, an absolute start or start of stream"
            )
    elif begin is not None and stop is not None and stop < begin:
        if not found.filter(~marked_col).isEmpty():
            raise ValueError("the stop time lies before the start time")
    literal = minute_literal(begin) if begin is not None else F.lit(None).cast("timestamp")
    return (
        found.withColumn("start_kind", F.when(marked_col, "checkpoint").otherwise(F.lit(kind)))
        .withColumn("start_minute", F.when(~marked_col, literal))
        .drop("_marked")
    )
