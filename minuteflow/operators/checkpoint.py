"""Checkpoints of minute-directory and collector streams.

A checkpoint is a table with one row per partition: for minute directories per
(cluster, minute of the hour), at most 60 per cluster; for collector and
stitched streams per (cluster, collector). ``file_key`` is the struct that
orders files, NULL before any file of the minute was read; ``line_no`` is the
last line consumed, -1 when the minute is fully read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from minuteflow.operators.positions import file_key, partition_key
from minuteflow.operators.ranges import minute_literal, owned, parse_group
from minuteflow.session import broadcast_if_small
from minuteflow.sources import storage
from minuteflow.sources.layout import to_minute

FULLY_READ = -1
# Stands in place of a collector in the row that tells up to which minute directory all was read.
LISTED = ""
MINUTES_PER_HOUR = 60
_ONE_MINUTE = "interval 1 minute"


def _keyed_by_minute(stream_type: str) -> bool:
    return stream_type not in ("collector", "stitched")


def build_checkpoint(consumed: DataFrame, stream_type: str = "local") -> DataFrame:
    """Position after the last consumed message of each partition.

    Minutes before the latest one of the cluster were left behind, so they
    count as fully read.
    """
    key = F.struct(*file_key(stream_type)).alias("file_key")
    if not _keyed_by_minute(stream_type):
        last = consumed.groupBy(*partition_key(stream_type)).agg(
            F.max(F.struct(key, "line_no")).alias("_last")
        )
        return last.select(
            *partition_key(stream_type),
            F.col("_last.file_key.file_minute").alias("minute"),
            "_last.file_key",
            "_last.line_no",
        )
    last = consumed.groupBy("cluster", F.minute("minute").alias("minute_of_hour")).agg(
        F.max(F.struct("minute", key, "line_no")).alias("_last")
    )
    # At most 60 rows per cluster are left, so this window is small.
    latest = F.max("_last.minute").over(Window.partitionBy("cluster"))
    behind = F.col("_last.minute") < F.col("_latest")
    return last.withColumn("_latest", latest).select(
        "cluster",
        "minute_of_hour",
        F.col("_last.minute").alias("minute"),
        "_last.file_key",
        F.when(behind, F.lit(FULLY_READ)).otherwise(F.col("_last.line_no")).alias("line_no"),
    )


def least_checkpoint(checkpoint: DataFrame) -> DataFrame:
    """Earliest marked minute of each cluster: where listing starts."""
    return checkpoint.groupBy("cluster").agg(F.min("minute").alias("least"))


def _beyond(key: Column, line_no: Column) -> Column:
    """Rows after the checkpointed position inside its own minute."""
    file, line = F.col("_file_key"), F.col("_line_no")
    after = (key > file) | ((key == file) & (line_no > line))
    return (line != FULLY_READ) & (file.isNull() | after)


def unread_files(checkpoint: DataFrame, stream_type: str = "local") -> Column:
    """False for files that lie wholly before the checkpoint.

    Only columns of the file are used, so filtered right above a scan it keeps
    Spark from opening them; ``resume`` then cuts the file of the position. The driver
    takes one row per partition: 60 per cluster, or one per collector.
    """
    text = "yyyy-MM-dd HH:mm:ss"
    on = "minute_of_hour" if _keyed_by_minute(stream_type) else "collector"
    marks = (
        checkpoint.filter("minute is not null")
        .select(
            F.concat("cluster", F.lit("/"), F.col(on).cast("string")).alias("key"),
            "cluster",
            F.date_format("minute", text).alias("minute"),
            (F.col("line_no") == FULLY_READ).alias("whole"),
        )
        .filter("key is not null")
        .collect()
    )
    if not marks:
        return F.lit(True)

    def found(key: Column, pairs: dict) -> Column:
        literals = [F.lit(x) for pair in pairs.items() for x in pair]
        return F.try_element_at(F.create_map(*literals), key).cast("timestamp")

    if not _keyed_by_minute(stream_type):
        mark = found(F.concat("cluster", F.lit("/"), "collector"), {m.key: m.minute for m in marks})
        return F.coalesce(F.col("file_minute") >= mark, F.lit(True))
    key = F.concat("cluster", F.lit("/"), F.minute("minute").cast("string"))
    # The first minute of which something may be unread.
    onward = {
        m.key: str(datetime.fromisoformat(m.minute) + timedelta(minutes=int(m.whole)))
        for m in marks
    }
    least: dict[str, str] = {}
    for m in marks:
        least[m.cluster] = min(m.minute, least.get(m.cluster, m.minute))
    begin = found(F.col("cluster"), least)
    return F.coalesce(F.col("minute") >= begin, F.lit(True)) & F.coalesce(
        F.col("minute") >= found(key, onward), F.lit(True)
    )


def resume(df: DataFrame, checkpoint: DataFrame, stream_type: str = "local") -> DataFrame:
    """Keep the rows a consumer has not read yet.

    Minute directories: a row stays if its minute of the hour has no checkpoint
    and it is not before the cluster's least checkpoint; if it is later than
    that checkpoint; or if it lies beyond the position in the same minute. The
    stored key holds the file's order, so a file that has gone is skipped over
    to the next higher one. Partitions without any checkpoint keep all rows.
    """
    on = partition_key(stream_type)
    key, line_no = F.struct(*file_key(stream_type)), F.col("line_no")
    if not _keyed_by_minute(stream_type):
        marks = checkpoint.select(
            *on, F.col("file_key").alias("_file_key"), F.col("line_no").alias("_line_no")
        )
        joined = df.join(broadcast_if_small(marks), on, "left")
        # Whole read files are -1, so nothing of them is left.
        same = (key == F.col("_file_key")) & (F.col("_line_no") != FULLY_READ)
        beyond = (key > F.col("_file_key")) | (same & (line_no > F.col("_line_no")))
        keep = F.col("_file_key").isNull() | beyond
        return joined.filter(keep).drop("_file_key", "_line_no")

    marked = checkpoint.filter(F.col("minute").isNotNull())
    marks = marked.select(
        "cluster",
        F.col("minute_of_hour").alias("_minute_of_hour"),
        F.col("minute").alias("_minute"),
        F.col("file_key").alias("_file_key"),
        F.col("line_no").alias("_line_no"),
    )
    # One row per cluster: as many as there are root directories.
    least = {
        row.cluster: row.least
        for row in least_checkpoint(marked)
        .select("cluster", F.date_format("least", "yyyy-MM-dd HH:mm:ss").alias("least"))
        .collect()
    }
    begin = F.lit(True)
    for cluster, minute in least.items():
        other = F.col("cluster") != cluster
        begin = begin & (other | (F.col("minute") >= F.lit(minute).cast("timestamp")))
    # This predicate has no column of the checkpoint, so it prunes files.
    joined = (
        df.filter(begin)
        .withColumn("_minute_of_hour", F.minute("minute"))
        .join(broadcast_if_small(marks), ["cluster", "_minute_of_hour"], "left")
    )
    keep = (
        F.col("_minute").isNull()
        | (F.col("minute") > F.col("_minute"))
        | ((F.col("minute") == F.col("_minute")) & _beyond(key, line_no))
    )
    return joined.filter(keep).drop("_minute_of_hour", "_minute", "_file_key", "_line_no")


def _owned_minutes(
    spark: SparkSession, clusters: DataFrame, first: datetime, last: datetime, group: str
) -> DataFrame:
    span = F.sequence(minute_literal(first), minute_literal(last), F.expr(_ONE_MINUTE))
    minutes = clusters.select("cluster", F.explode(span).alias("minute"))
    return minutes.filter(owned(F.col("minute"), group)).withColumn(
        "minute_of_hour", F.minute("minute")
    )


def fill_checkpoint(
    checkpoint: DataFrame,
    start: datetime,
    stop: datetime,
    group: str = "1/1",
    inclusive: bool = False,
) -> DataFrame:
    """Mark the owned minutes start..stop as fully read, where no file exists.

    ``stop`` itself counts only with ``inclusive`` (a stop time). A later
    checkpoint of the same minute of the hour stays. Only the last 60 minutes
    can matter, since each minute of the hour keeps one position.
    """
    spark = checkpoint.sparkSession
    last = to_minute(stop) if inclusive else to_minute(stop) - timedelta(minutes=1)
    first = max(to_minute(start), last - timedelta(minutes=MINUTES_PER_HOUR - 1))
    if last < first:
        return checkpoint
    clusters = checkpoint.select("cluster").distinct()
    gaps = _owned_minutes(spark, clusters, first, last, group).withColumnRenamed("minute", "_gap")
    columns = checkpoint.columns
    merged = checkpoint.join(gaps, ["cluster", "minute_of_hour"], "full")
    filled = F.col("_gap").isNotNull() & (
        F.col("minute").isNull() | (F.col("minute") <= F.col("_gap"))
    )
    return (
        merged.withColumn("file_key", F.when(~filled, F.col("file_key")))
        .withColumn(
            "line_no", F.when(filled, F.lit(FULLY_READ).cast("long")).otherwise(F.col("line_no"))
        )
        .withColumn("minute", F.when(filled, F.col("_gap")).otherwise(F.col("minute")))
        .select(*columns)
    )


def start_checkpoint(
    clusters: DataFrame,
    start: datetime,
    group: str = "1/1",
    checkpoint: DataFrame | None = None,
) -> DataFrame:
    """Positions before anything is read: each owned minute of the next 60.

    Minutes of the hour that already have a checkpoint are left out.
    """
    last = to_minute(start) + timedelta(minutes=MINUTES_PER_HOUR - 1)
    minutes = _owned_minutes(
        clusters.sparkSession, clusters.select("cluster").distinct(), start, last, group
    )
    if checkpoint is not None:
        marked = checkpoint.filter(F.col("minute").isNotNull())
        minutes = minutes.join(marked, ["cluster", "minute_of_hour"], "left_anti")
    key = "struct<file_dir:string,file_mtime:timestamp,file_name:string>"
    return minutes.select(
        "cluster",
        "minute_of_hour",
        "minute",
        F.lit(None).cast(key).alias("file_key"),
        F.lit(0).cast("long").alias("line_no"),
    )


def merge_checkpoints(
    old: DataFrame | None, new: DataFrame, stream_type: str = "local"
) -> DataFrame:
    """The consumer's checkpoint after new positions replace old ones."""
    if old is None:
        return new
    on = ["cluster", "minute_of_hour"] if _keyed_by_minute(stream_type) else partition_key(stream_type)
    return old.join(new, on, "left_anti").select(*new.columns).unionByName(new)


def owned_positions(checkpoint: DataFrame, group: str) -> DataFrame:
    """The positions of a member's own minutes of the hour."""
    number, total = parse_group(group)
    return checkpoint.filter(F.pmod("minute_of_hour", F.lit(total)) == number - 1)


class CheckpointStore(Protocol):
    """Where consumers keep their positions; a key is a consumer name and a topic."""

    def load(self, spark: SparkSession, consumer: str, topic: str) -> DataFrame | None:
        """All positions stored under a key, or None."""

    def save(self, checkpoint: DataFrame, consumer: str, topic: str) -> int:
        """Store these positions in place of all others; gives the version."""

    def merge(self, changed: DataFrame, consumer: str, topic: str, stream_type: str) -> int:
        """Store changed positions beside those of other partitions, whoever stored them."""


@dataclass(frozen=True)
class FileCheckpointStore:
    """Versions of a key's positions in a folder shared by all members of a group.

    A version is a table of its own and a small file ``v<number>`` that names it. That file is
    created only if nobody has the number, so of two members that go on from the same version one
    has to read the other's and go on from there: no member's positions are lost. The last
    ``keep`` versions stay.
    """

    root: str
    keep: int = 20

    def _path(self, spark: SparkSession, consumer: str, topic: str) -> str:
        return storage.qualify(spark, f"{self.root.rstrip('/')}/{consumer}_{topic}")

    def _versions(self, path: str) -> tuple[list[int], int]:
        """The versions that can be read, and the number of the next one.

        A folder of that name is a table itself, as stores had them once; one that was not finished
        is passed by.
        """
        found = {e.base_name: e for e in storage.children(path)}
        named = {n: int(n[1:]) for n in found if n.startswith("v") and n[1:].isdigit()}
        whole = [k for n, k in named.items() if found[n].is_file or storage.exists(f"{path}/{n}/_SUCCESS")]
        return sorted(whole), max(named.values(), default=0) + 1

    @staticmethod
    def _place(path: str, version: int) -> str:
        pointer = f"{path}/v{version:010d}"
        return pointer if storage.is_dir(pointer) else f"{path}/{storage.read_text(pointer)}"

    def _commit(self, checkpoint: DataFrame, path: str, version: int) -> bool:
        """Write the positions as this version, unless somebody else was faster."""
        spark, name = checkpoint.sparkSession, f"positions-{uuid.uuid4().hex}"
        # At most 60 rows per cluster, or one per collector.
        checkpoint.coalesce(1).write.parquet(f"{path}/{name}")
        if not storage.create_new(spark, f"{path}/v{version:010d}", name):
            storage.delete_dir(f"{path}/{name}")
            return False
        for old in self._versions(path)[0][: -self.keep]:
            storage.delete_dir(self._place(path, old))
            storage.delete_file(f"{path}/v{old:010d}")
        return True

    def load(self, spark: SparkSession, consumer: str, topic: str) -> DataFrame | None:
        path = self._path(spark, consumer, topic)
        versions, _ = self._versions(path)
        return spark.read.parquet(self._place(path, versions[-1])) if versions else None

    def save(self, checkpoint: DataFrame, consumer: str, topic: str) -> int:
        path = self._path(checkpoint.sparkSession, consumer, topic)
        while True:
            _, version = self._versions(path)
            if self._commit(checkpoint, path, version):
                return version

    def merge(self, changed: DataFrame, consumer: str, topic: str, stream_type: str) -> int:
        spark = changed.sparkSession
        path = self._path(spark, consumer, topic)
        while True:
            versions, version = self._versions(path)
            old = spark.read.parquet(self._place(path, versions[-1])) if versions else None
            if self._commit(merge_checkpoints(old, changed, stream_type), path, version):
                return version


def checkpoint_store(store: str | CheckpointStore) -> CheckpointStore:
    return FileCheckpointStore(store) if isinstance(store, str) else store


def save_checkpoint(checkpoint: DataFrame, store: str | CheckpointStore, consumer: str, topic: str) -> int:
    """Store positions in place of all others under the key, as a new version."""
    return checkpoint_store(store).save(checkpoint, consumer, topic)


def load_checkpoint(
    spark: SparkSession, store: str | CheckpointStore, consumer: str, topic: str
) -> DataFrame | None:
    """The latest version, or None."""
    return checkpoint_store(store).load(spark, consumer, topic)


def listed_until(checkpoint: DataFrame) -> dict[str, datetime]:
    """Cluster -> the minute directory before which a stitched consumer has read everything.

    Files are committed to the newest minute, so what comes later lies there or beyond.
    """
    rows = checkpoint.filter(F.col("collector") == LISTED)
    text = F.date_format("minute", "yyyy-MM-dd HH:mm:ss").alias("minute")
    return {r.cluster: datetime.fromisoformat(r.minute) for r in rows.select("cluster", text).collect()}


def with_listed(positions: DataFrame, seen: dict[str, datetime]) -> DataFrame:
    """Collector positions with a row per cluster for :func:`listed_until`."""
    if not seen:
        return positions
    rows = positions.sparkSession.createDataFrame(
        [(c, LISTED, m.isoformat(" ")) for c, m in seen.items()],
        "cluster string, collector string, minute string",
    )
    return positions.unionByName(
        rows.select(
            "cluster",
            "collector",
            F.col("minute").cast("timestamp").alias("minute"),
            F.lit(None).cast(positions.schema["file_key"].dataType).alias("file_key"),
            F.lit(FULLY_READ).cast("long").alias("line_no"),
        )
    )


def rename_clusters(checkpoint: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Move positions to new cluster names; others keep theirs."""
    if not mapping:
        return checkpoint
    names = F.create_map(*[F.lit(part) for pair in mapping.items() for part in pair])
    renamed = F.coalesce(F.try_element_at(names, F.col("cluster")), F.col("cluster"))
    return checkpoint.withColumn("cluster", renamed)
