"""Line numbers, stream order and bounded consumption."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from minuteflow.session import stored

# Order of files inside a partition. Minute directories: directory, then
# modification time, then name. Collector and stitched streams: file-name
# minute, then id.
MINUTE_KEY = ["file_dir", "file_mtime", "file_name"]
COLLECTOR_KEY = ["file_minute", "file_id"]
MINUTE_PARTITION = ["cluster"]
COLLECTOR_PARTITION = ["cluster", "collector"]


def file_key(stream_type: str) -> list[str]:
    return COLLECTOR_KEY if stream_type in ("collector", "stitched") else MINUTE_KEY


def partition_key(stream_type: str) -> list[str]:
    return COLLECTOR_PARTITION if stream_type in ("collector", "stitched") else MINUTE_PARTITION


def _rows_in_split(
    batches: Iterator[tuple[pa.Array, pa.Array]],
) -> Iterator[pa.Array]:
    """Number the rows of each split from 0; a task reads its splits one after the other."""
    split, seen = None, 0
    for paths, starts in batches:
        codes = paths.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        begins = starts.to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((np.diff(codes) != 0) | (np.diff(begins) != 0)) + 1
        numbers = np.arange(len(begins), dtype=np.int64)
        for begin, end in zip([0, *cuts], [*cuts, len(begins)]):
            here = (paths[begin].as_py(), begins[begin]) if end > begin else split
            seen = seen if here == split else 0
            numbers[begin:end] += seen - begin
            split, seen = here, seen + end - begin
        yield pa.array(numbers)


# Its result depends on the rows before, so no filter may move below it.
_row_in_split = F.arrow_udf(_rows_in_split, T.LongType()).asNondeterministic()


def _split_offsets(lines: DataFrame) -> DataFrame:
    """Lines before each later split of a file, as a written table of one row per split.

    The offset of a split depends only on where it starts, so it holds however
    a later scan cuts the files. Gzip files are never cut and not counted.
    """
    earlier = (
        Window.partitionBy("file_path")
        .orderBy("split_start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    counts = (
        lines.filter(~F.col("file_path").endswith(".gz"))
        .groupBy("file_path", "split_start")
        .agg(F.count(F.lit(1)).alias("_lines"))
    )
    offsets = counts.select(
        F.col("file_path").alias("_path"),
        F.col("split_start").alias("_start"),
        F.sum("_lines").over(earlier).alias("_before"),
    ).filter(F.col("_start") > 0)
    return stored(offsets, "split_offsets")


def with_positions(lines: DataFrame) -> DataFrame:
    """Add ``line_no``, from 1 in every file, to rows just scanned.

    A row's number in its file is its number in its split plus the lines of
    the file's earlier splits. The first is counted while the split is read;
    only the position columns go through Python. The second is counted once,
    when this is called, for files that can be split at all. Lines are neither
    sorted nor gathered per file, and while Spark finds the table of splits small
    enough to broadcast they are not shuffled either.
    """
    offsets = _split_offsets(lines)
    same_split = (F.col("file_path") == F.col("_path")) & (F.col("split_start") == F.col("_start"))
    first_split = F.col("split_start") == 0
    # Every later split that holds lines was counted, unless the file has changed.
    known = F.coalesce("_before", F.raise_error(F.lit("a file changed while it was read")))
    offset = F.when(first_split, F.lit(0).cast("long")).otherwise(known)
    numbered = lines.withColumn("_row", _row_in_split("file_path", "split_start"))
    return (
        numbered.join(offsets, same_split, "left")
        .withColumn("line_no", F.col("_row") + 1 + offset)
        .drop("_row", "_path", "_start", "_before")
    )


def order_key(stream_type: str = "local") -> Column:
    """A struct that sorts messages of one partition in stream order."""
    return F.struct(*file_key(stream_type), "line_no")


def _stream_order(stream_type: str) -> list[str]:
    if stream_type in ("collector", "stitched"):
        return [*COLLECTOR_PARTITION, *COLLECTOR_KEY]
    return ["minute", "cluster", *MINUTE_KEY]


def number_messages(
    df: DataFrame,
    stream_type: str = "local",
    max_messages: int | None = None,
) -> DataFrame:
    """Add ``message_no``, from 1 over the whole frame in stream order.

    Order: minute, cluster, file and line; or collector, file and line. Lines
    are counted per file, once, when this is called. Only these counts are put
    in order, by ranges, so the rows themselves are never sorted and no task has
    all files. ``max_messages`` leaves out later files. A file's lines must be
    without gaps; other frames raise.
    """
    keys = _stream_order(stream_type)
    n, first, last = F.count(F.lit(1)), F.min("line_no"), F.max("line_no")
    gaps = F.raise_error(F.lit("lines were filtered out within a file")).cast("long")
    files = df.groupBy(*keys).agg(
        F.when(last - first + 1 == n, n).otherwise(gaps).alias("_n"),
        (first - 1).alias("_skipped"),
    )
    dealt = files.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id())
    dealt = stored(dealt, "files_in_order")
    # One row per range, as many as shuffle partitions.
    sums = dealt.groupBy("_range").agg(F.sum("_n").alias("_sum"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    own = Window.partitionBy("_range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.join(bases, "_range").withColumn(
        "_before", F.col("_base") + F.coalesce(F.sum("_n").over(own), F.lit(0))
    )
    if max_messages is not None:
        starts = starts.filter(F.col("_before") < max_messages)
    starts = starts.select(*[F.col(k).alias(f"_{k}") for k in keys], "_before", "_skipped")
    starts = stored(starts, "file_starts")
    same_file = F.lit(True)
    for k in keys:
        same_file = same_file & F.col(k).eqNullSafe(F.col(f"_{k}"))
    # Lines of a file are dense; a file that is resumed begins after its first ones.
    return (
        df.join(starts, same_file)
        .withColumn("message_no", F.col("_before") + F.col("line_no") - F.col("_skipped"))
        .drop("_before", "_skipped", *[f"_{k}" for k in keys])
    )


def consume(df: DataFrame, max_messages: int, stream_type: str = "local") -> DataFrame:
    """The first ``max_messages`` rows in stream order, with their ``message_no``."""
    numbered = number_messages(df, stream_type, max_messages)
    return numbered.filter(F.col("message_no") <= max_messages)


def mark_points(numbered: DataFrame, every: int = 5000) -> DataFrame:
    """Messages after which a consumer marks: each ``every``-th in stream order."""
    return numbered.filter(F.col("message_no") % every == 0)
