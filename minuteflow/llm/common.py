"""Helpers that several of these operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from minuteflow.session import stored

# The white space between words; bytes.split() without arguments knows the same six characters.
SPACES = " \t\n\x0b\x0c\r"
WORD_GAP = r"[\x20\x09-\x0D]+"
# Rows whose texts a Python worker has as objects of its own at a time.
ROWS_AT_ONCE = 500
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often it is used."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text as an array; null has none.

    Splitting at one character needs no regular expression, so texts whose only white space is blanks
    and line ends are split so.
    """
    whole = F.coalesce(text, F.lit(""))
    rare = [F.contains(whole, F.lit(c)) for c in SPACES if c not in " \n"]
    parts = F.when(reduce(Column.__or__, rare), F.split(whole, WORD_GAP)).otherwise(
        F.split(F.replace(whole, F.lit("\n"), F.lit(" ")), " ")
    )
    return F.array_remove(parts, "")


def text_bytes(column: pa.Array) -> list[bytes]:
    """Texts of a batch as UTF-8 bytes; null is empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def slices(
    batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE
) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows, so copies of all their texts never meet.

    In the end the memory Arrow has spare is handed back: workers live on beside later steps.
    """
    try:
        for batch in batches:
            for a in range(0, batch.num_rows, rows):
                yield batch.slice(a, rows)
    finally:
        pa.default_memory_pool().release_unused()


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(h: np.ndarray, length: int) -> np.ndarray:
    """The hash of every window of ``length`` words."""
    n = len(h) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(length):
        out = out * _MULTIPLIER + h[k : k + n]
    return mixed(out)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def small_table(spark: SparkSession, rows: list[tuple], kinds: str) -> DataFrame:
    """A few rows of the driver's. They go as Arrow, so no executor starts Python workers for them."""
    schema = T.StructType.fromDDL(kinds)
    if not rows:
        return spark.createDataFrame([], schema)
    fields = arrow_schema(schema)
    arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=fields), schema)


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once to the shared folder and read it back.

    This cuts the lineage, so a lost executor costs no more than the step at hand,
    and the shuffle files of that step are dropped when it is written.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        return stored(df, name)
    finally:
        conf.set(_CLEANUP, before)


def few_tasks(df: DataFrame) -> DataFrame:
    """``df`` in fewer tasks where it has more than four a core; at least one for eight shuffle partitions.

    For tables of small rows. Java starts processes for every file that a task writes to a folder of
    ``file:``, and each looks as large as the executor for a moment. Not below a function that tells its
    tasks apart by number: several partitions share a task.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.coalesce(max(4 * spark.sparkContext.defaultParallelism, partitions // 8))


def running_sums(df: DataFrame, order: list[str], sums: list[str], name: str) -> DataFrame:
    """For every row the sums of ``sums`` over all rows before it in ``order``.

    Rows are dealt by ranges of ``order`` and sorted; each task adds up its own
    rows, and one row per task gives the offsets, so no task and no key holds
    the whole order. The result has the input's columns and ``<sum>_before``.
    It is written once to the shared folder, since ranges are sampled anew
    whenever a plan runs. What reaches the driver is one row per task.
    """
    spark = df.sparkSession
    added = [f"{s}_local" for s in sums]
    fields = [T.StructField(c, T.LongType(), False) for c in ["pid", *added]]
    schema = T.StructType([*df.schema.fields, *fields])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        totals = [0] * len(sums)
        for batch in batches:
            columns = list(batch.columns)
            columns.append(pa.array(np.full(batch.num_rows, pid, np.int64)))
            for k, s in enumerate(sums):
                values = np.asarray(batch.column(s).to_numpy(zero_copy_only=False), np.int64)
                after = np.cumsum(values) + totals[k]
                columns.append(pa.array(after - values))
                totals[k] = int(after[-1]) if len(after) else totals[k]
            yield pa.RecordBatch.from_arrays(
                columns, names=[*batch.schema.names, "pid", *added]
            )

    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = kept(ranged.mapInArrow(local, schema), name)
    per_task = rows.groupBy("pid").agg(*(F.sum(s).alias(s) for s in sums)).collect()
    offsets, totals = [], [0] * len(sums)
    for row in sorted(per_task, key=lambda r: r.pid):
        offsets.append((row.pid, *totals))
        totals = [t + row[s] for t, s in zip(totals, sums, strict=True)]
    names = [f"{s}_offset" for s in sums]
    kinds = ", ".join(f"{c} long" for c in ["offset_pid", *names])
    # One row per task, so the broadcast is bounded by the number of partitions.
    offset = F.broadcast(small_table(spark, offsets, kinds))
    joined = rows.join(offset, rows.pid == offset.offset_pid)
    return joined.select(
        *(rows[c] for c in df.columns),
        *((rows[f"{s}_local"] + offset[f"{s}_offset"]).alias(f"{s}_before") for s in sums),
    )
