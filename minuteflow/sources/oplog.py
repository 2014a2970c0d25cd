"""Append-only logs of what publishing and consuming did.

A log is a folder of entries. An entry has one row per topic, actor and kind with the number ``n``
of events, and its name says what it is about: the tag of a publish, the version of a mark. Written
again after a failure, an entry replaces itself, so nothing counts twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from minuteflow.sources import layout, storage

_PUBLISH = "topic string, publisher string, kind string, n long, nanos long"
_CONSUME = "topic string, consumer string, kind string, n long"


def publish_folder(root: str) -> str:
    return f"{root}/_log/publish"


def write_entry(rows: DataFrame, folder: str, entry: str) -> None:
    """Put an entry in place of one of its name. Its rows are few: one per topic and kind."""
    rows.coalesce(1).write.mode("overwrite").parquet(f"{folder}/entry={entry}")


def published_log(spark: SparkSession, root: str) -> DataFrame:
    """``topic, publisher, kind, n, nanos`` of every publish into a root, for the metrics operators."""
    return _entries(spark, publish_folder(storage.existing(spark, root)), _PUBLISH)


def consumed_log(spark: SparkSession, folder: str) -> DataFrame:
    """``topic, consumer, kind, n`` of every consumer that logs to a folder."""
    return _entries(spark, storage.qualify(spark, folder), _CONSUME)


def _entries(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    if not storage.exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", folder).parquet(layout.range_path(folder)).drop("entry")


def outcomes(accepted: DataFrame, oversized: DataFrame) -> DataFrame:
    """``topic, kind, n`` from messages per topic. Oversized ones are invoked and stay without outcome."""
    rows = accepted.select("topic", F.lit("SUCCESS").alias("kind"), "n").unionByName(
        oversized.select("topic", F.lit("EXCEEDED_MSG_SIZE").alias("kind"), "n")
    )
    invoked = rows.groupBy("topic").agg(F.sum("n").alias("n"))
    return rows.unionByName(invoked.select("topic", F.lit("INVOCATION").alias("kind"), "n"))


def log_consumption(
    spark: SparkSession, folder: str, entry: str, topic: str, consumer: str, kinds: dict[str, int]
) -> None:
    """One entry with the counts of ``kinds``."""
    rows = [(topic, consumer, kind, n) for kind, n in kinds.items() if n]
    write_entry(spark.createDataFrame(rows, _CONSUME), storage.qualify(spark, folder), entry)
