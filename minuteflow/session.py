"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def local_session(cores: str = "*", **conf: str) -> SparkSession:
    """A single-machine session, for tests and the benchmark."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("minuteflow")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def require_utc(spark: SparkSession) -> None:
    """Minutes of directories and file names are UTC; another session zone would shift them."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC; it is {zone}")


_local_base: list[str] = []


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder that every executor can reach.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``.
    Only a local session may do without that setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if not _local_base:
            _local_base.append(tempfile.mkdtemp(prefix="minuteflow-"))
        base = _local_base[0]
    return f"{base.rstrip('/')}/minuteflow/{uuid.uuid4().hex}/{name}"


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Hint a broadcast only after checking the row count.

    Beyond ``max_rows`` the frame is returned as it is, so the join shuffles.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a small result once, for several jobs to use without computing it again."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
