"""Audit counts per topic and window, packets and reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

AUDIT_TOPIC = "_audit"
DEFAULT_WINDOW_SEC = 60


def window_start(ts_ms: Column, window_sec: int = DEFAULT_WINDOW_SEC) -> Column:
    """The window of a time in ms: ``ts - ts % window``."""
    return ts_ms - ts_ms % (window_sec * 1000)


def audit_counts(
    df: DataFrame,
    window_sec: int = DEFAULT_WINDOW_SEC,
    topic: str = "topic",
    ts_ms: str = "ts_ms",
    name: str = "received",
) -> DataFrame:
    """Messages per topic and window.

    Apply after the size check: oversized messages are not counted.
    """
    window = window_start(F.col(ts_ms), window_sec).alias("window_ms")
    return df.groupBy(F.col(topic).alias("topic"), window).agg(F.count(F.lit(1)).alias(name))


def sent_counts(
    log: DataFrame, window_sec: int = DEFAULT_WINDOW_SEC, ts_ms: str = "ts_ms"
) -> DataFrame:
    """Received and sent messages per topic and window of a publish log."""
    window = window_start(F.col(ts_ms), window_sec).alias("window_ms")
    return log.groupBy("topic", window).agg(
        F.count_if(F.col("kind") == "INVOCATION").alias("received"),
        F.count_if(F.col("kind") == "SUCCESS").alias("sent"),
    )


def audit_packets(
    counts: DataFrame,
    tier: str,
    hostname: str,
    timestamp_ms: int | Column,
    window_sec: int = DEFAULT_WINDOW_SEC,
    max_windows: int = 500,
) -> DataFrame:
    """Records per topic with maps window -> received and window -> sent.

    The maps are built from window counts, never from messages. Zero counts
    take no entry. A flush period fits one record; a longer run of windows is
    cut into records of at most ``max_windows``, so no record outgrows a message.
    """
    if "sent" not in counts.columns:
        counts = counts.withColumn("sent", F.lit(0).cast("long"))

    def as_map(name: str) -> Column:
        # collect_list skips NULL, so windows without a count leave no entry.
        entry = F.when(F.col(name) > 0, F.struct("window_ms", name))
        return F.map_from_entries(F.collect_list(entry)).alias(name)

    stamp = timestamp_ms if isinstance(timestamp_ms, Column) else F.lit(timestamp_ms)
    span = F.floor(F.col("window_ms") / (window_sec * 1000 * max_windows)).alias("_span")
    packets = counts.groupBy("topic", span).agg(as_map("received"), as_map("sent"))
    filled = (F.size("received") > 0) | (F.size("sent") > 0)
    return packets.filter(filled).select(
        stamp.cast("long").alias("timestamp"),
        "topic",
        F.lit(tier).alias("tier"),
        F.lit(hostname).alias("hostname"),
        F.lit(window_sec).alias("window_size"),
        "received",
        "sent",
        F.array().cast("array<string>").alias("filenames"),
        F.create_map().cast("map<string,string>").alias("tags"),
    )


def packet_counts(packets: DataFrame, name: str = "received") -> DataFrame:
    """Flatten packets again and add up the windows of several flushes."""
    flat = packets.select("topic", F.explode(name).alias("window_ms", name))
    return flat.groupBy("topic", "window_ms").agg(F.sum(name).alias(name))


def reconcile(counts: DataFrame, tiers: list[str], base: str | None = None) -> DataFrame:
    """Per topic, one column per tier, its difference to ``base`` and ``matches``.

    Input: ``tier, topic, value``. The base tier is the first one unless given.
    """
    base = base or tiers[0]
    wide = counts.groupBy("topic").pivot("tier", tiers).agg(F.sum("value"))
    wide = wide.withColumns({t: F.coalesce(F.col(t), F.lit(0)) for t in tiers})
    others = [t for t in tiers if t != base]
    wide = wide.withColumns({f"{t}_diff": F.col(t) - F.col(base) for t in others})
    matches = F.lit(True)
    for t in others:
        matches = matches & (F.col(f"{t}_diff") == 0)
    return wide.withColumn("matches", matches)


def counter_delta(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Final minus initial ``value`` of every key of two snapshots."""
    first = before.select(*keys, F.col("value").alias("_before"))
    last = after.select(*keys, F.col("value").alias("_after"))
    delta = F.coalesce("_after", F.lit(0)) - F.coalesce("_before", F.lit(0))
    return first.join(last, keys, "full").select(*keys, delta.alias("delta"))
