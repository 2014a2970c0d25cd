"""Queries over audit headers, counts, packets and reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from minuteflow.functions import codec
from minuteflow.operators import audit
from minuteflow.plans import tables
from minuteflow.plans.registry import LOG_SQL, MESSAGES_SQL, query
from minuteflow.sources.minutes import read_messages

COUNTS_SQL = f"""(
  SELECT topic, ts_ms - ts_ms % 60000 AS window_ms, count(*) AS received
  FROM {MESSAGES_SQL} GROUP BY ALL)"""


@query(
    "a1_attach_header",
    f"""SELECT event_id, '01ABCDEF' || lpad(to_hex(ts_ms), 16, '0') ||
        lpad(to_hex(CAST(octet_length(encode(payload)) AS BIGINT)), 8, '0') ||
        hex(encode(payload)) AS framed FROM {MESSAGES_SQL}""",
)
def a1_attach_header(spark, sf_dir):
    framed = codec.attach_header(tables.events(spark, sf_dir), "ts_ms")
    return framed.select("event_id", F.hex("payload").alias("framed"))


@query(
    "a2_strip_header",
    f"""SELECT event_id, event_type IN ('click', 'view') AS stripped,
        CASE WHEN event_type IN ('click', 'view') THEN octet_length(encode(payload))
             WHEN event_type = 'error' THEN octet_length(encode(payload)) + 15
             ELSE octet_length(encode(payload)) + 16 END AS size FROM {MESSAGES_SQL}""",
)
def a2_strip_header(spark, sf_dir):
    """Valid headers go; wrong version, size or a time before 2013 leave the payload whole."""
    rows = tables.events(spark, sf_dir)
    good = codec.with_header(F.col("payload"), F.col("ts_ms"))
    old = codec.with_header(F.col("payload"), F.lit(1262304000000))
    rest = F.substring(good, F.lit(2), F.octet_length(good))
    framed = (
        F.when(F.col("topic") == "purchase", F.concat(F.unhex(F.lit("0A")), rest))
        .when(F.col("topic") == "signup", old)
        .when(F.col("topic") == "error", F.substring(good, F.lit(1), F.octet_length(good) - 1))
        .otherwise(good)
    )
    read = codec.strip_header(rows.withColumn("framed", framed), "framed")
    return read.select(
        "event_id",
        (F.col("framed") == F.col("payload")).alias("stripped"),
        F.octet_length("framed").cast("long").alias("size"),
    )


@query(
    "a3_audit_timestamp",
    f"""SELECT event_id, CASE WHEN event_type = 'error' THEN -1 ELSE ts_ms END AS audit_ts
        FROM {MESSAGES_SQL}""",
)
def a3_audit_timestamp(spark, sf_dir):
    """The header time, or -1 for messages without header."""
    rows = tables.events(spark, sf_dir)
    framed = F.when(F.col("topic") == "error", F.col("payload")).otherwise(
        codec.with_header(F.col("payload"), F.col("ts_ms"))
    )
    return rows.select("event_id", codec.audit_ts(framed).alias("audit_ts"))


@query("a4_received_counts", f"SELECT * FROM {COUNTS_SQL}")
def a4_received_counts(spark, sf_dir):
    return audit.audit_counts(tables.events(spark, sf_dir))


@query(
    "a4_hourly_counts",
    f"""SELECT topic, ts_ms - ts_ms % 3600000 AS window_ms, count(*) AS received
        FROM {MESSAGES_SQL} GROUP BY ALL""",
)
def a4_hourly_counts(spark, sf_dir):
    return audit.audit_counts(tables.events(spark, sf_dir), window_sec=3600)


@query(
    "a5_sent_counts",
    f"""SELECT topic, ts_ms - ts_ms % 3600000 AS window_ms,
        count(*) FILTER (kind = 'INVOCATION') AS received,
        count(*) FILTER (kind = 'SUCCESS') AS sent FROM {LOG_SQL} GROUP BY ALL""",
)
def a5_sent_counts(spark, sf_dir):
    return audit.sent_counts(tables.publish_log(spark, sf_dir), window_sec=3600)


@query(
    "a6_audit_packets",
    f"""SELECT topic, 'publisher' AS tier, 'host0' AS hostname, 60 AS window_size,
        window_ms, received FROM {COUNTS_SQL}""",
)
def a6_audit_packets(spark, sf_dir):
    """Packets of all windows, flattened again."""
    counts = audit.audit_counts(tables.events(spark, sf_dir))
    packets = audit.audit_packets(counts, "publisher", "host0", 1706745600000)
    flat = F.explode("received").alias("window_ms", "received")
    return packets.select("topic", "tier", "hostname", "window_size", flat)


def _tier(df: DataFrame, name: str) -> DataFrame:
    counts = df.groupBy(F.col("event_type").alias("topic")).agg(F.count(F.lit(1)).alias("value"))
    return counts.withColumn("tier", F.lit(name))


@query(
    "a8_reconcile_tiers",
    """WITH t AS (SELECT event_type AS topic, count(*) AS publisher, count(*) AS agent,
         count(*) FILTER (value >= 0.5 OR event_type = 'view') AS collector,
         count(*) AS storage FROM events GROUP BY ALL)
       SELECT *, agent - publisher AS agent_diff, collector - publisher AS collector_diff,
         storage - publisher AS storage_diff,
         agent = publisher AND collector = publisher AND storage = publisher AS matches FROM t""",
)
def a8_reconcile_tiers(spark, sf_dir):
    """Counts at four tiers: the collector lost cheap messages, storage is a published stream."""
    rows = tables.table(spark, sf_dir, "events")
    kept = rows.filter((F.col("value") >= 0.5) | (F.col("event_type") == "view"))
    read = read_messages(spark, tables.local_roots(spark, sf_dir), tables.TOPIC)
    stored = tables.message_fields(read).select("event_id")
    stored = stored.join(rows.select("event_id", "event_type"), "event_id")
    tiers = {"publisher": rows, "agent": rows, "collector": kept, "storage": stored}
    counts = reduce(DataFrame.unionByName, [_tier(df, name) for name, df in tiers.items()])
    return audit.reconcile(counts, list(tiers))


@query(
    "a9_counter_delta",
    """WITH b AS (SELECT user_id, count(*) AS value FROM events
                  WHERE ts < TIMESTAMP '2024-01-10' GROUP BY ALL),
            a AS (SELECT user_id, count(*) AS value FROM events
                  WHERE event_type <> 'error' GROUP BY ALL)
       SELECT user_id, coalesce(a.value, 0) - coalesce(b.value, 0) AS delta
       FROM a FULL JOIN b USING (user_id)""",
)
def a9_counter_delta(spark, sf_dir):
    """Counters per user in two snapshots."""
    rows = tables.events(spark, sf_dir)

    def snapshot(df: DataFrame) -> DataFrame:
        return df.groupBy("user_id").agg(F.count(F.lit(1)).alias("value"))

    before = snapshot(rows.filter(F.col("ts") < F.lit("2024-01-10").cast("timestamp")))
    after = snapshot(rows.filter(F.col("event_type") != "error"))
    return audit.counter_delta(before, after, ["user_id"])
