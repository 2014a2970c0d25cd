"""Queries over start positions, ranges, groups and checkpoints."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from minuteflow.consumer import Consumer
from minuteflow.operators import checkpoint as cp
from minuteflow.operators import metrics, ranges
from minuteflow.operators.positions import consume, with_positions
from minuteflow.plans import tables
from minuteflow.plans.registry import MESSAGES_SQL, query
from minuteflow.session import work_dir
from minuteflow.sources import oplog
from minuteflow.sources.collectors import read_collectors
from minuteflow.sources.minutes import decode_messages, read_minutes

MINUTE = "yyyy-MM-dd HH:mm"
MIDDLE = datetime(2024, 1, 16)
RANGE = (datetime(2024, 1, 10, 6, 30, 20), datetime(2024, 1, 12, 18, 45, 5))

# Checkpoint of all messages, as SQL.
CHECKPOINT_SQL = f"""(
  SELECT cluster, minute(minute) AS minute_of_hour, max(minute) AS minute,
         arg_max(file_name, (minute, file_name, event_id)) AS file_name,
         CASE WHEN max(minute) < max(max(minute)) OVER (PARTITION BY cluster) THEN -1
              ELSE arg_max(event_id + 1, (minute, file_name, event_id)) END AS line_no
  FROM (SELECT *, collector || '-events-' || strftime(minute, '%Y-%m-%d-%H-%M') || '_00000.gz'
               AS file_name FROM {MESSAGES_SQL})
  GROUP BY cluster, minute(minute))"""


def _before_middle(df: DataFrame) -> DataFrame:
    return df.filter(F.col("ts") < ranges.minute_literal(MIDDLE))


def _middle_checkpoint(spark, sf_dir) -> DataFrame:
    """The checkpoint after the first half, as a stored table."""
    store = work_dir(spark, "checkpoints")
    built = cp.build_checkpoint(_before_middle(tables.positioned(spark, sf_dir)))
    cp.save_checkpoint(built, store, "consumer", tables.TOPIC)
    return cp.load_checkpoint(spark, store, "consumer", tables.TOPIC)


def _whole_checkpoint(spark, sf_dir) -> DataFrame:
    """The checkpoint after all messages, as a stored table."""
    store = work_dir(spark, "checkpoints")
    built = cp.build_checkpoint(tables.positioned(spark, sf_dir))
    cp.save_checkpoint(built, store, "consumer", tables.TOPIC)
    return cp.load_checkpoint(spark, store, "consumer", tables.TOPIC)


def _show(checkpoint: DataFrame) -> DataFrame:
    return checkpoint.select(
        "cluster", "minute_of_hour", F.date_format("minute", MINUTE).alias("minute"),
        F.col("file_key.file_name").alias("file_name"), "line_no",
    )


@query(
    "p1_start_position",
    f"""SELECT cluster, collector,
        CASE WHEN bool_or(ts < TIMESTAMP '2024-01-01 00:30:00') THEN 'checkpoint' ELSE 'relative'
        END AS start_kind,
        CASE WHEN NOT bool_or(ts < TIMESTAMP '2024-01-01 00:30:00') THEN '2024-01-30 22:00'
        END AS start_minute FROM {MESSAGES_SQL} GROUP BY ALL""",
)
def p1_start_position(spark, sf_dir):
    """Partitions with a checkpoint go on from it; the others start relative to now."""
    rows = tables.positioned(spark, sf_dir)
    early = rows.filter(F.col("ts") < F.lit("2024-01-01 00:30:00").cast("timestamp"))
    found = ranges.resolve_start(
        rows.select("cluster", "collector").distinct(),
        cp.build_checkpoint(early, "collector"),
        now=datetime(2024, 1, 31),
        relative_minutes=120,
        start=datetime(2024, 1, 2),
        keys=("cluster", "collector"),
    )
    return found.withColumn("start_minute", F.date_format("start_minute", MINUTE))


@query(
    "p2_time_range",
    f"""SELECT event_id, cluster FROM {MESSAGES_SQL} WHERE date_trunc('minute', ts)
        BETWEEN TIMESTAMP '2024-01-10 06:30:00' AND TIMESTAMP '2024-01-12 18:45:00'""",
)
def p2_time_range(spark, sf_dir):
    """Start and stop minute are both inclusive, whatever their seconds."""
    return ranges.time_range(tables.positioned(spark, sf_dir), *RANGE).select("event_id", "cluster")


@query(
    "p3_stream_start",
    f"""SELECT cluster, strftime(min(minute), '%Y-%m-%d %H:%M') AS start
        FROM {MESSAGES_SQL} GROUP BY ALL""",
)
def p3_stream_start(spark, sf_dir):
    starts = ranges.stream_start(tables.positioned(spark, sf_dir))
    return starts.select("cluster", F.date_format("start", MINUTE).alias("start"))


@query(
    "p4_complete_minutes",
    f"""WITH dirs AS (
          SELECT DISTINCT collector, TIMESTAMP '2024-01-01' + INTERVAL 1 MINUTE *
                 date_diff('hour', TIMESTAMP '2024-01-01', ts) AS minute FROM {MESSAGES_SQL}),
        marked AS (
          SELECT *, coalesce(lead(minute) OVER w = minute + INTERVAL 1 MINUTE, false) AS followed
          FROM dirs WINDOW w AS (PARTITION BY collector ORDER BY minute))
        SELECT collector, strftime(minute, '%Y-%m-%d %H:%M') AS minute FROM (
          SELECT *, bool_and(followed) OVER (PARTITION BY collector ORDER BY minute) AS complete
          FROM marked) WHERE complete""",
)
def p4_complete_minutes(spark, sf_dir):
    """Hours replayed as minutes: read each collector up to its first gap."""
    hour = F.timestamp_diff("HOUR", F.lit("2024-01-01").cast("timestamp"), F.col("ts"))
    minute = F.timestamp_add("MINUTE", hour.cast("int"), F.lit("2024-01-01").cast("timestamp"))
    dirs = tables.events(spark, sf_dir).select("collector", minute.alias("minute"))
    complete = ranges.complete_minutes(dirs.distinct(), keys=["collector"])
    return complete.select("collector", F.date_format("minute", MINUTE).alias("minute"))


@query(
    "p5_consumer_group",
    f"""SELECT event_id, 'member ' || (minute(minute) % 7 + 1) AS member FROM {MESSAGES_SQL}""",
)
def p5_consumer_group(spark, sf_dir):
    """Seven members of a group: each message belongs to exactly one of them."""
    rows = tables.positioned(spark, sf_dir)
    member = F.coalesce(
        *[F.when(ranges.owned(F.col("minute"), f"{k}/7"), f"member {k}") for k in range(1, 8)]
    )
    return rows.select("event_id", member.alias("member"))


@query(
    "p5_group_member",
    f"SELECT event_id FROM {MESSAGES_SQL} WHERE minute(minute) % 4 = 2",
)
def p5_group_member(spark, sf_dir):
    """The share of the third of four members."""
    return ranges.consumer_group(tables.positioned(spark, sf_dir), "3/4").select("event_id")


@query(
    "p7_build_checkpoint",
    f"""SELECT cluster, CAST(minute_of_hour AS INTEGER) AS minute_of_hour,
        strftime(minute, '%Y-%m-%d %H:%M') AS minute, file_name, CAST(line_no AS BIGINT) AS line_no
        FROM {CHECKPOINT_SQL}""",
)
def p7_build_checkpoint(spark, sf_dir):
    return _show(cp.build_checkpoint(tables.positioned(spark, sf_dir)))


@query(
    "p7_collector_checkpoint",
    f"""SELECT cluster, collector, strftime(max(minute), '%Y-%m-%d %H:%M') AS minute,
        arg_max(event_id + 1, (minute, event_id)) AS line_no FROM {MESSAGES_SQL} GROUP BY ALL""",
)
def p7_collector_checkpoint(spark, sf_dir):
    """One position per collector."""
    marks = cp.build_checkpoint(tables.positioned(spark, sf_dir), "collector")
    return marks.select(
        "cluster", "collector", F.date_format("minute", MINUTE).alias("minute"), "line_no"
    )


@query(
    "p8_resume",
    f"SELECT event_id, cluster FROM {MESSAGES_SQL} WHERE ts >= TIMESTAMP '2024-01-16'",
)
def p8_resume(spark, sf_dir):
    """What is left after the first half was consumed."""
    rest = cp.resume(tables.positioned(spark, sf_dir), _middle_checkpoint(spark, sf_dir))
    return rest.select("event_id", "cluster")


@query(
    "p8_resume_collector",
    f"SELECT event_id, collector FROM {MESSAGES_SQL} WHERE ts >= TIMESTAMP '2024-01-10 06:30:20'",
)
def p8_resume_collector(spark, sf_dir):
    """Collector streams resume inside a minute, at a line."""
    rows = tables.positioned(spark, sf_dir)
    cut = F.lit("2024-01-10 06:30:20").cast("timestamp")
    marks = cp.build_checkpoint(rows.filter(F.col("ts") < cut), "collector")
    return cp.resume(rows, marks, "collector").select("event_id", "collector")


@query(
    "p9_missing_checkpoint_file",
    f"SELECT event_id, cluster FROM {MESSAGES_SQL} WHERE ts >= TIMESTAMP '2024-01-16'",
)
def p9_missing_checkpoint_file(spark, sf_dir):
    """The files named in the checkpoint are gone: reading goes on after them."""
    marks = _middle_checkpoint(spark, sf_dir)
    gone = marks.select("cluster", F.col("file_key.file_name").alias("file_name"))
    rows = tables.positioned(spark, sf_dir)
    left = rows.join(gone, ["cluster", "file_name"], "left_anti")
    return cp.resume(left, marks).select("event_id", "cluster")


@query(
    "p10_least_checkpoint",
    f"""SELECT cluster, strftime(min(minute), '%Y-%m-%d %H:%M') AS least
        FROM {CHECKPOINT_SQL} GROUP BY ALL""",
)
def p10_least_checkpoint(spark, sf_dir):
    least = cp.least_checkpoint(_whole_checkpoint(spark, sf_dir))
    return least.select("cluster", F.date_format("least", MINUTE).alias("least"))


@query(
    "p11_fill_checkpoint",
    f"""WITH owned AS (
          SELECT unnest(generate_series(TIMESTAMP '2024-01-30 23:10:00',
                 TIMESTAMP '2024-01-30 23:50:00', INTERVAL 1 MINUTE)) AS gap),
        gaps AS (SELECT c.cluster, minute(gap) AS minute_of_hour, gap
                 FROM owned, (SELECT DISTINCT cluster FROM {CHECKPOINT_SQL}) c
                 WHERE minute(gap) % 2 = 0),
        merged AS (SELECT coalesce(c.cluster, g.cluster) AS cluster,
                   coalesce(c.minute_of_hour, g.minute_of_hour) AS minute_of_hour,
                   g.gap IS NOT NULL AND (c.minute IS NULL OR c.minute <= g.gap) AS filled,
                   c.minute, g.gap, c.file_name, c.line_no
                   FROM {CHECKPOINT_SQL} c FULL JOIN gaps g
                   ON c.cluster = g.cluster AND c.minute_of_hour = g.minute_of_hour)
        SELECT cluster, CAST(minute_of_hour AS INTEGER) AS minute_of_hour,
          strftime(CASE WHEN filled THEN gap ELSE minute END, '%Y-%m-%d %H:%M') AS minute,
          CASE WHEN NOT filled THEN file_name END AS file_name,
          CAST(CASE WHEN filled THEN -1 ELSE line_no END AS BIGINT) AS line_no FROM merged""",
)
def p11_fill_checkpoint(spark, sf_dir):
    """Empty minutes up to a stop time count as read for the first member of two."""
    filled = cp.fill_checkpoint(
        _whole_checkpoint(spark, sf_dir),
        datetime(2024, 1, 30, 23, 10),
        datetime(2024, 1, 30, 23, 50),
        group="1/2",
        inclusive=True,
    )
    return _show(filled)


@query(
    "p12_start_checkpoint",
    f"""SELECT s.cluster, CAST(minute(m) AS INTEGER) AS minute_of_hour,
        strftime(m, '%Y-%m-%d %H:%M') AS minute, CAST(0 AS BIGINT) AS line_no
        FROM (SELECT cluster, unnest(generate_series(min(minute), min(minute) + INTERVAL 59 MINUTE,
                     INTERVAL 1 MINUTE)) AS m
              FROM (SELECT cluster, TIMESTAMP '2024-01-01 00:20:00' AS minute FROM {MESSAGES_SQL})
              GROUP BY cluster) s
        WHERE minute(m) % 3 = 1""",
)
def p12_start_checkpoint(spark, sf_dir):
    """Positions of the second of three members before it has read anything."""
    clusters = tables.positioned(spark, sf_dir).select("cluster")
    marks = cp.start_checkpoint(clusters, datetime(2024, 1, 1, 0, 20), "2/3")
    return _show(marks).drop("file_name")


@query(
    "p13_checkpoint_store",
    f"""SELECT cluster, CAST(minute_of_hour AS INTEGER) AS minute_of_hour,
        strftime(minute, '%Y-%m-%d %H:%M') AS minute, file_name, CAST(line_no AS BIGINT) AS line_no
        FROM {CHECKPOINT_SQL}""",
)
def p13_checkpoint_store(spark, sf_dir):
    """Of two marks the later one is loaded."""
    store = work_dir(spark, "store")
    rows = tables.positioned(spark, sf_dir)
    first_day = rows.filter(F.col("ts") < F.lit("2024-01-02").cast("timestamp"))
    for consumed in (first_day, rows):
        cp.save_checkpoint(cp.build_checkpoint(consumed), store, "consumer", tables.TOPIC)
    return _show(cp.load_checkpoint(spark, store, "consumer", tables.TOPIC))


@query(
    "m3_consumer_log",
    f"""SELECT 'logged' AS consumer, CAST(count(*) AS BIGINT) AS messages_consumed,
        CAST(3 AS BIGINT) AS mark_calls, CAST(1 AS BIGINT) AS reset_calls, CAST(1 AS BIGINT) AS timeouts
        FROM {MESSAGES_SQL}""",
)
def m3_consumer_log(spark, sf_dir):
    """Counts from the log of a consumer that reads half, marks, starts again, reads the rest, resets, reads
    and marks it, and then finds nothing more.
    """
    roots, log = tables.local_roots(spark, sf_dir), work_dir(spark, "log")
    store = work_dir(spark, "logged")
    for stop in (datetime(2024, 1, 1, 0, 3), None):
        member = Consumer(
            spark, tables.TOPIC, "logged", roots, store, start_of_stream=True, stop=stop, log=log
        )
        member.read()
        if stop is None:
            member.reset()
            member.read()
        member.mark()
    member.read()
    member.mark()
    return metrics.consumer_stats(oplog.consumed_log(spark, log)).drop("topic")


@query(
    "p13_group_marks",
    f"""SELECT event_id, CAST(minute(block + INTERVAL 1 MINUTE) % 2 + 1 AS BIGINT) AS member,
        CAST(CASE WHEN minute(block) < 3 THEN 1 ELSE 2 END AS BIGINT) AS read_no
        FROM {MESSAGES_SQL}""",
)
def p13_group_marks(spark, sf_dir):
    """Two members of one name read half, mark, the second one first, start again and read the rest."""
    roots = tables.local_roots(spark, sf_dir)
    store = work_dir(spark, "group")
    reads = []
    for number, stop in enumerate((datetime(2024, 1, 1, 0, 3), None), 1):
        members = {
            k: Consumer(
                spark, tables.TOPIC, "group", roots, store,
                group=f"{k}/2", start_of_stream=True, stop=stop,
            )
            for k in (1, 2)
        }
        for k, member in members.items():
            rows = tables.message_fields(member.read()).select("event_id")
            reads.append(rows.withColumns({"member": F.lit(k).cast("long"), "read_no": F.lit(number).cast("long")}))
        for k in (2, 1) if stop else ():
            members[k].mark()
    return reduce(DataFrame.unionByName, reads)


@query(
    "p14_rename_clusters",
    f"""SELECT CASE cluster WHEN 'c0' THEN 'west' ELSE cluster END AS cluster,
        CAST(minute_of_hour AS INTEGER) AS minute_of_hour,
        strftime(minute, '%Y-%m-%d %H:%M') AS minute, file_name, CAST(line_no AS BIGINT) AS line_no
        FROM {CHECKPOINT_SQL}""",
)
def p14_rename_clusters(spark, sf_dir):
    return _show(cp.rename_clusters(_whole_checkpoint(spark, sf_dir), {"c0": "west"}))


@query(
    "p15_mark_and_reset",
    f"""SELECT event_id, cluster, CAST(CASE WHEN minute(block) < 3 THEN 1 ELSE 2 END AS BIGINT) AS reads
        FROM {MESSAGES_SQL}""",
)
def p15_mark_and_reset(spark, sf_dir):
    """Read half of a published stream, mark, read on, reset, read the rest again."""
    roots = tables.local_roots(spark, sf_dir)
    scan = read_minutes(spark, roots, tables.TOPIC)
    lines = with_positions(scan)
    store = work_dir(spark, "marks")
    half = ranges.time_range(lines, None, datetime(2024, 1, 1, 0, 3))
    cp.save_checkpoint(cp.build_checkpoint(half), store, "consumer", tables.TOPIC)
    mark = cp.load_checkpoint(spark, store, "consumer", tables.TOPIC)
    again = cp.resume(with_positions(scan.filter(cp.unread_files(mark))), mark)
    reads = lines.select("cluster", "value").unionByName(again.select("cluster", "value"))
    return (
        tables.message_fields(decode_messages(reads))
        .groupBy("event_id", "cluster")
        .agg(F.count(F.lit(1)).alias("reads"))
    )


@query(
    "p15_stitched_increment",
    f"""SELECT event_id, collector,
        CAST(CASE WHEN minute(block) <= 2 THEN 1 ELSE 2 END AS BIGINT) AS read_no
        FROM {MESSAGES_SQL}""",
)
def p15_stitched_increment(spark, sf_dir):
    """A consumer of moving collector files marks its first read; the second has only the rest."""
    roots = tables.stitched_root(spark, sf_dir)
    store = work_dir(spark, "increments")
    reads = []
    for number, stop in enumerate((datetime(2024, 1, 1, 0, 2), None), 1):
        consumer = Consumer(
            spark, tables.TOPIC, "increment", roots, store,
            stream_type="stitched", start_of_stream=True, stop=stop,
        )
        rows = tables.message_fields(consumer.read())
        reads.append(rows.select("event_id", "collector", F.lit(number).cast("long").alias("read_no")))
        consumer.mark()
    return reads[0].unionByName(reads[1])


@query(
    "p16_bounded_consumption",
    """SELECT event_id FROM events ORDER BY date_trunc('minute', ts),
       'c' || (user_id % 2), 'collector' || (user_id % 4), event_id LIMIT 700""",
)
def p16_bounded_consumption(spark, sf_dir):
    """The first 700 messages in stream order."""
    return consume(tables.dense_positions(spark, sf_dir), 700).select("event_id")


@query(
    "p16_consume_published",
    f"""SELECT cluster, collector, strftime(block, '%Y-%m-%d %H:%M') AS file_minute,
        count(*) AS messages FROM (
          SELECT *, row_number() OVER (ORDER BY cluster, collector, block, event_id) AS n
          FROM {MESSAGES_SQL}) WHERE n <= 600 GROUP BY ALL""",
)
def p16_consume_published(spark, sf_dir):
    """The first 600 messages of published collector files, by line number."""
    lines = read_collectors(spark, tables.collector_roots(spark, sf_dir), tables.TOPIC)
    taken = consume(with_positions(lines), 600, "collector")
    minute = F.date_format("file_minute", MINUTE).alias("file_minute")
    return taken.groupBy("cluster", "collector", minute).agg(F.count(F.lit(1)).alias("messages"))
