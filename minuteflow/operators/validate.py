"""End-to-end delivery check of numbered messages.

A payload is ``seq/tsent_ms/tfiller``; the delimiter is the two characters
``/t``. Each of ``producers`` producers sends every number 1..``max_seq`` once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from minuteflow.session import broadcast_if_small, stored

# Fixed delimiter of the payload: a slash and the letter t, not a tab.
DELIMITER = "/t"


def sequence_payload(seq: Column, sent_ms: Column, filler: Column) -> Column:
    return F.concat_ws(DELIMITER, seq.cast("string"), sent_ms.cast("string"), filler)


def parse_sequence(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Add ``seq, sent_ms, filler, corrupt``. A part that cannot be read is NULL.

    A payload that ends with the delimiter has no filler.
    """
    text = F.col(payload).cast("string")
    after_seq = F.substring(text, F.locate(DELIMITER, text) + 2, F.length(text))
    after_sent = F.substring(after_seq, F.locate(DELIMITER, after_seq) + 2, F.length(text))
    both = (F.locate(DELIMITER, text) > 0) & (F.locate(DELIMITER, after_seq) > 0)
    filler = F.nullif(F.substring_index(after_sent, DELIMITER, 1), F.lit(""))
    parsed = df.withColumns(
        {
            "seq": F.substring_index(text, DELIMITER, 1).try_cast("long"),
            "sent_ms": F.when(
                F.locate(DELIMITER, text) > 0,
                F.substring_index(after_seq, DELIMITER, 1).try_cast("long"),
            ),
            "filler": F.when(both, filler),
        }
    )
    broken = F.col("seq").isNull() | F.col("sent_ms").isNull() | F.col("filler").isNull()
    return parsed.withColumn("corrupt", broken)


def sequence_counts(parsed: DataFrame) -> DataFrame:
    """How often each number arrived."""
    known = parsed.filter(F.col("seq").isNotNull())
    return known.groupBy("seq").agg(F.count(F.lit(1)).alias("arrivals"))


def duplicates(parsed: DataFrame, producers: int) -> DataFrame:
    """Total arrivals beyond one per producer."""
    extra = F.greatest(F.col("arrivals") - producers, F.lit(0))
    return sequence_counts(parsed).agg(F.coalesce(F.sum(extra), F.lit(0)).alias("duplicates"))


def missing_ranges(parsed: DataFrame, max_seq: int, producers: int) -> DataFrame:
    """Runs ``first`` to ``last`` of numbers in 1..``max_seq`` with equally many ``arrivals``, too few.

    Only numbers that arrived are ordered, by ranges, so a gap of any length is one row. Each task finds
    the runs between its own numbers; the first and last number of every task, one row each, come
    to the driver and give what lies between tasks.
    """
    spark = parsed.sparkSession
    counts = sequence_counts(parsed).filter(F.col("seq").between(1, max_seq))
    ordered = stored(
        counts.repartitionByRange("seq").sortWithinPartitions("seq").withColumn(
            "_task", F.spark_partition_id()
        ),
        "arrived",
    )
    edges = ordered.groupBy("_task").agg(F.min("seq").alias("first"), F.max("seq").alias("last"))
    before, rows = 0, []
    for edge in sorted(edges.collect(), key=lambda e: e["first"]):
        rows.append((edge["_task"], before))
        before = edge["last"]
    border = spark.createDataFrame(rows, "_task int, _border long")
    # A number of its task's rows goes after the one before it there, or after the task before.
    earlier = Window.partitionBy("_task").orderBy("seq")
    placed = ordered.join(F.broadcast(border), "_task").withColumn(
        "_before", F.coalesce(F.lag("seq").over(earlier), "_border")
    )
    gaps = placed.filter(F.col("seq") > F.col("_before") + 1).select(
        (F.col("_before") + 1).alias("first"),
        (F.col("seq") - 1).alias("last"),
        F.lit(0).cast("long").alias("arrivals"),
    )
    if before < max_seq:
        gaps = gaps.unionByName(
            spark.createDataFrame([(before + 1, max_seq, 0)], "first long, last long, arrivals long")
        )
    # Numbers that follow each other with the same count make one run, per task.
    few = placed.filter(F.col("arrivals") < producers)
    run = Window.partitionBy("_task", "arrivals").orderBy("seq")
    few = few.withColumn("_run", F.col("seq") - F.row_number().over(run))
    runs = few.groupBy("_task", "arrivals", "_run").agg(
        F.min("seq").alias("first"), F.max("seq").alias("last")
    )
    return gaps.unionByName(runs.select("first", "last", "arrivals"))


def missing(parsed: DataFrame, max_seq: int, producers: int) -> DataFrame:
    """Numbers that arrived from too few producers, with the count that did arrive."""
    ranges = missing_ranges(parsed, max_seq, producers)
    return ranges.select(F.explode(F.sequence("first", "last")).alias("seq"), "arrivals")


def _delays(parsed: DataFrame, arrival_ms: str) -> DataFrame:
    return parsed.filter(F.col("seq").isNotNull() & F.col("sent_ms").isNotNull()).withColumn(
        "_delay", F.col(arrival_ms) - F.col("sent_ms")
    )


def latency(parsed: DataFrame, producers: int, arrival_ms: str = "arrival_ms") -> DataFrame:
    """Sum of delays over the first ``producers`` arrivals of each number.

    Delays are added up per number in one pass; only numbers that arrived too often are looked at again.
    """
    per_seq = _delays(parsed, arrival_ms).groupBy("seq").agg(
        F.count(F.lit(1)).alias("timed"), F.sum("_delay").alias("delay")
    )
    return _first_delays(parsed, stored(per_seq, "delays"), producers, arrival_ms)


def _first_delays(parsed: DataFrame, per_seq: DataFrame, producers: int, arrival_ms: str) -> DataFrame:
    """``total_latency_ms`` from ``seq, timed, delay`` of every number.

    Only numbers that arrived more often than ``producers`` are ordered, and without them messages
    are not read again. Spark cuts each such number to its first arrivals before the shuffle.
    """
    often = per_seq.filter((F.col("timed") > producers) & F.col("seq").isNotNull()).select("seq")
    seldom = per_seq.filter(F.col("timed") <= producers)
    parts = seldom.filter(F.col("seq").isNotNull()).select("delay")
    if not often.isEmpty():
        rows = _delays(parsed, arrival_ms).join(broadcast_if_small(often), "seq", "left_semi")
        order = Window.partitionBy("seq").orderBy(arrival_ms, "sent_ms")
        first = rows.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= producers)
        parts = parts.unionByName(first.select(F.col("_delay").alias("delay")))
    return parts.agg(F.coalesce(F.sum("delay"), F.lit(0)).alias("total_latency_ms"))


def validate(
    parsed: DataFrame,
    max_seq: int,
    producers: int,
    filler: str,
    arrival_ms: str | None = None,
) -> DataFrame:
    """One row: counters and ``success``."""
    seq, arrivals = F.col("seq"), F.col("arrivals")
    # One pass: counts per number, then totals. Unreadable numbers share the NULL group.
    timed = {}
    if arrival_ms is not None:
        known = F.col("sent_ms").isNotNull()
        delay = F.when(known, F.col(arrival_ms) - F.col("sent_ms"))
        timed = {"timed": F.count_if(known), "delay": F.sum(delay)}
    per_seq = parsed.groupBy("seq").agg(
        *[value.alias(name) for name, value in timed.items()],
        F.count(F.lit(1)).alias("arrivals"),
        F.count_if("corrupt").alias("corrupt"),
        F.count_if(~F.col("corrupt") & (F.col("filler") != filler)).alias("mismatches"),
    )
    if timed:
        per_seq = stored(per_seq, "per-number")
    in_range = seq.between(1, max_seq)
    extra = F.when(seq.isNotNull(), F.greatest(arrivals - producers, F.lit(0)))
    sums = {"received": arrivals, "corrupt": F.col("corrupt"), "mismatches": F.col("mismatches"), "duplicates": extra}
    out = per_seq.agg(
        *[F.coalesce(F.sum(value), F.lit(0)).alias(name) for name, value in sums.items()],
        (F.lit(max_seq).cast("long") - F.count_if(in_range & (arrivals >= producers))).alias("missing"),
        F.count_if(~in_range).alias("unexpected"),
    )
    if arrival_ms is not None:
        # Two frames of one row each: stacked, then the only value of every column taken.
        stacked = out.unionByName(
            _first_delays(parsed, per_seq, producers, arrival_ms), allowMissingColumns=True
        )
        mean = F.when(F.col("received") > 0, F.expr("total_latency_ms div received"))
        out = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
        out = out.withColumn("mean_latency_ms", mean).drop("total_latency_ms")
    clean = F.lit(True)
    for c in ("duplicates", "missing", "unexpected", "mismatches", "corrupt"):
        clean = clean & (F.col(c) == 0)
    return out.withColumn("success", clean)
