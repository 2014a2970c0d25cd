"""Queries over the delivery check of numbered messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from minuteflow.operators import validate
from minuteflow.plans import tables
from minuteflow.plans.registry import SEQUENCES_SQL, query

PRODUCERS = 4
# Numbers that can be read: a line without delimiter has no number.
ARRIVALS_SQL = f"""(SELECT l_orderkey AS seq, count(*) AS arrivals
  FROM {SEQUENCES_SQL} WHERE NOT broken GROUP BY ALL)"""
TOP_SQL = "(SELECT max(o_orderkey) FROM orders)"
EXTRA_SQL = f"(SELECT CAST(sum(greatest(arrivals - 4, 0)) AS BIGINT) FROM {ARRIVALS_SQL})"
FULL_SQL = f"""(SELECT count(*) FROM {ARRIVALS_SQL}
  WHERE seq BETWEEN 1 AND {TOP_SQL} AND arrivals >= 4)"""
OUTSIDE_SQL = f"""(SELECT count(*) FROM {ARRIVALS_SQL} WHERE seq NOT BETWEEN 1 AND {TOP_SQL})"""
LATENCY_SQL = f"""(SELECT sum(arrival_ms - sent_ms) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY arrival_ms, sent_ms) AS n
  FROM {SEQUENCES_SQL} WHERE NOT broken) WHERE n <= 4)"""


def _top(spark, sf_dir) -> int:
    return tables.table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0]


def _parsed(spark, sf_dir):
    return validate.parse_sequence(tables.sequences(spark, sf_dir))


@query(
    "v1_parse_sequence",
    f"""SELECT l_orderkey, l_linenumber, broken AS corrupt,
        CASE WHEN NOT broken THEN l_orderkey END AS seq,
        CASE WHEN NOT broken THEN sent_ms END AS sent_ms,
        CASE WHEN NOT broken THEN filler END AS filler FROM {SEQUENCES_SQL}""",
)
def v1_parse_sequence(spark, sf_dir):
    return _parsed(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "corrupt", "seq", "sent_ms", "filler"
    )


@query("v2_duplicates", f"SELECT {EXTRA_SQL} AS duplicates")
def v2_duplicates(spark, sf_dir):
    return validate.duplicates(_parsed(spark, sf_dir), PRODUCERS)


@query(
    "v3_missing",
    f"""SELECT r.seq, coalesce(a.arrivals, 0) AS arrivals
        FROM (SELECT unnest(generate_series(1, {TOP_SQL})) AS seq) r
        LEFT JOIN {ARRIVALS_SQL} a USING (seq) WHERE coalesce(a.arrivals, 0) < 4""",
)
def v3_missing(spark, sf_dir):
    return validate.missing(_parsed(spark, sf_dir), _top(spark, sf_dir), PRODUCERS)


@query(
    "v3_missing_ranges",
    f"""SELECT arrivals, CAST(count(*) AS BIGINT) AS numbers, CAST(sum(seq) AS BIGINT) AS total FROM (
          SELECT r.seq, coalesce(a.arrivals, 0) AS arrivals
          FROM (SELECT unnest(generate_series(1, {TOP_SQL})) AS seq) r
          LEFT JOIN {ARRIVALS_SQL} a USING (seq) WHERE coalesce(a.arrivals, 0) < 4)
        GROUP BY arrivals""",
)
def v3_missing_ranges(spark, sf_dir):
    """How many numbers arrived how often, and their sum, from ranges alone."""
    found = validate.missing_ranges(_parsed(spark, sf_dir), _top(spark, sf_dir), PRODUCERS)
    n = F.col("last") - F.col("first") + 1
    return found.groupBy("arrivals").agg(
        F.sum(n).alias("numbers"),
        F.sum(F.expr("(first + last) * (last - first + 1) div 2")).alias("total"),
    )


VERDICT_SQL = f"""count(*) AS received, count(*) FILTER (broken) AS corrupt,
  count(*) FILTER (NOT broken AND filler <> 'N') AS mismatches, {EXTRA_SQL} AS duplicates,
  {TOP_SQL} - {FULL_SQL} AS missing, {OUTSIDE_SQL} AS unexpected"""


@query(
    "v4_mismatches",
    f"""SELECT count(*) FILTER (broken) AS corrupt,
        count(*) FILTER (NOT broken AND filler <> 'N') AS mismatches FROM {SEQUENCES_SQL}""",
)
def v4_mismatches(spark, sf_dir):
    verdict = validate.validate(_parsed(spark, sf_dir), _top(spark, sf_dir), PRODUCERS, "N")
    return verdict.select("corrupt", "mismatches")


@query(
    "v5_mean_latency",
    f"""SELECT count(*) AS received, CAST({LATENCY_SQL} // count(*) AS BIGINT) AS mean_latency_ms
        FROM {SEQUENCES_SQL}""",
)
def v5_mean_latency(spark, sf_dir):
    verdict = validate.validate(
        _parsed(spark, sf_dir), _top(spark, sf_dir), PRODUCERS, "N", "arrival_ms"
    )
    return verdict.select("received", "mean_latency_ms")


@query(
    "v6_verdict",
    f"""SELECT *, duplicates = 0 AND missing = 0 AND unexpected = 0 AND mismatches = 0
        AND corrupt = 0 AS success FROM (SELECT {VERDICT_SQL} FROM {SEQUENCES_SQL})""",
)
def v6_verdict(spark, sf_dir):
    return validate.validate(_parsed(spark, sf_dir), _top(spark, sf_dir), PRODUCERS, "N")


@query(
    "v6_verdict_clean",
    """SELECT count(*) AS received, CAST(0 AS BIGINT) AS corrupt, CAST(0 AS BIGINT) AS mismatches,
       CAST(0 AS BIGINT) AS duplicates, CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS unexpected,
       true AS success FROM events""",
)
def v6_verdict_clean(spark, sf_dir):
    """Every event once, numbered from 1: the run is good."""
    rows = tables.events(spark, sf_dir)
    payload = validate.sequence_payload(F.col("event_id") + 1, F.col("ts_ms"), F.lit("AAAA"))
    parsed = validate.parse_sequence(rows.select(payload.cast("binary").alias("payload")))
    return validate.validate(parsed, rows.count(), 1, "AAAA")
