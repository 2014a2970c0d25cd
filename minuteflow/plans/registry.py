"""Registry of queries: a name, a function of (spark, sf_dir) and its SQL check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with the SQL that gives the same rows."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


# SQL fragments over the shared tables, used by several checks.
MESSAGES_SQL = """(
  SELECT *, event_type AS topic, 'c' || (user_id % 2) AS cluster,
         'collector' || (user_id % 4) AS collector, date_trunc('minute', ts) AS minute,
         epoch_us(ts) // 1000 AS ts_ms,
         event_id || '|' || user_id || '|' || props AS payload,
         TIMESTAMP '2024-01-01' + INTERVAL 1 MINUTE * ((day(ts) - 1) // 5) AS block
  FROM events)"""

LOG_SQL = """(
  SELECT CASE WHEN user_id % 3 = 2 THEN '_audit' ELSE 't' || (user_id % 3) END AS topic,
         'p' || (user_id % 4) AS publisher, epoch_us(ts) // 1000 AS ts_ms, k.kind AS kind,
         CAST(floor(value * 1000) AS BIGINT) AS nanos
  FROM events,
       LATERAL (SELECT unnest(['INVOCATION',
         CASE event_type WHEN 'purchase' THEN 'GRACEFUL_FAILURE' WHEN 'error' THEN 'LOST'
                         WHEN 'signup' THEN 'RETRY' ELSE 'SUCCESS' END,
         CASE WHEN value > 50 THEN 'RECONNECT' END]) AS kind) k
  WHERE k.kind IS NOT NULL)"""

SEQUENCES_SQL = """(
  SELECT l_orderkey, l_linenumber, l_tax = 0 AS broken, l_returnflag AS filler,
         epoch_us(l_shipdate) // 1000 AS sent_ms,
         epoch_us(l_shipdate) // 1000 + CAST(floor(l_quantity * 1000) AS BIGINT) AS arrival_ms
  FROM lineitem)"""
