"""Registers queries by name, each with the DuckDB SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch  # noqa: F401  (for the plans)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

#: The trades that ``trades`` makes of the events table, for the oracle.
TRADES = """trades AS (SELECT event_type AS pool, CAST(ts AS DATE) AS blk, CAST(ts AS DATE) AS day, ts, event_id AS log_index,
  user_id AS sender, event_id // 3 AS tx,
  (CASE WHEN event_id % 2 = 0 THEN 1 ELSE -1 END) * CAST(round(value * 100) AS BIGINT) AS other_raw, value AS usd FROM events)"""


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def keep(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if oracle is not None:
            ORACLE[name] = oracle
        return function

    return keep


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as trades: a pool for each type, a block for each day, a sender for each
    user, a transaction for three neighbouring events."""
    amount = F.round(F.col("value") * 100).cast("long")
    return read(spark, sf_dir, "events").select(
        F.col("event_type").alias("pool"), F.to_date("ts").alias("blk"), F.to_date("ts").alias("day"), "ts", F.col("event_id").alias("log_index"),
        F.col("user_id").alias("sender"), F.floor(F.col("event_id") / 3).cast("long").alias("tx"),
        F.when(F.col("event_id") % 2 == 0, amount).otherwise(-amount).alias("other_raw"), F.col("value").alias("usd"),
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two pools of a pair as one stream of square-root prices, in buckets of days."""
    rows = trades(spark, sf_dir).filter("pool in ('click', 'view') and usd > 0")
    return rows.select(F.lit("pair").alias("pair"), F.when(F.col("pool") == "click", "lo").otherwise("hi").alias("mover"), F.col("log_index").alias("pos"), F.datediff("day", F.lit("2024-01-01")).cast("long").alias("blk"), "tx", F.col("usd").alias("sp"), "day")


#: The same stream, and the gaps found by two as-of joins, for the oracle.
PRICES = """lo AS (SELECT 1 AS k, event_id AS pos, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS blk, event_id // 3 AS tx, value AS sp FROM events WHERE event_type = 'click' AND value > 0),
hi AS (SELECT 1 AS k, event_id AS pos, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS blk, event_id // 3 AS tx, value AS sp FROM events WHERE event_type = 'view' AND value > 0),
gaps AS (
  SELECT lo.blk, lo.pos, lo.tx, 'lo' AS mover, 2e4 * ln(lo.sp / hi.sp) AS gap FROM lo ASOF JOIN hi ON lo.k = hi.k AND lo.pos > hi.pos
  UNION ALL
  SELECT hi.blk, hi.pos, hi.tx, 'hi' AS mover, 2e4 * ln(lo.sp / hi.sp) AS gap FROM hi ASOF JOIN lo ON hi.k = lo.k AND hi.pos > lo.pos)"""
