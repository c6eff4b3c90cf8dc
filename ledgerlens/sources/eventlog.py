"""Slow queries from Spark's event log, which stands in for a server's query log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart"
END = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionEnd"
LINE = "Event string, executionId long, description string, time long"


def slowest(lines: DataFrame, top: int = 20) -> DataFrame:
    """Queries (by description, white space made one space) with the longest runs: query, runs,
    slowest_ms, mean_ms. ``lines``: value, as ``spark.read.text`` gives them."""
    events = lines.select(F.from_json("value", LINE).alias("e")).select("e.*").filter(F.col("Event").isin(START, END))
    time = lambda kind: F.max(F.when(F.col("Event") == kind, F.col("time")))
    runs = events.groupBy("executionId").agg(F.max("description").alias("text"), (time(END) - time(START)).alias("ms")).filter("ms is not null")
    name = F.regexp_replace(F.trim("text"), r"\s+", " ")
    per = runs.groupBy(name.alias("query")).agg(F.count(F.lit(1)).alias("runs"), F.max("ms").alias("slowest_ms"), F.avg("ms").alias("mean_ms"))
    return per.orderBy(F.desc("slowest_ms"), "query").limit(top)
