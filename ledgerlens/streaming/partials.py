"""A daily aggregate kept up by a stream: each batch appends its partial sums, reading adds them
up. Batches are keyed by their number, so a repeated batch replaces itself; the backfill is batch
-1, so a repeated backfill does too."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BACKFILL = -1


def partial(rows: DataFrame) -> DataFrame:
    """``rows``: pool, day, raw. Partial sums whose sum is the sum."""
    return rows.groupBy("pool", "day").agg(F.count(F.lit(1)).alias("trades"), F.sum("raw").alias("raw"))


class DailyPartials:
    def __init__(self, spark: SparkSession, home: str):
        self.spark, self.home = spark, home

    def _write(self, rows: DataFrame, batch: int) -> None:
        partial(rows).write.mode("overwrite").parquet(f"{self.home}/partials/batch={batch}")

    def follow(self, stream: DataFrame, wait: bool = True):
        """Take in what a stream has (to its end), a partial for each batch."""
        query = stream.writeStream.foreachBatch(lambda rows, n: self._write(rows, n)).option("checkpointLocation", f"{self.home}/place").trigger(availableNow=True).start()
        if wait:
            query.awaitTermination()
        return query

    def backfill(self, rows: DataFrame) -> None:
        """Rows from before the stream, which never reads the past."""
        self._write(rows, BACKFILL)

    def rebuild(self, rows: DataFrame) -> None:
        """Replace all partials by those of the whole table, after a repair of it."""
        partial(rows).withColumn("batch", F.lit(BACKFILL)).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("batch").parquet(f"{self.home}/partials")

    def daily(self) -> DataFrame:
        rows = self.spark.read.schema("pool string, day date, trades long, raw long, batch long").parquet(f"{self.home}/partials")
        return rows.groupBy("pool", "day").agg(F.sum("trades").alias("trades"), F.sum("raw").alias("raw"))

    def problems(self, rows: DataFrame) -> DataFrame:
        """Pool-days on which the partials do not add up to the table: expected to be none."""
        from ..operators.quality import accounts_for

        return accounts_for(self.daily(), partial(rows), ["pool", "day"], ["trades", "raw"])


def windowed(stream: DataFrame, late: str = "1 hour", size: str = "1 day") -> DataFrame:
    """Event-time windows with a watermark over (pool, ts, raw)."""
    return stream.withWatermark("ts", late).groupBy(F.window("ts", size).alias("w"), "pool").agg(F.count(F.lit(1)).alias("trades"), F.sum("raw").alias("raw"))


def sessions(stream: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Sessions of a sender over (sender, ts)."""
    return stream.groupBy(F.session_window("ts", gap).alias("w"), "sender").agg(F.count(F.lit(1)).alias("trades"))
