"""A global rank that is computed in many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import stored


def global_rank(df: DataFrame, order: list[Column], name: str, partitions: int | None = None, keep: list[str] | None = None) -> DataFrame:
    """1-based places of rows in a total order.

    Rows are dealt by range of the order and sorted there; each is stored with its range and its place
    in it, and a range's start is the number of rows in the ranges before it. The ranges' sizes are one
    row each. Sizes and places come from the stored rows: ranges drawn a second time might differ.
    ``keep`` names the columns that are stored (all, if it is not given); others serve the order only.
    ``order`` must leave no ties, or tied rows may swap between a failed task and its repetition.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    kept = df.columns if keep is None else keep
    rows = stored(ranged.select(*kept, F.shiftright(at, 33).alias("_range"), at.bitwiseAND((1 << 33) - 1).alias("_place")), "ranks")
    sizes = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return rows.join(F.broadcast(starts), "_range").select(*kept, (F.col("_start") + F.col("_place") + 1).alias(name))
