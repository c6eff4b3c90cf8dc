"""The quantile rules in use. Only ``percentile_*`` of Spark interpolate or take lower elements,
so the element rules are spelled out on sorted arrays (small groups) or ranks (large ones)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import stored


def upper_element(values: Column, p: float) -> Column:
    """sorted[floor(p * n)], at most the last; null of no values. ``values``: an array."""
    ordered = F.array_sort(F.filter(values, lambda x: x.isNotNull()))
    place = F.least(F.floor(F.size(ordered) * F.lit(p)), F.size(ordered) - 1)
    return F.get(ordered, place.cast("int"))


def nearest_index(values: Column, q: float) -> Column:
    """sorted[int(q * (n - 1) + 0.5)]."""
    ordered = F.array_sort(F.filter(values, lambda x: x.isNotNull()))
    return F.get(ordered, F.floor(F.lit(q) * (F.size(ordered) - 1) + 0.5).cast("int"))


def nearest_rank(values: Column, q: float) -> Column:
    """sorted[ceil(q * n) - 1]."""
    ordered = F.array_sort(F.filter(values, lambda x: x.isNotNull()))
    return F.get(ordered, F.greatest(F.lit(0), F.ceil(F.lit(q) * F.size(ordered)) - 1).cast("int"))


def exact_by_rank(df: DataFrame, keys: list[str], value: str, ps: dict[str, float]) -> DataFrame:
    """``upper_element`` of groups of any size, exactly and without one task for a group.

    Equal values are counted, the distinct ones dealt into ranges, and the ranges' sums tell in
    which of them an element lies; only those ranges are looked through, each by itself. Null
    values do not count; a group without others has no row.
    """
    spark = df.sparkSession
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    # two ranges for each core, whatever the session's number for joins
    ranges = max(2, 2 * spark.sparkContext.defaultParallelism)
    ranged = stored(counted.repartitionByRange(ranges, *keys, "v").withColumn("part", F.spark_partition_id()), "quantiles")
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))  # over sums: a row for each range
    sums = ranged.groupBy(*keys, "part").agg(F.sum("c").alias("s"))
    sums = sums.withColumn("n", F.sum("s").over(group)).withColumn("before", F.sum("s").over(group.orderBy("part")) - F.col("s"))
    place = lambda p: F.least(F.floor(F.col("n") * F.lit(p)), F.col("n") - 1)
    wanted = reduce(lambda x, y: x | y, [(F.col("before") <= place(p)) & (place(p) < F.col("before") + F.col("s")) for p in ps.values()])
    here = sums.filter(wanted).select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("part").alias("_part"), "n", "before")
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], F.col("part") == F.col("_part"))
    upto = F.col("before") + F.sum("c").over(Window.partitionBy(*keys, "part").orderBy("v"))
    ranked = ranged.join(here, same).withColumn("upto", upto)
    return ranked.groupBy(*keys).agg(*[F.min(F.when(F.col("upto") > place(p), F.col("v"))).alias(name) for name, p in ps.items()])


def quantiles_of(df: DataFrame, keys: list[str], wanted: dict[str, dict[str, float]]) -> DataFrame:
    """``exact_by_rank`` of several numeric columns of one frame, from one table of counts:
    ``wanted`` has the quantiles by name of each column. Results have the columns' types (integers
    up to 2^53 are exact). A group without any value has no row."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    each = [F.struct(F.lit(c).alias("_of"), F.col(c).cast("double").alias("_v")) for c in wanted]
    rows = df.select(*keys, F.explode(F.array(*each)).alias("x")).select(*keys, "x._of", "x._v")
    ps = {f"{c}/{name}": p for c, names in wanted.items() for name, p in names.items()}
    found = exact_by_rank(rows, [*keys, "_of"], "_v", ps)
    pick = [F.max(F.when(F.col("_of") == c, F.col(f"`{c}/{name}`"))).cast(kinds[c]).alias(name) for c, names in wanted.items() for name in names]
    return found.groupBy(*keys).agg(*pick)


def tercile(position: Column, n: Column) -> Column:
    """0, 1, 2 for 1-based positions cut at n // 3 and twice that: the remainder goes last."""
    third = F.floor(n / 3)
    return F.when(position <= third, 0).when(position <= 2 * third, 1).otherwise(2)
