"""Operators on an ordered stream that do not gather a whole stream in one task.

The natural window for as-of joins and run numbers has one partition for each stream, and one
stream can hold most rows. So a stream is cut into buckets of its order (a range of blocks, a
day): windows run inside buckets, and what must cross a border is computed on one row for each
bucket and carried in. Rows of a bucket must all precede those of the next.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import stored


@dataclass
class Buckets:
    """A frame with a stream key, an order within it (unique), and a bucket of that order."""

    df: DataFrame
    keys: list[str]
    order: str
    bucket: str

    @property
    def inner(self):
        return Window.partitionBy(*self.keys, self.bucket).orderBy(self.order)

    @property
    def outer(self):
        return Window.partitionBy(*self.keys).orderBy(self.bucket)

    def _with(self, df: DataFrame) -> Buckets:
        return Buckets(df, self.keys, self.order, self.bucket)

    def _carried(self, per_bucket: dict[str, Column], carry: dict[str, Column]) -> DataFrame:
        """One row for each bucket with what is carried into it."""
        rows = self.df.groupBy(*self.keys, self.bucket).agg(*[c.alias(n) for n, c in per_bucket.items()])
        return rows.select(*self.keys, self.bucket, *[c.alias(n) for n, c in carry.items()])

    def last_before(self, values: dict[str, Column]) -> Buckets:
        """For each name the last non-null value on a strictly earlier row."""
        df = self.df.select("*", *[v.alias(f"_{n}") for n, v in values.items()])
        step = Buckets(df, self.keys, self.order, self.bucket)
        earlier = self.outer.rowsBetween(Window.unboundedPreceding, -1)
        carried = step._carried(
            {f"_c_{n}": F.max_by(F.col(f"_{n}"), F.when(F.col(f"_{n}").isNotNull(), F.col(self.order))) for n in values},
            {f"_c_{n}": F.last(f"_c_{n}", ignorenulls=True).over(earlier) for n in values},
        )
        within = self.inner.rowsBetween(Window.unboundedPreceding, -1)
        joined = df.join(carried, [*self.keys, self.bucket])
        found = [F.coalesce(F.last(f"_{n}", ignorenulls=True).over(within), F.col(f"_c_{n}")).alias(n) for n in values]
        return self._with(joined.select(*self.df.columns, *found))

    def first_after(self, values: dict[str, Column]) -> Buckets:
        """For each name the first non-null value on a strictly later row: ``last_before`` of the
        order turned round, so frames grow from the end and no row is looked at twice."""
        df = self.df.select("*", *[v.alias(f"_{n}") for n, v in values.items()])
        step = Buckets(df, self.keys, self.order, self.bucket)
        later = Window.partitionBy(*self.keys).orderBy(F.desc(self.bucket)).rowsBetween(Window.unboundedPreceding, -1)
        carried = step._carried(
            {f"_c_{n}": F.min_by(F.col(f"_{n}"), F.when(F.col(f"_{n}").isNotNull(), F.col(self.order))) for n in values},
            {f"_c_{n}": F.last(f"_c_{n}", ignorenulls=True).over(later) for n in values},
        )
        within = Window.partitionBy(*self.keys, self.bucket).orderBy(F.desc(self.order)).rowsBetween(Window.unboundedPreceding, -1)
        joined = df.join(carried, [*self.keys, self.bucket])
        found = [F.coalesce(F.last(f"_{n}", ignorenulls=True).over(within), F.col(f"_c_{n}")).alias(n) for n in values]
        return self._with(joined.select(*self.df.columns, *found))

    def running_sum(self, name: str, value: Column) -> Buckets:
        """Sum of a value up to and with each row."""
        df = self.df.withColumn("_v", value)
        step = Buckets(df, self.keys, self.order, self.bucket)
        earlier = self.outer.rowsBetween(Window.unboundedPreceding, -1)
        carried = step._carried({"_s": F.sum("_v")}, {"_s": F.coalesce(F.sum("_s").over(earlier), F.lit(0))})
        joined = df.join(carried, [*self.keys, self.bucket])
        total = F.sum("_v").over(self.inner.rowsBetween(Window.unboundedPreceding, 0)) + F.col("_s")
        return self._with(joined.withColumn(name, total).drop("_v", "_s"))


def gaps(prices: DataFrame, bucket: str, keys: list[str] | None = None) -> DataFrame:
    """Price gap in bps at every trade of two pools, against the other's last strictly earlier
    price: the as-of joins of both directions from one pass. Trades before the other pool's first
    are left out.

    ``prices``: keys (default pair), pos, mover ('lo' or 'hi'), sp (square-root price), bucket.
    """
    keys = keys or ["pair"]
    side = lambda s: F.when(F.col("mover") == s, F.col("sp"))
    found = Buckets(prices, keys, "pos", bucket).last_before({"lo_sp": side("lo"), "hi_sp": side("hi")}).df
    low = F.when(F.col("mover") == "lo", F.col("sp")).otherwise(F.col("lo_sp"))
    high = F.when(F.col("mover") == "hi", F.col("sp")).otherwise(F.col("hi_sp"))
    return found.withColumn("gap_bps", F.lit(2e4) * F.ln(low / high)).filter("gap_bps is not null").drop("lo_sp", "hi_sp")


def episodes(found: DataFrame, fee_bps: float, bucket: str, keys: list[str] | None = None) -> DataFrame:
    """Maximal runs of consecutive trades with a gap beyond the fee (gaps and islands).

    ``found``: as from ``gaps``, with blk and tx. One row for each run that is open: where and by
    whom it opened and closed (null: still open at the end), trades in it and its peak.
    """
    keys = keys or ["pair"]
    flagged = found.withColumn("is_open", F.abs("gap_bps") > F.lit(fee_bps))
    step = Buckets(flagged, keys, "pos", bucket).last_before({"was_open": F.col("is_open")})
    changed = (F.col("is_open") != F.coalesce("was_open", F.lit(False))).cast("long")
    runs = step.running_sum("run_id", changed).df
    first = F.min_by(F.struct("blk", "tx", "mover", "pos"), "pos")
    per_run = runs.groupBy(*keys, "run_id").agg(first.alias("first"), F.first("is_open").alias("is_open"), F.count(F.lit(1)).alias("trades"), F.max(F.abs("gap_bps")).alias("peak_bps"), F.min(bucket).alias("_b"))
    # a run belongs to the bucket it begins in; what follows it is in that bucket or heads a later one
    per_run = Buckets(per_run, keys, "run_id", "_b").first_after({"next": F.col("first")}).df.filter("is_open")
    return per_run.select(
        *keys, "run_id", "trades", "peak_bps",
        F.col("first.blk").alias("open_blk"), F.col("first.mover").alias("opened_by"), F.col("first.tx").alias("open_tx"),
        F.col("next.blk").alias("close_blk"), F.col("next.mover").alias("closed_by"), F.col("next.tx").alias("close_tx"),
    )


def asof_by_ranges(prices: DataFrame, parts: int, keys: list[str] | None = None) -> DataFrame:
    """The gaps of ``gaps`` by another way, to hold it against: both pools as one stream, dealt by
    range of (keys, pos), each range merged in one pass that holds the last price of either pool.

    What a range begins without comes from the ranges before: each leaves one row for each key it
    has seen. ``prices``: keys, pos (unique), mover, sp; no bucket is needed."""
    import pandas as pd

    keys = keys or ["pair"]
    rows = prices.select(*keys, "pos", "mover", "sp")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)

    def merge(frames):
        from pyspark import TaskContext

        part, last = TaskContext.get().partitionId(), {}
        for frame in frames:
            frame = frame.reset_index(drop=True)
            names = list(zip(*(frame[k] for k in keys), strict=True))
            codes, seen = pd.factorize(pd.Series(names, dtype=object))
            for side in ("lo", "hi"):
                known = frame["sp"].where(frame["mover"] == side).astype("float64")
                upto = known.groupby(codes).ffill()
                carried = pd.Series([last.get((n, side)) for n in names], dtype="float64")
                frame[f"{side}_sp"] = upto.groupby(codes).shift().fillna(carried)
                last.update({(seen[c], side): v for c, v in known.groupby(codes).last().items() if pd.notna(v)})
            yield frame.assign(part=part, tells=False)
        if last:
            ends = list(dict.fromkeys(n for n, _ in last))
            told = pd.DataFrame([list(n) for n in ends], columns=keys)
            yield told.assign(pos=-1, mover=None, sp=None, lo_sp=[last.get((n, "lo")) for n in ends], hi_sp=[last.get((n, "hi")) for n in ends], part=part, tells=True)

    order = [*keys, "pos"]
    merged = stored(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInPandas(merge, f"{fields}, lo_sp double, hi_sp double, part long, tells boolean"), "asof-ranges")
    earlier = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    told = merged.filter("tells").select(*keys, "part", *[F.last(f"{s}_sp", ignorenulls=True).over(earlier).alias(f"{s}_before") for s in ("lo", "hi")])
    found = merged.filter("not tells").join(told, [*keys, "part"], "left")
    low = F.when(F.col("mover") == "lo", F.col("sp")).otherwise(F.coalesce("lo_sp", "lo_before"))
    high = F.when(F.col("mover") == "hi", F.col("sp")).otherwise(F.coalesce("hi_sp", "hi_before"))
    return found.withColumn("gap_bps", F.lit(2e4) * F.ln(low / high)).filter("gap_bps is not null").select(*keys, "pos", "mover", "sp", "gap_bps")


def lag_or_self(value: Column, window) -> Column:
    """The previous row's value, or its own on the first row."""
    return F.coalesce(F.lag(value).over(window), value)


def rolling_median(value: Column, window, around: int = 10) -> Column:
    """Exact median (upper element) of the rows up to ``around`` before and after."""
    held = F.collect_list(value).over(window.rowsBetween(-around, around))
    return F.get(F.array_sort(held), F.floor(F.size(held) / 2).cast("int"))


def with_borders(step: Buckets, around: int, chunk_rows: int = 65_536) -> DataFrame:
    """Rows dealt into chunks of neighbouring rows, each with ``around`` rows of both neighbours.

    Adds chunk and own (false for the rows lent by a neighbour): a window over keys and chunk sees
    what a window over the whole stream would, for the own rows and frames of up to ``around``.
    """
    numbered = step.running_sum("_n", F.lit(1)).df.withColumn("_n", F.col("_n") - 1)
    chunk, place = F.floor(F.col("_n") / chunk_rows), F.col("_n") % chunk_rows
    also = F.array(chunk, F.when((place < around) & (chunk > 0), chunk - 1), F.when(place >= chunk_rows - around, chunk + 1))
    spread = numbered.withColumn("_home", chunk).withColumn("chunk", F.explode(F.filter(also, lambda x: x.isNotNull())))
    return spread.withColumn("own", F.col("chunk") == F.col("_home")).drop("_n", "_home")
