"""Round trips: a sender's two opposite trades of one pool in one block that nearly cancel out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import Buckets

TOLERANCE = 0.1
#: Log indexes of one bucket of a block's order.
BUCKET = 1 << 14
KEY = ["pool", "blk", "log_index"]


def residual(a: Column, b: Column) -> Column:
    """What is left of the first leg, as a share of it; null for an empty first leg."""
    return F.try_divide(F.abs((a + b).cast("double")), F.abs(a).cast("double"))


def pairs(trades: DataFrame, tolerance: float = TOLERANCE, *more: str) -> DataFrame:
    """All pairs (earlier, later): pool, blk, first_log, second_log, sender, one_tx, pair_usd,
    residual. ``trades``: pool, blk, log_index, sender, tx, other_raw, usd; of the columns ``more``
    the difference, later less earlier, as by_<name>.

    The join is on equality of pool, block and sender; order, sign and tolerance are residual
    conditions within those small groups."""
    carried = ("log_index", "tx", "other_raw", "usd", *more)
    a = trades.select("pool", "blk", "sender", *[F.col(c).alias(f"a_{c}") for c in carried])
    b = trades.select("pool", "blk", "sender", *[F.col(c).alias(f"b_{c}") for c in carried])
    both = a.join(b, ["pool", "blk", "sender"]).filter("b_log_index > a_log_index and signum(a_other_raw) != signum(b_other_raw)")
    kept = both.withColumn("residual", residual(F.col("a_other_raw"), F.col("b_other_raw"))).filter(F.col("residual") <= tolerance)
    by = [(F.col(f"b_{c}") - F.col(f"a_{c}")).alias(f"by_{c}") for c in more]
    return kept.select("pool", "blk", F.col("a_log_index").alias("first_log"), F.col("b_log_index").alias("second_log"), "sender", (F.col("a_tx") == F.col("b_tx")).alias("one_tx"), (F.col("a_usd") + F.col("b_usd")).alias("pair_usd"), "residual", *by)


def placed(trades: DataFrame) -> DataFrame:
    """Trades with their place in the block and among their sender's trades of the block.

    Places are prefix sums over buckets of the block's order, so a block or sender of any number of
    trades is no single task's."""
    bucketed = trades.withColumn("_bucket", F.floor(F.col("log_index") / BUCKET))
    whole = Buckets(bucketed, ["pool", "blk"], "log_index", "_bucket").running_sum("place", F.lit(1)).df
    return Buckets(whole, ["pool", "blk", "sender"], "log_index", "_bucket").running_sum("own_place", F.lit(1)).df.drop("_bucket")


def with_others(trades: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """The pairs with ``others``, the number of other senders' trades between the legs: all places
    between them less the sender's own. No trade of the block is looked at for a pair."""
    found = pairs(placed(trades), tolerance, "place", "own_place")
    return found.withColumn("others", F.col("by_place") - F.col("by_own_place")).drop("by_place", "by_own_place")


def leg_rows(found: DataFrame, *more: str) -> DataFrame:
    """Two rows for each pair, one for each leg, with its role."""
    ends = F.array(F.struct(F.col("first_log").alias("log_index"), F.lit("opened").alias("role")), F.struct(F.col("second_log").alias("log_index"), F.lit("closed").alias("role")))
    return found.select("pool", "blk", F.explode(ends).alias("end"), *more).select("pool", "blk", "end.log_index", "end.role", *more)


def legs(trades: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Each trade that is a leg, once: with the pairs it opened and closed."""
    rows = leg_rows(pairs(trades, tolerance), "one_tx").groupBy(*KEY).agg(
        F.count_if(F.col("role") == "opened").alias("pairs_opened"),
        F.count_if(F.col("role") == "closed").alias("pairs_closed"),
        F.max("one_tx").alias("in_one_tx"),
    )
    return trades.join(rows, KEY)


def daily(trades: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Every pool-day with its round trips and its volume without them."""
    total = trades.groupBy("pool", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("trades"), F.sum("usd").alias("volume_usd"))
    found = legs(trades, tolerance).groupBy("pool", F.to_date("ts").alias("day")).agg(
        F.sum("pairs_opened").alias("round_trips"), F.count(F.lit(1)).alias("leg_trades"), F.count_if("in_one_tx").alias("legs_in_one_tx"), F.sum("usd").alias("legs_usd"),
    )
    joined = total.join(found, ["pool", "day"], "left").fillna(0, ["round_trips", "leg_trades", "legs_in_one_tx"]).fillna(0.0, ["legs_usd"])
    return joined.withColumn("net_usd", F.col("volume_usd") - F.col("legs_usd")).withColumn("share_of_usd", F.try_divide("legs_usd", "volume_usd"))


def by_tolerance(trades: DataFrame, tolerances: list[float]) -> DataFrame:
    """Pairs, legs and shares at several tolerances from one self-join."""
    found = pairs(trades, max(tolerances))
    levels = F.explode(F.filter(F.array(*[F.lit(float(t)) for t in tolerances]), lambda t: F.col("residual") <= t)).alias("tolerance")
    levelled = found.select("*", levels)
    counted = levelled.groupBy("tolerance").agg(F.count(F.lit(1)).alias("pairs"))
    one = leg_rows(levelled, "tolerance").select("tolerance", *KEY).distinct().join(trades.select(*KEY, "usd"), KEY)
    sums = one.groupBy("tolerance").agg(F.count(F.lit(1)).alias("legs"), F.sum("usd").alias("legs_usd"))
    totals = trades.agg(F.sum("usd").alias("all_usd"), F.count(F.lit(1)).alias("all_trades"))
    out = counted.join(sums, "tolerance").crossJoin(F.broadcast(totals))  # totals: one row
    return out.select("tolerance", "pairs", "legs", "legs_usd", (F.col("legs_usd") / F.col("all_usd")).alias("share_of_usd"), (F.col("legs") / F.col("all_trades")).alias("share_of_trades"))


def between(trades: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """What sits between the legs: kind, pairs, usd, share of all pairs' usd."""
    kind = F.when(F.col("one_tx"), "3 inside one transaction").when(F.col("others") > 0, "1 someone else between").otherwise("2 nobody between")
    sums = with_others(trades, tolerance).groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("pairs"), F.sum("pair_usd").alias("usd"))
    total = sums.agg(F.sum("usd").alias("all_usd"))
    return sums.crossJoin(F.broadcast(total)).select("kind", "pairs", "usd", (F.col("usd") / F.col("all_usd")).alias("share"))  # total: one row
