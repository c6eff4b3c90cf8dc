"""Analyses of trades: price gaps between fee tiers, episodes, round trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.quantiles import exact_by_rank, quantiles_of, upper_element
from ..operators import ordered, roundtrips
from ..session import stored
from .registry import PRICES, TRADES, prices, query, trades

FEE_BPS = 4000.0
#: The upper element of an even count, in the oracle's spelling.
UPPER = "list_sort(list({x}))[least(CAST(floor({p} * count({x})) AS BIGINT), count({x}) - 1) + 1]"


def upper(x: str, p: float) -> str:
    return UPPER.format(x=x, p=p)


def gap_rows(spark, d) -> DataFrame:
    return ordered.gaps(prices(spark, d), "day").withColumn("gap_bps", F.round("gap_bps", 6))


@query("join_asof_strict", f"WITH {PRICES} SELECT pos, round(gap, 6) AS gap_bps FROM gaps WHERE mover = 'lo'")
def asof_strict(spark, d):
    return gap_rows(spark, d).filter("mover = 'lo'").select("pos", "gap_bps")


@query("join_asof_both", f"WITH {PRICES} SELECT pos, mover, round(gap, 6) AS gap_bps FROM gaps")
def asof_both(spark, d):
    return gap_rows(spark, d).select("pos", "mover", "gap_bps")


@query("q_gap", f"""WITH {PRICES}, g AS (SELECT mover, abs(round(gap, 6)) AS a, round(gap, 6) AS gap FROM gaps),
  m AS (SELECT mover, a, gap FROM g UNION ALL SELECT '' AS mover, a, gap FROM g)
SELECT mover AS moved, count(*) AS trades, {upper('a', 0.5)} AS abs_gap_p50, {upper('a', 0.9)} AS abs_gap_p90,
  {upper('a', 0.99)} AS abs_gap_p99, max(a) AS abs_gap_max, {upper('gap', 0.5)} AS gap_p50,
  count(*) FILTER (a > {FEE_BPS}) AS beyond_fee, count(*) FILTER (a > {FEE_BPS})::DOUBLE / count(*) AS share_beyond FROM m GROUP BY mover""")
def q_gap(spark, d):
    """Gap quantiles by mover and in all; the total row has an empty mover. The rows are doubled
    for the total, and quantiles come from counted values, so that no group lies in one task."""
    g = stored(gap_rows(spark, d), "gaps")
    both = g.withColumn("moved", F.explode(F.array(F.col("mover"), F.lit("")))).withColumn("a", F.abs("gap_bps"))
    counts = both.groupBy("moved").agg(F.count(F.lit(1)).alias("trades"), F.max("a").alias("abs_gap_max"), F.count_if(F.col("a") > FEE_BPS).alias("beyond_fee"))
    found = quantiles_of(both, ["moved"], {"a": {"abs_gap_p50": 0.5, "abs_gap_p90": 0.9, "abs_gap_p99": 0.99}, "gap_bps": {"gap_p50": 0.5}})
    out = counts.join(found, "moved")
    return out.select("moved", "trades", "abs_gap_max", "beyond_fee", "abs_gap_p50", "abs_gap_p90", "abs_gap_p99", "gap_p50", (F.col("beyond_fee") / F.col("trades")).alias("share_beyond"))


@query("q_gap_hist", f"""WITH {PRICES} SELECT CAST(least(floor(abs(round(gap, 6)) / 1000), 20) AS BIGINT) AS bucket, count(*) AS trades,
  count(*) FILTER (gap > 0) AS lo_above FROM gaps GROUP BY 1""")
def q_gap_hist(spark, d):
    bucket = F.least(F.floor(F.abs("gap_bps") / 1000), F.lit(20)).cast("long")
    return gap_rows(spark, d).groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("trades"), F.count_if(F.col("gap_bps") > 0).alias("lo_above"))


@query("agg_histogram", "SELECT CAST(least(floor(abs(value)), 20) AS BIGINT) AS bucket, count(*) AS n FROM events GROUP BY 1")
def agg_histogram(spark, d):
    return trades(spark, d).groupBy(F.least(F.floor(F.abs("usd")), F.lit(20)).cast("long").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


EPISODES = f"""{PRICES}, marked AS (SELECT *, abs(round(gap, 6)) > {FEE_BPS} AS is_open, lag(abs(round(gap, 6)) > {FEE_BPS}, 1, false) OVER (ORDER BY pos) AS was FROM gaps),
runs AS (SELECT *, sum(CAST(is_open <> was AS INT)) OVER (ORDER BY pos) AS run_id FROM marked),
per_run AS (SELECT run_id, bool_and(is_open) AS is_open, arg_min(blk, pos) AS blk, arg_min(tx, pos) AS tx, arg_min(mover, pos) AS mover, count(*) AS n, max(abs(round(gap, 6))) AS peak FROM runs GROUP BY run_id),
eps AS (SELECT *, lead(blk) OVER (ORDER BY run_id) AS close_blk, lead(mover) OVER (ORDER BY run_id) AS closed_by, lead(tx) OVER (ORDER BY run_id) AS close_tx FROM per_run)"""


def episode_rows(spark, d) -> DataFrame:
    return ordered.episodes(gap_rows(spark, d), FEE_BPS, "day")


@query("win_running_sum", f"WITH {EPISODES} SELECT CAST(run_id AS BIGINT) AS run_id, blk AS open_blk, mover AS opened_by, n AS trades, peak AS peak_bps FROM eps WHERE is_open")
def win_running_sum(spark, d):
    return episode_rows(spark, d).select("run_id", "open_blk", "opened_by", "trades", "peak_bps")


@query("win_lead_default", f"WITH {EPISODES} SELECT CAST(run_id AS BIGINT) AS run_id, coalesce(close_blk, 0) AS close_blk, coalesce(closed_by, '') AS closed_by, coalesce(close_tx, tx) AS close_tx FROM eps WHERE is_open")
def win_lead_default(spark, d):
    e = episode_rows(spark, d)
    return e.select("run_id", F.coalesce("close_blk", F.lit(0)).alias("close_blk"), F.coalesce("closed_by", F.lit("")).alias("closed_by"), F.coalesce("close_tx", "open_tx").alias("close_tx"))


@query("q_episodes", f"""WITH {EPISODES}, e AS (SELECT *, close_blk - blk AS lasted FROM eps WHERE is_open)
SELECT count(*) AS episodes, count(*) FILTER (close_blk IS NULL) AS still_open, count(*) FILTER (lasted = 0) AS same_block, count(*) FILTER (lasted = 1) AS one_block, count(*) FILTER (lasted >= 2) AS two_or_more,
 {upper('lasted', 0.5)} AS lasted_p50, {upper('lasted', 0.9)} AS lasted_p90, {upper('lasted', 0.99)} AS lasted_p99, max(lasted) AS lasted_max,
 count(*) FILTER (mover = 'lo') AS opened_by_lo, count(*) FILTER (mover = 'hi') AS opened_by_hi, count(*) FILTER (closed_by = 'lo') AS closed_by_lo, count(*) FILTER (closed_by = 'hi') AS closed_by_hi,
 count(*) FILTER (closed_by <> mover) AS closed_by_other, count(*) FILTER (closed_by = mover) AS closed_by_same, count(*) FILTER (mover = 'lo' AND closed_by = 'hi') AS lo_then_hi, count(*) FILTER (mover = 'hi' AND closed_by = 'lo') AS hi_then_lo,
 count(*) FILTER (close_tx = tx) AS within_one_tx, {upper('peak', 0.5)} AS peak_p50, {upper('peak', 0.99)} AS peak_p99 FROM e""")
def q_episodes(spark, d):
    return episode_report(episode_rows(spark, d))


def episode_report(rows: DataFrame) -> DataFrame:
    """One row of counts and quantiles; the episodes are found once and stored."""
    e = stored(rows, "episodes").withColumn("lasted", F.col("close_blk") - F.col("open_blk"))
    n = lambda c: F.count_if(F.expr(c))
    held = e.agg(
        F.count(F.lit(1)).alias("episodes"), n("close_blk is null").alias("still_open"), n("lasted = 0").alias("same_block"), n("lasted = 1").alias("one_block"), n("lasted >= 2").alias("two_or_more"),
        F.max("lasted").alias("lasted_max"), n("opened_by = 'lo'").alias("opened_by_lo"), n("opened_by = 'hi'").alias("opened_by_hi"), n("closed_by = 'lo'").alias("closed_by_lo"), n("closed_by = 'hi'").alias("closed_by_hi"),
        n("closed_by != opened_by").alias("closed_by_other"), n("closed_by = opened_by").alias("closed_by_same"), n("opened_by = 'lo' and closed_by = 'hi'").alias("lo_then_hi"), n("opened_by = 'hi' and closed_by = 'lo'").alias("hi_then_lo"),
        n("close_tx = open_tx").alias("within_one_tx"),
    )
    found = quantiles_of(e, [], {"lasted": {"lasted_p50": 0.5, "lasted_p90": 0.9, "lasted_p99": 0.99}, "peak_bps": {"peak_p50": 0.5, "peak_p99": 0.99}})
    return held.crossJoin(F.broadcast(found))  # one row each


@query("q_block_ends", f"""WITH {PRICES}, ends AS (SELECT blk, arg_max(abs(round(gap, 6)), pos) AS a FROM gaps GROUP BY blk)
SELECT count(*) AS blocks, count(*) FILTER (a <= {FEE_BPS}) AS within_fee, {upper('a', 0.5)} AS p50, {upper('a', 0.9)} AS p90 FROM ends""")
def q_block_ends(spark, d):
    return block_ends(gap_rows(spark, d))


def block_ends(found: DataFrame) -> DataFrame:
    ends = found.groupBy("blk").agg(F.max_by(F.abs("gap_bps"), "pos").alias("a"))
    held = ends.agg(F.count(F.lit(1)).alias("blocks"), F.count_if(F.col("a") <= FEE_BPS).alias("within_fee"))
    q = exact_by_rank(ends, [], "a", {"p50": 0.5, "p90": 0.9})
    return held.crossJoin(F.broadcast(q))  # one row


PAIRS = f"""{TRADES}, pairs AS (SELECT a.pool, a.blk, a.log_index AS l1, b.log_index AS l2, a.sender, a.tx = b.tx AS one_tx, a.usd + b.usd AS pair_usd,
  abs(CAST(a.other_raw + b.other_raw AS DOUBLE)) / abs(a.other_raw) AS residual
  FROM trades a JOIN trades b ON a.pool = b.pool AND a.blk = b.blk AND a.sender = b.sender AND b.log_index > a.log_index AND sign(a.other_raw) <> sign(b.other_raw) AND a.other_raw <> 0
  WHERE abs(CAST(a.other_raw + b.other_raw AS DOUBLE)) / abs(a.other_raw) <= 0.5),
ends AS (SELECT pool, blk, l1 AS log_index, one_tx, 1 AS o, 0 AS c FROM pairs WHERE residual <= 0.1 UNION ALL SELECT pool, blk, l2, one_tx, 0, 1 FROM pairs WHERE residual <= 0.1),
legs AS (SELECT t.*, e.pairs_opened, e.pairs_closed, e.in_one_tx FROM trades t JOIN (SELECT pool, blk, log_index, sum(o)::BIGINT AS pairs_opened, sum(c)::BIGINT AS pairs_closed, bool_or(one_tx) AS in_one_tx FROM ends GROUP BY ALL) e USING (pool, blk, log_index))"""


@query("join_self_range", f"WITH {PAIRS} SELECT pool, blk, l1 AS first_log, l2 AS second_log, sender, one_tx, round(residual, 9) AS residual FROM pairs WHERE residual <= 0.1")
def join_self_range(spark, d):
    return roundtrips.pairs(trades(spark, d)).select("pool", "blk", "first_log", "second_log", "sender", "one_tx", F.round("residual", 9).alias("residual"))


@query("q_rt_legs", f"WITH {PAIRS} SELECT pool, blk, log_index, ts, tx, sender, pairs_opened, pairs_closed, in_one_tx, usd FROM legs")
def q_rt_legs(spark, d):
    return roundtrips.legs(trades(spark, d)).select("pool", "blk", "log_index", "ts", "tx", "sender", "pairs_opened", "pairs_closed", "in_one_tx", "usd")


DAILY_RT = f"""{PAIRS}, daily AS (SELECT p.pool, p.day, p.trades, p.volume_usd, coalesce(l.round_trips, 0) AS round_trips, coalesce(l.leg_trades, 0) AS leg_trades, coalesce(l.legs_usd, 0.0) AS legs_usd, coalesce(l.legs_in_one_tx, 0) AS legs_in_one_tx
 FROM (SELECT pool, day, count(*) AS trades, sum(usd) AS volume_usd FROM trades GROUP BY ALL) p
 LEFT JOIN (SELECT pool, day, sum(pairs_opened)::BIGINT AS round_trips, count(*) AS leg_trades, sum(usd) AS legs_usd, count(*) FILTER (in_one_tx) AS legs_in_one_tx FROM legs GROUP BY ALL) l USING (pool, day))"""


@query("q_rt_daily", f"WITH {DAILY_RT} SELECT pool, day, trades, round_trips, leg_trades, legs_in_one_tx, round(volume_usd, 4) AS volume_usd, round(legs_usd, 4) AS legs_usd, round(volume_usd - legs_usd, 4) AS net_usd, round(legs_usd / volume_usd, 6) AS share_of_usd FROM daily")
def q_rt_daily(spark, d):
    r = roundtrips.daily(trades(spark, d))
    return r.select("pool", "day", "trades", "round_trips", "leg_trades", "legs_in_one_tx", *[F.round(c, 4).alias(c) for c in ("volume_usd", "legs_usd", "net_usd")], F.round("share_of_usd", 6).alias("share_of_usd"))


@query("q_rt_by_pool", f"""WITH {DAILY_RT}, m AS (SELECT * FROM daily UNION ALL SELECT * REPLACE ('' AS pool) FROM daily)
SELECT pool, sum(round_trips)::BIGINT AS pairs, sum(leg_trades)::BIGINT AS legs, round(sum(legs_usd), 4) AS legs_usd, round(sum(legs_usd) / sum(volume_usd), 6) AS share_of_usd,
 round({upper('round(legs_usd / volume_usd, 9)', 0.5)}, 6) AS median_daily_share FROM m GROUP BY pool""")
def q_rt_by_pool(spark, d):
    """By pool and in all, from the daily mart: small enough for arrays."""
    r = roundtrips.daily(trades(spark, d))
    held = r.rollup("pool").agg(
        F.sum("round_trips").alias("pairs"), F.sum("leg_trades").alias("legs"), F.sum("legs_usd").alias("legs_usd"), F.sum("volume_usd").alias("all_usd"),
        upper_element(F.collect_list(F.round("share_of_usd", 9)), 0.5).alias("median"), F.grouping("pool").alias("total"),
    )
    return held.select(F.when(F.col("total") == 1, "").otherwise(F.col("pool")).alias("pool"), "pairs", "legs", F.round("legs_usd", 4).alias("legs_usd"), F.round(F.col("legs_usd") / F.col("all_usd"), 6).alias("share_of_usd"), F.round("median", 6).alias("median_daily_share"))


@query("q_rt_by_hour", f"""WITH {PAIRS} SELECT CAST(t.h AS INT) AS hour, t.trades, coalesce(l.legs, 0) AS legs, round(coalesce(l.usd, 0), 4) AS legs_usd FROM
 (SELECT hour(ts) AS h, count(*) AS trades FROM trades GROUP BY 1) t LEFT JOIN (SELECT hour(ts) AS h, count(*) AS legs, sum(usd) AS usd FROM legs GROUP BY 1) l USING (h)""")
def q_rt_by_hour(spark, d):
    t = trades(spark, d)
    all_ = t.groupBy(F.hour("ts").alias("hour")).agg(F.count(F.lit(1)).alias("trades"))
    found = roundtrips.legs(t).groupBy(F.hour("ts").alias("hour")).agg(F.count(F.lit(1)).alias("legs"), F.sum("usd").alias("legs_usd"))
    return all_.join(found, "hour", "left").select("hour", "trades", F.coalesce("legs", F.lit(0)).alias("legs"), F.round(F.coalesce("legs_usd", F.lit(0.0)), 4).alias("legs_usd"))


CONC = """per AS (SELECT sender, sum(usd) AS usd, count(*) AS legs FROM legs GROUP BY sender),
ranked AS (SELECT *, row_number() OVER (ORDER BY round(usd, 6) DESC, legs DESC, sender) AS place FROM per)"""


@query("q_rt_conc", f"""WITH {PAIRS}, {CONC} SELECT count(*) AS senders, sum(legs)::BIGINT AS total_legs, round(sum(usd), 4) AS total_usd, round(sum(usd) FILTER (place <= 1) / sum(usd), 6) AS top1_usd,
 round(sum(usd) FILTER (place <= 3) / sum(usd), 6) AS top3_usd, round(sum(usd) FILTER (place <= 10) / sum(usd), 6) AS top10_usd, round(CAST(sum(legs) FILTER (place <= 1) AS DOUBLE) / sum(legs), 6) AS top1_legs FROM ranked""")
def q_rt_conc(spark, d):
    return concentration(roundtrips.legs(trades(spark, d)))


def concentration(found: DataFrame) -> DataFrame:
    """Shares of the largest senders by dollars; names none. Only the top ten are ranked: the
    totals come from an aggregate, so no task sorts all senders."""
    per = found.groupBy("sender").agg(F.sum("usd").alias("usd"), F.count(F.lit(1)).alias("legs"))
    totals = per.agg(F.count(F.lit(1)).alias("senders"), F.sum("legs").alias("total_legs"), F.sum("usd").alias("total_usd"))
    top = per.orderBy(F.round("usd", 6).desc(), F.desc("legs"), "sender").limit(10)
    place = F.row_number().over(Window.orderBy(F.round("usd", 6).desc(), F.desc("legs"), "sender"))
    up_to = lambda n, c: F.sum(F.when(F.col("place") <= n, F.col(c)))
    tops = top.withColumn("place", place).agg(up_to(1, "usd").alias("u1"), up_to(3, "usd").alias("u3"), up_to(10, "usd").alias("u10"), up_to(1, "legs").alias("l1"))
    share = lambda a, b, name: F.round(F.try_divide(a, b), 6).alias(name)
    return totals.crossJoin(F.broadcast(tops)).select("senders", "total_legs", F.round("total_usd", 4).alias("total_usd"), share("u1", "total_usd", "top1_usd"), share("u3", "total_usd", "top3_usd"), share("u10", "total_usd", "top10_usd"), share("l1", "total_legs", "top1_legs"))


@query("win_cumulative_share", f"""WITH {PAIRS}, {CONC}, run AS (SELECT place, sum(usd) OVER (ORDER BY place) / (SELECT sum(usd) FROM per) AS share FROM ranked)
SELECT place, round(share, 6) AS share FROM run WHERE place IN (1, 2, 3, 5, 8, 20, 50)""")
def win_cumulative_share(spark, d):
    per = roundtrips.legs(trades(spark, d)).groupBy("sender").agg(F.sum("usd").alias("usd"), F.count(F.lit(1)).alias("legs"))
    total = per.agg(F.sum("usd").alias("all_usd"))
    order = [F.round("usd", 6).desc(), F.desc("legs"), F.asc("sender")]
    top = per.orderBy(*order).limit(50)
    ranked = top.withColumn("place", F.row_number().over(Window.orderBy(*order))).withColumn("run", F.sum("usd").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    return ranked.filter(F.col("place").isin(1, 2, 3, 5, 8, 20, 50)).crossJoin(F.broadcast(total)).select(F.col("place").cast("long").alias("place"), F.round(F.col("run") / F.col("all_usd"), 6).alias("share"))


TOL = """SELECT t.tolerance, (SELECT count(*) FROM pairs WHERE residual <= t.tolerance) AS pairs, count(*) AS legs, round(sum(s.usd), 4) AS legs_usd, round(sum(s.usd) / (SELECT sum(usd) FROM trades), 9) AS share_of_usd,
 round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM trades), 9) AS share_of_trades FROM
 (SELECT DISTINCT tolerance, pool, blk, log_index FROM (SELECT pool, blk, l1 AS log_index, residual FROM pairs UNION ALL SELECT pool, blk, l2, residual FROM pairs) x, (SELECT unnest([0.0, 0.01, 0.05, 0.1, 0.2, 0.5])::DOUBLE AS tolerance) y WHERE residual <= tolerance) t
 JOIN trades s USING (pool, blk, log_index) GROUP BY t.tolerance"""


def _by_tolerance(spark, d):
    r = roundtrips.by_tolerance(trades(spark, d), [0.0, 0.01, 0.05, 0.1, 0.2, 0.5])
    return r.select("tolerance", "pairs", "legs", F.round("legs_usd", 4).alias("legs_usd"), F.round("share_of_usd", 9).alias("share_of_usd"), F.round("share_of_trades", 9).alias("share_of_trades"))


query("q_rt_tol", f"WITH {PAIRS} {TOL}")(_by_tolerance)
query("join_subq_correlated", f"WITH {PAIRS} {TOL}")(_by_tolerance)
query("arr_join_literal", f"WITH {PAIRS} SELECT tolerance, pairs FROM ({TOL}) q")(lambda spark, d: _by_tolerance(spark, d).select("tolerance", "pairs"))


@query("tol_check", f"""WITH {DAILY_RT} SELECT (SELECT count(*) FROM pairs WHERE residual <= 0.1) = (SELECT sum(round_trips) FROM daily) AS pairs_agree, (SELECT count(*) FROM legs) = (SELECT sum(leg_trades) FROM daily) AS legs_agree""")
def tol_check(spark, d):
    """The raw recomputation at 10 % against the mart."""
    t = trades(spark, d)
    raw = roundtrips.by_tolerance(t, [0.1]).select("pairs", "legs")
    mart = roundtrips.daily(t).agg(F.sum("round_trips").alias("p"), F.sum("leg_trades").alias("l"))
    return raw.crossJoin(F.broadcast(mart)).select((F.col("pairs") == F.col("p")).alias("pairs_agree"), (F.col("legs") == F.col("l")).alias("legs_agree"))


SIZE = "CASE WHEN usd < 5 THEN '1 below 5' WHEN usd < 20 THEN '2 below 20' WHEN usd < 100 THEN '3 below 100' ELSE '4 the rest' END"
SIZE_SQL = f"""WITH {PAIRS}, b AS (SELECT {SIZE} AS band, usd FROM legs), m AS (SELECT * FROM b UNION ALL SELECT '', usd FROM b)
SELECT band, count(*) AS legs, round(sum(usd), 4) AS usd, round(sum(usd) / (SELECT sum(usd) FROM legs), 6) AS share FROM m GROUP BY band"""


def _by_size(spark, d):
    found = roundtrips.legs(trades(spark, d)).select(F.expr(SIZE).alias("band"), "usd")
    rolled = found.rollup("band").agg(F.count(F.lit(1)).alias("legs"), F.sum("usd").alias("usd"), F.grouping("band").alias("total"))
    all_ = rolled.filter("total = 1").select(F.col("usd").alias("all_usd"))
    out = rolled.crossJoin(F.broadcast(all_))  # one row
    return out.select(F.when(F.col("total") == 1, "").otherwise(F.col("band")).alias("band"), "legs", F.round("usd", 4).alias("usd"), F.round(F.col("usd") / F.col("all_usd"), 6).alias("share"))


query("q_rt_size", SIZE_SQL)(_by_size)
query("agg_size_bands", SIZE_SQL)(_by_size)

BETWEEN = f"""WITH {PAIRS}, p AS (SELECT * FROM pairs WHERE residual <= 0.1), k AS (SELECT pool, blk, list({{'l': log_index, 's': sender}}) AS held FROM trades GROUP BY ALL),
c AS (SELECT p.*, len(list_filter(k.held, lambda x: x.l > p.l1 AND x.l < p.l2 AND x.s <> p.sender)) > 0 AS crossed FROM p JOIN k USING (pool, blk))
SELECT CASE WHEN one_tx THEN '3 inside one transaction' WHEN crossed THEN '1 someone else between' ELSE '2 nobody between' END AS kind, count(*) AS pairs, round(sum(pair_usd), 4) AS usd, round(sum(pair_usd) / (SELECT sum(pair_usd) FROM c), 6) AS share FROM c GROUP BY 1"""


def _between(spark, d):
    return roundtrips.between(trades(spark, d)).select("kind", "pairs", F.round("usd", 4).alias("usd"), F.round("share", 6).alias("share"))


query("q_rt_between", BETWEEN)(_between)


@query("join_block_context", f"""WITH {PAIRS}, p AS (SELECT * FROM pairs WHERE residual <= 0.1) SELECT p.pool, p.l1 AS first_log, p.l2 AS second_log,
 (SELECT count(*) FROM trades t WHERE t.pool = p.pool AND t.blk = p.blk AND t.log_index > p.l1 AND t.log_index < p.l2 AND t.sender <> p.sender) AS others FROM p""")
def join_block_context(spark, d):
    """Trades of others between the legs, as a difference of places in the block."""
    return roundtrips.with_others(trades(spark, d)).select("pool", "first_log", "second_log", "others")


@query("join_algo_check", f"WITH {PRICES} SELECT mover, count(*) AS rows_both, 0::BIGINT AS rows_one, 0::BIGINT AS apart, round(min(gap), 6) AS least, round(max(gap), 6) AS most FROM gaps GROUP BY mover")
def join_algo_check(spark, d):
    """The as-of joins by buckets of days against those by ranges, row by row at 1e-9."""
    rows = prices(spark, d)
    ranges = 2 * spark.sparkContext.defaultParallelism
    one = ordered.gaps(rows, "day").select("pair", "pos", "mover", F.col("gap_bps").alias("one"))
    two = ordered.asof_by_ranges(rows, ranges).select("pair", "pos", "mover", F.col("gap_bps").alias("two"))
    return compared(one, two)


def compared(one: DataFrame, two: DataFrame) -> DataFrame:
    """By mover: rows that both ways have, rows that one has, rows apart, and the range of gaps."""
    both = one.join(two, ["pair", "pos", "mover"], "full")
    has = F.col("one").isNotNull() & F.col("two").isNotNull()
    apart = F.abs(F.col("one") - F.col("two")) > 1e-9 * F.greatest(F.lit(1.0), F.abs("one"))
    return both.groupBy("mover").agg(F.count_if(has).alias("rows_both"), F.count_if(~has).alias("rows_one"), F.count_if(apart).alias("apart"), F.round(F.min("two"), 6).alias("least"), F.round(F.max("one"), 6).alias("most"))
