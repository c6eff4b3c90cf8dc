"""Marts and the reports that read them: staging, daily marts, incremental partials, examples,
question templates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import money
from ..sources import footers
from .registry import TRADES, query, read, trades

FEE = "CASE pool WHEN 'click' THEN 100 WHEN 'view' THEN 500 WHEN 'error' THEN 3000 ELSE 10000 END"
#: The daily mart in the oracle: exact cents, fees in hundredths of a basis point.
DAILY = f"""{TRADES}, daily AS (SELECT pool, day, {FEE} AS fee, count(*) AS swaps, sum(abs(other_raw))::BIGINT AS cents, sum(abs(other_raw))::BIGINT / 100.0::DOUBLE AS usd FROM trades GROUP BY pool, day)"""
cents = lambda c, name: F.round(c, 2).alias(name)


def dim_pools(spark, d) -> DataFrame:
    """A pool for each event type with its fee, as a dimension."""
    pools = trades(spark, d).select("pool").distinct().withColumn("fee", F.expr(FEE))
    return pools.select("pool", "fee", (F.col("fee") / F.lit(1e6)).alias("fee_fraction"), money_label(F.col("pool"), F.col("fee")).alias("label"))


def money_label(name, fee):
    from ..operators.quality import fee_text

    return F.concat(name, F.lit(" "), fee_text(fee))


def daily(spark, d) -> DataFrame:
    return trades(spark, d).groupBy("pool", "day").agg(F.count("*").alias("swaps"), F.sum(F.abs("other_raw")).alias("cents")).withColumn("usd", F.col("cents") / F.lit(100.0)).withColumn("fee", F.expr(FEE))


@query("q_dim_pools", f"WITH {TRADES} SELECT pool, {FEE} AS fee, ({FEE}) / 1e6 AS fee_fraction, pool || ' ' || CASE {FEE} WHEN 100 THEN '0.01' WHEN 500 THEN '0.05' WHEN 3000 THEN '0.3' ELSE '1' END || '%' AS label FROM (SELECT DISTINCT pool FROM trades)")
def q_dim_pools(spark, d):
    return dim_pools(spark, d)


@query("q_stg_swaps", f"WITH {TRADES} SELECT log_index, pool, {FEE} AS fee, day, '0x' || lpad(lower(to_hex(sender)), 40, '0') AS sender, other_raw, other_raw / 100.0::DOUBLE AS amount, CASE WHEN pool <> 'error' THEN abs(other_raw) / 100.0::DOUBLE END AS volume_usd FROM trades")
def q_stg_swaps(spark, d):
    """The readable view: scaled exactly, addresses as text, dollars where a stable leg is."""
    t = trades(spark, d).join(dim_pools(spark, d), "pool")
    amount = money.scale_exact(F.col("other_raw").cast("decimal(38,0)"), F.lit(2)).cast("double")
    return t.select("log_index", "pool", "fee", "day", F.concat(F.lit("0x"), F.lpad(F.lower(F.hex("sender")), 40, "0")).alias("sender"), "other_raw", amount.alias("amount"), F.when(F.col("pool") != "error", F.abs(amount)).alias("volume_usd"))


@query("q_pool_daily", f"WITH {DAILY} SELECT pool, day, fee, swaps, usd AS volume_usd, CAST(CAST(cents AS HUGEINT) * fee AS DOUBLE) / 100000000 AS fees_usd FROM daily")
def q_pool_daily(spark, d):
    """Volume and fees of each pool-day, in exact decimals until the end."""
    volume = (F.col("cents").cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(31,18)")
    return daily(spark, d).select("pool", "day", "fee", "swaps", F.col("usd").alias("volume_usd"), money.fee_usd(volume, F.col("fee")).cast("double").alias("fees_usd"))


NAMED = "named AS (SELECT DISTINCT tx FROM trades WHERE sender % 7 = 0)"


@query("q_smart_daily", f"WITH {TRADES}, {NAMED}, versions AS (SELECT pool, day, count(*) AS n, max(log_index) AS v FROM trades WHERE tx IN (SELECT tx FROM named) AND pool <> 'signup' GROUP BY 1, 2), all_ AS (SELECT pool, day, count(*) AS swaps FROM trades GROUP BY 1, 2) SELECT pool, day, versions.n AS named_swaps, round(versions.n::DOUBLE / swaps, 6) AS share FROM versions JOIN all_ USING (pool, day)")
def q_smart_daily(spark, d):
    """Only fetched pool-days have a row; of several fetches the newest counts."""
    t = trades(spark, d)
    named = t.filter("sender % 7 = 0").select("tx").distinct()
    found = t.join(named, "tx", "left_semi").filter("pool != 'signup'").groupBy("pool", "day").agg(F.count("*").alias("n"), F.max("log_index").alias("v"))
    older = found.select("pool", "day", (F.col("n") + 99).alias("n"), (F.col("v") - 1).alias("v"))
    newest = newest_version(found.unionByName(older), ["pool", "day"], "v")
    whole = t.groupBy("pool", "day").agg(F.count("*").alias("swaps"))
    return newest.join(whole, ["pool", "day"]).select("pool", "day", F.col("n").alias("named_swaps"), F.round(F.col("n") / F.col("swaps"), 6).alias("share"))


def newest_version(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Of the rows of a key the one with the highest version: an aggregate, so that versions of a
    key meet map-side first."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), version).alias("_r")).select(*keys, *[f"_r.{c}" for c in rest])


@query("replacing_final", "SELECT l_orderkey, l_linenumber, max(l_partkey) AS newest FROM lineitem GROUP BY 1, 2")
def replacing_final(spark, d):
    rows = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return newest_version(rows.withColumn("v", F.col("l_partkey")), ["l_orderkey", "l_linenumber"], "v").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("newest"))


# external hash lists

CROSS = f"WITH {TRADES}, {NAMED} SELECT "


@query("q_cross_tx", CROSS + "pool, count(*) AS swaps, count(DISTINCT tx) AS txs, sum(abs(other_raw))::BIGINT / 100.0::DOUBLE AS usd, count(*) FILTER (tx IN (SELECT tx FROM named)) AS named_swaps, count(DISTINCT CASE WHEN tx IN (SELECT tx FROM named) THEN tx END) AS named_txs FROM trades GROUP BY pool")
def q_cross_tx(spark, d):
    t = flagged(spark, d)
    return t.groupBy("pool").agg(F.count("*").alias("swaps"), F.countDistinct("tx").alias("txs"), (F.sum(F.abs("other_raw")) / F.lit(100.0)).alias("usd"), F.count_if("named").alias("named_swaps"), F.countDistinct(F.when(F.col("named"), F.col("tx"))).alias("named_txs"))


def flagged(spark, d) -> DataFrame:
    t = trades(spark, d)
    named = t.filter("sender % 7 = 0").select("tx").distinct().withColumn("named", F.lit(True))
    return t.join(named, "tx", "left").fillna(False, ["named"])


@query("q_named_tx", CROSS + "count(DISTINCT tx) AS txs FROM named")
def q_named_tx(spark, d):
    return trades(spark, d).filter("sender % 7 = 0").agg(F.countDistinct("tx").alias("txs"))


@query("q_daily_tx", CROSS + "pool, day, count(*) FILTER (tx IN (SELECT tx FROM named)) AS named_swaps, sum(CASE WHEN tx IN (SELECT tx FROM named) THEN abs(other_raw) ELSE 0 END)::BIGINT AS named_cents FROM trades GROUP BY pool, day")
def q_daily_tx(spark, d):
    return flagged(spark, d).groupBy("pool", "day").agg(F.count_if("named").alias("named_swaps"), F.sum(F.when(F.col("named"), F.abs("other_raw")).otherwise(0)).alias("named_cents"))


@query("q_tx_net", f"WITH {TRADES} SELECT tx, sum(abs(other_raw))::BIGINT AS gross, abs(sum(other_raw))::BIGINT AS net, count(DISTINCT sender) AS senders, list_sort(list(DISTINCT pool)) AS pools FROM trades WHERE hour(ts) = 10 AND day = DATE '2024-01-09' GROUP BY tx")
def q_tx_net(spark, d):
    rows = trades(spark, d).filter("day = date'2024-01-09' and hour(ts) = 10")
    return rows.groupBy("tx").agg(F.sum(F.abs("other_raw")).alias("gross"), F.abs(F.sum("other_raw")).alias("net"), F.countDistinct("sender").alias("senders"), F.array_sort(F.collect_set("pool")).alias("pools"))


# sanity reports


@query("q_sanity_01", f"WITH {TRADES} SELECT pool, day, count(*) AS n, min(ts) AS first, max(ts) AS last FROM trades GROUP BY 1, 2")
def q_sanity_01(spark, d):
    return trades(spark, d).groupBy("pool", "day").agg(F.count("*").alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last"))


@query("q_sanity_02", "SELECT l_orderkey, l_linenumber, count(*) AS copies, list_sort(list(DISTINCT l_partkey)) AS parts FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def q_sanity_02(spark, d):
    """Duplicate keys first on bare keys, then their rows: the wide columns of single keys are
    never gathered."""
    rows, keys = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey", "l_linenumber"]
    twice = rows.groupBy(keys).agg(F.count("*").alias("n")).filter("n > 1").select(keys)
    return rows.join(twice, keys, "left_semi").groupBy(keys).agg(F.count("*").alias("copies"), F.array_sort(F.collect_set("l_partkey")).alias("parts"))


@query("q_sanity_04", f"WITH {TRADES} SELECT log_index FROM trades WHERE sign(other_raw) = sign(1000 - log_index) AND other_raw <> 0")
def q_sanity_04(spark, d):
    return trades(spark, d).filter("signum(other_raw) = signum(1000 - log_index) and other_raw != 0").select("log_index")


@query("q_sanity_05", f"WITH {TRADES} SELECT pool, count(*) FILTER (abs(other_raw) < 100) AS tiny, count(*) AS n FROM trades GROUP BY 1")
def q_sanity_05(spark, d):
    return trades(spark, d).groupBy("pool").agg(F.count_if(F.abs("other_raw") < 100).alias("tiny"), F.count("*").alias("n"))


#: Columns of two tables, each with its value as a number or as a text, for the oracle.
FOOTED = {
    "events": {"event_id": "event_id", "ts": "epoch_us(ts)", "user_id": "user_id", "event_type": None, "value": "value", "props": None},
    "orders": {"o_orderkey": "o_orderkey", "o_custkey": "o_custkey", "o_orderstatus": None, "o_totalprice": "o_totalprice", "o_orderdate": "epoch_us(o_orderdate)", "o_orderpriority": None},
}
FOOTERS = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", count(*) AS rows, count(*) - count({c}) AS nulls, "
    + (f"CAST(min({number}) AS DOUBLE) AS low, CAST(max({number}) AS DOUBLE) AS high, NULL AS low_text, NULL AS high_text" if number else f"CAST(NULL AS DOUBLE) AS low, CAST(NULL AS DOUBLE) AS high, min({c}) AS low_text, max({c}) AS high_text")
    + f" FROM {t}"
    for t, held in FOOTED.items()
    for c, number in held.items()
)


@query("q_sanity_06", FOOTERS)
def q_sanity_06(spark, d):
    """Physical state from the footers of two tables, read in tasks: what they say of each column
    must be true of its rows."""
    found = [footers.columns(footers.row_groups(spark, f"{d}/{t}.parquet")).select(F.lit(t).alias("table"), "*") for t in FOOTED]
    return found[0].unionByName(found[1])


@query("q_table_files")
def q_table_files(spark, d):
    """The same by table: files, row groups, rows, the largest row group, bytes packed and unpacked."""
    def table(t):
        size = lambda c: money.readable_size(F.col(c)).alias(c)
        return footers.tables(footers.row_groups(spark, f"{d}/{t}.parquet")).select(F.lit(t).alias("table"), "files", "row_groups", "rows", "largest", size("packed"), size("unpacked"))

    return table("events").unionByName(table("orders"))


# examples and dashboard series


@query("q_examples_01", f"WITH {DAILY} SELECT day, pool, swaps, round(usd, 0) AS usd, round(usd / swaps, 2) AS each FROM daily ORDER BY cents DESC, pool, day LIMIT 10")
def q_examples_01(spark, d):
    top = daily(spark, d).orderBy(F.desc("cents"), "pool", "day").limit(10)
    return top.select("day", "pool", "swaps", F.round("usd", 0).alias("usd"), F.round(F.col("usd") / F.col("swaps"), 2).alias("each"))


@query("q_examples_02", f"WITH {DAILY} SELECT day, sum(usd) FILTER (fee = 100) AS low, sum(usd) FILTER (fee = 500) AS high, round(100 * sum(usd) FILTER (fee = 500) / sum(usd), 4) AS pct_high, sum(swaps) FILTER (fee = 100)::BIGINT AS swaps_low FROM daily WHERE pool IN ('click', 'view') GROUP BY day")
def q_examples_02(spark, d):
    of = lambda fee, c: F.sum(F.when(F.col("fee") == fee, F.col(c)))
    return daily(spark, d).filter(F.col("pool").isin("click", "view")).groupBy("day").agg(of(100, "usd").alias("low"), of(500, "usd").alias("high"), F.round(100 * of(500, "usd") / F.sum("usd"), 4).alias("pct_high"), of(100, "swaps").alias("swaps_low"))


@query("q_examples_03", f"WITH {TRADES} SELECT sender, count(*) AS swaps, sum(abs(other_raw))::BIGINT AS cents, round(100 * sum(abs(other_raw))::DOUBLE / (SELECT sum(abs(other_raw)) FROM trades), 4) AS pct FROM trades GROUP BY sender ORDER BY cents DESC, sender LIMIT 8")
def q_examples_03(spark, d):
    per = trades(spark, d).groupBy("sender").agg(F.count("*").alias("swaps"), F.sum(F.abs("other_raw")).alias("cents"))
    whole = per.agg(F.sum("cents").alias("whole"))
    return per.orderBy(F.desc("cents"), "sender").limit(8).crossJoin(F.broadcast(whole)).select("sender", "swaps", "cents", F.round(100 * F.col("cents").cast("double") / F.col("whole"), 4).alias("pct"))  # one row


@query("q_dashboard_totals", f"WITH {DAILY} SELECT sum(swaps)::BIGINT AS swaps, sum(cents)::BIGINT AS cents, count(DISTINCT pool) AS pools, min(day) AS first, max(day) AS last FROM daily")
def q_dashboard_totals(spark, d):
    return daily(spark, d).agg(F.sum("swaps").alias("swaps"), F.sum("cents").alias("cents"), F.countDistinct("pool").alias("pools"), F.min("day").alias("first"), F.max("day").alias("last"))


@query("q_dashboard_daily", f"WITH {DAILY} SELECT day, sum(cents)::BIGINT AS cents FROM daily GROUP BY day")
def q_dashboard_daily(spark, d):
    return daily(spark, d).groupBy("day").agg(F.sum("cents").alias("cents"))


@query("q_dashboard_pools", f"WITH {DAILY} SELECT pool, sum(swaps)::BIGINT AS swaps, sum(cents)::BIGINT AS cents FROM daily GROUP BY pool")
def q_dashboard_pools(spark, d):
    return daily(spark, d).groupBy("pool").agg(F.sum("swaps").alias("swaps"), F.sum("cents").alias("cents"))


# question templates over the daily mart: the figures a reader asks for

A, B = "DATE '2024-01-05'", "DATE '2024-01-14'"


def _in_period():
    return F.col("day").between("2024-01-05", "2024-01-14")


TEMPLATES: dict[str, tuple[str, object]] = {
    "volume_day": (f"SELECT cents FROM daily WHERE pool = 'click' AND day = {A}", lambda x: x.filter("pool = 'click' and day = date'2024-01-05'").select("cents")),
    "swaps_day": (f"SELECT swaps FROM daily WHERE pool = 'view' AND day = {A}", lambda x: x.filter("pool = 'view' and day = date'2024-01-05'").select("swaps")),
    "token_volume_day": (f"SELECT cents * 1000 AS raw FROM daily WHERE pool = 'error' AND day = {B}", lambda x: x.filter("pool = 'error' and day = date'2024-01-14'").select((F.col("cents") * 1000).alias("raw"))),
    "volume_all_day": (f"SELECT sum(cents)::BIGINT AS cents FROM daily WHERE day = {A}", lambda x: x.filter("day = date'2024-01-05'").agg(F.sum("cents").alias("cents"))),
    "volume_range": (f"SELECT sum(cents)::BIGINT AS cents FROM daily WHERE pool = 'click' AND day BETWEEN {A} AND {B}", lambda x: x.filter(_in_period() & (F.col("pool") == "click")).agg(F.sum("cents").alias("cents"))),
    "swaps_all_range": (f"SELECT sum(swaps)::BIGINT AS swaps FROM daily WHERE day BETWEEN {A} AND {B}", lambda x: x.filter(_in_period()).agg(F.sum("swaps").alias("swaps"))),
    "vwap_day": (f"SELECT round(sum(usd) / sum(swaps), 6) AS vwap FROM daily WHERE day = {A}", lambda x: x.filter("day = date'2024-01-05'").agg(F.round(F.sum("cents") / F.lit(100.0) / F.sum("swaps"), 6).alias("vwap"))),
    "top_pool_day": (f"SELECT arg_max(pool, (cents, pool)) AS pool FROM daily WHERE day = {A}", lambda x: x.filter("day = date'2024-01-05'").agg(F.max_by("pool", F.struct("cents", "pool")).alias("pool"))),
    "peak_day_range": (f"SELECT arg_max(day, (c, day)) AS day FROM (SELECT day, sum(cents) AS c FROM daily WHERE day BETWEEN {A} AND {B} GROUP BY day)", lambda x: x.filter(_in_period()).groupBy("day").agg(F.sum("cents").alias("c")).agg(F.max_by("day", F.struct("c", "day")).alias("day"))),
    "volume_change": (f"SELECT (sum(cents) FILTER (day = {B}) - sum(cents) FILTER (day = {A}))::BIGINT AS change FROM daily WHERE pool = 'click'", lambda x: x.filter("pool = 'click'").agg((F.sum(F.when(F.col("day") == "2024-01-14", F.col("cents"))) - F.sum(F.when(F.col("day") == "2024-01-05", F.col("cents")))).alias("change"))),
    "fees": (f"SELECT round(sum(CAST(cents AS HUGEINT) * fee)::DOUBLE / 1e8, 6) AS fees FROM daily WHERE day BETWEEN {A} AND {B}", lambda x: x.filter(_in_period()).agg(F.round(F.sum(F.col("cents") * F.col("fee")) / F.lit(1e8), 6).alias("fees"))),
    "share": (f"SELECT round(sum(cents) FILTER (pool = 'click')::DOUBLE / sum(cents), 6) AS share FROM daily WHERE day = {A}", lambda x: x.filter("day = date'2024-01-05'").agg(F.round(F.sum(F.when(F.col("pool") == "click", F.col("cents"))) / F.sum("cents"), 6).alias("share"))),
    "partial_day": ("SELECT max(day) AS last_day, arg_max(swaps, (day, pool))::BIGINT AS swaps FROM daily", lambda x: x.agg(F.max("day").alias("last_day"), F.max_by("swaps", F.struct("day", "pool")).alias("swaps"))),
    "absent_poolday": ("SELECT coalesce(sum(cents), 0)::BIGINT AS cents FROM daily WHERE pool = 'click' AND day = DATE '2031-01-01'", lambda x: x.filter("pool = 'click' and day = date'2031-01-01'").agg(F.coalesce(F.sum("cents"), F.lit(0)).alias("cents"))),
    "fee_units": ("SELECT DISTINCT pool, fee / 1e4 AS fee_percent, fee / 1e6 AS fee_fraction FROM daily", lambda x: x.select("pool", (F.col("fee") / F.lit(1e4)).alias("fee_percent"), (F.col("fee") / F.lit(1e6)).alias("fee_fraction")).distinct()),
    "gross_net": (f"SELECT (sum(cents) - sum(cents) FILTER (pool = 'error'))::BIGINT AS net FROM daily WHERE day = {A}", lambda x: x.filter("day = date'2024-01-05'").agg((F.sum("cents") - F.sum(F.when(F.col("pool") == "error", F.col("cents")))).alias("net"))),
    "days_above": ("SELECT count(*) AS days FROM daily WHERE pool = 'click' AND cents > 100000", lambda x: x.filter("pool = 'click' and cents > 100000").agg(F.count("*").alias("days"))),
    "pool_ratio": (f"SELECT round(sum(cents) FILTER (pool = 'click')::DOUBLE / sum(cents) FILTER (pool = 'view'), 6) AS ratio FROM daily WHERE day BETWEEN {A} AND {B}", lambda x: x.filter(_in_period()).agg(F.round(F.sum(F.when(F.col("pool") == "click", F.col("cents"))) / F.sum(F.when(F.col("pool") == "view", F.col("cents"))), 6).alias("ratio"))),
    "average": (f"SELECT round(sum(cents)::DOUBLE / count(*), 4) AS mean FROM daily WHERE pool = 'view' AND day BETWEEN {A} AND {B}", lambda x: x.filter(_in_period() & (F.col("pool") == "view")).agg(F.round(F.sum("cents") / F.count("*"), 4).alias("mean"))),
    "ranges_edges": (f"SELECT count(*) AS pool_days, count(*) FILTER (day IN ({A}, {B})) AS at_edges FROM daily WHERE day BETWEEN {A} AND {B}", lambda x: x.filter(_in_period()).agg(F.count("*").alias("pool_days"), F.count_if(F.col("day").isin("2024-01-05", "2024-01-14")).alias("at_edges"))),
    "top_range": (f"SELECT pool, sum(cents)::BIGINT AS cents FROM daily WHERE day BETWEEN {A} AND {B} GROUP BY pool ORDER BY cents DESC LIMIT 3", lambda x: x.filter(_in_period()).groupBy("pool").agg(F.sum("cents").alias("cents")).orderBy(F.desc("cents")).limit(3)),
    "hand_weekend": ("SELECT isodow(day) >= 6 AS weekend, sum(cents)::BIGINT AS cents, count(DISTINCT day) AS days FROM daily GROUP BY 1", lambda x: x.groupBy((F.weekday("day") >= 5).alias("weekend")).agg(F.sum("cents").alias("cents"), F.countDistinct("day").alias("days"))),
    "hand_rank_days": ("SELECT day FROM daily GROUP BY day ORDER BY sum(cents) DESC, day LIMIT 5", lambda x: x.groupBy("day").agg(F.sum("cents").alias("c")).orderBy(F.desc("c"), "day").limit(5).select("day")),
    "hand_grew": ("SELECT count(*) AS days FROM (SELECT pool, cents > lag(cents) OVER (PARTITION BY pool ORDER BY day) AS up FROM daily) WHERE up", lambda x: x.withColumn("up", F.col("cents") > F.lag("cents").over(Window.partitionBy("pool").orderBy("day"))).filter("up").agg(F.count("*").alias("days"))),
    "hand_week_compare": ("SELECT CAST(date_trunc('week', day) AS DATE) AS monday, sum(swaps)::BIGINT AS swaps, round(sum(usd) / sum(swaps), 4) AS each FROM daily GROUP BY 1", lambda x: x.groupBy(F.to_date(F.date_trunc("week", "day")).alias("monday")).agg(F.sum("swaps").alias("swaps"), F.round(F.sum("cents") / F.lit(100.0) / F.sum("swaps"), 4).alias("each"))),
    "hand_median_day": ("SELECT pool, list_sort(list(cents))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS median FROM daily GROUP BY pool", lambda x: x.groupBy("pool").agg(F.get(F.array_sort(F.collect_list("cents")), F.floor(F.count("*") / 2).cast("int")).alias("median"))),
    "hand_days_led": ("SELECT top AS pool, count(*) AS days FROM (SELECT day, arg_max(pool, (cents, pool)) AS top FROM daily GROUP BY day) GROUP BY 1", lambda x: x.groupBy("day").agg(F.max_by("pool", F.struct("cents", "pool")).alias("pool")).groupBy("pool").agg(F.count("*").alias("days"))),
    "hand_below_average": ("SELECT d.pool, count(*) AS days FROM daily d JOIN (SELECT pool, avg(cents) AS m FROM daily GROUP BY pool) a USING (pool) WHERE d.cents < a.m GROUP BY 1", lambda x: x.withColumn("m", F.avg("cents").over(Window.partitionBy("pool"))).filter("cents < m").groupBy("pool").agg(F.count("*").alias("days"))),
}
for _name, (_sql, _plan) in TEMPLATES.items():
    query(f"q_template_{_name}", f"WITH {DAILY} {_sql}")(lambda spark, d, plan=_plan: plan(daily(spark, d)))
