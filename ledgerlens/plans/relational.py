"""Relational operators one by one: projections, filters, joins, aggregates, windows, sorts, sets
and arrays, each on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import decode, money, wide
from ..operators.ordered import lag_or_self, rolling_median
from ..operators.ranking import global_rank
from ..session import stored
from .analyses import upper
from .registry import TRADES, query, read, trades

r4 = lambda c, name: F.round(c, 4).alias(name)


# projections and filters


@query("prj_alias_reuse", "SELECT o_orderpriority, n, round(total, 2) AS total, round(total / n, 4) AS each FROM (SELECT o_orderpriority, count(*) AS n, sum(o_totalprice) AS total FROM orders GROUP BY 1)")
def prj_alias_reuse(spark, d):
    sums = read(spark, d, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))
    return sums.select("o_orderpriority", "n", F.round("total", 2).alias("total"), r4(F.col("total") / F.col("n"), "each"))


@query("prj_cond", "SELECT event_id, CASE WHEN value < 10 THEN 'small' WHEN value < 100 THEN 'middle' ELSE 'large' END AS size FROM events")
def prj_cond(spark, d):
    v = F.col("value")
    return read(spark, d, "events").select("event_id", F.when(v < 10, "small").when(v < 100, "middle").otherwise("large").alias("size"))


@query("prj_const_tag", "SELECT 'customer' AS kind, count(*) AS n FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier")
def prj_const_tag(spark, d):
    parts = [read(spark, d, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("kind"), "n") for t in ("customer", "supplier")]
    return parts[0].unionByName(parts[1])


@query("flt_eq_range", "SELECT event_id, value FROM events WHERE event_type = 'click' AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-06'")
def flt_eq_range(spark, d):
    return read(spark, d, "events").filter("event_type = 'click' and ts >= timestamp'2024-01-05' and ts < timestamp'2024-01-06'").select("event_id", "value")


@query("flt_between", "SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1997-03-31'")
def flt_between(spark, d):
    return read(spark, d, "orders").filter(F.to_date("o_orderdate").between("1997-03-01", "1997-03-31")).select("o_orderkey")


@query("flt_in_list", "SELECT event_id FROM events WHERE event_type IN ('click', 'signup')")
def flt_in_list(spark, d):
    return read(spark, d, "events").filter(F.col("event_type").isin("click", "signup")).select("event_id")


@query("flt_in_subquery", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9000)")
def flt_in_subquery(spark, d):
    rich = read(spark, d, "customer").filter("c_acctbal > 9000").select(F.col("c_custkey").alias("o_custkey"))
    return read(spark, d, "orders").join(rich, "o_custkey", "left_semi").select("o_orderkey")


@query("flt_tuple_in", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE (l_orderkey, l_linenumber) IN (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 3)")
def flt_tuple_in(spark, d):
    rows, keys = read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]
    return rows.join(rows.groupBy(keys).agg(F.count("*").alias("n")).filter("n > 3").select(keys), keys, "left_semi").select(*keys, "l_partkey")


@query("flt_sign", f"WITH {TRADES} SELECT log_index FROM trades WHERE sign(other_raw) <> sign(log_index - 500)")
def flt_sign(spark, d):
    return trades(spark, d).filter("signum(other_raw) != signum(log_index - 500)").select("log_index")


@query("flt_tolerance", f"WITH {TRADES} SELECT log_index FROM trades WHERE abs(CAST(other_raw + 500 AS DOUBLE)) <= 0.1 * abs(CAST(other_raw AS DOUBLE))")
def flt_tolerance(spark, d):
    return trades(spark, d).filter("abs(cast(other_raw + 500 as double)) <= 0.1D * abs(cast(other_raw as double))").select("log_index")


@query("flt_regex", "SELECT c_custkey FROM customer WHERE regexp_matches(c_name, '^Customer#0+[1-9]7$')")
def flt_regex(spark, d):
    return read(spark, d, "customer").filter(F.col("c_name").rlike("^Customer#0+[1-9]7$")).select("c_custkey")


@query("flt_endswith", "SELECT c_custkey FROM customer WHERE ends_with(c_name, '77')")
def flt_endswith(spark, d):
    return read(spark, d, "customer").filter(F.col("c_name").endswith("77")).select("c_custkey")


@query("flt_ilike", "SELECT p_partkey FROM part WHERE p_name NOT ILIKE '%RING%'")
def flt_ilike(spark, d):
    return read(spark, d, "part").filter(~F.col("p_name").ilike("%RING%")).select("p_partkey")


@query("flt_null", "SELECT c.c_custkey, coalesce(o.n, 0) AS n, o.n IS NULL AS none, nullif(c.c_nationkey, 3) AS nation FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o ON o.o_custkey = c.c_custkey")
def flt_null(spark, d):
    counts = read(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    joined = read(spark, d, "customer").join(counts, "c_custkey", "left")
    return joined.select("c_custkey", F.coalesce("n", F.lit(0)).alias("n"), F.col("n").isNull().alias("none"), F.nullif("c_nationkey", F.lit(3)).alias("nation"))


@query("flt_default", "SELECT n_nationkey FROM nation WHERE n_regionkey = 0 UNION ALL SELECT n_nationkey FROM nation WHERE n_name = ''")
def flt_default(spark, d):
    """Rows with a column at its type's default."""
    from ..operators.quality import is_default

    rows = read(spark, d, "nation")
    return rows.filter(is_default(rows, "n_regionkey") | is_default(rows, "n_name")).select("n_nationkey")


# joins


@query("join_inner_dim", "SELECT n.n_name, count(*) AS customers FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey GROUP BY 1")
def join_inner_dim(spark, d):
    dim = read(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return read(spark, d, "customer").join(F.broadcast(dim), "c_nationkey").groupBy("n_name").agg(F.count("*").alias("customers"))  # nations: 25 rows


@query("join_inner_multi", f"WITH {TRADES}, a AS (SELECT pool, day, count(*) AS n FROM trades GROUP BY 1, 2), b AS (SELECT pool, day, max(log_index) AS last FROM trades GROUP BY 1, 2) SELECT a.pool, a.day, a.n, b.last FROM a JOIN b USING (pool, day)")
def join_inner_multi(spark, d):
    t = trades(spark, d).groupBy("pool", "day")
    return t.agg(F.count("*").alias("n")).join(t.agg(F.max("log_index").alias("last")), ["pool", "day"])


@query("join_inner_optin", f"WITH {TRADES}, fetched AS (SELECT DISTINCT pool, day FROM trades WHERE sender % 50 = 7) SELECT t.pool, t.day, count(*) AS n FROM trades t JOIN fetched f USING (pool, day) GROUP BY 1, 2")
def join_inner_optin(spark, d):
    """Pool-days that were not fetched have no row, rather than a zero."""
    t = trades(spark, d)
    fetched = t.filter("sender % 50 = 7").select("pool", "day").distinct()
    return t.join(fetched, ["pool", "day"]).groupBy("pool", "day").agg(F.count("*").alias("n"))


@query("join_left_default", "SELECT c.c_custkey, coalesce(o.n, 0) AS orders, coalesce(o.total, 0.0) AS total FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1) o ON o.o_custkey = c.c_custkey")
def join_left_default(spark, d):
    o = read(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return read(spark, d, "customer").join(o, "c_custkey", "left").select("c_custkey", F.coalesce("orders", F.lit(0)).alias("orders"), F.coalesce("total", F.lit(0.0)).alias("total"))


FULL = f"""WITH {TRADES}, l AS (SELECT pool, day, count(*) AS n FROM trades WHERE log_index % 3 <> 0 AND day <> DATE '2024-01-03' GROUP BY 1, 2), r AS (SELECT pool, day, count(*) AS n FROM trades WHERE log_index % 3 <> 1 AND pool <> 'view' GROUP BY 1, 2)
SELECT coalesce(l.pool, r.pool) AS pool, coalesce(l.day, r.day) AS day, CASE WHEN l.pool IS NULL THEN 'only_right' WHEN r.pool IS NULL THEN 'only_left' ELSE 'both' END AS presence, coalesce(l.n, 0) AS ln, coalesce(r.n, 0) AS rn
FROM l FULL JOIN r ON l.pool = r.pool AND l.day = r.day"""


@query("join_full_default", FULL)
def join_full_default(spark, d):
    t = trades(spark, d)
    left = t.filter("log_index % 3 != 0 and day != date'2024-01-03'").groupBy("pool", "day").agg(F.count("*").alias("ln")).withColumn("in_l", F.lit(True))
    right = t.filter("log_index % 3 != 1 and pool != 'view'").groupBy("pool", "day").agg(F.count("*").alias("rn")).withColumn("in_r", F.lit(True))
    both = left.join(right, ["pool", "day"], "full_outer")
    presence = F.when(F.col("in_l").isNull(), "only_right").when(F.col("in_r").isNull(), "only_left").otherwise("both")
    return both.select("pool", "day", presence.alias("presence"), F.coalesce("ln", F.lit(0)).alias("ln"), F.coalesce("rn", F.lit(0)).alias("rn"))


@query("join_full_hourly", f"WITH {TRADES}, a AS (SELECT hour(ts) AS h, count(*) AS n FROM trades WHERE pool = 'click' AND day = DATE '2024-01-10' GROUP BY 1), b AS (SELECT hour(ts) AS h, count(*) AS n FROM trades WHERE pool = 'view' AND day = DATE '2024-01-10' GROUP BY 1) SELECT CAST(coalesce(a.h, b.h) AS INT) AS hour, coalesce(a.n, 0) AS ours, coalesce(b.n, 0) AS theirs FROM a FULL JOIN b ON a.h = b.h")
def join_full_hourly(spark, d):
    t = trades(spark, d).filter("day = date'2024-01-10'")
    side = lambda pool, name: t.filter(F.col("pool") == pool).groupBy(F.hour("ts").alias("hour")).agg(F.count("*").alias(name))
    return side("click", "ours").join(side("view", "theirs"), "hour", "full_outer").fillna(0, ["ours", "theirs"])


@query("join_left_anti", "SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 300000)")
def join_left_anti(spark, d):
    return read(spark, d, "customer").join(read(spark, d, "orders").filter("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey")


@query("join_semi", f"WITH {TRADES} SELECT log_index, tx IN (SELECT tx FROM trades WHERE sender % 7 = 0) AS named FROM trades")
def join_semi(spark, d):
    t = trades(spark, d)
    named = t.filter("sender % 7 = 0").select("tx").distinct().withColumn("named", F.lit(True))
    return t.join(named, "tx", "left").select("log_index", F.coalesce("named", F.lit(False)).alias("named"))


@query("join_cross_scalar", "SELECT o_orderpriority, round(sum(o_totalprice) / (SELECT sum(o_totalprice) FROM orders), 6) AS share FROM orders GROUP BY 1")
def join_cross_scalar(spark, d):
    sums = read(spark, d, "orders").groupBy("o_orderpriority").agg(F.sum("o_totalprice").alias("total"))
    return sums.crossJoin(F.broadcast(sums.agg(F.sum("total").alias("whole")))).select("o_orderpriority", F.round(F.col("total") / F.col("whole"), 6).alias("share"))  # one row


@query("join_day_shift", f"WITH {TRADES}, x AS (SELECT pool, day, count(*) AS n FROM trades GROUP BY 1, 2) SELECT t.pool, t.day, t.n, y.n AS before FROM x t JOIN x y ON y.pool = t.pool AND y.day = t.day - 1")
def join_day_shift(spark, d):
    daily = trades(spark, d).groupBy("pool", "day").agg(F.count("*").alias("n"))
    return daily.join(daily.select("pool", F.date_add("day", 1).alias("day"), F.col("n").alias("before")), ["pool", "day"])


@query("join_subq_scalar", "SELECT o_orderkey FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) * 1.9 FROM orders) AND o_orderdate >= (SELECT min(o_orderdate) FROM orders)")
def join_subq_scalar(spark, d):
    o = read(spark, d, "orders")
    limits = o.agg((F.avg("o_totalprice") * 1.9).alias("high"), F.min("o_orderdate").alias("first"))
    return o.crossJoin(F.broadcast(limits)).filter("o_totalprice > high and o_orderdate >= first").select("o_orderkey")  # one row


# aggregates


@query("agg_count_sum_minmax", "SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS qty, min(l_shipdate) AS first, max(l_shipdate) AS last, round(avg(l_quantity), 6) AS mean FROM lineitem GROUP BY 1, 2")
def agg_count_sum_minmax(spark, d):
    return read(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"), F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"), F.round(F.avg("l_quantity"), 6).alias("mean"))


#: ``worded``: the rows of a table (hi, lo: integers of up to 17 digits) with hi * 2^128 + lo as text
#: (whole), by groups of 19 digits.
WIDE_SQL = """w1 AS (SELECT *, hi::HUGEINT * 3374607431768211456 + lo::HUGEINT AS low FROM {table}),
w2 AS (SELECT *, ((low % 10000000000000000000) + 10000000000000000000) % 10000000000000000000 AS r FROM w1),
w3 AS (SELECT *, hi::HUGEINT * 34028236692093846346 + (low - r) // 10000000000000000000 AS t FROM w2),
w4 AS (SELECT *, CASE WHEN t < 0 AND r > 0 THEN -t - 1 ELSE abs(t) END AS top, CASE WHEN t < 0 AND r > 0 THEN 10000000000000000000 - r ELSE r END AS rest FROM w3),
worded AS (SELECT *, CASE WHEN t < 0 THEN '-' ELSE '' END || CASE WHEN top = 0 THEN CAST(rest AS VARCHAR) ELSE CAST(top AS VARCHAR) || lpad(CAST(rest AS VARCHAR), 19, '0') END AS whole FROM w4)"""


def wide_words(spark, d):
    """Trades with a word of some 60 digits: other_raw * 2^128 + log_index."""
    high = F.substring(decode.word_of(F.col("other_raw")), 33, 32)
    return trades(spark, d).withColumn("word", F.concat(high, F.lpad(F.lower(F.hex("log_index")), 32, "0")))


@query("agg_sum_exact", f"WITH {TRADES}, s AS (SELECT pool, day, sum(other_raw)::HUGEINT AS hi, sum(log_index)::HUGEINT AS lo FROM trades GROUP BY ROLLUP (pool, day)), {WIDE_SQL.format(table='s')} SELECT coalesce(pool, '') AS pool, day, whole AS total FROM worded")
def agg_sum_exact(spark, d):
    """Sums beyond 38 digits by pool and day, by pool, and in all: partial sums merge."""
    daily = wide_words(spark, d).groupBy("pool", "day").agg(wide.limb_sums(F.col("word")).alias("sums"))
    rolled = daily.rollup("pool", "day").agg(wide.merged(F.col("sums")).alias("sums"))
    totals = wide.with_total(rolled.select(F.coalesce("pool", F.lit("")).alias("pool"), "day", "sums"), "sums", "word")
    return totals.select("pool", "day", decode.int256_text(F.col("word")).alias("total"))


@query("agg_sum_exact_decimal", f"WITH {TRADES} SELECT pool, CAST(sum(CAST(other_raw AS HUGEINT) * 1000000000000000000) AS VARCHAR) AS total FROM trades GROUP BY 1")
def agg_sum_exact_decimal(spark, d):
    """Within 38 digits a decimal does."""
    raw = F.col("other_raw").cast("decimal(20,0)") * F.lit("1000000000000000000").cast("decimal(19,0)")
    return trades(spark, d).groupBy("pool").agg(F.sum(raw.cast("decimal(38,0)")).cast("string").alias("total"))


@query("agg_if", "SELECT user_id % 10 AS g, coalesce(sum(CASE WHEN event_type = 'click' THEN 1 END), 0)::BIGINT AS clicks, count(DISTINCT CASE WHEN event_type = 'view' THEN user_id END) AS viewers, max(CASE WHEN event_type = 'error' THEN value END) AS worst FROM events GROUP BY 1")
def agg_if(spark, d):
    is_ = lambda k: F.col("event_type") == k
    return read(spark, d, "events").groupBy((F.col("user_id") % 10).alias("g")).agg(F.count_if(is_("click")).alias("clicks"), F.countDistinct(F.when(is_("view"), F.col("user_id"))).alias("viewers"), F.max(F.when(is_("error"), F.col("value"))).alias("worst"))


@query("agg_pivot_if", f"WITH {TRADES} SELECT day, count(*) FILTER (pool = 'click') AS clicks, count(*) FILTER (pool = 'view') AS views, round(coalesce(sum(usd) FILTER (pool = 'click'), 0), 4) AS click_usd FROM trades GROUP BY 1")
def agg_pivot_if(spark, d):
    return trades(spark, d).groupBy("day").agg(F.count_if(F.col("pool") == "click").alias("clicks"), F.count_if(F.col("pool") == "view").alias("views"), r4(F.coalesce(F.sum(F.when(F.col("pool") == "click", F.col("usd"))), F.lit(0.0)), "click_usd"))


@query("agg_distinct", f"WITH {TRADES} SELECT pool, count(DISTINCT sender) AS senders, count(DISTINCT tx) AS txs FROM trades GROUP BY 1")
def agg_distinct(spark, d):
    return trades(spark, d).groupBy("pool").agg(F.countDistinct("sender").alias("senders"), F.countDistinct("tx").alias("txs"))


@query("agg_argmin", "SELECT event_type, arg_min(value, event_id) AS first, arg_max(value, event_id) AS last FROM events GROUP BY 1")
def agg_argmin(spark, d):
    return read(spark, d, "events").groupBy("event_type").agg(F.min_by("value", "event_id").alias("first"), F.max_by("value", "event_id").alias("last"))


@query("agg_any", "SELECT n_regionkey, max(r_name) AS region, count(*) AS nations FROM nation JOIN region ON r_regionkey = n_regionkey GROUP BY 1")
def agg_any(spark, d):
    joined = read(spark, d, "nation").join(F.broadcast(read(spark, d, "region")), F.col("r_regionkey") == F.col("n_regionkey"))  # five rows
    return joined.groupBy("n_regionkey").agg(F.max("r_name").alias("region"), F.count("*").alias("nations"))


@query("agg_quantile_exact", f"SELECT event_type, {upper('value', 0.5)} AS p50, {upper('value', 0.9)} AS p90, {upper('value', 0.99)} AS p99 FROM events GROUP BY 1")
def agg_quantile_exact(spark, d):
    from ..functions.quantiles import exact_by_rank

    return exact_by_rank(read(spark, d, "events"), ["event_type"], "value", {"p50": 0.5, "p90": 0.9, "p99": 0.99})


@query("agg_rollup", "SELECT coalesce(n_name, '') AS nation, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY ROLLUP (n_name)")
def agg_rollup(spark, d):
    dim = F.broadcast(read(spark, d, "nation"))  # 25 rows
    rolled = read(spark, d, "customer").join(dim, F.col("n_nationkey") == F.col("c_nationkey")).rollup("n_name").agg(F.count("*").alias("n"), F.grouping("n_name").alias("all"))
    return rolled.select(F.when(F.col("all") == 1, "").otherwise(F.col("n_name")).alias("nation"), "n")


@query("agg_group_array", "SELECT n_regionkey, list_sort(list(n_name)) AS names, len(list(DISTINCT n_nationkey))::INT AS n FROM nation GROUP BY 1")
def agg_group_array(spark, d):
    return read(spark, d, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_name")).alias("names"), F.size(F.collect_set("n_nationkey")).alias("n"))


@query("agg_foreach", "SELECT event_type, [count(*) FILTER (value > 10), count(*) FILTER (value > 50), count(*) FILTER (value > 100)] AS beyond FROM events GROUP BY 1")
def agg_foreach(spark, d):
    return read(spark, d, "events").groupBy("event_type").agg(F.array(*[F.count_if(F.col("value") > n) for n in (10, 50, 100)]).alias("beyond"))


@query("agg_having_dups", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def agg_having_dups(spark, d):
    return read(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).filter("n > 1")


@query("agg_two_level", f"WITH {TRADES}, s AS (SELECT pool, sender, sum(usd) AS usd FROM trades GROUP BY 1, 2) SELECT pool, count(*) AS senders, round(max(usd), 4) AS largest, round(max(usd) / sum(usd), 6) AS share FROM s GROUP BY 1")
def agg_two_level(spark, d):
    per = trades(spark, d).groupBy("pool", "sender").agg(F.sum("usd").alias("usd"))
    return per.groupBy("pool").agg(F.count("*").alias("senders"), r4(F.max("usd"), "largest"), F.round(F.max("usd") / F.sum("usd"), 6).alias("share"))


@query("agg_of_ratio", "SELECT l_returnflag, round(sum(l_extendedprice) / sum(l_quantity), 4) AS ratio_of_sums, round(avg(l_extendedprice / l_quantity), 4) AS mean_of_ratios FROM lineitem GROUP BY 1")
def agg_of_ratio(spark, d):
    price, qty = F.col("l_extendedprice"), F.col("l_quantity")
    return read(spark, d, "lineitem").groupBy("l_returnflag").agg(r4(F.sum(price) / F.sum(qty), "ratio_of_sums"), r4(F.avg(price / qty), "mean_of_ratios"))


@query("agg_order_by_agg", f"WITH {TRADES} SELECT pool, day FROM trades GROUP BY 1, 2 ORDER BY round(sum(usd), 6) DESC, pool, day LIMIT 10")
def agg_order_by_agg(spark, d):
    return trades(spark, d).groupBy("pool", "day").agg(F.round(F.sum("usd"), 6).alias("usd")).orderBy(F.desc("usd"), "pool", "day").limit(10).drop("usd")


@query("agg_signed_split", f"WITH {TRADES} SELECT pool, sum(abs(other_raw))::BIGINT AS total FROM trades GROUP BY 1")
def agg_signed_split(spark, d):
    """Sum of sizes as positive less negative: another way to the same number."""
    raw = F.col("other_raw")
    return trades(spark, d).groupBy("pool").agg((F.sum(F.when(raw > 0, raw).otherwise(0)) - F.sum(F.when(raw < 0, raw).otherwise(0))).alias("total"))


@query("agg_mergeable", f"WITH {TRADES} SELECT pool, day, count(*) AS n, sum(abs(other_raw))::BIGINT AS raw FROM trades GROUP BY 1, 2")
def agg_mergeable(spark, d):
    """Partial sums of two halves, summed again when read."""
    t = trades(spark, d)
    part = lambda rows: rows.groupBy("pool", "day").agg(F.count("*").alias("n"), F.sum(F.abs("other_raw")).alias("raw"))
    return part(t.filter("log_index % 2 = 0")).unionByName(part(t.filter("log_index % 2 = 1"))).groupBy("pool", "day").agg(F.sum("n").alias("n"), F.sum("raw").alias("raw"))


# windows: each has a key that spreads, or runs on the few rows of an aggregate

def by_user():
    return Window.partitionBy("user_id").orderBy("event_id")


@query("win_lag_default", "SELECT event_id, lag(value, 1, value) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events")
def win_lag_default(spark, d):
    return read(spark, d, "events").select("event_id", lag_or_self(F.col("value"), by_user()).alias("before"))


@query("win_lag_bool", "SELECT event_id, lag(value > 20, 1, false) OVER (PARTITION BY user_id ORDER BY event_id) AS was_large FROM events")
def win_lag_bool(spark, d):
    return read(spark, d, "events").select("event_id", F.lag(F.col("value") > 20, 1, False).over(by_user()).alias("was_large"))


@query("win_rolling_median", "SELECT event_id, list_sort(h)[CAST(floor(len(h) / 2) AS BIGINT) + 1] AS median FROM (SELECT event_id, list(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING) AS h FROM events)")
def win_rolling_median(spark, d):
    return read(spark, d, "events").select("event_id", rolling_median(F.col("value"), by_user()).alias("median"))


@query("win_row_number", f"WITH {TRADES}, s AS (SELECT sender, round(sum(usd), 6) AS usd, count(*) AS n FROM trades GROUP BY 1) SELECT sender, row_number() OVER (ORDER BY usd DESC, n DESC, sender)::INT AS place FROM s")
def win_row_number(spark, d):
    """A global rank without one task for all: range partitions are ranked each, and start where
    the rows of earlier ranges end."""
    from ..operators.ranking import global_rank

    per = trades(spark, d).groupBy("sender").agg(F.round(F.sum("usd"), 6).alias("usd"), F.count("*").alias("n"))
    return global_rank(per, [F.desc("usd"), F.desc("n"), F.asc("sender")], "place").select("sender", F.col("place").cast("int").alias("place"))


@query("win_row_number_part", f"WITH {TRADES} SELECT log_index, row_number() OVER (PARTITION BY pool, day, usd > 20 ORDER BY md5(CAST(log_index AS VARCHAR)))::INT AS place FROM trades")
def win_row_number_part(spark, d):
    t = trades(spark, d).withColumn("large", F.col("usd") > 20)
    return t.select("log_index", F.row_number().over(Window.partitionBy("pool", "day", "large").orderBy(F.md5(F.col("log_index").cast("string").cast("binary")))).alias("place"))


@query("win_count_if_part", f"WITH {TRADES} SELECT log_index, count(*) FILTER (usd > 20) OVER (PARTITION BY pool, day) AS large FROM trades")
def win_count_if_part(spark, d):
    return trades(spark, d).select("log_index", F.count_if(F.col("usd") > 20).over(Window.partitionBy("pool", "day")).alias("large"))


@query("win_block_number", f"WITH {TRADES} SELECT pool, day, row_number() OVER (ORDER BY n DESC, pool, day)::INT AS place FROM (SELECT pool, day, count(*) AS n FROM trades GROUP BY 1, 2 ORDER BY n DESC, pool, day LIMIT 20)")
def win_block_number(spark, d):
    order = [F.desc("n"), F.asc("pool"), F.asc("day")]
    top = trades(spark, d).groupBy("pool", "day").agg(F.count("*").alias("n")).orderBy(*order).limit(20)
    return top.select("pool", "day", F.row_number().over(Window.orderBy(*order)).alias("place"))


@query("win_named", "SELECT event_id, lag(event_type) OVER w AS before, lead(event_type) OVER w AS after FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)")
def win_named(spark, d):
    return read(spark, d, "events").select("event_id", F.lag("event_type").over(by_user()).alias("before"), F.lead("event_type").over(by_user()).alias("after"))


# sorts and limits


@query("topk_simple", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def topk_simple(spark, d):
    return read(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("topk_unique_guard", f"WITH {TRADES}, x AS (SELECT day, count(*) AS n FROM trades GROUP BY 1) SELECT max(n) AS most, count(*) FILTER (n = (SELECT max(n) FROM x)) = 1 AS is_unique FROM x")
def topk_unique_guard(spark, d):
    daily = trades(spark, d).groupBy("day").agg(F.count("*").alias("n"))
    return daily.groupBy("n").agg(F.count("*").alias("days")).agg(F.max("n").alias("most"), (F.max_by("days", "n") == 1).alias("is_unique"))


@query("sort_expr", "SELECT region, n FROM (SELECT coalesce(CAST(n_regionkey AS VARCHAR), '') AS region, count(*) AS n FROM nation GROUP BY ROLLUP (n_regionkey)) ORDER BY region = '', region")
def sort_expr(spark, d):
    rolled = read(spark, d, "nation").rollup("n_regionkey").agg(F.count("*").alias("n"))
    return rolled.select(F.coalesce(F.col("n_regionkey").cast("string"), F.lit("")).alias("region"), "n").orderBy(F.col("region") == "", "region")


@query("row_cap", "SELECT n_nationkey, (SELECT count(*) FROM nation) > 10 AS truncated FROM nation ORDER BY n_nationkey LIMIT 10")
def row_cap(spark, d):
    """The first rows and whether there are more: one row beyond the cap is enough to know."""
    cap = 10
    first = read(spark, d, "nation").select("n_nationkey").orderBy("n_nationkey").limit(cap + 1)
    held = first.agg((F.count("*") > cap).alias("truncated"))
    return first.orderBy("n_nationkey").limit(cap).crossJoin(F.broadcast(held))  # one row


@query("argmax_of_day_count", f"WITH {TRADES}, x AS (SELECT day, pool, count(*) AS n FROM trades GROUP BY 1, 2), y AS (SELECT day, arg_max(pool, (n, pool)) AS top FROM x GROUP BY 1) SELECT count(*) FILTER (top = 'click') AS click_days, count(*) AS days FROM y")
def argmax_of_day_count(spark, d):
    x = trades(spark, d).groupBy("day", "pool").agg(F.count("*").alias("n"))
    return x.groupBy("day").agg(F.max_by("pool", F.struct("n", "pool")).alias("top")).agg(F.count_if(F.col("top") == "click").alias("click_days"), F.count("*").alias("days"))


# sets


@query("set_union_all", f"WITH {TRADES} SELECT log_index, 'buy' AS side FROM trades WHERE other_raw > 0 UNION ALL SELECT log_index, 'sell' FROM trades WHERE other_raw < 0")
def set_union_all(spark, d):
    t = trades(spark, d)
    return t.filter("other_raw > 0").select("log_index", F.lit("buy").alias("side")).unionByName(t.filter("other_raw < 0").select("log_index", F.lit("sell").alias("side")))


@query("set_symdiff", f"WITH {TRADES}, a AS (SELECT log_index FROM trades WHERE log_index % 2 = 0), b AS (SELECT log_index FROM trades WHERE log_index % 3 = 0) SELECT log_index, 'left' AS only_in FROM a WHERE log_index NOT IN (SELECT log_index FROM b) UNION ALL SELECT log_index, 'right' FROM b WHERE log_index NOT IN (SELECT log_index FROM a)")
def set_symdiff(spark, d):
    t = trades(spark, d)
    a, b = (t.filter(f"log_index % {n} = 0").select("log_index") for n in (2, 3))
    return a.join(b, "log_index", "left_anti").withColumn("only_in", F.lit("left")).unionByName(b.join(a, "log_index", "left_anti").withColumn("only_in", F.lit("right")))


@query("set_dedup_union", f"WITH {TRADES} SELECT sender FROM trades WHERE pool = 'click' UNION SELECT sender FROM trades WHERE pool = 'view'")
def set_dedup_union(spark, d):
    t = trades(spark, d)
    return t.filter("pool = 'click'").select("sender").union(t.filter("pool = 'view'").select("sender")).distinct()


# arrays and generators


@query("arr_explode_param", f"WITH {TRADES} SELECT p.tx, count(*) AS n FROM (SELECT unnest([1, 5, 9, 33]) AS tx) p JOIN trades t USING (tx) GROUP BY 1")
def arr_explode_param(spark, d):
    wanted = spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in (1, 5, 9, 33)])).alias("tx"))
    return trades(spark, d).join(F.broadcast(wanted), "tx").groupBy("tx").agg(F.count("*").alias("n")).select(F.col("tx").cast("int").alias("tx"), "n")  # four rows


CALENDAR = f"""WITH {TRADES}, span AS (SELECT min(day) AS a, max(day) AS b FROM trades), cal AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM span),
users AS (SELECT DISTINCT sender FROM trades) SELECT u.sender, c.day FROM users u, cal c WHERE NOT EXISTS (SELECT 1 FROM trades t WHERE t.sender = u.sender AND t.day = c.day)"""


def _missing_days(spark, d):
    """Days of the calendar on which a sender has no trade: the calendar without the sender's days,
    one row for each sender until the missing days are listed."""
    t = trades(spark, d)
    span = t.agg(F.min("day").alias("a"), F.max("day").alias("b"))
    days = t.groupBy("sender").agg(F.collect_set("day").alias("days")).crossJoin(F.broadcast(span))  # one row
    return days.select("sender", F.explode(F.array_except(F.sequence("a", "b"), "days")).alias("day"))


query("arr_calendar", CALENDAR)(_missing_days)
query("q_sanity_03", CALENDAR)(_missing_days)


@query("arr_map", "SELECT event_id, [CAST(value > 10 AS INT), CAST(value > 50 AS INT), CAST(value > 100 AS INT)] AS beyond FROM events")
def arr_map(spark, d):
    limits = F.array(*[F.lit(x) for x in (10, 50, 100)])
    return read(spark, d, "events").select("event_id", F.transform(limits, lambda n: (F.col("value") > n).cast("int")).alias("beyond"))


@query("arr_count", f"WITH {TRADES} SELECT day, len(list_filter(list(usd), lambda x: x > 20))::INT AS large FROM trades WHERE pool = 'click' GROUP BY 1")
def arr_count(spark, d):
    return trades(spark, d).filter("pool = 'click'").groupBy("day").agg(F.size(F.filter(F.collect_list("usd"), lambda x: x > 20)).alias("large"))


@query("arr_sort_concat", "SELECT n_regionkey, string_agg(n_name, ', ' ORDER BY n_nationkey) AS names FROM nation GROUP BY 1")
def arr_sort_concat(spark, d):
    held = F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name")))
    return read(spark, d, "nation").groupBy("n_regionkey").agg(F.array_join(F.transform(held, lambda x: x["n_name"]), ", ").alias("names"))


@query("arr_contains", "SELECT n_nationkey, list_contains([3, 7, 11], n_nationkey) AS inside, list_position([3, 7, 11], n_nationkey)::INT AS place FROM nation")
def arr_contains(spark, d):
    held = F.array(F.lit(3), F.lit(7), F.lit(11))
    return read(spark, d, "nation").select("n_nationkey", F.array_contains(held, F.col("n_nationkey")).alias("inside"), F.nullif(F.array_position(held, F.col("n_nationkey")), F.lit(0)).cast("int").alias("place"))


# decoding and exact money

def amount():
    return F.col("other_raw") * F.lit(1_000_003)


AMOUNT_SQL = "other_raw * 1000003"


@query("dec_int256", f"WITH {TRADES} SELECT log_index, CAST({AMOUNT_SQL} AS VARCHAR) AS amount FROM trades")
def dec_int256(spark, d):
    """There and back: the amount as a word of 64 hex digits, decoded again."""
    return trades(spark, d).select("log_index", decode.int256(decode.word_of(amount())).cast("string").alias("amount"))


@query("dec_uint256", f"WITH {TRADES} SELECT log_index, CAST(abs({AMOUNT_SQL}) AS DOUBLE) AS amount FROM trades")
def dec_uint256(spark, d):
    return trades(spark, d).select("log_index", decode.uint_double(decode.word_of(F.abs(amount()))).alias("amount"))


@query("dec_quantity", "SELECT event_id, event_id * 4099 AS q FROM events")
def dec_quantity(spark, d):
    return read(spark, d, "events").select("event_id", decode.quantity(F.concat(F.lit("0x"), F.lower(F.hex(F.col("event_id") * 4099)))).alias("q"))


@query("dec_topic_addr", "SELECT event_id, '0x' || lpad(lower(to_hex(user_id)), 40, '0') AS sender FROM events")
def dec_topic_addr(spark, d):
    return read(spark, d, "events").select("event_id", decode.topic_address(F.concat(F.lit("0x"), F.lpad(F.lower(F.hex("user_id")), 64, "0"))).alias("sender"))


@query("addr_normalize", "SELECT event_id, '0x' || lpad(lower(to_hex(user_id)), 40, '0') AS sender FROM events")
def addr_normalize(spark, d):
    return read(spark, d, "events").select("event_id", decode.address(F.concat(F.lit("0x"), F.lpad(F.hex("user_id"), 40, "0"))).alias("sender"))


@query("bin_hex", "SELECT event_id, '0x' || lpad(lower(to_hex(user_id)), 40, '0') AS sender, 20 AS bytes FROM events")
def bin_hex(spark, d):
    data = decode.to_binary(F.concat(F.lit("0x"), F.lpad(F.hex("user_id"), 40, "0")), 20)
    return read(spark, d, "events").select("event_id", data.alias("b")).select("event_id", decode.to_hex(F.col("b")).alias("sender"), F.length("b").alias("bytes"))


@query("dec_trade", f"WITH {TRADES} SELECT log_index, pool, '0x' || lpad(lower(to_hex(sender)), 40, '0') AS sender, CAST(other_raw AS VARCHAR) AS amount0, CAST(-other_raw AS VARCHAR) AS amount1, CAST((log_index % 2000) - 1000 AS INT) AS tick, CASE WHEN log_index % 97 = 0 THEN 'not three topics' END AS error_reason FROM trades")
def dec_trade(spark, d):
    """Raw logs built from trades and decoded; one in 97 is malformed and keeps its reason."""
    return raw_logs(spark, d).select("log_index", "pool", *[c.alias(f"d_{n}") for n, c in decode.trade_columns(F.col("log")).items()]).select(
        "log_index", "pool", F.col("d_sender").alias("sender"), F.col("d_amount0").cast("string").alias("amount0"), F.col("d_amount1").cast("string").alias("amount1"), F.col("d_tick").alias("tick"), F.col("d_error_reason").alias("error_reason"),
    )


def raw_logs(spark, d):
    """Trades as raw log structs."""
    hexed = lambda c: F.concat(F.lit("0x"), F.lower(F.hex(c)))
    padded = F.concat(F.lit("0x"), F.lpad(F.lower(F.hex("sender")), 64, "0"))
    tick = (F.col("log_index") % 2000) - 1000
    words = [decode.word_of(F.col("other_raw")), decode.word_of(-F.col("other_raw")), decode.word_of(F.lit(1 << 60).cast("long")), decode.word_of(F.lit(10**9).cast("long")), decode.word_of(tick)]
    topics = F.array(F.lit(decode.TRADE_TOPIC), padded, padded)
    log = F.struct(
        F.lit(False).alias("removed"), F.lit("0x" + "ab" * 20).alias("address"), F.when(F.col("log_index") % 97 == 0, F.slice(F.array(F.lit(decode.TRADE_TOPIC), padded, padded, padded), 1, 4)).otherwise(topics).alias("topics"),
        F.concat(F.lit("0x"), *words).alias("data"), hexed(F.datediff("day", F.lit("1970-01-01")).cast("long")).alias("blockNumber"), F.lit("0x0").alias("transactionIndex"), hexed(F.col("log_index")).alias("logIndex"),
        hexed(F.unix_timestamp("ts")).alias("blockTimestamp"), F.lit("0x" + "00" * 32).alias("blockHash"), F.concat(F.lit("0x"), F.lpad(F.lower(F.hex("tx")), 64, "0")).alias("transactionHash"),
    )
    return trades(spark, d).select("log_index", "pool", log.alias("log"))


@query("scale_exact", f"WITH {TRADES} SELECT log_index, CAST(CAST(other_raw AS DECIMAL(38,18)) / 1 AS DOUBLE) / 1000000 AS amount FROM trades")
def scale_exact(spark, d):
    return trades(spark, d).select("log_index", money.scale_exact(F.col("other_raw").cast("decimal(38,0)"), F.lit(6)).cast("double").alias("amount"))


#: Amounts of 6, 9 or 18 decimals, as whole numbers of 10^-18: hi * 2^128 + lo.
SCALED_SQL = f"""{TRADES}, amounts AS (SELECT log_index, pool, other_raw * p AS hi, log_index * p AS lo FROM
 (SELECT *, [1000000000000, 1000000000, 1][log_index % 3 + 1]::HUGEINT AS p FROM trades)), {WIDE_SQL.format(table='amounts')},
shown AS (SELECT *, CASE WHEN whole LIKE '-%' THEN '-' ELSE '' END AS sign, lpad(ltrim(whole, '-'), greatest(length(ltrim(whole, '-')), 19)::INT, '0') AS digits FROM worded),
fixed AS (SELECT log_index, pool, hi, lo, sign || substr(digits, 1, length(digits) - 18) || '.' || right(digits, 18) AS amount FROM shown)"""


def scaled_amounts(spark, d):
    decimals = F.element_at(F.array(F.lit(6), F.lit(9), F.lit(18)), (F.col("log_index") % 3 + 1).cast("int"))
    return wide.with_scaled(wide_words(spark, d).select("log_index", "pool", "word"), "word", decimals, "word")


@query("scale_exact_wide", f"WITH {SCALED_SQL} SELECT log_index, amount FROM fixed")
def scale_exact_wide(spark, d):
    """18 digits behind the point of amounts of up to 77 digits."""
    return wide.with_fixed_text(scaled_amounts(spark, d).select("log_index", "word"), "word", "amount").drop("word")


@query("wide_order", f"WITH {SCALED_SQL} SELECT log_index, row_number() OVER (ORDER BY hi DESC, lo DESC, log_index) AS place FROM fixed")
def wide_order(spark, d):
    """Places by amount, beyond the digits of any decimal: rows are dealt by range of the key. The key
    is stored, as it would be worked out once for the ranges' bounds and again for the rows."""
    rows = stored(scaled_amounts(spark, d).select("log_index", wide.key(F.col("word")).alias("key")), "wide-amounts")
    return global_rank(rows, [F.desc("key"), F.asc("log_index")], "place", keep=["log_index"])


@query("wide_range", f"WITH {SCALED_SQL}, l AS (SELECT hi AS h, lo AS l FROM fixed WHERE log_index = 3), u AS (SELECT hi AS h, lo AS l FROM fixed WHERE log_index = 1002) SELECT pool, count(*) AS n, arg_min(amount, (hi, lo)) AS least, arg_max(amount, (hi, lo)) AS most FROM fixed, l, u WHERE (hi, lo) >= least((l.h, l.l), (u.h, u.l)) AND (hi, lo) <= greatest((l.h, l.l), (u.h, u.l)) GROUP BY 1")
def wide_range(spark, d):
    """A range filter, min and max on the key; the bounds are two of the amounts."""
    rows = stored(scaled_amounts(spark, d).select("log_index", "pool", wide.key(F.col("word")).alias("key")), "wide-amounts")
    bounds = rows.filter("log_index in (3, 1002)").agg(F.min("key").alias("from"), F.max("key").alias("to"))
    inside = rows.crossJoin(F.broadcast(bounds)).filter("key between from and to")  # one row
    ends = inside.groupBy("pool").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("least"), F.max("key").alias("most"))  # a row for each pool
    for c in ("least", "most"):
        ends = wide.with_fixed_text(ends.withColumn(c, wide.word_of_key(F.col(c))), c, c)
    return ends


LEGS = "FROM (SELECT *, CASE WHEN log_index % 3 = 0 THEN 'USDC' ELSE 'WETH' END AS t0, CASE WHEN log_index % 3 = 1 THEN 'DAI' ELSE 'X' END AS t1 FROM trades)"


def _tokens(spark, d):
    i = F.col("log_index") % 3
    return trades(spark, d).withColumn("t0", F.when(i == 0, "USDC").otherwise("WETH")).withColumn("t1", F.when(i == 1, "DAI").otherwise("X"))


STABLES = ["USDC", "USDT", "DAI"]


@query("stable_leg", f"WITH {TRADES} SELECT log_index, CASE WHEN t0 IN ('USDC','USDT','DAI') THEN abs(other_raw) WHEN t1 IN ('USDC','USDT','DAI') THEN abs(other_raw + 1) END AS leg {LEGS}")
def stable_leg(spark, d):
    t = _tokens(spark, d)
    return t.select("log_index", money.stable_leg(t["t0"], t["t1"], t["other_raw"], t["other_raw"] + 1, STABLES).alias("leg"))


@query("other_leg", f"WITH {TRADES} SELECT log_index, CASE WHEN t0 IN ('USDC','USDT','DAI') THEN other_raw + 1 WHEN t1 IN ('USDC','USDT','DAI') THEN other_raw END AS leg {LEGS}")
def other_leg(spark, d):
    t = _tokens(spark, d)
    return t.select("log_index", money.other_leg(t["t0"], t["t1"], t["other_raw"], t["other_raw"] + 1, STABLES).alias("leg"))


@query("param_lookup", "SELECT event_id, CASE event_type WHEN 'click' THEN 6 WHEN 'view' THEN 18 END AS decimals FROM events WHERE event_type IN ('click', 'view')")
def param_lookup(spark, d):
    """Aligned parameter arrays as a dimension of two rows."""
    known = spark.createDataFrame([("click", 6), ("view", 18)], "event_type string, decimals int")
    return read(spark, d, "events").join(F.broadcast(known), "event_type").select("event_id", "decimals")


@query("position_key", f"WITH {TRADES} SELECT log_index, CAST(date_diff('day', DATE '1970-01-01', blk) AS BIGINT) * 4294967296 + log_index AS pos FROM trades")
def position_key(spark, d):
    return trades(spark, d).select("log_index", money.position_key(F.datediff("blk", F.lit("1970-01-01")), F.col("log_index")).alias("pos"))


@query("price_from_sqrt", "SELECT event_id, round(pow(value * 1e27 / 79228162514264337593543950336.0::DOUBLE, 2), 9) AS price FROM events")
def price_from_sqrt(spark, d):
    return read(spark, d, "events").select("event_id", F.round(money.price_from_sqrt(F.col("value") * F.lit(1e27)), 9).alias("price"))


@query("price_from_tick", "SELECT event_id, round(pow(1.0001::DOUBLE, event_id % 20000), 9) AS price FROM events")
def price_from_tick(spark, d):
    return read(spark, d, "events").select("event_id", F.round(money.price_from_tick(F.col("event_id") % 20000), 9).alias("price"))


@query("gap_bps", "SELECT event_id, round(2e4 * ln(value / 20.0::DOUBLE), 6) AS gap FROM events WHERE value > 0")
def gap_bps(spark, d):
    return read(spark, d, "events").filter("value > 0").select("event_id", F.round(money.gap_bps(F.col("value"), F.lit(20.0)), 6).alias("gap"))


@query("json_safe_cell", "SELECT event_id, CAST(CAST(event_id AS HUGEINT) * 9007199254740993 AS VARCHAR) AS big, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS at FROM events")
def json_safe_cell(spark, d):
    """Numbers that a JSON reader would round are strings."""
    big = F.col("event_id").cast("decimal(19,0)") * F.lit("9007199254740993").cast("decimal(16,0)")
    return read(spark, d, "events").select("event_id", big.cast("decimal(38,0)").cast("string").alias("big"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("at"))


# scalar functions


@query("fn_math", "SELECT event_id, abs(value - 20) AS a, CAST(sign(value - 20) AS DOUBLE) AS s, CAST(floor(value) AS BIGINT) AS f, CAST(round(CAST(value AS DECIMAL(18, 6)), 1) AS DOUBLE) AS r, least(value, 20.0::DOUBLE) AS l, greatest(value, 20.0::DOUBLE) AS g, round(pow(value, 2), 4) AS p, round(ln(value + 1), 9) AS n FROM events")
def fn_math(spark, d):
    v = F.col("value")
    return read(spark, d, "events").select("event_id", F.abs(v - 20).alias("a"), F.signum(v - 20).alias("s"), F.floor(v).alias("f"), F.round(v, 1).alias("r"), F.least(v, F.lit(20.0)).alias("l"), F.greatest(v, F.lit(20.0)).alias("g"), F.round(F.pow(v, 2), 4).alias("p"), F.round(F.ln(v + 1), 9).alias("n"))


@query("fn_dates", """SELECT event_id, CAST(ts AS DATE) AS day, date_trunc('hour', ts) AS hour_start, CAST(hour(ts) AS INT) AS hour, strftime(ts, '%Y%m') AS month, CAST(date_trunc('week', ts) AS DATE) AS monday,
 CAST(isodow(ts) AS INT) AS weekday, dayname(ts) AS name, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INT) AS since, CAST(CAST(ts AS DATE) + 7 AS DATE) AS later, ts + INTERVAL 90 MINUTE AS shifted, ts < now()::TIMESTAMP AS past, ts > now()::TIMESTAMP - INTERVAL 1 DAY AS today FROM events""")
def fn_dates(spark, d):
    t = F.col("ts")
    return read(spark, d, "events").select(
        "event_id", F.to_date(t).alias("day"), F.date_trunc("hour", t).cast("timestamp_ntz").alias("hour_start"), F.hour(t).alias("hour"), F.date_format(t, "yyyyMM").alias("month"), F.to_date(F.date_trunc("week", t)).alias("monday"),
        (F.weekday(t) + 1).alias("weekday"), F.date_format(t, "EEEE").alias("name"), F.datediff(F.to_date(t), F.lit("2024-01-01")).alias("since"), F.date_add(F.to_date(t), 7).alias("later"), (t + F.expr("interval 90 minutes")).alias("shifted"),
        (t < F.now()).alias("past"), (t > F.now() - F.expr("interval 1 day")).alias("today"),
    )


@query("fn_strings", "SELECT c_custkey, lower(c_name) AS lo, upper(c_name) AS up, c_name || '!' AS cc, repeat('ab', 3) AS rep, substr(c_name, 10, 4) AS sub, regexp_replace(c_name, '0+', '-', 'g') AS rr, c_mktsegment LIKE 'B%' AS b FROM customer")
def fn_strings(spark, d):
    n = F.col("c_name")
    return read(spark, d, "customer").select("c_custkey", F.lower(n).alias("lo"), F.upper(n).alias("up"), F.concat(n, F.lit("!")).alias("cc"), F.repeat(F.lit("ab"), 3).alias("rep"), F.substring(n, 10, 4).alias("sub"), F.regexp_replace(n, "0+", "-").alias("rr"), F.col("c_mktsegment").like("B%").alias("b"))


@query("fn_safe_division", "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE value / (event_id % 5) END AS share FROM events")
def fn_safe_division(spark, d):
    return read(spark, d, "events").select("event_id", F.try_divide(F.col("value"), (F.col("event_id") % 5).cast("double")).alias("share"))


@query("fn_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def fn_json(spark, d):
    return read(spark, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("fn_seeded_hash")
def fn_seeded_hash(spark, d):
    """A reproducible pick: the same for a seed, another for another. No oracle: the hash is
    Spark's own."""
    return trades(spark, d).select("log_index", F.xxhash64(F.lit(7), "blk", "log_index").alias("pick"))


def _hundredths(unit: int, name: str) -> str:
    """A size in a unit with two digits, half a hundredth going up."""
    h = f"((n * 200 + {unit}) // {2 * unit})"
    return f"printf('%d.%02d {name}', CAST({h} // 100 AS BIGINT), CAST({h} % 100 AS BIGINT))"


SIZES = "event_id::HUGEINT * (CASE event_id % 4 WHEN 0 THEN 3 WHEN 1 THEN 300 WHEN 2 THEN 30000 ELSE 3000000 END)"


@query("fn_readable_size", f"SELECT event_id, CASE WHEN n < 1024 THEN {_hundredths(1, 'B')} WHEN n < 1048576 THEN {_hundredths(1 << 10, 'KiB')} WHEN n < 1073741824 THEN {_hundredths(1 << 20, 'MiB')} ELSE {_hundredths(1 << 30, 'GiB')} END AS size FROM (SELECT event_id, {SIZES} AS n FROM events)")
def fn_readable_size(spark, d):
    i = F.col("event_id")
    n = i * F.when(i % 4 == 0, 3).when(i % 4 == 1, 300).when(i % 4 == 2, 30_000).otherwise(3_000_000)
    return read(spark, d, "events").select("event_id", money.readable_size(n).alias("size"))
