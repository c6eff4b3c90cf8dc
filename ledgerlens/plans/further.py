"""Pool list, wide amounts, dashboard series, answers of other kinds, costs by tier, grounding,
the ledger, and controls on the rows of a table."""

from __future__ import annotations

import datetime
import json

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import guard
from ..functions import decode
from ..operators import evaluation as ev
from ..operators import quality
from ..sources import pools, rpc
from .control import daily_window
from .marts import DAILY, daily, q_smart_daily
from .reconciliation import HOURS, hourly
from .registry import ORACLE, TRADES, query, read, scratch, trades
from .relational import raw_logs

# sources


@query("src_yaml", "SELECT '0x' || lpad(lower(to_hex(n_nationkey)), 40, '0') AS address, n_name AS token1, [100, 500, 3000, 10000][n_nationkey % 4 + 1]::INT AS fee FROM nation")
def src_yaml(spark, d):
    """The pool list, written as YAML and read."""
    rows = read(spark, d, "nation").select("n_nationkey", "n_name").collect()  # 25 rows
    lines = ["# pools", "pools:"]
    for r in rows:
        lines += [f"  - address: \"0x{r['n_nationkey']:040X}\"", "    token0: USDC  # the stable one", f"    token1: '{r['n_name']}'", "    decimals0: 6", "    decimals1: 18", f"    fee: {pools.FEE_TIERS[r['n_nationkey'] % 4]}"]
    path = scratch(spark, "pools")
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    return pools.read_pools(spark, path).select("address", "token1", "fee")


WIDE = 2**192
BASE = 10**19


def _wide_sql(x: str) -> str:
    """x * 2^192 + x as text, by groups of 19 digits."""
    groups = [WIDE // BASE**i % BASE for i in range(4)]
    t = [f"({x}::HUGEINT * {groups[0]} + {x})"]
    for g in groups[1:]:
        t.append(f"({x}::HUGEINT * {g} + {t[-1]} // {BASE}::HUGEINT)")
    parts = [f"lpad(CAST({v} % {BASE}::HUGEINT AS VARCHAR), 19, '0')" for v in reversed(t)]
    return f"regexp_replace(CAST({t[-1]} // {BASE}::HUGEINT AS VARCHAR) || {' || '.join(parts)}, '^0+(.)', '\\1')"


@query("dec_int256_wide", f"WITH {TRADES} SELECT log_index, CASE WHEN log_index % 2 = 1 THEN '-' ELSE '' END || {_wide_sql('log_index')} AS amount FROM trades")
def dec_int256_wide(spark, d):
    """Words beyond 38 digits, both signs, to decimal text."""
    n, gap = F.col("log_index"), F.repeat(F.lit("0"), F.lit(32))
    limb = lambda c: F.lpad(F.lower(F.hex(c)), 16, "0")
    plain = F.concat(limb(n), gap, limb(n))
    # minus a number: the flipped digits of one less
    minus = F.translate(F.concat(limb(n), gap, limb(n - 1)), "0123456789abcdef", "fedcba9876543210")
    word = F.when(n % 2 == 1, minus).otherwise(plain)
    return trades(spark, d).select("log_index", decode.int256_text(word).alias("amount"))


@query("dec_swap", f"WITH {TRADES} SELECT log_index, CASE WHEN log_index % 89 = 0 THEN '{WIDE}' ELSE CAST(other_raw AS VARCHAR) END AS amount0, CAST(-other_raw AS VARCHAR) AS amount1, '{1 << 60}' AS sqrt_price, CASE WHEN log_index % 97 = 0 THEN 'not three topics' END AS error_reason FROM trades")
def dec_swap(spark, d):
    """Logs of swaps, some with an amount beyond 38 digits, which is no fault."""
    data = F.col("log.data")
    wide = F.concat(F.lit("0x" + f"{WIDE:064x}"), F.substring(data, 67, 1 << 20))
    rows = raw_logs(spark, d).withColumn("log", F.col("log").withField("data", F.when(F.col("log_index") % 89 == 0, wide).otherwise(data)))
    c = decode.trade_columns(F.col("log"))
    return rows.select("log_index", c["amount0_text"].alias("amount0"), c["amount1_text"].alias("amount1"), c["sqrt_price_text"].alias("sqrt_price"), c["error_reason"].alias("error_reason"))


@query("src_safe_head_rows", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_id + 1000 ELSE event_id + 5000 - 64 END AS head, event_id % 3 = 2 AS refused FROM events WHERE event_id < 60")
def src_safe_head_rows(spark, d):
    """Nodes that know the tag, do not know it, or are busy (which is no reason to guess)."""

    def node(i: int):
        def call(method, params):
            if method == "eth_blockNumber":
                return hex(i + 5000)
            if i % 3 == 0:
                return {"number": hex(i + 1000)}
            raise rpc.RpcError("no such tag", code=-32602) if i % 3 == 1 else rpc.RpcError("busy", retry=True)

        return rpc.Client(call, retries=0)

    out = []
    for r in read(spark, d, "events").filter("event_id < 60").select("event_id").collect():  # sixty nodes
        i = r["event_id"]
        try:
            out.append((i, rpc.safe_head(node(i)), False))
        except rpc.RpcError:
            out.append((i, i + 5000 - 64, True))
    return spark.createDataFrame(out, "event_id long, head long, refused boolean")


def _keys(spark, d) -> list[int]:
    return [r["n_nationkey"] for r in read(spark, d, "nation").select("n_nationkey").collect()]  # 25 rows


@query("src_error_budget_rows", "SELECT n_nationkey, n_nationkey * 20 >= 200 AND n_nationkey * (n_nationkey % 7) > 0.2 * n_nationkey * 20 AS over FROM nation")
def src_error_budget_rows(spark, d):
    out = []
    for k in _keys(spark, d):
        client = rpc.Client(None)
        client.requests, client.repeated = k * 20, k * (k % 7)
        out.append((k, client.over_budget()))
    return spark.createDataFrame(out, "n_nationkey int, over boolean")


@query("src_window_resume_rows", "SELECT n_nationkey, CASE WHEN n_nationkey % 12 < 10 THEN 11 + n_nationkey % 12 END AS first FROM nation")
def src_window_resume_rows(spark, d):
    """What is left of blocks 10 to 20 behind a covered beginning of some length, given in two parts."""
    left = [(k, rpc.window_left(10, 20, [(11, 10 + k % 12), (10, 10)])) for k in _keys(spark, d)]
    return spark.createDataFrame([(k, x[0] if x else None) for k, x in left], "n_nationkey int, first int")


@query("store_daily_window_rows", "SELECT n_nationkey, CAST(least(DATE '2024-01-09' + n_nationkey, DATE '2024-01-20') - CASE WHEN n_nationkey % 2 = 0 THEN 1 ELSE 0 END AS DATE) AS last FROM nation")
def store_daily_window_rows(spark, d):
    """The last whole day of fetches that end on different days, complete or not."""
    end = lambda k: datetime.datetime(2024, 1, 9, 14) + datetime.timedelta(days=k)
    out = [(k, daily_window(datetime.date(2024, 1, 3), end(k), k % 2 == 1, datetime.datetime(2024, 1, 20))[1]) for k in _keys(spark, d)]
    return spark.createDataFrame(out, "n_nationkey int, last date")


@query("sql_guard_rows", "SELECT n_nationkey, n_nationkey % 5 < 2 AS allowed FROM nation")
def sql_guard_rows(spark, d):
    """Texts that only read, and texts that write, name a path or hold a second statement."""
    kinds = ["SELECT {k} AS x", "WITH t AS (SELECT {k} AS x) SELECT x FROM t WHERE x > {k} - 1", "DELETE FROM events WHERE event_id = {k}", "SELECT * FROM csv.`/tmp/{k}`", "SELECT {k}; DROP TABLE t{k}"]
    return spark.createDataFrame([(k, guard.check(kinds[k % 5].format(k=k)).ok) for k in _keys(spark, d)], "n_nationkey int, allowed boolean")


# dashboard series


@query("q_dashboard_sender_top", f"WITH {TRADES}, per AS (SELECT sender, sum(abs(other_raw))::BIGINT AS cents FROM trades GROUP BY sender) SELECT CAST(row_number() OVER (ORDER BY cents DESC, sender) AS INT) AS rank, cents FROM per ORDER BY cents DESC, sender LIMIT 50")
def q_dashboard_sender_top(spark, d):
    per = trades(spark, d).groupBy("sender").agg(F.sum(F.abs("other_raw")).alias("cents"))
    top = per.orderBy(F.desc("cents"), "sender").limit(50)
    return top.select(F.row_number().over(Window.orderBy(F.desc("cents"), "sender")).alias("rank"), "cents")  # fifty rows


@query("q_dashboard_sender_total", f"WITH {TRADES} SELECT sum(abs(other_raw))::BIGINT AS cents, count(DISTINCT sender) AS senders FROM trades")
def q_dashboard_sender_total(spark, d):
    per = trades(spark, d).groupBy("sender").agg(F.sum(F.abs("other_raw")).alias("cents"))
    return per.agg(F.sum("cents").alias("cents"), F.count(F.lit(1)).alias("senders"))


@query("q_dashboard_smart", f"WITH {DAILY}, smart AS ({ORACLE['q_smart_daily']}) SELECT s.pool, count(*) AS pool_days, sum(d.swaps)::BIGINT AS swaps, sum(s.named_swaps)::BIGINT AS smart_swaps, min(s.day) AS first_day, max(s.day) AS last_day FROM smart s JOIN daily d ON d.pool = s.pool AND d.day = s.day GROUP BY s.pool")
def q_dashboard_smart(spark, d):
    both = q_smart_daily(spark, d).join(daily(spark, d), ["pool", "day"])
    return both.groupBy("pool").agg(F.count(F.lit(1)).alias("pool_days"), F.sum("swaps").alias("swaps"), F.sum("named_swaps").alias("smart_swaps"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


@query("q_dashboard_hourly", f"WITH {HOURS} SELECT sum(abs(diff))::BIGINT AS moved, arg_max(hour, (abs(diff), -hour)) AS top_hour, count(*) AS hours FROM hours")
def q_dashboard_hourly(spark, d):
    """A flagged pool-day hour by hour: what moved in all, and the hour that moved most."""
    size = F.abs("diff")
    return hourly(spark, d).agg(F.sum(size).alias("moved"), F.max_by("hour", F.struct(size, -F.col("hour"))).alias("top_hour"), F.count(F.lit(1)).alias("hours"))


# answers of other kinds

@query("score_date", "SELECT event_id, event_id % 4 <> 0 AS correct FROM events")
def score_date(spark, d):
    """Dates said in several forms, a quarter of them a day off."""
    said = F.date_add(F.to_date("ts"), F.when(F.col("event_id") % 4 == 0, 1).otherwise(0))
    forms = F.when(F.col("event_id") % 3 == 0, F.date_format(said, "'On' yyyy-MM-dd'.'")).when(F.col("event_id") % 3 == 1, F.date_format(said, "'It was' d MMMM yyyy'.'")).otherwise(F.date_format(said, "MMMM d, yyyy"))
    return read(spark, d, "events").select("event_id", ev.date_matches(forms, F.to_date("ts")).alias("correct"))


@query("score_list", "SELECT user_id, count(DISTINCT event_type) < 2 OR user_id % 3 = 0 AS ordered, user_id % 3 < 2 AS unordered FROM events GROUP BY user_id")
def score_list(spark, d):
    """Lists in order, in another order, and one short."""
    want = F.array_sort(F.collect_set("event_type"))
    rows = read(spark, d, "events").groupBy("user_id").agg(want.alias("want"))
    kind = F.col("user_id") % 3
    said = F.when(kind == 0, F.array_join("want", " , ")).when(kind == 1, F.upper(F.array_join(F.reverse("want"), ", "))).otherwise(F.array_join(F.concat(F.slice("want", 2, 100), F.array(F.lit("none"))), ", "))
    got = F.split(said, r"\s*,\s*")
    return rows.select("user_id", ev.list_matches(got, F.col("want"), True).alias("ordered"), ev.list_matches(got, F.col("want"), False).alias("unordered"))


@query("score_refusal", "SELECT event_id, (event_id % 5 = 0) = (event_id % 2 = 0) AS correct FROM events")
def score_refusal(spark, d):
    """A question without an answer wants a refusal; any other wants none."""
    said = F.when(F.col("event_id") % 5 == 0, "The data cannot answer this.").otherwise("42")
    return read(spark, d, "events").select("event_id", ev.refusal_matches(said, F.col("event_id") % 2 == 0).alias("correct"))


@query("tolerances", "SELECT event_id, abs(floor(value) + CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END - floor(value)) <= 0 AS count, event_id % 3 <> 0 AS sum, event_id % 5 <> 0 AS quantity, event_id % 7 <> 0 AS ratio FROM events WHERE value > 1")
def tolerances(spark, d):
    """Each kind of number just within its tolerance, and beyond."""
    v, i = F.floor("value").cast("double"), F.col("event_id")
    off = lambda n, small, large: v + F.when(i % n == 0, F.lit(large)).otherwise(F.lit(small))
    rows = read(spark, d, "events").filter("value > 1")
    return rows.select(
        "event_id", ev.number_matches(v + F.when(i % 2 == 0, 1.0).otherwise(0.0), v, "count").alias("count"), ev.number_matches(off(3, 0.009, 5.0), v, "sum").alias("sum"),
        ev.number_matches(off(5, 5e-7, 1.0), v, "quantity").alias("quantity"), ev.number_matches(v * F.when(i % 7 == 0, 1.1).otherwise(1.0005), v, "ratio").alias("ratio"),
    )


@query("label_alteration_kinds", "SELECT item_id, 'sold 5 EUR on ' || strftime(DATE '2024-01-01' + CAST(item_id % 28 + 1 AS INT), '%Y-%m-%d') || ' to Bob. It will double.' AS altered FROM benchmark")
def label_alteration_kinds(spark, d):
    """A right answer with its unit, date and name changed and a claim added."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("item_id") % 28).cast("int"))
    text = F.concat(F.lit("sold 5 USD on "), F.date_format(day, "yyyy-MM-dd"), F.lit(" to Ann."))
    return read(spark, d, "benchmark").select("item_id", ev.with_claim(ev.names_swapped(ev.date_shifted(ev.unit_swapped(text, {"USD": "EUR"}), 1), {"Ann": "Bob"}), "It will double.").alias("altered"))


AGREE = "FROM (SELECT event_type AS section, value > 30 AS a, event_id % 3 = 0 AS b FROM events)"


@query("label_confusion", f"SELECT section, count(*) FILTER (a AND b) AS both, count(*) FILTER (a AND NOT b) AS first_only, count(*) FILTER (b AND NOT a) AS second_only, count(*) FILTER (NOT a AND NOT b) AS neither, round((avg((a = b)::INT) - (avg(a::INT) * avg(b::INT) + avg((NOT a)::INT) * avg((NOT b)::INT))) / (1 - (avg(a::INT) * avg(b::INT) + avg((NOT a)::INT) * avg((NOT b)::INT))), 9) AS kappa {AGREE} GROUP BY section")
def label_confusion(spark, d):
    """Two labellers by section: what each said, and how far beyond chance they agree."""
    rows = read(spark, d, "events").select(F.col("event_type").alias("section"), (F.col("value") > 30).alias("a"), (F.col("event_id") % 3 == 0).alias("b"))
    return ev.confusion(rows, "section", "a", "b").withColumn("kappa", F.round("kappa", 9))


@query("rag_relevance", "SELECT item_id, 3 AS retrieved, CAST(item_id % 4 AS INT) AS cited, CASE WHEN item_id % 4 = 0 THEN NULL ELSE 1.0 / (item_id % 4) END AS cited_relevant FROM benchmark")
def rag_relevance(spark, d):
    """Chunks retrieved and cited against the one that is relevant."""
    i = F.col("item_id")
    got = F.array(i, i + 1, i + 2)
    cited = F.slice(F.array(i, i + 5, i + 6), F.lit(1), (i % 4).cast("int"))
    return read(spark, d, "benchmark").select("item_id", F.size(got).alias("retrieved"), F.size(cited).alias("cited"), F.try_divide(F.size(F.array_intersect(cited, F.array(i))), F.size(cited)).alias("cited_relevant"))


@query("cost_tiers", "SELECT event_id, CAST(CASE WHEN event_id > 5000 THEN event_id::HUGEINT * 50 + user_id * 250 ELSE event_id::HUGEINT * 25 + user_id * 125 END AS DOUBLE) / 100000000 AS usd FROM events")
def cost_tiers(spark, d):
    """Rates that depend on the length of the prompt."""
    tiers = [(5000, {"input": "0.25", "output": "1.25"}), (None, {"input": "0.50", "output": "2.50"})]
    usd = ev.tiered_usd(F.col("event_id"), {"input": F.col("event_id"), "output": F.col("user_id")}, tiers)
    return read(spark, d, "events").select("event_id", usd.cast("double").alias("usd"))


# grounding and the ledger


@query("grounding", "SELECT n_nationkey, CASE n_nationkey % 5 WHEN 0 THEN 'last result' WHEN 1 THEN 'last result' WHEN 2 THEN 'an earlier result' WHEN 3 THEN 'nowhere' ELSE 'only as a rounded number' END AS cause FROM nation")
def grounding(spark, d):
    """Answers as the last result has them, as the same number in other digits, from an earlier
    result, in another case, and invented."""
    out = []
    for r in read(spark, d, "nation").select("n_nationkey", "n_name").collect():  # 25 answers
        k, name = r["n_nationkey"], r["n_name"]
        results = [[["earlier", k + 100.5]], [[name, k + 0.25]]]
        answer = {0: name, 1: f"{k}.2500", 2: k + 100.5, 3: name.lower(), 4: k + 0.2500001}[k % 5]
        out.append((k, guard.cause_of_ungrounded(answer, results)))
    return spark.createDataFrame(out, "n_nationkey int, cause string")


@query("ledger", "SELECT n_nationkey, n_nationkey < 10 AS allowed FROM nation")
def ledger(spark, d):
    """Calls of a dollar against a limit of ten, in order of the key."""
    import tempfile

    with tempfile.TemporaryDirectory() as home:
        book = guard.Ledger(f"{home}/ledger.jsonl", 10)
        out = []
        for r in read(spark, d, "nation").orderBy("n_nationkey").select("n_nationkey").collect():  # 25 calls
            out.append((r["n_nationkey"], book.reserve(1, json.dumps(r["n_nationkey"])) is not None))
    return spark.createDataFrame(out, "n_nationkey int, allowed boolean")


# scenarios that rules must find


@query("dq_mutation_scenarios", f"WITH {DAILY} SELECT * FROM (VALUES ('a pool that the seed lacks', (SELECT sum(swaps) FROM daily WHERE pool = 'click')::BIGINT), ('a row loaded twice', 1::BIGINT), ('a pool-day twice', 1::BIGINT), ('rows after the mart was built', (SELECT count(*) FROM daily WHERE pool = 'view')::BIGINT), ('a part beyond its whole', (SELECT count(*) FROM daily WHERE pool = 'error')::BIGINT)) t(scenario, found)")
def dq_mutation_scenarios(spark, d):
    """Five corruptions of the tables, and how many rows the rule for each finds."""
    t, mart = trades(spark, d), daily(spark, d)
    first = t.orderBy("log_index").limit(1)
    fewer = mart.select("pool").distinct().filter("pool != 'click'")
    raw = mart.groupBy("pool", "day").agg(F.sum("swaps").alias("swaps"))
    grown = raw.withColumn("swaps", F.col("swaps") + F.when(F.col("pool") == "view", 1).otherwise(0))
    found = {
        "a pool that the seed lacks": quality.orphans(t, fewer, "pool"),
        "a row loaded twice": quality.unique(t.unionByName(first), "log_index"),
        "a pool-day twice": quality.unique(mart.unionByName(mart.orderBy("pool", "day").limit(1)), "pool", "day"),
        "rows after the mart was built": quality.accounts_for(raw, grown, ["pool", "day"], ["swaps"]),
        "a part beyond its whole": quality.part_of(mart.withColumn("share", F.when(F.col("pool") == "error", 1.5).otherwise(0.5)), "share"),
    }
    rows = [df.agg(F.count(F.lit(1)).alias("found")).select(F.lit(name).alias("scenario"), "found") for name, df in found.items()]
    out = rows[0]
    for one in rows[1:]:
        out = out.unionByName(one)
    return out
