"""Data-quality rules on the driver's tables, mostly with a planted defect that must come out."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import money
from ..operators import quality, roundtrips
from .analyses import PAIRS
from .marts import DAILY, daily, dim_pools
from .registry import TRADES, query, read, trades


@query("dq_unique", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def dq_unique(spark, d):
    return quality.unique(read(spark, d, "lineitem"), "l_orderkey")


@query("dq_unique_combo", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dq_unique_combo(spark, d):
    return quality.unique(read(spark, d, "lineitem"), "l_orderkey", "l_linenumber")


@query("dq_not_default", "SELECT n_nationkey FROM nation WHERE n_regionkey = 0")
def dq_not_default(spark, d):
    return quality.not_default(read(spark, d, "nation"), "n_regionkey").select("n_nationkey")


@query("dq_not_null", "SELECT event_id FROM events WHERE event_id % 500 = 3")
def dq_not_null(spark, d):
    planted = read(spark, d, "events").withColumn("value", F.when(F.col("event_id") % 500 != 3, F.col("value")))
    return quality.not_null(planted, "value").select("event_id")


@query("dq_accepted_values", "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('click', 'view', 'signup')")
def dq_accepted_values(spark, d):
    return quality.accepted(read(spark, d, "events"), "event_type", ["click", "view", "signup"]).select("event_id", "event_type")


@query("dq_denorm_match", f"WITH {DAILY} SELECT pool, day FROM daily WHERE pool = 'view' AND day = DATE '2024-01-07'")
def dq_denorm_match(spark, d):
    planted = daily(spark, d).withColumn("fee", F.when((F.col("pool") == "view") & (F.col("day") == "2024-01-07"), 123).otherwise(F.col("fee")))
    return quality.denormalized_match(planted, dim_pools(spark, d), "pool", ["fee"]).select("pool", "day")


@query("dq_orphans", "SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20)")
def dq_orphans(spark, d):
    known = read(spark, d, "customer").filter("c_nationkey < 20").select(F.col("c_custkey").alias("o_custkey"))
    return quality.orphans(read(spark, d, "orders"), known, "o_custkey").select("o_orderkey")


@query("dq_hash_form", "SELECT event_id FROM events WHERE event_id % 400 = 1 OR user_id = 0")
def dq_hash_form(spark, d):
    shown = F.concat(F.lit("0x"), F.lpad(F.lower(F.hex("user_id")), 40, "0"))
    planted = read(spark, d, "events").withColumn("a", F.when(F.col("event_id") % 400 == 1, F.concat(shown, F.lit("Z"))).otherwise(shown))
    return quality.well_formed(planted, "a", 20).select("event_id")


@query("dq_lower_case", "SELECT c_custkey FROM customer WHERE c_name <> lower(c_name)")
def dq_lower_case(spark, d):
    return quality.lower_case(read(spark, d, "customer"), "c_name").select("c_custkey")


@query("dq_label_fee", f"WITH {DAILY} SELECT DISTINCT pool FROM daily WHERE pool = 'error'")
def dq_label_fee(spark, d):
    planted = dim_pools(spark, d).withColumn("label", F.when(F.col("pool") == "error", "error 0.31%").otherwise(F.col("label")))
    return quality.label_states_fee(planted, "label", "fee").select("pool")


@query("dq_rt_definition", f"WITH {PAIRS} SELECT pool, blk, log_index, 'missing' AS problem FROM legs WHERE log_index % 5 = 0 UNION ALL SELECT pool, blk, log_index, 'not in the recomputation' FROM trades WHERE log_index = 11 AND log_index NOT IN (SELECT log_index FROM legs) UNION ALL SELECT pool, blk, log_index, 'listed twice' FROM legs WHERE log_index % 35 = 7")
def dq_rt_definition(spark, d):
    """A mart of legs with some missing, one too many and some twice, against their definition."""
    t = trades(spark, d)
    legs, keys = roundtrips.legs(t), roundtrips.KEY
    mart = legs.filter("log_index % 5 != 0").select(keys).unionByName(t.filter("log_index = 11").select(keys)).distinct()
    mart = mart.unionByName(legs.filter("log_index % 35 = 7").select(keys))
    return quality.symmetric_difference(mart, legs, keys)


@query("dq_rt_part", "SELECT 0 AS broken, 0 AS uncovered WHERE true")
def dq_rt_part(spark, d):
    """Round trips are a part of the pool-day, and every pool-day has its row."""
    t = trades(spark, d)
    rt = roundtrips.daily(t)
    broken = rt.filter("leg_trades > trades or legs_usd > volume_usd + 1e-6").agg(F.count("*").cast("int").alias("broken"))
    missing = daily(spark, d).join(rt.select("pool", "day"), ["pool", "day"], "left_anti").agg(F.count("*").cast("int").alias("uncovered"))
    return broken.crossJoin(F.broadcast(missing))  # one row


@query("dq_scale_lossless", "SELECT event_id FROM events WHERE event_id % 300 = 7")
def dq_scale_lossless(spark, d):
    raw = (F.col("event_id") * 1_000_003 + 1).cast("decimal(38,0)")
    scaled = money.scale_exact(raw, F.lit(18))
    planted = scaled + F.when(F.col("event_id") % 300 == 7, F.lit("0.000000000000000001").cast("decimal(31,18)")).otherwise(F.lit("0").cast("decimal(31,18)"))
    back = F.regexp_replace(planted.cast("decimal(31,18)").cast("string"), r"\.", "").cast("decimal(38,0)")
    return read(spark, d, "events").select("event_id", raw.alias("raw"), back.alias("back")).filter("raw != back").select("event_id")


@query("dq_smart_part", "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount * 12 > 1.000001")
def dq_smart_part(spark, d):
    rows = read(spark, d, "lineitem").withColumn("share", F.col("l_discount") * 12)
    return quality.part_of(rows, "share").select("l_orderkey", "l_linenumber", "l_discount")


@query("dq_opposite_sign", f"WITH {TRADES} SELECT log_index FROM trades WHERE log_index % 250 = 0 AND other_raw <> 0")
def dq_opposite_sign(spark, d):
    planted = trades(spark, d).withColumn("stable", F.when(F.col("log_index") % 250 == 0, F.col("other_raw")).otherwise(-F.col("other_raw")))
    return quality.opposite_signs(planted, "other_raw", "stable").select("log_index")


@query("dq_sanity_runner", "SELECT * FROM (VALUES ('unique events', 0, true), ('unique lines', 1, false), ('unknown column', -1, false)) t(rule, found, passed)")
def dq_sanity_runner(spark, d):
    """Rules run together: one holds, one is broken, one cannot run and stops nothing."""
    rules = [
        quality.Rule("unique events", "Is every event there once?", lambda: quality.unique(read(spark, d, "events"), "event_id")),
        quality.Rule("unique lines", "Is every line there once?", lambda: quality.unique(read(spark, d, "lineitem"), "l_orderkey", "l_linenumber")),
        quality.Rule("unknown column", "Does a rule that cannot run get reported?", lambda: quality.unique(read(spark, d, "events"), "no_such_column")),
    ]
    out = [(r["rule"], -1 if r["rows"] is None else min(1, r["rows"]), r["passed"]) for r in quality.run_rules(rules)]
    return spark.createDataFrame(out, "rule string, found int, passed boolean")
