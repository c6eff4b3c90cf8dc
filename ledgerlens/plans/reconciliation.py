"""Reconciliation of two volume sources, and the evidence for why they differ."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.quantiles import exact_by_rank, tercile, upper_element
from ..operators.ordered import Buckets, lag_or_self, rolling_median, with_borders
from .analyses import upper
from .marts import DAILY, daily
from .registry import TRADES, query, trades

THRESHOLDS = (25, 50, 100, 200, 500, 1000)
FLAG_REL, FLAG_ABS = 0.01, 1000.0

#: The other source: the mart, moved by a rule of the key; some days missing on either side.
OTHER = f"""{DAILY}, ours AS (SELECT * FROM daily WHERE NOT (pool = 'view' AND day = DATE '2024-01-11')),
theirs AS (SELECT pool, day, cents + (CASE WHEN day_n % 4 = 0 THEN cents // 20 WHEN day_n % 4 = 1 THEN -cents // 500 ELSE 0 END) AS ext FROM (SELECT *, date_diff('day', DATE '2024-01-01', day) AS day_n FROM daily) WHERE NOT (pool = 'click' AND day = DATE '2024-01-12')),
span AS (SELECT min(day) AS a, max(day) AS b FROM ours),
recon AS (SELECT coalesce(o.pool, t.pool) AS pool, coalesce(o.day, t.day) AS day, CASE WHEN o.pool IS NULL THEN 'only_external' WHEN t.pool IS NULL THEN 'only_ours' ELSE 'both' END AS presence,
 coalesce(o.day, t.day) IN (span.a, span.b) AS partial_day, coalesce(o.cents, 0) AS ours, coalesce(t.ext, 0) AS theirs, CASE WHEN o.pool IS NOT NULL AND t.ext <> 0 THEN (o.cents - t.ext)::DOUBLE / t.ext END AS rel
 FROM ours o FULL JOIN theirs t ON o.pool = t.pool AND o.day = t.day, span)"""


def ours(spark, d) -> DataFrame:
    return daily(spark, d).filter("not (pool = 'view' and day = date'2024-01-11')")


def theirs(spark, d) -> DataFrame:
    n = F.datediff("day", F.lit("2024-01-01")) % 4
    moved = F.when(n == 0, F.floor(F.col("cents") / 20)).when(n == 1, F.expr("-cents div 500")).otherwise(0)
    return daily(spark, d).filter("not (pool = 'click' and day = date'2024-01-12')").select("pool", "day", (F.col("cents") + moved.cast("long")).alias("ext"))


def compare(left: DataFrame, right: DataFrame) -> DataFrame:
    """Full outer comparison by pool and day: presence, partial day, difference and its share.

    ``left``: pool, day, cents; ``right``: pool, day, ext. Presence comes from flags, not from
    default values; the first and last day of the left side are partial."""
    both = left.select("pool", "day", "cents", F.lit(True).alias("in_l")).join(right.select("pool", "day", "ext", F.lit(True).alias("in_r")), ["pool", "day"], "full_outer")
    span = left.agg(F.min("day").alias("a"), F.max("day").alias("b"))
    presence = F.when(F.col("in_l").isNull(), "only_external").when(F.col("in_r").isNull(), "only_ours").otherwise("both")
    out = both.crossJoin(F.broadcast(span))  # one row
    return out.select(
        "pool", "day", presence.alias("presence"), ((F.col("day") == F.col("a")) | (F.col("day") == F.col("b"))).alias("partial_day"),
        F.coalesce("cents", F.lit(0)).alias("ours"), F.coalesce("ext", F.lit(0)).alias("theirs"), F.when(F.col("in_l") & F.col("in_r"), F.try_divide((F.col("cents") - F.col("ext")).cast("double"), F.col("ext").cast("double"))).alias("rel"),
    )


def recon(spark, d) -> DataFrame:
    return compare(ours(spark, d), theirs(spark, d))


@query("q_recompute_raw", f"WITH {TRADES} SELECT pool, day, count(*) AS swaps, sum(abs(other_raw))::BIGINT AS cents FROM trades GROUP BY 1, 2")
def q_recompute_raw(spark, d):
    """The mart's figures by other means: signs apart, no absolute value."""
    raw = F.col("other_raw")
    return trades(spark, d).groupBy("pool", "day").agg(F.count("*").alias("swaps"), (F.sum(F.greatest(raw, F.lit(0))) - F.sum(F.least(raw, F.lit(0)))).alias("cents"))


MV = f"WITH {DAILY}, raw AS (SELECT pool, day, swaps + CASE WHEN pool = 'click' AND day = DATE '2024-01-04' THEN 1 ELSE 0 END AS swaps, cents FROM daily WHERE NOT (pool = 'view' AND day = DATE '2024-01-06')) SELECT coalesce(d.pool, r.pool) AS pool, coalesce(d.day, r.day) AS day, CASE WHEN d.pool IS NULL THEN 'only in recomputation' WHEN r.pool IS NULL THEN 'only in mart' ELSE 'differs' END AS problem FROM daily d FULL JOIN raw r ON d.pool = r.pool AND d.day = r.day WHERE d.swaps IS DISTINCT FROM r.swaps OR d.cents IS DISTINCT FROM r.cents"


def _internal(spark, d):
    """The mart against a recomputation with two planted defects: only those come out."""
    from ..operators.quality import accounts_for

    raw = q_recompute_raw(spark, d).filter("not (pool = 'view' and day = date'2024-01-06')")
    planted = raw.withColumn("swaps", F.col("swaps") + F.when((F.col("pool") == "click") & (F.col("day") == "2024-01-04"), 1).otherwise(0))
    return accounts_for(daily(spark, d), planted, ["pool", "day"], ["swaps", "cents"]).select("pool", "day", "problem")


query("q_recon_a", MV)(_internal)
query("mv_compare", MV)(_internal)
query("dq_mart_accounts", MV)(_internal)


@query("q_recon_b", f"WITH {OTHER} SELECT pool, day, presence, partial_day, ours, theirs, ours - theirs AS diff, round(rel, 9) AS rel FROM recon")
def q_recon_b(spark, d):
    return recon(spark, d).select("pool", "day", "presence", "partial_day", "ours", "theirs", (F.col("ours") - F.col("theirs")).alias("diff"), F.round("rel", 9).alias("rel"))


@query("rec_exclusion", f"WITH {OTHER} SELECT pool, day, array_to_string(list_filter([CASE WHEN partial_day THEN 'partial day' END, CASE WHEN day >= DATE '2024-01-28' THEN 'open candle' END, CASE WHEN presence <> 'both' THEN presence END], lambda x: x IS NOT NULL), ',') AS reasons FROM recon")
def rec_exclusion(spark, d):
    reasons = F.array_compact(F.array(F.when(F.col("partial_day"), "partial day"), F.when(F.col("day") >= "2024-01-28", "open candle"), F.when(F.col("presence") != "both", F.col("presence"))))
    return recon(spark, d).select("pool", "day", F.array_join(reasons, ",").alias("reasons"))


def flag(rows: DataFrame) -> DataFrame:
    """flagged if beyond both limits, strictly; below absolute if only beyond the relative one."""
    rel, size = F.abs("rel") > FLAG_REL, F.abs(F.col("ours") - F.col("theirs")) > FLAG_ABS
    return rows.withColumn("flag", F.when(rel & size, "flagged").when(rel, "below absolute").when(F.col("rel").isNotNull(), "within"))


FLAG = f"flags AS (SELECT *, CASE WHEN abs(rel) > {FLAG_REL} AND abs(ours - theirs) > {FLAG_ABS} THEN 'flagged' WHEN abs(rel) > {FLAG_REL} THEN 'below absolute' WHEN rel IS NOT NULL THEN 'within' END AS flag FROM recon)"


@query("rec_flag", f"WITH {OTHER}, {FLAG} SELECT pool, day, flag FROM flags")
def rec_flag(spark, d):
    return flag(recon(spark, d)).select("pool", "day", "flag")


@query("rec_pool_summary", f"WITH {OTHER}, {FLAG} SELECT pool, sum(ours)::BIGINT AS ours, sum(theirs)::BIGINT AS theirs, round(sum(ours)::DOUBLE / sum(theirs) - 1, 9) AS total_rel, round(median(rel), 9) AS median_rel, round(max(abs(rel)), 9) AS max_abs_rel, count(*) FILTER (flag = 'flagged') AS flagged, count(rel) AS days FROM flags WHERE presence = 'both' GROUP BY pool")
def rec_pool_summary(spark, d):
    return flag(recon(spark, d)).filter("presence = 'both'").groupBy("pool").agg(
        F.sum("ours").alias("ours"), F.sum("theirs").alias("theirs"), F.round(F.sum("ours").cast("double") / F.sum("theirs") - 1, 9).alias("total_rel"), F.round(F.median("rel"), 9).alias("median_rel"),
        F.round(F.max(F.abs("rel")), 9).alias("max_abs_rel"), F.count_if(F.col("flag") == "flagged").alias("flagged"), F.count("rel").alias("days"),
    )


@query("rec_quantiles5", f"WITH {OTHER}, s AS (SELECT pool, list_sort(list(ours)) AS v, count(*) AS n FROM recon GROUP BY pool) SELECT pool, v[1] AS q0, v[CAST(floor(0.25 * (n - 1) + 0.5) AS BIGINT) + 1] AS q25, v[CAST(floor(0.5 * (n - 1) + 0.5) AS BIGINT) + 1] AS q50, v[CAST(floor(0.75 * (n - 1) + 0.5) AS BIGINT) + 1] AS q75, v[n] AS q100 FROM s")
def rec_quantiles5(spark, d):
    from ..functions.quantiles import nearest_index

    held = F.collect_list("ours")
    return recon(spark, d).groupBy("pool").agg(*[nearest_index(held, q).alias(f"q{int(100 * q)}") for q in (0, 0.25, 0.5, 0.75, 1)])


@query("rec_activity_tercile", f"WITH {DAILY}, r AS (SELECT *, row_number() OVER (PARTITION BY pool ORDER BY swaps, day) AS place, count(*) OVER (PARTITION BY pool) AS n FROM daily) SELECT pool, day, CASE WHEN place <= n // 3 THEN 0 WHEN place <= 2 * (n // 3) THEN 1 ELSE 2 END AS third FROM r")
def rec_activity_tercile(spark, d):
    place, n = F.row_number().over(Window.partitionBy("pool").orderBy("swaps", "day")), F.count("*").over(Window.partitionBy("pool"))
    return daily(spark, d).withColumn("place", place).withColumn("n", n).select("pool", "day", tercile(F.col("place"), F.col("n")).alias("third"))


@query("rec_pair_sum", f"WITH {OTHER}, p AS (SELECT day, count(*) AS members, sum(ours)::BIGINT AS ours, sum(theirs)::BIGINT AS theirs, max(abs(rel)) AS worst FROM recon WHERE presence = 'both' AND pool IN ('click', 'view') GROUP BY day) SELECT day, ours, theirs, worst > 0.01 AND abs(ours::DOUBLE / theirs - 1) <= 0.02 AS cancels FROM p WHERE members = 2")
def rec_pair_sum(spark, d):
    """Pools of one pair, summed on days on which every member is compared."""
    p = recon(spark, d).filter("presence = 'both' and pool in ('click', 'view')").groupBy("day").agg(F.count("*").alias("members"), F.sum("ours").alias("ours"), F.sum("theirs").alias("theirs"), F.max(F.abs("rel")).alias("worst"))
    return p.filter("members = 2").select("day", "ours", "theirs", ((F.col("worst") > 0.01) & (F.abs(F.col("ours").cast("double") / F.col("theirs") - 1) <= 0.02)).alias("cancels"))


@query("rec_same_day", f"WITH {OTHER} SELECT day, round(max(rel) FILTER (pool = 'click'), 9) AS click, round(max(rel) FILTER (pool = 'view'), 9) AS view, count(*) FILTER (rel > 0.01) >= 3 OR count(*) FILTER (rel < -0.01) >= 3 AS together FROM recon GROUP BY day")
def rec_same_day(spark, d):
    of = lambda p: F.round(F.max(F.when(F.col("pool") == p, F.col("rel"))), 9).alias(p)
    return recon(spark, d).groupBy("day").agg(of("click"), of("view"), ((F.count_if(F.col("rel") > 0.01) >= 3) | (F.count_if(F.col("rel") < -0.01) >= 3)).alias("together"))


@query("rec_siblings", f"WITH {OTHER}, {FLAG} SELECT a.pool, a.day, round(b.rel, 9) AS sibling_rel FROM flags a JOIN flags b ON a.day = b.day AND a.pool IN ('click', 'view') AND b.pool IN ('click', 'view') AND a.pool <> b.pool WHERE a.flag = 'flagged'")
def rec_siblings(spark, d):
    rows = flag(recon(spark, d)).filter("pool in ('click', 'view')")
    other = rows.select("day", F.col("pool").alias("sibling"), F.round("rel", 9).alias("sibling_rel"))
    return rows.filter("flag = 'flagged'").join(other, "day").filter("pool != sibling").select("pool", "day", "sibling_rel")


@query("q_day_boundary", f"""WITH {OTHER}, s AS (SELECT unnest(generate_series(-12, 12)) AS shift), cut AS (SELECT shift, pool, CAST(ts + shift * INTERVAL 1 HOUR AS DATE) AS day, sum(abs(other_raw)) AS cents FROM trades, s GROUP BY ALL)
SELECT CAST(shift AS INT) AS shift, pool, count(*) AS days, sum(abs(c.cents - t.ext))::BIGINT AS abs_diff, round(sum(abs(c.cents - t.ext))::DOUBLE / sum(t.ext), 9) AS over_external FROM cut c JOIN theirs t USING (pool, day) WHERE day BETWEEN DATE '2024-01-02' AND DATE '2024-01-28' GROUP BY shift, pool""")
def q_day_boundary(spark, d):
    """All 25 cuts of the day in one plan: trades are first summed by hour, so that the shifts
    multiply hours and not trades."""
    hourly = trades(spark, d).groupBy("pool", F.date_trunc("hour", "ts").alias("hour")).agg(F.sum(F.abs("other_raw")).alias("cents"))
    shifts = hourly.withColumn("shift", F.explode(F.sequence(F.lit(-12), F.lit(12))))
    cut = shifts.groupBy("shift", "pool", F.to_date(F.expr("hour + make_dt_interval(0, shift, 0, 0)")).alias("day")).agg(F.sum("cents").alias("cents"))
    both = cut.join(theirs(spark, d), ["pool", "day"]).filter(F.col("day").between("2024-01-02", "2024-01-28")).withColumn("off", F.abs(F.col("cents") - F.col("ext")))
    return both.groupBy("shift", "pool").agg(F.count("*").alias("days"), F.sum("off").alias("abs_diff"), F.round(F.sum("off").cast("double") / F.sum("ext"), 9).alias("over_external"))


@query("q_leg_valuation", f"WITH {TRADES}, v AS (SELECT pool, abs(other_raw) > 40000 AS limited, round((abs(other_raw) + log_index % 7)::DOUBLE / abs(other_raw) - 1, 9) AS off, abs(other_raw) AS a, abs(other_raw) + log_index % 7 AS b FROM trades WHERE other_raw <> 0) SELECT pool, count(*) FILTER (NOT limited) AS swaps, count(*) FILTER (limited) AS at_limit, round(sum(b) FILTER (NOT limited)::DOUBLE / sum(a) FILTER (NOT limited) - 1, 9) AS total_off, {upper('CASE WHEN NOT limited THEN off END', 0.01)} AS p01, {upper('CASE WHEN NOT limited THEN off END', 0.5)} AS p50, {upper('CASE WHEN NOT limited THEN off END', 0.99)} AS p99 FROM v GROUP BY pool")
def q_leg_valuation(spark, d):
    a, b = F.abs("other_raw"), F.abs("other_raw") + F.col("log_index") % 7
    v = trades(spark, d).filter("other_raw != 0").select("pool", (a > 40000).alias("limited"), F.round(b.cast("double") / a - 1, 9).alias("off"), a.alias("a"), b.alias("b"))
    free = ~F.col("limited")
    sums = v.groupBy("pool").agg(F.count_if(free).alias("swaps"), F.count_if("limited").alias("at_limit"), F.round(F.sum(F.when(free, F.col("b"))).cast("double") / F.sum(F.when(free, F.col("a"))) - 1, 9).alias("total_off"))
    return sums.join(exact_by_rank(v.filter(free), ["pool"], "off", {"p01": 0.01, "p50": 0.5, "p99": 0.99}), "pool")


@query("q_zero_leg", f"WITH {TRADES} SELECT pool, count(*) AS swaps, count(*) FILTER (other_raw = 0 OR log_index % 50 = 0) AS zero_leg, coalesce(sum(abs(other_raw)) FILTER (log_index % 50 = 0), 0)::BIGINT AS zero_cents FROM trades GROUP BY pool")
def q_zero_leg(spark, d):
    empty = F.col("log_index") % 50 == 0
    return trades(spark, d).groupBy("pool").agg(F.count("*").alias("swaps"), F.count_if((F.col("other_raw") == 0) | empty).alias("zero_leg"), F.coalesce(F.sum(F.when(empty, F.abs("other_raw"))), F.lit(0)).alias("zero_cents"))


@query("q_single_swap", f"""WITH {TRADES}, s AS (SELECT *, TIMESTAMP '2024-01-10' AS a, TIMESTAMP '2024-01-11' AS b FROM trades WHERE pool = 'click' AND ts >= TIMESTAMP '2024-01-10' - INTERVAL 120 MINUTE AND ts < TIMESTAMP '2024-01-11' + INTERVAL 120 MINUTE),
o AS (SELECT count(*) AS day_swaps, {upper('abs(other_raw)', 0.5)} AS day_median FROM s WHERE ts >= a AND ts < b)
SELECT log_index, round(abs(other_raw)::DOUBLE / 1500 - 1, 9) AS off, CASE WHEN ts < a THEN 'before the day' WHEN ts >= b THEN 'after the day' WHEN ts < a + INTERVAL 120 MINUTE THEN 'first minutes' WHEN ts >= b - INTERVAL 120 MINUTE THEN 'last minutes' ELSE '' END AS place, day_swaps, day_median FROM s, o WHERE abs(other_raw) BETWEEN 1500 * 0.5 AND 1500 * 1.5""")
def q_single_swap(spark, d):
    """Trades near a target size around one day, with where in the day they lie."""
    start, end, margin = (F.expr(x) for x in ("timestamp'2024-01-10'", "timestamp'2024-01-11'", "interval 120 minutes"))
    t = F.col("ts")
    near = trades(spark, d).filter((F.col("pool") == "click") & (t >= start - margin) & (t < end + margin)).withColumn("size", F.abs("other_raw"))
    of_day = near.filter((t >= start) & (t < end)).agg(F.count("*").alias("day_swaps"), upper_element(F.collect_list("size"), 0.5).alias("day_median"))  # one pool, one day
    place = F.when(t < start, "before the day").when(t >= end, "after the day").when(t < start + margin, "first minutes").when(t >= end - margin, "last minutes").otherwise("")
    kept = near.filter(F.col("size").between(750, 2250)).crossJoin(F.broadcast(of_day))  # one row
    return kept.select("log_index", F.round(F.col("size").cast("double") / 1500 - 1, 9).alias("off"), place.alias("place"), "day_swaps", "day_median")


def displaced(rows: DataFrame, bucket: str = "day", around: int = 10) -> DataFrame:
    """Each trade with its reference (median tick of the trades around it) and displacement: how
    far it began or ended from that. ``rows``: pool, pos (unique order), bucket, tick.

    Medians are taken in chunks of neighbouring trades with borrowed borders, so the largest pool
    spreads over tasks."""
    chunks = with_borders(Buckets(rows, ["pool"], "pos", bucket), around)
    w = Window.partitionBy("pool", "chunk").orderBy("pos")
    found = chunks.withColumn("reference", rolling_median(F.col("tick"), w, around)).withColumn("start_tick", lag_or_self(F.col("tick"), w)).filter("own").drop("own", "chunk")
    return found.withColumn("displacement", F.greatest(F.abs(F.col("start_tick") - F.col("reference")), F.abs(F.col("tick") - F.col("reference"))))


def displaced_trades(spark, d) -> DataFrame:
    t = trades(spark, d).withColumn("pos", F.col("log_index")).withColumn("tick", F.abs("other_raw"))
    return displaced(t).withColumn("at_reference", F.col("tick") + F.col("reference"))


DISPLACED = f"""{TRADES}, w AS (SELECT *, abs(other_raw) AS tick, lag(abs(other_raw), 1, abs(other_raw)) OVER (PARTITION BY pool ORDER BY log_index) AS start_tick, list(abs(other_raw)) OVER (PARTITION BY pool ORDER BY log_index ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING) AS h FROM trades),
m AS (SELECT *, list_sort(h)[len(h) // 2 + 1] AS reference FROM w), disp AS (SELECT *, greatest(abs(start_tick - reference), abs(tick - reference)) AS displacement, tick + reference AS at_reference FROM m)"""


@query("q_displaced", f"WITH {DISPLACED} SELECT pool, day, count(*) AS swaps, sum(tick)::BIGINT AS volume, sum(at_reference)::BIGINT AS at_reference, [{', '.join(f'count(*) FILTER (displacement > {n})' for n in THRESHOLDS)}] AS displaced_swaps, [{', '.join(f'coalesce(sum(tick) FILTER (displacement > {n}), 0)::BIGINT' for n in THRESHOLDS)}] AS displaced_volume FROM disp GROUP BY pool, day")
def q_displaced(spark, d):
    beyond = lambda n: F.col("displacement") > n
    return displaced_trades(spark, d).groupBy("pool", "day").agg(
        F.count("*").alias("swaps"), F.sum("tick").alias("volume"), F.sum("at_reference").alias("at_reference"),
        F.array(*[F.count_if(beyond(n)) for n in THRESHOLDS]).alias("displaced_swaps"), F.array(*[F.coalesce(F.sum(F.when(beyond(n), F.col("tick"))), F.lit(0)) for n in THRESHOLDS]).alias("displaced_volume"),
    )


@query("q_displ_dist", f"WITH {DISPLACED} SELECT pool, {upper('displacement', 0.5)} AS p50, {upper('displacement', 0.9)} AS p90, {upper('displacement', 0.99)} AS p99, max(displacement) AS largest FROM disp GROUP BY pool")
def q_displ_dist(spark, d):
    x = displaced_trades(spark, d)
    return x.groupBy("pool").agg(F.max("displacement").alias("largest")).join(exact_by_rank(x, ["pool"], "displacement", {"p50": 0.5, "p90": 0.9, "p99": 0.99}), "pool")


def placebo(rows: DataFrame, threshold: int, seeds: list[int], pick=None) -> DataFrame:
    """Change in volume if displaced trades count at reference, and if as many others, picked by
    a seeded hash, do. ``rows``: pool, day, pos, tick, at_reference, displacement."""
    pick = pick or (lambda seed, pos: F.xxhash64(seed, pos))
    flagged = rows.withColumn("off", F.col("displacement") > threshold).withColumn("change", F.col("at_reference") - F.col("tick"))
    k = F.count_if("off").over(Window.partitionBy("pool", "day"))
    seeded = flagged.withColumn("k", k).withColumn("seed", F.explode(F.array(*[F.lit(s) for s in seeds])))
    place = F.row_number().over(Window.partitionBy("pool", "day", "seed", "off").orderBy(pick(F.col("seed"), F.col("pos")), "pos"))
    chosen = ~F.col("off") & (F.col("place") <= F.col("k"))
    sum_if = lambda c: F.coalesce(F.sum(F.when(c, F.col("change"))), F.lit(0))
    return seeded.withColumn("place", place).groupBy("pool", "day", "seed").agg(F.max("k").alias("displaced_swaps"), F.sum("change").alias("delta_all"), sum_if(F.col("off")).alias("delta_displaced"), sum_if(chosen).alias("delta_placebo"), F.count_if(chosen).alias("placebo_swaps"))


PLACEBO = f"""WITH {DISPLACED}, s AS (SELECT unnest([1, 2, 3]) AS seed), r AS (SELECT *, displacement > 200 AS off_, at_reference - tick AS change FROM disp),
k AS (SELECT r.*, s.seed, count(*) FILTER (off_) OVER (PARTITION BY pool, day, seed) AS k, row_number() OVER (PARTITION BY pool, day, seed, off_ ORDER BY md5(seed || '-' || log_index), log_index) AS place FROM r, s)
SELECT pool, day, seed, max(k)::BIGINT AS displaced_swaps, sum(change)::BIGINT AS delta_all, coalesce(sum(change) FILTER (off_), 0)::BIGINT AS delta_displaced, coalesce(sum(change) FILTER (NOT off_ AND place <= k), 0)::BIGINT AS delta_placebo, count(*) FILTER (NOT off_ AND place <= k) AS placebo_swaps FROM k GROUP BY pool, day, seed"""


def _md5_pick(seed, pos):
    return F.md5(F.concat(seed.cast("string"), F.lit("-"), pos.cast("string")).cast("binary"))


@query("q_placebo", PLACEBO)
def q_placebo(spark, d):
    return placebo(displaced_trades(spark, d), 200, [1, 2, 3], _md5_pick)


@query("h2_eval", f"WITH p AS ({PLACEBO}), t AS (SELECT seed, day < DATE '2024-01-20' AS in_sample, sum(delta_placebo) AS x FROM p GROUP BY ALL) SELECT in_sample, min(x)::BIGINT AS low, median(x)::DOUBLE AS middle, max(x)::BIGINT AS high FROM t GROUP BY in_sample")
def h2_eval(spark, d):
    """Spread of the placebo over seeds, in the sample and held out: all seeds in one plan."""
    per = placebo(displaced_trades(spark, d), 200, [1, 2, 3], _md5_pick).groupBy("seed", (F.col("day") < "2024-01-20").alias("in_sample")).agg(F.sum("delta_placebo").alias("x"))
    return per.groupBy("in_sample").agg(F.min("x").alias("low"), F.median("x").alias("middle"), F.max("x").alias("high"))


def what_if(rows: DataFrame, limit: float = FLAG_REL) -> DataFrame:
    """Days that a substituted volume would fix or break, by sign. ``rows``: rel, new_rel."""
    was, now = F.abs("rel") > limit, F.abs("new_rel") > limit
    return rows.agg(F.count_if(was & ~now & (F.col("rel") > 0)).alias("fixed_plus"), F.count_if(was & ~now & (F.col("rel") < 0)).alias("fixed_minus"), F.count_if(~was & now).alias("broken"))


WHATIF = f"{OTHER}, adj AS (SELECT rel, (ours * 0.96 - theirs) / theirs AS new_rel FROM recon WHERE presence = 'both')"


@query("rec_whatif", f"WITH {WHATIF} SELECT count(*) FILTER (abs(rel) > 0.01 AND abs(new_rel) <= 0.01 AND rel > 0) AS fixed_plus, count(*) FILTER (abs(rel) > 0.01 AND abs(new_rel) <= 0.01 AND rel < 0) AS fixed_minus, count(*) FILTER (abs(rel) <= 0.01 AND abs(new_rel) > 0.01) AS broken FROM adj")
def rec_whatif(spark, d):
    rows = recon(spark, d).filter("presence = 'both'").withColumn("new_rel", (F.col("ours") * F.lit(0.96) - F.col("theirs")) / F.col("theirs"))
    return what_if(rows)


def pearson(df: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """Correlation of groups of at least three pairs; null where a side does not vary."""
    held = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(*keys).agg(F.count("*").alias("n"), correlation(a, b).alias("r"))
    return held.select(*keys, "n", F.when(F.col("n") >= 3, F.col("r")).alias("r"))


def correlation(a: str, b: str):
    """As ``corr``, which raises under ANSI rules where a side does not vary; null there."""
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


@query("rec_pearson", f"WITH {OTHER} SELECT pool, count(*) AS n, round(corr(ours::DOUBLE, theirs::DOUBLE), 9) AS r FROM recon WHERE presence = 'both' GROUP BY pool")
def rec_pearson(spark, d):
    rows = recon(spark, d).filter("presence = 'both'").select("pool", F.col("ours").cast("double").alias("a"), F.col("theirs").cast("double").alias("b"))
    return pearson(rows, ["pool"], "a", "b").withColumn("r", F.round("r", 9))


H12 = f"""WITH {DISPLACED}, th AS (SELECT unnest([25, 50, 100, 200, 500, 1000]) AS threshold), v AS (SELECT threshold, pool, day, sum(tick) AS volume, sum(CASE WHEN displacement > threshold THEN 0 ELSE tick END) AS left_out, sum(CASE WHEN displacement > threshold THEN reference ELSE tick END) AS at_ref FROM disp, th GROUP BY ALL)
SELECT threshold, CASE WHEN stddev_pop(left_out::DOUBLE / volume) > 0 AND stddev_pop(at_ref::DOUBLE / volume) > 0 THEN round(corr(left_out::DOUBLE / volume, at_ref::DOUBLE / volume), 6) END AS r, round(avg(left_out::DOUBLE / volume), 9) AS h1, round(avg(at_ref::DOUBLE / volume), 9) AS h2 FROM v WHERE volume > 0 GROUP BY threshold"""


@query("rec_h1_h2", H12)
def rec_h1_h2(spark, d):
    """Both hypotheses at all thresholds in one plan: leave displaced trades out, or count them at
    reference."""
    x = displaced_trades(spark, d).withColumn("threshold", F.explode(F.array(*[F.lit(n) for n in THRESHOLDS])))
    off = F.col("displacement") > F.col("threshold")
    v = x.groupBy("threshold", "pool", "day").agg(F.sum("tick").alias("volume"), F.sum(F.when(off, 0).otherwise(F.col("tick"))).alias("o"), F.sum(F.when(off, F.col("reference")).otherwise(F.col("tick"))).alias("a")).filter("volume > 0")
    v = v.select("threshold", (F.col("o") / F.col("volume")).alias("h1"), (F.col("a") / F.col("volume")).alias("h2"))
    return v.groupBy("threshold").agg(F.round(correlation("h1", "h2"), 6).alias("r"), F.round(F.avg("h1"), 9).alias("h1"), F.round(F.avg("h2"), 9).alias("h2"))


HOURS = f"""{TRADES}, o AS (SELECT hour(ts) AS h, count(*) AS n, sum(abs(other_raw)) AS c FROM trades WHERE pool = 'click' AND day = DATE '2024-01-10' GROUP BY 1), t AS (SELECT hour(ts) AS h, sum(abs(other_raw)) + 50 AS c FROM trades WHERE pool = 'click' AND day = DATE '2024-01-10' AND hour(ts) <> 5 GROUP BY 1),
hours AS (SELECT CAST(coalesce(o.h, t.h) AS INT) AS hour, coalesce(o.n, 0) AS swaps, coalesce(o.c, 0)::BIGINT AS ours, coalesce(t.c, 0)::BIGINT AS theirs, (coalesce(o.c, 0) - coalesce(t.c, 0))::BIGINT AS diff FROM o FULL JOIN t ON o.h = t.h)"""


def hourly(spark, d) -> DataFrame:
    t = trades(spark, d).filter("pool = 'click' and day = date'2024-01-10'").groupBy(F.hour("ts").alias("hour")).agg(F.count("*").alias("swaps"), F.sum(F.abs("other_raw")).alias("ours"))
    other = t.filter("hour != 5").select("hour", (F.col("ours") + 50).alias("theirs"))
    return t.join(other, "hour", "full_outer").fillna(0, ["swaps", "ours", "theirs"]).withColumn("diff", F.col("ours") - F.col("theirs"))


@query("q_hourly", f"WITH {HOURS} SELECT * FROM hours")
def q_hourly(spark, d):
    return hourly(spark, d)


@query("rec_top3_hours", f"WITH {HOURS} SELECT hour, diff, round(diff::DOUBLE / (SELECT sum(diff) FROM hours), 9) AS share FROM hours ORDER BY abs(diff) DESC, hour LIMIT 3")
def rec_top3_hours(spark, d):
    rows = hourly(spark, d)
    whole = rows.agg(F.sum("diff").alias("whole"))
    return rows.orderBy(F.abs("diff").desc(), "hour").limit(3).crossJoin(F.broadcast(whole)).select("hour", "diff", F.round(F.try_divide(F.col("diff").cast("double"), F.col("whole").cast("double")), 9).alias("share"))  # one row


@query("q_rt_evidence", f"""WITH {TRADES}, s AS (SELECT *, lag(abs(other_raw), 1, abs(other_raw)) OVER (ORDER BY log_index) AS before FROM trades WHERE pool = 'click' AND day BETWEEN DATE '2024-01-02' AND DATE '2024-01-25')
SELECT a.log_index AS first_log, b.log_index AS second_log, a.tx = b.tx AS same_tx, a.before AS first_before, b.before AS second_before, a.other_raw + b.other_raw AS net, (SELECT count(*) FROM s x WHERE x.blk = a.blk AND x.log_index > a.log_index AND x.log_index < b.log_index AND x.sender <> a.sender) AS others
FROM s a JOIN s b ON a.blk = b.blk AND a.sender = b.sender AND b.log_index > a.log_index AND sign(a.other_raw) <> sign(b.other_raw) WHERE abs((a.other_raw + b.other_raw)::DOUBLE) <= 0.1 * abs(a.other_raw) ORDER BY abs(a.other_raw) DESC, a.log_index, b.log_index LIMIT 10""")
def q_rt_evidence(spark, d):
    """The largest round trips of a pool's days, with what was around them."""
    from ..operators import roundtrips

    day = trades(spark, d).filter((F.col("pool") == "click") & F.col("day").between("2024-01-02", "2024-01-25"))
    step = Buckets(day.withColumn("size", F.abs("other_raw")), ["pool"], "log_index", "day").last_before({"before": F.col("size")}).df
    s = step.withColumn("before", F.coalesce("before", "size"))
    found = roundtrips.pairs(day)
    side = lambda p: s.select("pool", F.col("log_index").alias(f"{p}_log"), F.col("before").alias(f"{p}_before"), F.col("other_raw").alias(f"{p}_raw"))
    both = found.join(side("first"), ["pool", "first_log"]).join(side("second"), ["pool", "second_log"])
    top = both.orderBy(F.abs("first_raw").desc(), "first_log", "second_log").limit(10)
    others = day.select("blk", F.col("log_index").alias("o"), F.col("sender").alias("os"))
    counted = top.join(others, "blk").filter("o > first_log and o < second_log and os != sender").groupBy("first_log", "second_log").agg(F.count("*").alias("others"))
    return top.join(counted, ["first_log", "second_log"], "left").select("first_log", "second_log", F.col("one_tx").alias("same_tx"), "first_before", "second_before", (F.col("first_raw") + F.col("second_raw")).alias("net"), F.coalesce("others", F.lit(0)).alias("others"))
