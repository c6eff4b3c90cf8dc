"""Questions that a reader asks of the daily marts, each as one SQL text.

``{daily}`` is the daily mart (pool, day, fee, swaps, cents, usd), ``{rt}`` the round trips by
pool and day. The text is plain SQL; where two engines name a function differently, the second
text is Spark's. Marts have a row for each pool and day, so all of this is small.
"""

from __future__ import annotations

from .analyses import q_rt_daily
from .marts import DAILY, daily
from .registry import ORACLE, query

A, B, C = "DATE '2024-01-03'", "DATE '2024-01-10'", "DATE '2024-01-24'"
WEEK1 = "BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'"
WEEK2 = "BETWEEN DATE '2024-01-15' AND DATE '2024-01-21'"
EARLY = "BETWEEN DATE '2024-01-01' AND DATE '2024-01-15'"
LATE = "BETWEEN DATE '2024-01-16' AND DATE '2024-01-30'"
PAIR = "('click', 'view')"
CLICK, VIEW = "pool = 'click'", "pool = 'view'"
EITHER = "CASE WHEN pool = 'click' THEN cents ELSE swaps * 100 END"
LAST = "(SELECT max(day) FROM {daily})"
FIRST = "(SELECT min(day) FROM {daily})"
FEES = "sum(CAST(cents AS DOUBLE) * fee) / 1e8"


def total(of: str = "cents") -> str:
    return f"CAST(sum({of}) AS BIGINT)"


def within(period: str, of: str = "cents", also: str = "TRUE") -> str:
    """A sum over the rows of a period; 0 over none."""
    return f"sum(CASE WHEN day {period} AND {also} THEN {of} ELSE 0 END)"


#: Name: SQL, or the SQL and Spark's.
CASES: dict[str, str | tuple[str, str]] = {
    # several steps
    "larger_tier_of_week": f"SELECT pool FROM {{daily}} WHERE pool IN {PAIR} AND day {WEEK1} GROUP BY pool ORDER BY sum(cents) DESC, pool LIMIT 1",
    "share_of_pair_moved": f"SELECT round(100 * ({within(WEEK2, also=CLICK)} / {within(WEEK2)} - {within(WEEK1, also=CLICK)} / {within(WEEK1)}), 6) AS points FROM {{daily}} WHERE pool IN {PAIR}",
    "share_that_grew_most": f"SELECT pool, round(100 * (late / all_late - early / all_early), 6) AS points FROM (SELECT pool, {within(EARLY)} AS early, {within(LATE)} AS late FROM {{daily}} GROUP BY pool) p CROSS JOIN (SELECT {within(EARLY)} AS all_early, {within(LATE)} AS all_late FROM {{daily}}) w ORDER BY points DESC, pool LIMIT 1",
    "fees_of_one_over_other": f"SELECT round({within(WEEK1, 'CAST(cents AS DOUBLE) * fee', VIEW)} / 1e8 - {within(WEEK1, 'CAST(cents AS DOUBLE) * fee', CLICK)} / 1e8, 6) AS usd FROM {{daily}}",
    "larger_average_trade": f"SELECT pool FROM {{daily}} WHERE pool IN {PAIR} AND day {LATE} GROUP BY pool ORDER BY sum(cents) / sum(swaps) DESC, pool LIMIT 1",
    "days_one_led_other": f"SELECT count(*) AS days FROM {{daily}} a JOIN {{daily}} b ON a.day = b.day WHERE a.pool = 'click' AND b.pool = 'view' AND a.cents > b.cents AND a.day {LATE}",
    "best_day_of_all": "SELECT day FROM {daily} GROUP BY day ORDER BY sum(cents) DESC, day LIMIT 1",
    "pool_days_above": "SELECT count(*) AS pool_days FROM {daily} WHERE cents > 200000",
    "days_a_pool_was_first": "SELECT count(*) AS days FROM (SELECT pool, row_number() OVER (PARTITION BY day ORDER BY cents DESC, pool) AS n FROM {daily}) d WHERE n = 1 AND pool = 'view'",
    "more_swaps_than_week_before": f"SELECT CAST({within(WEEK2, 'swaps')} - {within(WEEK1, 'swaps')} AS BIGINT) AS more FROM {{daily}}",
    "days_with_more_than": "SELECT count(*) AS days FROM {daily} WHERE pool = 'click' AND swaps > 20",
    "first_day_above": "SELECT min(day) AS day FROM {daily} WHERE pool = 'view' AND cents > 200000",
    # units
    "fee_in_points": "SELECT DISTINCT CAST(fee / 100 AS DOUBLE) AS bps FROM {daily} WHERE pool = 'error'",
    "fee_as_fraction": "SELECT DISTINCT fee / 1e6 AS fraction FROM {daily} WHERE pool = 'click'",
    "volume_in_millions": f"SELECT round(sum(cents) / 1e8, 9) AS millions FROM {{daily}} WHERE day {EARLY}",
    "fees_in_millions": f"SELECT round({FEES} / 1e6, 9) AS millions FROM {{daily}} WHERE pool = 'view' AND day {EARLY}",
    "trade_in_thousands": f"SELECT round(sum(cents) / 1e5 / sum(swaps), 9) AS thousands FROM {{daily}} WHERE pool = 'click' AND day = {B}",
    "fee_of_busiest": f"SELECT CAST(max_by(fee, swaps * 100000 + fee) / 100 AS DOUBLE) AS bps FROM {{daily}} WHERE day = {A}",
    "tokens_not_dollars": f"SELECT {total('cents * 1000')} AS raw FROM {{daily}} WHERE day = {B}",
    "thousand_tokens": f"SELECT round(sum(cents) / 1e5, 9) AS thousands FROM {{daily}} WHERE pool = 'view' AND day {WEEK2}",
    "fee_of_one_trade_in_cents": f"SELECT round(100 * {FEES} / sum(swaps), 9) AS cents FROM {{daily}} WHERE pool = 'click' AND day = {C}",
    # gross and net
    "net_of_week": f"SELECT round(sum(net_usd), 3) AS usd FROM {{rt}} WHERE pool = 'click' AND day {WEEK1}",
    "gross_of_week": f"SELECT {total()} AS cents FROM {{daily}} WHERE pool = 'click' AND day {WEEK1}",
    "round_trips_of_day": f"SELECT round(coalesce(sum(legs_usd), 0), 3) AS usd FROM {{rt}} WHERE pool = 'view' AND day = {B}",
    "round_trip_percent": "SELECT round(100 * sum(legs_usd) / sum(volume_usd), 6) AS pct FROM {rt}",
    "net_of_all_on_day": f"SELECT round(sum(net_usd), 3) AS usd FROM {{rt}} WHERE day = {B}",
    "most_round_trips": f"SELECT pool FROM {{rt}} WHERE day = {A} ORDER BY share_of_usd DESC, pool LIMIT 1",
    "gross_over_net": f"SELECT round(sum(volume_usd) - sum(net_usd), 3) AS usd FROM {{rt}} WHERE pool = 'click' AND day {WEEK2}",
    "percent_of_late_period": f"SELECT round(100 * sum(legs_usd) / sum(volume_usd), 6) AS pct FROM {{rt}} WHERE day {LATE}",
    "legs_in_one_transaction": f"SELECT {total('legs_in_one_tx')} AS legs FROM {{rt}} WHERE day {LATE}",
    "days_net_far_below": "SELECT count(*) AS days FROM {rt} WHERE pool = 'view' AND net_usd < 0.99 * volume_usd",
    # edges of the data
    "swaps_on_last_day": f"SELECT {total('swaps')} AS swaps FROM {{daily}} WHERE day = {LAST}",
    "volume_on_first_day": f"SELECT {total()} AS cents FROM {{daily}} WHERE day = {FIRST}",
    "busiest_on_last_day": f"SELECT pool FROM {{daily}} WHERE day = {LAST} ORDER BY swaps DESC, pool LIMIT 1",
    "last_day_against_day_before": ("SELECT round(100.0 * sum(CASE WHEN day = m THEN cents ELSE 0 END) / sum(CASE WHEN day = m - 1 THEN cents ELSE 0 END), 6) AS pct FROM {daily} CROSS JOIN (SELECT max(day) AS m FROM {daily}) x WHERE pool = 'view'",
                                    "SELECT round(100.0D * sum(CASE WHEN day = m THEN cents ELSE 0 END) / sum(CASE WHEN day = date_sub(m, 1) THEN cents ELSE 0 END), 6) AS pct FROM {daily} CROSS JOIN (SELECT max(day) AS m FROM {daily}) x WHERE pool = 'view'"),
    "rows_on_last_day": f"SELECT count(*) AS pools FROM {{daily}} WHERE day = {LAST}",
    "pools_on_first_day": f"SELECT count(*) AS pools FROM {{daily}} WHERE day = {FIRST} AND swaps >= 1",
    "days_of_data": ("SELECT CAST(max(day) - min(day) + 1 AS BIGINT) AS days FROM {daily}", "SELECT CAST(datediff(max(day), min(day)) + 1 AS BIGINT) AS days FROM {daily}"),
    # missing rows
    "days_without_a_swap": ("SELECT CAST(max(w.days) - count(day) AS BIGINT) AS days FROM {daily} CROSS JOIN (SELECT max(day) - min(day) + 1 AS days FROM {daily}) w WHERE pool = 'signup'",
                            "SELECT CAST(max(w.days) - count(day) AS BIGINT) AS days FROM {daily} CROSS JOIN (SELECT datediff(max(day), min(day)) + 1 AS days FROM {daily}) w WHERE pool = 'signup'"),
    "swaps_of_a_day_out_of_range": "SELECT coalesce(CAST(sum(swaps) AS BIGINT), 0) AS swaps FROM {daily} WHERE pool = 'view' AND day = DATE '2023-12-31'",
    "swaps_by_calendar_day": f"SELECT round(sum(swaps) / 7e0, 6) AS each FROM {{daily}} WHERE pool = 'signup' AND day {WEEK1}",
    "pools_without_a_swap": f"SELECT CAST(max(n) - count(*) AS BIGINT) AS pools FROM {{daily}} CROSS JOIN (SELECT count(DISTINCT pool) AS n FROM {{daily}}) x WHERE day = {A}",
    "change_to_next_day": "SELECT CAST(sum(CASE WHEN day = DATE '2024-01-11' THEN cents ELSE 0 END) - sum(CASE WHEN day = DATE '2024-01-10' THEN cents ELSE 0 END) AS BIGINT) AS change FROM {daily} WHERE pool = 'error'",
    # words with more than one reading
    "average_by_day": f"SELECT round(sum(cents) / 7e0, 6) AS each FROM {{daily}} WHERE pool = 'error' AND day {WEEK1}",
    "most_active": f"SELECT pool FROM {{daily}} WHERE day {LATE} GROUP BY pool ORDER BY sum(swaps) DESC, pool LIMIT 1",
    "typical_day": (f"SELECT list_sort(list(cents))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS cents FROM {{daily}} WHERE pool = 'view' AND day {LATE}",
                    f"SELECT get(array_sort(collect_list(cents)), CAST(floor(count(*) / 2) AS INT)) AS cents FROM {{daily}} WHERE pool = 'view' AND day {LATE}"),
    "last_seven_days": ("SELECT CAST(sum(cents) AS BIGINT) AS cents FROM {daily} CROSS JOIN (SELECT max(day) AS m FROM {daily}) x WHERE pool = 'view' AND day > m - 7",
                        "SELECT CAST(sum(cents) AS BIGINT) AS cents FROM {daily} CROSS JOIN (SELECT max(day) AS m FROM {daily}) x WHERE pool = 'view' AND day > date_sub(m, 7)"),
    "fees_of_early_period": f"SELECT round({FEES}, 6) AS usd FROM {{daily}} WHERE pool = 'view' AND day {EARLY}",
    # lists in order
    "three_best_days": "SELECT day FROM {daily} WHERE pool = 'view' ORDER BY cents DESC, day LIMIT 3",
    "three_busiest_days": "SELECT day FROM {daily} GROUP BY day ORDER BY sum(swaps) DESC, day LIMIT 3",
    "two_busiest_pools": f"SELECT pool FROM {{daily}} WHERE day = {B} ORDER BY swaps DESC, pool LIMIT 2",
    "busiest_days_of_pool": "SELECT day FROM {daily} WHERE pool = 'signup' ORDER BY swaps DESC, day LIMIT 3",
    # names
    "both_tiers_of_pair": f"SELECT {total()} AS cents FROM {{daily}} WHERE pool IN {PAIR} AND day = {B}",
    "tiers_of_pair": f"SELECT count(DISTINCT fee) AS tiers FROM {{daily}} WHERE pool IN {PAIR}",
    "name_in_other_case": "SELECT CAST(sum(swaps) AS BIGINT) AS swaps FROM {daily} WHERE lower(pool) = lower('VIEW')",
    # dates
    "weekday_of_best_day": ("SELECT dayname(max_by(day, cents)) AS weekday FROM {daily} WHERE pool = 'view'", "SELECT date_format(max_by(day, cents), 'EEEE') AS weekday FROM {daily} WHERE pool = 'view'"),
    "weekends": ("SELECT CAST(sum(cents) AS BIGINT) AS cents FROM {daily} WHERE isodow(day) >= 6", "SELECT CAST(sum(cents) AS BIGINT) AS cents FROM {daily} WHERE weekday(day) >= 5"),
    "days_until_above": (f"SELECT CAST(min(day) - {A} AS BIGINT) AS days FROM {{daily}} WHERE pool = 'click' AND cents > 200000 AND day >= {A}", f"SELECT CAST(datediff(min(day), {A}) AS BIGINT) AS days FROM {{daily}} WHERE pool = 'click' AND cents > 200000 AND day >= {A}"),
    "calendar_week": f"SELECT {total('swaps')} AS swaps FROM {{daily}} WHERE day {WEEK1}",
    "best_week": "SELECT CAST(date_trunc('week', day) AS DATE) AS monday FROM {daily} WHERE day <= DATE '2024-01-28' GROUP BY 1 ORDER BY sum(cents) DESC, 1 LIMIT 1",
    # periods compared
    "swaps_changed_percent": f"SELECT round(100.0 * ({within(WEEK2, 'swaps')} / {within(WEEK1, 'swaps')} - 1), 6) AS pct FROM {{daily}}",
    "times_more_swaps": f"SELECT round(CAST(sum(CASE WHEN pool = 'click' THEN swaps ELSE 0 END) AS DOUBLE) / sum(CASE WHEN pool = 'view' THEN swaps ELSE 0 END), 6) AS times FROM {{daily}} WHERE day {LATE}",
    "pool_that_grew_most": f"SELECT pool FROM (SELECT pool, {within(WEEK1)} AS a, {within(WEEK2)} AS b FROM {{daily}} GROUP BY pool) s WHERE a > 0 ORDER BY b / a DESC, pool LIMIT 1",
    "average_trade_changed": f"SELECT round(100 * (({within(LATE)} / {within(LATE, 'swaps')}) / ({within(EARLY)} / {within(EARLY, 'swaps')}) - 1), 6) AS pct FROM {{daily}} WHERE pool = 'view'",
    "days_above_day_before": "SELECT count(*) AS days FROM (SELECT c > lag(c) OVER (ORDER BY day) AS up FROM (SELECT day, sum(cents) AS c FROM {daily} GROUP BY day) s) u WHERE up",
    # token amounts the right way round
    "token_direction_inverse": f"SELECT pool, round(CASE WHEN pool IN {PAIR} THEN swaps / usd ELSE usd / swaps END, 9) AS inverse FROM {{daily}} WHERE day = {B} AND usd > 0",
    "token_direction_amount": f"SELECT {total(EITHER)} AS amount FROM {{daily}} WHERE pool IN {PAIR} AND day {WEEK1}",
}


def _plan(text: str):
    def run(spark, d):
        marts = {"daily": lambda: daily(spark, d), "rt": lambda: q_rt_daily(spark, d)}
        return spark.sql(text, **{name: make() for name, make in marts.items() if f"{{{name}}}" in text})

    return run


for _name, _case in CASES.items():
    _sql, _spark = (_case, _case) if isinstance(_case, str) else _case
    _rt = f", rt AS ({ORACLE['q_rt_daily']})" if "{rt}" in _sql else ""
    query(f"q_hand_{_name}", f"WITH {DAILY}{_rt} {_sql.replace('{daily}', 'daily').replace('{rt}', 'rt')}")(_plan(_spark))
