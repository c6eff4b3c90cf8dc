"""What plans and controls an ingest, reports, and proofs that rules can fail."""

from __future__ import annotations

import csv
import datetime
import io
import re

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ..operators import evaluation as ev
from ..operators import quality
from ..sources import reports, rpc
from .evaluation import RUNS, runs
from .marts import DAILY, daily
from .registry import query, read, scratch


@query("src_rpc_logs", "SELECT b AS block FROM (SELECT unnest(generate_series(10, 250)) AS b) WHERE b % 3 = 0")
def src_rpc_logs(spark, d):
    """The data source over a transport without a network; a partition for each range."""
    spark.dataSource.register(rpc.LogSource)
    rows = spark.read.format("rpc_logs").options(start="10", stop="250", size="10", transport="ledgerlens.sources.rpc:SampleTransport").load()
    return rows.select(F.conv(F.substring("blockNumber", 3, 16), 16, 10).cast("long").alias("block"))


@query("src_safe_head", "SELECT 100 AS finalized, 136 AS behind_tip")
def src_safe_head(spark, d):
    with_tag = rpc.Client(lambda m, p: {"number": "0x64"} if m == "eth_getBlockByNumber" else "0xc8")
    without = rpc.Client(lambda m, p: None if m == "eth_getBlockByNumber" else "0xc8")
    return spark.createDataFrame([(rpc.safe_head(with_tag), rpc.safe_head(without))], "finalized int, behind_tip int")


@query("src_window_resume", "SELECT 15 AS first, 20 AS last")
def src_window_resume(spark, d):
    return spark.createDataFrame([rpc.window_left(10, 20, [(10, 12), (13, 14)])], "first int, last int")


@query("src_error_budget", "SELECT true AS over, false AS early")
def src_error_budget(spark, d):
    over, early = rpc.Client(None), rpc.Client(None)
    over.requests, over.repeated, early.requests, early.repeated = 300, 100, 100, 90
    return spark.createDataFrame([(over.over_budget(), early.over_budget())], "over boolean, early boolean")


#: Rows of a row group of the table of logs: what a task of the backfill holds at once.
LOG_ROWS = 20_000


@query("src_backfill", "SELECT event_id // 1000 * 1000 AS start, count(*) AS delivered, sum(event_id)::BIGINT AS ids FROM events GROUP BY 1")
def src_backfill(spark, d):
    """All events as logs of a block each, delivered by a stream over block ranges in three batches.
    The sink fails at the second one with half of it written; the next call delivers it again from
    the checkpoint, and every log is there once."""
    rows = read(spark, d, "events").select("event_id")
    top = rows.agg(F.coalesce(F.max("event_id") + 1, F.lit(0))).first()[0]
    home = scratch(spark, "backfill")
    hexed = F.concat(F.lit("0x"), F.lower(F.hex("event_id")))
    held = {"removed": F.lit(False), "topics": F.array().cast("array<string>"), "blockNumber": hexed, "logIndex": F.lit("0x0")}
    logs = [held.get(n, F.lit("0x")).alias(n) for n in rpc.FIELDS]
    rows.repartitionByRange("event_id").sortWithinPartitions("event_id").select(F.col("event_id").alias("block"), *logs).write.option("parquet.block.row.count.limit", LOG_ROWS).parquet(f"{home}/logs")
    failing = [1]

    def sink(batch, n):
        found = batch.select(F.conv(F.substring("blockNumber", 3, 16), 16, 10).cast("long").alias("block"))
        if n in failing:
            failing.remove(n)
            found.filter("block % 2 = 0").write.mode("overwrite").parquet(f"{home}/rows/batch={n}")
            raise OSError("the sink broke off")
        found.write.mode("overwrite").parquet(f"{home}/rows/batch={n}")

    # some tasks for each core in a batch, each with many calls: every task reads the table's footers
    calls = max(1, -(-top // (3 * 1000 * 4 * spark.sparkContext.defaultParallelism)))
    options = {"start": "0", "size": "1000", "calls": str(calls), "transport": "ledgerlens.sources.rpc:TableTransport", "url": f"{home}/logs"}
    spark.createDataFrame([], "block long").write.parquet(f"{home}/rows/batch=0")
    for third in (1, 2, 3):
        # a range of a thousand goes whole to the batch in which its first block lies
        head = -(-top * third // 3 // 1000) * 1000 - 1 if third < 3 else top - 1
        options["stop"] = str(min(head, top - 1))
        try:
            rpc.follow_blocks(spark, options, home, sink)
        except StreamingQueryException:
            rpc.follow_blocks(spark, options, home, sink)
    delivered = spark.read.schema("block long, batch int").parquet(f"{home}/rows")
    return delivered.groupBy((F.floor(F.col("block") / 1000) * 1000).cast("long").alias("start")).agg(F.count("*").alias("delivered"), F.sum("block").alias("ids"))


@query("store_daily_window", "SELECT DATE '2024-01-03' AS first, DATE '2024-01-08' AS last")
def store_daily_window(spark, d):
    """The window that fetched pages support: up to the last whole day, and not beyond our own."""
    return spark.createDataFrame([daily_window(datetime.date(2024, 1, 3), datetime.datetime(2024, 1, 9, 14), False, datetime.datetime(2024, 1, 20))], "first date, last date")


def daily_window(first: datetime.date, oldest_fetched: datetime.datetime, complete: bool, ours: datetime.datetime) -> tuple[datetime.date, datetime.date]:
    """First and last day: an incomplete fetch ends on the last whole day before its end."""
    end = min(oldest_fetched, ours)
    last = end.date() if complete else end.date() - datetime.timedelta(days=1)
    return first, last


SUMS = f"WITH {DAILY} SELECT pool, sum(cents)::BIGINT AS cents FROM daily GROUP BY pool"


def _sums(spark, d):
    return daily(spark, d).groupBy("pool").agg(F.sum("cents").alias("cents")).orderBy("pool")


@query("sink_report_md", SUMS)
def sink_report_md(spark, d):
    """The report read back: every row of it, by its columns."""
    lines = reports.markdown(_sums(spark, d), "Pools").splitlines()
    head, *rows = [[v.strip() for v in line.strip("|").split("|")] for line in lines if line.startswith("|")]
    found = [dict(zip(head, r, strict=True)) for r in rows[1:]]
    return spark.createDataFrame([(r["pool"], int(r["cents"])) for r in found], "pool string, cents long")


@query("sink_report_csv", SUMS)
def sink_report_csv(spark, d):
    found = list(csv.DictReader(io.StringIO(reports.as_csv(_sums(spark, d)))))
    return spark.createDataFrame([(r["pool"], int(r["cents"])) for r in found], "pool string, cents long")


@query("sink_dashboard", f"WITH {DAILY} SELECT CAST(day AS VARCHAR) AS label, CAST(sum(cents)::BIGINT AS VARCHAR) AS value, 2 AS charts FROM daily GROUP BY day UNION ALL SELECT pool, CAST(sum(swaps)::BIGINT AS VARCHAR), 2 FROM daily GROUP BY pool")
def sink_dashboard(spark, d):
    """The page read back: the rows of both tables and the number of charts."""
    x = daily(spark, d)
    series = {"Volume by day": x.groupBy("day").agg(F.sum("cents").alias("cents")).orderBy("day"), "Trades by pool": x.groupBy("pool").agg(F.sum("swaps").alias("n")).orderBy("pool")}
    text = reports.page("Trades", series)
    rows = re.findall(r"<tr><td>([^<]*)</td><td>([^<]*)</td></tr>", text)
    return spark.createDataFrame([(a, b, text.count("<svg")) for a, b in rows], "label string, value string, charts int")


@query("q_sanity_07", "SELECT 'query ' || (user_id % 7) AS query, count(*) AS runs, max(event_id % 50)::BIGINT AS slowest FROM events GROUP BY 1")
def q_sanity_07(spark, d):
    """Slow queries from an event log, here one made of events."""
    from ..sources import eventlog

    rows = read(spark, d, "events")
    start = F.struct(F.lit(eventlog.START).alias("Event"), F.col("event_id").alias("executionId"), F.concat(F.lit("query  "), (F.col("user_id") % 7).cast("string")).alias("description"), F.lit(1000).cast("long").alias("time"))
    end = F.struct(F.lit(eventlog.END).alias("Event"), F.col("event_id").alias("executionId"), F.lit(None).cast("string").alias("description"), (F.col("event_id") % 50 + 1000).alias("time"))
    lines = rows.select(F.explode(F.array(F.to_json(start), F.to_json(end))).alias("value"))
    return eventlog.slowest(lines, 100).select("query", "runs", F.col("slowest_ms").alias("slowest"))


@query("distribution", f"WITH {RUNS} SELECT round(avg(value), 6) AS mean, round(median(value), 6) AS middle, list_sort(list(value))[CAST(ceil(0.95 * count(*)) AS BIGINT)] AS p95 FROM runs")
def distribution(spark, d):
    """Mean, median and nearest-rank p95 of all values: percentile_disc is that rank, computed
    from counts, so no array of all values is built."""
    r = runs(spark, d)
    return r.agg(F.round(F.avg("value"), 6).alias("mean"), F.round(F.median("value"), 6).alias("middle"), F.expr("percentile_disc(0.95) within group (order by value)").alias("p95"))


@query("means_guards", f"WITH {RUNS}, p AS (SELECT run, avg(value) AS m FROM runs GROUP BY 1) SELECT round(avg(m), 6) AS mean, round(max(m) - min(m), 6) AS margin FROM p")
def means_guards(spark, d):
    return ev.means_margin(runs(spark, d), "value").select(F.round("mean", 6).alias("mean"), F.round("margin", 6).alias("margin"))


@query("worst_case", "SELECT event_id, CAST(CASE WHEN event_id > 5000 THEN event_id::HUGEINT * 60 + 4096 * 250 ELSE event_id::HUGEINT * 30 + 4096 * 125 END AS DOUBLE) / 100000000 AS usd FROM events")
def worst_case(spark, d):
    """Dearer beyond 5,000 tokens of prompt; input may have to be written to the cache."""
    tiers = [(5000, {"input": "0.25", "cache_write": "0.30", "output": "1.25"}), (None, {"input": "0.50", "cache_write": "0.60", "output": "2.50"})]
    usd = ev.worst_case_usd(F.col("event_id"), F.lit(4096), tiers)
    return read(spark, d, "events").select("event_id", usd.cast("double").alias("usd"))


PROVEN = ["accepted", "denormalized", "label", "lower", "not default", "not null", "opposite signs", "orphans", "part of", "unique", "well formed"]


@query("dq_mutation_proof", f"SELECT * FROM (VALUES {', '.join(f'({chr(39)}{r}{chr(39)}, 1, 0)' for r in PROVEN)}) t(rule, found, before)")
def dq_mutation_proof(spark, d):
    """Each rule finds a planted corruption, and nothing before it is planted."""
    good = spark.createDataFrame([("a", 1, 500, "a 0.05%", "0x" + "0b" * 20, 5, -5, 0.5), ("b", 2, 100, "b 0.01%", "0x" + "0c" * 20, -7, 7, 0.2)], "pool string, k long, fee int, label string, who string, x long, y long, share double")
    dim = spark.createDataFrame([("a", 500), ("b", 100)], "pool string, fee int")
    first = F.col("pool") == "a"
    spoil = lambda c, v: good.withColumn(c, F.when(first, F.lit(v).cast(good.schema[c].dataType)).otherwise(F.col(c)))
    rules = {
        "accepted": (lambda t: quality.accepted(t, "fee", [100, 500, 3000, 10000]), spoil("fee", 123)), "denormalized": (lambda t: quality.denormalized_match(t, dim, "pool", ["fee"]), spoil("fee", 3000)),
        "label": (lambda t: quality.label_states_fee(t, "label", "fee"), spoil("label", "a 0.3%")), "lower": (lambda t: quality.lower_case(t, "pool"), spoil("pool", "A")),
        "not default": (lambda t: quality.not_default(t, "k"), spoil("k", 0)), "not null": (lambda t: quality.not_null(t, "who"), spoil("who", None)), "opposite signs": (lambda t: quality.opposite_signs(t, "x", "y"), spoil("y", 9)),
        "orphans": (lambda t: quality.orphans(t, dim, "pool"), spoil("pool", "z")), "part of": (lambda t: quality.part_of(t, "share"), spoil("share", 1.5)), "unique": (lambda t: quality.unique(t, "k"), spoil("k", 2)),
        "well formed": (lambda t: quality.well_formed(t, "who", 20), spoil("who", "0x00")),
    }
    counts = [f(t).agg(F.count("*").cast("int").alias("n")).select(F.lit(name).alias("rule"), F.lit(kind).alias("kind"), "n") for name, (f, bad) in rules.items() for kind, t in (("found", bad), ("before", good))]
    together = counts[0]
    for one in counts[1:]:
        together = together.unionByName(one)
    return together.groupBy("rule").pivot("kind", ["found", "before"]).agg(F.max("n"))
