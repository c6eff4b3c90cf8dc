"""Sources, sinks, loading and the incremental aggregate, each on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import files, landing
from ..streaming.partials import DailyPartials, partial
from .registry import TRADES, query, read, scratch, trades
from .relational import raw_logs

RANGE = 5


def good_logs(spark, d) -> DataFrame:
    """The raw logs of all good trades."""
    return raw_logs(spark, d).filter("log_index % 97 != 0").select(F.col("log").alias("raw"))


LANDED = f"WITH {TRADES}, landed AS (SELECT *, date_diff('day', DATE '1970-01-01', day) AS block FROM trades WHERE log_index % 97 <> 0) "


def landed(spark, d) -> str:
    path = scratch(spark, "landing")
    landing.write_logs(good_logs(spark, d), path, RANGE)
    return path


@query("src_chunk_ranges", "SELECT a AS from_block, least(a + 9, 1234) AS to_block FROM (SELECT unnest(generate_series(7, 1234, 10)) AS a)")
def src_chunk_ranges(spark, d):
    return landing.chunk_ranges(spark, 7, 1234, 10)


@query("src_block_search", "SELECT CAST(ts AS DATE) AS day, min(event_id) AS first_event FROM events GROUP BY 1")
def src_block_search(spark, d):
    """First event not before each midnight: over a table, a least id for each day."""
    return read(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(F.min("event_id").alias("first_event"))


@query("src_jsonl", LANDED + "SELECT block AS block_number, log_index, CAST(other_raw AS VARCHAR) AS amount0 FROM landed")
def src_jsonl(spark, d):
    rows = landing.read_landing(spark, landed(spark, d))
    return rows.select(F.col("block_number").cast("long").alias("block_number"), F.col("log_index").cast("long").alias("log_index"), "amount0")


@query("sink_jsonl", LANDED + f"SELECT block // {RANGE} * {RANGE} AS from_block, count(*) AS lines FROM landed GROUP BY 1")
def sink_jsonl(spark, d):
    """Written twice, there once: ranges replace themselves."""
    logs, path = good_logs(spark, d), scratch(spark, "landing")
    landing.write_logs(logs, path, RANGE)
    landing.write_logs(logs, path, RANGE)
    return landing.read_landing(spark, path).groupBy("from_block").agg(F.count("*").alias("lines"))


query("at_least_once_idempotent", LANDED + f"SELECT block // {RANGE} * {RANGE} AS from_block, count(*) AS lines FROM landed GROUP BY 1")(sink_jsonl)


@query("src_redecode", LANDED + "SELECT log_index, CAST(other_raw AS VARCHAR) AS amount0, CAST((log_index % 2000) - 1000 AS INT) AS tick FROM landed")
def src_redecode(spark, d):
    rows = landing.read_landing(spark, landed(spark, d), redecode=True)
    return rows.select("log_index", F.col("amount0").cast("string").alias("amount0"), "tick")


@query("src_coverage", "WITH f AS (SELECT event_id // 500 AS n, min(event_id) AS a, max(event_id) AS b FROM events WHERE event_id NOT BETWEEN 900 AND 1700 GROUP BY 1) SELECT before, a AS from_block, 'gap' AS problem FROM (SELECT a, lag(b) OVER (ORDER BY a) AS before FROM f) WHERE a > before + 1")
def src_coverage(spark, d):
    rows = read(spark, d, "events").filter("event_id not between 900 and 1700")
    ranges = rows.groupBy(F.floor(F.col("event_id") / 500).alias("n")).agg(F.min("event_id").alias("from_block"), F.max("event_id").alias("to_block"))
    return landing.coverage_problems(ranges)


def tsv_of(spark, d) -> str:
    path = scratch(spark, "fixture")
    nation = read(spark, d, "nation").withColumn("n_regionkey", F.when(F.col("n_nationkey") != 3, F.col("n_regionkey")))
    files.write_tsv(nation, path, ["n_nationkey"], {"n_nationkey": "Int32", "n_name": "String", "n_regionkey": "Nullable(Int32)"})
    return path


TSV = "SELECT n_nationkey, n_name, CASE WHEN n_nationkey <> 3 THEN n_regionkey END AS n_regionkey FROM nation"


@query("src_tsv", TSV)
def src_tsv(spark, d):
    return files.read_tsv(spark, tsv_of(spark, d))


@query("sink_tsv_fixture", r"SELECT 'n_nationkey' || chr(9) || 'n_name' || chr(9) || 'n_regionkey' AS line UNION ALL SELECT 'Int32' || chr(9) || 'String' || chr(9) || 'Nullable(Int32)' UNION ALL SELECT n_nationkey || chr(9) || n_name || chr(9) || CASE WHEN n_nationkey = 3 THEN '\N' ELSE n_regionkey::VARCHAR END FROM nation")
def sink_tsv_fixture(spark, d):
    return spark.read.text(tsv_of(spark, d)).select(F.col("value").alias("line"))


@query("fixture_fingerprint", "SELECT count(*) AS rows, CAST(min(o_orderdate) AS DATE) AS first, CAST(max(o_orderdate) AS DATE) AS last, CAST(sum(CAST(o_orderkey AS DECIMAL(38,6))) AS VARCHAR) AS sum_o_orderkey FROM orders")
def fixture_fingerprint(spark, d):
    return files.fingerprint(read(spark, d, "orders").withColumn("day", F.to_date("o_orderdate")), "day", ["o_orderkey"])


@query("src_seed_csv", "SELECT CAST(n_nationkey AS VARCHAR) AS pool_address, n_name AS label, n_regionkey * 100 AS fee FROM nation")
def src_seed_csv(spark, d):
    path = scratch(spark, "seed")
    rows = read(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("pool_address"), F.lit("USDC").alias("token0"), F.lit("WETH").alias("token1"), F.lit(6).alias("decimals0"), F.lit(18).alias("decimals1"), (F.col("n_regionkey") * 100).alias("fee"), F.col("n_name").alias("label"))
    rows.write.option("header", True).csv(path)
    return files.read_seed(spark, path).select("pool_address", "label", "fee")


def responses(spark, d, step: str) -> DataFrame:
    """OHLCV responses made of trades, one for each pool; the first candle is repeated."""
    start = F.unix_timestamp(F.date_trunc(step, "ts"))
    rows = trades(spark, d).groupBy("pool", start.alias("at")).agg(F.sum(F.abs("other_raw")).cast("double").alias("v"), F.count("*").cast("double").alias("c"))
    candle = F.array(F.col("at").cast("double"), F.lit(0.0), F.lit(0.0), F.lit(0.0), F.col("c"), F.col("v"))
    held = rows.groupBy("pool").agg(F.sort_array(F.collect_list(candle), asc=False).alias("l"))
    listed = F.concat("l", F.slice("l", 1, 1))
    return held.select("pool", F.to_json(F.struct(F.struct(F.struct(listed.alias("ohlcv_list")).alias("attributes")).alias("data"))).alias("body"))


@query("src_ohlcv_daily", f"WITH {TRADES} SELECT pool, CAST(day AS TIMESTAMP) AS start, sum(abs(other_raw))::DOUBLE AS volume_usd, count(*)::DOUBLE AS close_usd FROM trades GROUP BY 1, 2")
def src_ohlcv_daily(spark, d):
    return _naive(files.candles(responses(spark, d, "day")))


@query("src_ohlcv_hourly", f"WITH {TRADES} SELECT pool, date_trunc('hour', ts) AS start, sum(abs(other_raw))::DOUBLE AS volume_usd, count(*)::DOUBLE AS close_usd FROM trades GROUP BY 1, 2")
def src_ohlcv_hourly(spark, d):
    return _naive(files.candles(responses(spark, d, "hour"), step=3600))


def _naive(rows: DataFrame) -> DataFrame:
    """Starts without a zone, as the tables here have them."""
    return rows.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("src_trades_json", f"WITH {TRADES} SELECT '0x' || lpad(lower(to_hex(tx)), 64, '0') AS tx_hash, count(*) AS n, round(sum(usd), 4) AS usd FROM trades WHERE pool = 'click' AND log_index % 11 <> 0 GROUP BY 1")
def src_trades_json(spark, d):
    hash_ = F.concat(F.lit("0x"), F.lpad(F.upper(F.hex("tx")), 64, "0"))
    one = F.struct(F.when(F.col("log_index") % 11 != 0, hash_).otherwise("0xbad").alias("transaction_hash"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("block_timestamp"), F.col("usd").alias("value_usd"))
    bodies = trades(spark, d).filter("pool = 'click'").groupBy("day").agg(F.to_json(F.collect_list(one)).alias("body"))
    return files.named_trades(bodies.select("body")).groupBy("tx_hash").agg(F.count("*").alias("n"), F.round(F.sum("value_usd"), 4).alias("usd"))


def receipt_lines(spark, d) -> DataFrame:
    t = trades(spark, d)
    one = F.struct(F.concat(F.lit("0x"), F.lpad(F.hex("pool"), 40, "0")).alias("address"), F.array(F.when(F.col("log_index") % 2 == 0, "0xaa").otherwise("0xbb")).alias("topics"))
    per = t.groupBy("tx").agg(F.min("sender").alias("s"), F.sum("log_index").alias("g"), F.collect_list(one).alias("logs"))
    hexed = lambda c: F.concat(F.lit("0x"), F.lower(F.hex(c)))
    return per.select(F.to_json(F.struct(F.concat(F.lit("0x"), F.lpad(F.hex("tx"), 64, "0")).alias("transactionHash"), hexed(F.col("s")).alias("from"), hexed(F.col("g")).alias("gasUsed"), hexed(F.col("tx") % 9).alias("transactionIndex"), F.col("logs").alias("logs"))).alias("value"))


@query("src_receipts_json", f"WITH {TRADES} SELECT '0x' || lpad(lower(to_hex(tx)), 64, '0') AS tx_hash, sum(log_index)::BIGINT AS gas, tx % 9 AS slot, count(*)::INT AS logs FROM trades GROUP BY tx")
def src_receipts_json(spark, d):
    return files.receipts(receipt_lines(spark, d)).select("tx_hash", "gas", "slot", F.size("logs").alias("logs"))


@query("receipts_summary", f"""WITH {TRADES}, r AS (SELECT tx, min(sender) AS s, sum(log_index)::BIGINT AS gas FROM trades GROUP BY tx), top AS (SELECT count(*) AS signers, max(n) AS most, sum(n) FILTER (place <= 5) AS most5 FROM (SELECT n, row_number() OVER (ORDER BY n DESC) AS place FROM (SELECT s, count(*) AS n FROM r GROUP BY s))), l AS (SELECT * FROM trades)
SELECT count(*) AS txs, median(gas)::DOUBLE AS gas_p50, list_sort(list(gas))[CAST(ceil(0.95 * count(*)) AS BIGINT)] AS gas_p95, round(avg(CASE WHEN tx % 9 <= 2 THEN 1.0 ELSE 0.0 END), 9) AS early, (SELECT signers FROM top) AS signers,
 (SELECT count(*) FROM l WHERE log_index % 2 = 0 AND pool = 'click') AS swaps_of_ours, (SELECT count(*) FROM l WHERE log_index % 2 = 0 AND pool <> 'click') AS swaps_elsewhere, (SELECT count(*) FROM l WHERE log_index % 2 = 1) AS other_logs, round((SELECT most FROM top)::DOUBLE / count(*), 9) AS top_share, round((SELECT most5 FROM top)::DOUBLE / count(*), 9) AS top5_share FROM r""")
def receipts_summary(spark, d):
    emitter = "0x" + "click".encode().hex().rjust(40, "0")
    out = files.receipts_summary(files.receipts(receipt_lines(spark, d)), [emitter], "0xaa")
    return out.withColumn("early", F.round("early", 9)).withColumn("top_share", F.round("top_share", 9)).withColumn("top5_share", F.round("top5_share", 9))


@query("k_anonymity", "SELECT g AS name, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN n >= 67 THEN 'user ' || user_id ELSE 'other' END AS g, n FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1)) GROUP BY 1 HAVING sum(n) >= 67")
def k_anonymity(spark, d):
    per = read(spark, d, "events").groupBy(F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("name")).agg(F.count("*").alias("n"))
    return files.k_anonymous(per, "name", "n", 67)


# loading


def _loaded(spark, d) -> tuple[DataFrame, str]:
    path, target = landed(spark, d), scratch(spark, "table")
    landing.load(spark, path, target)
    return landing.load(spark, path, target), target


@query("load_incremental", LANDED + f"SELECT block // {RANGE} * {RANGE} AS from_block, count(*) AS lines, 'skip' AS action FROM landed GROUP BY 1")
def load_incremental(spark, d):
    """A second load finds every file there."""
    return _loaded(spark, d)[0].select("from_block", "lines", "action")


@query("load_full", LANDED + "SELECT count(*) AS rows, sum(other_raw)::BIGINT AS raw FROM landed")
def load_full(spark, d):
    path, target = landed(spark, d), scratch(spark, "table")
    landing.load(spark, path, target)
    landing.load(spark, path, target, full=True)
    return spark.read.parquet(target).agg(F.count("*").alias("rows"), F.sum(F.col("amount0").cast("long")).alias("raw"))


@query("load_verify", LANDED + f", f AS (SELECT DISTINCT block // {RANGE} * {RANGE} AS a FROM landed), r AS (SELECT a, a + {RANGE} - CASE WHEN a % {2 * RANGE} = 0 THEN 0 ELSE 1 END AS b FROM f) SELECT 'daily aggregate' AS \"check\", count(*) AS problems FROM (SELECT DISTINCT pool, day FROM landed WHERE day = DATE '2024-01-03' AND pool = 'click') UNION ALL SELECT 'coverage', count(*) FROM (SELECT a, lag(b) OVER (ORDER BY a) AS before FROM r) WHERE a <> before + 1")
def load_verify(spark, d):
    """A loaded table with a planted drift of its aggregate, and every other file reaching into the
    next one's blocks: these alone are found."""
    t = trades(spark, d).filter("log_index % 97 != 0").withColumn("block_number", F.datediff("day", F.lit("1970-01-01")).cast("long")).withColumn("from_block", F.floor(F.col("block_number") / RANGE) * RANGE)
    reach = F.when(F.col("from_block") % (2 * RANGE) == 0, 0).otherwise(1)
    held = t.groupBy("from_block").agg(F.count("*").alias("lines")).withColumn("to_block", F.col("from_block") + RANGE - reach)
    daily = t.groupBy("pool", "day").agg((F.count("*") + F.max(F.when((F.col("pool") == "click") & (F.col("day") == "2024-01-03"), 1).otherwise(0))).alias("trades"))
    return landing.verify(t, held, daily).groupBy("check").agg(F.count("*").alias("problems"))


#: Rows of a batch in the query: small enough for several batches of the test tables.
BATCH = 1_000


@query("sink_insert_batch", LANDED + f"SELECT CAST(batch AS BIGINT) AS batch, least({BATCH}, (SELECT count(*) FROM landed) - batch * {BATCH})::BIGINT AS rows, 1::BIGINT AS files FROM range((SELECT (count(*) + {BATCH - 1}) // {BATCH} FROM landed)) b(batch)")
def sink_insert_batch(spark, d):
    """Large batches: each is one file of as many rows, all but the last, read back."""
    path = scratch(spark, "batches")
    files.write_batches(trades(spark, d).filter("log_index % 97 != 0"), path, BATCH)
    back = spark.read.parquet(path).select(F.col("batch").cast("long").alias("batch"), "_metadata.file_path")
    return back.groupBy("batch").agg(F.count("*").alias("rows"), F.countDistinct("file_path").alias("files"))


@query("canonical_check", "SELECT CAST(last AS BIGINT) AS block_number FROM (SELECT max(event_id) AS last FROM events GROUP BY event_id // 500) WHERE last % 2500 = 499")
def canonical_check(spark, d):
    """Planted blocks whose hash is not the canonical one: the last of every fifth range."""
    rows = read(spark, d, "events").select((F.floor(F.col("event_id") / 500) * 500).alias("from_block"), F.col("event_id").alias("block_number"), F.md5(F.col("event_id").cast("string").cast("binary")).alias("block_hash"))
    canonical = rows.select("block_number", F.when(F.col("block_number") % 2500 == 499, "forked").otherwise(F.col("block_hash")).alias("block_hash"))
    return landing.canonical_problems(rows, canonical).select("block_number")


# the incremental aggregate

SUMS = f"WITH {TRADES} SELECT pool, day, count(*) AS trades, sum(abs(other_raw))::BIGINT AS raw FROM trades GROUP BY 1, 2"


def _rows(spark, d) -> DataFrame:
    return trades(spark, d).select("pool", "day", F.abs("other_raw").alias("raw"), "ts", "log_index", "sender")


def _followed(spark, d) -> tuple[DailyPartials, DataFrame]:
    """A stream over the later days, a backfill of the earlier ones."""
    home, rows = scratch(spark, "partials"), _rows(spark, d)
    later = rows.filter("day >= date'2024-01-10'")
    later.repartition(3).write.parquet(f"{home}/inserted")
    stream = spark.readStream.schema(later.schema).option("maxFilesPerTrigger", 1).parquet(f"{home}/inserted")
    kept = DailyPartials(spark, home)
    kept.follow(stream)
    earlier = rows.filter("day < date'2024-01-10'")
    kept.backfill(earlier)
    kept.backfill(earlier)
    return kept, rows


@query("mv_trigger", f"WITH s AS ({SUMS}) SELECT * FROM s WHERE day >= DATE '2024-01-10'")
def mv_trigger(spark, d):
    return _followed(spark, d)[0].daily().filter("day >= date'2024-01-10'")


@query("mv_read", SUMS)
def mv_read(spark, d):
    rows = _rows(spark, d)
    parts = partial(rows.filter("log_index % 3 = 0")).unionByName(partial(rows.filter("log_index % 3 > 0")))
    return parts.groupBy("pool", "day").agg(F.sum("trades").alias("trades"), F.sum("raw").alias("raw"))


@query("mv_backfill", SUMS)
def mv_backfill(spark, d):
    """Backfilled twice, counted once."""
    return _followed(spark, d)[0].daily()


@query("mv_rebuild", SUMS)
def mv_rebuild(spark, d):
    kept, rows = _followed(spark, d)
    kept.rebuild(rows)
    return kept.daily()


@query("catchup_day", f"WITH {TRADES} SELECT day, count(*) AS trades FROM trades GROUP BY 1")
def catchup_day(spark, d):
    """A stream that catches up with everything there is and ends."""
    home, rows = scratch(spark, "catchup"), _rows(spark, d)
    rows.repartition(2).write.parquet(f"{home}/inserted")
    kept = DailyPartials(spark, home)
    kept.follow(spark.readStream.schema(rows.schema).parquet(f"{home}/inserted"))
    return kept.daily().groupBy("day").agg(F.sum("trades").alias("trades"))


@query("stream_windows", f"WITH {TRADES} SELECT pool, CAST(day AS TIMESTAMP) AS start, count(*) AS trades FROM trades WHERE day < (SELECT max(day) FROM trades) GROUP BY 1, 2")
def stream_windows(spark, d):
    """Event-time windows that a watermark closed: all days but the last."""
    from ..streaming.partials import windowed

    home, rows = scratch(spark, "windows"), _rows(spark, d)
    rows.coalesce(1).write.parquet(f"{home}/inserted")
    stream = windowed(spark.readStream.schema(rows.schema).parquet(f"{home}/inserted").withColumn("ts", F.col("ts").cast("timestamp")))
    out = stream.select("pool", F.col("w.start").alias("start"), "trades")
    out.writeStream.format("parquet").option("path", f"{home}/out").option("checkpointLocation", f"{home}/place").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{home}/out").withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("stream_sessions", f"WITH {TRADES}, g AS (SELECT sender, ts, CASE WHEN ts >= lag(ts) OVER (PARTITION BY sender ORDER BY ts) + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS new FROM trades), s AS (SELECT sender, ts, sum(new) OVER (PARTITION BY sender ORDER BY ts) AS n FROM g) SELECT sender, min(ts) AS start, count(*) AS trades FROM s GROUP BY sender, n")
def stream_sessions(spark, d):
    from ..streaming.partials import sessions

    found = sessions(trades(spark, d).withColumn("ts", F.col("ts").cast("timestamp")), "6 hours")
    return found.select("sender", F.col("w.start").cast("timestamp_ntz").alias("start"), "trades")


@query("fee_tier_pairs", "SELECT n_nationkey AS pair, n_name || ' 0.01%' AS low, n_name || ' 0.05%' AS high FROM nation")
def fee_tier_pairs(spark, d):
    """The two pools of a pair, cheaper first; a pair with any other number is refused."""
    tiers = F.explode(F.array(*[F.struct(F.lit(fee).alias("fee"), F.concat("n_name", F.lit(text)).alias("label")) for fee, text in ((500, " 0.05%"), (100, " 0.01%"))]))
    pools = read(spark, d, "nation").select(F.col("n_nationkey").alias("pair"), tiers.alias("t")).select("pair", "t.*")
    rows = pools.groupBy("pair").agg(F.count("*").alias("n"), F.min_by("label", "fee").alias("low"), F.max_by("label", "fee").alias("high"))
    checked = F.when(F.col("n") != 2, F.raise_error(F.lit("a pair needs two pools")).cast("int")).otherwise(F.col("pair"))
    return rows.select(checked.alias("pair"), "low", "high")

