"""Smaller file formats: TSV fixtures with a type header, seeds, candles, trades, receipts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.decode import quantity
from ..session import stored

#: Column types of a TSV header and the types here.
TYPES = {"String": "string", "UInt8": "boolean", "UInt32": "bigint", "UInt64": "bigint", "Int32": "int", "Date": "date", "DateTime": "timestamp", "DateTime('UTC')": "timestamp", "Float64": "double"}


def _type(text: str) -> str:
    if text.startswith("Nullable(") or text.startswith("LowCardinality("):
        return _type(text.partition("(")[2][:-1])
    if text.startswith("Decimal"):
        digits, _, scale = text.partition("(")[2][:-1].partition(",")
        wide = {"Decimal64": "18", "Decimal128": "38", "Decimal256": "38"}.get(text.partition("(")[0])
        width = int({"Decimal256": "76"}.get(text.partition("(")[0], wide or digits))
        return f"decimal({width},{(scale or digits).strip()})" if width <= 38 else "string"  # every digit, as text
    return TYPES[text]


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    r"""A TSV with a line of names and a line of types; ``\N`` is null. Ragged rows and escapes
    other than null are refused."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"))
    # the first lines of the first file by name; Spark deals files out by size
    head = lines.orderBy("file", "block", "n").limit(2).collect()
    names, kinds = (r["value"].split("\t") for r in head)
    if len(names) != len(kinds):
        raise ValueError("names and types differ in number")
    is_head = (F.col("file") == head[0]["file"]) & F.col("n").isin([r["n"] for r in head])
    body = lines.filter(~is_head)  # by place: a row may look like a header
    cells = F.split("value", "\t", -1)
    ragged = F.size(cells) != len(names)
    escaped = F.regexp_replace("value", r"(^|\t)\\N(?=\t|$)", "$1").contains("\\")
    checked = F.when(ragged, F.raise_error(F.concat(F.lit("ragged row: "), F.col("value")))).when(escaped, F.raise_error(F.concat(F.lit("escape in row: "), F.col("value")))).cast("array<string>")
    rows = body.select(F.coalesce(checked, cells).alias("c"))
    return rows.select(*[F.when(F.get("c", F.lit(i)) != "\\N", F.get("c", F.lit(i))).cast(_type(k)).alias(name) for i, (name, k) in enumerate(zip(names, kinds, strict=True))])


def write_tsv(df: DataFrame, path: str, keys: list[str], kinds: dict[str, str], file_rows: int = 100_000) -> None:
    """A fixture: rows in key order after the two header lines; a table without rows has those.

    Lines are numbered over the whole table and written in parallel, ``file_rows`` of them or so to
    a file; read in order of their names, the files are the fixture."""
    spark = df.sparkSession
    head = [(0, "\t".join(df.columns)), (1, "\t".join(kinds[c] for c in df.columns))]
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("\\N"))
    from ..operators.ranking import global_rank

    shown = df.withColumn("_line", F.concat_ws("\t", *[cell(c) for c in df.columns]))
    body = global_rank(shown, [F.asc(k) for k in keys], "_n", keep=["_line"]).select((F.col("_n") + 1).alias("n"), F.col("_line").alias("value"))
    lines = stored(spark.createDataFrame(head, "n long, value string").unionByName(body), "fixture-lines")
    parts = max(1, -(-lines.count() // file_rows))
    lines.repartitionByRange(parts, "n").sortWithinPartitions("n").select("value").write.mode("overwrite").text(path)


def write_batches(df: DataFrame, path: str, rows: int = 100_000) -> None:
    """Insert batches: files of exactly ``rows`` rows, all but the last, below batch=<number>.

    Rows are numbered by prefix sums over the sizes of the parts they lie in, so batches are filled
    across parts and written side by side."""
    names = df.columns
    place = F.monotonically_increasing_id()
    parts = stored(df.select("*", F.shiftright(place, 33).alias("_part"), place.bitwiseAND((1 << 33) - 1).alias("_at")), "batch-rows")
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each part
    placed = parts.join(F.broadcast(sizes.select("_part", before.alias("_before"))), "_part")
    batches = placed.select(*names, F.floor((F.col("_before") + F.col("_at")) / rows).alias("batch"))
    writers = max(1, df.sparkSession.sparkContext.defaultParallelism)
    batches.repartition(writers, "batch").write.mode("overwrite").partitionBy("batch").parquet(path)


def fingerprint(df: DataFrame, date: str, sums: list[str]) -> DataFrame:
    """Rows, first and last date and exact sums as text: what a fixture is recognised by."""
    whole = [F.sum(F.col(c).cast("decimal(38,6)")).cast("string").alias(f"sum_{c}") for c in sums]
    return df.agg(F.count(F.lit(1)).alias("rows"), F.min(date).alias("first"), F.max(date).alias("last"), *whole)


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """The pool dimension from a CSV seed."""
    schema = "pool_address string, token0 string, token1 string, decimals0 int, decimals1 int, fee int, label string"
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


CANDLES = "struct<data:struct<attributes:struct<ohlcv_list:array<array<double>>>>>"


def candles(responses: DataFrame, column: str = "body", step: int = 86_400) -> DataFrame:
    """Candles of OHLCV responses: start, volume_usd, close_usd. Identical repeats count once;
    repeats that differ, and starts off the step, are refused."""
    held = F.from_json(column, CANDLES)["data"]["attributes"]["ohlcv_list"]
    rows = responses.select(*[c for c in responses.columns if c != column], F.explode(held).alias("c"))
    keys = [c for c in responses.columns if c != column]
    start = F.get("c", F.lit(0)).cast("long")
    rows = rows.select(*keys, start.alias("at"), F.get("c", F.lit(5)).alias("volume_usd"), F.get("c", F.lit(4)).alias("close_usd"))
    once = rows.groupBy(*keys, "at").agg(F.max(F.struct("volume_usd", "close_usd")).alias("hi"), F.min(F.struct("volume_usd", "close_usd")).alias("lo"))
    wrong = F.when(F.col("at") % step != 0, "a candle does not start on the step").when(F.col("hi") != F.col("lo"), "a candle was given twice with other values")
    good = F.when(wrong.isNotNull(), F.raise_error(wrong).cast("bigint")).otherwise(F.col("at"))
    return once.select(*keys, F.timestamp_seconds(good).alias("start"), F.col("hi.volume_usd").alias("volume_usd"), F.col("hi.close_usd").alias("close_usd"))


TRADE = "array<struct<transaction_hash:string,block_timestamp:string,value_usd:double>>"


def named_trades(responses: DataFrame, column: str = "body") -> DataFrame:
    """Trades of an outside source with a well-formed hash, lower case, in UTC."""
    rows = responses.select(F.explode(F.from_json(column, TRADE)).alias("t"))
    hash_, at = F.lower("t.transaction_hash"), F.to_timestamp(F.regexp_replace("t.block_timestamp", "Z$", "+00:00"))
    return rows.select(hash_.alias("tx_hash"), at.alias("at"), F.col("t.value_usd").alias("value_usd")).filter(F.col("tx_hash").rlike("^0x[0-9a-f]{64}$") & F.col("at").isNotNull())


RECEIPT = "struct<transactionHash:string,`from`:string,gasUsed:string,transactionIndex:string,logs:array<struct<address:string,topics:array<string>>>>"


def receipts(lines: DataFrame, column: str = "value") -> DataFrame:
    """Cached receipts: tx, signer, gas, place and logs."""
    r = F.from_json(column, RECEIPT)
    return lines.select(F.lower(r["transactionHash"]).alias("tx_hash"), F.lower(r["from"]).alias("signer"), quantity(r["gasUsed"]).alias("gas"), quantity(r["transactionIndex"]).alias("slot"), r["logs"].alias("logs"))


def receipts_summary(rows: DataFrame, pools: list[str], swap_topic: str) -> DataFrame:
    """Signers, the shares of the largest one and the largest five, logs by kind, share of early
    slots and gas quantiles."""
    per = rows.groupBy("signer").agg(F.count(F.lit(1)).alias("n"))
    top = per.agg(F.count(F.lit(1)).alias("signers"), F.max("n").alias("most"))
    top5 = per.orderBy(F.desc("n")).limit(5).agg(F.sum("n").alias("most5"))
    logs = rows.select(F.explode("logs").alias("l")).select(F.lower(F.get("l.topics", F.lit(0))).alias("topic"), F.lower("l.address").alias("emitter"))
    ours: Column = F.col("emitter").isin(pools)
    kinds = logs.agg(F.count_if((F.col("topic") == swap_topic) & ours).alias("swaps_of_ours"), F.count_if((F.col("topic") == swap_topic) & ~ours).alias("swaps_elsewhere"), F.count_if(F.col("topic") != swap_topic).alias("other_logs"))
    whole = rows.agg(F.count(F.lit(1)).alias("txs"), F.median("gas").alias("gas_p50"), F.expr("percentile_disc(0.95) within group (order by gas)").cast("long").alias("gas_p95"), F.avg((F.col("slot") <= 2).cast("double")).alias("early"))
    return whole.crossJoin(F.broadcast(top)).crossJoin(F.broadcast(kinds)).crossJoin(F.broadcast(top5)).withColumn("top_share", F.col("most") / F.col("txs")).withColumn("top5_share", F.col("most5") / F.col("txs")).drop("most", "most5")  # one row each


def k_anonymous(rows: DataFrame, group: str, count: str, k: int = 5, other: str = "other") -> DataFrame:
    """Groups of fewer than k are merged; the merged one is dropped if it is still too small."""
    named = rows.withColumn(group, F.when(F.col(count) >= k, F.col(group)).otherwise(F.lit(other)))
    return named.groupBy(group).agg(F.sum(count).alias(count)).filter(F.col(count) >= k)
