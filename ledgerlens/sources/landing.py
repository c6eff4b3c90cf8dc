"""Landing files: gzipped JSON lines of decoded trades and their raw logs, a folder for a block range.

Integers are strings, so that no reader rounds them. The range in a folder's name is its key:
writing a range again replaces it, which makes an at-least-once delivery idempotent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import decode
from ..session import scratch

LOG = "struct<removed:boolean,address:string,topics:array<string>,data:string,blockNumber:string,transactionIndex:string,logIndex:string,blockTimestamp:string,blockHash:string,transactionHash:string>"
DECODED = ("pool", "block_number", "block_hash", "block_timestamp", "tx_hash", "tx_index", "log_index", "sender", "recipient", "amount0", "amount1", "sqrt_price", "liquidity", "tick")
LINE = f"decoded struct<{','.join(f'{c}:string' for c in DECODED)}>, raw {LOG}"
KEY = ("block_number", "log_index")
#: Rows that a task of the sink sorts and writes, some 150 MB.
FILE_ROWS = 100_000
#: The JVM interprets methods of more than 8,000 bytes, such as the decoding of a whole log as one; below
#: this limit Spark generates several.
METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit"


def chunk_ranges(spark: SparkSession, start: int, end: int, size: int) -> DataFrame:
    """Disjoint inclusive ranges that cover [start, end]."""
    if size < 1 or end < start:
        raise ValueError("an empty range or size")
    first = F.col("id").alias("from_block")
    return spark.range(start, end + 1, size).select(first, F.least(F.col("id") + size - 1, F.lit(end)).alias("to_block"))


def write_landing(lines: DataFrame, path: str, range_size: int, file_rows: int = FILE_ROWS) -> None:
    """Write (block_number, decoded, raw) rows by block range; only the ranges present in the
    rows are replaced. Rows are dealt by their place in the order of blocks and logs, some
    ``file_rows`` to a task, so a range of many rows has several files, one after the other."""
    ranged = lines.withColumn("from_block", F.floor(F.col("block_number") / range_size) * range_size)
    order = [F.col("from_block"), F.col("decoded.block_number").cast("long"), F.col("decoded.log_index").cast("long")]
    _write(_dealt(ranged.select("from_block", "decoded", "raw"), order, lines, file_rows), path)


def write_logs(logs: DataFrame, path: str, range_size: int, file_rows: int = FILE_ROWS) -> None:
    """As ``write_landing`` for good logs (column raw) that are not decoded yet: the raw logs alone
    are dealt, and each task decodes those it writes."""
    order = ["from_block", "block_number", "log_index"]
    block = decode.quantity(F.col("raw.blockNumber"))
    ranged = logs.select((F.floor(block / range_size) * range_size).alias("from_block"), block.alias("block_number"), decode.quantity(F.col("raw.logIndex")).alias("log_index"), "raw")
    _write(_dealt(ranged, order, logs, file_rows).select("from_block", decoded(F.col("raw")).alias("decoded"), "raw"), path)


def decoded(raw: Column) -> Column:
    """The decoded half of a line: integers as strings."""
    fields = decode.trade_columns(raw)
    return F.struct(*[fields[c].cast("string").alias(c) for c in DECODED])


def _dealt(rows: DataFrame, order: list, counted: DataFrame, file_rows: int) -> DataFrame:
    tasks = max(1, -(-counted.count() // file_rows))
    return rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)


def _write(rows: DataFrame, path: str) -> None:
    """Lines are hex digits for the most part and shrink to less than a tenth; while a range is
    replaced, the folder holds it twice."""
    conf = rows.sparkSession.conf
    before = conf.get(METHOD_BYTES)
    conf.set(METHOD_BYTES, "8000")
    try:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "gzip").partitionBy("from_block").json(path)
    finally:
        conf.set(METHOD_BYTES, before)

def read_landing(spark: SparkSession, path: str, redecode: bool = False) -> DataFrame:
    """Rows of a landing folder with their range; a malformed line fails the read. ``redecode``
    takes the fields from the raw logs again."""
    rows = spark.read.schema(f"{LINE}, from_block long").option("mode", "FAILFAST").json(path)
    if not redecode:
        return rows.select("from_block", *[F.col(f"decoded.{c}").alias(c) for c in DECODED])
    fields = decode.trade_columns(F.col("raw"))
    out = rows.select("from_block", *[c.alias(n) for n, c in fields.items()])
    bad = F.col("error_reason").isNotNull()
    return out.withColumn("pool", F.when(bad, F.raise_error(F.col("error_reason")).cast("string")).otherwise(F.col("pool"))).drop("error_reason")


def coverage_problems(ranges: DataFrame) -> DataFrame:
    """Gaps and overlaps between ranges (from_block, to_block): one row for each."""
    before = F.lag("to_block").over(Window.orderBy("from_block"))  # one row for each file
    found = ranges.withColumn("before", before).filter("before is not null and from_block != before + 1")
    return found.select("before", "from_block", F.when(F.col("from_block") > F.col("before") + 1, "gap").otherwise("overlap").alias("problem"))


def load_plan(files: DataFrame, table: DataFrame) -> DataFrame:
    """What an incremental load does with each file. ``files``: from_block, lines; ``table``:
    rows with from_block. skip: all there; insert: none there; replace: some there."""
    held = table.groupBy("from_block").agg(F.count(F.lit(1)).alias("rows"))
    joined = files.join(held, "from_block", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    action = F.when(F.col("rows") == F.col("lines"), "skip").when(F.col("rows") == 0, "insert").otherwise("replace")
    return joined.select("from_block", "lines", "rows", action.alias("action"))


def load(spark: SparkSession, landing: str, target: str, full: bool = False) -> DataFrame:
    """Bring a Parquet table up to its landing folder; returns the plan that was carried out.

    Ranges are partitions of the target, overwritten dynamically; a full load replaces all."""
    rows = read_landing(spark, landing).withColumn("month", F.substring("block_timestamp", 1, 7))
    files = rows.groupBy("from_block").agg(F.count(F.lit(1)).alias("lines"))
    fresh = full or not exists(spark, target)
    table = spark.createDataFrame([], "from_block long") if fresh else spark.read.parquet(target).select("from_block")
    # the plan is written, as what it was made from changes
    at = scratch(spark, "load-plan")
    load_plan(files, table).write.parquet(at)
    plan = spark.read.parquet(at)
    todo = plan.filter("action != 'skip'").select("from_block")
    if full:
        rows.write.mode("overwrite").partitionBy("from_block").parquet(target)
    elif not todo.isEmpty():
        rows.join(todo, "from_block", "left_semi").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("from_block").parquet(target)
    return plan


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a folder; any other trouble with it raises."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(at)


def verify(table: DataFrame, files: DataFrame, aggregate: DataFrame) -> DataFrame:
    """Problems of a loaded table as rows (check, detail): row count, coverage of the blocks by the
    files, duplicate keys, rows by file, and the daily aggregate (pool, day, trades) against the rows.
    ``files``: from_block, to_block, lines."""
    say = lambda df, check, detail: df.select(F.lit(check).alias("check"), detail.alias("detail"))
    counts = table.agg(F.count(F.lit(1)).alias("a")).crossJoin(F.broadcast(files.agg(F.coalesce(F.sum("lines"), F.lit(0)).alias("b"))))  # one row
    total = say(counts.filter("a != b"), "row count", F.concat_ws(" vs ", "a", "b"))
    covered = say(coverage_problems(files), "coverage", F.concat_ws(" ", "problem", F.col("from_block").cast("string")))
    keys = table.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    twice = say(keys, "duplicate key", F.concat_ws("/", *KEY))
    by_file = say(load_plan(files, table).filter("action != 'skip'"), "rows by file", F.col("from_block").cast("string"))
    daily = table.groupBy("pool", "day").agg(F.count(F.lit(1)).alias("n"))
    drift = daily.join(aggregate.select("pool", "day", F.col("trades").alias("m")), ["pool", "day"], "full_outer").filter("not (n <=> m)")
    return total.unionByName(covered).unionByName(twice).unionByName(by_file).unionByName(say(drift, "daily aggregate", F.concat_ws("/", "pool", F.col("day").cast("string"))))


def canonical_problems(rows: DataFrame, canonical: DataFrame, tail: int = 100) -> DataFrame:
    """Blocks whose hash is not the node's: the last one with a row of every range, and all of the
    last ``tail`` blocks. ``canonical``: block_number, block_hash."""
    last = rows.groupBy("from_block").agg(F.max_by(F.struct("block_number", "block_hash"), "block_number").alias("b")).select("b.*")
    top = rows.agg(F.max("block_number").alias("top"))
    late = rows.crossJoin(F.broadcast(top)).filter(F.col("block_number") > F.col("top") - tail).select("block_number", "block_hash")  # one row
    return last.unionByName(late).distinct().join(canonical, ["block_number", "block_hash"], "left_anti")
