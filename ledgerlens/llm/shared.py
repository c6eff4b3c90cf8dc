"""What the training-data operators share: tables, shared folders, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in one Arrow batch; with the byte limit it bounds what a Python worker holds at once.
ARROW_ROWS = 1000
ARROW_BYTES = 4 * 1024 * 1024
#: Rows that a Parquet reader decodes at once, and bytes of a row group of tables written here: with
#: texts of a hundred thousand characters the usual 4,096 rows and 128 MB take much of an executor.
READ_ROWS, GROUP_BYTES = 512, 32 * 1024 * 1024
#: A side with at most this many narrow rows (three columns or so) may be broadcast: some 10 MB.
BROADCAST_ROWS = 100_000
#: Tasks for each core that a table is written by at least, if it has so many parts, and the bytes
#: of input that a task takes beyond that: small parts go together, so that no table falls into
#: many small files.
TASKS_PER_CORE, TASK_BYTES = 2, 128 * 1024 * 1024
#: More parts than this are left as they are (the size of a plan with joins is a guess).
MOST_PARTS = 10_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches and the reader's batches of the session, so that very long texts fit
    a worker and an executor. Smaller bounds that the session has already stay."""
    bounds = {"spark.sql.execution.arrow.maxRecordsPerBatch": ARROW_ROWS, "spark.sql.execution.arrow.maxBytesPerBatch": ARROW_BYTES, "spark.sql.parquet.columnarReaderBatchSize": READ_ROWS}
    for key, most in bounds.items():
        now = spark.conf.get(key, None) or ""
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder below spark.checkpoint.dir. Where that is unset, one of this machine, but only
    for a session whose executors run in the driver, as in tests; a cluster must name one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir is unset: executors of {master} need a folder that all of them share")
        base = "file://" + tempfile.mkdtemp(prefix="ledgerlens-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def parts_of(docs: DataFrame) -> int:
    """Parts in which a table made from ``docs`` is written: enough for all cores, and one for each
    TASK_BYTES of what is read."""
    cores = max(1, docs.sparkSession.sparkContext.defaultParallelism)
    size = docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return max(TASKS_PER_CORE * cores, min(MOST_PARTS, int(str(size)) // TASK_BYTES))


def stored(df: DataFrame, label: str, narrow: bool = False, parts: int | None = None) -> DataFrame:
    """Write to the shared folder and read back: later steps neither repeat nor lose the work.
    A ``narrow`` table (ids, counts) is written by a task for each core, others by at most
    ``parts`` tasks, if given."""
    spark = df.sparkSession
    path = shared_dir(spark, label)
    parts = max(1, spark.sparkContext.defaultParallelism) if narrow else parts
    (df if parts is None else df.coalesce(parts)).write.option("parquet.block.size", GROUP_BYTES).parquet(path)
    read = spark.read.schema(df.schema).parquet(path)
    read.stored_at = path
    return read


def dropped(*tables: DataFrame | None) -> None:
    """Delete stored tables that nothing will read again."""
    for df in tables:
        path = getattr(df, "stored_at", None)
        if path:
            jvm = df.sparkSession._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast behind a check of the counted rows; a plain (adaptive) join beyond it."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def text_bytes(column) -> list[bytes]:
    """UTF-8 of an Arrow text column, null as empty."""
    import pyarrow as pa

    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def let_go() -> None:
    """Give what this worker has freed back to the machine; called at the end of a task, so that
    what one operator held does not stay beside the next one's."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
