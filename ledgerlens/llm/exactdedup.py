"""Exact dedup as a stateful stream over documents.

Two streams run to the end of what there is and keep their place, so another call handles only
new files. The first reads the documents and appends one catalog row for each: digest of the
normalised text, length, id and locator (file and row). The second groups the catalog by digest
in a disk-backed state store without expiry: for each digest the number of rows and the row that
stays (most code points, then smallest id), with its identifier and locator. Each batch writes
the groups it changed.

Digests alone decide nothing: on hits, that is for digests with several rows, the full bytes are
read again and compared (least and greatest text of a digest). Groups that differ in their bytes
are split by the text itself. A large group is dealt in parts: its digest is one of at most
HOT_GROUPS whose sizes pass a bound that grows with the table, so their list can be sent to all
tasks; their rows join by digest and part, and both ends are first found within a part.

Main path in DataFrame functions only. Defined results: a null text is empty; texts of white
space alone are equal to the empty one; rows that repeat an id are rows of their own, of which
one stays; a null id comes last among equals; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Settings of the session while the state is brought up to date: a state store on disk, without
#: space allotted in advance, of which many small stores would take more than their rows.
STATE = {
    PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
SOURCES = "source string, doc_id string, text string"
#: Rows of a part of a large group, and the most groups that count as large.
PART_ROWS, HOT_GROUPS = 1_000, 50_000


def normalized(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


class StreamingDedup:
    """The streams' state below one shared folder; see the module's text."""

    def __init__(self, spark: SparkSession, home: str, digest: Callable[[Column], Column] = sha256, files_per_batch: int | None = None):
        self.spark, self.home, self.digest, self.files_per_batch = spark, home, digest, files_per_batch

    def advance(self, source: str, doc_id: str = "doc_id", text: str = "text") -> None:
        """Take in the Parquet files below ``source`` that have not been seen yet."""
        source = source.rstrip("/")
        self.doc_id, self.text = doc_id, text
        known = self.spark.createDataFrame([(source, doc_id, text)], SOURCES)
        known.coalesce(1).write.mode("append").parquet(f"{self.home}/sources")
        schema = self.spark.read.parquet(source).select(doc_id, text).schema
        reader = self.spark.readStream.schema(schema)
        if self.files_per_batch:
            reader = reader.option("maxFilesPerTrigger", self.files_per_batch)
        # as a pattern that matches just this name, a single file can be a stream's source too
        rows = self._digested(reader.parquet(f"{source[:-1]}[{source[-1]}]"))
        self._run(rows.drop("norm").writeStream.format("parquet").option("path", f"{self.home}/catalog").outputMode("append"), "catalog-place")
        place = F.struct("n_chars", F.bitwise_not("doc_id").alias("order"), "file", "row")
        groups = self.spark.readStream.schema(rows.drop("norm").schema).parquet(f"{self.home}/catalog")
        groups = groups.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.max(place).alias("best"))
        before = {key: self.spark.conf.get(key, None) for key in STATE}
        for key, value in STATE.items():
            self.spark.conf.set(key, value)
        try:
            self._run(groups.writeStream.outputMode("update").foreachBatch(self._keep), "state-place")
        finally:
            for key, value in before.items():
                if value is None:
                    self.spark.conf.unset(key)
                else:
                    self.spark.conf.set(key, value)

    def _digested(self, docs: DataFrame) -> DataFrame:
        rows = docs.select(
            F.col(self.doc_id).cast("long").alias("doc_id"),
            F.length(F.coalesce(F.col(self.text), F.lit(""))).cast("long").alias("n_chars"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.row_index").alias("row"),
            normalized(F.col(self.text)).alias("norm"),
        )
        return rows.withColumn("digest", self.digest(F.col("norm"))).withColumn("text_sha256", sha256(F.col("norm")))

    def _run(self, writer, place: str) -> None:
        writer.option("checkpointLocation", f"{self.home}/{place}").trigger(availableNow=True).start().awaitTermination()

    def _keep(self, batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.home}/groups/batch={number}")

    def groups(self) -> DataFrame:
        """The newest state of each digest: digest, group_size, best."""
        rows = self.spark.read.parquet(f"{self.home}/groups")
        newest = F.max(F.struct("batch", "group_size", "best")).alias("g")
        return rows.groupBy("digest").agg(newest).select("digest", "g.group_size", "g.best")

    def catalog(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.home}/catalog")

    def documents(self) -> DataFrame:
        """All rows of all folders taken in, with their normalised texts."""
        known = self.spark.read.parquet(f"{self.home}/sources").distinct().orderBy("source").collect()  # a row for each folder
        parts = []
        for r in known:
            self.doc_id, self.text = r["doc_id"], r["text"]
            parts.append(self._digested(self.spark.read.parquet(r["source"])))
        return reduce(DataFrame.unionByName, parts)

    @staticmethod
    def _dealt(rows: DataFrame, hot: DataFrame) -> DataFrame:
        """``rows`` (digest, file, row) with the part of the group that each belongs to."""
        part = F.coalesce(F.pmod(F.xxhash64("file", "row"), F.col("parts")), F.lit(0)).cast("int")
        return rows.join(F.broadcast(hot), "digest", "left").withColumn("part", part).drop("parts")

    @staticmethod
    def _parted(groups: DataFrame, hot: DataFrame) -> DataFrame:
        """``groups`` once for each part."""
        parts = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)).cast("int") - 1)
        return groups.join(F.broadcast(hot), "digest", "left").withColumn("part", F.explode(parts)).drop("parts")

    @staticmethod
    def hot(groups: DataFrame) -> DataFrame:
        """digest and parts of the large groups: at most HOT_GROUPS, as each has more rows than
        the whole table has for each of so many."""
        rows = groups.agg(F.sum("group_size")).first()[0] or 0
        large = groups.filter(F.col("group_size") > max(PART_ROWS, rows // HOT_GROUPS))
        return large.select("digest", F.ceil(F.col("group_size") / PART_ROWS).cast("long").alias("parts"))

    def unequal(self, groups: DataFrame, hot: DataFrame) -> DataFrame:
        """Digests whose texts are not all the same bytes."""
        several = self._parted(groups.filter("group_size > 1").select("digest"), hot)
        hits = self._dealt(self.documents(), hot).join(several, ["digest", "part"])
        parts = hits.groupBy("digest", "part").agg(F.min("norm").alias("low"), F.max("norm").alias("high"))
        return parts.groupBy("digest").agg(F.min("low").alias("low"), F.max("high").alias("high")).filter("low != high").select("digest")

    def result(self) -> DataFrame:
        """One row per document: doc_id, keep_id, group_size, kept, text_sha256, file, row."""
        groups = shared.stored(self.groups(), "dedup-groups")
        hot = shared.stored(self.hot(groups), "dedup-hot", narrow=True)
        unequal = shared.stored(self.unequal(groups, hot), "dedup-unequal", narrow=True)
        joined = self._dealt(self.catalog(), hot).join(self._parted(groups, hot), ["digest", "part"]).drop("part")
        if not unequal.isEmpty():
            hits = self.documents().join(unequal, "digest")
            exact = hits.groupBy("digest", "norm").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("n_chars", F.bitwise_not("doc_id").alias("order"), "file", "row")).alias("best"))
            split = hits.join(exact, ["digest", "norm"]).select(*joined.columns)
            joined = joined.join(unequal, "digest", "left_anti").unionByName(split)
        kept = (F.col("file") == F.col("best.file")) & (F.col("row") == F.col("best.row"))
        return joined.select("doc_id", F.bitwise_not("best.order").alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256", "file", "row")


def dedup_exact(spark: SparkSession, source: str, home: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All of ``source`` through a new (or continued) state folder."""
    state = StreamingDedup(spark, home or shared.shared_dir(spark, "exact-dedup"))
    state.advance(source, doc_id, text)
    return state.result()
