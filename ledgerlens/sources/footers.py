"""Physical state of Parquet tables from their footers, read in tasks: no row is decoded.

Spark lists the files and deals them; a task opens each of its files, reads the footer and gives a
row for each row group and column. Numbers, times (microseconds), dates (days) and booleans have
their bounds as doubles; texts as text, where the writer kept them whole or cut. A column whose
writer kept no statistics has null bounds and null counts; an empty table gives no rows.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GROUPS = "file string, row_group int, column string, rows long, nulls long, packed long, unpacked long, bounded boolean, low double, high double, low_text string, high_text string"
EPOCH = datetime.datetime(1970, 1, 1, tzinfo=datetime.UTC)


def number_of(value) -> float | None:
    """A bound as a number; None for texts and bytes. Both zeros are one, as footers may hold -0.0."""
    if isinstance(value, datetime.datetime):
        at = value if value.tzinfo else value.replace(tzinfo=datetime.UTC)
        return float((at - EPOCH) // datetime.timedelta(microseconds=1))
    if isinstance(value, datetime.date):
        return float((value - EPOCH.date()).days)
    return None if isinstance(value, str | bytes) else float(value) + 0.0


def _groups_of(file: str) -> Iterator[tuple]:
    import pyarrow.parquet as pq
    from pyarrow.fs import FileSystem

    system, path = FileSystem.from_uri(file)
    with system.open_input_file(path) as source:
        footer = pq.read_metadata(source)
    for g in range(footer.num_row_groups):
        group = footer.row_group(g)
        for c in range(group.num_columns):
            column = group.column(c)
            kept = column.statistics
            bounds = (kept.min, kept.max) if kept is not None and kept.has_min_max else (None, None)
            counted = kept is not None and kept.has_null_count
            nulls = 0 if not group.num_rows else kept.null_count if counted else None
            empty = nulls == group.num_rows  # no value, so nothing that bounds could leave out
            texts = [b if isinstance(b, str) else None for b in bounds]
            numbers = [None if b is None else number_of(b) for b in bounds]
            yield file, g, column.path_in_schema, group.num_rows, nulls, column.total_compressed_size, column.total_uncompressed_size, bounds[0] is not None or empty, *numbers, *texts


def _read(batches: Iterator) -> Iterator:
    import pyarrow as pa

    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
    fields = [f.split() for f in GROUPS.split(", ")]
    for batch in batches:
        for file in batch.column(0).to_pylist():
            rows = list(_groups_of(file))
            columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def row_groups(spark: SparkSession, path: str) -> DataFrame:
    """A row for each file, row group and column of the table at ``path``, a file or a folder."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path").mapInArrow(_read, GROUPS)


def columns(groups: DataFrame) -> DataFrame:
    """A row for each column: rows, nulls and bounds over all row groups. Nulls or bounds that one
    row group lacks are null."""
    whole = lambda c, known: F.when(F.bool_and(known), c)
    bounded, counted = F.col("bounded"), F.col("nulls").isNotNull()
    return groups.groupBy("column").agg(
        F.sum("rows").alias("rows"), whole(F.sum("nulls"), counted).alias("nulls"),
        whole(F.min("low"), bounded).alias("low"), whole(F.max("high"), bounded).alias("high"),
        whole(F.min("low_text"), bounded).alias("low_text"), whole(F.max("high_text"), bounded).alias("high_text"),
    )


def tables(groups: DataFrame) -> DataFrame:
    """One row: files, row groups, rows, bytes packed and unpacked, the largest row group's rows."""
    files = groups.groupBy("file", "row_group").agg(F.max("rows").alias("rows"), F.sum("packed").alias("packed"), F.sum("unpacked").alias("unpacked"))
    return files.agg(F.count_distinct("file").alias("files"), F.count("*").alias("row_groups"), F.sum("rows").alias("rows"), F.max("rows").alias("largest"), F.sum("packed").alias("packed"), F.sum("unpacked").alias("unpacked"))
