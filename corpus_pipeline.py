"""The corpus pipeline: toxicity, line dedup, near-dedup, mixing to target weights, packing.

Each stage takes (spark, docs, sf_dir), works on all rows of its predecessor and returns the
columns of ``documents`` again, but for the last, which returns the packed sequences by piece: the
ids of a sequence stand, padded, in the row of its first piece. The driver (or
``run``) writes each result as Parquet and reads it for the next stage.

For every stage: a null text counts as empty; an empty table gives an empty table with the same
columns; columns beyond those of ``documents`` are not carried on, whatever their names; no plan
depends on the size of the table. Results are written in parts of a sensible size (see
``shared.parts_of``), not in one for each small part that was read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.llm import linededup, mixing, neardup, packing, shared, toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Words that a task of the last stage remembers: fewer than alone, as the executors of a long run
#: hold more by then.
CACHED_WORDS = 60_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model rejects go; it is fitted on labelled rows of ``docs``.

    Each row is judged by its own text: empty texts stay, rows that repeat fare alike. Without
    labels of both kinds all documents stay."""
    model = toxicity.train(docs, shared.table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select(*COLUMNS), model).filter("not toxic").select("row.*").coalesce(shared.parts_of(docs))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in many documents stay in one of them; documents keep the rest.

    Every row stays, with the text that is left (perhaps empty) and its length. Rows that repeat an
    id are one document; a null id is an id like others, below all of them."""
    out = linededup.dedup_lines(docs.select(*COLUMNS))
    text = F.col("kept_text")
    return out.select("row.doc_id", text.alias("text"), "row.lang", "row.source", F.length(text).cast("long").alias("n_chars")).coalesce(shared.parts_of(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest id.

    Documents without words have no copies and stay. Of rows that repeat an id, or have none, one
    stays for each set of shingles: of these the one with the least hash of its text, then by
    language, source and length, so that a repeated run keeps the same rows."""
    kept = neardup.classed(docs).filter("kept").groupBy("doc_id", "d1", "d2").agg(F.min("th").alias("th"))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(neardup.NO_ID)).alias("did")
    kept = shared.stored(kept.select(key, "th").distinct(), "kept-ids", narrow=True)
    rows = docs.select(*COLUMNS, key, F.xxhash64("text").alias("th")).join(kept.hint("merge"), ["did", "th"], "left_semi")
    place = F.row_number().over(Window.partitionBy("did", "th").orderBy("lang", "source", "n_chars"))
    return rows.withColumn("place", place).filter("place = 1").select(*COLUMNS).coalesce(shared.parts_of(docs))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it: not at all, once or repeatedly, at most
    three times.

    A row's id and source decide, so rows that repeat an id within a source fare alike; a null
    source is a source of its own. A document without words may be taken like any other."""
    sized = mixing.sizes(docs.select(*COLUMNS))
    bounds = mixing.limits(shared.stored(sized.select("key", "size", "h"), "mix-sizes", narrow=True))
    copies = mixing.taken(sized, bounds).filter("repeats > 0")
    return copies.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("repeats")))).select("row.*").coalesce(shared.parts_of(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, cut into sequences of tokens.

    Rows that repeat are packed once each; an empty text is its end id alone; a null id stays
    null."""
    return packing.with_pieces(packing.sequences(docs, cached=CACHED_WORDS)).coalesce(shared.parts_of(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_shared_lines),
    ("near dedup", drop_near_copies),
    ("mix", mix_to_targets),
    ("pack", pack),
]

#: SQL cannot express the fitted model of the first stage, nor the tokens of the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES, 1):
        if place < len(STAGES):
            done = docs
            docs = shared.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
            shared.dropped(done)  # what the stage after it has been written from
        else:
            docs = stage(spark, docs, sf_dir)
    return docs
