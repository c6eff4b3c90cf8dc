"""Mixing sources to target weights by hash-threshold histograms.

A document's place in its source is a hash of its id, so a budget of words is the set of
documents whose hash lies below a threshold. The threshold is found without sorting: words are
summed by source and hash bucket, the bucket in which the budget runs out is refined into finer
buckets, and the rest of the rows is never looked at again. Budgets are nested: a larger target
takes a superset.

Defined results: a null text has size 0; a null source is a source of its own, last in order; a
source without words has target 0; a document without words is taken as often as its neighbours
by hash, at most three times; rows that repeat a doc_id are taken or left together (a null
doc_id hashes like the empty string); an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import shared

#: Bits of the hash (the first 15 hex digits of the id's MD5) and bits that one pass resolves.
HASH_BITS = 60
PASS_BITS = 12
MAX_REPEATS = 3
WEIGHT_CYCLE = (1, 2, 3)


def id_hash(doc_id: Column) -> Column:
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A join key that has no null: equality on it means the same source."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def water_fill(totals: DataFrame, repeats: int = MAX_REPEATS) -> DataFrame:
    """Targets by weight that share the sum of all sizes, none above ``repeats`` sizes.

    ``totals``: key, source_size, weight; one row for each source. What a capped source leaves is
    shared again by weight. Capped sources are those of least size for their weight, so in that
    order the level is known from running sums, without iteration.
    """
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "key")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(F.col("source_size") * repeats).over(before), F.lit(0))
    weights = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levels = totals.withColumn("cap", F.col("source_size") * repeats).withColumn("left_words", left).withColumn("left_weight", weights)
    levels = levels.withColumn("open", F.col("cap") * F.col("left_weight") > F.col("weight") * F.col("left_words"))
    first = F.min(F.when(F.col("open"), F.struct(F.col("source_size") / F.col("weight"), "key", "left_words", "left_weight"))).over(everything)
    levels = levels.withColumn("first", first)
    level = F.col("weight") * F.col("first.left_words") / F.col("first.left_weight")
    return levels.select("key", "source_size", "weight", F.when(F.col("open"), level).otherwise(F.col("cap").cast("double")).alias("target"))


def cycle_weights(totals: DataFrame, cycle: tuple[int, ...] = WEIGHT_CYCLE) -> DataFrame:
    """Sources by code point, null last, weigh as the cycle says. One row for each source."""
    place = F.row_number().over(Window.orderBy(F.col("key") == "n", "key")) - 1
    weights = F.array(*[F.lit(w) for w in cycle])
    return totals.withColumn("weight", F.element_at(weights, (place % len(cycle) + 1).cast("int")).cast("long"))


def thresholds(sized: DataFrame, targets: DataFrame, n_sources: int) -> DataFrame:
    """For each source the number of whole rounds and the hash below which one more is taken.

    Returns key, source_size, target, rounds, edge (hash of the boundary) and edge_in (whether the
    rows at the boundary are taken: if that comes nearer to the target).
    """
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    state = targets.withColumn("rounds", rounds).withColumn("need", F.col("target") - F.col("rounds") * F.col("source_size"))
    state = state.select("key", "source_size", "target", "rounds", "need", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("acc"), F.lit(None).cast("long").alias("edge"), F.lit(0).cast("long").alias("edge_words"))
    for level in range(1, HASH_BITS // PASS_BITS + 1):
        shift = HASH_BITS - PASS_BITS * level
        open_ = shared.small(state.filter("edge is null").select("key", "prefix"), n_sources)
        rows = sized.join(open_, "key").filter(F.shiftright("h", shift + PASS_BITS) == F.col("prefix"))
        bars = rows.groupBy("key", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("words"), F.min("h").alias("lo"), F.max("h").alias("hi"))
        so_far = Window.partitionBy("key").orderBy("bucket")
        bars = bars.withColumn("cum", F.sum("words").over(so_far)).join(shared.small(state.filter("edge is null").select("key", "need", "acc"), n_sources), "key")
        bars = bars.filter(F.col("acc") + F.col("cum") > F.col("need"))
        cut = bars.groupBy("key").agg(F.min(F.struct("bucket", "cum", "words", "lo", "hi")).alias("b"))
        cut = cut.select("key", F.col("b.bucket").alias("b_bucket"), (F.col("b.cum") - F.col("b.words")).alias("b_before"), F.col("b.words").alias("b_words"), F.when((F.col("b.lo") == F.col("b.hi")) | F.lit(shift == 0), F.col("b.lo")).alias("b_edge"))
        joined = state.join(cut, "key", "left")
        found = F.col("edge").isNull() & F.col("b_bucket").isNotNull()
        state = joined.select(
            "key", "source_size", "target", "rounds", "need",
            F.when(found, F.col("b_bucket")).otherwise(F.col("prefix")).alias("prefix"),
            F.when(found, F.col("acc") + F.col("b_before")).otherwise(F.col("acc")).alias("acc"),
            # a source in which the budget never runs out has no words: its edge lies at 0
            F.coalesce("edge", F.when(F.col("b_bucket").isNull(), F.lit(0)), "b_edge").cast("long").alias("edge"),
            F.when(found, F.col("b_words")).otherwise(F.col("edge_words")).alias("edge_words"),
        )
        state = shared.stored(state, "mix-level", narrow=True)
        if state.filter("edge is null").isEmpty():
            break
    return state.select("key", "source_size", "target", "rounds", "edge", (2 * (F.col("need") - F.col("acc")) >= F.col("edge_words")).alias("edge_in"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken and repeats (times the mix takes it).

    The texts are read once, into a narrow table in the shared folder; every pass works on that.
    """
    sized = shared.stored(sizes(docs, doc_id, text, source).select("doc_id", "key", "size", "h"), "mix-sizes", narrow=True)
    return taken(sized, limits(sized))


def sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents as a struct ``row``, with doc_id, key (of the source), size and h (hash of the
    id), which are all that a mix asks for."""
    shared.prepare(docs.sparkSession)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(row, F.col(doc_id).alias("doc_id"), source_key(F.col(source)).alias("key"), word_count(F.col(text)).alias("size"), id_hash(F.col(doc_id)).alias("h"))


def limits(sized: DataFrame) -> DataFrame:
    """What the mix takes of each source: see ``thresholds``. ``sized``: key, size, h."""
    totals = shared.stored(sized.groupBy("key").agg(F.sum("size").alias("source_size")), "mix-totals", narrow=True)
    return thresholds(sized, water_fill(cycle_weights(totals)), totals.count())


def taken(sized: DataFrame, bounds: DataFrame) -> DataFrame:
    """``sized`` (key, size, h and any others) with source_size, target, repeats and taken. A row's
    own columns and the bounds of its source decide, so no row is joined to another."""
    extra = (F.col("h") < F.col("edge")) | ((F.col("h") == F.col("edge")) & F.col("edge_in"))
    out = sized.join(shared.small(bounds, bounds.count()), "key")
    # a document without words lies before any edge: it is held to the bound like all others
    out = out.withColumn("repeats", F.least(F.col("rounds") + extra.cast("long"), F.lit(MAX_REPEATS)))
    return out.withColumn("taken", F.col("size") * F.col("repeats")).drop("rounds", "edge", "edge_in")
