"""Document fingerprints from closed syncmers.

A text is a sequence of characters. Of its runs of K characters, those are anchors whose least
inner run of S characters, by hash, stands first or last: closed syncmers. Whether a run is an
anchor depends on its own characters alone, so shared passages have the same anchors wherever they
stand, one in about sixteen places. Where a window of inner runs holds one of low hash, its least
is low too: so low ones are compared, and all places of the rare stretches without any.

That is the coarse scale, which every text has. Texts of fewer than FINE characters have a fine one
as well: all their runs of S characters. Two texts are compared on the finest scale that both have;
FINE lies far above the length at which the coarse scale begins to tell texts apart, so neighbours
in length are compared alike on either side of it.

The fingerprint lists the anchors in text order, each with its character position (``hash@position``
on the coarse scale, ``hash:position`` on the fine one). Likeness of two
fingerprints is the share of common anchors among all (Jaccard); ``aligned`` matches by position:
the share of common anchors that keep their position.

Anchors are found once for each text. Those of an edited text are its own up to the cut, those of
the next text's beginning behind it, and what lies across the cut, which alone is looked at anew.

Main path in DataFrame functions only. Defined results: a null text is empty; an empty text has an
empty fingerprint, like another such text by 1 and any other by 0; a text without an anchor (of
fewer than S characters, or a long one by chance) has one anchor made of all of it; equal texts
have equal fingerprints; rows that repeat an id, or have none, follow each other by the hash of their texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import shared

#: Characters of an inner run, inner runs of a run, and the run's characters.
S, INNER = 4, 32
K = INNER + S - 1
#: Hashes below this count as low: a sixth. Saves comparisons and changes no result.
LOW = -(1 << 63) + (1 << 64) // 6
#: Texts of fewer characters have the fine scale too.
FINE = 8 * K
#: Minima are kept of so many neighbouring hashes; INNER is a multiple.
STEP = 4
#: Anchors are 48-bit numbers: 12 hex digits in a fingerprint.
ANCHOR_MASK = (1 << 48) - 1
#: Rows in a run of neighbouring ids, runs of which one window finds the neighbours, and how many
#: times the mean the fullest run may hold before ids are ranked instead of divided.
RUN_ROWS, RUNS_TOGETHER, UNEVEN_RUNS = 256, 65_536, 8
#: Ranges over which ids are ranked.
RANGES = 1024


def bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once for the row."""
    return F.transform(F.array(value), body)[0]


def _beside(a: Column, n: int, f) -> Column:
    """Each element of an array with the one ``n`` places on (null beyond the end)."""
    return F.zip_with(a, F.slice(a, F.lit(n + 1), F.greatest(F.size(a) - n, F.lit(0))), f)


def inner_hashes(text: Column, body) -> Column:
    """``body`` of the hashes of all runs of S characters, then a few of what is left at the end."""
    pair = lambda x, y: F.xxhash64(x, y)
    return bound(F.split(text, ""), lambda c: bound(_beside(c, 1, pair), lambda two: bound(_beside(two, 2, pair), body)))


def _struct(pos: Column, value: Column) -> Column:
    return F.struct(pos.cast("int").alias("pos"), value.bitwiseAND(ANCHOR_MASK).alias("anchor"))


def kmers(text: Column) -> Column:
    """Array of (pos, anchor) of the closed syncmers of a text."""
    least = lambda x, y: F.least(x, y)
    cover = sorted({*range(0, INNER, S), INNER - 1})  # inner runs that together cover the run

    def of_candidates(h: Column, n: Column, m: Column, at: Column) -> Column:
        # n: how many runs of S there are
        first = F.filter(at, lambda j: (j <= n - INNER) & (F.get(h, j) <= F.least(*[F.get(m, j + i) for i in range(0, INNER, STEP)])))
        last = F.filter(at, lambda j: (j >= INNER - 1) & (j < n) & (F.get(h, j) <= F.least(*[F.get(m, j - i) for i in range(STEP - 1, INNER, STEP)])))
        starts = F.array_sort(F.array_union(first, F.transform(last, lambda j: j - (INNER - 1))))
        return F.transform(starts, lambda i: _struct(i, F.xxhash64(*[F.get(h, i + j) for j in cover])))

    def of_hashes(h: Column) -> Column:
        n = F.size(h) - (S - 1)
        minima = bound(_beside(h, 1, least), lambda two: _beside(two, 2, least))
        low = F.array_compact(F.transform(h, lambda x, i: F.when(x < LOW, i)))

        def with_gaps(at: Column) -> Column:
            # places from one low one to the next, if a window of INNER fits between
            start = F.concat(F.array(F.lit(-1)), at)
            gaps = F.zip_with(start, F.concat(at, F.array(n)), lambda x, y: F.when(y - x > INNER, F.sequence(x + 1, y - 1)))
            return F.concat(at, F.flatten(F.array_compact(gaps)))

        return bound(minima, lambda m: bound(bound(low, with_gaps), lambda at: of_candidates(h, n, m, at)))

    none = F.array().cast("array<struct<pos:int,anchor:bigint>>")
    return F.when(F.length(text) < K, none).otherwise(inner_hashes(text, of_hashes))


def anchors(text: Column, found: Column | None = None) -> Column:
    """(coarse, fine): arrays of (pos, anchor) of a text, fine null for long ones; ``found`` are its
    syncmers, if known."""
    found = kmers(text) if found is None else found
    inner = inner_hashes(text, lambda h: F.transform(F.slice(h, F.lit(1), F.greatest(F.size(h) - (S - 1), F.lit(0))), lambda x, i: _struct(i, x)))
    whole = F.array(_struct(F.lit(0), F.xxhash64(text)))
    coarse = F.when((F.length(text) >= FINE) & (F.size(found) == 0), whole).otherwise(found)
    fine = F.when(F.length(text) == 0, F.slice(whole, 1, 0)).when(F.length(text) < S, whole).when(F.length(text) < FINE, inner)
    return F.struct(coarse.alias("coarse"), fine.alias("fine"))


def as_text(found: Column) -> Column:
    """The fingerprint: anchors in order as hash and position, both hexadecimal."""
    listed = lambda scale, mark: F.transform(scale, lambda a: F.concat(F.hex(a["anchor"]), F.lit(mark), F.hex(a["pos"])))
    return F.lower(F.array_join(F.concat(listed(found["coarse"], "@"), F.coalesce(listed(found["fine"], ":"), F.array().cast("array<string>"))), " "))


def _on_one_scale(a: Column, b: Column, body) -> Column:
    """``body`` of the anchors of two texts on the finest scale that both have."""
    fine = a["fine"].isNotNull() & b["fine"].isNotNull()
    both = F.when(fine, F.struct(a["fine"].alias("x"), b["fine"].alias("y"))).otherwise(F.struct(a["coarse"].alias("x"), b["coarse"].alias("y")))
    return bound(both, lambda p: body(p["x"], p["y"]))


def likeness(a: Column, b: Column) -> Column:
    """Common anchors among all anchors of two texts (see ``anchors``)."""

    def share(x: Column, y: Column) -> Column:
        both, any_ = F.size(F.array_intersect(x["anchor"], y["anchor"])), F.size(F.array_union(x["anchor"], y["anchor"]))
        return F.when(any_ == 0, F.lit(1.0)).otherwise(both / any_)

    return _on_one_scale(a, b, share)


def aligned(a: Column, b: Column) -> Column:
    """Anchors that stand at the same position in both, among all anchors."""
    placed = lambda found: F.transform(found, lambda i: F.xxhash64(i["pos"], i["anchor"]))  # noqa: E731  sets of numbers meet by hash, sets of structs pair by pair

    def share(x: Column, y: Column) -> Column:
        any_ = F.size(F.array_union(x["anchor"], y["anchor"]))
        return F.when(any_ == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.size(F.array_intersect(placed(x), placed(y))) / any_))

    return _on_one_scale(a, b, share)


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", more=None) -> DataFrame:
    """doc_id, text and next_text: of the row after it by descending id, after the last the first.
    ``more`` (a name and an expression of the text) is worked out once for each row and given as
    that name and next_ that name.

    Ids are dealt into runs of neighbours; each run also gets the first row of the following run
    (one row more for a run), so each is looked through alone and texts are shuffled once. Equal
    ids are ordered by the hash of their texts, null ids come last.
    """
    shared.prepare(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    total, nulls, low, high = rows.agg(F.count(F.lit(1)), F.count_if(F.col("doc_id").isNull()), F.min("doc_id"), F.max("doc_id")).first()
    runs = max(1, total // RUN_ROWS)
    # null ids: by the hash, in runs behind all others
    null_runs = max(1, nulls // RUN_ROWS)
    run = F.lit(runs + 1) + F.floor((F.col("th") / F.lit(2.0**64) + 0.5) * null_runs)
    if low is not None:
        width = max(1.0, (high - low + 1) / runs)
        run = F.coalesce(F.floor((F.lit(float(high)) - F.col("doc_id").cast("double")) / F.lit(width)), run)
    rows = rows.withColumn("run", run.cast("long"))
    firsts = shared.stored(_firsts(rows), "syncmer-runs", narrow=True)
    fullest = firsts.filter("doc_id is not null").agg(F.max("n")).first()[0] or 0
    if fullest > UNEVEN_RUNS * max(RUN_ROWS, total / runs):
        rows = _ranked(rows.drop("run"))
        firsts = shared.stored(_firsts(rows), "syncmer-runs", narrow=True)
    heads = _heads(firsts)
    same = F.col("doc_id").eqNullSafe(F.col("head")) & (F.col("th") == F.col("head_th"))
    both = rows.join(shared.small(heads, heads.count()), same, "left")
    here = F.struct(F.col("run"), F.lit(0).alias("extra"))
    there = F.struct(F.col("also").alias("run"), F.lit(1).alias("extra"))
    both = both.select("doc_id", "text", "th", F.explode(F.when(F.col("also").isNull(), F.array(here)).otherwise(F.array(here, there))).alias("at"))
    both = both.select("doc_id", "text", "th", "at.run", "at.extra")
    place = [F.asc("extra"), F.desc_nulls_last("doc_id"), F.asc("th")]
    # what is worked out for each text stands between the shuffle and the window
    dealt = both.repartition("run").sortWithinPartitions("run", *place)
    carried = ["text"] + ([more[0]] if more else [])
    if more:
        dealt = dealt.withColumn(more[0], more[1](F.col("text")))
    order = Window.partitionBy("run").orderBy(*place)
    out = dealt.select("doc_id", *carried, "extra", *[F.lead(c).over(order).alias(f"next_{c}") for c in carried])
    return out.filter("extra = 0").drop("extra")


def _firsts(rows: DataFrame) -> DataFrame:
    """For each run its number of rows and its first row (greatest id, then least hash)."""
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.bitwise_not("doc_id").alias("order"), "th", "doc_id")
    return rows.groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("k")).select("run", "n", "k.doc_id", "k.th")


def _heads(firsts: DataFrame) -> DataFrame:
    """First rows of runs (head, head_th), each with the run before it (also), for the first run
    the last one. Neighbours are found among RUNS_TOGETHER runs, and among such groups."""
    group = F.shiftright("run", RUNS_TOGETHER.bit_length() - 1)
    firsts = firsts.select("run", F.col("doc_id").alias("head"), F.col("th").alias("head_th"), group.alias("group"))
    groups = firsts.groupBy("group").agg(F.max("run").alias("last"))
    groups = groups.select("group", F.lag("last").over(Window.orderBy("group")).alias("before"), F.max("last").over(Window.partitionBy(F.lit(1))).alias("end"))
    joined = firsts.join(groups, "group")
    also = F.coalesce(F.lag("run").over(Window.partitionBy("group").orderBy("run")), "before", "end")
    return joined.select("head", "head_th", also.alias("also"))


def _ranked(rows: DataFrame) -> DataFrame:
    """Runs of even size for ids that crowd together: ids and hashes are dealt by range and
    numbered within it. Costs a second shuffle of the texts."""
    order = [F.desc_nulls_last("doc_id"), F.asc("th")]
    spread = rows.select("doc_id", "th").distinct().repartitionByRange(RANGES, *order).withColumn("part", F.spark_partition_id().cast("long"))
    spread = shared.stored(spread, "syncmer-ranges")
    place = F.floor((F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1) / RUN_ROWS)
    ids = spread.select(F.col("doc_id").alias("id"), F.col("th").alias("id_th"), (F.col("part") * F.lit(1 << 40) + place).cast("long").alias("run"))
    ids = shared.stored(ids, "syncmer-ranked")
    return rows.join(ids, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("th") == F.col("id_th"))).drop("id", "id_th")


def half_edited(text: Column, next_text: Column) -> Column:
    """The last half of the code points replaced by the first as many of the next text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(next_text, F.lit(1), half))


def edited_kmers(text: Column, next_text: Column, edited: Column, own: Column, following: Column) -> Column:
    """The syncmers of ``edited`` (see ``half_edited``) from those of the two texts."""
    half = F.floor(F.length(text) / 2).cast("int")
    cut = F.length(text) - half
    # lengths are worked out once for the row, not for each anchor
    ends = F.struct(cut.alias("cut"), F.least(half, F.length(next_text)).alias("taken"), F.greatest(cut - (K - 1), F.lit(0)).alias("begin"))
    moved = lambda found, by: F.transform(found, lambda a: F.struct((a["pos"] + by).cast("int").alias("pos"), a["anchor"].alias("anchor")))

    def parts(x: Column) -> Column:
        across = kmers(F.substring(edited, x["begin"] + 1, x["cut"] + F.least(x["taken"], F.lit(K - 1)) - x["begin"]))
        return F.concat(F.filter(own, lambda a: a["pos"] <= x["cut"] - K), moved(across, x["begin"]), moved(F.filter(following, lambda a: a["pos"] <= x["taken"] - K), x["cut"]))

    return bound(ends, parts)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its fingerprint, that of its edited text, and likeness to it and to the next
    document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, aligned_edited."""
    rows = with_next(docs, doc_id, text, ("kmers", kmers)).withColumn("edited", half_edited(F.col("text"), F.col("next_text")))
    three = F.array(
        anchors(F.col("text"), F.col("kmers")),
        anchors(F.col("edited"), edited_kmers(F.col("text"), F.col("next_text"), F.col("edited"), F.col("kmers"), F.col("next_kmers"))),
        anchors(F.col("next_text"), F.col("next_kmers")),
    )
    said = lambda x: F.struct(as_text(x[0]).alias("own"), as_text(x[1]).alias("edited"), likeness(x[0], x[1]).alias("near_edited"), likeness(x[0], x[2]).alias("near_next"), aligned(x[0], x[1]).alias("aligned_edited"))
    found = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), bound(three, said).alias("f"))
    return found.select("doc_id", "n_chars", "edited_sha256", F.col("f.own").alias("fingerprint"), F.col("f.edited").alias("edited_fingerprint"), "f.near_edited", "f.near_next", "f.aligned_edited")
