"""Near-duplicate groups by MinHash bands and odd sketches, links confirmed on full sets.

A document's set holds its distinct runs of five words. Documents with equal sets form a class,
and one row stands for it from then on, so copies never meet each other. For each class MinHash
samples are taken; they are cut into bands for candidates, and folded into an odd sketch, a
bitmap of parities: the population count of two sketches' XOR estimates how many samples differ,
precisely where similarity is high. A second odd sketch folds the whole set: there each element
on one side only flips one bit, so the XOR's population count never exceeds the number of such
elements, and a pair beyond the bound is ruled out for certain. Only pairs whose sketches allow
the similarity are confirmed exactly, on the full sets of the whole texts.

Pairs of a bucket are not made rows of. What is wanted are connected groups, so a bucket's members
are first compared with its smallest member only (each member with one such partner, then, where
still apart, with the others), and components are merged. What is left are buckets whose members
still lie in different components: there the members meet by their sketches, within one worker for
a bucket of up to BLOCK_ROWS members. A larger bucket is cut into blocks of that size, and each
pair of blocks is a piece of work of its own; a member is copied once for each block, so a bucket
of n members takes n * n / BLOCK_ROWS rows of sketches and no more memory than two blocks. Only
pairs of different components that the sketches allow come out. Every pair of different components
that shares a band is thus examined.

Bands miss a pair at the limit (0.75) with a chance of (1 - 0.75^5)^48, about 2 in a million;
the sketch bound lies five standard deviations below it. Shingles are compared by 64-bit hashes:
two different shingles of a pair of texts with n shingles in all are taken for equal with a chance
of about n^2 / 2^65, below one in a million for a million shingles.

Defined results: a null or blank text has an empty set and is linked with nothing; a text of
fewer than five words has one element, its whole word sequence; rows that repeat a doc_id count
as one document; a null doc_id is smaller than all others; an empty table gives an empty result;
columns other than the id and the text are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

WORDS, PERCENT = 5, 75
BANDS, BAND_ROWS = 48, 5
SAMPLES = BANDS * BAND_ROWS
SKETCH_WORDS = 16
SKETCH_BITS = 64 * SKETCH_WORDS
#: Words of the odd sketch of the whole set.
PARITY_WORDS = 32
#: Pairs less alike than this by their sketches are not confirmed.
LEAST_ESTIMATE = PERCENT / 100 - 5 * math.sqrt(PERCENT / 100 * (1 - PERCENT / 100) / SAMPLES) - 0.03
#: Members compared with one partner in one call, and members of a block of a bucket.
PART_ROWS, BLOCK_ROWS = 64, 2048
#: Words whose hashes a worker remembers: some 8 MB.
CACHED_WORDS = 50_000
NO_ID = -(1 << 63)

SIGNATURES = "did long, th long, n_shingles long, d1 long, d2 long, sketch array<long>, parity array<long>, bands array<long>"


def most_different(estimate: float = LEAST_ESTIMATE) -> int:
    """The largest XOR population count of two sketches whose estimate is at least this."""
    differing = 2 * SAMPLES * (1 - estimate)
    return math.floor(SKETCH_BITS / 2 * (1 - math.exp(-2 * differing / SKETCH_BITS)))


class WordHashes(dict):
    """64-bit hashes of words, remembered in this worker process."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = found = xxh3_64_intdigest(word)
        return found


_HASHES = WordHashes()


def _mixed(x):
    import numpy as np

    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingles(text: bytes):
    """The set of a text as sorted distinct 64-bit hashes."""
    import numpy as np
    from xxhash import xxh3_64_intdigest

    words = text.lower().split()  # bytes: A-Z alone change, ASCII white space alone splits
    if not words:
        return np.empty(0, dtype="u8")
    if len(words) < WORDS:
        return np.array([xxh3_64_intdigest(b" ".join(words), seed=len(words))], dtype="u8")
    w = np.fromiter(map(_HASHES.__getitem__, words), dtype="u8", count=len(words))
    n = len(words) - WORDS + 1
    h = w[:n]
    for i in range(1, WORDS):
        h = h * np.uint64(0xD6E8FEB86659FD93) + w[i : i + n]
    return np.unique(_mixed(h))


def folded(hashes, words: int):
    """The parity bitmap of hashes, as so many 64-bit words (a power of two)."""
    import numpy as np

    size = 64 * words
    bits = (hashes >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)
    return np.packbits((np.bincount(bits, minlength=size) & 1).astype("u1")).view("<i8")


class Sampler:
    """MinHash samples of sets, their bands and odd sketches."""

    def __init__(self, seed: int = 1):
        import numpy as np

        rng = np.random.default_rng(seed)
        draw = lambda n: rng.integers(0, 1 << 63, n, dtype="u8") * np.uint64(2) + np.uint64(1)
        self.factor, self.flip = draw(SAMPLES)[:, None], draw(SAMPLES)[:, None]
        self.place, self.base = draw(SAMPLES), draw(BAND_ROWS)
        self.band = draw(BANDS)

    def samples(self, found):
        import numpy as np

        least = None
        for at in range(0, len(found), 2048):
            part = ((found[None, at : at + 2048] ^ self.flip) * self.factor).min(axis=1)
            least = part if least is None else np.minimum(least, part)
        return least

    def bands(self, samples):
        return _mixed((_mixed(samples).reshape(BANDS, BAND_ROWS) * self.base).sum(axis=1, dtype="u8") + self.band)

    def sketch(self, samples):
        import numpy as np

        return folded(_mixed(samples * self.place), SKETCH_WORDS)


def _signatures(batches: Iterator) -> Iterator:
    import numpy as np
    import pyarrow as pa
    from xxhash import xxh3_128_digest

    sampler = Sampler()
    try:
        for batch in batches:
            sizes, digests, sketches, parities, bands = [], [], [], [], []
            for text in shared.text_bytes(batch.column(2)):
                found = shingles(text)
                sizes.append(len(found))
                digests.append(xxh3_128_digest(found.tobytes()))
                if len(found):
                    samples = sampler.samples(found)
                    sketches.append(sampler.sketch(samples))
                    parities.append(folded(found, PARITY_WORDS))
                    bands.append(sampler.bands(samples).view("<i8"))
                else:
                    sketches.append([])
                    parities.append([])
                    bands.append([])
            halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(sketches, pa.list_(pa.int64())), pa.array(parities, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64()))],
                names=["did", "th", "n_shingles", "d1", "d2", "sketch", "parity", "bands"],
            )
    finally:
        shared.let_go()


def linked(a, b) -> bool:
    """Whether two sets (sorted, distinct) are alike enough."""
    import numpy as np

    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


def fresh(df: DataFrame) -> DataFrame:
    """The same columns as new ones, so that two sides from one table can be told apart."""
    return df.select([F.col(c).alias(c) for c in df.columns])


def _confirm(key, members, hubs):
    """Of the members' texts those linked with a text of their hub."""
    import pyarrow as pa

    against = [shingles(t) for t in shared.text_bytes(hubs.column("text").combine_chunks())]
    good = [any(linked(found, h) for h in against) for found in map(shingles, shared.text_bytes(members.column("text").combine_chunks()))]
    return members.select(["hub", "member"]).filter(pa.array(good, pa.bool_()))


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (hub, member) that are linked. ``texts``: id, text. A hub's members are dealt in
    parts of bounded size, each with the hub's text."""
    parts = shared.stored(pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).cast("int").alias("parts")), "near-parts", narrow=True)
    members = pairs.join(parts, "hub").withColumn("part", F.pmod(F.xxhash64("member"), F.col("parts")).cast("int")).select("hub", "part", "member")
    members = members.join(texts.withColumnRenamed("id", "member"), "member").select("hub", "part", "member", "text")
    hubs = parts.join(texts.withColumnRenamed("id", "hub"), "hub").select("hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "text")
    found = members.groupBy("hub", "part").cogroup(fresh(hubs).groupBy("hub", "part")).applyInArrow(_confirm, "hub long, member long")
    return shared.stored(found, "near-links", narrow=True)


def merge(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links: (id, root) with (a, b) between ids, as a new (id, root).

    Works on the graph of roots: least label of the neighbours, then the label's own label, until
    nothing changes; the rounds number about the logarithm of a component's diameter. Only roots
    that have a link take part. Roots are the smallest ids of their components.
    """
    ends = roots.select(F.col("id").alias("a"), F.col("root").alias("x")), roots.select(F.col("id").alias("b"), F.col("root").alias("y"))
    edges = links.select("a", "b").join(ends[0], "a").join(ends[1], "b").filter("x != y").select("x", "y")
    edges = shared.stored(edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "near-edges", narrow=True)
    if edges.isEmpty():
        return roots
    labels = shared.stored(edges.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("label")), "near-labels", narrow=True)
    while True:
        near = edges.join(labels.select(F.col("x").alias("y"), F.col("label").alias("near")), "y").groupBy("x").agg(F.min("near").alias("near"))
        least = labels.join(near, "x").select("x", F.least("label", "near").alias("least"), F.col("label").alias("was"))
        least = shared.stored(least, "near-labels", narrow=True)
        jump = least.select(F.col("x").alias("least"), F.col("least").alias("far"))
        after = least.join(jump, "least", "left").select("x", F.least("least", F.coalesce("far", "least")).alias("label"), "was")
        after = shared.stored(after, "near-labels", narrow=True)
        shared.dropped(labels, least)
        labels = after.select("x", "label")
        labels.stored_at = after.stored_at
        if after.filter("label != was").isEmpty():
            break
    moved = labels.withColumnRenamed("x", "root")
    shared.dropped(edges)
    return shared.stored(roots.join(moved, "root", "left").select("id", F.coalesce("label", "root").alias("root")), "near-roots", narrow=True)


def _possible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (hub, member) whose sizes and sketches allow a link. Nothing that needs a hub's
    rows together follows the join, so a hub of many members can be split among tasks."""
    side = lambda name, i: nodes.select(F.col("id").alias(name), F.col("n_shingles").alias(f"n{i}"), F.col("sketch").alias(f"s{i}"), F.col("parity").alias(f"p{i}"))
    both = pairs.join(side("member", 1), "member").join(side("hub", 2), "hub")
    sizes = 100 * F.least("n1", "n2") >= PERCENT * F.greatest("n1", "n2")
    differing = lambda c, words: reduce(lambda x, y: x + y, [F.bit_count(F.get(f"{c}1", F.lit(i)).bitwiseXOR(F.get(f"{c}2", F.lit(i)))) for i in range(words)])
    bound = (100 + PERCENT) * differing("p", PARITY_WORDS) <= (100 - PERCENT) * (F.col("n1") + F.col("n2"))
    return both.filter(sizes & (differing("s", SKETCH_WORDS) <= most_different()) & bound).select("hub", "member")


def _across(ids, roots, sizes, sketches, parities, left, right) -> Iterator[tuple[int, int]]:
    """Pairs of rows (left places, right places) of different components that may be linked. With
    ``right`` None the pairs are those within ``left``."""
    import numpy as np

    for n, i in enumerate(left.tolist()):
        others = left[n + 1 :] if right is None else right
        others = others[(roots[others] != roots[i]) & (100 * np.minimum(sizes[others], sizes[i]) >= PERCENT * np.maximum(sizes[others], sizes[i]))]
        if not len(others):
            continue
        others = others[np.bitwise_count(sketches[others] ^ sketches[i]).sum(axis=1, dtype=np.int64) <= most_different()]
        if not len(others):
            continue
        apart = np.bitwise_count(parities[others] ^ parities[i]).sum(axis=1, dtype=np.int64)
        for j in others[(100 + PERCENT) * apart <= (100 - PERCENT) * (sizes[others] + sizes[i])].tolist():
            yield min(ids[i], ids[j]), max(ids[i], ids[j])


def _bucket_pairs(batches: Iterator) -> Iterator:
    """Rows (key, low, high, block, id, root, n_shingles, sketch, parity), those of a key and pair
    of blocks together: the pairs of each. Holds one such group at a time."""
    import numpy as np
    import pyarrow as pa

    def pairs(group) -> pa.RecordBatch:
        column = lambda c: group.column(c).to_numpy()
        words = lambda c, n: group.column(c).combine_chunks().flatten().to_numpy().reshape(-1, n).view("<u8")
        block, low, high = column("block"), group.column("low")[0].as_py(), group.column("high")[0].as_py()
        args = column("id"), column("root"), column("n_shingles"), words("sketch", SKETCH_WORDS), words("parity", PARITY_WORDS)
        sides = (np.arange(len(block)), None) if low == high else (np.flatnonzero(block == low), np.flatnonzero(block == high))
        found = sorted(set(_across(*args, *sides)))
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["hub", "member"])

    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        if not rows.num_rows:
            continue
        places = [rows.column(c).to_numpy() for c in ("key", "low", "high")]
        edges = [0, *(np.flatnonzero(np.any([x[1:] != x[:-1] for x in places], axis=0)) + 1).tolist(), rows.num_rows]
        for a, b in zip(edges[:-2], edges[1:-1], strict=True):
            if b - a > 1:
                yield pairs(rows.slice(a, b - a))
        held = rows.slice(edges[-2])
    if held is not None and held.num_rows > 1:
        yield pairs(held)


def _rest(owned: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (hub, member) within buckets whose members still lie in different components.
    ``owned``: id and the keys of its buckets; ``nodes``: id, n_shingles, sketch, parity. Sketches
    are joined once for each id, before its rows are copied for its buckets."""
    keys = owned.join(roots, "id").select("root", F.explode("keys").alias("key")).groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count(F.lit(1)).alias("n"))
    keys = shared.stored(keys.filter("least != most").select("key", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks")), "near-apart", narrow=True)
    apart = owned.select("id", F.explode("keys").alias("key")).join(keys, "key").groupBy("id").agg(F.collect_list(F.struct("key", "blocks")).alias("buckets"))
    apart = shared.stored(apart, "near-members", narrow=True)
    full = apart.join(roots, "id").join(nodes.select("id", "n_shingles", "sketch", "parity"), "id")
    full = full.withColumn("bucket", F.explode("buckets")).withColumn("block", F.pmod(F.xxhash64("id"), F.col("bucket.blocks")).cast("int"))
    # each block meets itself and every other one
    full = full.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("bucket.blocks") - 1)))
    full = full.select("bucket.key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "id", "root", "n_shingles", "sketch", "parity")
    dealt = full.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return dealt.mapInArrow(_bucket_pairs, "hub long, member long").distinct()


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    return classed(docs, doc_id, text).drop("th", "d1", "d2")


def classed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``components``, with the text's hash (th) and the class of equal sets (d1, d2)."""
    parts = shared.parts_of(docs)
    shared.prepare(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("did"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    signed = shared.stored(rows.mapInArrow(_signatures, SIGNATURES), "near-signatures")
    filled = signed.filter("n_shingles > 0")
    classes = shared.stored(filled.groupBy("d1", "d2").agg(F.min("did").alias("id")), "near-classes", narrow=True)
    nodes = filled.join(classes, ["d1", "d2"]).filter("did = id").select("id", "d1", "d2", "n_shingles", "sketch", "parity", "bands").dropDuplicates(["id", "d1", "d2"])
    nodes = shared.stored(nodes, "near-nodes", parts=parts)
    # what is asked of all rows from here on; the signatures of copies go
    signed, bulky = shared.stored(signed.select("did", "th", "n_shingles", "d1", "d2"), "near-rows", narrow=True), signed
    shared.dropped(bulky)
    filled = signed.filter("n_shingles > 0")
    slim = nodes.select("id", "n_shingles", "sketch", "parity")
    buckets = nodes.select("id", F.explode("bands").alias("key")).groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last"))
    buckets = shared.stored(buckets.filter("hub != last").drop("last"), "near-buckets", narrow=True)
    shares = shared.stored(nodes.select("id", F.explode("bands").alias("key")).join(buckets, "key"), "near-shares", narrow=True)
    owned = shared.stored(shares.groupBy("id").agg(F.collect_list("key").alias("keys")), "near-owned", narrow=True)
    stars = shares.filter("hub != id").select("hub", F.col("id").alias("member")).distinct()
    possible = shared.stored(_possible(stars, slim), "near-possible", narrow=True)

    def texts_of(ids: DataFrame) -> DataFrame:
        """Texts of these ids only: those that may have a link."""
        ids = shared.stored(ids.distinct(), "near-ids", narrow=True)
        found = rows.select(F.col("did").alias("id"), "text").join(ids.hint("merge"), "id", "left_semi")
        return shared.stored(found, "near-texts", parts=parts)

    roots = shared.stored(nodes.select("id", F.col("id").alias("root")).distinct(), "near-roots", narrow=True)
    # rows that repeat an id hold it together
    twice = filled.join(classes, ["d1", "d2"]).filter("did != id").select(F.col("did").alias("a"), F.col("id").alias("b")).join(roots.select(F.col("id").alias("a")), "a", "left_semi")
    links = lambda pairs, texts: confirmed(pairs, texts).select(F.col("hub").alias("a"), F.col("member").alias("b"))
    if not possible.isEmpty():
        texts = texts_of(possible.select(F.col("hub").alias("id")).unionByName(possible.select(F.col("member").alias("id"))))
        first = shared.stored(possible.groupBy("member").agg(F.min("hub").alias("hub")), "near-first", narrow=True)
        roots = merge(roots, links(first, texts).unionByName(twice))
        others = possible.join(first, ["member", "hub"], "left_anti")
        apart = others.join(roots.select(F.col("id").alias("hub"), F.col("root").alias("x")), "hub").join(roots.select(F.col("id").alias("member"), F.col("root").alias("y")), "member")
        apart = shared.stored(apart.filter("x != y").select("hub", "member"), "near-second", narrow=True)
        if not apart.isEmpty():
            roots = merge(roots, links(apart, texts))
        shared.dropped(texts)
        rest = shared.stored(_rest(owned, slim, roots).join(possible, ["hub", "member"], "left_anti"), "near-rest", narrow=True)
        if not rest.isEmpty():
            texts = texts_of(rest.select(F.col("hub").alias("id")).unionByName(rest.select(F.col("member").alias("id"))))
            roots = merge(roots, links(rest, texts))
            shared.dropped(texts)
    else:
        roots = merge(roots, twice)
    shared.dropped(nodes, shares, owned)
    grouped = signed.join(classes, ["d1", "d2"], "left").join(roots, "id", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("root")).otherwise(F.col("did"))
    named = lambda c: F.when(c != NO_ID, c)
    return grouped.select(named(F.col("did")).alias("doc_id"), "n_shingles", named(component).alias("component_id"), (F.col("did") == component).alias("kept"), "th", "d1", "d2")
