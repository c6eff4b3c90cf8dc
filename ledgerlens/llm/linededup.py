"""Reversible line dedup: exact reference counts with sharded cuckoo filters before them.

The state is a log of postings: for each document and each distinct key of its lines (of at
least ``min_chars`` code points) one row, with +1 for an insertion and -1 for a deletion. Counts
and the largest holder of a key are sums over that log, so taking a document out restores what
its presence had dropped elsewhere. Keys that reach ``min_docs`` documents stand, by shard of
their hash, in a cuckoo filter and, packed and sorted, in the shard's exact table. A line first
asks the filter (most lines stop there), then the exact table. A change counts again only the keys
it holds, and writes only their shards.

A shard's postings are dealt in salted parts of bounded size, so a line that a third of all
documents share does not land in one task.

Defined results: a null or empty text is one empty line; a text ending in a newline ends with an
empty line; rows that repeat a doc_id count as one document, and the lines of all rows with
the largest doc_id stay; a null doc_id is below all others; an empty table gives an empty table.
Keys are compared by a 128-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared

SPACE = b" \t\n\x0b\x0c\r"
MIN_CHARS, MIN_DOCS = 20, 3
#: Postings that a shard has on average before more shards are made, and the fewest shards.
SHARD_ROWS, LEAST_SHARDS = 100_000, 256
#: Changes after which logs and shards are written as one.
MOST_LOGS = 8
#: What a null doc_id counts as: below all others.
NO_ID = -(1 << 63)

POSTINGS = "did long, th long, k1 long, k2 long, lines array<int>"
SHARDS = "shard int, filter binary, k1s binary, k2s binary, keepers binary"
DROPS = "did long, th long, lines array<int>"


class CuckooFilter:
    """Approximate membership with deletion: 16-bit fingerprints, four to a bucket."""

    SLOTS, KICKS = 4, 500

    def __init__(self, buckets: int = 4, cells=None):
        import numpy as np

        self.buckets = buckets
        self.cells = np.zeros((buckets, self.SLOTS), dtype="<u2") if cells is None else cells

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        return cls(1 << max(2, int(keys / (cls.SLOTS * 0.8))).bit_length())

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        import numpy as np

        cells = np.frombuffer(data, dtype="<u2").reshape(-1, cls.SLOTS).copy()
        return cls(len(cells), cells)

    def dump(self) -> bytes:
        return self.cells.tobytes()

    def places(self, k1, k2):
        """Fingerprints and both buckets of keys given as unsigned 64-bit arrays."""
        import numpy as np

        prints = (k2 & np.uint64(0xFFFF)).astype("<u2")
        prints[prints == 0] = 1
        mask = np.uint64(self.buckets - 1)
        first = (k1 >> np.uint64(20)) & mask
        return prints, first, first ^ self.step(prints)

    def step(self, prints):
        import numpy as np

        return (prints.astype("u8") * np.uint64(0x5BD1E995) >> np.uint64(7)) & np.uint64(self.buckets - 1)

    def contains(self, k1, k2):
        prints, one, two = self.places(k1, k2)
        return (self.cells[one] == prints[:, None]).any(axis=1) | (self.cells[two] == prints[:, None]).any(axis=1)

    def add(self, k1, k2) -> bool:
        """Insert all keys; False if the filter is too full, which asks for a larger one."""
        import numpy as np

        prints, one, two = self.places(k1, k2)
        for seed, (p, a, b) in enumerate(zip(prints.tolist(), one.tolist(), two.tolist(), strict=True)):
            for bucket in (a, b):
                free = np.flatnonzero(self.cells[bucket] == 0)
                if len(free):
                    self.cells[bucket, free[0]] = p
                    break
            else:
                at = b
                for kick in range(self.KICKS):
                    slot = (seed + kick) % self.SLOTS
                    p, self.cells[at, slot] = int(self.cells[at, slot]), p
                    at ^= int(self.step(np.array([p], dtype="<u2"))[0])
                    free = np.flatnonzero(self.cells[at] == 0)
                    if len(free):
                        self.cells[at, free[0]] = p
                        break
                else:
                    return False
        return True

    def remove(self, k1, k2) -> None:
        """Take out keys that were added before."""
        import numpy as np

        prints, one, two = self.places(k1, k2)
        for p, a, b in zip(prints.tolist(), one.tolist(), two.tolist(), strict=True):
            for bucket in (a, b):
                held = np.flatnonzero(self.cells[bucket] == p)
                if len(held):
                    self.cells[bucket, held[0]] = 0
                    break


def line_keys(text: bytes, min_chars: int = MIN_CHARS) -> dict[bytes, list[int]]:
    """Line numbers by key, for keys of at least so many code points."""
    found: dict[bytes, list[int]] = {}
    for number, line in enumerate(text.lower().split(b"\n")):  # bytes.lower() changes A-Z alone
        key = line.strip(SPACE)
        if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars):
            found.setdefault(key, []).append(number)
    return found


def _postings(min_chars: int):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh3_128_digest

        for batch in batches:
            dids, ths, digests, lines = [], [], [], []
            for did, th, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), shared.text_bytes(batch.column(2)), strict=True):
                for key, numbers in line_keys(text, min_chars).items():
                    dids.append(did)
                    ths.append(th)
                    digests.append(xxh3_128_digest(key))
                    lines.append(numbers)
            halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(dids, pa.int64()), pa.array(ths, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(lines, pa.list_(pa.int32()))],
                names=["did", "th", "k1", "k2", "lines"],
            )

    return run


def _filled(k1, k2) -> CuckooFilter:
    """A filter that holds all keys, given as unsigned arrays."""
    size = max(len(k1), 1)
    cuckoo = CuckooFilter.sized(size)
    while not cuckoo.add(k1, k2):
        size *= 2
        cuckoo = CuckooFilter.sized(size)
    return cuckoo


def _split_shards(n_shards: int):
    """Shards dealt anew by a multiple of their number: a shard's keys go to shards of its own."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                k1, k2, keepers = (np.frombuffer(row[c], dtype="<i8") for c in ("k1s", "k2s", "keepers"))
                home = np.mod(k1, n_shards)
                for shard in np.unique(home).tolist():
                    own = home == shard
                    columns = [np.ascontiguousarray(x[own]) for x in (k1, k2, keepers)]
                    held = _filled(columns[0].view("<u8"), columns[1].view("<u8")).dump()
                    yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([held], pa.binary()), *(pa.array([x.tobytes()], pa.binary()) for x in columns)], names=["shard", "filter", "k1s", "k2s", "keepers"])

    return run


def _merge_shard(key, old, changes):
    """A shard's filter and exact table after its changed keys (n_docs below the limit: gone)."""
    import numpy as np
    import pyarrow as pa

    table: dict[tuple[int, int], int] = {}
    cuckoo = None
    if old.num_rows:
        row = old.to_pylist()[0]
        columns = [np.frombuffer(row[c], dtype="<i8").tolist() for c in ("k1s", "k2s", "keepers")]
        table = {(a, b): k for a, b, k in zip(*columns, strict=True)}
        cuckoo = CuckooFilter.load(row["filter"])
    held = [(changes.column(c).to_numpy()) for c in ("k1", "k2", "keeper", "present")]
    gone, new = [], []
    for a, b, keeper, present in zip(*(x.tolist() for x in held), strict=True):
        if not present:
            if table.pop((a, b), None) is not None:
                gone.append((a, b))
        else:
            if (a, b) not in table:
                new.append((a, b))
            table[a, b] = keeper
    unsigned = lambda pairs: np.array(pairs, dtype="<i8").reshape(-1, 2).view("<u8").T
    if cuckoo is not None:
        cuckoo.remove(*unsigned(gone))
    if cuckoo is None or not cuckoo.add(*unsigned(new)):
        cuckoo = _filled(*unsigned(list(table)))
    rows = np.array([(a, b, table[a, b]) for a, b in sorted(table)], dtype="<i8").reshape(-1, 3)
    packed = [[np.ascontiguousarray(rows[:, i]).tobytes()] for i in range(3)]
    return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([cuckoo.dump()], pa.binary()), *(pa.array(x, pa.binary()) for x in packed)], names=["shard", "filter", "k1s", "k2s", "keepers"])


def _probe(key, lines, shards):
    """The postings whose lines go: filter first, exact table for what passes."""
    import numpy as np
    import pyarrow as pa

    empty = pa.table({"did": pa.array([], pa.int64()), "th": pa.array([], pa.int64()), "lines": pa.array([], pa.list_(pa.int32()))})
    if not lines.num_rows or not shards.num_rows:
        return empty
    row = shards.to_pylist()[0]
    k1, k2, did = (lines.column(c).to_numpy() for c in ("k1", "k2", "did"))
    maybe = np.flatnonzero(CuckooFilter.load(row["filter"]).contains(k1.view("<u8"), k2.view("<u8")))
    k1s, k2s, keepers = (np.frombuffer(row[c], dtype="<i8") for c in ("k1s", "k2s", "keepers"))
    exact = {(a, b): k for a, b, k in zip(k1s.tolist(), k2s.tolist(), keepers.tolist(), strict=True)}
    gone = [i for i, a, b, d in zip(maybe.tolist(), k1[maybe].tolist(), k2[maybe].tolist(), did[maybe].tolist(), strict=True) if exact.get((a, b), d) != d]
    return lines.select(["did", "th", "lines"]).take(pa.array(gone, pa.int64()))


def _drop_lines(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        texts, totals, gone = [], [], []
        for text, drops in zip(shared.text_bytes(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            if drops:
                lines, out = text.split(b"\n"), set(drops)
                totals.append(len(lines))
                text = b"\n".join([x for i, x in enumerate(lines) if i not in out])
                gone.append(len(out))
            else:
                totals.append(text.count(b"\n") + 1)
                gone.append(0)
            texts.append(text)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(totals, pa.int64()), pa.array(gone, pa.int64())], names=["row", "kept_text", "n_lines", "n_dropped"])


@dataclass(frozen=True)
class LineIndex:
    """Stored postings with a sign, and the shards of the keys that reach ``min_docs``. Each change
    adds a log of postings and new versions of the shards it touches; after MOST_LOGS changes both
    are written anew as one. Shards are split in two, all at once, as often as the postings ask for
    it, so that a shard stays a bounded table however small the index began."""

    postings: DataFrame
    shards: DataFrame
    n_shards: int
    signed: bool
    min_chars: int = MIN_CHARS
    min_docs: int = MIN_DOCS
    logs: int = 1

    @classmethod
    def build(cls, docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, doc_id: str = "doc_id", text: str = "text") -> LineIndex:
        """The index of a first set of documents."""
        postings = shared.stored(cls._log(docs, min_chars, 1, doc_id, text), "line-postings", parts=shared.parts_of(docs))
        n_shards = LEAST_SHARDS
        while n_shards * SHARD_ROWS < postings.count():
            n_shards *= 2
        empty = docs.sparkSession.createDataFrame([], f"{SHARDS}, version int")
        index = cls(postings, empty, n_shards, False, min_chars, min_docs)
        return index._with_shards(index.references().filter(F.col("n_docs") >= min_docs))

    @staticmethod
    def _log(docs: DataFrame, min_chars: int, sign: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        shared.prepare(docs.sparkSession)
        rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("did"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))
        return rows.mapInArrow(_postings(min_chars), POSTINGS).withColumn("sign", F.lit(sign))

    def insert(self, docs: DataFrame) -> LineIndex:
        return self._changed(self._log(docs, self.min_chars, 1), self.signed)

    def delete(self, docs: DataFrame) -> LineIndex:
        """Take out documents, given as they were inserted."""
        return self._changed(self._log(docs, self.min_chars, -1), True)

    def _changed(self, log: DataFrame, signed: bool) -> LineIndex:
        log = shared.stored(log, "line-postings")
        index = replace(self, postings=self.postings.unionByName(log), signed=signed, logs=self.logs + 1)
        touched = shared.stored(log.select("k1", "k2").distinct(), "line-touched", narrow=True)
        # only keys of this change are counted again; one that no document holds any more has no
        # reference row: it counts as 0
        now = touched.join(index.references(touched), ["k1", "k2"], "left").fillna({"n_docs": 0, "keeper": NO_ID})
        index = index._with_shards(now).split()
        return index.compacted() if index.logs > MOST_LOGS else index

    def split(self) -> LineIndex:
        """The same index with enough shards for its postings."""
        n_shards, n = self.n_shards, self.postings.count()
        while n_shards * SHARD_ROWS < n:
            n_shards *= 2
        if n_shards == self.n_shards:
            return self
        shards = self.current().mapInArrow(_split_shards(n_shards), SHARDS).withColumn("version", F.lit(self.logs))
        return replace(self, shards=shared.stored(shards, "line-shards"), n_shards=n_shards)

    def compacted(self) -> LineIndex:
        """The same index as one log of what is in, and one version of each shard."""
        rows = self.live().select("did", "th", "k1", "k2", "lines", F.col("copies").cast("int").alias("sign"))
        shards = self.current().withColumn("version", F.lit(0))
        return replace(self, postings=shared.stored(rows, "line-postings"), shards=shared.stored(shards, "line-shards"), signed=False, logs=1)

    def live(self, keys: DataFrame | None = None) -> DataFrame:
        """Postings (of these keys only) of the documents that are in: did, th, k1, k2, lines and
        copies."""
        rows = self.postings if keys is None else self.postings.join(keys, ["k1", "k2"], "left_semi")
        if not self.signed:
            return rows.select("did", "th", "k1", "k2", "lines", F.col("sign").alias("copies"))
        rows = rows.groupBy("did", "th", "k1", "k2").agg(F.first("lines").alias("lines"), F.sum("sign").alias("copies"))
        return rows.filter("copies > 0")

    def references(self, keys: DataFrame | None = None) -> DataFrame:
        """The exact table (of these keys only): for each key its documents, rows that repeat an id
        counting once, and the largest id that holds it."""
        held = self.live(keys).select("k1", "k2", "did").distinct()
        return held.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("did").alias("keeper"))

    def current(self) -> DataFrame:
        """The newest version of each shard."""
        newest = F.max_by(F.struct("filter", "k1s", "k2s", "keepers"), "version").alias("s")
        return self.shards.groupBy("shard").agg(newest).select("shard", "s.*")

    def _shard(self):
        return F.pmod(F.col("k1"), F.lit(self.n_shards)).cast("int").alias("shard")

    def _with_shards(self, changed: DataFrame) -> LineIndex:
        """New versions of the shards that hold a changed key."""
        changes = shared.stored(changed.select(self._shard(), "k1", "k2", "keeper", (F.col("n_docs") >= self.min_docs).alias("present")), "line-changes", narrow=True)
        old = self.current().join(changes.select("shard").distinct(), "shard", "left_semi")
        new = old.groupBy("shard").cogroup(changes.groupBy("shard")).applyInArrow(_merge_shard, SHARDS)
        new = shared.stored(new.withColumn("version", F.lit(self.logs)), "line-shards", narrow=True)
        return replace(self, shards=self.shards.unionByName(new))

    def drops(self) -> DataFrame:
        """Line numbers that go, by document row (did, th)."""
        rows = self.live().select(self._shard(), "did", "th", "k1", "k2", "lines")
        sizes = shared.stored(rows.groupBy("shard").count(), "line-sizes", narrow=True)
        total = sizes.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
        part = max(500, 2 * total // self.n_shards)
        parts = shared.small(sizes.select("shard", F.ceil(F.col("count") / part).cast("int").alias("parts")), self.n_shards)
        dealt = rows.join(parts, "shard").withColumn("part", F.pmod(F.xxhash64("did", "th"), F.col("parts")).cast("int")).drop("parts")
        tables = self.current().join(parts, "shard").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        found = dealt.groupBy("shard", "part").cogroup(tables.groupBy("shard", "part")).applyInArrow(_probe, DROPS)
        return found.groupBy("did", "th").agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("drops"))

    def apply(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """The documents as a struct ``row``, with kept_text, n_lines and n_dropped."""
        rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("did"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))
        joined = rows.join(self.drops(), ["did", "th"], "left").select("row", "text", "drops")
        out = T.StructType([T.StructField("row", rows.schema["row"].dataType), *T.StructType.fromDDL("kept_text string, n_lines long, n_dropped long").fields])
        return joined.mapInArrow(_drop_lines, out)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Build the index of all documents and apply it to them."""
    return LineIndex.build(docs, min_chars, min_docs, doc_id, text).apply(docs, doc_id, text)
