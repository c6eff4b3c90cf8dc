import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from ledgerlens.llm import linededup
from ledgerlens.llm.linededup import CuckooFilter, LineIndex

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = " \t\n\x0b\x0c\r"


def brute(rows):
    keys = {}
    split = [(i, (t or "").split("\n")) for i, t in rows]
    for n, (i, lines) in enumerate(split):
        for line in lines:
            key = line.strip(SPACE).translate(LOWER)
            if len(key) >= 20:
                keys.setdefault(key, {})[n] = i
    out = []
    for i, lines in split:
        def gone(line):
            held = keys.get(line.strip(SPACE).translate(LOWER), {})
            return len(held) >= 3 and max(held.values()) != i
        kept = [x for x in lines if not gone(x)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def result(df):
    return sorted((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in df.select("row.doc_id", "n_lines", "n_dropped", "kept_text").collect())


def make(seed, n):
    rng = random.Random(seed)
    common = [f"This is a shared line number {k}, é" for k in range(12)] + ["short", "x" * 19, "y" * 20, "", " " * 30]
    vary = lambda s: rng.choice([s, s.upper(), f"  {s}\t", s])
    return [(i, "\n".join(vary(rng.choice(common)) if rng.random() < 0.6 else f"own line {i} {k} {rng.random()}" for k in range(rng.randint(0, 12)))) for i in range(n)]


def test_against_brute_force(docs):
    rows = make(1, 80) + [(1000, None), (1001, ""), (1002, "\n"), (1003, "z" * 300_000), (1004, "the very same long line\n" * 3), (1005, "the very same long line"), (1006, "THE very same long line ")]
    # a line that most documents share
    rows = [(i, t if t is None or i % 3 else t + "\nEveryone repeats this one line") for i, t in rows]
    assert result(linededup.dedup_lines(docs(rows))) == brute(rows)


def test_empty_table_repeats_and_clashing_columns(docs):
    assert linededup.dedup_lines(docs([])).count() == 0
    line = "a line of more than twenty characters"
    # three rows, two documents: the line stays
    assert result(linededup.dedup_lines(docs([(7, line), (7, line), (3, line + "\nown")]))) == [(3, 2, 0, line + "\nown"), (7, 1, 0, line), (7, 1, 0, line)]
    assert result(linededup.dedup_lines(docs([(1, line), (1, "y"), (2, line)]))) == [(1, 1, 0, line), (1, 1, 0, "y"), (2, 1, 0, line)]
    more = docs([(7, line), (7, line), (5, line), (3, line + "\nown")]).withColumn("n_lines", F.lit(1)).withColumn("th", F.lit(2)).withColumn("row", F.lit(3))
    got = linededup.dedup_lines(more)
    assert result(got) == [(3, 2, 1, "own"), (5, 1, 1, ""), (7, 1, 0, line), (7, 1, 0, line)]
    assert got.select("row.row").distinct().collect()[0][0] == 3


def test_null_ids_are_below_others(docs):
    line = "a line of more than twenty characters"
    got = linededup.dedup_lines(docs([(None, line), (1, line), (2, line)])).select("row.doc_id", "kept_text").collect()
    assert {(r["doc_id"], r["kept_text"]) for r in got} == {(None, ""), (1, ""), (2, line)}


def test_insertions_and_deletions_are_reversible(docs):
    first, second = make(2, 30), [(i + 500, t) for i, t in make(3, 20)]
    index = LineIndex.build(docs(first))
    both = index.insert(docs(second))
    assert result(both.apply(docs(first + second))) == brute(first + second)
    back = both.delete(docs(second))
    assert result(back.apply(docs(first))) == brute(first)
    half = both.delete(docs(first[:15]))
    assert result(half.apply(docs(first[15:] + second))) == brute(first[15:] + second)


def test_many_changes_are_written_as_one(docs, monkeypatch):
    monkeypatch.setattr(linededup, "MOST_LOGS", 3)
    parts = [[(100 * n + i, t) for i, t in make(n, 12)] for n in range(5)]
    index = LineIndex.build(docs(parts[0]))
    for part in parts[1:]:
        index = index.insert(docs(part))
    assert index.logs <= 3
    index = index.delete(docs(parts[1])).delete(docs(parts[3]))
    left = parts[0] + parts[2] + parts[4]
    assert result(index.apply(docs(left))) == brute(left)


def test_an_index_begun_small_splits_its_shards(docs, monkeypatch):
    monkeypatch.setattr(linededup, "SHARD_ROWS", 10)
    monkeypatch.setattr(linededup, "LEAST_SHARDS", 2)
    first, more = make(21, 5), [(100 + i, t) for i, t in make(22, 150)]
    index = LineIndex.build(docs(first))
    began = index.n_shards
    index = index.insert(docs(more))
    assert index.n_shards > 8 * began and index.n_shards * 10 >= index.postings.count()
    homes = [(r["shard"], np.frombuffer(r["k1s"], dtype="<i8")) for r in index.current().collect()]
    assert len(homes) > 2 and all((np.mod(k, index.n_shards) == shard).all() for shard, k in homes)
    assert result(index.apply(docs(first + more))) == brute(first + more)
    index = index.delete(docs(more[:100])).insert(docs(more[:30]))
    left = first + more[:30] + more[100:]
    assert result(index.apply(docs(left))) == brute(left)


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, (2, 5000), dtype="u8")
    cuckoo = CuckooFilter.sized(5000)
    assert cuckoo.add(*keys)
    assert cuckoo.contains(*keys).all()
    others = rng.integers(0, 1 << 63, (2, 20_000), dtype="u8")
    assert cuckoo.contains(*others).mean() < 0.01
    cuckoo = CuckooFilter.load(cuckoo.dump())
    cuckoo.remove(*keys[:, :2500])
    assert cuckoo.contains(*keys[:, 2500:]).all()
    assert cuckoo.contains(*keys[:, :2500]).mean() < 0.02


def test_a_full_filter_says_so():
    keys = np.random.default_rng(2).integers(0, 1 << 63, (2, 500), dtype="u8")
    assert not CuckooFilter(4).add(*keys)


def test_digest_of_kept_text(spark, tmp_path, docs):
    from ledgerlens.llm.queries import op5_line_dedup

    docs([(1, "a\nb")]).write.parquet(f"{tmp_path}/documents.parquet")
    assert op5_line_dedup(spark, str(tmp_path)).collect()[0]["kept_sha256"] == hashlib.sha256(b"a\nb").hexdigest()
