import random
import re

import numpy as np
from pyspark.sql import functions as F

from ledgerlens.llm import neardup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (i, len(sets[i]), find(i), find(i) == i) for i in ids}


def check(docs, rows):
    got = {r["doc_id"]: (r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.components(docs(rows)).collect()}
    assert got == brute(rows)


def words(rng, n, of=4000):
    return [f"w{rng.randrange(of)}" for _ in range(n)]


def changed(rng, base, n):
    out = list(base)
    for at in rng.sample(range(len(out)), n):
        out[at] = f"x{rng.randrange(10**6)}"
    return out


def test_groups_against_brute_force(docs):
    rng = random.Random(2)
    rows = []
    for _ in range(25):
        base = words(rng, rng.randint(20, 150))
        for _ in range(rng.randint(1, 5)):
            rows.append(" ".join(changed(rng, base, rng.randint(0, 4))))
    # a star: texts that are all like one text and hardly like each other
    base = words(rng, 200)
    rows += [" ".join(changed(rng, base, 4)) for _ in range(40)] + [" ".join(base)]
    # a chain: each like the next only
    base = words(rng, 120)
    for step in range(12):
        base = base[4:] + words(rng, 4)
        rows.append(" ".join(base))
    # texts that share a passage and no more
    passage = words(rng, 60)
    rows += [" ".join(words(rng, 30) + passage + words(rng, 30)) for _ in range(40)]
    rows += [None, "", " \n", "one two", "One  two", "one two three", "A b c d e", "a b C d\te", "Ä b c d e", "ä b c d e", rows[0], rows[0].upper(), "long " * 20_000]
    rng.shuffle(rows)
    check(docs, list(enumerate(rows)))


def test_small_and_odd_tables(docs):
    check(docs, [])
    check(docs, [(5, None)])
    check(docs, [(3, "a b c d e f"), (-4, "a b c d e f")])


def test_repeated_and_null_ids(docs):
    rows = [(1, "a b c d e f g"), (1, "h i j k l m n"), (2, "a b c d e f g"), (3, "h i j k l m n"), (None, "q r s t u v"), (4, "q r s t u v")]
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in neardup.components(docs(rows)).collect()}
    assert got == {(1, 1, True), (2, 1, False), (3, 1, False), (None, None, True), (4, None, False)}


def test_extra_columns_that_clash(docs):
    more = docs([(1, "a b c d e"), (2, "A B C D E")]).withColumn("id", F.lit(1)).withColumn("root", F.lit(2)).withColumn("hub", F.lit(3))
    assert {r["component_id"] for r in neardup.components(more).collect()} == {1}


def test_buckets_that_stay_apart(spark, monkeypatch):
    """All pairs of different components within a bucket, none of one component, whether a bucket
    is one block or several."""
    same = [0] * neardup.SKETCH_WORDS
    rows = [(i, 10, same, same * 2, [1, 2] if i in (5, 6) else [1]) for i in range(700)] + [(700, 10, same, same * 2, [3])]
    nodes = spark.createDataFrame(rows, "id long, n_shingles long, sketch array<long>, parity array<long>, keys array<long>")
    owned = nodes.select("id", "keys")
    roots = spark.createDataFrame([(i, 0 if i % 7 == 0 else i // 100 + 1) for i in range(701)], "id long, root long")
    root = {r["id"]: r["root"] for r in roots.collect()}
    want = {(a, b) for a in range(700) for b in range(a + 1, 700) if root[a] != root[b]}
    assert {(r["hub"], r["member"]) for r in neardup._rest(owned, nodes, roots).collect()} == want
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 100)
    assert {(r["hub"], r["member"]) for r in neardup._rest(owned, nodes, roots).collect()} == want


def test_sketches_estimate_similarity():
    sampler, rng = neardup.Sampler(), np.random.default_rng(3)
    for alike in (0.6, 0.75, 0.9):
        common = int(2000 * alike / (1 + alike) * 2)
        pool = rng.integers(0, 1 << 63, 4000, dtype="u8")
        a, b = np.sort(pool[:2000]), np.sort(np.concatenate([pool[2000 - common : 2000], pool[2000 : 4000 - common]]))
        differing = int(np.bitwise_count(sampler.sketch(sampler.samples(a)).view("u8") ^ sampler.sketch(sampler.samples(b)).view("u8")).sum())
        samples = -neardup.SKETCH_BITS / 2 * np.log(1 - 2 * differing / neardup.SKETCH_BITS)
        exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs(1 - samples / 2 / neardup.SAMPLES - exact) < 0.12


def test_parity_of_whole_sets_never_rules_out_a_link():
    rng = np.random.default_rng(4)
    for size in (1, 20, 300, 5000, 40_000):
        pool = neardup._mixed(rng.integers(0, 1 << 63, 2 * size, dtype="u8"))
        a = np.unique(pool[:size])
        for moved in range(0, size // 3 + 1, max(1, size // 12)):
            b = np.unique(pool[moved : size + moved])
            differing = int(np.bitwise_count(neardup.folded(a, neardup.PARITY_WORDS).view("u8") ^ neardup.folded(b, neardup.PARITY_WORDS).view("u8")).sum())
            assert differing <= len(np.setxor1d(a, b))
            if neardup.linked(a, b):
                assert (100 + neardup.PERCENT) * differing <= (100 - neardup.PERCENT) * (len(a) + len(b))


def test_merging_long_chains(spark):
    n = 200
    roots = spark.createDataFrame([(i, i) for i in range(n)], "id long, root long")
    links = spark.createDataFrame([(i, i + 1) for i in range(n - 1) if i != 99], "a long, b long")
    got = {r["id"]: r["root"] for r in neardup.merge(roots, links).collect()}
    assert got == {i: 0 if i < 100 else 100 for i in range(n)}
