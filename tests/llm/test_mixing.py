import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import mixing


def brute_targets(sizes):
    """Targets by sharing again and again. sizes: by source, null as None."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: n % 3 + 1 for n, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total >= 3 * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = 3.0 * sizes[s]
        left -= sum(3 * sizes[s] for s in over)
        open_ -= set(over)
    return target


def hashed(doc_id):
    return int(hashlib.md5(str(doc_id).encode()).hexdigest()[:15], 16)


def check(docs, rows):
    got = {r["doc_id"]: r for r in mixing.mix(docs(rows)).collect()}
    size = {i: len((t or "").split()) for i, t, _ in rows}
    sources = {}
    for i, _, s in rows:
        sources.setdefault(s, []).append(i)
    totals = {s: sum(size[i] for i in ids) for s, ids in sources.items()}
    targets = brute_targets(totals)
    for s, ids in sources.items():
        rounds = int(targets[s] // totals[s]) if totals[s] else 0
        need, acc, more = targets[s] - rounds * totals[s], 0, set()
        for i in sorted(ids, key=hashed):
            if acc + size[i] <= need or 2 * (need - acc) >= size[i]:
                more.add(i)
            acc += size[i]
            if acc > need:
                break
        for i in ids:
            r = got[i]
            assert (r["size"], r["source_size"]) == (size[i], totals[s])
            assert r["target"] == pytest.approx(targets[s])
            assert r["taken"] == size[i] * (rounds + (i in more)) <= 3 * size[i]
        assert abs(sum(got[i]["taken"] for i in ids) - targets[s]) <= max(size[i] for i in ids) / 2 + 1e-6
    return got


def test_against_brute_force(docs):
    rng = random.Random(1)
    names = ["b", "a", "é", "z", None, "A", "tiny", "empty"]
    share = [50, 20, 5, 5, 5, 10, 0, 0]
    rows = [(i, "w " * rng.randint(0, 60), rng.choices(names, share)[0]) for i in range(500)] + [(1000, "one two", "tiny"), (1001, None, "empty"), (1002, " \n", "empty"), (1003, "x " * 20_000, "b")]
    check(docs, rows)


def test_one_source_takes_all_once(docs):
    got = check(docs, [(i, "a b c", "s") for i in range(20)])
    assert all(r["taken"] == 3 for r in got.values())


def test_empty_table_repeats_and_clashing_columns(docs):
    assert mixing.mix(docs([])).count() == 0
    more = docs([(1, "a b", "x"), (1, "a b", "x"), (2, "c", "y"), (None, "d", "y")]).withColumn("size", F.lit(0)).withColumn("h", F.lit(0)).withColumn("key", F.lit("k"))
    out = mixing.mix(more).collect()
    assert sorted(r["size"] for r in out) == [1, 1, 2, 2]
    assert len({r["taken"] for r in out if r["doc_id"] == 1}) == 1


def test_reruns_agree(docs):
    rows = [(i, "w " * (i % 17), "s" + str(i % 4)) for i in range(200)]
    one, two = (sorted(mixing.mix(docs(rows).repartition(n)).select("doc_id", "taken").collect()) for n in (1, 9))
    assert one == two
