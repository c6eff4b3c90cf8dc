import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import shared, trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def rebuilt(rows):
    turns = {}
    for conv, turn, role, text in rows:
        turns.setdefault(conv, []).append((turn, role or "", text or ""))
    key = lambda t: (t[0] is not None, t[0] or 0, hashlib.sha256(f"{len(t[1])}:{t[1]}{t[2]}".encode()).hexdigest())
    turns = {c: [(r, t) for _, r, t in sorted(x, key=key)] for c, x in turns.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(("" if c is None else str(c)).encode()) % 4
        head = [] if c is None else turns.get(c - (abs(c) % 20) * (1 if c >= 0 else -1), [])
        out[c] = tuple(head[:h] + own[h:])
    return out


def expected(convs):
    low = lambda ids: min((c for c in ids if c is not None), default=None)
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    own = lambda p: (len(members[p]) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0)
    children = {p: [q for q in members if len(q) == len(p) + 1 and q[: len(p)] == p] for p in members}
    out = []
    for p, ids in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = sorted((c for c in ids if len(convs[c]) == len(p)), key=lambda c: (c is None, c or 0))
        listed = ",".join("" if c is None else str(c) for c in ends)
        parent = low(members[p[:-1]]) if p else None
        out.append((low(ids), len(p), parent, len(ids), len(children[p]), sum(not children[q] for q in below), sum(map(own, below)), hashlib.sha256(listed.encode()).hexdigest()))
    return sorted(out, key=repr)


def random_rows(seed, n, words=("a", "b b", "c c c"), longest=7):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        copy = c % 3 == 0
        for t in range(4 if copy else rng.randrange(1, longest)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", "same again" if copy else rng.choice(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("fan", [2, 3, 64])
@pytest.mark.parametrize("ranges", [1, 7, 40])
def test_against_brute_force(spark, rows_of, monkeypatch, ranges, fan):
    """A third of all conversations are copies; ranges of few rows are stitched over several levels."""
    monkeypatch.setattr(trie, "CHUNK", 40)
    rows = random_rows(ranges, 240)
    got = rows_of(trie.prefix_trie(trie.rebuilt(spark.createDataFrame(rows, SCHEMA)), range_rows=-(-240 // ranges), fan=fan), *COLUMNS)
    assert got == expected(rebuilt(rows))


def test_nulls_ties_repeats_and_clashing_columns(spark, rows_of):
    rows = [
        (None, 0, None, None), (None, None, "user", "first"), (3, 1, "user", "x"), (3, 1, "user", "x"), (3, 1, "assistant", "x"), (3, None, "user", "z"),
        (-7, 0, "user", "minus"), (-7, 1, "user", "one"), (-20, 0, "user", "base"), (0, 0, "user", ""), (0, 1, "", "user"), (1, 0, None, ""), (2, 0, "", None), (40, 0, "user", "w " * 100_000),
        (41, 5, "u", "t"), (42, 5, "u", "t"), (43, 5, "u", "t"), (45, 5, "ut", ""),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit(1)).withColumn("words", F.lit("w")).withColumn("place", F.lit(0))
    assert rows_of(trie.prefix_trie(trie.rebuilt(frame)), *COLUMNS) == expected(rebuilt(rows))


def test_long_conversations(spark, rows_of):
    """Two of 2,000 turns that part near the end, in ranges of their own."""
    rows = [(c, t, "user", f"{t}" if t < 1990 or c % 2 else f"{t} {c}") for c in (20, 21, 22, 23) for t in range(2000)]
    got = rows_of(trie.prefix_trie(trie.rebuilt(spark.createDataFrame(rows, SCHEMA)), range_rows=1, fan=2), *COLUMNS)
    convs = rebuilt(rows)
    deepest = [r for r in got if r[4] == 0]
    assert len(got) == len({x[:d] for x in convs.values() for d in range(2001)}) and sum(r[3] for r in deepest) == 4
    assert {r[7] for r in deepest} <= {hashlib.sha256(x.encode()).hexdigest() for x in ("20", "21", "22", "23", "21,23", "20,22")}


def test_parents_of_many_children_are_joined_apart(spark, rows_of, monkeypatch):
    monkeypatch.setattr(trie, "LARGE_ROWS", 3)
    monkeypatch.setattr(shared, "BROADCAST_ROWS", 0)
    rows = random_rows(9, 60, words=[str(i) for i in range(30)], longest=3)
    assert rows_of(trie.prefix_trie(trie.rebuilt(spark.createDataFrame(rows, SCHEMA))), *COLUMNS) == expected(rebuilt(rows))


def test_empty(spark):
    assert trie.prefix_trie(trie.rebuilt(spark.createDataFrame([], SCHEMA))).collect() == []
