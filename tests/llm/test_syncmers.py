import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import syncmers


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def edited(rows):
    """Edited texts by id, for unique ids."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = {}
    for n, (i, text) in enumerate(order):
        text, after = text or "", order[(n + 1) % len(order)][1] or ""
        half = len(text) // 2
        out[i] = text[: len(text) - half] + after[:half]
    return out


def make(n=60, seed=1):
    rng = random.Random(seed)
    rows = [(i * 7 - 100, " ".join(f"w{rng.randrange(500)}é" for _ in range(rng.randint(0, 120)))) for i in range(n)]
    return rows + [(9000, None), (9001, ""), (9002, "one"), (9003, "x" * 5000), (9004, "漢字かな" * 30), (9007, "ab"), (9008, "é" * 40), (9010, "some words of a text with a cut " * 3), (9005, rows[3][1]), (9006, "w " * 20_000)]


def test_edited_texts_and_sizes(docs):
    rows = make()
    got, want = by_id(syncmers.fingerprints(docs(rows))), edited(rows)
    for i, text in rows:
        assert got[i]["n_chars"] == len(text or "")
        assert got[i]["edited_sha256"] == hashlib.sha256(want[i].encode()).hexdigest()
        assert all(0 <= got[i][c] <= 1 for c in ("near_edited", "near_next", "aligned_edited"))


def test_equal_texts_and_likeness(docs):
    rows = make()
    got, want = by_id(syncmers.fingerprints(docs(rows))), edited(rows)
    again = by_id(syncmers.fingerprints(docs(list(want.items()))))
    for i, text in rows:
        assert again[i]["fingerprint"] == got[i]["edited_fingerprint"]
        both = [got[i][c].split() for c in ("fingerprint", "edited_fingerprint")]
        mark = ":" if all(len(t or "") < syncmers.FINE for t in (text, want[i])) else "@"
        mine, other = ({a.split(mark)[0] for a in listed if mark in a} for listed in both)
        assert got[i]["near_edited"] == pytest.approx(len(mine & other) / len(mine | other) if mine | other else 1.0)
    assert got[9005]["fingerprint"] == got[make()[3][0]]["fingerprint"]
    assert got[9000]["fingerprint"] == got[9001]["fingerprint"] == ""
    long = [r for i, r in got.items() if i < 9000 and r["n_chars"] > 300]
    assert sum(r["near_edited"] for r in long) / len(long) > 0.2 > 0.02 > sum(r["near_next"] for r in long) / len(long)


def test_closed_syncmers_against_plain_python(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice(alphabet) for _ in range(n)) for n in (3, 26, 34, 35, 36, 60, 300, 1500, 4000) for alphabet in ("ab ", "abcdefghijklmnop é漢字")]
    frame = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    k, s = syncmers.K, syncmers.S
    grams = sorted({t[i : i + s] for t in texts for i in range(len(t) - s + 1)})
    hashes = spark.createDataFrame([(g, *g) for g in grams], "g string, a string, b string, c string, d string").select("g", F.xxhash64(F.xxhash64("a", "b"), F.xxhash64("c", "d")).alias("h"))
    value = {r["g"]: r["h"] for r in hashes.collect()}
    for r in frame.select("i", syncmers.kmers(F.col("text")).alias("found")).collect():
        text = texts[r["i"]]
        inner = [value[text[i : i + s]] for i in range(len(text) - s + 1)]
        edge = []
        for i in range(len(text) - k + 1):
            least = min(inner[i : i + syncmers.INNER])
            if least in (inner[i], inner[i + syncmers.INNER - 1]):
                edge.append(i)
        assert [a["pos"] for a in r["found"]] == edge
        by_run = {}
        for a in r["found"]:
            assert by_run.setdefault(text[a["pos"] : a["pos"] + k], a["anchor"]) == a["anchor"]
        assert len(set(by_run.values())) == len(by_run)


def test_anchors_do_not_depend_on_what_is_around(spark):
    rng = random.Random(5)
    passage = " ".join(f"p{rng.randrange(10**6)}" for _ in range(60))
    texts = [passage, "a b c " + passage, passage + " x y z", "q " * 500 + passage + " r" * 500]
    found = [{a["anchor"] for a in r["f"]} for r in spark.createDataFrame(list(enumerate(texts)), "i long, text string").select("i", syncmers.kmers(F.col("text")).alias("f")).orderBy("i").collect()]
    assert len(found[0]) > 20 and all(found[0] <= other for other in found[1:])


@pytest.mark.parametrize("run_rows", [4, 256])
def test_next_rows_of_crowded_ids(docs, monkeypatch, run_rows):
    monkeypatch.setattr(syncmers, "RUN_ROWS", run_rows)
    monkeypatch.setattr(syncmers, "RUNS_TOGETHER", 8)
    monkeypatch.setattr(syncmers, "RANGES", 5)
    rows = [(i, f"text {i}") for i in range(200)] + [(10**15, "far"), (None, "none")]
    got = {r["doc_id"]: r["next_text"] for r in syncmers.with_next(docs(rows)).collect()}
    assert got == {10**15: "text 199", 0: "none", None: "far", **{i: f"text {i - 1}" for i in range(1, 200)}}


def test_next_rows_without_ids_go_by_the_hash_of_the_text(docs, spark, monkeypatch):
    monkeypatch.setattr(syncmers, "RUN_ROWS", 4)
    monkeypatch.setattr(syncmers, "RUNS_TOGETHER", 4)
    texts = [f"text {i}" for i in range(60)]
    order = [r["t"] for r in spark.createDataFrame([(t,) for t in texts], "t string").orderBy(F.xxhash64("t")).collect()]
    got = {r["text"]: r["next_text"] for r in syncmers.with_next(docs([(7, "seven"), *((None, t) for t in texts)])).collect()}
    assert got == {"seven": order[0], order[-1]: "seven", **dict(zip(order, order[1:], strict=False))}


def test_small_tables_repeats_and_clashing_columns(docs):
    assert syncmers.fingerprints(docs([])).count() == 0
    alone = syncmers.fingerprints(docs([(1, "abcd")])).collect()[0]
    assert alone["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()
    more = docs([(1, "same text"), (1, "same text"), (2, "other")]).withColumn("run", F.lit(1)).withColumn("also", F.lit(2)).withColumn("th", F.lit(3))
    assert sorted(r["doc_id"] for r in syncmers.fingerprints(more).collect()) == [1, 1, 2]


def test_texts_keep_anchors_when_half_is_edited(spark):
    rng = random.Random(6)
    words = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    pairs = [(n, f"{half} {words(n - n // 2)}", f"{half} {words(n - n // 2)}") for n in range(2, 60, 3) for half in [words(n // 2)] for _ in range(5)]
    frame = spark.createDataFrame(pairs, "n long, a string, b string")
    got = frame.select("n", syncmers.likeness(syncmers.anchors(F.col("a")), syncmers.anchors(F.col("b"))).alias("near")).collect()
    assert all(r["near"] > 0 for r in got)


def test_likeness_does_not_jump_with_length(spark):
    """A text and itself less its last character, at lengths on all sides of K, FINE and twice it."""
    rng = random.Random(8)
    letters = "abcdefghijklmnop é漢"
    lengths = sorted({*range(20, 60), *range(60, 2001, 7), *range(syncmers.FINE - 4, syncmers.FINE + 5), *range(276, 285)})
    rows = [(n, "".join(rng.choice(letters) for _ in range(n))) for n in lengths]
    frame = spark.createDataFrame(rows, "n long, text string")
    less = F.expr("substring(text, 1, n - 1)")
    half = F.expr("substring(text, 1, n - floor(n / 4))")
    got = frame.select("n", *[syncmers.likeness(syncmers.anchors(F.col("text")), syncmers.anchors(x)).alias(c) for x, c in ((less, "less"), (half, "half"))]).collect()
    assert min(r["less"] for r in got) >= 0.8
    assert all(r["half"] > 0.4 for r in got)
    near = [r["half"] for r in got if abs(r["n"] - syncmers.FINE) < 5]
    assert max(near) - min(near) < 0.4
