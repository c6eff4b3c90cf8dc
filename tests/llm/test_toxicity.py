import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import toxicity


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(1)
    bad = ["vile", "nasty", "grumpfoo", "grumpbar", "grumpbaz"]
    rows = []
    for i in range(900):
        toxic = i % 5 == 0
        text = [f"w{rng.randrange(2000)}" for _ in range(rng.randint(5, 80))]
        if toxic:
            text += rng.choices([*bad, f"grump{rng.randrange(999)}"], k=rng.randint(2, 8))
        rng.shuffle(text)
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_held_out_accuracy(spark, docs, corpus):
    labels = spark.createDataFrame([(i, 1, t) for i, _, t in corpus if i < 600] + [(5000, 1, None)], "doc_id long, quality int, toxic int")
    frame = docs([(i, t) for i, t, _ in corpus] + [(9000, None), (9001, ""), (9002, "w1 " * 30_000 + " vile nasty")])
    model = toxicity.train(frame, labels)
    got = {r["doc_id"]: r for r in toxicity.score(frame, model).select("row.doc_id", "severity", "p_clean", "grade", "toxic").collect()}
    held = [(got[i]["toxic"], bool(t)) for i, _, t in corpus if i >= 600]
    assert sum(a == b for a, b in held) / len(held) > 0.97
    assert not any(a for a, b in held if not b)
    assert not got[9000]["toxic"] and not got[9001]["toxic"] and got[9002]["toxic"]
    assert all(0 <= r["severity"] <= 2 for r in got.values())
    assert all(r["toxic"] == (r["grade"] > 0) for r in got.values())
    assert np.mean([r["severity"] for r in got.values() if not r["toxic"]]) < 0.1 < 0.9 < np.mean([r["severity"] for r in got.values() if r["toxic"]])


def test_recovers_ordered_thresholds():
    rng = np.random.default_rng(1)
    weights, thresholds = np.array([2.0, 1.0, -1.5, 0.0]), np.array([0.5, 1.5, 3.0])
    rows = []
    for _ in range(6000):
        x = np.flatnonzero(rng.random(4) < 0.5)
        rows.append((int((weights[x].sum() + rng.logistic() > thresholds).sum()), x.tolist()))
    model = toxicity.fit(rows, 4, l2=1e-5, steps=1500)
    assert np.allclose([model.weights[i] for i in range(4)], weights, atol=0.25)
    assert np.allclose(model.thresholds, thresholds, atol=0.25)
    assert sorted(model.thresholds) == list(model.thresholds)
    assert sum(model.grades({0, 1})) == pytest.approx(1)


def test_without_labels_nothing_is_toxic(spark, docs):
    frame = docs([(1, "vile"), (1, "vile"), (None, "x")]).withColumn("toxic", F.lit(7)).withColumn("severity", F.lit(8))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = toxicity.score(frame, toxicity.train(frame, none)).collect()
    assert [(r["toxic"], r["severity"]) for r in out] == [(False, 0.0)] * 3
    assert out[0]["row"]["toxic"] == 7
    assert toxicity.score(docs([]), toxicity.SeverityModel()).count() == 0


def test_sample_is_bounded_and_repeats(spark, docs, corpus):
    labels = spark.createDataFrame([(i, 1, t) for i, _, t in corpus], "doc_id long, quality int, toxic int")
    frame = docs([(i, t) for i, t, _ in corpus])
    one, two = (sorted(toxicity.sample(frame.repartition(n), labels, 50, 70).collect()) for n in (2, 7))
    assert one == two and len(one) == 120


def test_few_labels_still_give_features(spark, docs):
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{rng.randrange(2000)}" for _ in range(20)) + (f" {'abcdefghijklmnopqrst'[i % 20] * 7}" if i < 60 else "")) for i in range(400)]
    labels = spark.createDataFrame([(i, 1, int(i < 60)) for i, _ in rows], "doc_id long, quality int, toxic int")
    frame = docs(rows)
    got = {r["doc_id"]: r["toxic"] for r in toxicity.score(frame, toxicity.train(frame, labels)).select("row.doc_id", "toxic").collect()}
    assert sum(got[i] for i in range(60)) > 54 and not any(got[i] for i in range(60, 400))
    assert [toxicity.least_rows(n) for n in (1, 51, 449, 2_000, 9_000)] == [3, 3, 3, 5, 5]


def test_the_query_against_plain_python(spark, docs, corpus, tmp_path):
    """Sample, features, folds, cut and scores of the query, worked out in plain Python."""
    import math
    import re

    from xxhash import xxh3_64_intdigest

    from ledgerlens.llm.queries import op6_score_toxicity

    rows = [(i, t) for i, t, _ in corpus] + [(9000, None), (9001, "vile"), (1, "nasty words of another row")]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i % 3 > 0), y) for i, _, y in corpus if i % 2]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = sorted((r["doc_id"], r["p_clean"], r["severity"], r["grade"], r["toxic"], r["n_features"]) for r in op6_score_toxicity(spark, str(tmp_path)).collect())

    def features(text):
        out = set()
        for word in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or "")):
            raw = word.encode()
            out |= {(0, raw)} | {(n, raw[:n]) for n in (4, 5, 6) if len(raw) > n}
        signed = lambda x: x - 2**64 if x >= 2**63 else x
        return {signed(xxh3_64_intdigest(b, seed=n)) for n, b in out}

    fold_of = {r["i"]: r["f"] for r in spark.createDataFrame([(i,) for i, _, _ in labels], "i long").select("i", F.pmod(F.xxhash64("i", F.lit("fold")), F.lit(3)).alias("f")).collect()}
    label = {i: (y, 0 if not y else 2 if not q else 1) for i, q, y in labels}
    known = sorted((fold_of[i], *label[i], sorted(features(t))) for i, t in rows if i in label)

    def model(without):
        part = [r for r in known if r[0] != without]
        bad, good = sum(r[1] for r in part), sum(not r[1] for r in part)
        seen = {}
        for _, y, _, fs in part:
            for f in fs:
                seen.setdefault(f, [0, 0])[y] += 1
        least = max(3, min(5, round(5 * sum(r[1] for r in known) / 2000)))
        least = least if without < 0 else round(least * 2 / 3)
        kept = {f for f, (c, b) in seen.items() if b >= least and b / bad / (b / bad + c / good) >= 0.97}
        return toxicity.fit([(g, [f for f in fs if f in kept]) for _, _, g, fs in part]), kept

    def chances(fitted, fs):
        score = sum(fitted.weights.get(f, 0.0) for f in fs)
        upto = [1 / (1 + math.exp(score - t)) for t in fitted.thresholds] + [1.0]
        return [upto[0], upto[1] - upto[0], upto[2] - upto[1]]

    whole, kept = model(-1)
    others = {fold: model(fold)[0] for fold in range(3)}
    cut = toxicity.best_cut([(chances(others[fold], fs)[0], bool(y)) for fold, y, _, fs in known])
    want = []
    for i, t in rows:
        fs = features(t) & kept
        p = chances(whole, fs)
        grade = 0 if p[0] >= cut else 1 if p[1] >= p[2] else 2
        want.append((i, p[0], p[1] + 2 * p[2], grade, p[0] < cut, len(fs)))
    assert len(got) == len(want)
    for a, b in zip(got, sorted(want), strict=True):
        assert (a[0], *a[3:]) == (b[0], *b[3:])
        assert a[1:3] == pytest.approx(b[1:3], abs=1e-6)


def test_the_sample_is_bounded_whatever_repeats(docs, spark):
    rows = [(i, f"text {i}") for i in range(100)] + [(n, "said again") for n in range(0, 100, 2) for _ in range(20)]
    known = [(i, i % 2, i % 4 < 2) for i in range(100)] + [(0, 0, True)] * 50
    labels = spark.createDataFrame([(i, q, int(t)) for i, q, t in known], "doc_id long, quality int, toxic int")
    found = toxicity.sample(docs(rows), labels, 20, 20).groupBy("toxic").count().collect()
    assert all(r["count"] <= 20 for r in found) and len(found) == 2
    again = toxicity.sample(docs(list(reversed(rows))), labels, 20, 20)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, toxicity.sample(docs(rows), labels, 20, 20).collect()))
