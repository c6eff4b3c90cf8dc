import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import variants


def counted(docs):
    n = Counter()
    for doc, text, *_ in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def near(x, y):
    """Exactly one insertion, deletion or replacement apart."""
    if len(x) > len(y):
        x, y = y, x
    if len(y) - len(x) > 1 or x == y:
        return False
    i = next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), len(x))
    return x[i + 1 :] == y[i + 1 :] if len(x) == len(y) else x[i:] == y[i + 1 :]


def expected(n):
    form, near_n = {}, {}
    for w in n:
        close = [x for x in n if near(w, x)]
        near_n[w] = len(close)
        best = min(close, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], near_n[w], n.get(form[w])))
    return sorted(out, key=repr)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def vocabulary(seed, size=220, letters="abé"):
    """Words of few letters, many of them near, with runs of equal letters and long chains."""
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(6, 10))) for _ in range(size)}
    words |= {"aaaaaa", "aaaaaaa", "aaaaaaaa", "éaaaaaa", "aaaaaaé", "z" * 300, "z" * 301, "z" * 150 + "y" + "z" * 149}
    return {w: rng.choice([5, 6, 25, 30, 125, 126, 700]) for w in sorted(words)}


@pytest.mark.parametrize("limits", [{}, {"set_rows": 6, "task_rows": 40}, {"set_chars": 30, "task_chars": 300}])
def test_pairs_against_brute_force(spark, limits):
    n = vocabulary(1)
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    got = {r.word: (r.n_near, r.best) for r in variants.near_words(words, **limits).collect()}
    want = {}
    for w in n:
        close = [x for x in n if near(w, x)]
        if close:
            want[w] = (len(close), min(close, key=lambda x: (-n[x], x)))
    assert got == want


def test_whole_job_against_brute_force(docs, rows_of):
    rng = random.Random(3)
    names = list(vocabulary(4, 60))
    rows = [(i, " ".join(rng.choice(names[: 5 + i % 60]) for _ in range(120)), "s") for i in range(400)]
    rows += [(None, "Straße, ÉCLAIRS éclairs Éclairs÷éclairs " * 9), (7, None), (8, ""), (9, "abc-defghij " * 7), (9, "abc-defghij " * 7), (11, "Q" * 50_000 + " " + "q" * 50_000)]
    rows += [(1000 + i, "q" * 50_000) for i in range(5)]
    frame = docs(rows).withColumn("word", F.lit("clash")).withColumn("n", F.lit("x"))
    got = rows_of(variants.spelling_variants(frame), *COLUMNS)
    want = expected(counted(rows))
    assert got == want
    assert any(r[1] for r in want)


def test_chains_of_forms_are_followed(spark, rows_of):
    links = [(f"w{i}", f"w{i + 1}") for i in range(27)] + [("x", "w9"), ("y", "z")]
    got = rows_of(variants.with_roots(spark.createDataFrame(links, "word string, form string")), "word", "root")
    assert got == sorted([(w, "z" if w == "y" else "w27") for w, _ in links], key=repr)


def test_empty(docs):
    assert variants.spelling_variants(docs([])).collect() == []
    assert variants.spelling_variants(docs([(1, None), (2, "short w")])).collect() == []


def test_wavelet_matrix_reports_rectangles():
    rng = np.random.default_rng(2)
    for n in (1, 2, 5, 64, 100):
        values = rng.permutation(n)
        tree = variants.WaveletMatrix(values)
        l, lo = rng.integers(0, n, 50), rng.integers(0, n, 50)
        r, hi = rng.integers(l, n + 1), rng.integers(lo, n + 1)
        q, v = tree.report(l, r, lo, hi)
        want = [(i, x) for i in range(50) for x in values[l[i] : r[i]] if lo[i] <= x < hi[i]]
        assert sorted(zip(q.tolist(), v.tolist(), strict=True)) == sorted(want)


def test_one_letter_sets_are_never_cut_further(spark):
    n = {f"prefix{c}suffix": 5 + i for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")}
    words = spark.createDataFrame(list(n.items()), "word string, n long")
    got = {r.word: (r.n_near, r.best) for r in variants.near_words(words, set_rows=2).collect()}
    assert got == {w: (25, "prefixzsuffix" if w != "prefixzsuffix" else "prefixysuffix") for w in n}
