import hashlib
import random
import re

from pyspark.sql import functions as F

from ledgerlens.llm import exactdedup, shared


def brute(rows):
    norm = {n: re.sub(r"[\x20\x09-\x0D]", "", t or "") for n, (_, t) in enumerate(rows)}
    groups = {}
    for n, text in norm.items():
        groups.setdefault(text, []).append(n)
    keep = {x: max(ns, key=lambda n: (len(rows[n][1] or ""), -(rows[n][0]))) for x, ns in groups.items()}
    return sorted((i, rows[keep[norm[n]]][0], len(groups[norm[n]]), hashlib.sha256(norm[n].encode()).hexdigest()) for n, (i, _) in enumerate(rows))


def written(docs, rows, path):
    docs(rows).write.mode("append").parquet(str(path))
    return str(path)


def result(df):
    return sorted((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in df.collect())


def make(n=120, seed=1):
    rng = random.Random(seed)
    texts = ["same words here", "same  words here", "samewords\there ", "other", "", None, " \n", "é x", "é x", "long " * 20_000]
    return [(i, rng.choice(texts)) for i in range(n)]


def test_against_brute_force(spark, docs, tmp_path):
    rows = make()
    out = exactdedup.dedup_exact(spark, written(docs, rows, tmp_path / "d.parquet"))
    assert result(out) == brute(rows)
    kept = out.filter("kept").collect()
    assert all(r["doc_id"] == r["keep_id"] for r in kept) and len(kept) == len({x[3] for x in brute(rows)})


def test_more_files_continue_the_state(spark, docs, tmp_path):
    rows, more = make(40, 2), [(i + 1000, t) for i, t in make(40, 3)] + [(5000, "same words here, not")]
    path = written(docs, rows, tmp_path / "d.parquet")
    home = shared.shared_dir(spark, "test-dedup")
    assert result(exactdedup.dedup_exact(spark, path, home)) == brute(rows)
    written(docs, more, path)
    state = exactdedup.StreamingDedup(spark, home)
    state.advance(path)
    assert result(state.result()) == brute(rows + more)
    assert state.catalog().count() == len(rows + more)


def test_equal_digests_of_different_texts_are_told_apart(spark, docs, tmp_path):
    rows = make(60, 4) + [(i + 100, f"text {i}") for i in range(40)]
    path = written(docs, rows, tmp_path / "d.parquet")
    weak = exactdedup.StreamingDedup(spark, shared.shared_dir(spark, "test-dedup"), digest=lambda c: F.substring(exactdedup.sha256(c), 1, 1))
    weak.advance(path)
    groups = weak.groups()
    assert weak.unequal(groups, weak.hot(groups)).count() > 3
    assert result(weak.result()) == brute(rows)


def test_repeats_nulls_and_empty_tables(spark, docs, tmp_path):
    out = exactdedup.dedup_exact(spark, written(docs, [(1, "a b"), (1, "a b"), (None, "ab"), (None, "c")], tmp_path / "d.parquet")).collect()
    assert sorted((r["doc_id"] or 0, r["keep_id"] or 0, r["group_size"]) for r in out) == [(0, 0, 1), (0, 1, 3), (1, 1, 3), (1, 1, 3)]
    assert sum(r["kept"] for r in out) == 2
    assert exactdedup.dedup_exact(spark, written(docs, [], tmp_path / "none.parquet")).count() == 0


def test_state_lies_on_disk_without_expiry(spark, docs, tmp_path):
    state = exactdedup.StreamingDedup(spark, shared.shared_dir(spark, "test-dedup"))
    before = spark.conf.get(exactdedup.PROVIDER)
    state.advance(written(docs, make(20), tmp_path / "d.parquet"))
    assert spark.conf.get(exactdedup.PROVIDER) == before
    groups = state.groups().collect()
    assert all(g["best"]["file"].endswith(".parquet") and g["best"]["row"] >= 0 for g in groups)


def test_large_groups_are_dealt_in_parts(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(exactdedup, "PART_ROWS", 10)
    rows = [(i, "the same text") for i in range(200)] + [(1000 + i, f"own {i % 90}") for i in range(100)]
    path = written(docs, rows, tmp_path / "d.parquet")
    state = exactdedup.StreamingDedup(spark, shared.shared_dir(spark, "test-dedup"))
    state.advance(path + "/")
    groups = state.groups()
    hot = state.hot(groups).collect()
    assert [r["parts"] for r in hot] == [20]
    parts = state._dealt(state.catalog(), state.hot(groups)).groupBy("digest", "part").count()
    assert parts.filter("count > 1").count() > 20 and parts.agg(F.max("count")).first()[0] < 40
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = state.unequal(groups, state.hot(groups))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # texts meet by digest and part, never by digest alone
    assert re.search(r"SortMergeJoin \[digest#\d+, part#\d+", plan) and not re.search(r"SortMergeJoin \[digest#\d+\]", plan)
    assert result(state.result()) == brute(rows)


def test_bytes_of_all_folders_are_compared(spark, docs, tmp_path):
    rows, more = make(30, 5), [(i + 1000, t) for i, t in make(30, 6)]
    state = exactdedup.StreamingDedup(spark, shared.shared_dir(spark, "test-dedup"), digest=lambda c: F.substring(exactdedup.sha256(c), 1, 1))
    state.advance(written(docs, rows, tmp_path / "one.parquet"))
    state.advance(written(docs, more, tmp_path / "two.parquet"))
    assert result(state.result()) == brute(rows + more)


def test_columns_with_clashing_names(spark, docs, tmp_path):
    rows = make(20, 7)
    more = docs(rows)
    for name in ("digest", "norm", "part", "parts", "file", "best"):
        more = more.withColumn(name, F.lit(1))
    more.write.parquet(str(tmp_path / "d.parquet"))
    assert result(exactdedup.dedup_exact(spark, str(tmp_path / "d.parquet"))) == brute(rows)
