import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline as pipeline

from .test_linededup import brute as brute_lines
from .test_mixing import brute_targets
from .test_neardup import brute as brute_near


@pytest.fixture
def corpus(spark, docs, tmp_path):
    rng = random.Random(4)
    line = "This line is shared by a lot of documents"
    rows = []
    for i in range(240):
        text = " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randint(10, 60)))
        if i % 6 == 0:
            text += " " + " ".join(rng.choices(["vile", "nasty", "grump"], k=4))
        if i % 4 == 1:
            text += f"\n{line}"
        rows.append((i, text, f"s{i % 3}"))
    rows += [(1000 + i, rows[i][1] + " extra", "s9") for i in range(1, 60, 7)] + [(2000, None, None), (2001, "", "s1")]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(240)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path), rows


def test_stages_one_by_one(spark, corpus):
    path, rows = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    clean = pipeline.drop_toxic(spark, docs, path)
    assert clean.columns == docs.columns
    left = {r["doc_id"]: r for r in clean.collect()}
    toxic = {i for i, t, _ in rows if t and "nasty" in t or t and "vile" in t or t and "grump" in t}
    assert set(left) == {i for i, _, _ in rows} - toxic

    lines = pipeline.drop_shared_lines(spark, clean, path)
    want = {i: text for i, _, _, text in brute_lines([(i, r["text"]) for i, r in left.items()])}
    got = {r["doc_id"]: r for r in lines.collect()}
    assert {i: r["text"] for i, r in got.items()} == want
    assert all(r["n_chars"] == len(r["text"]) and r["source"] == left[i]["source"] for i, r in got.items())

    near = pipeline.drop_near_copies(spark, lines, path)
    kept = {r["doc_id"] for r in near.collect()}
    assert kept == {i for i, (_, _, _, keep) in brute_near(list(want.items())).items() if keep}
    assert near.columns == docs.columns

    mixed = pipeline.mix_to_targets(spark, near, path)
    assert mixed.columns == docs.columns
    sizes, taken = {}, {}
    for i in kept:
        s = got[i]["source"]
        sizes[s] = sizes.get(s, 0) + len(want[i].split())
    for r in mixed.collect():
        assert r["text"] == want[r["doc_id"]]
        taken[r["source"]] = taken.get(r["source"], 0) + len(r["text"].split())
    for s, target in brute_targets(sizes).items():
        assert abs(taken.get(s, 0) - target) <= 35

    pieces = pipeline.pack(spark, mixed, path).collect()
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in mixed.collect()}


def test_run_is_the_stages_in_turn(spark, corpus):
    path, _ = corpus
    assert pipeline.run(spark, path).columns[0] == "doc_id"
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "line dedup", "near dedup", "mix", "pack"]


def test_empty_table(spark, docs, tmp_path):
    docs([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    empty = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in pipeline.STAGES:
        out = stage(spark, empty, str(tmp_path))
        assert out.count() == 0, name
        assert name == "pack" or out.columns == list(pipeline.COLUMNS)


def test_repeated_and_null_ids_lose_no_clean_text(spark, docs, tmp_path):
    """Of rows with one id or none a row stays for each text; the rest of the stages keep all."""
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    text = lambda n: " ".join(f"w{n}x{k}" for k in range(30))
    rows = [(None, text(1), "a"), (None, text(2), "a"), (None, text(1), "b"), (7, text(3), "a"), (7, text(4), "b"), (7, text(3), "a"), (8, text(4), "a"), (9, None, None), (9, "", "a"), (None, None, "a")]
    frame = docs(rows)
    for stage in (pipeline.drop_toxic, pipeline.drop_shared_lines):
        assert stage(spark, frame, str(tmp_path)).count() == len(rows)
    for parts in (1, 5):
        got = pipeline.drop_near_copies(spark, frame.repartition(parts), str(tmp_path)).collect()
        assert sorted((r["doc_id"] or 0, r["text"] or "", r["source"] or "") for r in got) == sorted([(0, text(1), "a"), (0, text(2), "a"), (7, text(3), "a"), (7, text(4), "b"), (9, "", "a"), (0, "", "a")])
    mixed = pipeline.mix_to_targets(spark, docs([(1, "", "s"), (2, text(5), "s"), (3, text(6), "t"), (4, text(7), "u"), (5, None, "s")]), str(tmp_path)).groupBy("doc_id").count().collect()
    assert max(r["count"] for r in mixed) <= 3


def test_columns_with_clashing_names(spark, docs, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    more = docs([(1, "one text here", "a"), (2, "another text here", "b")])
    for name in ("row", "did", "th", "key", "place", "copy", "kept", "size", "toxic", "pid", "ids"):
        more = more.withColumn(name, F.lit(1))
    for name, stage in pipeline.STAGES:
        out = stage(spark, more, str(tmp_path))
        assert {r["doc_id"] for r in out.collect()} == {1, 2}, name
