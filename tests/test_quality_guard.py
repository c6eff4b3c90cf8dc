import random
import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlens import guard
from ledgerlens.operators import bm25, evaluation, quality
from ledgerlens.plans import reconciliation

ALLOWED = ["SELECT 1", "select a from t where b = 'x; drop table y'", "WITH x AS (SELECT 1) SELECT * FROM x", "SELECT 1;", "SELECT 1 -- ; DROP", "(SELECT 1)", "SELECT `set` FROM t", "SELECT max(a) AS use FROM t"]
REJECTED = ["", ";", "SELECT 1; SELECT 2", "INSERT INTO t VALUES (1)", "DROP TABLE t", "SET a = 1", "SELECT 1 UNION ALL SELECT java_method('a', 'b')", "SELECT reflect('a', 'b')", "SELECT * FROM parquet.`/x`", "SELECT * FROM csv.`/x`", "SELECT /*+ MERGE(a) */ 1", "EXPLAIN SELECT 1", "CREATE TABLE x AS SELECT 1", "SELECT 'open", "SELECT * FROM read_files('/x')", "CACHE TABLE t", "SELECT TRANSFORM(a) USING 'cat' FROM t"]


@pytest.mark.parametrize("sql", ALLOWED)
def test_allowed(sql):
    assert guard.check(sql).ok, guard.check(sql).reason


@pytest.mark.parametrize("sql", REJECTED)
def test_rejected(sql):
    assert not guard.check(sql).ok


def test_run_sql(spark):
    tools = guard.Tools(spark, {"t": spark.range(300).select("id", (F.col("id") + 2**60).alias("big"))}, cap=5)
    got = tools.run_sql("SELECT id, big FROM t ORDER BY id")
    assert got["truncated"] and len(got["rows"]) == 5 and got["rows"][0] == [0, str(2**60)]
    assert "unknown table" in tools.run_sql("SELECT * FROM nowhere")["error"]
    assert "error" in tools.run_sql("SELECT no_such FROM t")
    assert tools.run_sql("SELECT  no_such FROM t")["repeated"]
    assert tools.run_sql("WITH x AS (SELECT id FROM t WHERE id < 2) SELECT count(*) AS n FROM x")["rows"] == [[2]]
    assert "error" in tools.run_sql("SELECT * FROM parquet.`/root`")
    assert tools.coverage("t", "id") == {"first": 0, "last": 299, "rows": 300}


def test_cells_and_grounding():
    assert guard.cell(2**53) == str(2**53) and guard.cell(5) == 5 and guard.cell(Decimal("1.50")) == "1.50"
    assert guard.cell(datetime.date(2024, 1, 2)) == "2024-01-02" and guard.cell(b"\xff") == "0xff" and guard.cell(b"ab") == "ab"
    assert guard.grounded("USDC", [[["USDC"]]]) and not guard.grounded("USDC", [[["usdc"]]]) and not guard.grounded(1, [[[2]], [[3]]])
    assert guard.grounded("0.30", [[[Decimal("0.3")]]]) and not guard.grounded(0.3, [[[0.1 + 0.2]]]) and guard.grounded(0.1, [[["0.1000000000000000055"]]]) and not guard.grounded("0.1", [[["0.1000000000000000055"]]])
    assert guard.grounded(["a", 2], [[["a"], [2]]]) and not guard.grounded(["a", 3], [[["a"], [2]]]) and not guard.grounded([], [[["a"]]]) and not guard.grounded(1, [[[True]]])
    assert guard.cause_of_ungrounded(2, [[[2]], [[3]]]) == "an earlier result"
    assert guard.cause_of_ungrounded("1.0000001", [[["1.0000002"]]]) == "only as a rounded number"


def test_ledger(tmp_path):
    ledger = guard.Ledger(str(tmp_path / "l.jsonl"), 1.0)
    assert ledger.allows(1) and not ledger.allows(1.01)
    ledger.add("0.75", "a call")
    assert ledger.allows("0.25") and not ledger.allows("0.26")


def test_two_writers_do_not_pass_the_limit_together(tmp_path):
    """Eight processes try to reserve ten dollars each of a limit of a hundred."""
    import subprocess
    import sys
    from pathlib import Path

    path = str(tmp_path / "l.jsonl")
    code = f"import sys; sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})\nfrom ledgerlens.guard import Ledger\nbook = Ledger({path!r}, 100)\nprint(sum(book.reserve(10, 'call') is not None for _ in range(5)))"
    runs = [subprocess.Popen([sys.executable, "-c", code], stdout=subprocess.PIPE, text=True) for _ in range(8)]
    assert sum(int(r.communicate(timeout=120)[0]) for r in runs) == 10
    book = guard.Ledger(path, 100)
    assert book.spent() == 100 and book.reserve("0.01", "more") is None
    name = guard.Ledger(str(tmp_path / "other"), 5).reserve(4, "call")
    other = guard.Ledger(str(tmp_path / "other"), 5)
    other.settle(name, 4, "1.5", "call")
    assert other.spent() == Decimal("1.5") and other.reserve("3.5", "next") is not None


def test_keys_listed_twice_are_told(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (4,)], "k long")
    right = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    assert sorted((r["k"], r["problem"]) for r in quality.symmetric_difference(left, right, ["k"]).collect()) == [(1, "listed twice"), (3, "missing"), (4, "not in the recomputation")]


def broken(spark):
    """Each rule with a table that breaks it once."""
    pools = spark.createDataFrame([("a", 500, "a 0.05%"), ("b", 100, "b 0.02%")], "pool string, fee int, label string")
    rows = spark.createDataFrame([("a", 1, "0x" + "0b" * 20, 5, -5, 0.5), ("a", 1, "0x" + "00" * 20, 7, 7, 1.5), ("C", 0, None, 1, -1, 0.1)], "pool string, k long, who string, x long, y long, share double")
    dims = spark.createDataFrame([("a", 500), ("b", 3000)], "pool string, fee int")
    return {
        "unique": quality.unique(rows, "pool", "k"), "not_default": quality.not_default(rows, "k"), "not_null": quality.not_null(rows, "who"), "accepted": quality.accepted(rows, "pool", ["a"]),
        "orphans": quality.orphans(rows, dims, "pool"), "denormalized": quality.denormalized_match(pools, dims, "pool", ["fee"]), "lower": quality.lower_case(rows, "pool"),
        "label": quality.label_states_fee(pools, "label", "fee"), "signs": quality.opposite_signs(rows, "x", "y"), "part": quality.part_of(rows, "share"),
    }


def test_every_rule_can_fail(spark):
    for name, found in broken(spark).items():
        assert found.count() == 1, name
    rows = spark.createDataFrame([("0x" + "0b" * 20,), ("0x" + "00" * 20,), ("0x0B",), (None,)], "who string")
    assert quality.well_formed(rows, "who", 20).count() == 3


def test_reconciliation_finds_one_planted_change_at_a_time(spark):
    days = [("p", f"2024-01-0{n}", 1000 * n) for n in range(1, 6)]
    frame = lambda rows, name: spark.createDataFrame(rows, f"pool string, day string, {name} long")
    left = frame(days, "cents")
    same = reconciliation.compare(left, frame(days, "ext")).collect()
    assert all(r["presence"] == "both" and r["rel"] == 0 for r in same)
    assert sorted(r["day"] for r in same if r["partial_day"]) == ["2024-01-01", "2024-01-05"]
    dearer = {r["day"]: r for r in reconciliation.compare(left, frame([(p, d, int(v * 1.05)) for p, d, v in days], "ext")).collect()}
    assert dearer["2024-01-03"]["rel"] == pytest.approx(1 / 1.05 - 1)
    missing = {r["day"]: r for r in reconciliation.flag(reconciliation.compare(left, frame(days[:2] + days[3:], "ext"))).collect()}
    assert (missing["2024-01-03"]["presence"], missing["2024-01-03"]["rel"], missing["2024-01-03"]["flag"]) == ("only_ours", None, None)


def test_statistics(spark):
    runs = spark.createDataFrame([(c, r, (c + r) % 3 > 0) for c in range(40) for r in range(3)], "case_id long, run long, correct boolean")
    row = evaluation.accuracy(runs).first()
    assert row["accuracy"] == pytest.approx(2 / 3) and row["low"] < 2 / 3 < row["high"]
    boot = evaluation.bootstrap(runs, 200).first()
    assert boot["low"] - 1e-9 <= boot["accuracy"] <= boot["high"] + 1e-9
    labels = spark.createDataFrame([(1, 1)] * 20 + [(1, 0)] * 5 + [(0, 1)] * 10 + [(0, 0)] * 15, "a int, b int")
    assert evaluation.kappa(labels, "a", "b").first()["kappa"] == pytest.approx(0.4)
    assert evaluation.kappa(spark.createDataFrame([(1, 1)], "a int, b int"), "a", "b").first()["kappa"] is None
    sizes = spark.createDataFrame([("a", 50), ("b", 30), ("c", 21)], "stratum string, size long")
    assert {r["stratum"]: r["quota"] for r in evaluation.quotas(sizes, 10).collect()} == {"a": 5, "b": 3, "c": 2}


def test_long_sections_are_cut_at_blank_lines():
    rng = random.Random(2)
    for _ in range(50):
        parts = ["p" * rng.randint(1, 400) for _ in range(rng.randint(1, 12))]
        pieces = [t for _, t in bm25.chunks_of("# H\n" + "\n\n".join(parts))]
        assert "\n\n".join(pieces) == "\n\n".join(parts)
        whole = len("\n\n".join(parts))
        assert len(pieces) == 1 if whole <= bm25.LONGEST or len(parts) == 1 else 1 < len(pieces) <= -(-whole // bm25.LONGEST)
    assert bm25.chunks_of("~~~\n# no\n```\n# no\n~~~\n# yes\ntext") == [("", "~~~\n# no\n```\n# no\n~~~"), ("yes", "text")]
    assert bm25.chunks_of("") == [] and bm25.chunks_of("# alone") == [("alone", "")]


def test_chunks_and_search(spark):
    text = "intro words\n\n# Fees\nA fee is taken.\n```\n# not a heading\n```\n## Gaps\nGaps between prices."
    pieces = bm25.chunks_of(text)
    assert [h for h, _ in pieces] == ["", "Fees", "Gaps"] and "# not a heading" in pieces[1][1]
    chunks = spark.createDataFrame([(n, h, b) for n, (h, b) in enumerate(pieces)], "chunk_id long, heading string, text string")
    asked = spark.createDataFrame([(1, "what is the fee"), (2, "gaps"), (3, "nothing of this")], "query_id long, text string")
    found = {(r["query_id"], r["place"]): r["chunk_id"] for r in bm25.Index(chunks).search(asked).collect()}
    assert found[1, 1] == 1 and found[2, 1] == 2 and (3, 1) not in found
    relevant = spark.createDataFrame([(1, 1), (2, 2), (3, 0)], "query_id long, chunk_id long")
    row = bm25.retrieval_metrics(bm25.Index(chunks).search(asked), relevant).first()
    assert (row["queries"], row["found"]) == (3, 2) and row["mrr"] == pytest.approx(2 / 3)


@pytest.mark.parametrize("cases", [1, 37, 400])
def test_draws_take_exactly_as_many_cases_as_there_are(spark, monkeypatch, cases):
    monkeypatch.setattr(evaluation, "RANGE_CASES", 30)
    per = spark.createDataFrame([(i, float(i % 5 == 0)) for i in range(cases)], "case_id long, share double")
    drawn = evaluation._drawn(per, 300, 7).collect()
    assert len(drawn) == 300 and {r["cases"] for r in drawn} == {cases}
    p = sum(i % 5 == 0 for i in range(cases)) / cases
    mean = sum(r["total"] for r in drawn) / 300
    spread = sum((r["total"] - mean) ** 2 for r in drawn) / 299
    assert abs(mean - cases * p) <= 4 * (cases * p * (1 - p) / 300) ** 0.5 + 1e-9
    assert p in (0, 1) or 0.7 < spread / (cases * p * (1 - p)) < 1.35
    again = evaluation._drawn(per.repartition(5), 300, 7).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, drawn))


def test_draws_of_no_cases(spark):
    assert evaluation._drawn(spark.createDataFrame([], "case_id long, share double"), 10, 1).count() == 0


@pytest.mark.parametrize("limits", [{}, {"rare": 2, "step": 2}, {"rare": 1, "step": 5}])
def test_search_by_bounds_finds_what_all_scores_say(spark, limits):
    """Words of very different frequency; some queries hold common ones only, one holds none known."""
    from pyspark.sql.window import Window

    rng = random.Random(4)
    word = lambda: f"w{int(rng.paretovariate(0.7)) % 300}"
    chunks = spark.createDataFrame([(f"c{i:04}", " ".join(word() for _ in range(2)), " ".join(word() for _ in range(rng.randint(0, 60)))) for i in range(200)], "chunk_id string, heading string, text string")
    asked = [(i, " ".join(word() for _ in range(rng.randint(1, 12)))) for i in range(40)] + [(90, "w1"), (91, "w1 w2 w3"), (92, "unknown"), (93, None)]
    queries = spark.createDataFrame(asked, "query_id long, text string")
    index = bm25.Index(chunks)
    got = {(r["query_id"], r["place"]): (r["chunk_id"], round(r["score"], 6)) for r in index.search(queries, 5, **limits).collect()}
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 9)), "chunk_id"))
    want = {(r["query_id"], r["place"]): (r["chunk_id"], round(r["score"], 6)) for r in index.scores(queries).withColumn("place", place).filter("place <= 5").collect()}
    assert got == want and len(want) > 150


@pytest.mark.parametrize("limits", [{}, {"rare": 1, "step": 3}])
def test_search_stores_no_pairs_and_agrees_over_groups(spark, monkeypatch, limits):
    """Chunks of small groups, many of them the same text: what is stored are the chunks alone."""
    from pyspark.sql.window import Window

    rng = random.Random(8)
    texts = ["same words again", *(" ".join(f"w{rng.randint(0, 40)}" for _ in range(rng.randint(0, 30))) for _ in range(60))]
    chunks = spark.createDataFrame([(i, "", texts[0] if i % 2 else texts[rng.randint(0, 60)]) for i in range(300)], "chunk_id long, heading string, text string").repartition(5)
    queries = spark.createDataFrame([(i, " ".join(texts[i : i + 3])) for i in range(20)], "query_id long, text string")
    index, rows, stored = bm25.Index(chunks), [], bm25.stored

    def counted(df, label):
        rows.append((kept := stored(df, label)).count())
        return kept

    monkeypatch.setattr(bm25, "stored", counted)
    monkeypatch.setattr(bm25, "GROUP_WORDS", 200, raising=False)
    got = {(r["query_id"], r["place"]): (r["chunk_id"], round(r["score"], 6)) for r in index.search(queries, 5, **limits).collect()}
    assert rows == [300]
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 9)), "chunk_id"))
    assert got == {(r["query_id"], r["place"]): (r["chunk_id"], round(r["score"], 6)) for r in index.scores(queries).withColumn("place", place).filter("place <= 5").collect()}
    assert bm25.Index(chunks.limit(0)).search(queries).count() == 0


def test_search_copies_no_query_for_a_group(spark, monkeypatch):
    """However many groups there are, chunks and queries are stored once and only results shuffled."""
    rng = random.Random(9)
    text = lambda n: " ".join(f"w{rng.randint(0, 60)}" for _ in range(n))
    chunks = spark.createDataFrame([(i, "", text(rng.randint(0, 30))) for i in range(200)] + [(200, "", text(400))], "chunk_id long, heading string, text string").repartition(2)
    queries = spark.createDataFrame([(i, text(6)) for i in range(30)], "query_id long, text string")
    shown = lambda found: sorted((r["query_id"], r["place"], r["chunk_id"], round(r["score"], 6)) for r in found.collect())
    whole = shown(bm25.Index(chunks).search(queries))
    kept, files = {}, bm25._files
    monkeypatch.setattr(bm25, "_files", lambda rows, label: kept.setdefault(label, files(rows, label)))
    monkeypatch.setattr(bm25, "GROUP_WORDS", 100)
    monkeypatch.setattr(bm25, "PART_TERMS", 20)
    found = bm25.Index(chunks).search(queries)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and plan.count("Exchange") == 1
    groups, parts = (kept[k].select(F.explode(c)) for k, c in (("bm25-groups", "ids"), ("bm25-queries", "queries")))
    assert kept["bm25-groups"].count() > 25 and groups.count() == groups.distinct().count() == 201
    assert kept["bm25-queries"].count() > 5 and parts.count() == parts.distinct().count() == 30
    assert shown(found) == whole and len(whole) == 150
