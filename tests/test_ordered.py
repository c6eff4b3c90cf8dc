import math

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.quantiles import exact_by_rank, nearest_index, nearest_rank, tercile, upper_element
from ledgerlens.operators import ordered, ranking
from ledgerlens.plans import analyses, reconciliation

# One pool sets the price; the other moves away by 20 bps and stays, until the first catches up;
# then the first drops by 30 bps and the other follows in the same block.
PLANTED = [("hi", 100, 0, 1.0), ("lo", 100, 1, 1.0), ("lo", 101, 0, 1.002), ("lo", 101, 1, 1.0021), ("hi", 103, 0, 1.002), ("hi", 104, 0, 0.999), ("lo", 104, 5, 0.999)]


def stream(spark, rows, width):
    data = [("p", m, b * 2**32 + i, b, f"{b}-{i}" if len(r) == 4 else r[4], math.sqrt(price)) for r in rows for m, b, i, price in [r[:4]]]
    frame = spark.createDataFrame(data, "pair string, mover string, pos long, blk long, tx string, sp double")
    return frame.withColumn("bucket", F.floor(F.col("blk") / width))


@pytest.mark.parametrize("width", [1, 2, 1000])
def test_planted_gaps_and_episodes(spark, width):
    found = ordered.gaps(stream(spark, PLANTED, width), "bucket")
    rows = found.collect()
    assert len(rows) == 6 and sum(r["mover"] == "lo" for r in rows) == 4
    assert max(abs(r["gap_bps"]) for r in rows) == pytest.approx(1e4 * math.log(1.0021 / 0.999))
    assert sum(abs(r["gap_bps"]) > 6 for r in rows) == 3
    report = analyses.episode_report(ordered.episodes(found, 6.0, "bucket")).first()
    assert (report["episodes"], report["still_open"], report["same_block"], report["two_or_more"], report["lasted_max"]) == (2, 0, 1, 1, 2)
    assert (report["opened_by_lo"], report["opened_by_hi"], report["closed_by_lo"], report["closed_by_hi"], report["closed_by_other"]) == (1, 1, 1, 1, 2)


def test_open_and_one_transaction_episodes(spark):
    start = [("hi", 100, 0, 1.0), ("lo", 100, 1, 1.0)]
    still = analyses.episode_report(ordered.episodes(ordered.gaps(stream(spark, [*start, ("lo", 101, 0, 1.01)], 1), "bucket"), 6.0, "bucket")).first()
    assert (still["episodes"], still["still_open"], still["closed_by_lo"] + still["closed_by_hi"]) == (1, 1, 0)
    once = analyses.episode_report(ordered.episodes(ordered.gaps(stream(spark, [*start, ("lo", 101, 0, 1.01, "t"), ("hi", 101, 1, 1.01, "t")], 1), "bucket"), 6.0, "bucket")).first()
    assert (once["episodes"], once["within_one_tx"]) == (1, 1)


def test_block_ends(spark):
    found = ordered.gaps(stream(spark, PLANTED, 2), "bucket")
    ends = found.groupBy("blk").agg(F.max_by(F.abs("gap_bps"), "pos").alias("a")).collect()
    assert len(ends) == 4 and sum(r["a"] <= 6 for r in ends) == 3


def test_displaced_trades(spark):
    """Thirty calm trades, a push, a victim and the way back, thirty calm trades."""
    ticks = [198_000] * 30 + [190_000, 190_000, 198_000] + [198_000] * 30
    rows = spark.createDataFrame([("p", n, n // 7, t) for n, t in enumerate(ticks)], "pool string, pos long, bucket long, tick long")
    for chunk in (64, 65_536):
        step = ordered.Buckets(rows, ["pool"], "pos", "bucket")
        assert ordered.with_borders(step, 10, chunk).filter("own").count() == 63
    found = reconciliation.displaced(rows, "bucket").filter("displacement > 100").orderBy("pos").collect()
    assert [r["pos"] for r in found] == [30, 31, 32] and max(r["displacement"] for r in found) == 8000


def test_chunks_with_borders_see_what_a_whole_window_sees(spark):
    import random

    from pyspark.sql.window import Window

    rng = random.Random(1)
    rows = spark.createDataFrame([("ab"[n % 3 == 0], n, n // 13, rng.randint(0, 99)) for n in range(500)], "pool string, pos long, bucket long, tick long")
    whole = rows.withColumn("m", ordered.rolling_median(F.col("tick"), Window.partitionBy("pool").orderBy("pos")))
    chunks = ordered.with_borders(ordered.Buckets(rows, ["pool"], "pos", "bucket"), 10, 32)
    cut = chunks.withColumn("m", ordered.rolling_median(F.col("tick"), Window.partitionBy("pool", "chunk").orderBy("pos"))).filter("own")
    pick = lambda df: sorted((r["pool"], r["pos"], r["m"]) for r in df.collect())
    assert pick(whole) == pick(cut)


def test_placebo_equals_displaced_counts(spark):
    rows = spark.createDataFrame([("p", "2024-01-01", n, 100, 130 if n < 3 else 100, 500 if n < 3 else 0) for n in range(30)], "pool string, day string, pos long, tick long, at_reference long, displacement long")
    for r in reconciliation.placebo(rows, 200, [1, 2]).collect():
        assert (r["displaced_swaps"], r["placebo_swaps"], r["delta_all"], r["delta_displaced"], r["delta_placebo"]) == (3, 3, 90, 90, 0)


def test_what_if_and_pearson(spark):
    days = spark.createDataFrame([(0.03, 0.0), (-0.03, 0.0), (0.001, 0.02)], "rel double, new_rel double")
    assert tuple(reconciliation.what_if(days).first()) == (1, 1, 1)
    rows = spark.createDataFrame([("up", 1.0, 2.0), ("up", 2.0, 4.0), ("up", 3.0, 6.0), ("flat", 1.0, 2.0), ("flat", 1.0, 3.0), ("flat", 1.0, 4.0), ("few", 1.0, 1.0), ("few", 2.0, 2.0)], "k string, a double, b double")
    got = {r["k"]: r["r"] for r in reconciliation.pearson(rows, ["k"], "a", "b").collect()}
    assert got["up"] == pytest.approx(1) and got["flat"] is None and got["few"] is None


def test_quantile_rules(spark):
    row = spark.range(1).select(F.array(*[F.lit(x) for x in (4, 1, 3, 2)]).alias("v"))
    got = row.select(upper_element(F.col("v"), 0.5).alias("a"), nearest_index(F.col("v"), 0.5).alias("b"), nearest_rank(F.col("v"), 0.5).alias("c")).first()
    assert tuple(got) == (3, 3, 2)
    many = spark.range(1000).select((F.col("id") % 3).alias("k"), (F.col("id") % 50).cast("double").alias("v"))
    by_rank = {r["k"]: r["p"] for r in exact_by_rank(many, ["k"], "v", {"p": 0.9}).collect()}
    by_array = {r["k"]: r["p"] for r in many.groupBy("k").agg(upper_element(F.collect_list("v"), 0.9).alias("p")).collect()}
    assert by_rank == by_array
    small = spark.createDataFrame([(1.2e-7,), (3.4e-7,), (-5.6e-9,), (None,)], "v double")
    assert tuple(exact_by_rank(small, [], "v", {"low": 0.0, "mid": 0.5, "top": 1.0}).first()) == (-5.6e-9, 1.2e-7, 3.4e-7)
    none = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", None)], "k string, v double")
    assert [tuple(r) for r in exact_by_rank(none, ["k"], "v", {"p": 0.5}).collect()] == [(None, 2.0)]
    thirds = [r["t"] for r in spark.range(1, 12).select(tercile(F.col("id"), F.lit(11)).alias("t")).collect()]
    assert thirds == [0] * 3 + [1] * 3 + [2] * 5


def test_global_rank(spark):
    rows = spark.range(500).select("id", ((F.col("id") * 37) % 101).alias("v"))
    got = {r["id"]: r["place"] for r in ranking.global_rank(rows, [F.desc("v"), F.asc("id")], "place", 7).collect()}
    want = sorted(range(500), key=lambda i: (-((i * 37) % 101), i))
    assert got == {i: n for n, i in enumerate(want, 1)}


def test_global_rank_has_no_gap_beside_columns_that_do_not_order(spark):
    # the ranges' sizes need the key only: by a plan of their own they came from other bounds, and places were given twice
    n = 40_000
    rows = spark.range(n).select("id", ((F.col("id") * 7_919) % 40_009).alias("v"), F.hex("id").alias("more"))
    placed = ranking.global_rank(rows, [F.desc("v")], "place", 7)
    assert placed.columns == ["id", "v", "more", "place"]
    want = {i: k for k, i in enumerate(sorted(range(n), key=lambda i: -((i * 7_919) % 40_009)), 1)}
    assert {r["id"]: r["place"] for r in placed.collect()} == want
    few = ranking.global_rank(rows, [F.desc("v")], "place", 7, keep=["id"])
    assert few.columns == ["id", "place"] and {r["id"]: r["place"] for r in few.collect()} == want


def random_stream(spark, n, pairs=("p",), seed=3):
    import random

    rng = random.Random(seed)
    rows = [(rng.choice(pairs), rng.choice(["lo", "hi"]), i, i // 3, i // 2, rng.choice([1.0, 1.001, 1.002, 0.9985, 1.004]), i // 17) for i in range(n)]
    return rows, spark.createDataFrame(rows, "pair string, mover string, pos long, blk long, tx long, sp double, bucket long")


def plain_episodes(rows, fee):
    """Runs of trades beyond the fee in one pass over each pair."""
    out = []
    for pair in sorted({r[0] for r in rows}):
        last, run, before, found = {}, 0, False, []
        for _, mover, pos, blk, tx, sp, _ in (r for r in rows if r[0] == pair):
            other = last.get("hi" if mover == "lo" else "lo")
            last[mover] = sp
            if other is None:
                continue
            low, high = (sp, other) if mover == "lo" else (other, sp)
            is_open = abs(2e4 * math.log(low / high)) > fee
            if is_open != before or not found:
                run += is_open != before
                found.append([run, is_open, 0, blk, mover, tx])
            before = is_open
            found[-1][2] += 1
        for this, after in zip(found, [*found[1:], None], strict=True):
            if this[1]:
                out.append((pair, this[0], this[2], *this[3:], *(after[3:] if after else (None, None, None))))
    return sorted(out, key=str)


@pytest.mark.parametrize("pairs", [("one",), ("a", "b", "c")])
def test_episodes_of_one_hot_pair(spark, pairs):
    rows, frame = random_stream(spark, 900, pairs)
    got = ordered.episodes(ordered.gaps(frame, "bucket"), 25.0, "bucket")
    columns = ("pair", "run_id", "trades", "open_blk", "opened_by", "open_tx", "close_blk", "closed_by", "close_tx")
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=str) == plain_episodes(rows, 25.0)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    windows = [w for w in plan.splitlines() if "Window [" in w and "run_id" in w]
    assert windows and all("_b" in w.rsplit("], [", 2)[-2] for w in windows if "run_id" in w.rsplit("], [", 1)[-1])


def test_first_after(spark):
    rows = spark.createDataFrame([("k", i, i // 4, None if i % 5 else i) for i in range(23)], "k string, pos long, b long, v long")
    got = ordered.Buckets(rows, ["k"], "pos", "b").first_after({"after": F.col("v")}).df.collect()
    assert {r["pos"]: r["after"] for r in got} == {i: next((j for j in range(i + 1, 23) if j % 5 == 0), None) for i in range(23)}


@pytest.mark.parametrize("parts", [1, 5])
def test_asof_joins_agree_row_by_row(spark, parts):
    _, frame = random_stream(spark, 700, ("a", "b", None))
    named = frame.fillna("none", ["pair"])
    one = ordered.gaps(named, "bucket").select("pair", "pos", "mover", F.col("gap_bps").alias("one"))
    two = ordered.asof_by_ranges(named, parts).select("pair", "pos", "mover", F.col("gap_bps").alias("two"))
    found = analyses.compared(one, two).collect()
    assert sum(r["rows_both"] for r in found) == one.count() and all(r["rows_one"] == 0 and r["apart"] == 0 for r in found)
    wrong = two.withColumn("two", F.when(F.col("pos") == 100, F.col("two") + 1e-6).otherwise(F.col("two"))).filter("pos != 101")
    found = analyses.compared(one, wrong).collect()
    assert sum(r["apart"] for r in found) == 1 and sum(r["rows_one"] for r in found) == 1
