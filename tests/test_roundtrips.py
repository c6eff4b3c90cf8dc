import pytest

from ledgerlens.operators import roundtrips
from ledgerlens.plans import analyses

COLUMNS = "pool string, blk long, log_index long, sender string, tx long, other_raw long, usd double, ts timestamp"


def rows(spark, data):
    import datetime

    at = datetime.datetime(2026, 9, 1, 12)
    return spark.createDataFrame([("p", b, i, who, tx, raw, usd, at) for b, i, tx, who, raw, usd in data], COLUMNS)


SHAPES = [
    (10, 0, 1, "bot", -1000, 1000.0), (10, 1, 2, "other", -5, 5.0), (10, 2, 3, "bot", 1000, 1000.0),
    (20, 0, 4, "bot", -200, 200.0), (20, 1, 5, "bot", 200, 200.0),
    (30, 0, 6, "bot", -30, 30.0), (30, 1, 6, "bot", 30, 30.0),
]


def test_what_sits_between(spark):
    got = {r["kind"][0]: (r["pairs"], r["usd"]) for r in roundtrips.between(rows(spark, SHAPES)).collect()}
    assert got == {"1": (1, 2000.0), "2": (1, 400.0), "3": (1, 60.0)}


def test_legs_and_daily(spark):
    t = rows(spark, SHAPES)
    legs = {(r["blk"], r["log_index"]): r for r in roundtrips.legs(t).collect()}
    assert len(legs) == 6 and (10, 1) not in legs
    assert legs[30, 0]["in_one_tx"] and not legs[20, 0]["in_one_tx"]
    (day,) = roundtrips.daily(t).collect()
    assert (day["round_trips"], day["leg_trades"], day["trades"], day["net_usd"]) == (3, 6, 7, pytest.approx(5.0))


def test_same_direction_and_zero_legs_are_no_round_trip(spark):
    assert roundtrips.pairs(rows(spark, [(1, 0, 1, "a", 100, 1.0), (1, 1, 2, "a", 100, 1.0), (2, 0, 3, "a", 0, 1.0), (2, 1, 4, "a", 0, 1.0), (3, 0, 5, "a", 0, 1.0), (3, 1, 6, "a", 7, 1.0)])).count() == 0


def test_tolerance_is_inclusive(spark):
    t = rows(spark, [(1, 0, 1, "a", 100, 1.0), (1, 1, 2, "a", -90, 1.0)])
    assert roundtrips.pairs(t, 0.1).count() == 1 and roundtrips.pairs(t, 0.099).count() == 0
    levels = {r["tolerance"]: (r["pairs"], r["legs"]) for r in roundtrips.by_tolerance(t, [0.0, 0.1, 0.5]).collect()}
    assert levels == {0.1: (1, 2), 0.5: (1, 2)}


def test_concentration(spark):
    legs = spark.createDataFrame([("a", 60.0), ("b", 30.0), ("b", 0.0), ("c", 10.0)], "sender string, usd double")
    r = analyses.concentration(legs).first()
    assert (r["senders"], r["total_legs"], r["total_usd"], r["top1_usd"], r["top3_usd"], r["top1_legs"]) == (3, 4, 100.0, 0.6, 1.0, 0.25)
    assert not any(isinstance(v, str) for v in r)


@pytest.mark.parametrize("width", [3, 1 << 14])
def test_others_between_are_counted_by_places(spark, monkeypatch, width):
    """One block of many trades, cut into buckets of its order; one sender has a third of it."""
    import random

    monkeypatch.setattr(roundtrips, "BUCKET", width)
    rng = random.Random(2)
    data = [(1 + i % 2, i, i // 2, rng.choice(["hot", "a", "b"]), rng.choice([-100, -95, 98, 100]), 1.0) for i in range(60)]
    got = {(r["blk"], r["first_log"], r["second_log"]): r["others"] for r in roundtrips.with_others(rows(spark, data)).collect()}
    want = {}
    for blk, i, _, who, raw, _ in data:
        for blk2, j, _, who2, raw2, _ in data:
            if blk == blk2 and who == who2 and i < j and (raw > 0) != (raw2 > 0) and abs(raw + raw2) / abs(raw) <= 0.1:
                want[blk, i, j] = sum(b == blk and i < k < j and w != who for b, k, _, w, _, _ in data)
    assert got == want and any(want.values())
