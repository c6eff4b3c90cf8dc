import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import decode, money

VALUES = [0, 1, -1, 2**100, -(2**100), 10**37, -(10**38) + 1, 10**38 - 1]


def word(value: int) -> str:
    return f"{value % (1 << 256):064x}"


def test_int256_is_exact_up_to_38_digits(spark):
    rows = spark.createDataFrame([(str(v), word(v)) for v in VALUES], "v string, w string")
    for r in rows.select("v", decode.int256(F.col("w")).cast("string").alias("got")).collect():
        assert int(r["got"]) == int(r["v"])


@pytest.mark.parametrize("value", [10**38, -(10**38), 2**255 - 1, -(2**255)])
def test_beyond_38_digits_is_null_or_an_error(spark, value):
    rows = spark.createDataFrame([(word(value),)], "w string")
    assert rows.select(decode.int256_or_null(F.col("w")).alias("x")).first()["x"] is None
    with pytest.raises(Exception, match="38 digits"):
        rows.select(decode.int256(F.col("w"))).collect()


def test_unsigned_and_small_words(spark):
    big = (1 << 160) - 1
    row = spark.createDataFrame([(word(big), word(-5), word(8_388_607), word(1 << 23))], "a string, b string, c string, d string")
    got = row.select(decode.uint_double(F.col("a")).alias("a"), *[decode.int24(F.col(c)).alias(c) for c in "bcd"]).first()
    assert (got["a"], got["b"], got["c"], got["d"]) == (float(big), -5, 8_388_607, None)


def log(**change):
    base = {
        "removed": False, "address": "0x" + "AB" * 20, "topics": [decode.TRADE_TOPIC, "0x" + "00" * 12 + "0b" * 20, "0x" + "00" * 12 + "0c" * 20],
        "data": "0x" + word(-5) + word(7) + word(2**96) + word(10**18) + word(-100), "blockNumber": "0x10", "transactionIndex": "0x2", "logIndex": "0x3",
        "blockTimestamp": "0x65920080", "blockHash": "0xAA", "transactionHash": "0xBB",
    }
    return base | change


def decoded(spark, *logs):
    from ledgerlens.sources.landing import LOG

    rows = spark.createDataFrame([(x,) for x in logs], f"log {LOG}")
    return rows.select([c.alias(n) for n, c in decode.trade_columns(F.col("log")).items()]).collect()


def test_a_good_log(spark):
    (r,) = decoded(spark, log())
    assert r["error_reason"] is None
    assert (r["pool"], r["sender"], r["recipient"]) == ("0x" + "ab" * 20, "0x" + "0b" * 20, "0x" + "0c" * 20)
    assert (r["amount0"], r["amount1"], r["tick"], r["block_number"], r["log_index"]) == (Decimal(-5), Decimal(7), -100, 16, 3)
    assert r["sqrt_price"] == 2.0**96 and r["liquidity"] == 1e18


def test_reasons_of_bad_logs(spark):
    topics = log()["topics"]
    bad = [
        (log(removed=True), "removed log"), (log(topics=topics[:2]), "not three topics"), (log(topics=["0x" + "11" * 32, *topics[1:]]), "another event"),
        (log(data="0x00"), "data is not five words"), (log(topics=[topics[0], "0x" + "01" * 32, topics[2]]), "topic is not an address"), (log(address="0xZZ"), "malformed address"),
        (log(data="0x" + word(1) + word(7) + word(1 << 170) + word(1) + word(0)), "price beyond 160 bits"),
        (log(data="0x" + word(1) + word(7) + word(1) + word(1 << 130) + word(0)), "liquidity beyond 128 bits"), (log(data="0x" + word(1) + word(7) + word(1) + word(1) + word(1 << 24)), "tick beyond 24 bits"),
    ]
    assert [r["error_reason"] for r in decoded(spark, *(x for x, _ in bad))] == [reason for _, reason in bad]


def test_amounts_beyond_38_digits_keep_every_digit(spark):
    rng = random.Random(3)
    values = [0, 1, -1, 10**38, -(10**38), 2**255 - 1, -(2**255), 9, -10, -(10**20), *(rng.randrange(-(2**255), 2**255) for _ in range(60)), *(rng.randrange(-(10**k), 10**k) for k in range(1, 77))]
    rows = spark.createDataFrame([(str(v), word(v)) for v in values] + [(None, "zz"), (None, None)], "v string, w string")
    got = rows.select("v", decode.int256_text(F.col("w")).alias("x"), decode.uint256_text(F.col("w")).alias("u")).collect()
    assert all(r["x"] == r["v"] for r in got)
    assert [r["u"] for r in got[: len(values)]] == [str(v % 2**256) for v in values]
    (r,) = decoded(spark, log(data="0x" + word(2**200) + word(-(2**130)) + word(2**159) + word(1) + word(0)))
    assert r["error_reason"] is None and r["amount0"] is None
    assert (r["amount0_text"], r["amount1_text"], r["sqrt_price_text"]) == (str(2**200), str(-(2**130)), str(2**159))


def test_quantities_are_never_cut(spark):
    rows = spark.createDataFrame([("0x0",), ("0x" + "0" * 20 + "ff",), ("0x7fffffffffffffff",), (None,)], "q string")
    assert [r["x"] for r in rows.select(decode.quantity(F.col("q")).alias("x")).collect()] == [0, 255, 2**63 - 1, None]
    for bad in ("0x1ffffffffffffffff", "0xffffffffffffffff"):
        with pytest.raises(Exception, match="64 bits|cannot be cast"):
            spark.createDataFrame([(bad,)], "q string").select(decode.quantity(F.col("q"))).collect()


def test_scaling_loses_no_digit(spark):
    cases = [("635972952123456789012", 18, "635.972952123456789012"), ("-1", 18, "-0.000000000000000001"), ("1234567", 6, "1.234567"), ("0", 6, "0"), ("42", 0, "42")]
    rows = spark.createDataFrame([(a, b) for a, b, _ in cases], "raw string, d int")
    got = [r["x"] for r in rows.select(money.scale_exact(F.col("raw").cast("decimal(38,0)"), F.col("d")).alias("x")).collect()]
    assert got == [Decimal(c) for _, _, c in cases]


def test_fees_are_exact(spark):
    row = spark.createDataFrame([(Decimal("1234567.123456789012345678"), 500)], "v decimal(31,18), fee int")
    assert row.select(money.fee_usd(F.col("v"), F.col("fee")).alias("x")).first()["x"] == Decimal("617.283561728394506172839")


def test_stable_leg_prefers_the_first_token(spark):
    rows = spark.createDataFrame([("USDC", "DAI", -5, 7), ("WETH", "DAI", -5, 7), ("WETH", "X", 1, 2)], "a string, b string, x long, y long")
    got = rows.select(money.stable_leg(*(F.col(c) for c in "abxy"), ["USDC", "DAI"]).alias("s")).collect()
    assert [r["s"] for r in got] == [5, 7, None]
