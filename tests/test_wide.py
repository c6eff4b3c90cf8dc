import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import decode, wide


def word(n: int) -> str:
    return f"{n % (1 << 256):064x}"


def numbers(seed=1, bits=250):
    rng = random.Random(seed)
    edge = [0, 1, -1, 10**38, -(10**38), (1 << 64) - 1, 1 << 64, -(1 << 64), (1 << 128) - 1, -(1 << 128), (1 << 192) + 5, -(1 << 192) - 5]
    return edge + [rng.choice([-1, 1]) * rng.getrandbits(rng.randrange(1, bits)) for _ in range(60)]


def frame(spark, values):
    return spark.createDataFrame([(i, i % 3, None if v is None else word(v)) for i, v in enumerate(values)], "i long, g long, word string")


def text(df, sums="s"):
    return wide.with_total(df, sums, "w").withColumn("t", decode.int256_text(F.col("w")))


def test_sums_merge_and_carry(spark):
    values = [*numbers(), None]
    df = frame(spark, values)
    part = df.groupBy("g").agg(wide.limb_sums(F.col("word")).alias("s"))
    got = {r["g"]: int(r["t"]) for r in text(part).collect()}
    assert got == {g: sum(v for i, v in enumerate(values) if i % 3 == g and v is not None) for g in range(3)}
    assert int(text(part.agg(wide.merged(F.col("s")).alias("s"))).first()["t"]) == sum(v for v in values if v is not None)


def test_sums_of_nothing_and_beyond(spark):
    none = frame(spark, [None]).unionByName(frame(spark, [1]).withColumn("word", F.lit("0x1")))
    summed = lambda df: wide.with_total(df.agg(wide.limb_sums(F.col("word")).alias("s")), "s", "w")
    assert summed(none).first()["w"] is None
    most = (1 << 255) - 1
    assert summed(frame(spark, [most, most, -most])).first()["w"] == word(most)
    for over in ([most, 1], [-most, -2]):
        with pytest.raises(Exception, match="beyond 256 bits"):
            summed(frame(spark, over)).collect()


def test_order_range_and_max(spark):
    values = sorted(set(numbers(2, 255)))
    mixed = random.Random(3).sample(values, len(values))
    df = frame(spark, mixed).withColumn("key", wide.key(F.col("word")))
    assert [mixed[r["i"]] for r in df.orderBy("key").collect()] == values
    low, high = values[10], values[40]
    bound = lambda v: wide.key(F.lit(word(v)))
    assert df.filter(F.col("key").between(bound(low), bound(high))).count() == 31
    most = df.agg(F.max("key").alias("m"), F.min("key").alias("l")).select(decode.int256_text(wide.word_of_key(F.col("m"))), decode.int256_text(wide.word_of_key(F.col("l")))).first()
    assert (int(most[0]), int(most[1])) == (values[-1], values[0])
    assert frame(spark, [None]).select(wide.key(F.col("word"))).first()[0] is None


@pytest.mark.parametrize("decimals", [0, 6, 9, 17, 18])
def test_fixed_point_keeps_all_digits(spark, decimals):
    values = [v for v in numbers(4, 190)]
    scaled = wide.with_scaled(frame(spark, values), "word", F.lit(decimals), "word")
    got = wide.with_fixed_text(scaled, "word", "t").select("i", "t").collect()
    from decimal import localcontext

    with localcontext() as c:
        c.prec = 120
        for r in got:
            assert Decimal(r["t"]) == Decimal(values[r["i"]]).scaleb(-decimals), (values[r["i"]], r["t"])
            assert len(r["t"].partition(".")[2]) == 18


def test_negation_and_products(spark):
    values = numbers(5)
    got = frame(spark, values).select("i", wide.negated(F.col("word")).alias("n")).collect()
    assert all(r["n"] == word(-values[r["i"]]) for r in got)
    with pytest.raises(Exception, match="beyond 256 bits"):
        wide.with_product(frame(spark, [1 << 250]), "word", F.lit(1000).cast("bigint"), "p").collect()


def test_text_of_wide_words_by_longs_at_every_border(spark):
    edges = [s * ((1 << b) + k) for b in (0, 29, 30, 59, 60, 64, 120, 128, 160, 192, 254) for k in (-1, 0, 1) for s in (1, -1)]
    values = [*edges, (1 << 255) - 1, -(1 << 255), *(s * 10**k - k % 2 for k in range(1, 77) for s in (1, -1))]
    df = spark.createDataFrame([(str(v), str(v % (1 << 256)), word(v)) for v in values] + [(None, None, "f" * 63), (None, None, "g" * 64), (None, None, None)], "signed string, unsigned string, w string")
    found = df.select("signed", "unsigned", decode.int256_text(F.col("w")).alias("s"), decode.uint256_text(F.upper("w")).alias("u"))
    assert all((r["s"], r["u"]) == (r["signed"], r["unsigned"]) for r in found.collect())
    # by decimals of 38 digits a word took many times as long
    assert "decimal" not in found._jdf.queryExecution().optimizedPlan().toString().lower()


def test_products_by_longs_up_to_the_last_bit(spark):
    factors = [0, 1, 7, 10**9]
    values = [v for v in [*numbers(6, 225), (1 << 225), -(1 << 225), (1 << 60) - 1, -(1 << 240) - 1] if abs(v) * 10**9 < 1 << 255]
    df = frame(spark, [*values, None]).withColumn("f", F.explode(F.array(*[F.lit(f).cast("bigint") for f in factors])))
    found = wide.with_product(df, "word", F.col("f"), "p")
    assert all(r["p"] == (word(values[r["i"]] * r["f"]) if r["i"] < len(values) else None) for r in found.collect())
    assert "aggregate(" not in found._jdf.queryExecution().optimizedPlan().toString()  # no fold that is interpreted row by row
    edge = frame(spark, [(1 << 255) - 1, -(1 << 255)])
    assert [r["p"] for r in wide.with_product(edge, "word", F.lit(1).cast("bigint"), "p").orderBy("i").collect()] == [word((1 << 255) - 1), word(-(1 << 255))]
    for over in ((1 << 254), -(1 << 254) - 1):
        with pytest.raises(Exception, match="beyond 256 bits"):
            wide.with_product(frame(spark, [over]), "word", F.lit(2).cast("bigint"), "p").collect()


def test_scaling_takes_a_word_apart_once(spark):
    values = [*numbers(8, 190), None]
    df = frame(spark, values).withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(18))))
    scaled = wide.with_scaled(df, "word", F.col("d"), "word")
    assert scaled.columns == ["i", "g", "d", "word"]
    for r in scaled.collect():
        assert r["word"] == (None if values[r["i"]] is None else word(values[r["i"]] * 10 ** (18 - r["d"])))
    plan = scaled._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("conv(") == 5 and "RLIKE" not in plan  # ten and two, for each of two products
    for over in (1 << 240, 1 << 215, -(1 << 215)):  # beyond 256 bits by the first factor, by the second
        with pytest.raises(Exception, match="beyond 256 bits"):
            wide.with_scaled(frame(spark, [over]), "word", F.lit(0), "word").collect()


def test_malformed_words_have_no_key_and_no_product(spark):
    good = word(5)
    bad = [good + "\n", good[1:] + "\n", good[1:], "g" + good[1:], "é" + good[2:], good[:-1] + " ", "", None]
    df = spark.createDataFrame([(i, w) for i, w in enumerate([*bad, good, good.upper()])], "i long, word string")
    got = wide.with_product(df.withColumn("key", wide.key(F.col("word"))), "word", F.lit(3).cast("bigint"), "p").orderBy("i").collect()
    assert [(r["key"], r["p"]) for r in got[: len(bad)]] == [(None, None)] * len(bad)
    assert all(r["p"] == word(15) and r["key"] == bytes.fromhex("8" + good[1:]) for r in got[len(bad) :])
