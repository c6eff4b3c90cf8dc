"""Signed numbers of 256 bits: sums that merge, order, and fixed point beyond 38 digits.

A number is a word: 64 hex digits of its two's complement, as logs hold it. Spark's decimals end at
38 digits, so sums keep four 64-bit limbs apart, each in a decimal(38) that no number of rows fills,
and carry once at the end. Order needs no arithmetic: a word's bytes with the sign bit turned over
compare as the numbers do. What leaves the 256 bits raises; a malformed or null word gives null.

Functions that add a column work in a few projections of their own: nested in one expression, the
steps would be analysed and worked out many times over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .decode import int256_text

LIMBS = 4
_B = "18446744073709551616"  # 2^64
_HEX, _FLIPPED = "0123456789abcdef", "fedcba9876543210"


def _dec(value: str | Column, digits: int = 38) -> Column:
    return (F.lit(value) if isinstance(value, str) else value).cast(f"decimal({digits},0)")


def _well(word: Column) -> Column:
    """64 hex digits; a regular expression took ten times as long."""
    return (F.octet_length(word) == 64) & F.unhex(word).isNotNull()


def limb_sums(word: Column) -> Column:
    """Aggregate: the sums of the limbs (the lowest first) and the number of negative words, as a
    struct. Null words do not count; sums of no word are null."""
    good = F.when(_well(word), word)
    limb = lambda i: _dec(F.conv(F.substring(good, 1 + 16 * (LIMBS - 1 - i), 16), 16, 10), 28)
    negative = _dec(F.when(F.substring(good, 1, 1).rlike("[89a-fA-F]"), 1).otherwise(0), 28)
    return F.struct(*[F.sum(limb(i)).alias(f"limb{i}") for i in range(LIMBS)], F.sum(F.when(good.isNotNull(), negative)).alias("negatives"))


def merged(sums: Column) -> Column:
    """Aggregate: the sum of partial ``limb_sums``."""
    names = [*(f"limb{i}" for i in range(LIMBS)), "negatives"]
    return F.struct(*[F.sum(_dec(sums[n], 28)).alias(n) for n in names])


def with_total(df: DataFrame, sums: str, name: str) -> DataFrame:
    """The word that the ``limb_sums`` in a column add up to, as a new column; null of no words.
    Raises beyond 256 bits."""
    base, columns = _dec(_B, 20), df.columns

    def carried(state: Column, limb: Column) -> Column:
        value = (limb + state["carry"]).cast("decimal(38,0)")
        # pmod: the rest of a negative value is counted up from below
        rest = F.pmod(value, base).cast("decimal(20,0)")
        carry = ((value - rest).cast("decimal(38,0)") / base).cast("decimal(38,0)")
        return F.struct(F.coalesce(F.concat(F.lpad(F.lower(F.conv(rest.cast("string"), 10, 16)), 16, "0"), state["done"]), F.lit("")).alias("done"), carry.alias("carry"))

    limbs = F.array(*[F.coalesce(_dec(F.col(f"{sums}.limb{i}")), _dec("0")) for i in range(LIMBS)])
    df = df.withColumn("_s", F.aggregate(limbs, F.struct(F.lit("").alias("done"), _dec("0").alias("carry")), carried))
    # a negative word counts 2^256 too much
    fits = (F.col("_s.carry") - F.col(f"{sums}.negatives")) == F.when(F.substring("_s.done", 1, 1).rlike("[89a-f]"), -1).otherwise(0)
    word = F.when(fits, F.col("_s.done")).otherwise(F.raise_error(F.lit("a sum beyond 256 bits")).cast("string"))
    return df.select(*columns, F.when(F.col(f"{sums}.limb0").isNotNull(), word).alias(name))


def negated(word: Column) -> Column:
    """Minus a word (the least one stays itself, as two's complement has it)."""
    zeros = F.length(F.regexp_extract(word, "0*$", 0))
    head = F.substring(word, F.lit(1), F.lit(64) - zeros)
    last = F.right(head, F.lit(1))
    plus = F.translate(last, "123456789abcdef", "fedcba987654321")
    flipped = F.translate(F.substring(head, F.lit(1), F.length(head) - 1), _HEX, _FLIPPED)
    return F.when(zeros == 64, word).otherwise(F.concat(flipped, plus, F.repeat(F.lit("0"), zeros)))


def with_product(df: DataFrame, word: str, factor: Column, name: str) -> DataFrame:
    """A word times a bigint of 0 to 10^9, as a new column. Raises beyond 256 bits."""
    return _with_products(df, word, [factor], name)


def _with_products(df: DataFrame, word: str, factors: list[Column], name: str) -> DataFrame:
    """A word times several factors of 0 to 10^9: it is taken apart and put together once for all of them."""
    columns, low = df.columns, (1 << 30) - 1
    df = df.withColumns({"_w": F.when(_well(F.col(word)), F.col(word))} | {f"_f{k}": f for k, f in enumerate(factors)})
    missing = F.col("_w").isNull()
    for k in range(len(factors)):
        missing = missing | F.col(f"_f{k}").isNull()
    # four pieces of 60 bits, the lowest first, and 16 bits with the sign; none is null, which keeps the generated code short
    part = lambda at, n: F.coalesce(F.conv(F.substring("_w", at, n), 16, 10).cast("bigint"), F.lit(0).cast("bigint"))
    factor = {f"_f{k}": F.coalesce(f"_f{k}", F.lit(0).cast("bigint")) for k in range(len(factors))}
    df = df.withColumns({"_null": missing} | {f"_p{i}": part(50 - 15 * i, 15) for i in range(4)} | {"_p4": part(1, 4)} | factor)
    # limbs are half a piece
    limbs = [F.shiftright(f"_p{i // 2}", 30) if i % 2 else F.col(f"_p{i // 2}").bitwiseAND(low) for i in range(8)]
    limbs.append(F.col("_p4") - F.shiftleft(F.shiftright("_p4", 15), 16))
    for k in range(len(factors)):
        for i, limb in enumerate(limbs):
            value = limb * F.col(f"_f{k}")
            df = df.withColumn(f"_v{i}", value + F.shiftright(f"_v{i - 1}", 30) if i else value)
        fits = F.col("_v8").between(-(1 << 15), (1 << 15) - 1)
        df = df.withColumn("_v8", F.when(fits, F.col("_v8")).otherwise(F.raise_error(F.lit("a product beyond 256 bits")).cast("bigint")))
        limbs = [*(F.col(f"_v{i}").bitwiseAND(low) for i in range(8)), F.col("_v8")]
    # a bit above the digits keeps their zeros
    hexed = lambda c, n: F.substring(F.hex(c.bitwiseOR(1 << 4 * n)), 2, n)
    whole = [F.shiftleft(limbs[2 * i + 1], 30).bitwiseOR(limbs[2 * i]) for i in range(4)]
    product = F.lower(F.concat(hexed(limbs[8].bitwiseAND(0xFFFF), 4), *[hexed(c, 15) for c in reversed(whole)]))
    return df.select(*[c for c in columns if c != name], F.when(~F.col("_null"), product).alias(name))


def with_scaled(df: DataFrame, word: str, decimals: Column, name: str, to: int = 18) -> DataFrame:
    """A raw amount of so many decimals (0 to ``to``, at most 18) as a whole number of 10^-to."""
    power = lambda n: F.element_at(F.array(*[F.lit(10**i).cast("bigint") for i in range(10)]), (n + 1).cast("int"))
    columns = df.columns
    df = df.withColumn("_missing", F.lit(to) - decimals)
    factors = [power(F.least(F.col("_missing"), F.lit(9))), power(F.greatest(F.col("_missing") - 9, F.lit(0)))]
    return _with_products(df, word, factors, name).select(*[c for c in columns if c != name], name)


def with_fixed_text(df: DataFrame, word: str, name: str, places: int = 18) -> DataFrame:
    """The number over 10^places, all digits: sign, whole part, point, ``places`` digits."""
    columns = df.columns
    df = df.withColumn("_t", int256_text(F.col(word))).withColumn("_d", F.regexp_replace("_t", "^-", ""))
    df = df.withColumn("_d", F.lpad("_d", F.greatest(F.length("_d"), F.lit(places + 1)), F.lit("0")))
    sign, whole = F.when(F.col("_t").startswith("-"), "-").otherwise(""), F.substring("_d", F.lit(1), F.length("_d") - places)
    return df.select(*[c for c in columns if c != name], F.concat(sign, whole, F.lit("."), F.right("_d", F.lit(places))).alias(name))


def key(word: Column) -> Column:
    """32 bytes that compare (``ORDER BY``, ``<``, ``max``) as the numbers do."""
    first = F.translate(F.lower(F.substring(word, 1, 1)), _HEX, "89abcdef01234567")
    # what is not a hex digit gives null
    return F.when(F.octet_length(word) == 64, F.unhex(F.concat(first, F.substring(word, 2, 63))))


def word_of_key(data: Column) -> Column:
    """The word of a ``key``."""
    digits = F.lower(F.hex(data))
    return F.concat(F.translate(F.substring(digits, 1, 1), _HEX, "89abcdef01234567"), F.substring(digits, 2, 63))
