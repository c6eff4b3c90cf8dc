"""Lossless decoding of raw log fields with native expressions.

A 256-bit word is 64 hex digits, read as four 64-bit limbs. Values beyond 38 digits do not fit a
decimal: ``int256_text`` and ``uint256_text`` give all digits of any word as text; of the decimals,
strict decoders raise and ``*_or_null`` ones give null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = "^[0-9a-fA-F]{64}$"
LIMB = "18446744073709551616"  # 2^64
TOP = "18446744073709551615"


def _limb(word: Column, place: int) -> Column:
    """Limb 0 is the highest; an unsigned 64-bit number as decimal(20,0)."""
    return F.conv(F.substring(word, 1 + 16 * place, 16), 16, 10).cast("decimal(20,0)")


def _dec(value: str) -> Column:
    return F.lit(value).cast("decimal(20,0)")


def int256_or_null(word: Column) -> Column:
    """Two's complement of 64 hex digits as decimal(38,0); null beyond 38 digits or if malformed."""
    negative = F.substring(word, 1, 1).rlike("[89a-fA-F]")
    fits = F.substring(word, 1, 32).rlike("^(0{32}|[fF]{32})$") & word.rlike("^[0-9a-fA-F]{64}$")
    high, low = _limb(word, 2), _limb(word, 3)
    big, small = F.when(negative, _dec(TOP) - high).otherwise(high), F.when(negative, _dec(TOP) - low).otherwise(low)
    size = F.try_add(F.try_multiply(big.cast("decimal(20,0)"), _dec(LIMB)).cast("decimal(38,0)"), small.cast("decimal(38,0)")).cast("decimal(38,0)")
    # a difference, since the unary minus of a decimal keeps 34 digits only
    head, last = _near_zero(word)
    near = F.when(head == "0" * 49, last).when(head == "f" * 49, last - (1 << 60)).cast("decimal(38,0)")
    return F.when(fits, F.when(near.isNotNull(), near).when(negative, F.try_subtract(F.lit("-1").cast("decimal(38,0)"), size).cast("decimal(38,0)")).otherwise(size))


def int256(word: Column) -> Column:
    """As ``int256_or_null`` but an error instead of null."""
    found = int256_or_null(word)
    return F.when(word.isNull() | found.isNotNull(), found).otherwise(F.raise_error(F.concat(F.lit("not a number of 38 digits: "), word)).cast("decimal(38,0)"))


def _once(value: Column, body) -> Column:
    """``body`` of a value that is worked out once for the row, however often it is named."""
    return F.transform(F.array(value), body)[0]


def _near_zero(word: Column) -> tuple[Column, Column]:
    """The first 49 hex digits, lower case, and the last 15 as a bigint: if the first are all zero the
    number is the last ones, if they are all f it is 2^60 less."""
    return F.lower(F.substring(word, 1, 49)), F.conv(F.substring(word, 50, 15), 16, 10).cast("bigint")


#: 2^(30 i) by groups of nine decimal digits, the lowest first: nine limbs times these add up within a bigint.
_POWERS = [[(1 << 30 * i) // 10 ** (9 * j) % 10**9 for j in range(9)] for i in range(9)]


def _long_text(word: Column, plus: int) -> Column:
    """The text of an unsigned word that is at least 2^60, plus 0 or 1: its limbs of 30 bits count the
    groups of nine digits, whose carries go up once."""
    pieces = F.array(*[F.conv(F.substring(word, a, n), 16, 10).cast("bigint") for a, n in ((50, 15), (35, 15), (20, 15), (5, 15), (1, 4))])

    def groups(p: Column) -> Column:
        limb = lambda i: F.shiftright(p[i // 2], 30) if i % 2 else p[i // 2].bitwiseAND((1 << 30) - 1)
        return F.array(*[sum((limb(i) * F.lit(_POWERS[i][j]).cast("bigint") for i in range(9) if _POWERS[i][j]), F.lit(0).cast("bigint")) for j in range(9)])

    def step(s: Column, x: Column) -> Column:
        value = x + s["carry"]
        return F.struct(F.concat(F.lpad((value % 10**9).cast("string"), 9, "0"), s["text"]).alias("text"), F.call_function("div", value, F.lit(10**9).cast("bigint")).alias("carry"))

    start = F.struct(F.lit("").alias("text"), F.lit(plus).cast("bigint").alias("carry"))
    return F.ltrim(F.aggregate(_once(pieces, groups), start, step)["text"], F.lit("0"))


def uint256_text(word: Column) -> Column:
    """An unsigned word of 64 hex digits as decimal text, all of its digits; null if malformed."""
    head, low = _near_zero(word)
    return F.when(word.rlike(WORD), F.when(head == "0" * 49, low.cast("string")).otherwise(_long_text(word, 0)))


def int256_text(word: Column) -> Column:
    """Two's complement of 64 hex digits as decimal text, all of its digits; null if malformed."""
    head, low = _near_zero(word)
    # the digits' complement is one less than the size
    flipped = F.translate(F.lower(word), "0123456789abcdef", "fedcba9876543210")
    size = F.when(head.substr(1, 1).rlike("[89a-f]"), F.concat(F.lit("-"), _long_text(flipped, 1))).otherwise(_long_text(word, 0))
    return F.when(word.rlike(WORD), F.when(head == "0" * 49, low.cast("string")).when(head == "f" * 49, (low - (1 << 60)).cast("string")).otherwise(size))


def uint_double(word: Column) -> Column:
    """An unsigned word of 64 hex digits as a double."""
    return sum((_limb(word, i).cast("double") * F.lit(2.0 ** (64 * (3 - i))) for i in range(1, 4)), _limb(word, 0).cast("double") * F.lit(2.0**192))


def quantity(text: Column) -> Column:
    """``0x`` hex quantity as bigint; one that does not fit raises."""
    digits = F.regexp_replace(F.substring(text, 3, 1 << 30), "^0+(?=.)", "")
    wide = F.raise_error(F.concat(F.lit("quantity beyond 64 bits: "), text)).cast("bigint")
    return F.when(F.length(digits) > 16, wide).otherwise(F.conv(digits, 16, 10).cast("bigint"))


def int24(word: Column) -> Column:
    """The signed low 24 bits; null unless the word is their sign extension."""
    value = F.conv(F.substring(word, 59, 6), 16, 10).cast("int")
    extended = word.rlike("^(0{58}[0-7]|[fF]{58}[89a-fA-F])[0-9a-fA-F]{5}$")
    return F.when(extended, F.when(value >= 1 << 23, value - (1 << 24)).otherwise(value))


def topic_address(topic: Column) -> Column:
    """The address in a left-padded topic, lower case; null if the padding is not zero."""
    return F.when(topic.rlike("^0x0{24}[0-9a-fA-F]{40}$"), F.concat(F.lit("0x"), F.lower(F.substring(topic, 27, 40))))


def address(text: Column) -> Column:
    """A valid address in lower case; null otherwise."""
    return F.when(text.rlike("^0x[0-9a-fA-F]{40}$"), F.lower(text))


def to_binary(text: Column, length: int) -> Column:
    """``0x`` hex to binary of a stated length; null otherwise."""
    return F.when(text.rlike(f"^0x[0-9a-fA-F]{{{2 * length}}}$"), F.unhex(F.substring(text, 3, 2 * length)))


def to_hex(data: Column) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.hex(data)))


def word_of(value: Column) -> Column:
    """A bigint as a 64-digit two's complement word."""
    fill = F.when(value < 0, F.lit("f")).otherwise(F.lit("0"))
    return F.concat(F.repeat(fill, F.lit(48)), F.lpad(F.lower(F.hex(value)), 16, "0"))


#: The signature topic of the trade event that ``trade_columns`` decodes.
TRADE_TOPIC = "0xc42079f94a6350d7e6235f29174924f928cc2ac818eb64fed8004e115fbcca67"


def trade_columns(log: Column) -> dict[str, Column]:
    """Decoded fields of a raw log struct, and ``error_reason``: null for a good log. Amounts beyond
    38 digits are null as decimals; their text, like that of the price, has every digit.

    Fields: removed, address, topics, data, blockNumber, transactionIndex, logIndex,
    blockTimestamp, blockHash, transactionHash.
    """
    word = lambda i: F.substring(log["data"], 3 + 64 * i, 64)
    topics = log["topics"]
    reasons = [
        (F.coalesce(log["removed"], F.lit(False)), "removed log"),
        (F.size(topics) != 3, "not three topics"),
        (F.lower(F.get(topics, F.lit(0))) != TRADE_TOPIC, "another event"),
        (~F.coalesce(log["data"].rlike("^0x[0-9a-fA-F]{320}$"), F.lit(False)), "data is not five words"),
        (topic_address(F.get(topics, F.lit(1))).isNull() | topic_address(F.get(topics, F.lit(2))).isNull(), "topic is not an address"),
        (address(log["address"]).isNull(), "malformed address"),
        (~word(2).rlike("^0{24}"), "price beyond 160 bits"),
        (~word(3).rlike("^0{32}"), "liquidity beyond 128 bits"),
        (int24(word(4)).isNull(), "tick beyond 24 bits"),
    ]
    return {
        "pool": address(log["address"]),
        "block_number": quantity(log["blockNumber"]),
        "block_hash": F.lower(log["blockHash"]),
        "block_timestamp": F.timestamp_seconds(quantity(log["blockTimestamp"])),
        "tx_hash": F.lower(log["transactionHash"]),
        "tx_index": quantity(log["transactionIndex"]),
        "log_index": quantity(log["logIndex"]),
        "sender": topic_address(F.get(topics, F.lit(1))),
        "recipient": topic_address(F.get(topics, F.lit(2))),
        "amount0": int256_or_null(word(0)),
        "amount1": int256_or_null(word(1)),
        "amount0_text": int256_text(word(0)),
        "amount1_text": int256_text(word(1)),
        "sqrt_price_text": uint256_text(word(2)),
        "sqrt_price": uint_double(word(2)),
        "liquidity": uint_double(word(3)),
        "tick": int24(word(4)),
        "error_reason": F.coalesce(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(text)) for bad, text in reasons]),
    }
