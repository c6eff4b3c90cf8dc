"""Exact money: decimals are shifted on their digits, never divided."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Q96 = float(1 << 96)


def scale_exact(raw: Column, decimals: Column) -> Column:
    """A raw integer (decimal(38,0)) over 10^decimals (up to 18) as decimal(31,18).

    The point is put into the digit string, so no digit is lost; what does not fit raises."""
    digits = F.lpad(F.regexp_replace(raw.cast("string"), "^-", ""), 58, "0")  # abs keeps 34 digits only
    whole = F.substring(digits, F.lit(1), F.lit(58) - decimals)
    part = F.substring(digits, F.lit(59) - decimals, decimals)
    sign = F.when(raw < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, whole, F.lit("."), F.coalesce(part, F.lit("")), F.lit("0")).cast("decimal(31,18)")


def fee_usd(volume: Column, fee: Column) -> Column:
    """Volume times a fee in hundredths of a basis point, exactly."""
    return volume.cast("decimal(31,18)") * (fee.cast("decimal(7,0)") * F.lit("0.000001").cast("decimal(7,6)")).cast("decimal(7,6)")


def stable_leg(token0: Column, token1: Column, amount0: Column, amount1: Column, stables: list[str]) -> Column:
    """The dollar leg of a trade: of token0 if that is a stablecoin, else of token1, else null."""
    return F.when(token0.isin(stables), F.abs(amount0)).when(token1.isin(stables), F.abs(amount1))


def other_leg(token0: Column, token1: Column, amount0: Column, amount1: Column, stables: list[str]) -> Column:
    return F.when(token0.isin(stables), amount1).when(token1.isin(stables), amount0)


def price_from_sqrt(sqrt_price: Column) -> Column:
    return F.pow(sqrt_price / F.lit(Q96), F.lit(2.0))


def price_from_tick(tick: Column) -> Column:
    return F.pow(F.lit(1.0001), tick)


def gap_bps(low: Column, high: Column) -> Column:
    """Gap between two square-root prices, in basis points."""
    return F.lit(2e4) * F.ln(low / high)


def position_key(block: Column, log_index: Column) -> Column:
    """Chain order as one number."""
    return F.shiftleft(block.cast("bigint"), 32) + log_index


def readable_size(size: Column) -> Column:
    """Bytes in binary units with two digits."""
    shown = lambda value, unit: F.format_string(f"%.2f {unit}", value)
    out = shown(size / F.lit(float(1 << 30)), "GiB")
    for power, unit in ((20, "MiB"), (10, "KiB")):
        out = F.when(size < 1 << (power + 10), shown(size / F.lit(float(1 << power)), unit)).otherwise(out)
    return F.when(size < 1 << 10, shown(size.cast("double"), "B")).otherwise(out)
