"""Data-quality rules: each returns the rows that break it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def default_of(kind: T.DataType) -> Column:
    """The value a column of this type has when nothing was given."""
    if isinstance(kind, T.StringType):
        return F.lit("")
    if isinstance(kind, T.BinaryType):
        return F.lit(b"")
    if isinstance(kind, T.BooleanType):
        return F.lit(False)
    if isinstance(kind, T.DateType):
        return F.lit("1970-01-01").cast("date")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01 00:00:00").cast(kind)
    return F.lit(0).cast(kind)


def is_default(df: DataFrame, column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) == default_of(df.schema[column].dataType))


def unique(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def not_default(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_default(df, column))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def accepted(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.filter(~F.coalesce(F.col(column).isin(values), F.lit(False)))


def orphans(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    return df.join(dim.select(key), key, "left_anti")


def denormalized_match(df: DataFrame, dim: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows whose copies of dimension columns differ from the dimension."""
    joined = df.join(dim.select(key, *[F.col(c).alias(f"_{c}") for c in columns]), key)
    return joined.filter(reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns])).select(*df.columns)


def well_formed(df: DataFrame, column: str, length: int) -> DataFrame:
    """Rows whose hex text is not of so many bytes, lower case and other than zero."""
    good = F.col(column).rlike(f"^0x[0-9a-f]{{{2 * length}}}$") & ~F.col(column).rlike("^0x0+$")
    return df.filter(~F.coalesce(good, F.lit(False)))


def lower_case(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) != F.lower(column))


def fee_text(fee: Column) -> Column:
    """A fee in hundredths of a basis point as percent text: 500 is 0.05%."""
    plain = (fee.cast("decimal(10,0)") * F.lit("0.0001").cast("decimal(5,4)")).cast("string")
    return F.concat(F.regexp_replace(plain, r"\.?0+$", ""), F.lit("%"))


def label_states_fee(df: DataFrame, label: str, fee: str) -> DataFrame:
    return df.filter(~F.col(label).endswith(fee_text(F.col(fee))))


def opposite_signs(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.filter((F.signum(a) == F.signum(b)) & (F.col(a) != 0))


def part_of(df: DataFrame, share: str, slack: float = 1e-6) -> DataFrame:
    return df.filter((F.col(share) < 0) | (F.col(share) > 1 + slack))


def symmetric_difference(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on one side only, with the side, and those that the left side lists twice."""
    one = left.join(right.select(keys), keys, "left_anti").select(*keys).withColumn("problem", F.lit("not in the recomputation"))
    two = right.join(left.select(keys), keys, "left_anti").select(*keys).withColumn("problem", F.lit("missing"))
    twice = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*keys).withColumn("problem", F.lit("listed twice"))
    return one.unionByName(two).unionByName(twice)


def accounts_for(mart: DataFrame, raw: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Keys on which the mart and a recomputation differ, or that only one of them has."""
    l = mart.select(*keys, *[F.col(c).alias(f"m_{c}") for c in columns], F.lit(True).alias("in_m"))  # noqa: E741
    r = raw.select(*keys, *[F.col(c).alias(f"r_{c}") for c in columns], F.lit(True).alias("in_r"))
    both = l.join(r, keys, "full_outer")
    differs = reduce(lambda a, b: a | b, [~F.col(f"m_{c}").eqNullSafe(F.col(f"r_{c}")) for c in columns])
    problem = F.when(F.col("in_m").isNull(), "only in recomputation").when(F.col("in_r").isNull(), "only in mart").when(differs, "differs")
    return both.withColumn("problem", problem).filter("problem is not null").drop("in_m", "in_r")


@dataclass(frozen=True)
class Rule:
    """A question with the rows that answer it; ``expect_empty`` rules fail on any row."""

    name: str
    question: str
    rows: Callable[[], DataFrame]
    expect_empty: bool = True


def run_rules(rules: list[Rule], sample: int = 5) -> list[dict]:
    """Outcome of each rule; one that cannot run is reported and does not stop the others."""
    out = []
    for rule in rules:
        try:
            found = rule.rows()
            n = found.count()
            out.append({"rule": rule.name, "rows": n, "passed": n == 0 or not rule.expect_empty, "sample": [r.asDict() for r in found.take(sample)], "error": None})
        except Exception as error:
            out.append({"rule": rule.name, "rows": None, "passed": False, "sample": [], "error": str(error).splitlines()[0]})
    return out
