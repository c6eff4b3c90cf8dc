"""Statistics of evaluation runs: scoring, intervals, bootstraps, agreement, guards, sampling.

Runs are rows (case_id, run, correct and what else a function names)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import stored

Z95 = 1.959963984540054
#: Kind of number: absolute and relative tolerance.
TOLERANCES = {"count": (0.0, 0.0), "sum": (0.01, 1e-6), "quantity": (1e-6, 1e-6), "ratio": (1e-4, 1e-3)}


def number_matches(got: Column, want: Column, kind: str) -> Column:
    """Within the absolute or the relative tolerance of its kind."""
    absolute, relative = TOLERANCES[kind]
    off = F.abs(got - want)
    return F.coalesce((off <= absolute) | (off <= F.abs(want) * relative), F.lit(False))


def label_matches(got: Column, want: Column) -> Column:
    return F.coalesce(F.lower(F.trim(got)) == F.lower(F.trim(want)), F.lit(False))


# Names of months.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


def said_dates(text: Column) -> Column:
    """Dates in a text, as 2024-01-05, 5 January 2024 or January 5, 2024; what is no date is left out."""
    low = F.lower(text)
    month = "|".join(MONTHS)
    number = F.create_map(*[F.lit(x) for i, name in enumerate(MONTHS, 1) for x in (name, f"{i:02}")])
    made = lambda pattern, y, m, d: F.transform(
        F.regexp_extract_all(low, F.lit(pattern), F.lit(0)),
        lambda x: F.concat_ws("-", F.regexp_extract(x, pattern, y), number[F.regexp_extract(x, pattern, m)], F.lpad(F.regexp_extract(x, pattern, d), 2, "0")),
    )
    plain = F.regexp_extract_all(low, F.lit(r"\b\d{4}-\d{2}-\d{2}\b"), F.lit(0))
    found = F.concat(plain, made(rf"\b(\d{{1,2}}) ({month}) (\d{{4}})\b", 3, 2, 1), made(rf"\b({month}) (\d{{1,2}}),? (\d{{4}})\b", 3, 1, 2))
    return F.array_distinct(F.array_compact(F.transform(found, lambda x: F.try_to_date(x))))


def date_matches(said: Column, want: Column) -> Column:
    """One date is said, and it is the wanted one."""
    dates = said_dates(said)
    return F.coalesce((F.size(dates) == 1) & (F.get(dates, F.lit(0)) == want), F.lit(False))


def list_matches(got: Column, want: Column, ordered: bool) -> Column:
    """The same labels, in the same order if that is asked for; case and outer space do not count."""
    plain = lambda x: F.transform(x, lambda v: F.lower(F.trim(v)))
    a, b = plain(got), plain(want)
    return F.coalesce(a == b if ordered else F.array_sort(a) == F.array_sort(b), F.lit(False))


#: What counts as saying that there is no answer.
REFUSAL = r"\b(?:cannot|can't|can not|unable to|not able to|no data|not in the data|don't know|do not know)\b"


def refusal_matches(said: Column, wanted: Column) -> Column:
    """Whether a refusal was given where, and only where, one is wanted."""
    return F.lower(F.coalesce(said, F.lit(""))).rlike(REFUSAL) == wanted


def unit_swapped(text: Column, units: dict[str, str]) -> Column:
    """The first unit that occurs, exchanged."""
    out = text
    for unit, other in units.items():
        out = F.when(out.contains(unit), F.regexp_replace(out, rf"\b{unit}\b", other)).otherwise(out)
    return out


def date_shifted(text: Column, days: int) -> Column:
    """The first plain date, moved by so many days."""
    found = F.regexp_extract(text, r"\d{4}-\d{2}-\d{2}", 0)
    moved = F.date_format(F.date_add(F.try_to_date(found), days), "yyyy-MM-dd")
    return F.when(found == "", text).otherwise(F.replace(text, found, moved))


def names_swapped(text: Column, names: dict[str, str]) -> Column:
    """Names exchanged for others."""
    out = text
    for name, other in names.items():
        out = F.regexp_replace(out, rf"\b{name}\b", other)
    return out


def with_claim(text: Column, claim: str) -> Column:
    """The text with a claim that nothing supports."""
    return F.concat(F.rtrim(text), F.lit(" "), F.lit(claim))


def confusion(rows: DataFrame, section: str, a: str, b: str) -> DataFrame:
    """Per section the four counts of two yes-or-no labels, and kappa (null without variation)."""
    x, y = F.col(a), F.col(b)
    held = rows.groupBy(section).agg(F.count_if(x & y).alias("both"), F.count_if(x & ~y).alias("first_only"), F.count_if(y & ~x).alias("second_only"), F.count_if(~x & ~y).alias("neither"))
    n = F.col("both") + F.col("first_only") + F.col("second_only") + F.col("neither")
    same = (F.col("both") + F.col("neither")) / n
    pa, pb = (F.col("both") + F.col("first_only")) / n, (F.col("both") + F.col("second_only")) / n
    chance = pa * pb + (1 - pa) * (1 - pb)
    return held.withColumn("kappa", F.try_divide(same - chance, 1 - chance))


def tiered_usd(prompt: Column, tokens: dict[str, Column], tiers: list[tuple[int | None, dict[str, str]]]) -> Column:
    """Cost at the rates of the first tier whose longest prompt is not passed; the last has none."""
    *bounded, (_, last) = tiers
    out = cost_usd(tokens, last)
    for most, rates in reversed(bounded):
        out = F.when(prompt <= most, cost_usd(tokens, rates)).otherwise(out)
    return out


def wilson(right: Column, n: Column) -> tuple[Column, Column]:
    """The 95 % interval of a share, within [0, 1]."""
    p, z2 = right / n, Z95 * Z95
    middle = p + z2 / (2 * n)
    half = F.lit(Z95) * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))
    low, high = (middle - half) / (1 + z2 / n), (middle + half) / (1 + z2 / n)
    return F.greatest(F.lit(0.0), low), F.least(F.lit(1.0), high)


def accuracy(rows: DataFrame, *keys: str) -> DataFrame:
    held = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if("correct").alias("right_"))
    low, high = wilson(F.col("right_"), F.col("n"))
    return held.select(*keys, "n", "right_", F.try_divide("right_", "n").alias("accuracy"), low.alias("low"), high.alias("high"))


def majority(rows: DataFrame) -> DataFrame:
    """Per case: right in more than half of its runs; right in every, some or no run."""
    held = rows.groupBy("case_id").agg(F.count(F.lit(1)).alias("runs"), F.count_if("correct").alias("right_"))
    stable = F.when(F.col("right_") == F.col("runs"), "every").when(F.col("right_") == 0, "none").otherwise("some")
    return held.select("case_id", (2 * F.col("right_") > F.col("runs")).alias("majority"), stable.alias("stability"))


def moves(before: DataFrame, after: DataFrame) -> DataFrame:
    """What changed for each case by majority."""
    a = majority(before).select("case_id", F.col("majority").alias("was"))
    b = majority(after).select("case_id", F.col("majority").alias("is"))
    move = F.when(F.col("was") & F.col("is"), "stayed right").when(~F.col("was") & ~F.col("is"), "stayed wrong").when(F.col("is"), "fixed").otherwise("broke")
    return a.join(b, "case_id").select("case_id", move.alias("move"))


#: Ranges of the hash among which a draw is split first, at most, and cases of a range beyond which
#: more ranges are taken.
RANGES, RANGE_CASES = 65_536, 4_096


def _drawn(cases: DataFrame, draws: int, seed: int) -> DataFrame:
    """draw, cases (how many were drawn: exactly as many as there are) and total (of their shares),
    for resampling with replacement. ``cases``: case_id (unique), share.

    A draw is a multinomial count over the cases. It is split down a tree of hashes: over ranges of
    the cases' hashes by the ranges' sizes, then over the cases of each range. Both are exact, each
    range of all draws is one task's work, and every split has a seed of its own, so a repeated task
    gives the same."""
    import pandas as pd

    n = cases.count()
    ranges = max(1, min(RANGES, -(-n // RANGE_CASES)))
    placed = cases.select(F.col("case_id").cast("string").alias("case_id"), F.col("share").cast("double").alias("share"), F.pmod(F.xxhash64(F.col("case_id").cast("string")), F.lit(ranges)).alias("range"))
    sizes = sorted((r["range"], r["count"]) for r in placed.groupBy("range").count().collect())  # at most RANGES numbers

    def over_ranges(frames):
        import numpy as np

        shares = np.array([c / n for _, c in sizes])
        for frame in frames:
            for draw in frame["id"]:
                counts = np.random.default_rng([seed, draw]).multinomial(n, shares)
                yield pd.DataFrame({"range": [r for r, _ in sizes], "draw": draw, "k": counts})

    def over_cases(key, own, splits):
        import numpy as np

        shares = own.sort_values("case_id")["share"].to_numpy()
        if not len(shares):
            return pd.DataFrame({"draw": [], "k": [], "total": []})
        even = np.full(len(shares), 1 / len(shares))
        totals = [float(np.random.default_rng([seed, d, int(key[0]) + 1]).multinomial(k, even) @ shares) for d, k in zip(splits["draw"], splits["k"], strict=True)]
        return pd.DataFrame({"draw": splits["draw"], "k": splits["k"], "total": totals})

    tasks = max(1, min(draws, cases.sparkSession.sparkContext.defaultParallelism))
    splits = cases.sparkSession.range(0, draws if n else 0, 1, tasks).mapInPandas(over_ranges, "range long, draw long, k long")
    found = placed.groupBy("range").cogroup(splits.groupBy("range")).applyInPandas(over_cases, "draw long, k long, total double")
    return found.groupBy("draw").agg(F.sum("k").alias("cases"), F.sum("total").alias("total"))


def _resampled(per: DataFrame, name: str, draws: int, seed: int) -> DataFrame:
    """The mean of ``share``, its percentile interval, its standard error in closed form, and how
    many cases the least and the largest draw took."""
    drawn = _drawn(per, draws, seed).withColumn("x", F.col("total") / F.col("cases"))
    found = _interval(drawn, "x").crossJoin(F.broadcast(drawn.agg(F.min("cases").alias("least_drawn"), F.max("cases").alias("most_drawn"))))  # one row each
    error = F.sqrt(F.var_pop("share") / F.count("share")).alias("standard_error")
    return per.agg(F.avg("share").alias(name), error).crossJoin(F.broadcast(found))  # one row


def _interval(values: DataFrame, column: str) -> DataFrame:
    held = F.array_sort(F.collect_list(column))  # one number for each draw
    at = lambda q: F.get(held, F.floor(q * (F.size(held) - 1) + 0.5).cast("int"))
    return values.agg(at(0.025).alias("low"), at(0.975).alias("high"))


def bootstrap(rows: DataFrame, draws: int = 500, seed: int = 1) -> DataFrame:
    """Accuracy with a percentile interval; a case is drawn with all its runs."""
    per = rows.groupBy("case_id").agg(F.avg(F.col("correct").cast("double")).alias("share"))
    return _resampled(stored(per, "bootstrap"), "accuracy", draws, seed)


def paired_difference(before: DataFrame, after: DataFrame, draws: int = 500, seed: int = 1) -> DataFrame:
    """After less before on shared cases, with an interval."""
    mean = lambda df, name: df.groupBy("case_id").agg(F.avg(F.col("correct").cast("double")).alias(name))
    both = mean(before, "a").join(mean(after, "b"), "case_id").select("case_id", (F.col("b") - F.col("a")).alias("share"))
    return _resampled(stored(both, "bootstrap"), "difference", draws, seed)


def kappa(rows: DataFrame, a: str, b: str) -> DataFrame:
    """Cohen's kappa of two labellings; null where chance alone agrees always."""
    counts = rows.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"), F.sum(F.when(F.col(a) == F.col(b), F.col("n")).otherwise(0)).alias("same"))
    left = counts.groupBy(F.col(a).alias("label")).agg(F.sum("n").alias("l"))
    right = counts.groupBy(F.col(b).alias("label")).agg(F.sum("n").alias("r"))
    chance = left.join(right, "label").agg(F.coalesce(F.sum(F.col("l") * F.col("r")), F.lit(0)).alias("both"))
    pe = F.col("both") / (F.col("total") * F.col("total"))
    po = F.col("same") / F.col("total")
    return total.crossJoin(F.broadcast(chance)).select("total", po.alias("agreement"), F.when(pe < 1, (po - pe) / (1 - pe)).alias("kappa"))  # one row


def quotas(sizes: DataFrame, n: int) -> DataFrame:
    """Seats of strata by largest remainder. ``sizes``: stratum, size (a row for each stratum)."""
    whole = Window.partitionBy(F.lit(1))
    exact = F.col("size") * n / F.sum("size").over(whole)
    rows = sizes.withColumn("exact", exact).withColumn("base", F.floor("exact"))
    left = F.lit(n) - F.sum("base").over(whole)
    place = F.row_number().over(Window.orderBy(F.desc(F.col("exact") - F.col("base")), "stratum"))
    return rows.withColumn("left", left).withColumn("place", place).select("stratum", (F.col("base") + (F.col("place") <= F.col("left")).cast("long")).alias("quota"))


def stratified(rows: DataFrame, stratum: str, key: str, n: int, pick: Column) -> DataFrame:
    """A sample with each stratum's quota, chosen by a hash. No quota exceeds n, so each task keeps
    the first n of a stratum before any are brought together."""
    sizes = rows.groupBy(F.col(stratum).alias("stratum")).agg(F.count(F.lit(1)).alias("size"))
    seats = quotas(sizes, n).withColumnRenamed("stratum", stratum)
    place = F.row_number().over(Window.partitionBy(stratum).orderBy(pick, key))
    first = rows.withColumn("_place", place).filter(F.col("_place") <= n)
    return first.join(seats, stratum).filter(F.col("_place") <= F.col("quota")).drop("_place", "quota")


def round_robin(rows: DataFrame, family: str, key: str, n: int) -> DataFrame:
    """One of each family in turn, until n; no family gives more than n."""
    place = F.row_number().over(Window.partitionBy(family).orderBy(key))
    return rows.withColumn("_turn", place).filter(F.col("_turn") <= n).orderBy("_turn", family).limit(n).drop("_turn")


def spread_margin(rows: DataFrame) -> DataFrame:
    """Least and most right cases over runs, and the margin: their spread, at least 1."""
    per = rows.groupBy("run").agg(F.count_if("correct").alias("right_"))
    return per.agg(F.min("right_").alias("least"), F.max("right_").alias("most"), F.greatest(F.lit(1), F.max("right_") - F.min("right_")).alias("margin"))


def gate(rows: DataFrame, asked: int, most_wrong: int, most_cost: float) -> DataFrame:
    """Whether a run passes: all cases asked, no error, few wrong, cheap enough."""
    held = rows.agg(F.countDistinct("case_id").alias("cases"), F.count_if("error").alias("errors"), F.count_if(~F.col("correct")).alias("wrong"), F.sum("cost").alias("cost"))
    good = (F.col("cases") == asked) & (F.col("errors") == 0) & (F.col("wrong") <= most_wrong) & (F.col("cost") <= most_cost)
    return held.withColumn("passed", good)


def routers(rows: DataFrame) -> DataFrame:
    """Two models by case (cheap_right, strong_right, cheap_cost, strong_cost, cheap_sure): accuracy
    and cost of each alone, of an oracle and of a cascade that asks the strong one when the cheap
    one is not sure."""
    oracle = F.when(F.col("cheap_right") | ~F.col("strong_right"), F.col("cheap_cost")).otherwise(F.col("strong_cost"))
    cascade_right = F.when(F.col("cheap_sure"), F.col("cheap_right")).otherwise(F.col("strong_right"))
    cascade_cost = F.col("cheap_cost") + F.when(F.col("cheap_sure"), 0.0).otherwise(F.col("strong_cost"))
    ways = F.array(*[
        F.struct(F.lit(name).alias("way"), right.alias("right_"), cost.alias("cost"))
        for name, right, cost in (
            ("cheap", F.col("cheap_right"), F.col("cheap_cost")),
            ("strong", F.col("strong_right"), F.col("strong_cost")),
            ("oracle", F.col("cheap_right") | F.col("strong_right"), oracle),
            ("cascade", cascade_right, cascade_cost),
        )
    ])
    return rows.select(F.explode(ways).alias("w")).groupBy("w.way").agg(F.avg(F.col("w.right_").cast("double")).alias("accuracy"), F.avg("w.cost").alias("cost"))


def cost_usd(tokens: dict[str, Column], rates: dict[str, str]) -> Column:
    """Token kinds times rates a million, exact."""
    parts = [tokens[k].cast("decimal(15,0)") * F.lit(rates[k]).cast("decimal(10,4)") for k in tokens]
    return sum(parts[1:], parts[0]) * F.lit("0.000001").cast("decimal(7,6)")


def means_margin(rows: DataFrame, value: str) -> DataFrame:
    """Mean of a figure by run, and the margin a later mean may move: the spread of these means."""
    per = rows.groupBy("run").agg(F.avg(value).alias("mean"))
    return per.agg(F.avg("mean").alias("mean"), (F.max("mean") - F.min("mean")).alias("margin"))


def worst_case_usd(prompt: Column, most_output: Column, tiers: list[tuple[int | None, dict[str, str]]]) -> Column:
    """The most a call can cost: nothing read from a cache, all output used, at the rates of the
    prompt's tier. Where a tier has a rate for writing to the cache, input costs the dearer of both."""
    dearest = [(most, rates | {"input": max(rates["input"], rates.get("cache_write", "0"), key=float)}) for most, rates in tiers]
    plain = [(most, {k: rates[k] for k in ("input", "output")}) for most, rates in dearest]
    return tiered_usd(prompt, {"input": prompt, "output": most_output}, plain)
