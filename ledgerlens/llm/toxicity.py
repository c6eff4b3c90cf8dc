"""Toxicity as ordered severity grades by cumulative-link regression.

Features are the distinct words of a text and the words' beginnings of 4, 5 and 6 bytes, each a
64-bit hash; of those seen in the training sample the ones that speak most for toxic text are
selected. The model is P(grade <= k) = sigmoid(threshold_k - w.x) with one weight vector for all
thresholds, which are ordered by construction; it gives a distribution over grades and its mean,
the expected severity. A text is toxic if the chance of grade 0 lies below a cut; its grade is then
the likeliest of the others, else 0. The cut is set so that misses and, five times as much, false
rejections are fewest among scores of rows that had no part in the model that scored them: the
sample is split in FOLDS, and each is scored by a model selected and fitted on the others.

The sample is bounded: at most TOXIC_ROWS and CLEAN_ROWS labelled rows, by hash of the id. Grades
come from the labels alone: 0 for a clean row, 1 for a toxic one, 2 for a toxic one that is marked
as of poor quality too. Tables with grades of their own go to ``fit`` directly.

Scoring reads every whole text. Defined results: a null text is empty and has no feature; a null
label is no label; rows that repeat are scored each; without labels of both kinds nothing is
toxic (severity 0); an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared
from .licenses import words_of

TOXIC_ROWS, CLEAN_ROWS = 2_000, 6_000
FOLDS = 3
#: A feature needs this many toxic rows, and this share of its rows (by class rate) toxic. The
#: count holds for a full sample and follows the number of its toxic rows, down to FEWEST_ROWS.
LEAST_ROWS, LEAST_SHARE = 5, 0.97
FEWEST_ROWS = 3
#: Weight of the squared weights in the fit: features of few rows stay small.
L2 = 2e-3
PREFIXES = (4, 5, 6)
GRADES = 3
CACHED_WORDS = 200_000
SCORED = "doc_id long, severity double, p_clean double, grade long, toxic boolean, n_features long"


def features_of(word: bytes) -> tuple[int, ...]:
    """Hashes of a word and of its beginnings."""
    from xxhash import xxh3_64_intdigest as hashed

    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return (signed(hashed(word)), *(signed(hashed(word[:n], seed=n)) for n in PREFIXES if len(word) > n))


class Features(dict):
    """Selected features of a word, remembered for words met before."""

    def __init__(self, selected: set[int] | None):
        super().__init__()
        self.selected = selected

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= CACHED_WORDS:
            self.clear()
        found = features_of(word)
        self[word] = found = found if self.selected is None else tuple(f for f in found if f in self.selected)
        return found

    def of(self, text: bytes) -> set[int]:
        return set().union(*filter(None, map(self.__getitem__, set(words_of(text)))))


@dataclass
class SeverityModel:
    """Weights by feature, ordered thresholds (one less than there are grades) and the cut."""

    weights: dict[int, float] = field(default_factory=dict)
    thresholds: tuple[float, ...] = ()
    cut: float = 0.5

    def grades(self, found: set[int]) -> list[float]:
        """Probability of each grade; without a model all is grade 0."""
        from math import exp

        if not self.thresholds:
            return [1.0]
        score = sum(self.weights.get(f, 0.0) for f in sorted(found))
        upto = [1 / (1 + exp(min(700.0, max(-700.0, score - t)))) for t in self.thresholds] + [1.0]
        return [upto[0], *(b - a for a, b in zip(upto, upto[1:], strict=False))]


def fit(rows: list[tuple[int, list[int]]], grades: int = GRADES, l2: float = L2, steps: int = 400, rate: float = 0.05) -> SeverityModel:
    """Cumulative-link regression of (grade, features) rows by full gradient steps (Adam)."""
    import numpy as np

    y = np.array([g for g, _ in rows])
    names = sorted({f for _, fs in rows for f in fs})
    place = {f: i for i, f in enumerate(names)}
    of_row = np.repeat(np.arange(len(rows)), [len(fs) for _, fs in rows])
    column = np.array([place[f] for _, fs in rows for f in fs], dtype=int)
    share = np.cumsum(np.bincount(y, minlength=grades))[:-1] / len(rows)
    first = np.log((share + 1e-3) / (1 - share + 1e-3))
    # thresholds: the first, then steps that are exponentials and so positive
    free = np.concatenate([np.zeros(len(names)), [first[0]], np.log(np.maximum(np.diff(first), 1e-2))])
    m, v = np.zeros_like(free), np.zeros_like(free)
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -500, 500)))

    def levels(tail):
        return np.concatenate([tail[:1], tail[0] + np.cumsum(np.exp(tail[1:]))])

    for step in range(1, steps + 1):
        w, tail = free[: len(names)], free[len(names) :]
        theta = levels(tail)
        score = np.bincount(of_row, w[column], minlength=len(rows)) if len(column) else np.zeros(len(rows))
        edges = np.concatenate([[-np.inf], theta, [np.inf]])
        high, low = sigmoid(edges[y + 1] - score), sigmoid(edges[y] - score)
        chance = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high) / chance, low * (1 - low) / chance
        d_score = (d_high - d_low) / len(rows)  # of the mean negative log likelihood
        d_w = np.bincount(column, d_score[of_row], minlength=len(names)) + l2 * w if len(column) else l2 * w
        d_theta = np.zeros(grades + 1)
        np.add.at(d_theta, y + 1, -d_high / len(rows))
        np.add.at(d_theta, y, d_low / len(rows))
        d_theta = d_theta[1:-1]
        above = np.cumsum(d_theta[::-1])[::-1]
        d_tail = np.concatenate([[above[0]], above[1:] * np.exp(tail[1:])])
        g = np.concatenate([d_w, d_tail])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        free = free - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return SeverityModel(dict(zip(names, free[: len(names)].tolist(), strict=True)), tuple(levels(free[len(names) :]).tolist()))


def best_cut(rows: list[tuple[float, bool]], weight: float = 5.0, place: float = 0.5) -> float:
    """A cut in the range of those with the least cost over (p_clean, toxic) rows: the share of
    toxic rows above the cut plus ``weight`` times the share of clean rows below it. Of ranges that
    cost the same the highest counts, and ``place`` says where in it the cut lies."""
    toxic, clean = sum(t for _, t in rows), sum(not t for _, t in rows)
    if not toxic or not clean:
        return 0.5
    costs, missed, rejected = [], toxic, 0
    places = sorted({p for p, _ in rows})
    by_place: dict[float, list[int]] = {p: [0, 0] for p in places}
    for p, t in rows:
        by_place[p][t] += 1
    costs.append((missed / toxic, 0.0, places[0]))
    for p, after in zip(places, [*places[1:], 1.0], strict=True):
        missed -= by_place[p][1]
        rejected += by_place[p][0]
        costs.append((missed / toxic + weight * rejected / clean, p, after))
    least = min(c for c, _, _ in costs)
    low, high = next((a, b) for c, a, b in reversed(costs) if c <= least)
    return low + place * (high - low)


SAMPLED = "toxic int, grade int, fold int"


def _extract(selected: frozenset[int] | None):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        features = Features(None if selected is None else set(selected))
        for batch in batches:
            found = [sorted(features.of(t)) for t in shared.text_bytes(batch.column(3))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(found, pa.list_(pa.int64()))], names=["toxic", "grade", "fold", "features"])

    return run


def sample(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> DataFrame:
    """toxic, grade, fold and text of a bounded sample of the labelled documents, the same for
    every run. Rows that repeat an id, in either table, all count, but the bounds hold for rows too.
    Folds go by the id, so rows that repeat one are in one fold."""
    toxic, quality = F.col("toxic").cast("int"), F.col("quality").cast("int")
    grade = F.when(toxic == 0, 0).when(quality == 0, 2).otherwise(1)
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int")
    known = labels.select(F.col("doc_id").alias("label_id"), toxic.alias("toxic"), grade.alias("grade"), fold.alias("fold")).filter("label_id is not null and toxic is not null")
    parts = [known.filter(F.col("toxic") == kind).orderBy(F.xxhash64("label_id"), "label_id", "grade").limit(most) for kind, most in ((1, toxic_rows), (0, clean_rows))]
    chosen = parts[0].unionByName(parts[1])  # at most toxic_rows + clean_rows narrow rows
    rows = docs.select(F.col("doc_id").alias("label_id"), F.col("text").alias("text")).join(F.broadcast(chosen), "label_id")
    first = [rows.filter(F.col("toxic") == kind).orderBy(F.xxhash64("label_id"), "label_id", F.xxhash64("text"), "grade").limit(most) for kind, most in ((1, toxic_rows), (0, clean_rows))]
    return first[0].unionByName(first[1]).select("toxic", "grade", "fold", "text")


def least_rows(toxic: int, toxic_rows: int = TOXIC_ROWS) -> int:
    """Toxic rows that a feature needs in a sample of so many of them."""
    return max(FEWEST_ROWS, min(LEAST_ROWS, round(LEAST_ROWS * toxic / toxic_rows)))


def _selected(counts: DataFrame, sizes: dict[tuple[int, int], int], without: int, toxic_rows: int) -> frozenset[int]:
    """Features that speak for toxic text in all folds but one (-1: in all). Their number is bounded
    by the words of the sample. ``counts``: feature, fold, toxic, n."""
    bad, good = (sum(n for (fold, toxic), n in sizes.items() if fold != without and toxic == kind) for kind in (1, 0))
    if not bad or not good:
        return frozenset()
    seen = counts.filter(F.col("fold") != without).groupBy("feature").agg(F.sum(F.col("toxic") * F.col("n")).alias("bad"), F.sum("n").alias("n"))
    rate = F.col("bad") / bad
    # what a feature needs in the whole sample, it needs in proportion in a part of the folds
    least = least_rows(sum(n for (_, toxic), n in sizes.items() if toxic), toxic_rows)
    least = least if without < 0 else max(1, round(least * (FOLDS - 1) / FOLDS))
    strong = seen.filter((F.col("bad") >= least) & (rate / (rate + (F.col("n") - F.col("bad")) / good) >= LEAST_SHARE))
    return frozenset(r["feature"] for r in strong.select("feature").collect())


def train(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> SeverityModel:
    """Select features, fit, and set the cut, all on the bounded sample."""
    shared.prepare(docs.sparkSession)
    chosen = shared.stored(sample(docs, labels, toxic_rows, clean_rows), "toxic-sample", narrow=True)
    sizes = {(r["fold"], r["toxic"]): r["count"] for r in chosen.groupBy("fold", "toxic").count().collect()}
    if len({toxic for _, toxic in sizes}) < 2:
        return SeverityModel()
    seen = chosen.mapInArrow(_extract(None), f"{SAMPLED}, features array<long>").select("toxic", "fold", F.explode("features").alias("feature"))
    counts = shared.stored(seen.groupBy("feature", "fold", "toxic").agg(F.count(F.lit(1)).alias("n")), "toxic-counts", narrow=True)
    chosen_by = {without: _selected(counts, sizes, without, toxic_rows) for without in (-1, *range(FOLDS))}
    if not chosen_by[-1]:
        return SeverityModel()
    found = chosen.mapInArrow(_extract(frozenset().union(*chosen_by.values())), f"{SAMPLED}, features array<long>").collect()
    rows = sorted((r["fold"], r["toxic"], r["grade"], r["features"]) for r in found)

    def fitted(without: int) -> SeverityModel:
        kept = chosen_by[without]
        return fit([(grade, [f for f in features if f in kept]) for fold, _, grade, features in rows if fold != without])

    model, others = fitted(-1), {}
    scores = []
    for fold, toxic, _, features in rows:
        if fold not in others:
            others[fold] = fitted(fold) if chosen_by[fold] else SeverityModel()
        scores.append((others[fold].grades(set(features))[0], bool(toxic)))
    model.cut = best_cut(scores)
    return model


def _score(model: SeverityModel):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        features = Features(set(model.weights))
        kinds = [pa.float64(), pa.float64(), pa.int64(), pa.bool_(), pa.int64()]
        try:
            for batch in batches:
                rows = []
                for text in shared.text_bytes(batch.column(1)):
                    found = features.of(text)
                    chances = model.grades(found)
                    severity = sum(k * p for k, p in enumerate(chances))
                    toxic = chances[0] < model.cut
                    grade = chances.index(max(chances[1:]), 1) if toxic else 0
                    rows.append((severity, chances[0], grade, toxic, len(found)))
                columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["row", *(x.split()[0] for x in SCORED.split(", ")[1:])])

        finally:
            features.clear()
            shared.let_go()

    return run


def score(docs: DataFrame, model: SeverityModel, text: str = "text") -> DataFrame:
    """The documents as a struct ``row`` with severity, p_clean, grade, toxic and n_features."""
    shared.prepare(docs.sparkSession)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("text"))
    out = T.StructType([T.StructField("row", rows.schema["row"].dataType), *T.StructType.fromDDL(SCORED).fields[1:]])
    return rows.mapInArrow(_score(model), out)
