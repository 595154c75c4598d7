"""Quality classifier: naive Bayes support vectors over byte n-grams.

A text is the set of its byte n-grams of order 1 to 3, and of the pairs of a word with itself,
hashed to ``2 ** bits`` features.  Each indicator is scaled by the log ratio of its smoothed
shares in the two classes and by the size of the set.  On these a linear hinge-loss model is
fitted by dual coordinate descent, one support value per text.  Margins become probabilities
by a logistic curve fitted on a fifth of the sample that the descent has not seen, weighted
to the true class sizes.

Fitting reads the whole texts of a bounded, documented sample of the labelled rows: about
``sample_rows`` per class, picked by a hash of the id.  Executors turn them into features; one task,
bounded by the sample, fits the model.  Scoring is a projection of the text alone.

Rows.  Null and empty texts have no n-grams and get the score of the bias.  Texts are read
whole; repeated rows are scored alike, and each pair of a document and a label of its id is a lesson.  Labels other than 0 and 1 and null ids or labels teach
nothing; a label without its document neither.  With one class only, or none, every text gets
the smoothed share of class 1.  The score is one new column, all others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import sampled, ship

_WEIGHTS = "weights binary, bias double, slope double, offset double"


@dataclass(frozen=True)
class Settings:
    sample_rows: int = 6_000
    bits: int = 18
    orders: int = 3
    cost: float = 10.0
    passes: int = 8
    seed: int = 7


def features(text: str | None, settings: Settings) -> np.ndarray:
    """The distinct features of a text, in order."""
    raw = (text or "").encode()
    if not raw:
        return np.zeros(0, np.int32)
    given = np.frombuffer(raw, np.uint8).astype(np.uint64)
    rolled, found = np.zeros(len(given), np.uint64), []
    for n in range(1, min(settings.orders, len(given)) + 1):
        rolled = rolled[: len(given) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + given[n - 1 :] + np.uint64(n)
        found.append(rolled)
    words = raw.split()
    same = sum(a == b for a, b in zip(words, words[1:]))
    if same:  # a word beside itself, by the share of such places
        found.append(np.array([(1 << 40) + int(np.log2(same / len(words)) - 1)], np.uint64))
    mixed = np.concatenate(found)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    seen = np.zeros(1 << settings.bits, bool)
    seen[(mixed >> np.uint64(64 - settings.bits)).astype(np.int64)] = True
    return np.flatnonzero(seen).astype(np.int32)


def log_count_ratios(rows: list[np.ndarray], good: np.ndarray, size: int) -> np.ndarray:
    """Log ratio of the smoothed share of every feature in the two classes."""
    counts = np.ones((2, size))
    for found, side in zip(rows, good, strict=True):
        counts[int(side), found] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def dual_descent(rows: list[np.ndarray], scaled: list[np.ndarray], side: np.ndarray, size: int, settings: Settings) -> np.ndarray:
    """Hinge loss with a quadratic penalty, solved over its dual; the last weight is the bias."""
    draw = np.random.default_rng(settings.seed)
    weights, support = np.zeros(size + 1), np.zeros(len(rows))
    norms = [v @ v + 1 for v in scaled]
    for _ in range(settings.passes):
        for i in draw.permutation(len(rows)):
            slope = side[i] * (weights[rows[i]] @ scaled[i] + weights[size]) - 1
            now = min(max(support[i] - slope / norms[i], 0.0), settings.cost)
            if now != support[i]:
                step = (now - support[i]) * side[i]
                weights[rows[i]] += step * scaled[i]
                weights[size] += step
                support[i] = now
    return weights


def logistic(margins: np.ndarray, good: np.ndarray, weight: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of the probability of class 1, by damped Newton steps; the slope is positive."""
    a, b = 1.0, 0.0
    target = np.where(good, (good.sum() + 1) / (good.sum() + 2), 1 / ((~good).sum() + 2))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g, h = weight * (p - target), weight * p * (1 - p) + 1e-9
        grad = np.array([g @ margins, g.sum()])
        hess = np.array([[h @ margins**2, h @ margins], [h @ margins, h.sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        a, b = max(a - np.clip(step[0], -1, 1), 1e-3), b - np.clip(step[1], -1, 1)
    return float(a), float(b)


def scale(found: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    return ratios[found] / np.sqrt(max(1, len(found)))


def train(rows: list[np.ndarray], good: np.ndarray, share: float, settings: Settings) -> tuple[np.ndarray, float, float, float]:
    """Weights by feature, bias, slope and offset; ``share`` is that of class 1 among all labelled rows."""
    size = 1 << settings.bits
    if good.all() or not good.any():
        return np.zeros(size), 0.0, 1.0, float(np.log(share / (1 - share)))
    held = np.arange(len(rows)) % 5 == 4
    if len(rows) < 50 or good[held].all() or not good[held].any():
        held[:] = False
    fitted = np.flatnonzero(~held)
    ratios = log_count_ratios([rows[i] for i in fitted], good[fitted], size)
    scaled = [scale(f, ratios) for f in rows]
    side = np.where(good, 1.0, -1.0)
    weights = dual_descent([rows[i] for i in fitted], [scaled[i] for i in fitted], side[fitted], size, settings)
    judged = np.flatnonzero(held) if held.any() else fitted
    margins = np.array([weights[rows[i]] @ scaled[i] + weights[size] for i in judged])
    there = good[judged]
    weight = np.where(there, share / max(1, there.sum()), (1 - share) / max(1, (~there).sum())) * len(judged)
    return weights[:size] * ratios, float(weights[size]), *logistic(margins, there, weight)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    offset: float
    settings: Settings

    def score(self, text: str | None) -> float:
        found = features(text, self.settings)
        margin = self.weights[found].sum() / np.sqrt(max(1, len(found))) + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30))))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", settings: Settings = Settings()) -> Model:
    """Learn from the documents that have a label."""
    ship(docs.sparkSession)
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter(
        "id IS NOT NULL AND label IN (0, 1)"
    )
    sizes = {r["label"]: r["rows"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("rows")).collect()}
    share = (sizes.get(1, 0) + 1) / (sum(sizes.values()) + 2)
    # Bounded by twice ``sample_rows``, whatever the size of the tables.
    picked = F.broadcast(sampled(known, "label", settings.sample_rows, sizes, "id"))

    @F.pandas_udf("array<int>")
    def turned(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t, settings) for t in texts], dtype=object)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(picked, "id")

    def one_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, labels_, order = [], [], []
        for batch in batches:
            found += [np.asarray(f, np.int32) for f in batch["found"]]
            labels_ += list(batch["label"])
            order += list(batch["rank"])
        by = np.argsort(np.array(order, np.int64), kind="stable")
        weights, bias, slope, offset = train([found[i] for i in by], np.array(labels_, int)[by] == 1, share, settings)
        yield pd.DataFrame([(weights.astype("<f8").tobytes(), bias, slope, offset)], columns=["weights", "bias", "slope", "offset"])

    sample = rows.select("label", F.xxhash64("id", "text", "label").alias("rank"), turned("text").alias("found"))
    result = sample.repartition(1).mapInPandas(one_task, _WEIGHTS).first()
    if result is None:  # no sample, no task
        weights, *rest = train([], np.zeros(0, bool), share, settings)
        return Model(weights, *rest, settings)
    return Model(np.frombuffer(result["weights"], "<f8"), result["bias"], result["slope"], result["offset"], settings)


def scorer(model: Model, spark):
    """The model as a function of a text column: probability of class 1."""
    ship(spark)
    ready = spark.sparkContext.broadcast(model)

    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([ready.value.score(t) for t in texts], dtype=float)

    udf = F.pandas_udf(score, "double").asNondeterministic()  # evaluated once

    def apply(text: Column) -> Column:
        return udf(text)

    return apply
