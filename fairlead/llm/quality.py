"""Quality classifier: a linear support vector machine over naive-Bayes-scaled n-gram indicators."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairlead.llm.common import arrow_rows, fold_of, matched, portions, uniform
from fairlead.llm.features import BITS, ngram_features

FOLDS = 5
# At most about so many labelled documents are fitted, each with all of its distinct features;
# the draw is by a hash of doc_id.
SAMPLE = 6_000
THRESHOLD = 0.3
PORTION = 1 << 20


@dataclass(frozen=True)
class Model:
    """weight: of a feature's scaled indicator, times its scale; square: its scale squared."""

    weight: np.ndarray
    square: np.ndarray
    bias: float
    slope: float
    offset: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Probability-like scores in [0, 1] of the texts being of label 1."""
        row, feature = ngram_features(texts)
        n = len(texts)
        dot = np.bincount(row, self.weight[feature], n)
        norm = np.sqrt(np.bincount(row, self.square[feature], n))
        margin = dot / np.maximum(norm, 1e-9) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


def log_count_ratios(rows: list[np.ndarray], good: np.ndarray, size: int, alpha: float = 1.0) -> np.ndarray:
    """log of the smoothed share of label 1's indicators over that of label 0's, per feature."""
    p, q = np.full(size, alpha), np.full(size, alpha)
    for features, label in zip(rows, good):
        (p if label else q)[features] += 1
    return np.log((p / p.sum()) / (q / q.sum()))


def dual_descent(
    rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int, cost: np.ndarray, epochs: int = 8
) -> tuple[np.ndarray, float]:
    """A linear hinge-loss fit: one dual variable per row, each in turn set to its best value.

    min 1/2 |w|^2 + sum cost_i * max(0, 1 - y_i w.x_i). Per row the dual objective is a
    parabola in alpha_i, clipped to [0, cost_i]; w is kept up to date. The last component of x
    is a constant 1 for the bias.
    """
    w, bias = np.zeros(size), 0.0
    alpha = np.zeros(len(rows))
    q = np.array([float(v @ v) + 1.0 for v in values])
    order = np.random.default_rng(1)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            x, v = rows[i], values[i]
            slope = y[i] * (w[x] @ v + bias) - 1
            new = min(max(alpha[i] - slope / q[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[x] += step * v
                bias += step
                alpha[i] = new
    return w, bias


def _fit_once(rows: list[np.ndarray], good: np.ndarray, size: int, c: float) -> tuple[np.ndarray, np.ndarray, float]:
    ratio = log_count_ratios(rows, good, size)
    values = []
    for x in rows:
        v = ratio[x]
        values.append(v / max(float(np.sqrt(v @ v)), 1e-9))
    share = np.array([max(1, int((~good).sum())), max(1, int(good.sum()))])
    cost = c * len(rows) / (2 * share[good.astype(int)])
    w, bias = dual_descent(rows, values, np.where(good, 1.0, -1.0), size, cost)
    return w * ratio, ratio**2, bias


def _margins(rows: list[np.ndarray], weight: np.ndarray, square: np.ndarray, bias: float) -> np.ndarray:
    return np.array([weight[x].sum() / max(float(np.sqrt(square[x].sum())), 1e-9) + bias for x in rows])


def calibrate(
    margins: np.ndarray, good: np.ndarray, count: np.ndarray | None = None, steps: int = 200
) -> tuple[float, float]:
    """Slope and offset of a logistic curve through held-out margins, by Newton steps.

    Each row stands for `count` rows, so that the curve has the shares of what was drawn from.
    """
    slope, offset = 1.0, 0.0
    count = np.ones(len(good)) if count is None else count / count.mean()
    n1, n0 = int(good.sum()), int((~good).sum())
    aim = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -30, 30)))
        g, h = count * (p - aim), count * p * (1 - p) + 1e-9
        a, b, d = (h * margins**2).sum() + 1e-6, (h * margins).sum(), h.sum() + 1e-6
        ga, gb = (g * margins).sum(), g.sum()
        det = a * d - b * b
        move = np.array([d * ga - b * gb, a * gb - b * ga]) / det
        move = np.clip(move, -1, 1)
        slope, offset = slope - move[0], offset - move[1]
        if np.abs(move).max() < 1e-9:
            break
    return max(float(slope), 1e-3), float(offset)


def fit(
    rows: list[np.ndarray], good: np.ndarray, bits: int = BITS, c: float = 1.0, count: np.ndarray | None = None
) -> Model:
    """The model of a list of feature arrays, their labels, and for how many rows each stands.

    Each half is scored by a fit on the other to calibrate the scores. The fits give both labels
    the same cost whatever their shares; the calibration alone knows the shares, from `count`.
    With one label alone all scores are that label; without rows they are 1.
    """
    size = 1 << bits
    if good.all() or not good.any():
        sure = 30.0 if good.all() else -30.0
        return Model(np.zeros(size), np.zeros(size), 0.0, 1.0, sure)
    half = np.arange(len(rows)) % 2 == 0
    margins = np.zeros(len(rows))
    for part in (half, ~half):
        inside, outside = np.flatnonzero(part), np.flatnonzero(~part)
        if not len(inside):
            continue
        fitted = _fit_once([rows[i] for i in inside], good[inside], size, c)
        margins[outside] = _margins([rows[i] for i in outside], *fitted)
    slope, offset = calibrate(margins, good, count)
    weight, square, bias = _fit_once(rows, good, size, c)
    return Model(weight, square, bias, slope, offset)


def training_rows(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE
) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Features, labels and counts of about `sample` labelled documents outside the held-out fold.

    Labels are drawn by a hash of doc_id at a rate that meets the bound, class by class, so that
    a rare label is not lost: at most half of the sample each. A row's count is how many labels
    of its class there are for each one drawn. Labels other than 0 and 1 are left out; of
    several labels of an id the smallest counts.
    """
    usable = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (fold_of("doc_id", FOLDS) != 0))
    usable = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"))

    def by_label(rows: DataFrame) -> dict[int, int]:
        return {r["quality"]: r["n"] for r in rows.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}

    counts = by_label(usable)
    rate = F.when(F.col("quality") == 1, sample / 2 / max(1, counts.get(1, 0))).otherwise(
        sample / 2 / max(1, counts.get(0, 0))
    )
    drawn = usable.filter(uniform("doc_id", seed=4) < rate)
    taken = by_label(drawn) if max(counts.values(), default=0) > sample / 2 else counts
    drawn = drawn.withColumnRenamed("doc_id", "_labelled")
    texts = docs.select("doc_id", F.col("text").cast("string")).join(
        F.broadcast(drawn), F.col("doc_id") == F.col("_labelled")
    )
    schema = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("features", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in portions(whole, "text", PORTION):
                row, feature = ngram_features(batch.column(1))
                at = np.searchsorted(row, np.arange(batch.num_rows + 1))
                packed = [feature[a:b].astype("<i4").tobytes() for a, b in zip(at[:-1], at[1:])]
                yield arrow_rows(schema, doc_id=batch.column(0), quality=batch.column(2), features=packed)

    texts = texts.select(F.col("doc_id").cast("long"), "text", F.col("quality").cast("int"))
    gathered = texts.mapInArrow(run, "doc_id long, quality int, features binary").collect()
    gathered.sort(key=lambda r: (r["doc_id"], bytes(r["features"])))
    rows = [np.frombuffer(r["features"], "<i4") for r in gathered]
    count = np.array([counts[r["quality"]] / taken[r["quality"]] for r in gathered], float)
    return rows, np.array([r["quality"] == 1 for r in gathered], bool), count


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """Per document: doc_id, held_out, score (0 to 1) and predicted (1 if score >= threshold).

    The fit sees a bounded sample of labelled documents outside the held-out fold
    (crc32(doc_id) mod 5 = 0), and the scores have the shares of all labels there, whatever the
    sample's; every whole text is scored by its words alone. Null and empty
    texts get the score of a text without features. Rows that repeat an id are scored each by
    its own text; a null id is in the fold of the empty text. An empty table gives one; without
    usable labels all scores are of label 1. A text of any length is scored whole, as a portion
    of its own. Columns other than doc_id and text, and doc_id and quality of the labels, are
    ignored.
    """
    rows, good, count = training_rows(docs, labels, sample)
    model = fit(rows, good, count=count)
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.weight.astype(np.float32), model.square.astype(np.float32), model.bias, model.slope, model.offset)
    )
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("text_hash", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for whole in batches:
            for batch in portions(whole, "text", PORTION):
                yield arrow_rows(
                    schema,
                    doc_id=batch.column(0),
                    held_out=batch.column(2),
                    score=model.scores(batch.column(1)),
                    text_hash=batch.column(3),
                )

    given = docs.select(
        F.col("doc_id").cast("long"),
        F.col("text").cast("string"),
        (fold_of("doc_id", FOLDS) == 0).alias("held_out"),
        F.xxhash64("text").alias("text_hash"),
    )
    scored = given.mapInArrow(run, "doc_id long, held_out boolean, score double, text_hash long")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, scored: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject, with their own columns."""
    return matched(docs, scored.filter("predicted = 0"), "left_anti")
