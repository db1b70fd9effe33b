"""Quality classifier: naive-Bayes-scaled n-gram indicators under a linear hinge loss (NBSVM).

A word is reduced to its shape: case, digits, length class, the exact punctuation at its end, and whether it repeats the
word before it. Features are the 1-, 2- and 3-grams of shapes and the words themselves, hashed into ``DIMENSIONS``
indicators: junk is a matter of form, and forms recur in every language.

Training, on a bounded sample of labelled rows (``TRAIN_ROWS``, and ``TRAIN_BYTES`` of features): class log-count ratios r scale the indicators, a linear
hinge-loss model is fitted by dual coordinate descent over the samples in random order, and the weights are drawn
towards their mean size (``BETA``). A fifth of the sample is left out of the fit and gives the logistic curve that turns
decision values into probabilities. Scoring sends one weight vector of fixed size to all tasks.

Edge cases: null and empty texts have no feature and get the probability of the bias alone; several labels of one doc_id
count as the largest; without labels of both kinds every score is the base rate, or 0.5 without labels; repeated rows
are scored each; texts of any length are scored whole; an empty table gives no rows; other columns, whatever their names, are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_stored, held_out, stored
from .toxicity import labelled, logistic
from .words import BYTE_CODE, SPACE, U, blocks, grams, mix, words

TRAIN_ROWS = 12_000
TRAIN_BYTES = 64 << 20
DIMENSIONS = 1 << 15
COST = 1.0
EPOCHS = 12
BETA = 0.5
SMOOTHING = 1.0
THRESHOLD = 0.3

_UPPER, _LOWERS, _DIGIT = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91], _LOWERS[97:123], _DIGIT[48:58] = True, True, True
_LOWERS[128:] = True


def features(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, feature numbers, with repeats) of each text."""
    for first_row, rows, raw, at in blocks(column):
        hashes, starts, ends, first = words(raw, at, SPACE, None)
        if not len(hashes):
            yield from ((first_row + r, np.zeros(0, np.int64)) for r in range(rows))
            continue
        some = lambda kind: np.diff(np.append(0, np.cumsum(kind[raw]))[np.stack([starts, ends])], axis=0)[0]
        upper, lower, digit, size = some(_UPPER), some(_LOWERS), some(_DIGIT), ends - starts
        rest = size - upper - lower - digit
        tail, tail2, tail3 = raw[ends - 1], raw[np.maximum(ends - 2, starts)], raw[np.maximum(ends - 3, starts)]
        letter = _UPPER | _LOWERS
        code = lambda t, k: np.where(letter[t], U(0), BYTE_CODE[t] * U(k))
        again = np.zeros(len(hashes), bool)
        again[1:] = hashes[1:] == hashes[:-1]
        again[first[:-1][first[:-1] < len(again)]] = False  # the first word of a text has none before it
        case = np.where(upper == 0, 0, np.where(lower == 0, 1, np.where(_UPPER[raw[starts]] & (upper == 1), 2, 3)))
        shape = mix(
            case.astype(U) + U(8) * np.minimum(digit, 3).astype(U) + U(64) * np.digitize(size, [2, 4, 8, 16, 32]).astype(U) + U(1024) * np.minimum(rest, 4).astype(U)
            + U(1 << 14) * again.astype(U) + code(tail, 3) + code(tail2, 5) + code(tail3, 7)
        )
        kinds = [(hashes, first)] + [grams(shape, first, k) for k in (1, 2, 3)]
        kinds = [((h >> U(20)).astype(np.int64) % DIMENSIONS, f) for h, f in kinds]
        for r in range(rows):
            yield first_row + r, np.concatenate([h[f[r] : f[r + 1]] for h, f in kinds])


def fit(rows: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights over indicators, and the bias, by dual coordinate descent on the L1 hinge loss."""
    y = np.where(labels > 0, 1.0, -1.0)
    p, q = np.full(DIMENSIONS, SMOOTHING), np.full(DIMENSIONS, SMOOTHING)
    for x, s in zip(rows, y, strict=True):
        (p if s > 0 else q)[x] += 1
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    squares = ratio * ratio
    scale = np.asarray([1 / np.sqrt(max(len(x), 1)) for x in rows])
    norms = np.asarray([squares[x].sum() * k * k + 1 for x, k in zip(rows, scale, strict=True)])
    weight = (y > 0).mean()
    cost = np.where(y > 0, COST * 0.5 / max(weight, 1e-9), COST * 0.5 / max(1 - weight, 1e-9))
    w, bias, alpha, rng = np.zeros(DIMENSIONS), 0.0, np.zeros(len(y)), np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(y)):
            x = rows[i]
            v = ratio[x] * scale[i]
            gradient = y[i] * (w[x] @ v + bias) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[x] += step * v
                bias += step
                alpha[i] = new
    w = (1 - BETA) * np.abs(w).mean() * np.sign(w) + BETA * w
    return w * ratio, bias


def decision(weights: np.ndarray, bias: float, x: np.ndarray) -> float:
    return float(weights[x].sum() / np.sqrt(max(len(x), 1)) + bias)


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, target: str = "quality", rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float, float, float]:
    """weights, bias, and slope and intercept of the logistic curve.

    The driver gets the feature numbers of the sample, two bytes each, of at most ``TRAIN_BYTES`` in all: the rows with the
    smallest hashes of doc_id whose features fit in.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(x).astype(np.uint16) for _, x in features(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([2 * len(x) for x in found], pa.int64()), pa.array([x.tobytes() for x in found], pa.binary())], ["doc_id", "label", "size", "x"])

    kept: list[str] = []
    try:
        sample = labelled(spark, docs, labels, target, rows, kept).mapInArrow(task, "doc_id long, label int, size long, x binary")
        sample = stored(spark, sample.withColumn("place", F.xxhash64("doc_id")), "features", kept)
        sizes = sample.select("place", "size").orderBy("place").toPandas()  # at most ``rows`` pairs of numbers
        fits = sizes["place"][sizes["size"].cumsum() <= TRAIN_BYTES]
        got = sample.filter(F.col("place") <= int(fits.iloc[-1])) if len(fits) else sample.limit(0)
        found = sorted(got.select("doc_id", "label", "x").collect())
    finally:
        drop_stored(spark, kept)
    y = np.asarray([r["label"] for r in found], int)
    x = [np.frombuffer(r["x"], np.uint16) for r in found]
    if len(set(y.tolist())) < 2:
        rate = 0.0 if not len(y) else float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
        return np.zeros(DIMENSIONS), 0.0, 0.0, rate
    apart = np.zeros(len(y), bool)
    for label in (0, 1):  # every fifth of each label, by doc_id
        apart[np.flatnonzero(y == label)[::5]] = True
    if len(set(y[apart].tolist())) < 2 or len(set(y[~apart].tolist())) < 2:
        apart = np.zeros(len(y), bool)
    w, bias = fit([v for v, out in zip(x, apart, strict=True) if not out], y[~apart])
    test = apart if apart.any() else np.ones(len(y), bool)
    z = np.asarray([decision(w, bias, v) for v, out in zip(x, test, strict=True) if out])
    slope = logistic(np.column_stack([np.ones(len(z)), z]), y[test].astype(float))
    return w, bias, float(slope[1]), float(slope[0])


SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def score_documents(spark: SparkSession, docs: DataFrame, model: tuple[np.ndarray, float, float, float]) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    sent = spark.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, bias, slope, intercept = sent.value
        present = np.zeros(DIMENSIONS, bool)
        for batch in batches:
            z = []
            for _, x in features(batch.column(2)):
                present[:] = False
                present[x] = True
                z.append(decision(w, bias, np.flatnonzero(present)))
            score = 1 / (1 + np.exp(-np.clip(slope * np.asarray(z) + intercept, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score, pa.float64()), pa.array((score >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"]
            )

    return docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(task, SCHEMA)
