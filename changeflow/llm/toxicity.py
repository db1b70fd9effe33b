"""Toxic passages: every significant maximal-scoring segment of token log-odds, calibrated by extreme values.

Training, on a bounded sample of labelled rows (``TRAIN_ROWS``, the rows with the smallest hash of doc_id):

1. Documents that hold a token are counted by label. Log-odds with an informative Dirichlet prior (a token's frequency in
   both labels together, ``PRIOR`` documents in all) give each token a score. Tokens keep it if the signed root of
   their likelihood ratio against the base rate is at least ``LEAST_Z``, which allows for the many tokens tested (a Wald
   test is blind to tokens that one label never has); all others cost ``DRIFT``, so that the expected score of
   ordinary text is negative, which segment statistics need. One document of each family of copies counts (those with
   the same label and the same smallest 4-gram hash), or else a family's own words would pass for toxic ones.
2. The best segment scores of non-toxic training documents, less the log of their length, follow a Gumbel law; its scale
   and location are fitted by moments. A segment is significant if ordinary text of that length has one as good with a
   probability below ``ALPHA``.
3. A logistic curve over the evidence, the sum of -log p of all significant segments, and over -log p of the best one
   gives the probability.

Scoring walks each text once (Ruzzo and Tompa's linear-time search for all maximal segments); runs of ordinary tokens are
one step. Counts, statistics and scores use whole texts; the model holds at most ``MAX_TOKENS`` tokens and is sent to all tasks.

Edge cases: null and empty texts have no segments and get the probability of no evidence; several labels of one doc_id
count as the largest; without labels of both kinds every score is the base rate, or 0.5 without labels; repeated rows
are scored each; texts of any length are scored whole; an empty table gives no rows; other columns, whatever their names, are
ignored here and come back as they are from ``keep_clean``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_sample, drop_stored, held_out, stored
from .words import LOWER, NOT_ALNUM, blocks, grams, words

TRAIN_ROWS = 20_000
MAX_TOKENS = 50_000
PRIOR = 100.0
DRIFT = -0.25
LEAST_Z = 5.0
LEAST_DOCS = 4
ALPHA = 0.01

SCHEMA = "doc_id long, held_out boolean, score double, predicted int, n_passages int, passages array<struct<begin:int,end:int,score:double>>"


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last + 1, score) of a sequence, in linear time.

    Candidates are kept as (left sum, right sum, first, end); each new one is joined with the nearest candidate of smaller
    left sum as long as that one's right sum is smaller too. ``back`` links each candidate to that nearest one.
    """
    kept: list[tuple[float, float, int, int]] = []
    back: list[int] = []
    total = 0.0
    for i, x in enumerate(scores):
        before, total = total, total + x
        if x <= 0:
            continue
        left, first = before, i
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][0] >= left:
                j = back[j]
            if j < 0 or kept[j][1] >= total:
                kept.append((left, total, first, i + 1))
                back.append(j)
                break
            left, first = kept[j][0], kept[j][2]
            del kept[j:], back[j:]
    return [(first, end, right - left) for left, right, first, end in kept]


@dataclass(frozen=True)
class Model:
    tokens: np.ndarray  # sorted hashes
    scores: np.ndarray
    scale: float  # of the Gumbel law
    location: float
    weights: tuple[float, float, float]  # intercept, evidence, best

    def p_value(self, score: float, n_words: int) -> float:
        """Chance that ordinary text of n words holds a segment at least as good."""
        return -np.expm1(-np.exp(-(score - np.log(max(n_words, 1)) * self.scale - self.location) / self.scale))

    def probability(self, evidence: np.ndarray, best: np.ndarray) -> np.ndarray:
        a, b, c = self.weights
        return 1 / (1 + np.exp(-np.clip(a + b * np.log1p(evidence) + c * np.log1p(best), -30, 30)))


class Table:
    """Look-up of token scores by hash, without a search for the many words that have none."""

    def __init__(self, tokens: np.ndarray, scores: np.ndarray, bits: int = 20):
        self.tokens, self.scores, self.shift = tokens, scores, np.uint64(64 - bits)
        self.maybe = np.zeros(1 << bits, bool)
        self.maybe[tokens >> self.shift] = True

    def of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of known tokens and their scores."""
        at = np.flatnonzero(self.maybe[hashes >> self.shift])
        if not len(at) or not len(self.tokens):
            return np.zeros(0, np.int64), np.zeros(0)
        i = np.minimum(np.searchsorted(self.tokens, hashes[at]), len(self.tokens) - 1)
        hit = self.tokens[i] == hashes[at]
        return at[hit], self.scores[i[hit]]


def passages(table: Table, column: pa.Array) -> Iterator[tuple[int, int, list[tuple[int, int, float]]]]:
    """(row, words, segments as (begin byte, end byte, score)) of every text that has a scoring token; others as counts."""
    for first_row, rows, raw, at in blocks(column):
        hashes, starts, ends, first = words(raw, at, NOT_ALNUM, LOWER)
        where, scores = table.of(hashes)
        cuts = np.searchsorted(where, first)
        for r in range(rows):
            n, own = int(first[r + 1] - first[r]), slice(cuts[r], cuts[r + 1])
            found = []
            if cuts[r] < cuts[r + 1]:
                items, spots, last = [], [], int(first[r]) - 1
                for w, s in zip(where[own].tolist(), scores[own].tolist(), strict=True):
                    if w - last > 1:
                        items.append(DRIFT * (w - last - 1))
                        spots.append(w)
                    items.append(s)
                    spots.append(w)
                    last = w
                found = [(int(starts[spots[i]] - at[r]), int(ends[spots[j - 1]] - at[r]), s) for i, j, s in segments(items)]
            yield first_row + r, n, found


def labelled(spark: SparkSession, docs: DataFrame, labels: DataFrame, target: str, rows: int, kept: list[str]) -> DataFrame:
    """A bounded sample of training documents (doc_id, text, label), written once, so that all who read it see the same rows.

    The ids are those with the smallest hashes, at most ``rows``, and are broadcast. Of texts that share a doc_id the one
    with the smallest hash stands for it, and of each family of copies the smallest doc_id: neither the order of rows nor
    their partitioning has a say.
    """
    known = labels.filter(F.col(target).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    ids = known.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max(F.col(target).cast("int")).alias("_label"))
    ids = bounded_sample(ids, "_id", rows)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    each = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).join(F.broadcast(ids), F.col("doc_id") == F.col("_id"))
    each = each.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"), F.max("_label").alias("label"))
    each = each.select("doc_id", "t.text", "label").mapInArrow(_family, "doc_id long, text string, label int, family long")
    each = stored(spark, each, "sample", kept)
    first = each.groupBy("label", "family").agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    return each.join(F.broadcast(first), "doc_id").select("doc_id", "text", "label")


def _family(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the smallest 4-gram hash of each text (of its words, if there are fewer), which most copies share."""
    for batch in batches:
        family = []
        for _, rows, raw, at in blocks(batch.column(1)):
            hashes, _, _, first = words(raw, at, NOT_ALNUM, LOWER)
            four, start = grams(hashes, first, 4)
            for r in range(rows):
                own = four[start[r] : start[r + 1]] if start[r] < start[r + 1] else hashes[first[r] : first[r + 1]]
                family.append(int(own.min().view(np.int64)) if len(own) else 0)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(family, pa.int64())], ["doc_id", "text", "label", "family"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents by token and label, summed over a batch."""
    for batch in batches:
        label = np.asarray(batch.column(2).to_pylist(), np.int64)
        for first_row, rows, raw, at in blocks(batch.column(1)):
            hashes, _, _, first = words(raw, at, NOT_ALNUM, LOWER)
            doc = np.repeat(np.arange(rows), np.diff(first))
            order = np.lexsort((doc, hashes))
            h, d = hashes[order], doc[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
            h, toxic = h[new], label[first_row + d[new]]
            token, start = np.unique(h, return_index=True)
            if len(token):
                both, yes = np.diff(np.append(start, len(h))), np.add.reduceat(toxic, start)
                yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(both), pa.array(yes)], ["token", "n", "n_toxic"])


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, target: str = "toxic", rows: int = TRAIN_ROWS) -> Model:
    kept: list[str] = []
    try:
        return _fit(labelled(spark, docs, labels, target, rows, kept))
    finally:
        drop_stored(spark, kept)


def _fit(sample: DataFrame) -> Model:
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    yes, no = sizes.get(1, 0), sizes.get(0, 0)
    nothing = np.zeros(0)
    if not yes or not no:
        rate = 0.0 if yes + no == 0 else np.log((yes + 0.5) / (no + 0.5))
        return Model(np.zeros(0, np.uint64), nothing, 1.0, 0.0, (float(rate), 0.0, 0.0))
    counted = sample.mapInArrow(_count, "token long, n long, n_toxic long").groupBy("token").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("y"))
    prior = F.col("n") * F.lit(PRIOR / (yes + no))
    odds = lambda k, total: F.log((k + prior) / (F.lit(total + PRIOR) - k - prior))
    rest = F.col("n") - F.col("y")
    rate = yes / (yes + no)
    part = lambda k, share: F.when(k > 0, k * F.log(k / (F.col("n") * share))).otherwise(0.0)
    scored = (
        counted.filter((F.col("y") >= LEAST_DOCS) & (F.col("y") > F.col("n") * rate))
        .select("token", (odds(F.col("y"), yes) - odds(rest, no)).alias("delta"), F.sqrt(2 * (part(F.col("y"), rate) + part(rest, 1 - rate))).alias("z"))
        .filter((F.col("z") >= LEAST_Z) & (F.col("delta") > 0)).orderBy(F.desc("z"), "token").limit(MAX_TOKENS).collect()
    )
    tokens = np.asarray([r["token"] for r in scored], np.int64).view(np.uint64)
    order = np.argsort(tokens)
    tokens, scores = tokens[order], np.asarray([r["delta"] for r in scored])[order]
    if not len(tokens):
        return Model(tokens, scores, 1.0, 0.0, (float(np.log(yes / no)), 0.0, 0.0))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(tokens, scores)
        for batch in batches:
            got = [(n, max((s for _, _, s in found), default=0.0)) for _, n, found in passages(table, batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([n for n, _ in got], pa.int64()), pa.array([s for _, s in got], pa.float64())], ["doc_id", "label", "n", "s"])

    # two passes over the sample, each of at most ``TRAIN_ROWS`` rows of a few numbers, however long the texts are
    seen = sample.mapInArrow(best, "doc_id long, label int, n long, s double").collect()
    seen.sort(key=lambda r: r["doc_id"])  # sums of floats depend on their order
    null = np.asarray([r["s"] for r in seen if r["label"] == 0])
    length = np.asarray([np.log(max(r["n"], 1)) for r in seen if r["label"] == 0])
    scale = max(float(np.std(null)) * np.sqrt(6) / np.pi, 0.25)
    location = float(np.mean(null - scale * length)) - 0.5772156649 * scale
    raw = Model(tokens, scores, scale, location, (0.0, 0.0, 0.0))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(tokens, scores)
        for batch in batches:
            got = [evidence(raw, n, [s for _, _, s in found]) for _, n, found in passages(table, batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([g[i] for g in got], pa.float64()) for i in (0, 1))], ["doc_id", "evidence", "best"])

    facts = sorted(sample.mapInArrow(weigh, "doc_id long, evidence double, best double").collect(), key=lambda r: r["doc_id"])
    x = np.column_stack([np.ones(len(seen)), np.log1p(np.asarray([(r["evidence"], r["best"]) for r in facts]))])
    return Model(tokens, scores, scale, location, tuple(logistic(x, np.asarray([r["label"] for r in seen], float))))


def evidence(model: Model, n_words: int, scores: list[float]) -> tuple[float, float]:
    logs = [-np.log(max(p, 1e-300)) for s in scores if (p := model.p_value(s, n_words)) <= ALPHA]
    return float(sum(logs)), float(max(logs, default=0.0))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.clip(np.linalg.solve(h, x.T @ (y - p) - ridge * w), -3, 3)
    return w


def score_documents(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages, passages (byte ranges of significant segments and their scores)."""
    sent = spark.sparkContext.broadcast(model)
    kinds = pa.schema([
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32()), ("n_passages", pa.int32()),
        ("passages", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))),
    ])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        table = Table(m.tokens, m.scores)
        for batch in batches:
            found, facts = [], []
            for _, n, spans in passages(table, batch.column(2)):
                found.append([{"begin": b, "end": e, "score": s} for b, e, s in spans if m.p_value(s, n) <= ALPHA])
                facts.append(evidence(m, n, [s for _, _, s in spans]))
            f = np.asarray(facts).reshape(-1, 2)
            score = m.probability(f[:, 0], f[:, 1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array([len(x) for x in found], pa.int32()), pa.array(found, kinds.field("passages").type)],
                schema=kinds,
            )

    return docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(task, SCHEMA)


def keep_clean(spark: SparkSession, docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """Rows whose text scores below the threshold, as they came."""
    sent, place = spark.sparkContext.broadcast(model), docs.columns.index("text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        table = Table(m.tokens, m.scores)
        for batch in batches:
            facts = [evidence(m, n, [s for _, _, s in spans]) for _, n, spans in passages(table, batch.column(place))]
            f = np.asarray(facts).reshape(-1, 2)
            if (keep := m.probability(f[:, 0], f[:, 1]) < threshold).any():
                yield batch.filter(pa.array(keep))

    return docs.mapInArrow(task, docs.schema)
