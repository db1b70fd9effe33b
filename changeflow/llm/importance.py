"""Importance resampling towards a target distribution, by hashed word-run features.

Words are what is left of a text (A-Z lower-cased, nothing else) between ASCII characters that are neither letters nor digits.
A document's features are its runs of 1 to ``longest`` words, joined by a space, repeats counted; the CRC-32 of a feature's UTF-8
bytes modulo ``buckets`` is its bucket. A bucket's gain is floor(1000 * ln of the smoothed share of the target's features in it over
that of the documents'); a document's weight is the sum of gains of its features, its score the weight plus Gumbel noise that
``seed`` and doc_id decide. The ``percent`` share of highest scores among documents of ``least_words`` words is drawn: a sample
without replacement, with chances in proportion to exp(weight / 1000).

Two passes over the texts, each with a trie of words a partition (``Trie``):

1. Nodes count how often their feature was met and hold its CRC-32, which continues that of the node above. A partition gives
   its totals by bucket, which are summed; what reaches the driver are ``buckets`` numbers each of documents and target.
2. Nodes hold the gain of their bucket, looked up once when a node is made; a document's weight is the sum along its paths.

A trie that has grown to ``NODES`` nodes or ``NODE_BYTES`` bytes of words is emptied (its counts go to the totals first), so that a
task's memory is bounded whatever its vocabulary; texts are cut into words ``PIECE`` bytes at a time, features run across the cuts.
Ranks come from one sort by range and a count for each range; equal scores, and rows that agree in all, are spread over ranges.

Edge cases: null and empty texts, and texts without words, have no features, weight 0 and no rank; documents of any length are
read whole (a single word has to fit into memory); ties of score go to the smaller doc_id, null ids last; a null doc_id counts as the empty string
in the noise; rows that share a doc_id are separate documents with the same noise; repeated rows have neighbouring ranks; an
empty target gives all features of a bucket the same gain rule with t = T = 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored
from .sharding import row_numbers
from .words import flat

NODES, NODE_BYTES, PIECE = 1 << 17, 1 << 26, 1 << 20
#: Bytes of words as they are, A-Z in lower case, all others as spaces.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))


def runs(text: bytes, longest: int) -> Iterator[tuple[list[bytes], int]]:
    """(words, old): the words of a text, piece by piece; the first ``old`` of each piece are the last ones of the piece before."""
    tail, begin = [], 0
    while begin < len(text):
        end = begin + PIECE
        if end < len(text):
            # up to the last separator of the piece, or the first one behind it
            part = text[begin:end].translate(_FOLD)
            cut = part.rfind(b" ")
            while cut < 0 and end < len(text):
                begin_more, end = end, end + PIECE
                more = text[begin_more:end].translate(_FOLD)
                cut = more.find(b" ")
                part, cut = part + more, cut if cut < 0 else len(part) + cut
            part = part if cut < 0 else part[: cut + 1]
        else:
            part = text[begin:].translate(_FOLD)
        begin += len(part)
        words = part.split()
        if words:
            yield tail + words, len(tail)
            tail = (tail + words)[1 - longest :] if longest > 1 else []


class Trie:
    """Words on the edges; a node is the feature that its path spells. Node 0 is the root."""

    def __init__(self, buckets: int, longest: int, gains: np.ndarray | None = None):
        self.buckets, self.longest, self.gains = buckets, longest, gains
        self.totals = np.zeros(buckets, np.int64)
        self.clear()

    def clear(self) -> None:
        self.edges: dict[tuple[int, bytes], int] = {}
        self.crc, self.gain, self.bytes, self.met = [0], [0], 0, []

    def _grow(self, node: int, word: bytes) -> int:
        if (known := self.edges.get((node, word))) is not None:
            return known
        self.edges[node, word] = new = len(self.crc)
        self.crc.append(zlib.crc32(b" " + word, self.crc[node]) if node else zlib.crc32(word))
        self.bytes += len(word)
        if self.gains is not None:
            self.gain.append(int(self.gains[self.crc[new] % self.buckets]))
        return new

    def walk(self, words: list[bytes], old: int) -> list[int]:
        """Nodes of the features that end behind the first ``old`` words, shorter features first."""
        nodes, level = [], [0] * len(words)
        for depth in range(self.longest):
            above, level = level, list(map(self.edges.get, zip(level, words[depth:] if depth else words)))
            if None in level:
                level = [self._grow(above[i], words[depth + i]) if n is None else n for i, n in enumerate(level)]
            nodes += level[max(0, old - depth) :]
        return nodes

    def full(self) -> bool:
        return len(self.crc) > NODES or self.bytes > NODE_BYTES

    def count(self, text: bytes) -> None:
        for words, old in runs(text, self.longest):
            self.met += self.walk(words, old)
            if len(self.met) > 1 << 20 or self.full():
                self.settle()

    def settle(self) -> None:
        """Counts of nodes go to their buckets; a full trie begins anew."""
        n = np.bincount(np.asarray(self.met, np.int64), minlength=len(self.crc))
        np.add.at(self.totals, np.asarray(self.crc, np.int64)[n > 0] % self.buckets, n[n > 0])
        self.met = []
        if self.full():
            self.clear()

    def weigh(self, text: bytes) -> tuple[int, int, int]:
        """Features, words and weight of a text."""
        features = n_words = weight = 0
        for words, old in runs(text, self.longest):
            nodes = self.walk(words, old)
            features, n_words, weight = features + len(nodes), n_words + len(words) - old, weight + sum(map(self.gain.__getitem__, nodes))
            if self.full():
                self.clear()
        return features, n_words, weight


def _texts(column: pa.Array) -> Iterator[bytes]:
    raw, at = flat(column)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        yield raw[a:b].tobytes()


def bucket_totals(texts: DataFrame, buckets: int, longest: int) -> np.ndarray:
    """How many features of the texts (one column) fall in each bucket."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(buckets, longest)
        for batch in batches:
            for text in _texts(batch.column(0)):
                trie.count(text)
        trie.settle()
        at = np.flatnonzero(trie.totals)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(trie.totals[at])], ["bucket", "n"])

    found = texts.mapInArrow(task, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(buckets, np.int64)
    out[found["bucket"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=np.int64)
    return out


def bucket_gains(of_docs: np.ndarray, of_target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of each bucket, in doubles."""
    n = len(of_docs)
    docs, target = float(of_docs.sum()) + n, float(of_target.sum()) + n
    return np.asarray([math.floor(1000 * math.log((t + 1.0) * docs / ((s + 1.0) * target))) for s, t in zip(of_docs.tolist(), of_target.tolist(), strict=True)], np.int64)


def noise(seed: str, doc_id: int | None) -> int:
    """Gumbel noise in thousandths, the same for a seed and a doc_id whatever the table."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(spark: SparkSession, docs: DataFrame, gains: np.ndarray, longest: int, seed: str) -> DataFrame:
    """doc_id, n_features, n_words, weight and score of each document."""
    shared = spark.sparkContext.broadcast(gains)
    names = ["doc_id", "n_features", "n_words", "weight", "score"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(len(shared.value), longest, shared.value)
        for batch in batches:
            ids, facts = batch.column(0), [trie.weigh(text) for text in _texts(batch.column(1))]
            score = [f[2] + noise(seed, i) for i, f in zip(ids.to_pylist(), facts, strict=True)]
            yield pa.RecordBatch.from_arrays([ids, *(pa.array([f[k] for f in facts], pa.int64()) for k in range(3)), pa.array(score, pa.int64())], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(task, ", ".join(f"{n} long" for n in names))


def resample(spark: SparkSession, docs: DataFrame, target: DataFrame, percent: int = 10, buckets: int = 10_000, longest: int = 1, least_words: int = 20, seed: str = "2024") -> DataFrame:
    """One row a document: doc_id, n_features, weight, score, rank (of drawn ones, from 1; else null). ``target`` has a column text."""
    gains = bucket_gains(*(bucket_totals(x.select(F.col("text").cast("string").alias("text")), buckets, longest) for x in (docs, target)))
    rows = stored(spark, scored(spark, docs, gains, longest, seed), "scores")
    able = F.col("n_words") >= least_words
    n = rows.filter(able).count()
    # the last column only spreads rows that agree in all others over ranges
    order = [F.when(able, 0).otherwise(1), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_salt")]
    ranked = row_numbers(spark, rows.withColumn("_salt", F.monotonically_increasing_id()), order, "_place")
    return ranked.select("doc_id", "n_features", "weight", "score", F.when(F.col("_place") < percent * n // 100, F.col("_place") + 1).alias("rank"))


def resample_sql(percent: int = 10, buckets: int = 10_000, least_words: int = 20, seed: str = "2024") -> str:
    """The same in DuckDB for single words: CRC-32 of each distinct word, folded over its bytes."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)::BIGINT[]), lambda c, _k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256))::BIGINT AS i))),
worded AS (SELECT doc_id, {words} AS ws FROM documents),
mine AS (SELECT word, count(*) AS n FROM (SELECT unnest(ws) AS word FROM worded) GROUP BY word),
theirs AS (SELECT word, count(*) AS n FROM (SELECT unnest({words}) AS word FROM benchmark) GROUP BY word),
hexed AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM mine UNION SELECT word FROM theirs)),
placed AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, (2 * i + 1)::INT, 2))::BIGINT)),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) % {buckets} AS bucket FROM hexed, crc_table),
totals AS (SELECT bucket, sum(coalesce(m.n, 0))::DOUBLE AS s, sum(coalesce(o.n, 0))::DOUBLE AS t FROM placed p LEFT JOIN mine m ON m.word = p.word LEFT JOIN theirs o ON o.word = p.word GROUP BY bucket),
gains AS (SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + {buckets}) / ((s + 1) * (sum(t) OVER () + {buckets}))))::BIGINT AS gain FROM totals),
weights AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM (SELECT doc_id, unnest(ws) AS word FROM worded) JOIN placed USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT d.doc_id::BIGINT AS doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight, len(ws) >= {least_words} AS able,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{seed}:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
  FROM worded d LEFT JOIN weights w ON w.doc_id = d.doc_id)
SELECT doc_id, n_features, weight, score,
  CASE WHEN able AND row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) <= {percent} * count(*) FILTER (able) OVER () // 100 THEN row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) END::BIGINT AS rank
FROM scored"""
