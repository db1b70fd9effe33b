"""Near-duplicate classes by one-permutation MinHash, banded buckets and star-shaped candidate edges.

A document's set are its distinct runs of ``words`` words, as in ``jaccard_join``. Documents with equal sets are one set from the
first step on. Then:

1. Sketch. One hash deals a set's shingles into ``BINS`` bins, the least of each bin is the bin's value. An empty bin takes the value
   of the first bin in its own random order of bins that isn't empty (optimal densification, drawn without replacement), so
   any two bins of two sets agree with the sets' similarity as probability, however small the sets are.
2. Buckets. ``BANDS`` bands of ``ROWS`` bins each: sets that agree in a whole band share a bucket. Two sets of similarity 0.8
   share none with probability (1 - 0.8**6)**48, 5 in 10 million; of similarity 0.9, 2 in 10**16.
3. Stars. Each set of a bucket is a candidate of the bucket's leader (the set with most copies) only: at most ``BANDS`` candidates a set,
   whatever a bucket's size. Sizes and parity bits of whole sets (a bound, not an estimate) drop what can't link, what is left is
   confirmed on full sets. Confirmed edges give classes so far.
4. The rest. A bucket whose sets are in one class is settled: no link inside it could change anything. The sets of the other
   buckets, where a link between two sets that don't link to the leader may be missing, go through the exact token-group join
   of ``jaccard_join``, with the classes as its groups, and its links are added. It makes no pairs of all sets of a
   bucket: two sets meet only over a rare shingle among their first ones.

Full sets are written once for the sets that share a bucket with another one, picked by a Bloom filter of fixed size while texts are read
a second time; nothing else reads texts. Nothing but counts, the most frequent shingles and that filter reaches the driver.

Edge cases: texts that are null, empty or white space have no shingle and link with nothing; repeated rows and equal doc_ids with
different texts are separate documents; rows with a null doc_id take part, and a class of such rows alone has a null id and
keeps them; documents of any length are used whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, drop_stored, row_key, stored
from .components import components
from .jaccard_join import BITS, Join, _bloom, _compare, _digest, _long, _parity, _wanted, first_tokens, frequent, jaccard_sql, sets
from .words import U, mix

BANDS, ROWS = 48, 6
BINS = BANDS * ROWS
#: Bins that an empty bin looks at before it is cheaper to look at the full ones.
LOOKS = 24
_rng = np.random.default_rng(48)
#: Each bin's order of the others, and the place of each bin in it.
ORDER = np.argsort(_rng.random((BINS, BINS)), axis=1).astype(np.int32)
PLACE = np.argsort(ORDER, axis=1).astype(np.int32)
_BAND = mix(np.arange(1, BANDS + 1, dtype=U))
NONE = U(0xFFFFFFFFFFFFFFFF)


def sketch(found: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The bins of each slice of shingle hashes, densified; slices without shingles have ``NONE`` in all."""
    rows = len(offsets) - 1
    hashed = mix(found ^ U(0x6A09E667F3BCC908))
    slot = np.repeat(np.arange(rows), np.diff(offsets)) * BINS + ((hashed >> U(32)) * U(BINS) >> U(32)).astype(np.int64)
    flat = np.full(rows * BINS, NONE, U)
    np.minimum.at(flat, slot, mix(hashed))
    bins = flat.reshape(rows, BINS)
    full = np.zeros(rows * BINS, bool)
    full[slot] = True
    full = full.reshape(rows, BINS)
    row, bin_ = np.nonzero(~full & full.any(axis=1)[:, None])
    out = bins.copy()
    for look in range(LOOKS):
        at = ORDER[bin_, look]
        hit = full[row, at]
        out[row[hit], bin_[hit]] = bins[row[hit], at[hit]]
        row, bin_ = row[~hit], bin_[~hit]
    for r, begin, end in zip(*_slices(row), strict=True):
        have = np.flatnonzero(full[r])
        empty = bin_[begin:end]
        out[r, empty] = bins[r, have[PLACE[empty[:, None], have].argmin(axis=1)]]
    return out


def _slices(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Value, begin and end of runs of an ascending array."""
    found, begin = np.unique(values, return_index=True)
    return found, begin, np.append(begin, len(values))[1:]


def bands(found: np.ndarray, offsets: np.ndarray, at_once: int = 1000) -> np.ndarray:
    """The bucket of each slice in each band."""
    rows = len(offsets) - 1
    out = np.zeros((rows, BANDS), U)
    for a in range(0, rows, at_once):
        b = min(rows, a + at_once)
        at = offsets[a : b + 1]
        bins = sketch(found[at[0] : at[-1]], at - at[0]).reshape(b - a, BANDS, ROWS)
        total = np.broadcast_to(_BAND, (b - a, BANDS)).copy()
        for i in range(ROWS):
            total = mix(total ^ bins[:, :, i]) + U(i)
        out[a:b] = total
    return out


def _describe(k: int):
    names = ["kind", "doc_id", "n", "d1", "d2", "bands", *BITS, "th"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            ids, hashes = batch.column(0), batch.column(2)
            for first_row, rows, found, at in sets(batch.column(1), k):
                d1, d2 = _digest(found, at)
                keys = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * BANDS), _long(bands(found, at).reshape(-1)))
                bits = [_long(np.ascontiguousarray(b)) for b in _parity(found, at).T]
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(rows, np.int8)), ids.slice(first_row, rows), pa.array(np.diff(at)), _long(d1), _long(d2), keys, *bits, hashes.slice(first_row, rows)], names)
                token, n = np.unique(found, return_counts=True)
                seen.append((token[n > 1], n[n > 1]))
        for token, n in frequent(seen):
            none = pa.nulls(len(token), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(token), np.int8)), none, pa.array(n), _long(token), none, pa.nulls(len(token), pa.list_(pa.int64())), *[none] * (len(BITS) + 1)], names)

    return task, "kind byte, doc_id long, n long, d1 long, d2 long, bands array<long>, " + ", ".join(f"{b} long" for b in BITS) + ", th long"


def _first(percent: int, order):
    """The first tokens of whole sets (rid, tokens)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = []
            for raw in batch.column(1).to_pylist():
                found = np.frombuffer(raw, U)
                ranked = found[np.lexsort((mix(found ^ U(0xBB67AE8584CAA73B)), order.value.levels(found)))]
                first.append(ranked[: first_tokens(len(found), percent)].view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(first, pa.list_(pa.int64()))], ["rid", "first"])

    return task, "rid long, first array<long>"


class NearJoin(Join):
    """As ``Join``, from sketches: ``members`` are the sets of buckets with more than one, ``tokens`` their whole sets."""

    def __init__(self, spark: SparkSession, docs: DataFrame, words: int, percent: int):
        self.spark, self.k, self.percent, self.kept = spark, words, percent, []
        self.texts = docs.select(F.col("text").cast("string").alias("text"))
        doc_id, th = row_key()
        self.facts = stored(spark, docs.select(doc_id, F.col("text").cast("string").alias("text"), th).mapInArrow(*_describe(words)), "facts", self.kept)
        self.docs = self.facts.filter("kind = 0").select("doc_id", "th", "n", "d1", "d2")
        distinct = self.facts.filter("kind = 0 and n > 0").groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in ("n", *BITS, "bands")])
        self.sets = stored(spark, distinct.withColumn("rid", F.monotonically_increasing_id()), "sets", self.kept)
        keyed = self.sets.select("rid", "n", "copies", F.explode("bands").alias("bucket"))
        lead = keyed.groupBy("bucket").agg(F.max(F.struct("copies", "rid", "n")).alias("lead"), F.count(F.lit(1)).alias("size")).filter("size > 1")
        # written first: then both sides of the join are plain shuffles, and a part that is full of one bucket can be split
        lead = checkpointed(spark, lead.select("bucket", F.col("lead.rid").alias("a"), F.col("lead.n").alias("an")))
        self.members = stored(spark, keyed.select("rid", "n", "bucket").join(lead, "bucket"), "members", self.kept)
        keys = checkpointed(spark, self.sets.select("rid", "d1", "d2").join(self.members.select("rid").distinct(), "rid"))
        tokens = self.texts.mapInArrow(*_wanted(words, _bloom(spark, keys))).join(keys, ["d1", "d2"]).groupBy("rid").agg(F.first("tokens").alias("tokens"))
        self.tokens = stored(spark, tokens, "tokens", self.kept)

    def verified(self, pairs: DataFrame, name: str) -> DataFrame:
        pairs = stored(self.spark, pairs, f"{name}-pairs", self.kept)
        left, right = (self.tokens.select(F.col("rid").alias(side), F.col("tokens").alias(column)) for side, column in (("a", "x"), ("b", "y")))
        return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(*_compare(self.percent))

    def star_pairs(self) -> DataFrame:
        pairs = self.members.filter((F.col("a") != F.col("rid")) & self.near("an", "n")).select("a", F.col("rid").alias("b")).distinct()
        known = lambda side: self.sets.select(F.col("rid").alias(side), F.col("n").alias(f"{side}n"), *[F.col(b).alias(f"{side}{b}") for b in BITS])
        both = pairs.join(known("a"), "a").join(known("b"), "b")
        return both.filter(self.apart("a", "b") <= self.allowed(F.col("an"), F.col("bn"))).select("a", "b")

    def open_sets(self, groups: DataFrame) -> DataFrame:
        """rid of the sets of buckets that have more than one class."""
        classed = self.members.select("bucket", "rid").join(groups.withColumnRenamed("node", "rid"), "rid", "left").select("bucket", "rid", F.coalesce("root", "rid").alias("root"))
        classed = checkpointed(self.spark, classed)
        several = classed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("bucket")
        return checkpointed(self.spark, classed.join(checkpointed(self.spark, several), "bucket", "left_semi").select("rid").distinct())

    def first_tokens(self, open_: DataFrame) -> DataFrame:
        return self.tokens.join(open_, "rid", "left_semi").select("rid", "tokens").mapInArrow(*_first(self.percent, self.order()))

    def placed(self) -> DataFrame:
        stars = checkpointed(self.spark, self.verified(self.star_pairs(), "star"))
        groups = checkpointed(self.spark, components(self.spark, stars))
        rest = self.verified(self.matrix_pairs(groups, self.first_tokens(self.open_sets(groups))), "rest")
        return self.rooted(stars.unionByName(rest))


def near_copies(spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id (smallest doc_id of its class), kept (it is that document)."""
    classes = NearJoin(spark, docs, words, percent).classes()
    return classes.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def near_copies_sql(words: int = 4, percent: int = 80) -> str:
    """The same classes in DuckDB, by counting shared shingles of all pairs."""
    return f"SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM ({jaccard_sql(words, percent)})"
