"""Exact Jaccard join of documents on word shingles, by a token-group matrix, down to connected classes.

A document's set are its distinct runs of ``words`` words (lower case A-Z, words between ASCII white space; fewer words:
the whole sequence). Two documents link when 100 * intersection >= percent * union. All work is on distinct sets:

1. Sets. One pass gives each document a digest of its set, three min-hashes and the frequent shingles of its partition;
   documents of equal digest are one set from here on.
2. Groups. Sets with an equal min-hash are probably alike. Each set is compared with one leader of each of its three
   groups (the set with most copies), exactly, and what links forms a group: a star, not all pairs.
3. Token-group matrix. Shingles are ordered from rare to frequent; two sets that link must share one of the first
   n - ceil(percent * n / 100) + 1 of each, and as many of them as ``common`` says for their sizes. A group's tokens are the
   union of its members' first tokens. Tokens of one group alone are dropped (a family of copies is one group, so its tokens
   cost nothing). If c tokens are common to two sets, the rarest of these has c - 1 common ones behind it in both; so a set
   probes a group with a token only if enough of its tokens, and of some member's, are behind it, for the sizes that the group
   has. Groups without such a token stay closed.
4. Members of open groups are bounded in the same way, by parity bits of both whole sets (which differ in no more places
   than the sets have shingles apart), then by all first tokens in common, and what is left is compared exactly. Links of both rounds together give the classes.

The order of shingles comes from at most ``FREQUENT`` frequent shingles, which are sent to all tasks; it decides speed only,
any order gives the same links. Whole shingle sets are moved only for sets that are compared: a Bloom filter of fixed size
picks them while texts are read. No group of copies is ever gathered in a task and nothing but counts reaches the driver.
Shingles are told apart by 64-bit hashes (``words``): two different ones agree by chance, about once in 2**64 pairs, but none do
by their structure, so what is called exact here is so up to that chance.

Edge cases: texts that are null, empty or white space have no shingle and link with nothing; repeated rows and equal
doc_ids with different texts are separate documents; rows with a null doc_id take part, and a class of such rows alone
has a null id; documents of any length are used whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import checkpointed, drop_stored, marked, row_key, stored
from .components import components
from .words import LOWER, SPACE, U, blocks, grams, mix, words

FREQUENT = 100_000
SEEDS = (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179, 0x3C6EF372FE94F82B)
BLOOM_BITS = 1 << 25
HELD = 100_000
PARITY = 512
GONE, ONCE = 1, 2
BITS = [f"b{i}" for i in range(PARITY // 64)]


def sets(column: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, shingles, offsets): distinct shingle hashes of each text, ascending."""
    for first_row, rows, raw, at in blocks(column):
        hashes, _, _, first = words(raw, at, SPACE, LOWER)
        found, start = grams(hashes, first, k)
        doc = np.repeat(np.arange(rows), np.diff(start))
        count = np.diff(first)
        for size in np.unique(count[(count > 0) & (count < k)]).tolist():
            short = np.flatnonzero(count == size)
            total = np.zeros(len(short), U)
            for j in range(size):
                total = total * U(0xD6E8FEB86659FD93) + hashes[first[short] + j]
            found, doc = np.concatenate([found, mix(total + U(size))]), np.concatenate([doc, short])
        order = np.lexsort((found, doc))
        found, doc = found[order], doc[order]
        new = np.ones(len(found), bool)
        new[1:] = (found[1:] != found[:-1]) | (doc[1:] != doc[:-1])
        found, doc = found[new], doc[new]
        yield first_row, rows, found, np.searchsorted(doc, np.arange(rows + 1))


def _reduce(ufunc: np.ufunc, values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """ufunc over each slice, 0 for empty ones."""
    out = np.zeros(len(offsets) - 1, U)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        out[full] = ufunc.reduceat(values, offsets[full])
    return out


def _digest(found: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _reduce(np.add, mix(found ^ U(0x9B05688C2B3E6C1F)), offsets), _reduce(np.add, mix(found ^ U(0x510E527FADE682D1)), offsets)


def _parity(found: np.ndarray, offsets: np.ndarray, at_once: int = 2000) -> np.ndarray:
    """For each slice, ``PARITY`` bits: whether an odd number of its shingles falls in each of as many classes."""
    rows = len(offsets) - 1
    out = np.zeros((rows, PARITY // 64), U)
    kind = (mix(found ^ U(0x71374491428A2F98)) % U(PARITY)).astype(np.int64)
    for a in range(0, rows, at_once):
        b = min(rows, a + at_once)
        doc = np.repeat(np.arange(b - a), np.diff(offsets[a : b + 1]))
        odd = np.bincount(doc * PARITY + kind[offsets[a] : offsets[b]], minlength=(b - a) * PARITY) & 1
        out[a:b] = np.packbits(odd.astype(np.uint8).reshape(b - a, PARITY), axis=1, bitorder="little").view("<u8")
    return out


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def frequent(seen: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of shingles and their counts in blocks of texts: those with a sum above 2, in parts."""
    if seen:
        token, place = np.unique(np.concatenate([t for t, _ in seen]), return_inverse=True)
        n = np.bincount(place, np.concatenate([c for _, c in seen]), len(token)).astype(np.int64)
        token, n = token[n > 2], n[n > 2]
        for i in range(0, len(token), 10_000):
            yield token[i : i + 10_000], n[i : i + 10_000]


def _describe(k: int):
    names = ["kind", "doc_id", "n", "d1", "d2", "m1", "m2", "m3", *BITS, "th"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            ids, hashes = batch.column(0), batch.column(2)
            for first_row, rows, found, at in sets(batch.column(1), k):
                d1, d2 = _digest(found, at)
                mins = [_long(_reduce(np.minimum, mix(found ^ U(s)), at)) for s in SEEDS]
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(rows, np.int8)), ids.slice(first_row, rows), pa.array(np.diff(at)), _long(d1), _long(d2), *mins, *(_long(np.ascontiguousarray(b)) for b in _parity(found, at).T), hashes.slice(first_row, rows)], names)
                token, n = np.unique(found, return_counts=True)
                seen.append((token[n > 1], n[n > 1]))
        for token, n in frequent(seen):
            none = pa.nulls(len(token), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(token), np.int8)), none, pa.array(n), _long(token), *[none] * (5 + len(BITS))], names)

    return task, "kind byte, doc_id long, n long, d1 long, d2 long, m1 long, m2 long, m3 long, " + ", ".join(f"{b} long" for b in BITS) + ", th long"


class Order:
    """Rare before frequent, then by hash; the same for all sets."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        order = np.argsort(tokens)
        self.tokens, self.level = tokens[order], (np.log2(counts[order].astype(float)) + 1).astype(np.uint8)
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[self.tokens >> U(42)] = True

    def levels(self, found: np.ndarray) -> np.ndarray:
        out = np.zeros(len(found), np.uint8)
        at = np.flatnonzero(self.maybe[found >> U(42)])
        if len(at):
            i = np.minimum(np.searchsorted(self.tokens, found[at]), len(self.tokens) - 1)
            same = self.tokens[i] == found[at]
            out[at[same]] = self.level[i[same]]
        return out


class Bloom:
    """Digests that are wanted; may say yes too often, never no."""

    def __init__(self, digests: np.ndarray):
        self.bits = np.zeros(BLOOM_BITS >> 3, np.uint8)
        for place in self.places(digests):
            place = np.unique(place)
            byte = place >> 3
            first = np.flatnonzero(np.diff(byte, prepend=-1))
            if len(first):
                self.bits[byte[first]] |= np.bitwise_or.reduceat(np.uint8(128) >> (place & 7).astype(np.uint8), first)

    @staticmethod
    def places(digests: np.ndarray) -> list[np.ndarray]:
        return [(mix(digests ^ U(s)) % U(BLOOM_BITS)).astype(np.int64) for s in SEEDS]

    def holds(self, digests: np.ndarray) -> np.ndarray:
        hit = np.ones(len(digests), bool)
        for place in self.places(digests):
            hit &= (self.bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1).astype(bool)
        return hit


def _bloom(spark: SparkSession, wanted: DataFrame):
    """Filter of the digests d1, made in the tasks and combined by OR: what reaches the driver has the filter's size."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch.column(0).to_numpy(zero_copy_only=False).view(U) for batch in batches if batch.num_rows]
        if held:
            bits = Bloom(np.concatenate(held)).bits
            for i in range(0, len(bits), 1 << 16):
                if bits[i : i + (1 << 16)].any():
                    words_ = np.flatnonzero(part := bits[i : i + (1 << 16)].view(np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(words_ + (i >> 3)), pa.array(part[words_])], ["place", "bits"])

    rows = wanted.select("d1").mapInArrow(build, "place long, bits long").groupBy("place").agg(F.expr("bit_or(bits)").alias("bits")).toPandas()
    filter_ = Bloom(np.zeros(0, U))
    merged = filter_.bits.view(np.int64).copy()
    merged[rows["place"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64)
    filter_.bits = merged.view(np.uint8)
    return spark.sparkContext.broadcast(filter_)


def first_tokens(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _prefixes(k: int, percent: int, order):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        o = order.value
        for batch in batches:
            for _, rows, found, at in sets(batch.column(0), k):
                d1, d2 = _digest(found, at)
                level = o.levels(found)
                doc = np.repeat(np.arange(rows), np.diff(at))
                ranked = found[np.lexsort((mix(found ^ U(0xBB67AE8584CAA73B)), level, doc))]
                full = np.flatnonzero(np.diff(at))
                first = [ranked[at[r] : at[r] + first_tokens(int(at[r + 1] - at[r]), percent)].view(np.int64) for r in full]
                yield pa.RecordBatch.from_arrays([_long(d1[full]), _long(d2[full]), pa.array(first, pa.list_(pa.int64()))], ["d1", "d2", "first"])

    return task, "d1 long, d2 long, first array<long>"


def _wanted(k: int, bloom):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, found, at in sets(batch.column(0), k):
                d1, d2 = _digest(found, at)
                pick = np.flatnonzero(bloom.value.holds(d1) & (np.diff(at) > 0))
                if len(pick):
                    whole = [found[at[r] : at[r + 1]].tobytes() for r in pick]
                    yield pa.RecordBatch.from_arrays([_long(d1[pick]), _long(d2[pick]), pa.array(whole, pa.binary())], ["d1", "d2", "tokens"])

    return task, "d1 long, d2 long, tokens binary"


def _compare(percent: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = (batch.column(i).to_pylist() for i in range(4))
            good = []
            for i in range(len(a)):
                p, q = np.frombuffer(x[i], U), np.frombuffer(y[i], U)
                both = len(np.intersect1d(p, q, assume_unique=True))
                good.append(100 * both >= percent * (len(p) + len(q) - both))
            keep = np.flatnonzero(good)
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())], ["a", "b"])

    return task, "a long, b long"


def _several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (token, grp), those whose token is in more than one group.

    The rows of a batch's last token are held back while all of them are of one group, up to ``HELD`` rows; beyond that they
    are passed on, which costs time later and changes nothing.
    """
    held: list[pa.RecordBatch] = []
    token = grp = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t, g = batch.column(0).to_numpy(), batch.column(2).to_numpy()
        cut = np.flatnonzero(np.diff(t)) + 1
        starts = np.concatenate([[0], cut])
        ends = np.concatenate([cut, [len(t)]])
        many = g[starts] != g[ends - 1]
        goes_on = token is not None and t[0] == token
        if goes_on and (grp is None or g[0] != grp or many[0]):
            many[0] = True
            yield from held
            held, grp = [], None
        elif not goes_on:
            held = []
        keep = np.repeat(many, ends - starts)
        if not many[-1]:
            tail = batch.slice(int(starts[-1]))
            held = [*held, tail] if goes_on and len(starts) == 1 else [tail]
            token, grp = t[-1], g[-1]
            if sum(b.num_rows for b in held) > HELD:
                yield from held
                held, grp = [], None
        else:
            held, token, grp = [], t[-1], None
        if keep.any():
            yield batch.filter(pa.array(keep))


class Join:
    """State of one join: texts, distinct sets (rid, n, d1, d2, copies, min-hashes) and which document has which set."""

    def __init__(self, spark: SparkSession, docs: DataFrame, words: int, percent: int):
        self.spark, self.k, self.percent = spark, words, percent
        self.kept: list[str] = []
        self.texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        doc_id, th = row_key()
        self.facts = stored(spark, docs.select(doc_id, "text", th).mapInArrow(*_describe(words)), "facts", self.kept)
        self.docs = self.facts.filter("kind = 0").select("doc_id", "th", "n", "d1", "d2")
        distinct = self.facts.filter("kind = 0 and n > 0").groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in ("n", "m1", "m2", "m3", *BITS)])
        self.sets = stored(spark, distinct.withColumn("rid", F.monotonically_increasing_id()), "sets", self.kept)

    def near(self, n: str, m: str):
        """Sizes that allow a link."""
        return (F.least(n, m) * 100 >= F.greatest(n, m) * self.percent)

    def verified(self, pairs: DataFrame, name: str) -> DataFrame:
        """Those of the pairs (a, b) of set ids that link."""
        pairs = stored(self.spark, pairs, f"{name}-pairs", self.kept)
        ids = pairs.select(F.col("a").alias("rid")).unionByName(pairs.select(F.col("b").alias("rid"))).distinct()
        keys = checkpointed(self.spark, self.sets.select("rid", "d1", "d2").join(ids, "rid"))
        tokens = self.texts.select("text").mapInArrow(*_wanted(self.k, _bloom(self.spark, keys)))
        tokens = tokens.join(keys, ["d1", "d2"]).groupBy("rid").agg(F.first("tokens").alias("tokens"))
        tokens = stored(self.spark, tokens, f"{name}-tokens", self.kept)
        left = tokens.select(F.col("rid").alias("a"), F.col("tokens").alias("x"))
        right = tokens.select(F.col("rid").alias("b"), F.col("tokens").alias("y"))
        return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(*_compare(self.percent))

    def star_pairs(self) -> DataFrame:
        keyed = self.sets.select("rid", "n", "copies", F.expr("stack(3, 1, m1, 2, m2, 3, m3) as (i, m)"))
        lead = keyed.groupBy("i", "m").agg(F.max(F.struct("copies", "rid", "n")).alias("lead"), F.count(F.lit(1)).alias("size")).filter("size > 1")
        # written first: then both sides of the join are plain shuffles, and a part that is full of one min-hash can be split
        lead = checkpointed(self.spark, lead.select("i", "m", F.col("lead.rid").alias("a"), F.col("lead.n").alias("an")))
        return keyed.join(lead, ["i", "m"]).filter((F.col("a") != F.col("rid")) & self.near("an", "n")).select("a", F.col("rid").alias("b")).distinct()

    def order(self):
        often = self.facts.filter("kind = 1").groupBy("d1").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "d1").limit(FREQUENT).toPandas()
        return self.spark.sparkContext.broadcast(Order(often["d1"].to_numpy(dtype=np.int64).view(U), often["n"].to_numpy(dtype=np.int64)))

    def first_tokens(self) -> DataFrame:
        """rid and first tokens of all sets."""
        first = self.texts.select("text").mapInArrow(*_prefixes(self.k, self.percent, self.order()))
        first = first.groupBy("d1", "d2").agg(F.first("first").alias("first"))
        return first.join(self.sets.select("rid", "d1", "d2"), ["d1", "d2"]).select("rid", "first")

    def matrix_pairs(self, groups: DataFrame, first: DataFrame) -> DataFrame:
        """Pairs of sets (rid, first) of different groups that the token-group matrix leaves open."""
        known = first.join(groups.withColumnRenamed("node", "rid"), "rid", "left").withColumn("grp", F.coalesce("root", "rid"))
        tokens = known.select(F.explode("first").alias("token"), "rid", "grp")
        shared = tokens.repartition("token").sortWithinPartitions("token", "grp").mapInArrow(_several, "token long, rid long, grp long")
        shared = checkpointed(self.spark, shared)
        facts = shared.groupBy("rid").agg(F.count(F.lit(1)).alias("m")).join(self.sets.select("rid", "n", *BITS), "rid")
        often = checkpointed(self.spark, shared.groupBy("token").agg(F.count(F.lit(1)).alias("df")))
        ranked = shared.join(often, "token").withColumn("rank", F.row_number().over(W.partitionBy("rid").orderBy("df", "token")))
        shared = stored(self.spark, ranked.join(facts, "rid"), "shared", self.kept)
        # rows of the matrix: tokens of a group, with the extremes of the members that hold them
        matrix = shared.groupBy("token", F.col("grp").alias("g")).agg(F.min("n").alias("low"), F.max("n").alias("high"), F.min(F.col("rank") - F.col("m")).alias("front"), F.max("rid").alias("last"))
        p = self.percent
        smallest, largest = F.greatest("low", F.expr(f"cast(ceil({p} * n / 100) as bigint)")), F.least("high", F.expr(f"cast(floor(100 * n / {p}) as bigint)"))
        least = F.greatest(self.common(F.col("n"), smallest, largest), F.lit(1))
        # of two sets the one with the smaller id probes, so a group needs a member with a larger one
        fits = (F.col("grp") != F.col("g")) & (F.col("rid") < F.col("last")) & (smallest <= largest) & (F.col("rank") - F.col("m") <= 1 - least) & (F.col("front") <= 1 - least)
        open_ = shared.alias("s").join(matrix, (F.col("s.token") == matrix["token"]) & fits)
        open_ = open_.select("s.token", F.col("rid").alias("q"), "g", F.col("n").alias("qn"), (F.col("rank") - F.col("m")).alias("qfront"), *[F.col(b).alias(f"q{b}") for b in BITS])
        y, x = shared.alias("y"), open_.alias("x")
        least = F.greatest(self.common(F.col("qn"), F.col("n"), F.col("n")), F.lit(1))
        # the rarest common token opens the way from both sides, so one of them will do
        meets = (F.col("x.token") == F.col("y.token")) & (F.col("x.g") == F.col("y.grp")) & (F.col("q") < F.col("rid")) & self.near("qn", "n") & (F.col("qfront") <= 1 - least) & (F.col("rank") - F.col("m") <= 1 - least) & (self.apart("q", "") <= self.allowed(F.col("qn"), F.col("n")))
        pairs = x.join(y, meets).select(F.col("q").alias("a"), F.col("rid").alias("b")).distinct()
        # all common first tokens of a pair, from the few that others share at all
        lists = checkpointed(self.spark, shared.groupBy("rid", "n").agg(F.collect_list("token").alias("tokens")))
        for side in ("a", "b"):
            pairs = pairs.join(lists.select(F.col("rid").alias(side), F.col("n").alias(f"{side}n"), F.col("tokens").alias(f"{side}t")), side)
        both = F.size(F.array_intersect("at", "bt"))
        return pairs.filter(both >= F.ceil((F.col("an") + F.col("bn")) * p / (100 + p)) - self.rest_of(F.col("an"), F.col("bn"))).select("a", "b")

    @staticmethod
    def apart(left: str, right: str) -> Column:
        """In how many classes the parities of two sets differ: shingles that only one has change that of at most as many."""
        return sum((F.bit_count(F.col(f"{left}{b}").bitwiseXOR(F.col(f"{right}{b}"))) for b in BITS), F.lit(0))

    def allowed(self, n: Column, m: Column) -> Column:
        """Shingles that only one of two sets has, at most, if they link."""
        return n + m - 2 * F.ceil((n + m) * self.percent / (100 + self.percent))

    def rest_of(self, n: Column, high: Column) -> Column:
        """The larger number of tokens after the first ones."""
        return F.greatest(F.ceil(n * self.percent / 100), F.ceil(high * self.percent / 100)).cast("long") - 1

    def common(self, n: Column, low: Column, high: Column) -> Column:
        """First tokens that a set of n tokens shares at least with any set of ``low`` to ``high`` tokens that it links with.

        A link has ceil(percent * (n + m) / (100 + percent)) tokens in common. The set whose first tokens end earlier has
        only its rest besides, so the rest of one of the two and the shared first tokens must be as many.
        """
        p = self.percent
        return F.ceil((n + low) * p / (100 + p)).cast("long") - self.rest_of(n, high)

    def placed(self) -> DataFrame:
        """doc_id, th, n and root (null without shingles) of each document."""
        stars = checkpointed(self.spark, self.verified(self.star_pairs(), "star"))
        groups = checkpointed(self.spark, components(self.spark, stars))
        return self.rooted(stars.unionByName(self.verified(self.matrix_pairs(groups, self.first_tokens()), "matrix")))

    def rooted(self, links: DataFrame) -> DataFrame:
        """``placed`` from the links of sets."""
        roots = components(self.spark, links)
        ids = self.sets.select("rid", "d1", "d2").join(roots.withColumnRenamed("node", "rid"), "rid", "left").select("d1", "d2", F.coalesce("root", "rid").alias("root"))
        placed = self.docs.join(ids, ["d1", "d2"], "left")
        placed = stored(self.spark, placed.select("doc_id", "th", "n", F.when(F.col("n") > 0, F.col("root")).alias("root")), "placed")
        drop_stored(self.spark, self.kept)  # what follows reads ``placed`` only
        return placed

    def classes(self) -> DataFrame:
        """doc_id, n_shingles, component_id."""
        placed = self.placed()
        least = checkpointed(self.spark, placed.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("class_size")))
        out = placed.join(least, "root", "left")
        return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"))


def jaccard_classes(spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id (smallest doc_id of its class), class_size."""
    return Join(spark, docs, words, percent).classes()


def keep_one(spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each class, whole as it came: that of the smallest doc_id (null last), then of the smallest text hash.

    Decisions go back by doc_id and text hash, so rows that share a doc_id or have none are judged each by its own text. Of
    rows that agree in both, the one whose columns hash smallest stays. Rows without words are in no class and all stay.
    """
    placed = Join(spark, docs, words, percent).placed()
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    keys = checkpointed(spark, placed.filter("root is not null").groupBy("root", "doc_id", "th").agg(F.count(F.lit(1)).alias("copies")))
    # written first: then both sides of the join are plain shuffles, and a part that is full of one class can be split
    first = checkpointed(spark, keys.groupBy("root").agg(F.min(key).alias("first")))
    judged = keys.join(first, "root").withColumn("mark", F.when(~key.eqNullSafe(F.col("first")), GONE).when(F.col("copies") > 1, ONCE))
    judged = checkpointed(spark, judged.filter("mark is not null").select("doc_id", "th", "mark"))
    rows, mark, names = marked(docs, judged)
    stay = rows.filter(F.col(mark).isNull()).select(docs.columns)
    if judged.filter(F.col("mark") == ONCE).limit(1).count() == 0:
        return stay
    repeated = rows.filter(F.col(mark) == ONCE).select(*names, F.struct(*docs.columns).alias("row"))
    one = repeated.groupBy(*names).agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return stay.unionByName(one.select("row.*"))


def jaccard_sql(words: int = 4, percent: int = 85) -> str:
    """The same classes in DuckDB, by counting shared shingles of all pairs."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingled AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {words} + 2), lambda i: array_to_string(w[i:i + {words - 1}], ' ')) END) AS s FROM worded),
sizes AS (SELECT doc_id, len(s)::BIGINT AS n FROM shingled),
exploded AS (SELECT doc_id, unnest(s) AS t FROM shingled),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM exploded a JOIN exploded b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
sym AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sizes UNION SELECT r.a, e.b FROM reach r JOIN sym e ON e.a = r.b),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, n AS n_shingles, component_id, count(*) OVER (PARTITION BY component_id) AS class_size FROM sizes JOIN least USING (doc_id)"""
