"""Benchmark decontamination: rare n-gram seeds join passages to test items, Smith-Waterman alignment scores them.

Words are runs of letters and digits in lower case. Seeds are the 3-word runs of an item. A first pass over all documents
counts in how many each seed occurs; an item keeps the rarer half of its seeds (eight at least), those of the other half
that are about as rare as its median, so that an item which leaked into thousands of documents still has seeds, and the two
rarest of each ``STRETCH`` seeds in a row, so that any 9 words in a row have two, also of a part that leaked more often than
the rest. A second pass finds seed hits, groups hits of an item that lie within
one item length of each other, and aligns the item with the passage around each group by Smith and Waterman's local
alignment over words (match 2, mismatch -1, gap -1). The score is the best alignment over that of the item with itself;
edited, reordered or interrupted copies lose what their edits cost. Pairs with ``THRESHOLD`` or more over at
least ``LEAST_WORDS`` words are returned, and pairs whose alignment scores as much as ``EXCERPT_WORDS`` words copied without
an edit, however long the item is: an excerpt of a long item is a leak although most of the item is missing. Items of fewer
than ``LEAST_WORDS`` words are found by their whole sequence of words, without an edit.

The join is of a stated query set, the benchmark, against all rows. A benchmark of at most ``BLOCK_BYTES`` of text is sent to the tasks:
two readings of the corpus, and no document leaves its task. A larger one is joined by shuffle (``SeedJoin``), in three readings
however large it is: seeds of documents and items meet by their hash, counted first, then those that are rare; what has hits enough is
aligned where the document's words meet the item's. Bloom filters of fixed size keep documents' other seeds from the shuffle; they never
decide. Both ways give the same rows.

Edge cases: null or empty texts and items, and items without letters and digits, match nothing; all texts of an item_id are
searched, also those of items without one, and the best match of an id (null is one too) is reported for each document;
documents of any length are searched whole; repeated rows are reported each; empty tables give no rows; other columns,
whatever their names, are ignored here and come back as they are from ``keep_clean``, which lets documents pass whose matches
are all shorter than ``LEAST_WORDS`` words: so short a sequence is in many texts by chance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import checkpointed, drop_stored, row_key, stored, without
from .jaccard_join import _bloom
from .words import NOT_ALNUM, blocks, grams, words

SEED_WORDS = 3
LEAST_SEEDS = 8
LEAST_HITS = 2
LEAST_WORDS = 8
THRESHOLD = 0.4
EXCERPT_WORDS = 20
STRETCH = 4
MATCH, MISMATCH, GAP = 2, 1, 1
BLOCK_BYTES = 16 << 20

SCHEMA = "doc_id long, item_id long, score double, n_hits int, begin_word int, end_word int, aligned_words int"


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: score, and first and last + 1 word of the passage in it."""
    n = len(passage)
    j = np.arange(n + 1) * GAP
    row, start = np.zeros(n + 1, np.int64), np.arange(n + 1)
    best = (0, 0, 0)
    for w in item:
        step = np.where(passage == w, MATCH, -MISMATCH)
        diagonal, above = row[:-1] + step, row[1:] - GAP
        here = np.concatenate([[0], np.maximum(np.maximum(diagonal, above), 0)])
        from_ = np.concatenate([[0], np.where(diagonal >= above, start[:-1], start[1:])])
        from_ = np.where(here > 0, from_, np.arange(n + 1))
        lifted = here + j
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == top, np.arange(n + 1), 0))
        row, start = np.maximum(top - j, 0), np.where(top - j > 0, from_[source], np.arange(n + 1))
        k = int(row.argmax())
        if row[k] > best[0]:
            best = (int(row[k]), int(start[k]), k)
    return best


class Items:
    """A block of items with a look-up from seed hashes to (item, position), and one from hashes of whole short items."""

    def __init__(self, rows: list[tuple[int, str]]):
        texts = pc.utf8_lower(pa.array([t for _, t in rows], pa.large_string()))
        self.ids, self.words, seeds, item, place = [], [], [], [], []
        short: dict[int, list[tuple[int, int]]] = {}
        for first_row, n, raw, at in blocks(texts, 1 << 62):
            hashes, _, _, first = words(raw, at, NOT_ALNUM)
            found, start = grams(hashes, first, SEED_WORDS)
            for r in range(n):
                own = hashes[first[r] : first[r + 1]]
                if not len(own):
                    continue
                if len(own) < LEAST_WORDS:
                    short.setdefault(len(own), []).append((int(grams(own, np.asarray([0, len(own)]), len(own))[0][0]), len(self.ids)))
                else:
                    seeds.append(found[start[r] : start[r + 1]])
                    item.append(np.full(len(seeds[-1]), len(self.ids)))
                    place.append(np.arange(len(seeds[-1])))
                self.ids.append(rows[first_row + r][0])
                self.words.append(own)
        join = lambda xs, kind: np.concatenate(xs) if xs else np.zeros(0, kind)
        self.set(join(seeds, np.uint64), join(item, np.int64), join(place, np.int64))
        self.short = {k: (np.asarray([h for h, _ in sorted(v)], np.uint64), np.asarray([i for _, i in sorted(v)])) for k, v in short.items()}

    def set(self, seeds: np.ndarray, item: np.ndarray, place: np.ndarray, bits: int = 20) -> None:
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.item, self.place = seeds[order], item[order], place[order]
        self.shift, self.maybe = np.uint64(64 - bits), np.zeros(1 << bits, bool)
        self.maybe[self.seeds >> self.shift] = True

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``hashes`` that hold a seed, and the seed's first number."""
        at = np.flatnonzero(self.maybe[hashes >> self.shift])
        if not len(at):
            return at, at
        i = np.minimum(np.searchsorted(self.seeds, hashes[at]), len(self.seeds) - 1)
        same = self.seeds[i] == hashes[at]
        return at[same], i[same]

    def short_hits(self, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """Places of words where a whole short item begins, the item's number, and its words; ``first`` as in ``words``."""
        for k, (known, item) in self.short.items():
            found, start = grams(hashes, first, k)
            if not len(found):
                continue
            low, high = np.searchsorted(known, found), np.searchsorted(known, found, "right")
            at = np.flatnonzero(high > low)
            if len(at):
                count = (high - low)[at]
                each = np.repeat(low[at] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
                doc = np.searchsorted(start, at, "right") - 1
                yield np.repeat(at - start[doc] + first[doc], count), item[each], k

    def keep_rare(self, seeds: np.ndarray, numbers: np.ndarray) -> None:
        """Drops the frequent seeds of each item; ``seeds`` are sorted and in ``numbers`` documents, all others in none."""
        df = np.zeros(len(self.seeds), np.int64)
        if len(seeds):
            i = np.minimum(np.searchsorted(seeds, self.seeds), len(seeds) - 1)
            df = np.where(seeds[i] == self.seeds, numbers[i], 0)
        order = np.lexsort((self.place, df, self.item))
        counts = np.bincount(self.item, minlength=len(self.ids))
        starts = np.cumsum(counts) - counts
        rank = np.arange(len(order)) - np.repeat(starts, counts)
        half = np.maximum(counts // 2, LEAST_SEEDS)
        middle = np.where(counts > 0, df[order][np.minimum(starts + counts // 2, max(len(order) - 1, 0))] if len(order) else 0, 0)
        keep = (rank < np.repeat(half, counts)) | (df[order] <= np.repeat(2 * middle + 8, counts))
        stretch = self.place[order] // STRETCH
        near = np.lexsort((rank, stretch, self.item[order]))
        new = np.append(True, (np.diff(stretch[near]) != 0) | (np.diff(self.item[order][near]) != 0))[: len(near)]
        begin = np.maximum.accumulate(np.where(new, np.arange(len(near)), 0))
        keep[near[np.arange(len(near)) - begin < LEAST_HITS]] = True
        kept = order[keep]
        self.set(self.seeds[kept], self.item[kept], self.place[kept])


def _documents(items: Items, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int, int]]]]:
    """(row, words, places of hits, seed numbers, short items as (item, place, words)) of texts with hits."""
    for first_row, rows, raw, at in blocks(pc.utf8_lower(column.cast(pa.large_string()).fill_null(""))):
        hashes, _, _, first = words(raw, at, NOT_ALNUM)
        found, start = grams(hashes, first, SEED_WORDS)
        places, seeds = items.hits(found)
        cut = np.searchsorted(places, start)
        short: dict[int, list[tuple[int, int, int]]] = {}
        for at_word, item, k in items.short_hits(hashes, first):
            doc = np.searchsorted(first, at_word, "right") - 1
            for d, i, w in zip(doc.tolist(), item.tolist(), (at_word - first[doc]).tolist(), strict=True):
                short.setdefault(d, []).append((i, w, k))
        for r in np.union1d(np.flatnonzero(np.diff(cut)), np.asarray(list(short), np.int64)).tolist():
            own = slice(cut[r], cut[r + 1])
            yield first_row + r, hashes[first[r] : first[r + 1]], places[own] - start[r], seeds[own], short.get(r, [])


def _matches(items: Items, text: np.ndarray, places: np.ndarray, seeds: np.ndarray, short: list[tuple[int, int, int]]) -> Iterator[tuple]:
    whole: dict[int, list[int]] = {}
    for item, place, k in short:
        whole.setdefault(item, [0, place, k])[0] += 1
    for item, (n, place, k) in whole.items():
        yield items.ids[item], 1.0, n, place, place + k, k
    if not len(seeds):
        return
    last = np.searchsorted(items.seeds, items.seeds[seeds], "right")
    count = last - seeds
    each = np.repeat(seeds - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    item, place, at = items.item[each], items.place[each], np.repeat(places, count)
    order = np.lexsort((at, item))
    item, place, at = item[order], place[order], at[order]
    for group in np.split(np.arange(len(item)), np.flatnonzero(np.diff(item)) + 1):
        it = int(item[group[0]])
        own = items.words[it]
        best = None
        for run in np.split(group, np.flatnonzero(np.diff(at[group]) > len(own)) + 1):
            if len(run) < LEAST_HITS or len(set(place[run].tolist())) < LEAST_HITS:
                continue
            slack = len(own) // 4 + 8
            begin = max(0, int((at[run] - place[run]).min()) - slack)
            end = int((at[run] - place[run]).max()) + len(own) + slack
            score, a, b = align(own, text[begin:end])
            if best is None or score > best[0]:
                best = (score, begin + a, begin + b, len(run))
        if best and best[0] >= MATCH * min(THRESHOLD * len(own), EXCERPT_WORDS) and best[2] - best[1] >= LEAST_WORDS:
            yield items.ids[it], best[0] / (MATCH * len(own)), best[3], best[1], best[2], best[2] - best[1]


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.filter("text is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()


def _is_small(benchmark: DataFrame) -> bool:
    return int(benchmark.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]) <= BLOCK_BYTES


def matches(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``contaminated`` with ``th``, the document's text hash."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kinds = pa.schema(list(zip([*names, "th"], [pa.int64(), pa.int64(), pa.float64(), *[pa.int32()] * 4, pa.int64()], strict=True)))
    doc_id, th = row_key()
    texts = docs.select(doc_id, F.col("text").cast("string").alias("text"), th)
    if not _is_small(benchmark):
        return SeedJoin(spark, texts, _items(benchmark)).matches()
    items = Items([(r["item_id"], r["text"]) for r in _items(benchmark).orderBy("item_id", "text").collect()])
    sent = spark.sparkContext.broadcast(items)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, total = sent.value, np.zeros(len(sent.value.seeds), np.int64)
        for batch in batches:
            for _, _, _, seeds, _ in _documents(items, batch.column(0)):
                total[np.unique(seeds)] += 1
        held = np.flatnonzero(total)
        if len(held):
            yield pa.RecordBatch.from_arrays([pa.array(items.seeds[held].view(np.int64)), pa.array(total[held])], ["seed", "n"])

    # two numbers for each seed of the benchmark, at most
    counted = texts.select("text").mapInArrow(count, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).toPandas()
    seen = counted["seed"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(seen)
    items.keep_rare(seen[order], counted["n"].to_numpy(dtype=np.int64)[order])
    sent.unpersist()
    rare = spark.sparkContext.broadcast(items)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for r, text, *hits in _documents(rare.value, batch.column(1)):
                doc_id, th = batch.column(0)[r].as_py(), batch.column(2)[r].as_py()
                best: dict[int | None, tuple] = {}
                for m in _matches(rare.value, text, *hits):
                    best[m[0]] = max(best.get(m[0], m), m, key=lambda x: x[1:])
                found += [(doc_id, *m, th) for m in best.values()]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds.types, strict=True)], schema=kinds)

    return texts.mapInArrow(find, SCHEMA + ", th long")


def _rows(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}
    fields = [f.split(" ") for f in ddl.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows, strict=True), fields, strict=True)], [n for n, _ in fields])


def _worded(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, word hashes) of texts."""
    for first_row, rows, raw, at in blocks(pc.utf8_lower(column.cast(pa.large_string()).fill_null(""))):
        hashes, _, _, first = words(raw, at, NOT_ALNUM)
        for r in range(rows):
            yield first_row + r, hashes[first[r] : first[r + 1]]


def _runs_of(own: np.ndarray, k: int) -> np.ndarray:
    return grams(own, np.asarray([0, len(own)]), k)[0]


def _of_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(it, item_id, n, words) and the seeds of items, or the hash of a short one's whole sequence, as a list of longs."""
    for batch in batches:
        out = []
        for r, own in _worded(batch.column(2)):
            if len(own):
                seeds = _runs_of(own, SEED_WORDS if len(own) >= LEAST_WORDS else len(own))
                out.append((batch.column(0)[r].as_py(), batch.column(1)[r].as_py(), len(own), own.tobytes(), seeds.tobytes()))
        if out:
            yield _rows(out, ITEMS)


ITEMS = "it long, item_id long, n long, words binary, seeds binary"
SEEDS = "it long, n long, place long, seed long"
HITS = "doc_id long, th long, seed long, at long"
WINDOWS = "doc_id long, th long, it long, begin long, end long, hits long"


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for it, n, seeds in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            found = np.frombuffer(seeds, np.int64)
            for a in range(0, len(found), 10_000):
                part = found[a : a + 10_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), it)), pa.array(np.full(len(part), n)), pa.array(np.arange(a, a + len(part))), pa.array(part)], ["it", "n", "place", "seed"])


class SeedJoin:
    """Seeds of documents (doc_id, text, th) and of a benchmark of any size (item_id, text) meet in shuffles."""

    def __init__(self, spark: SparkSession, texts: DataFrame, items: DataFrame):
        self.spark, self.texts, self.kept = spark, texts, []
        numbered = items.select(F.monotonically_increasing_id().alias("it"), "item_id", "text")
        self.items = stored(spark, numbered.mapInArrow(_of_items, ITEMS), "items", self.kept)
        self.seeds = self.items.select("it", "n", "seeds").mapInArrow(_exploded, SEEDS)
        self.short = [r["n"] for r in self.items.filter(F.col("n") < LEAST_WORDS).select("n").distinct().collect()]  # lengths below LEAST_WORDS

    def hits(self, wanted: DataFrame, placed: bool) -> DataFrame:
        """Seeds of documents that may be ``wanted`` (seed): each place, or each document's distinct ones without their place."""
        bloom, sizes = _bloom(self.spark, wanted.select(F.col("seed").alias("d1"))), [SEED_WORDS, *self.short]

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                row, seed, place = [], [], []
                for r, own in _worded(batch.column(1)):
                    for k in sizes if placed else sizes[:1]:
                        found = _runs_of(own, k)
                        found = found if placed else np.unique(found)
                        at = np.flatnonzero(bloom.value.holds(found)) if len(found) else np.zeros(0, np.int64)
                        row.append(np.full(len(at), r))
                        seed.append(found[at].view(np.int64))
                        place.append(at)
                if row and len(rows := np.concatenate(row)):
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), batch.column(2).take(pa.array(rows)), pa.array(np.concatenate(seed)), pa.array(np.concatenate(place))], ["doc_id", "th", "seed", "at"])

        return self.texts.mapInArrow(task, HITS)

    def rare(self) -> DataFrame:
        """What ``Items.keep_rare`` keeps, and all of short items: (it, n, place, seed)."""
        long_ = self.seeds.filter(F.col("n") >= LEAST_WORDS)
        numbers = self.hits(long_, False).groupBy("seed").agg(F.count(F.lit(1)).alias("df"))
        known = long_.join(checkpointed(self.spark, numbers), "seed", "left").withColumn("df", F.coalesce("df", F.lit(0)))
        item = W.partitionBy("it")
        ranked = known.withColumns({"rank": F.row_number().over(item.orderBy("df", "place")) - 1, "m": F.count(F.lit(1)).over(item)})
        ranked = ranked.withColumn("middle", F.max(F.when(F.col("rank") == F.floor(F.col("m") / 2), F.col("df"))).over(item))
        ranked = ranked.withColumn("near", F.row_number().over(W.partitionBy("it", F.floor(F.col("place") / STRETCH)).orderBy("rank")))
        keep = (F.col("rank") < F.greatest(F.floor(F.col("m") / 2), F.lit(LEAST_SEEDS))) | (F.col("df") <= 2 * F.col("middle") + 8) | (F.col("near") <= LEAST_HITS)
        short = self.seeds.filter(F.col("n") < LEAST_WORDS)
        return checkpointed(self.spark, ranked.filter(keep).select("it", "n", "place", "seed").unionByName(short))

    def windows(self) -> DataFrame:
        """Parts of documents that may hold a copy of an item: from ``begin`` to ``end``, in words; short items as they are."""
        rare = self.rare()
        met = self.hits(rare, True).distinct().join(rare, "seed").select("doc_id", "th", "it", "n", "at", "place")

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []
            for batch in batches:
                if not batch.num_rows:
                    continue
                held.append(batch)
                key = [np.concatenate([b.column(i).fill_null(-(1 << 62)).to_numpy() for b in held]) for i in range(3)]
                new = np.flatnonzero((np.diff(key[0]) != 0) | (np.diff(key[1]) != 0) | (np.diff(key[2]) != 0)) + 1
                if len(new):  # all pairs but the last one are whole
                    table = pa.Table.from_batches(held).combine_chunks()
                    yield from windowed(table, np.concatenate([[0], new]))
                    held = table.slice(int(new[-1])).to_batches()
            if held:
                table = pa.Table.from_batches(held).combine_chunks()
                yield from windowed(table, np.asarray([0, len(table)]))

        def windowed(table: pa.Table, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
            out, at, place = [], table["at"].to_numpy(), table["place"].to_numpy()
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                doc_id, th, it, n = (table[c][a].as_py() for c in ("doc_id", "th", "it", "n"))
                if n < LEAST_WORDS:
                    out.append((doc_id, th, it, int(at[a]), int(at[a]) + n, b - a))
                    continue
                for run in np.split(np.arange(a, b), np.flatnonzero(np.diff(at[a:b]) > n) + 1):
                    if len(run) >= LEAST_HITS and len(np.unique(place[run])) >= LEAST_HITS:
                        first, slack = at[run] - place[run], n // 4 + 8
                        out.append((doc_id, th, it, max(0, int(first.min()) - slack), int(first.max()) + n + slack, len(run)))
            if out:
                yield _rows(out, WINDOWS)

        return met.repartition("doc_id", "th", "it").sortWithinPartitions("doc_id", "th", "it", "at", "place").mapInArrow(task, WINDOWS)

    def passages(self, windows: DataFrame) -> DataFrame:
        """The words of the documents that have windows, once for each text."""
        bloom = _bloom(self.spark, windows.select(F.col("th").alias("d1")))

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                pick = np.flatnonzero(bloom.value.holds(batch.column(1).to_numpy().view(np.uint64)))
                chosen = batch.take(pa.array(pick))
                out = [(chosen.column(1)[r].as_py(), own.tobytes()) for r, own in _worded(chosen.column(0))]
                if out:
                    yield _rows(out, "th long, text binary")

        return self.texts.select("text", "th").mapInArrow(task, "th long, text binary").groupBy("th").agg(F.first("text").alias("text"))

    def matches(self) -> DataFrame:
        windows = stored(self.spark, self.windows(), "windows", self.kept)
        items = self.items.select("it", "item_id", "n", "words")
        pairs = windows.join(self.passages(windows), "th").join(items, "it").select("doc_id", "th", "it", "item_id", "begin", "hits", "words", F.substring("text", F.col("begin").cast("int") * 8 + 1, (F.col("end") - F.col("begin")).cast("int") * 8).alias("passage"))
        scored = stored(self.spark, pairs.mapInArrow(_aligned, ALIGNED), "scored")
        drop_stored(self.spark, self.kept)
        # of an item's windows the best one, the first of equal ones, then of an item_id's texts the best, as in ``find``
        one = F.max_by(F.struct("item_id", "n", "raw", "hits", "begin", "end"), F.struct("raw", -F.col("begin")))
        each = scored.groupBy("doc_id", "th", "it").agg(one.alias("m")).select("doc_id", "th", "m.*")
        short, words_ = F.col("n") < LEAST_WORDS, F.col("end") - F.col("begin")
        enough = (F.col("raw") >= MATCH * F.least(THRESHOLD * F.col("n"), F.lit(EXCERPT_WORDS))) & (words_ >= LEAST_WORDS)
        values = {"score": F.when(short, 1.0).otherwise(F.col("raw") / (MATCH * F.col("n"))), "n_hits": F.col("hits"), "begin_word": F.col("begin"), "end_word": F.col("end"), "aligned_words": words_}
        kinds = dict(x.split() for x in SCHEMA.split(", "))
        best = each.filter(short | enough).groupBy("doc_id", "th", "item_id").agg(F.max(F.struct(*[c.cast(kinds[n]).alias(n) for n, c in values.items()])).alias("m"))
        keys = self.texts.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"))  # repeated rows each
        return best.join(keys, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th"))).select("doc_id", "item_id", "m.*", "th")


ALIGNED = "doc_id long, th long, it long, item_id long, n long, raw long, hits long, begin long, end long"


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            own, first = np.frombuffer(r["words"], np.uint64), r["begin"]
            raw, a, b = (MATCH * len(own), 0, len(own)) if len(own) < LEAST_WORDS else align(own, np.frombuffer(r["passage"], np.uint64))
            out.append((r["doc_id"], r["th"], r["it"], r["item_id"], len(own), raw, r["hits"], first + a, first + b))
        if out:
            yield _rows(out, ALIGNED)


def contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and item_id of which it holds a copy: doc_id, item_id, score, n_hits, words of the passage."""
    return matches(spark, docs, benchmark).drop("th")


def keep_clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """Documents without a copy of ``least_words`` words of any item, whole rows as they came; rows that share a doc_id or have none are judged each by its own text."""
    found = matches(spark, docs, benchmark).filter(F.col("aligned_words") >= least_words)
    return without(docs, checkpointed(spark, found.select("doc_id", "th").distinct()))
