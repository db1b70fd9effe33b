"""Exact removal of repeated byte strings by suffix arrays over shards.

A byte goes if it lies in a string of ``length`` bytes that begins at more than one place of the corpus. The work is cut
so that all places of such a string meet in one shard:

1. Runs. In each string of ``length`` bytes the smallest of its ``ANCHOR``-byte hashes is its anchor. Neighbouring strings
   with the same anchor form a run, a window of less than two lengths (a longer run, in text that repeats itself, is cut). Equal
   strings have equal anchors, so a string can repeat only among windows of equal anchor hash; that different strings may share
   one costs time only. One row a run is kept: place, anchor hash, two 61-bit prints of the window, and whether the anchor comes
   once more inside it: without that no string begins twice in one window.
2. Windows whose anchor occurs once, in themselves too, are done. Windows of equal prints count as one with its number; if an anchor has one window
   only, all of it repeats. The prints are polynomials modulo the prime 2**61 - 1 with two bases that each run draws anew: two
   different windows agree in both about once in 2**104 pairs, whatever their bytes are; no text can be made to fit the bases.
3. Other windows are fetched (from one document each) and dealt by anchor into shards of about ``SHARD_BYTES``. A shard's
   suffix array comes from induced sorting, its permuted common prefixes tell which strings begin twice, byte by byte.
4. Anchors with more than ``CROWD`` different windows (the borders of a passage that very many documents share) don't go to
   one shard: their windows are cut into single strings, counted by both prints, a key each.
5. Ranges of repeated starts go back to all places of their window, and to the documents, as spans to cut.

What stays whole: all documents take part at full length, in blocks of ``BLOCK`` starts where they are long. Texts are read
from the source each time; only those that a Bloom filter of fixed size holds for likely are shuffled.

Edge cases: null text is empty; texts shorter than ``length`` bytes keep all; rows that share a doc_id are told apart by
their text, and rows that repeat both are copies of each other, so a repeated text of ``length`` bytes or more goes whole; an
empty table gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_KEYS, drop_stored, stored
from .jaccard_join import _bloom
from .suffix_array import repeated_starts
from .words import BASE, BYTE_CODE, U, blocks, mix

ANCHOR = 64
BLOCK = 1 << 20
SHARD_BYTES = 2 << 20
CROWD = 4_000

_INVERSE = U(pow(int(BASE), -1, 1 << 64))
_tables: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    have = _tables.get(int(base))
    if have is None or len(have) < n:
        have = _tables[int(base)] = np.concatenate([[U(1)], np.multiply.accumulate(np.full(n, base, U))])
    return have[:n]


PRIME = U((1 << 61) - 1)
#: Bases of the prints where none are given: numbers below the prime, drawn at random once.
PRINT_BASES = (0x0B7E151628AED2A6, 0x1243F6A8885A308D)
_LOW = U((1 << 31) - 1)
_prints: dict[int, np.ndarray] = {}


def _fold(x: np.ndarray) -> np.ndarray:
    x = (x & PRIME) + (x >> U(61))
    return np.where(x >= PRIME, x - PRIME, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo 2**61 - 1, in parts of 31 bits."""
    a1, a0, b1, b0 = a >> U(31), a & _LOW, b >> U(31), b & _LOW
    middle = a1 * b0 + a0 * b1
    return _fold(U(2) * a1 * b1 + (middle >> U(30)) + ((middle & U((1 << 30) - 1)) << U(31)) + a0 * b0)


def _prime_powers(base: int, n: int) -> np.ndarray:
    have = _prints.get(base)
    if have is None or len(have) < n:
        if have is None and len(_prints) >= 4:  # those of an earlier run: a base and its inverse, twice
            _prints.clear()
        have, step = np.ones(1, U), base
        while len(have) < n:
            have, step = np.concatenate([have, times(have, np.full(len(have), step, U))]), step * step % int(PRIME)
        _prints[base] = have
    return have


class Prints:
    """Two prints of any range of a block, from exact sums of letters times powers of a base."""

    def __init__(self, raw: np.ndarray, bases: tuple[int, int] = PRINT_BASES):
        self.n, self.bases = len(raw), bases
        letters, self.sums = raw.astype(U) + U(1), []
        for base in bases:
            power = _prime_powers(base, self.n + 1)[: self.n]
            parts = []
            for half in (power & _LOW, power >> U(31)):  # sums stay below 2**60 for blocks of 2**20 bytes
                part = np.zeros(self.n + 1, U)
                np.cumsum(letters * half, out=part[1:])
                parts.append(part)
            self.sums.append(parts)

    def of(self, begin: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
        out = []
        for base, (low, high) in zip(self.bases, self.sums, strict=True):
            total = _fold(_fold(low[end] - low[begin]) + times(_fold(high[end] - high[begin]), np.full(len(begin), 1 << 31, U)))
            shifted = times(total, _prime_powers(pow(base, -1, int(PRIME)), self.n + 1)[begin])  # as if the block began here
            out.append((shifted ^ ((end - begin).astype(U) << U(48))).view(np.int64))
        return out


def _smallest(key: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    span = 1
    while span * 2 <= width:
        key = np.minimum(key[: len(key) - span], key[span:])
        span *= 2
    return np.minimum(key[: len(key) - (width - span)], key[width - span :]) if span < width else key


def runs(raw: np.ndarray, at: np.ndarray, length: int, bases: tuple[int, int] = PRINT_BASES) -> tuple[np.ndarray, ...]:
    """For all texts of a block: text number, first start in the block, starts, anchor hash, both prints of each run, and if its anchor comes again.

    A string that begins at two starts of a run has the run's anchor at both; of the places of the anchor in the run, the last
    one then isn't in the strings of all starts, so it comes in with a start that isn't the first.
    """
    none = np.zeros(0, np.int64)
    n = len(raw) - length + 1
    if n <= 0:
        return (none,) * 7
    anchor = min(ANCHOR, length)
    width = length - anchor + 1
    sums = np.zeros(len(raw) + 1, U)
    np.cumsum(BYTE_CODE[raw] * _powers(BASE, len(raw)), out=sums[1:])
    key = mix((sums[anchor:] - sums[:-anchor]) * _powers(_INVERSE, len(raw) + 1)[: len(raw) - anchor + 1])
    least = _smallest(key, width)
    doc = np.searchsorted(at, np.arange(n), "right") - 1
    starts = np.flatnonzero(np.arange(n) + length <= at[doc + 1])
    if not len(starts):
        return (none,) * 7
    least, doc = least[starts], doc[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    since = np.arange(len(starts)) - np.repeat(first, np.diff(np.append(first, len(starts))))
    first = np.flatnonzero(since % width == 0)
    count = np.diff(np.append(first, len(starts)))
    begin = starts[first]
    comes = key[starts + width - 1] == least
    comes[first] = False
    again = np.logical_or.reduceat(comes, first)
    return doc[first], begin, count, least[first].view(np.int64), *Prints(raw, bases).of(begin, begin + count + length - 1), again


def _runs(length: int, bases: tuple[int, int]):
    names = ["doc_id", "th", "begin", "n", "anchor", "win", "win2", "again"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column(0), batch.column(1)
            for first_row, rows, raw, at in blocks(batch.column(2), BLOCK // 4):
                for lo in range(0, max(len(raw), 1), BLOCK) if rows == 1 else [0]:
                    part = raw[lo : lo + BLOCK + length - 1] if rows == 1 else raw
                    doc, begin, count, anchor, win, win2, again = runs(part, at if rows > 1 else np.asarray([0, len(part)]), length, bases)
                    if len(doc):
                        row = pa.array(doc + first_row)
                        facts = [begin + lo - at[doc], count.astype(np.int32), anchor, win, win2, again]
                        yield pa.RecordBatch.from_arrays([ids.take(row), hashes.take(row), *map(pa.array, facts)], names)

    return task, "doc_id long, th long, begin long, n int, anchor long, win long, win2 long, again boolean"


def _likely(bloom):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(bloom.value.holds(batch.column(1).to_numpy().view(U))))

    return task, "doc_id long, th long, text string"


def _cut(length: int):
    """Windows of one document each: rows of (text, list of (begin, n, anchor, win, win2, copies, crowd))."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, cut = batch.column(1).flatten(), []
            begin, n = flat.field("begin").to_pylist(), flat.field("n").to_pylist()
            at = 0
            for text, count in zip(batch.column(0), pc.list_value_length(batch.column(1)).to_pylist(), strict=True):
                data = memoryview(text.as_buffer())
                cut += [bytes(data[b : b + k + length - 1]) for b, k in zip(begin[at : at + count], n[at : at + count], strict=True)]
                at += count
            names = ["anchor", "win", "win2", "copies", "crowd", "n"]
            yield pa.RecordBatch.from_arrays([*(flat.field(c) for c in names), pa.array(cut, pa.binary())], [*names, "data"])

    return task, "anchor long, win long, win2 long, copies long, crowd boolean, n int, data binary"


def _ranges(twice: np.ndarray) -> list[dict[str, int]]:
    edge = np.flatnonzero(np.diff(twice.astype(np.int8), prepend=0, append=0))
    return [{"a": int(a), "b": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)]


RANGES = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _shard(length: int):
    """Rows sorted by anchor: anchor, win, win2, copies, n, data. Whole anchors are gathered up to about SHARD_BYTES."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        text = np.frombuffer(b"".join(r[5] for r in rows), np.uint8)
        sizes = np.asarray([len(r[5]) for r in rows])
        at = np.concatenate([[0], np.cumsum(sizes)])
        valid = np.arange(len(text)) - np.repeat(at[:-1], sizes) < np.repeat([r[4] for r in rows], sizes)
        twice = repeated_starts(text, valid, length)
        found = [[{"a": 0, "b": r[4]}] if r[3] > 1 else _ranges(twice[a : a + r[4]]) for r, a in zip(rows, at[:-1].tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([*(pa.array([r[i] for r in rows]) for i in range(3)), pa.array(found, RANGES)], ["anchor", "win", "win2", "ranges"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if size >= SHARD_BYTES and row[0] != rows[-1][0]:
                    yield solve(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[5])
        if rows:
            yield solve(rows)

    return task, "anchor long, win long, win2 long, ranges array<struct<a:int,b:int>>"


def _strings(length: int, bases: tuple[int, int]):
    """One row for each start of a window: both prints of its string."""
    names = ["h1", "h2", "anchor", "win", "win2", "off", "copies"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, win, win2, copies, n, data in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                off = np.arange(n)
                one, two = Prints(np.frombuffer(data, np.uint8), bases).of(off, off + length)
                yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(two), *(pa.array(np.full(n, x)) for x in (anchor, win, win2)), pa.array(off.astype(np.int32)), pa.array(np.full(n, copies))], names)

    return task, "h1 long, h2 long, anchor long, win long, win2 long, off int, copies long"


def _mark(bloom):
    """Texts without spans are finished here; the others go on with their text."""
    names = ["doc_id", "th", "n_bytes", "kept_sha256", "text"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            likely = bloom.value.holds(batch.column(1).to_numpy().view(U))
            n, sha, text = [], [], []
            for t, go in zip(batch.column(2), likely, strict=True):
                data = t.as_buffer()
                n.append(len(data))
                sha.append(None if go else hashlib.sha256(data).hexdigest())
                text.append(t.as_py() if go else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(text, pa.string())], names)

    return task, "doc_id long, th long, n_bytes long, kept_sha256 string, text string"


SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes; spans that touch are one run."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        removed, count, sha = [], [], []
        for text, known, spans in zip(batch.column(2), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
            cut = merge([(s["begin"], s["end"]) for s in spans or []])
            if known is None:
                data, last, kept = memoryview(text.as_buffer()), 0, hashlib.sha256()
                for a, b in cut:
                    kept.update(data[last:a])
                    last = b
                kept.update(data[last:])
                known = kept.hexdigest()
            removed.append(sum(b - a for a, b in cut))
            count.append(len(cut))
            sha.append(known)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(sha, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeated_spans(spark: SparkSession, texts: DataFrame, length: int, kept: list[str]) -> DataFrame:
    """(doc_id, th, begin, end): byte ranges covered by repeated strings; they may overlap. Reads the tables listed in ``kept``."""
    bases = (secrets.randbelow(int(PRIME) - 2) + 2, secrets.randbelow(int(PRIME) - 2) + 2)
    rows = stored(spark, texts.mapInArrow(*_runs(length, bases)), "runs", kept)
    differ = (F.min("win") != F.max("win")) | (F.min("win2") != F.max("win2"))
    k = F.count(F.lit(1))
    # a window that is alone goes on if a string may begin twice in it
    anchors = rows.groupBy("anchor").agg(k.alias("k"), (differ | (k == 1)).alias("several"), F.max("again").alias("again")).filter("k > 1 or again")
    # written first: then the join's sides are plain shuffles, and a part that is full of one anchor can be split
    anchors = stored(spark, anchors.select("anchor", "several"), "anchors", kept)
    places = stored(spark, rows.drop("again").join(anchors, "anchor"), "places", kept)
    # different windows of anchors that have several, one place each
    window = ["anchor", "win", "win2"]
    wins = places.filter("several").groupBy(*window).agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "th", "begin", "n")).alias("p"))
    wins = stored(spark, wins.select(*window, "copies", "p.doc_id", "p.th", "p.begin", "p.n"), "windows", kept)
    crowds = wins.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") > CROWD).select("anchor", F.lit(True).alias("crowd"))
    crowds = stored(spark, crowds, "crowds", kept)
    crowds = F.broadcast(crowds) if crowds.count() <= BROADCAST_KEYS else crowds
    listed = wins.join(crowds, "anchor", "left").groupBy("doc_id", "th").agg(
        F.collect_list(F.struct("begin", "n", *window, "copies", F.coalesce("crowd", F.lit(False)).alias("crowd"))).alias("wins")
    )
    likely = texts.mapInArrow(*_likely(_bloom(spark, wins.select(F.col("th").alias("d1")).distinct()))).dropDuplicates(["doc_id", "th"])
    same = likely["doc_id"].eqNullSafe(listed["doc_id"]) & (likely["th"] == listed["th"])
    data = stored(spark, likely.join(listed, same).select("text", "wins").mapInArrow(*_cut(length)), "data", kept)
    cols = [*window, "copies", "n", "data"]
    small = data.filter("not crowd").select(cols).repartition("anchor").sortWithinPartitions("anchor").mapInArrow(*_shard(length))
    strings = data.filter("crowd").select(cols).mapInArrow(*_strings(length, bases))
    twice = strings.groupBy("h1", "h2").agg(F.sum("copies").alias("k")).filter("k > 1").select("h1", "h2")
    crowded = strings.join(twice, ["h1", "h2"]).groupBy(*window).agg(F.collect_list(F.struct(F.col("off").alias("a"), (F.col("off") + 1).alias("b"))).alias("ranges"))
    # written, so that what follows is dealt by window and not by the anchor that the shards were dealt by
    found = stored(spark, small.unionByName(crowded).filter("size(ranges) > 0"), "ranges", kept)
    whole = places.filter("not several").select("doc_id", "th", "begin", (F.col("begin") + F.col("n") + (length - 1)).alias("end"))
    partly = places.filter("several").join(found, window).select("doc_id", "th", "begin", F.explode("ranges").alias("r"))
    partly = partly.select("doc_id", "th", (F.col("begin") + F.col("r.a")).alias("begin"), (F.col("begin") + F.col("r.b") + (length - 1)).alias("end"))
    return whole.unionByName(partly)


def remove_repeats(spark: SparkSession, docs: DataFrame, length: int = 200) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    text = F.coalesce(F.col("text"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
    kept: list[str] = []
    spans = repeated_spans(spark, texts, length, kept).groupBy("doc_id", "th").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    spans = stored(spark, spans, "spans")
    drop_stored(spark, kept)
    marked = texts.mapInArrow(*_mark(_bloom(spark, spans.select(F.col("th").alias("d1")).distinct())))
    same = marked["doc_id"].eqNullSafe(spans["doc_id"]) & (marked["th"] == spans["th"])
    return marked.join(spans, same, "left").select(marked["doc_id"], "n_bytes", "text", "kept_sha256", "spans").mapInArrow(_remove, SCHEMA)
