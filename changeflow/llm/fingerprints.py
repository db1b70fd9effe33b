"""Homomorphic multiset fingerprints: wide vectors hashed from paragraphs, summed modulo powers of two.

A text is a multiset of paragraph pieces: lines, cut after every 64 code points. Each piece is hashed with SHA-256 into
four 60-bit words. The fingerprint sums over pieces

* the four words, modulo 2**60 each (equality of multisets), and
* the 120 bits of the first two words as separate counters, two in a 64-bit lane, modulo 2**30 each (likeness).

Addition of vectors is all there is, so the order of pieces doesn't matter and pieces, or whole texts, can be added to
or taken from a fingerprint without the rest (``add``, ``subtract``). Every bit of a hash is a fair coin: two texts'
centred counters have an expected cosine of shared / sqrt(n1 * n2) pieces, which ``likeness`` returns, cut to [0, 1].

Everything is row-local but the look-up of the next document: rows are dealt once by ranges of doc_id, the next text is
a LEAD inside a range, and only the first row of each range is looked up by the last row of the range before.

Edge cases: null text is the empty text; empty texts have a zero vector and are like other empty texts only; rows that
share a doc_id are ordered by text; a single document follows itself; null doc_ids come first; texts of any length are
hashed whole, piece by piece; an empty table gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bucket_bounds, bucket_of

PIECE = "[^\\n]{1,64}"
WORDS, LANES = 4, 60
MASK60, MASK_LANES = (1 << 60) - 1, ((1 << 30) - 1) | (((1 << 30) - 1) << 30)
PAIR = 1 | 1 << 30
ROWS_A_RANGE = 2000


def _long(x: int) -> Column:
    return F.lit(x).cast("long")


def vector(text: Column) -> Column:
    """ARRAY<BIGINT>: number of pieces, four word sums, then 60 lanes of two 30-bit counters each."""
    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PIECE), F.lit(0))
    hashes = F.transform(pieces, lambda p: F.sha2(p, 256))
    word = lambda k: F.transform(hashes, lambda h: F.conv(F.substring(h, 15 * k + 1, 15), 16, 10).cast("long"))
    total = lambda xs, mask: F.aggregate(xs, _long(0), lambda a, x: (a + x).bitwiseAND(_long(mask)))

    def of(words: Column) -> Column:
        sums = [total(F.element_at(words, k + 1), MASK60) for k in range(WORDS)]
        lanes = F.transform(
            F.sequence(F.lit(0), F.lit(LANES - 1)),
            lambda i: F.aggregate(
                F.element_at(words, F.when(i < 30, 1).otherwise(2)), _long(0),
                lambda a, x: (a + F.call_function("shiftright", x, i % 30).bitwiseAND(_long(PAIR))).bitwiseAND(_long(MASK_LANES)),
            ),
        )
        return F.concat(F.array(F.size(F.element_at(words, 1)).cast("long"), *sums), lanes)

    # one lambda argument holds the hashed words, so that they are computed once and not once a lane
    return F.element_at(F.transform(F.array(F.array(*[word(k) for k in range(WORDS)])), of), 1)


def add(a: Column, b: Column, sign: int = 1) -> Column:
    """Fingerprint vector of the union (sign 1) or difference (-1) of two multisets of pieces."""
    def one(x: Column, y: Column, i: int) -> Column:
        if i == 0:
            return x + sign * y
        if i <= WORDS:
            return (x + sign * y).bitwiseAND(_long(MASK60))
        low, high = _long((1 << 30) - 1), _long(((1 << 30) - 1) << 30)
        lower = (x.bitwiseAND(low) + sign * y.bitwiseAND(low)).bitwiseAND(low)
        upper = (x.bitwiseAND(high) + sign * y.bitwiseAND(high)).bitwiseAND(high)
        return lower + upper

    return F.array(*[one(F.element_at(a, i + 1), F.element_at(b, i + 1), i) for i in range(1 + WORDS + LANES)])


def subtract(a: Column, b: Column) -> Column:
    return add(a, b, -1)


def fingerprint(v: Column) -> Column:
    return F.concat_ws("-", F.transform(v, lambda x: F.lower(F.hex(x))))


def centred(v: Column) -> Column:
    """120 counters, each less half of the pieces, times two."""
    n, lanes = F.element_at(v, 1), F.slice(v, 2 + WORDS, LANES)
    low = F.transform(lanes, lambda x: 2 * x.bitwiseAND(_long((1 << 30) - 1)) - n)
    high = F.transform(lanes, lambda x: 2 * F.shiftright(x, 30) - n)
    return F.concat(low, high)


def likeness(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), _long(0), lambda s, z: s + z)

    def of(pair: Column) -> Column:
        x, y = F.element_at(pair, 1), F.element_at(pair, 2)
        norm = F.sqrt(dot(x, x).cast("double")) * F.sqrt(dot(y, y).cast("double"))
        cosine = F.round(F.when(norm == 0, 0.0).otherwise(dot(x, y) / norm), 6)
        return F.when(F.element_at(a, 1) + F.element_at(b, 1) == 0, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))

    return F.when(a == b, 1.0).otherwise(F.element_at(F.transform(F.array(F.array(centred(a), centred(b))), of), 1))


def with_next(docs: DataFrame, order: list[str], keep: list[str], made: dict[str, Column]) -> DataFrame:
    """Adds next_<c> for each column c of ``keep`` and ``made``: its value in the next row by ``order``; the last row wraps to the first.

    ``made`` are columns that are computed from the others: for all rows once, and again only for the first row of each range.
    """
    key, kept = order[0], [*keep, *made]
    n = docs.count()
    bounds = bucket_bounds(docs, key, min(16_384, -(-n // ROWS_A_RANGE)))
    ranged = docs.withColumn("_range", bucket_of(F.col(key), bounds))
    by = W.partitionBy("_range").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    here = ranged.withColumns(made).select("*", F.lead(F.struct(*kept)).over(by).alias("_next"))
    # the least struct is the first row: nulls are least
    firsts = ranged.groupBy("_range").agg(F.min(F.struct(*order, *[c for c in docs.columns if c not in order])).alias("_f")).select(F.col("_range").alias("_first_range"), "_f.*")
    firsts = firsts.withColumns(made).select("_first_range", F.struct(*kept).alias("_first"))
    ranges = ranged.groupBy("_range").agg(F.lit(1).alias("_one"))
    all_ranges = W.orderBy("_range")
    follows = ranges.select(
        F.col("_range").alias("_from"),
        F.coalesce(F.lead("_range").over(all_ranges), F.min("_range").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))).alias("_first_range"),
    )
    heads = follows.join(firsts, "_first_range").select("_from", "_first")
    joined = here.join(heads.hint("merge"), here["_range"] == heads["_from"], "left")
    after = F.coalesce(F.col("_next"), F.col("_first"))
    return joined.select(*docs.columns, *made, *[after[c].alias(f"next_{c}") for c in kept])


def fingerprint_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    paired = with_next(texts, ["doc_id", "text"], ["text"], {"v": vector(F.col("text"))})
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.expr("left(text, char_length(text) - cast(floor(char_length(text) / 2) as int))"), F.substring(F.col("next_text"), F.lit(1), half))
    done = paired.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2(edited, 256).alias("edited_sha256"),
        "v", vector(edited).alias("e"), F.col("next_v").alias("x"),
    )
    return done.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("v")).alias("fingerprint"), fingerprint(F.col("e")).alias("edited_fingerprint"),
        likeness(F.col("v"), F.col("e")).alias("near_edited"), likeness(F.col("v"), F.col("x")).alias("near_next"),
    )


def fingerprint_sql() -> str:
    """The same in DuckDB."""
    def lanes(words: str) -> str:
        return (
            f"list_transform(range(60), lambda i: list_sum(list_transform({words}[1 + i // 30], lambda x: ((x >> (i % 30)::INT) & {PAIR}::BIGINT)))::BIGINT)"
        )

    def vec(text: str) -> str:
        return f"regexp_extract_all({text}, '[^\\n]{{1,64}}')"

    parts = []
    for name, text in (("v", "text"), ("e", "edited"), ("x", "nxt")):
        parts.append(f"list_transform({vec(text)}, lambda p: sha256(p)) AS {name}_h")
    words = [
        "[" + ", ".join(f"list_transform({k}_h, lambda h: ('0x' || substr(h, {15 * w + 1}, 15))::BIGINT)" for w in range(4)) + f"] AS {k}_w"
        for k in "vex"
    ]
    sums = [
        f"list_concat([len({k}_h)::BIGINT], list_transform({k}_w, lambda ws: (coalesce(list_sum(ws), 0) % {1 << 60})::BIGINT), list_transform({lanes(f'{k}_w')}, lambda z: coalesce(z, 0))) AS {k}"
        for k in "vex"
    ]
    centre = [
        f"list_concat(list_transform({k}[6:65], lambda z: 2 * (z & {(1 << 30) - 1}) - {k}[1]), list_transform({k}[6:65], lambda z: 2 * (z >> 30) - {k}[1])) AS {k}_c"
        for k in "vex"
    ]
    dot = lambda a, b: f"list_sum(list_transform(list_zip({a}_c, {b}_c), lambda z: z[1] * z[2]))"
    norm = lambda b: f"(sqrt({dot('v', 'v')}::DOUBLE) * sqrt({dot(b, b)}::DOUBLE))"
    like = lambda b: (
        f"CASE WHEN v = {b} THEN 1.0::DOUBLE WHEN {norm(b)} = 0 THEN 0.0::DOUBLE ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE, round({dot('v', b)}::DOUBLE / {norm(b)}, 6))) END"
    )
    return f"""
WITH ordered AS (
  SELECT doc_id, coalesce(text, '') AS text,
    coalesce(lead(coalesce(text, '')) OVER w, first_value(coalesce(text, '')) OVER w) AS nxt
  FROM documents WINDOW w AS (ORDER BY doc_id NULLS FIRST, coalesce(text, ''))),
edited AS (SELECT *, left(text, (length(text) - length(text) // 2)::BIGINT) || substring(nxt, 1, (length(text) // 2)::BIGINT) AS edited FROM ordered),
hashed AS (SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(edited) AS edited_sha256, {", ".join(parts)} FROM edited),
worded AS (SELECT *, {", ".join(words)} FROM hashed),
summed AS (SELECT *, {", ".join(sums)} FROM worded),
centred AS (SELECT *, {", ".join(centre)} FROM summed)
SELECT doc_id, n_chars, edited_sha256, list_aggregate(list_transform(v, lambda z: lower(to_hex(z))), 'string_agg', '-') AS fingerprint,
  list_aggregate(list_transform(e, lambda z: lower(to_hex(z))), 'string_agg', '-') AS edited_fingerprint,
  {like("e")} AS near_edited, {like("x")} AS near_next
FROM centred"""
