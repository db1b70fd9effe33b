"""Reproducible shuffle into shards: a Feistel permutation over global row numbers, with cycle walking.

Rows are numbered 0..N-1 in ascending (doc_id, text_crc32, size) order, nulls first. The number is permuted inside
[0, N) and the permuted number p gives both places at once: shard = p mod shards, slot = p div shards. Row counts of
shards differ by one at most and slots have no gaps, by arithmetic alone; any row's place can be computed without
looking at other rows.

The cipher works on pairs (l, r) of Z_a x Z_b with a*b >= N, rounds alternately adding a keyed function of one half to
the other. Values in [N, a*b) are walked on until they fall below N. ``plan_feistel`` picks a near sqrt(N) so that
a*b - N is small; a walk can't be longer than that, so the number of steps is proven, not hoped for.

Edge cases: null text counts as 1 byte of size with crc 0; null doc_id sorts first; repeated rows are separate rows
and interchangeable; an empty text has a size of 1; very long texts are read once, for their size and crc, and never moved; an empty
table gives no rows; other columns of the input, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import checkpointed

#: Multipliers and offsets of the round function, one pair a round (fixed values: odd primes below 2**31).
ROUND_KEYS = [(1103515245, 12345), (1664525, 1013904223), (214013, 2531011), (1140671485, 12820163), (22695477, 907633385), (69069, 362437)]


@dataclass(frozen=True)
class Feistel:
    n: int
    a: int
    b: int

    @property
    def walk(self) -> int:
        return self.a * self.b - self.n


def plan_feistel(n: int, tries: int = 4096) -> Feistel:
    root = max(1, math.isqrt(max(n, 1)))
    a = min(range(root, root + min(tries, root) + 1), key=lambda a: (-n) % a)
    return Feistel(n, a, -(-n // a))


def _round(x: Column, mul: int, add: int, key: int) -> Column:
    """Keyed integer mix that stays below 2**63 for x < 2**31, so that ANSI arithmetic never overflows."""
    y = (x * F.lit(mul).cast("long") + F.lit((add + key) % (1 << 31)).cast("long")) % F.lit(2147483647).cast("long")
    return (y + F.shiftright(y, 15)) * F.lit(48271).cast("long") % F.lit(2147483647).cast("long")


def permute(p: Column, plan: Feistel, key: int = 0) -> Column:
    """One pass of the cipher over [0, a*b)."""
    left = p % F.lit(plan.a).cast("long")
    right = ((p - left) / F.lit(plan.a)).cast("long")  # exact: a multiple of a, below 2**53
    for i, (mul, add) in enumerate(ROUND_KEYS):
        if i % 2 == 0:
            left = (left + _round(right, mul, add, key)) % F.lit(plan.a).cast("long")
        else:
            right = (right + _round(left, mul, add, key)) % F.lit(plan.b).cast("long")
    return left + right * F.lit(plan.a).cast("long")


def row_numbers(spark: SparkSession, df: DataFrame, order: list[Column], out: str = "row_number") -> DataFrame:
    """Global 0-based numbers in the given order: sort by range, number inside partitions, add the partitions' offsets.

    The only thing gathered in one place is one count a partition.
    """
    part = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    part = checkpointed(spark, part)  # the range bounds come from a sample: fix them before they are used twice
    pid, at = F.shiftright(F.col("_at"), 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    part = part.withColumn("_pid", pid).withColumn("_at", at)
    counts = part.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_pid", (F.sum("_n").over(W.orderBy("_pid")) - F.col("_n")).alias("_before"))
    return part.join(F.broadcast(offsets), "_pid").withColumn(out, F.col("_before") + F.col("_at")).drop("_pid", "_at", "_before")


def shard_documents(spark: SparkSession, docs: DataFrame, shards: int = 8, key: int = 0) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null: the law is ``rows``)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("text_crc32"), F.col("size")]
    numbered = row_numbers(spark, base, order)
    plan = plan_feistel(numbered.count())
    p = permute(F.col("row_number"), plan, key)
    if plan.walk:
        steps = F.sequence(F.lit(1), F.lit(plan.walk))
        p = F.aggregate(steps, p, lambda acc, _: F.when(acc < plan.n, acc).otherwise(permute(acc, plan, key)))
    return numbered.withColumn("p", p).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), (F.col("p") % shards).cast("int").alias("shard"),
        F.floor(F.col("p") / shards).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def shard_sql(shards: int = 8, key: int = 0) -> str:
    """The same in DuckDB: CRC-32 folded over the bytes, numbers by one window, the walk by recursion."""
    rounds = []
    for i, (mul, add) in enumerate(ROUND_KEYS):
        src, dst, m = ("r", "l", "a") if i % 2 == 0 else ("l", "r", "b")
        mix = f"(({src} * {mul}::BIGINT + {(add + key) % (1 << 31)}) % 2147483647)"
        body = f"({dst} + (({mix} + ({mix} >> 15)) * 48271) % 2147483647) % {m} AS {dst}"
        other = "r" if dst == "l" else "l"
        rounds.append((body, other))
    step = "SELECT *, p % a AS l, p // a AS r FROM {src}"
    for body, other in rounds:
        step = f"SELECT * EXCLUDE (l, r), {other}, {body} FROM ({step})"
    return f"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)::BIGINT[]), lambda c, _k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256))::BIGINT AS i))),
base AS (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents),
crc AS (
  SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(size - 1), lambda i: ('0x' || substr(h, (2 * i + 1)::INT, 2))::BIGINT)),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) AS text_crc32 FROM base, crc_table),
numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS rn, count(*) OVER () AS n FROM crc),
tries AS (SELECT n, unnest(range(greatest(1, floor(sqrt(n))::BIGINT), greatest(1, floor(sqrt(n))::BIGINT) + least(4096, greatest(1, floor(sqrt(n))::BIGINT)) + 1)) AS a FROM (SELECT DISTINCT n FROM numbered)),
halves AS (SELECT a, (n + a - 1) // a AS b FROM tries ORDER BY (a - n % a) % a, a LIMIT 1),
walk AS (
  SELECT doc_id, size, text_crc32, n, a, b, l + r * a AS p, 1 AS k FROM ({step.format(src="(SELECT *, rn AS p FROM numbered, halves)")})
  UNION ALL
  SELECT doc_id, size, text_crc32, n, a, b, l + r * a AS p, k + 1 AS k FROM ({step.format(src="(SELECT * FROM walk WHERE p >= n)")}))
SELECT doc_id, size, text_crc32, 'rows' AS law, (p % {shards})::INT AS shard, (p // {shards})::BIGINT AS slot, NULL::INT AS grown_shard
FROM walk WHERE p < n"""
