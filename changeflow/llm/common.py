"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(spark: SparkSession, df: DataFrame, name: str, kept: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here and lost executors cost nothing.

    The path is added to ``kept``, for ``drop_stored`` once nothing that is still to be computed reads it.
    """
    path = f"{shared_dir(spark).rstrip('/')}/changeflow-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if kept is not None:
        kept.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(spark: SparkSession, kept: list[str]) -> None:
    """Delete stored tables."""
    for path in kept:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    kept.clear()


def checkpointed(spark: SparkSession, df: DataFrame) -> DataFrame:
    shared_dir(spark)
    return df.checkpoint()


def held_out(doc_id: Column) -> Column:
    """crc32 of the decimal doc_id modulo 5 is 0; such rows never train a model."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def bucket_bounds(df: DataFrame, key: str, n: int) -> list[int]:
    """At most n - 1 ascending split points of an integer key, about equally full (sketch of fixed accuracy)."""
    if n <= 1:
        return []
    at = [i / n for i in range(1, n)]
    found = df.agg(F.percentile_approx(F.col(key), at, max(10_000, 4 * n)).alias("q")).first()["q"]
    return sorted(set(found or []))


def bucket_of(key: Column, bounds: list[int], fan: int = 128) -> Column:
    """Number of bounds <= key, found in two steps over at most ``fan`` + len/fan comparisons; null keys go to 0."""
    if not bounds:
        return F.lit(0)
    longs = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    count = lambda arr: F.size(F.filter(arr, lambda x: x <= key))
    if len(bounds) <= fan:
        n = count(longs(bounds))
    else:
        rows = [bounds[i : i + fan] for i in range(0, len(bounds), fan)]
        row = F.greatest(count(longs([r[0] for r in rows])), F.lit(1))
        n = (row - 1) * fan + count(F.element_at(F.array(*[longs(r) for r in rows]), row))
    return F.when(key.isNull(), 0).otherwise(n).cast("int")


#: Keys of at most this many rows (8 bytes for each of two columns) may be sent to all tasks; larger sets are joined by shuffle.
BROADCAST_KEYS = 500_000


def row_key() -> list[Column]:
    """What tells documents apart, also those that share a doc_id or have none: doc_id and a hash of the text."""
    return [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("th")]


def marked(docs: DataFrame, keys: DataFrame) -> tuple[DataFrame, str, list[str]]:
    """docs with the mark of ``keys`` (doc_id, th, mark; one row a key), null for rows without one; the name of the mark's
    column and those of the key's. The names are new ones, so columns of docs may have any.
    """
    tag = uuid.uuid4().hex
    names = [f"{c}_{tag}" for c in ("doc_id", "th", "mark")]
    keys = keys.select("doc_id", "th", "mark").toDF(*names)
    keys = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
    doc_id, th = row_key()
    return docs.join(keys, doc_id.eqNullSafe(F.col(names[0])) & (th == F.col(names[1])), "left"), names[2], names[:2]


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of docs whose key (``row_key``) isn't among ``keys`` (doc_id, th; a key may repeat)."""
    rows, mark, _ = marked(docs, keys.select("doc_id", "th").distinct().withColumn("mark", F.lit(1)))
    return rows.filter(F.col(mark).isNull()).select(docs.columns)


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The ``rows`` rows with the smallest hashes of an integer key, whatever the partitioning.

    A first cut by hash keeps about three times as many, so that no task or merge handles more than its share of them.
    """
    share = min(1.0, 3 * rows / max(df.count(), 1))
    place = F.pmod(F.xxhash64(key), F.lit(1 << 40))
    return df.filter(place < int(share * (1 << 40)) + 1).orderBy(place, key).limit(rows)
