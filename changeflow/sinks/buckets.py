"""A target table in buckets of its key, of which a batch rewrites those that its keys fall in.

It is a bucketed table of the session's catalog whose partition column is the bucket number: a fold that joins changes to it by the key
shuffles the changes alone, and writing a fold back overwrites the partitions of its buckets and leaves all other files as they are.

Each bucket that is written gets one row more, without a key, that isn't ``_live`` and holds the number of the write: a bucket whose rows
are all deleted is written too, and a write that failed half-way goes on with the buckets that don't have its number yet, so that folds
that can't be applied twice aren't.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..streaming.ledger import exists

Fold = Callable[[DataFrame, DataFrame], DataFrame]


class BucketedTarget:
    """``schema`` of the rows as DDL; ``path`` is where the files are, whatever catalog knows of them."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets
        self.schema = T.StructType.fromDDL(schema)
        self.columns = [f.name for f in self.schema]
        self.name = "target_" + hashlib.sha256(path.encode()).hexdigest()[:16]
        if not spark.catalog.tableExists(self.name):
            there = exists(spark, path)
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
            spark.sql(f"CREATE TABLE {self.name} ({columns}, _live boolean, _write bigint, _bucket int) USING parquet PARTITIONED BY (_bucket) CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
            if there:
                spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")

    def bucket(self) -> Column:
        """The bucket that Spark's own writer puts a row in."""
        return F.pmod(F.hash(self.key), F.lit(self.buckets)).cast("int")

    def _rows(self, buckets: list[int] | None = None) -> DataFrame:
        rows = self.spark.table(self.name).filter("_live")
        return rows if buckets is None else rows.filter(F.col("_bucket").isin(buckets))

    def read(self) -> DataFrame:
        return self._rows().select(self.columns)

    def begin(self, rows: DataFrame) -> None:
        """The rows as they are before the first write."""
        self._put(rows.repartition(self.buckets, self.key), list(range(self.buckets)), 0)

    def _put(self, rows: DataFrame, buckets: list[int], number: int) -> None:
        live = rows.select(*self.columns, F.lit(True).alias("_live"), F.lit(number).cast("long").alias("_write"), self.bucket().alias("_bucket"))
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema]
        marks = self.spark.createDataFrame([(b,) for b in buckets], "_bucket int").coalesce(1).select(*none, F.lit(False).alias("_live"), F.lit(number).cast("long").alias("_write"), "_bucket")
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(mode)
        self.spark.conf.set(mode, "dynamic")
        try:
            live.unionByName(marks).write.insertInto(self.name, overwrite=True)
        finally:
            self.spark.conf.set(mode, before)

    def touched(self, changes: DataFrame) -> list[int]:
        """Numbers of the buckets that the changes' keys fall in; there are ``buckets`` at most."""
        kind = self.schema[self.key].dataType
        found = changes.select(F.col(self.key).cast(kind).alias(self.key)).select(self.bucket().alias("b")).distinct().collect()
        return sorted(r["b"] for r in found)

    def folded(self, changes: DataFrame, fold: Fold, buckets: list[int]) -> DataFrame:
        """The fold of the changes over the rows of their buckets."""
        return fold(self._rows(buckets).select(self.columns), changes)

    def apply(self, changes: DataFrame, fold: Fold, number: int) -> list[int]:
        """Fold changes into their buckets by the write of that number, which is done once however often it is tried."""
        buckets = self.touched(changes)
        marks = self.spark.table(self.name).filter(~F.col("_live") & F.col("_bucket").isin(buckets)).groupBy("_bucket").agg(F.max("_write").alias("w"))
        done = {r["_bucket"] for r in marks.filter(F.col("w") >= number).collect()}
        todo = [b for b in buckets if b not in done]
        if todo:
            kind = self.schema[self.key].dataType
            here = changes if not done else changes.filter(F.pmod(F.hash(F.col(self.key).cast(kind)), F.lit(self.buckets)).isin(todo))
            self._put(self.folded(here, fold, todo), todo, number)
        return todo
