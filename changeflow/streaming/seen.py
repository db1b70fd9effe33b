"""INSERTs that a stream has written before, as keyed state.

A key is remembered, with the latest stamp, by a micro-batch that INSERTs or DELETEs it, unless it DELETEs it at all: then it is
forgotten. An INSERT is ``seen`` if a micro-batch before its own has remembered its key at most ``hours`` before the INSERT's stamp, as in
``operators.batches.seen_insert_guard``. What is remembered lives in the query's state store, is part of its checkpoint and
expires ``hours`` after the micro-batch that wrote it, by the clock; nothing that was written is read again. UPDATEs pass by the state.
The state's rows are buckets of keys by hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


#: Buckets of keys a table. Keys of a bucket share a call and a row of state, since a call for each key costs about a millisecond.
BUCKETS = 2048
_KEY, _BUCKET = "_seen_key", "_seen_bucket"


def with_seen(changes: DataFrame, stamp: str, hours: int = 24, buckets: int = BUCKETS) -> DataFrame:
    """A stream of changes (table, id, op, the stamp, others) with ``seen``; ``start`` it.

    A query keeps the number of buckets that it began with.
    """
    out = T.StructType([*changes.schema.fields, T.StructField("seen", T.BooleanType())])
    names = [f.name for f in changes.schema]
    term, lasts = pd.Timedelta(hours=hours), hours * 3_600_000

    def bucket(_: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        ids, stamps, until = state.get if state.exists else ([], [], [])
        known = {i: (s, u) for i, s, u in zip(ids, stamps, until, strict=True) if u > now}
        before = pd.Series([s for s, _ in known.values()], pd.Index(known, dtype=object), dtype="datetime64[us]")
        touched = []
        for part in [] if state.hasTimedOut else parts:
            # a part holds the grouping columns as well
            at, key, insert = pd.to_datetime(part[stamp]).dt.tz_localize(None), part[_KEY], part["op"] == "INSERT"
            yield part[names].assign(seen=insert & (at - term < key.map(before)))
            touched.append(pd.DataFrame({"key": key, "at": at, "gone": part["op"] == "DELETE"}).groupby("key").agg({"at": "max", "gone": "max"}))
        if touched:
            marks = pd.concat(touched).groupby(level=0).agg({"at": "max", "gone": "max"})
            for i, at, gone in zip(marks.index, marks["at"], marks["gone"], strict=True):
                if gone:
                    known.pop(i, None)
                elif pd.notna(at):
                    known[i] = (at.value // 1000, now + lasts)
        if known:
            state.update((list(known), [int(s) for s, _ in known.values()], [int(u) for _, u in known.values()]))
            state.setTimeoutDuration(max(1, min(u for _, u in known.values()) - now))
        elif state.exists:
            state.remove()

    written = changes.filter(F.col("op").isin("INSERT", "DELETE")).withColumn(_KEY, F.coalesce(F.concat(F.lit("="), F.col("id").cast("string")), F.lit("")))
    written = written.withColumn(_BUCKET, F.when(F.col("id").isNotNull(), F.pmod(F.xxhash64("id"), F.lit(buckets))))
    marked = written.groupBy("table", _BUCKET).applyInPandasWithState(bucket, out, "ids array<string>, stamps array<long>, until array<long>", "append", GroupStateTimeout.ProcessingTimeTimeout)
    return marked.unionByName(changes.filter(~F.col("op").isin("INSERT", "DELETE")).withColumn("seen", F.lit(False)))


def use_rocksdb(spark: SparkSession) -> None:
    """State outside the heap, written as changes; a query keeps what it began with."""
    for name, value in ROCKSDB.items():
        spark.conf.set(name, value)


def start(changes: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Write a stream to Parquet files, each micro-batch once.

    A run until the input is used up has no micro-batches without input: those, which only let state expire, would never end.
    """
    use_rocksdb(changes.sparkSession)
    changes.sparkSession.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true" if every else "false")
    writer = changes.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    # each part of the state opens, commits and uploads its store in each micro-batch: no more parts than tasks run at once
    conf, usual = changes.sparkSession.conf, changes.sparkSession.conf.get("spark.sql.shuffle.partitions")
    conf.set("spark.sql.shuffle.partitions", str(min(int(usual), changes.sparkSession.sparkContext.defaultParallelism)))
    try:
        return writer.start()
    finally:
        conf.set("spark.sql.shuffle.partitions", usual)
