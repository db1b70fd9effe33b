"""Batching, sequence checks, stream positions, progress and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import blocks

#: Histogram bounds (fixed values).
FLUSH_SECONDS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10]
FLUSH_COUNTS = [1, 10, 25, 50, 100, 250, 500, 1000, 2500, 5000, 10000]
PROCESSING_SECONDS = [1, 2, 3, 5, 10, 60, 300, 600, 1800, 3600]


def flush_limit(max_ack_pending: int, driver_max: int) -> int:
    return min(max_ack_pending, driver_max) if driver_max > 0 else max_ack_pending


def flush_batches(events: DataFrame, order: str, limit: int, partition: list[str]) -> DataFrame:
    """Replay of flushes: the number of the batch that each event falls in, ``limit`` events a batch, in each stream partition."""
    dealt = blocks.Blocks(events, partition, order)
    rows = dealt.rows.withColumn("_n", F.row_number().over(dealt.inside()))
    rows = dealt.carry(rows, {"_all": F.count(F.lit(1))}, {"_earlier": F.coalesce(F.sum("_all").over(blocks.before()), F.lit(0))}, alone={"_earlier": F.lit(0)})
    return dealt.clean(rows.withColumn("batch_id", F.floor((F.col("_earlier") + F.col("_n") - 1) / limit).cast("long")), "_n", "_earlier")


def sequence_gaps(events: DataFrame, seq: str, partition: list[str]) -> DataFrame:
    """Events whose sequence isn't the previous one plus 1, with what was expected."""
    dealt = blocks.Blocks(events, partition, seq)
    rows = dealt.rows.withColumn("_last", F.lag(seq).over(dealt.inside()))
    rows = dealt.carry(rows, {"_most": F.max(seq)}, {"_earlier": F.max("_most").over(blocks.before())}, alone={"_earlier": F.lit(None).cast(events.schema[seq].dataType)})
    rows = dealt.clean(rows.withColumn("expected", F.coalesce("_last", "_earlier") + 1), "_last", "_earlier")
    return rows.filter(F.col("expected").isNotNull() & (F.col(seq) != F.col("expected")))


def start_position(watermarks: DataFrame, deliver_all: bool = False) -> DataFrame:
    """Where a new consumer starts: everything, the earliest snapshot, or what comes from now on. One row."""
    if deliver_all:
        return watermarks.agg(F.lit("all").alias("policy"), F.lit(None).cast("timestamp_ntz").alias("start_ts"))
    first = F.min("export_ts")
    return watermarks.agg(F.when(first.isNull(), "new").otherwise("by_start_time").alias("policy"), first.alias("start_ts"))


def export_watermark(files: DataFrame, cursors: DataFrame | None = None) -> DataFrame:
    """(table, export_ts): the newest file of each table, else the export's cursor for tables without files."""
    newest = files.groupBy("table").agg(F.max("file_ts").alias("export_ts"))
    if cursors is None:
        return newest
    return cursors.join(newest, "table", "full_outer").select("table", F.coalesce("export_ts", "cursor_ts").alias("export_ts"))


def export_progress(jobs: DataFrame) -> DataFrame:
    """One row: tables in all and by status, and the share that is completed."""
    is_ = lambda s: F.sum(F.when(F.col("status") == s, 1).otherwise(0))
    return jobs.agg(
        F.count(F.lit(1)).alias("total"), is_("Completed").alias("completed"), is_("Pending").alias("pending"), is_("Failed").alias("failed"),
        F.round(100.0 * is_("Completed") / F.greatest(F.count(F.lit(1)), F.lit(1)), 4).alias("percent"),
    )


def import_counts(rows: DataFrame, *by: str) -> DataFrame:
    """Rows by file and table, by file, and in all."""
    return rows.rollup(*by).agg(F.count(F.lit(1)).alias("n"))


def histogram(values: DataFrame, column: str, bounds: list[float], by: list[str]) -> DataFrame:
    """Cumulative bucket counts (value <= bound), one row a bound, with sum and count: one pass, no join."""
    sums = [F.sum(F.when(F.col(column) <= b, 1).otherwise(0)).alias(f"_{i}") for i, b in enumerate(bounds)]
    wide = values.groupBy(*by).agg(F.count(column).alias("count"), F.sum(column).alias("sum"), *sums)
    pairs = F.array(*[F.struct(F.lit(float(b)).alias("le"), F.col(f"_{i}").alias("n")) for i, b in enumerate(bounds)])
    return wide.select(*by, "count", "sum", F.explode(pairs).alias("b")).select(*by, "count", "sum", "b.le", "b.n")


def running_average(flushes: DataFrame, duration: str, count: str, order: str, partition: list[str]) -> DataFrame:
    """Mean time a record after each flush: all durations so far over all records so far, counted before the collapse."""
    dealt = blocks.Blocks(flushes, partition, order)
    so_far = dealt.inside().rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = dealt.rows.withColumns({"_d": F.sum(duration).over(so_far), "_c": F.sum(count).over(so_far)})
    earlier = {x: F.coalesce(F.sum(y).over(blocks.before()), F.lit(0)) for x, y in (("_d0", "_d1"), ("_c0", "_c1"))}
    rows = dealt.carry(rows, {"_d1": F.sum(duration), "_c1": F.sum(count)}, earlier, alone={x: F.lit(0) for x in earlier})
    return dealt.clean(rows.withColumn("mean", (F.col("_d") + F.col("_d0")) / (F.col("_c") + F.col("_c0"))), "_d", "_c", "_d0", "_c0")


def runs(rows: DataFrame, value: Column, order: str, partition: list[str], out: str = "run") -> DataFrame:
    """Numbers runs of equal values in order: inside blocks first, then with what the blocks before have."""
    dealt = blocks.Blocks(rows.withColumn("_v", value), partition, order)
    by = dealt.inside()
    new = F.when(F.lag("_v").over(by).eqNullSafe(F.col("_v")) & (F.row_number().over(by) > 1), 0).otherwise(1)
    numbered = dealt.rows.withColumn("_new", new).withColumn("_run", F.sum("_new").over(by.rowsBetween(W.unboundedPreceding, W.currentRow)))
    facts = {"_head": F.min_by("_v", order), "_tail": F.max_by("_v", order), "_n": F.sum("_new")}
    goes_on = F.when(F.lag("_tail").over(blocks.in_order()).eqNullSafe(F.col("_head")) & (F.row_number().over(blocks.in_order()) > 1), 1).otherwise(0)
    offset = F.coalesce(F.sum(F.col("_n") - F.col("_on")).over(blocks.before()), F.lit(0)) - F.col("_on")
    numbered = dealt.carry(numbered, facts, {"_on": goes_on}, {"_offset": offset}, alone={"_offset": F.lit(0).cast("long")})
    return dealt.clean(numbered.withColumn(out, F.col("_run") + F.col("_offset")), "_v", "_new", "_run", "_offset")


def seen_insert_guard(records: DataFrame, flush: str, stamp: str, hours: int = 24) -> DataFrame:
    """Adds ``seen``: an INSERT whose key an earlier flush has written within the time, and hasn't deleted since.

    A key is remembered after a flush that INSERTs or DELETEs it, unless the flush DELETEs it at all; the look-up sees the state
    before the flush. What a flush does to a key is one row, combined before the shuffle; the window runs over those rows, not over
    the key's records, which may be a large share of all.
    """
    keys = ["table", "id"]
    touched = F.max(F.when(F.col("op").isin("INSERT", "DELETE"), F.col(stamp)))
    facts = records.groupBy(*keys, flush).agg((F.max((F.col("op") == "DELETE").cast("int")) == 1).alias("_deleted"), touched.alias("_touched"))
    mark = F.when(F.col("_touched").isNotNull(), F.struct(F.col(flush).alias("f"), F.when(~F.col("_deleted"), F.col("_touched")).alias("t")))
    earlier = W.partitionBy(*keys).orderBy(flush).rangeBetween(W.unboundedPreceding, -1)
    facts = facts.select(*[F.col(c).alias(f"_{c}") for c in keys], F.col(flush).alias("_flush"), F.max(mark).over(earlier).alias("_last"))
    same = F.col("table").eqNullSafe(F.col("_table")) & F.col("id").eqNullSafe(F.col("_id")) & F.col(flush).eqNullSafe(F.col("_flush"))
    rows = records.join(facts, same)
    fresh = F.col("_last.t") > F.col(stamp) - F.expr(f"interval {hours} hours")
    return rows.withColumn("seen", F.coalesce((F.col("op") == "INSERT") & F.col("_last.t").isNotNull() & fresh, F.lit(False))).drop("_table", "_id", "_flush", "_last")
