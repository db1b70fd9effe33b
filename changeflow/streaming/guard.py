"""Events that a stream can't apply are set aside, and counted, so that it goes on without losing any.

``sorting`` sets aside lines that can't be decoded and events of tables that no schema knows. ``guarded`` sets aside what makes a batch fail
each time it is delivered: after ``TRIES`` deliveries the batch is cut in halves until the events that fail stand alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..model import decode
from ..operators.filters import small
from .ledger import folder
from .runner import stream_of

#: Deliveries of an event before it is set aside (a fixed value).
TRIES = 20

Flush = Callable[[DataFrame, int], None]


def sorted_out(changes: DataFrame, versions: DataFrame) -> DataFrame:
    """Decoded lines with ``why``: null for good ones, else the decoder's error or that the table is unknown."""
    known = small(versions.select(F.col("table").alias("_known")).distinct())
    rows = decode(changes).join(known, F.col("table") == F.col("_known"), "left")
    return rows.withColumn("why", F.when(F.col("error").isNotNull(), F.col("error")).when(F.col("_known").isNull(), "unknown table")).drop("_known", "error")


def sorting(run: Flush, versions: DataFrame, aside: str, stream: str | None = None, strict: bool = False) -> Flush:
    """A ``foreachBatch`` function that gives ``run`` the good events of each batch of lines.

    The others go to ``aside``/rows, with ``why``, in a folder of the stream and batch; ``aside``/counts has a row a batch: good, bad, unknown.
    ``strict``: an unknown table stops the stream, before anything of its batch is applied.
    """

    def flush(lines: DataFrame, batch: int) -> None:
        at = folder(stream or stream_of(lines), batch)
        marked, seen = sorted_out(lines, versions).persist(), Observation()
        try:
            is_ = lambda c: F.count(F.when(c, 1))
            why = F.col("why")
            counted = marked.observe(seen, is_(why.isNull()).alias("good"), is_(why != "unknown table").alias("bad"), is_(why == "unknown table").alias("unknown"))
            counted.filter("why is not null").write.mode("overwrite").parquet(f"{aside}/rows/{at}")
            counts = seen.get
            if strict and counts["unknown"]:
                raise ValueError(f"{counts['unknown']} events of unknown tables in batch {batch}")
            spark = lines.sparkSession
            spark.createDataFrame([(counts["good"], counts["bad"], counts["unknown"])], "good long, bad long, unknown long").coalesce(1).write.mode("overwrite").parquet(f"{aside}/counts/{at}")
            run(marked.filter("why is null").drop("why"), batch)
        finally:
            marked.unpersist()

    return flush


def failing(rows: DataFrame, prepare: Callable[[DataFrame], DataFrame], key: list[str]) -> list[int]:
    """Hashes of the keys of the rows that ``prepare`` fails on, found by halves: some 2 * log2(rows) jobs for each."""
    hashed = rows.withColumn("_h", F.xxhash64(*key))
    bad: list[int] = []

    def search(depth: int, prefix: int) -> None:
        part = hashed.filter(F.col("_h").bitwiseAND((1 << depth) - 1) == prefix) if depth else hashed
        found = [r["_h"] for r in part.select("_h").distinct().limit(2).collect()]
        if not found:
            return
        try:
            prepare(part.drop("_h")).write.format("noop").mode("overwrite").save()
        except Exception:  # whatever it is: the event is to be found, not the error
            if len(found) == 1:
                bad.extend(found)
                return
            search(depth + 1, prefix)
            search(depth + 1, prefix | 1 << depth)

    search(0, 0)
    return bad


def guarded(prepare: Callable[[DataFrame], DataFrame], flush: Flush, aside: str, key: tuple[str, ...] = ("file", "place"), tries: int = TRIES, stream: str | None = None) -> Flush:
    """A ``foreachBatch`` function that flushes what ``prepare`` makes of each batch of a ``changefiles`` stream.

    A failure stops the stream; a supervisor starts it again and the batch is delivered once more. With its delivery number ``tries`` the events
    that ``prepare`` fails on go to ``aside``, in a folder of the stream and batch, and the rest is flushed.
    """

    def run(rows: DataFrame, batch: int) -> None:
        most = rows.agg(F.max("deliveries").alias("n")).first()["n"] or 0
        if most >= tries:
            rows = rows.persist()
            bad = failing(rows, prepare, list(key))
            hit = F.xxhash64(*key).isin(bad) if bad else F.lit(False)
            rows.filter(hit).write.mode("overwrite").parquet(f"{aside}/{folder(stream or stream_of(rows), batch)}")
            rows = rows.filter(~hit)
        flush(prepare(rows), batch)

    return run
