"""Change streams into tables, each micro-batch once.

A micro-batch is one flush. ``foreachBatch`` writes its changes as they are into a folder of its stream and batch, over whatever an
attempt before has left there, then enters it in the ledger: a batch that is replayed after a failure writes the same rows to the
same place, and streams with checkpoints of their own don't take each other's batches for theirs. The table is the fold of the
entered changes over a target in buckets, worked out when it is read; ``settle`` folds them into the buckets that they touch. A
micro-batch costs what its own rows cost, however large the table is. No watermark: late events are never dropped, and are ordered by the
fold with all that isn't settled yet; an event that is older than a settled one of its key is applied after that.

Reading side: ``maxFilesPerTrigger`` and ``trigger`` are the flush limits, stopping the query is a pause, starting it with the
same checkpoint resumes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.evolution import migration_plan
from ..operators.filters import small, widened_diff
from ..operators.state import table_versions
from ..sinks.buckets import BucketedTarget, Fold
from .ledger import Ledger, exists, folder


class LoggedTable:
    """Changes below ``path``/changes, entered in ``path``/ledger, over a bucketed target at ``path``/rows.

    ``path``/settled has, for each fold into the target, which batches of which streams it takes; it is written before the fold, so that a
    fold that failed is tried again with the same ones.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, changes: T.StructType | str, fold: Fold, key: str, buckets: int = 64):
        self.spark, self.path, self.fold = spark, path.rstrip("/"), fold
        self.logged = changes if isinstance(changes, T.StructType) else T.StructType.fromDDL(changes)
        self.ledger, self.folds = Ledger(spark, f"{self.path}/ledger"), Ledger(spark, f"{self.path}/folds")
        self.target = BucketedTarget(spark, f"{self.path}/rows", schema, key, buckets)

    def begin(self, rows: DataFrame) -> None:
        """The table as it is before the first batch."""
        self.target.begin(rows)

    def append(self, changes: DataFrame, stream: str, batch: int, versions: dict[str, str] | None = None) -> None:
        """Log a batch and enter it; columns that it lacks are null."""
        there = set(changes.columns)
        columns = [F.col(f.name).cast(f.dataType) if f.name in there else F.lit(None).cast(f.dataType).alias(f.name) for f in self.logged]
        at = f"{self.path}/changes/{folder(stream, batch)}"
        changes.select(*columns).write.mode("overwrite").parquet(at)
        self.ledger.add(stream, batch, self.spark.read.schema(self.logged).parquet(at).count(), versions)

    def _settled(self) -> DataFrame:
        at, schema = f"{self.path}/settled", "stream string, upto long, number long"
        return self.spark.read.schema(schema).parquet(at) if exists(self.spark, at) else self.spark.createDataFrame([], schema)

    def settled(self, number: int | None = None) -> dict[str, int]:
        """The last batch of each stream that the target has, or had after the fold of that number."""
        rows = self._settled() if number is None else self._settled().filter(F.col("number") <= number)
        return {r["stream"]: r["upto"] for r in rows.groupBy("stream").agg(F.max("upto").alias("upto")).collect()}

    def has(self, stream: str, batch: int) -> bool:
        return self.ledger.has(stream, batch) or batch <= self.settled().get(stream, -1)

    def _between(self, after: dict[str, int], upto: dict[str, int] | None = None) -> list[tuple[str, int]]:
        entered = [(r["stream"], r["batch"]) for r in self.ledger.entries().select("stream", "batch").collect()]
        return sorted((s, b) for s, b in entered if b > after.get(s, -1) and (upto is None or b <= upto.get(s, -1)))

    def pending(self) -> list[tuple[str, int]]:
        """Stream and number of the batches that the target doesn't have yet."""
        return self._between(self.settled())

    def _changes(self, batches: list[tuple[str, int]]) -> DataFrame | None:
        if not batches:
            return None
        return self.spark.read.schema(self.logged).parquet(*[f"{self.path}/changes/{folder(s, b)}" for s, b in batches])

    def changes(self) -> DataFrame | None:
        return self._changes(self.pending())

    def read(self) -> DataFrame:
        changes = self.changes()
        return self.target.read() if changes is None else self.fold(self.target.read(), changes)

    def settle(self) -> list[int]:
        """Fold what is pending into the target; the numbers of the buckets that were written. One at a time."""
        latest, written = self._settled().agg(F.max("number").alias("n")).first()["n"] or 0, []
        if latest and not self.folds.has("settled", latest):  # it failed half-way
            written += self._fold(latest)
        before = self.settled()
        if upto := {s: b for s, b in self._between(before)}:  # in ascending order: the last batch of each stream stays
            marks = self.spark.createDataFrame(list(upto.items()), "stream string, upto long")
            marks.coalesce(1).write.parquet(f"{self.path}/settled/number={latest + 1}")
            written += self._fold(latest + 1)
        return written

    def _fold(self, number: int) -> list[int]:
        changes = self._changes(self._between(self.settled(number - 1), self.settled(number)))
        written = [] if changes is None else self.target.apply(changes, self.fold, number)
        self.folds.add("settled", number, len(written))
        return written


@dataclass
class Migrations:
    """What new versions of tables ask for while a stream runs.

    ``schemas``: (table, version, column). ``carry_out(table, action, columns)`` creates a table or adds columns at the
    destination. ``current``: (table, version) as known so far; it goes on with each batch, and with the ledger over restarts.
    """

    schemas: DataFrame
    carry_out: Callable[[str, str, list[str]], None]
    current: dict[str, str]
    order: str = "seq"

    def known(self) -> DataFrame:
        return self.schemas.sparkSession.createDataFrame(list(self.current.items()), "table string, version string")

    def plan(self, changes: DataFrame) -> DataFrame:
        return migration_plan(changes, self.schemas, self.known(), self.order)

    def after(self, changes: DataFrame) -> dict[str, str]:
        """The versions that hold after a batch."""
        return self.current | {r["table"]: r["version"] for r in table_versions(changes, self.order).collect()}  # a row a table


def widen(changes: DataFrame, plan: DataFrame, order: str) -> DataFrame:
    """The event that brings a new version counts the added columns as changed."""
    first = small(plan.filter("action = 'add_columns'").select(F.col("table").alias("_table"), F.col("first_seq").alias("_first"), F.col("columns").alias("_new")))
    rows = changes.join(first, (changes["table"] == F.col("_table")) & (changes[order] == F.col("_first")), "left")
    return rows.withColumn("diff", F.when(F.col("_new").isNotNull(), widened_diff(F.col("diff"), F.col("_new"))).otherwise(F.col("diff"))).drop("_table", "_first", "_new")


def split_at_migrations(changes: DataFrame, plan: DataFrame, order: str) -> list[tuple[list[tuple[str, str, list[str]]], DataFrame]]:
    """Cut a micro-batch where versions begin: [(migrations to do first, events up to the next cut)].

    A plan has a row for each new version, so its rows are few; events stay distributed. A destination that is flushed part by
    part has each migration between the events before it and those after.
    """
    cuts = sorted({(r["first_seq"], r["table"], r["action"], tuple(r["columns"])) for r in plan.collect()})
    edges = sorted({c[0] for c in cuts})
    if not edges:
        return [([], changes)]
    out = [([], changes.filter(changes[order] < edges[0]))]
    for i, at in enumerate(edges):
        part = changes.filter(changes[order] >= at)
        if i + 1 < len(edges):
            part = part.filter(changes[order] < edges[i + 1])
        out.append(([(t, a, list(c)) for s, t, a, c in cuts if s == at], part))
    return out


def migrated(changes: DataFrame, migrations: Migrations, flush: Callable[[DataFrame, int], None], finish: Callable[[dict[str, str]], None] | None = None) -> None:
    """Carry out a batch's migrations, each before the events that need it.

    ``flush`` gets each part and its number, ``finish`` comes last, with the versions that hold from then on.
    """
    changes = changes.persist()  # planned, cut and flushed from one reading of the batch
    try:
        plan = migrations.plan(changes)
        for i, (steps, part) in enumerate(split_at_migrations(widen(changes, plan, migrations.order), plan, migrations.order)):
            for table, action, columns in steps:
                if action != "advance":
                    migrations.carry_out(table, action, columns)
            flush(part, i)
        versions = migrations.after(changes)
        if finish:
            finish(versions)
        migrations.current = versions
    finally:
        changes.unpersist()


def stream_of(changes: DataFrame) -> str:
    """The id of the query that a micro-batch comes from; it belongs to the checkpoint and stays over restarts."""
    found = changes.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise ValueError("not inside a streaming query: name the stream")
    return found


def apply_batch(table: LoggedTable, migrations: Migrations | None = None, stream: str | None = None) -> Callable[[DataFrame, int], None]:
    """What ``foreachBatch`` calls. Parts of a batch that is cut by migrations go to the log as one, when all are there.

    ``stream`` names where the batches come from; by default it is the running query's id.
    """

    def run(changes: DataFrame, batch: int) -> None:
        name = stream or stream_of(changes)
        if table.has(name, batch):  # entered by an attempt that ended after that
            return
        if migrations is None:
            table.append(changes, name, batch)
            return
        migrations.current |= table.ledger.versions()
        parts: list[DataFrame] = []
        migrated(changes, migrations, lambda part, _: parts.append(part), lambda versions: table.append(reduce(DataFrame.unionByName, parts), name, batch, versions))

    return run


def start(changes: DataFrame, table: LoggedTable, checkpoint: str, every: str | None = None, migrations: Migrations | None = None) -> StreamingQuery:
    """Run a stream into a table: with ``every`` (a processing time) until it is stopped, else until the input is used up."""
    return begin(changes, apply_batch(table, migrations), checkpoint, every)


def begin(changes: DataFrame, run: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None) -> StreamingQuery:
    writer = changes.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
