"""The application rules as streams: files in, ``foreachBatch``, the same rows out as in one batch."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import apply
from ..session import shared_dir
from ..sources import changes as source
from ..streaming import guard, runner, seen
from . import changes, events
from .feeds import COLUMNS, EVENTS_SQL, event_feed, user_target


#: Buckets of the targets of these queries.
BUCKETS = 8


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of the events table as a stream; its path may be one file or a folder of them."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    names = "{events.parquet,events.parquet/*.parquet}"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 8).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/{names}")


def _streamed(spark: SparkSession, sf_dir: str, fold: runner.Fold) -> DataFrame:
    """The events table read as a stream of files into a table that starts as ``user_target``."""
    place = f"{shared_dir(spark).rstrip('/')}/changeflow-stream-{uuid.uuid4().hex}"
    target, feed = user_target(spark, sf_dir).select("pk", *COLUMNS), event_feed(spark, sf_dir, _stream(spark, sf_dir))
    table = runner.LoggedTable(spark, f"{place}/table", ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in target.schema), feed.schema, fold, "pk", BUCKETS)
    table.begin(target)
    runner.start(feed, table, f"{place}/checkpoint").awaitTermination()
    return table.read()


def stream_apply_postgres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, lambda old, new: apply.changed_columns_upsert(old, new, "pk", COLUMNS, "seq"))


def stream_apply_mysql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, lambda old, new: apply.replace_rows(old, new, "pk", COLUMNS, "seq"))


def stream_migration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream whose table ``grown`` (even users) gets the column ``note`` with version v2, in the middle; ``plain`` is new to the destination.

    Before v2 the diff names what it names; the event that brings v2 counts ``note`` as changed, later ones only where they
    say so (none does), so each row has the note of that one event, of its first event, or of an INSERT.
    """
    place = f"{shared_dir(spark).rstrip('/')}/changeflow-stream-{uuid.uuid4().hex}"
    grown = F.col("pk") % 2 == 0
    middle = spark.read.parquet(f"{sf_dir}/events.parquet").agg((F.max("event_id") / 2).cast("long").alias("m")).first()["m"]
    late = grown & (F.col("seq") > middle)
    feed = event_feed(spark, sf_dir, _stream(spark, sf_dir)).withColumns({
        "table": F.when(grown, "grown").otherwise("plain"), "modelVersion": F.when(late, "v2").otherwise("v1"), "note": F.when(late, F.concat(F.lit("n"), F.col("seq").cast("string"))),
    })
    columns, done = [*COLUMNS, "note"], []
    rows = [(t, v, c) for t, v in (("grown", "v1"), ("grown", "v2"), ("plain", "v1")) for c in (columns if v == "v2" else COLUMNS)]
    schemas = spark.createDataFrame(rows, "table string, version string, column string")
    moves = runner.Migrations(schemas, lambda *step: done.append(step), {"grown": "v1"})
    table = runner.LoggedTable(spark, f"{place}/table", "pk bigint, value double, props string, ts timestamp_ntz, note string", feed.schema, lambda old, new: apply.changed_columns_upsert(old, new, "pk", columns, "seq"), "pk", BUCKETS)
    runner.start(feed, table, f"{place}/checkpoint", migrations=moves).awaitTermination()
    steps = F.lit("; ".join(f"{a} {t} {','.join(c)}".strip() for t, a, c in sorted(done)))
    return table.read().withColumn("steps", steps)


STREAM_MIGRATION_SQL = f"""
WITH {EVENTS_SQL},
middle AS (SELECT max(seq) // 2 AS m FROM feed),
noted AS (SELECT f.* EXCLUDE (diff), CASE WHEN pk % 2 = 0 AND seq > m THEN 'n' || seq END AS note, pk % 2 = 0 AND seq > m AS late, diff FROM feed f, middle),
first_late AS (SELECT min(seq) AS s FROM noted WHERE late),
widened AS (SELECT n.* EXCLUDE (diff), CASE WHEN seq = s THEN list_append(diff, 'note') ELSE diff END AS diff FROM noted n, first_late),
tail AS (SELECT * FROM (SELECT *, max(CASE WHEN op = 'DELETE' THEN seq END) OVER (PARTITION BY pk) AS ld FROM widened) WHERE ld IS NULL OR seq > ld)
SELECT pk, {", ".join(f"CASE WHEN count(*) FILTER (op <> 'UPDATE' OR list_contains(diff, '{c}')) > 0 THEN arg_max_null({c}, CASE WHEN op <> 'UPDATE' OR list_contains(diff, '{c}') THEN seq END) ELSE arg_min_null({c}, seq) END AS {c}" for c in [*COLUMNS, "note"])},
  'add_columns grown note; create plain' AS steps
FROM tail GROUP BY pk"""



def stream_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of even and odd users as two streams, each with batches from 0 on, into one table that is settled after each.

    The last batch of the first stream comes once more at the end and adds nothing.
    """
    place = f"{shared_dir(spark).rstrip('/')}/changeflow-stream-{uuid.uuid4().hex}"
    target, feed = user_target(spark, sf_dir).select("pk", *COLUMNS), event_feed(spark, sf_dir, _stream(spark, sf_dir))
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in target.schema)
    table = runner.LoggedTable(spark, f"{place}/table", ddl, feed.schema, lambda old, new: apply.changed_columns_upsert(old, new, "pk", COLUMNS, "seq"), "pk", BUCKETS)
    table.begin(target)
    for part in (0, 1):
        runner.start(feed.filter(F.col("pk") % 2 == part), table, f"{place}/checkpoint-{part}").awaitTermination()
        table.settle()
    (again, batch), *_ = table.ledger.last().items()
    runner.apply_batch(table, stream=again)(event_feed(spark, sf_dir).limit(3), batch)
    return table.read()


def stream_seen_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INSERTs of the feed, in eight micro-batches of a query that is stopped and started again twice, that an earlier one has written within a day."""
    place = f"{shared_dir(spark).rstrip('/')}/changeflow-stream-{uuid.uuid4().hex}"
    feed = event_feed(spark, sf_dir).select(F.lit("u").alias("table"), F.col("pk").alias("id"), "op", "seq", "ts")
    top = feed.agg(F.max("seq")).first()[0] or 0
    cuts = [-(-b * (top + 1) // 8) for b in range(9)]
    for b in range(8):
        feed.filter((F.col("seq") >= cuts[b]) & (F.col("seq") < cuts[b + 1])).repartition(1).write.mode("append").parquet(f"{place}/in")
        if b in (3, 5, 7):  # four batches, then two, then two
            stream = spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 1).parquet(f"{place}/in")
            seen.start(seen.with_seen(stream, "ts"), f"{place}/out", f"{place}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{place}/out").filter("op = 'INSERT'").select("id", "seq", "seen")


SEEN_SQL = events.SEEN_SQL.replace("seq // 500 AS flush FROM feed", "seq * 8 // (max(seq) OVER () + 1) AS flush FROM feed")


def change_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire lines in files, half of them compressed, through the change source in batches of a third, over a restart.

    What of the lines is good is logged; bad lines and events of the table ``user_event``, which has no schema, are set aside.
    """
    place = f"{shared_dir(spark).rstrip('/')}/changeflow-stream-{uuid.uuid4().hex}"
    lines = events.wire_json(spark, sf_dir)
    for kind, rest in (("none", 0), ("gzip", 1)):
        lines.filter(F.col("event_id") % 2 == rest).select("value").coalesce(4).write.mode("append").option("compression", kind).text(f"{place}/in")
    size = lines.agg(F.sum(F.octet_length("value"))).first()[0] or 1
    schema = "operation string, id string, table string, pk string"
    table = runner.LoggedTable(spark, f"{place}/table", "pk string", schema, lambda old, new: old, "pk", 2)
    versions = spark.createDataFrame([("event", "v1")], "table string, version string")
    for _ in range(2):
        read = source.stream(spark, f"{place}/in", f"{place}/state/source.json", max_bytes=size // 3 + 1, split_bytes=1 << 20)
        query = runner.begin(read, guard.sorting(runner.apply_batch(table), versions, f"{place}/aside"), f"{place}/checkpoint", every="0 seconds")
        query.processAllAvailable()
        query.stop()
    good = table.changes().select(F.lit("good").alias("why"), "id", F.col("table").alias("tbl"), "pk")
    aside = spark.read.parquet(f"{place}/aside/rows").select("why", "id", F.col("table").alias("tbl"), "pk")
    return good.unionByName(aside)


CHANGE_SOURCE_SQL = f"""
WITH {events.WIRE_SQL}, read AS (SELECT *, event_id % 50 = 0 AS cut, event_id % 70 = 0 AS bare FROM wire)
SELECT CASE WHEN cut THEN 'bad json' WHEN bare THEN 'no primary key' WHEN tbl = 'user_event' THEN 'unknown table' ELSE 'good' END AS why, CASE WHEN NOT cut THEN event_id::VARCHAR END AS id, CASE WHEN NOT cut THEN tbl END AS tbl,
  CASE WHEN cut OR bare THEN '' ELSE pk END AS pk FROM read"""

QUERIES = {f.__name__: f for f in (stream_apply_postgres, stream_apply_mysql, stream_migration, stream_two_sources, stream_seen_guard, change_source)}
ORACLES = {"stream_apply_postgres": changes.APPLY_POSTGRES_SQL, "stream_apply_mysql": changes.APPLY_MYSQL_SQL, "stream_migration": STREAM_MIGRATION_SQL, "stream_two_sources": changes.APPLY_POSTGRES_SQL, "stream_seen_guard": SEEN_SQL, "change_source": CHANGE_SOURCE_SQL}
