"""Queries that send data out and read it back, or through a choice made by name: registry, migrations, strategies, dry runs, a failed batch."""

from __future__ import annotations

import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import model
from ..functions import naming
from ..operators import apply, collapse, evolution, imports
from ..session import scratch, shared_dir
from ..sinks import destinations
from ..sources import catalog, registry, snapshot
from ..streaming import runner
from ..streaming.ledger import folder
from . import changes, events, schemas, streams
from .feeds import COLUMNS, event_feed, table, user_target


def update_strategies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target under each strategy of the warehouse, chosen by name; none is the standard one."""
    feed = changes._shuffled_dates(event_feed(spark, sf_dir))
    records = collapse.collapse(feed, ["pk"], "seq", COLUMNS).withColumnRenamed("last_seq", "seq")
    parts = [apply.by_strategy(s, user_target(spark, sf_dir), feed if s == "after" else records, "pk", COLUMNS, "seq", "ts").select(F.lit(s or "none").alias("strategy"), "pk", *COLUMNS) for s in ("", "standard", "after")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


STRATEGIES_SQL = " UNION ALL ".join(f"SELECT '{s}' AS strategy, pk, value, props, ts FROM ({sql})" for s, sql in (("none", changes._standard_sql()), ("standard", changes._standard_sql()), ("after", changes.APPLY_AFTER_SQL)))


def import_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of the tables that are asked for; a table is what users of one remainder by 50 send."""
    tabled = events.wire(spark, sf_dir).withColumn("table", F.concat(F.lit("t"), (F.col("user_id") % 50).cast("string")))
    return imports.of_tables(tabled, ["t3", "t7", "t30"]).select("event_id", F.col("table").alias("tbl"))


IMPORT_TABLES_SQL = "SELECT event_id, 't' || (user_id % 50) AS tbl FROM events WHERE user_id % 50 IN (3, 7, 30)"


def unknown_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of the feed that no version is known of: versions are those of customers' nations."""
    tabled = events.wire(spark, sf_dir).select(F.concat(F.lit("t"), (F.col("user_id") % 50).cast("string")).alias("table"))
    versions = table(spark, sf_dir, "customer").select(F.concat(F.lit("t"), F.col("c_nationkey").cast("string")).alias("table"), F.lit("v1").alias("version")).distinct()
    return snapshot.unknown_tables(tabled, versions).select(F.col("table").alias("tbl"))


UNKNOWN_SQL = "SELECT DISTINCT 't' || (user_id % 50) AS tbl FROM events WHERE user_id % 50 NOT IN (SELECT c_nationkey FROM customer)"


def schema_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schemas of the tables that parts stand for as JSON documents, one a table and version, some hundred a file, read back by the latest version."""
    rows = schemas.part_schemas(spark, sf_dir)
    items = F.when(F.col("enum"), F.struct(F.lit("string").alias("type"), F.array(F.lit("a"), F.lit("b")).alias("enum")))
    field = F.struct("column", F.struct("type", "format", "nullable", items.alias("items")))
    keys = F.sort_array(F.collect_list(F.when(F.col("is_pk"), F.struct("pk_place", "column"))))["column"]
    docs = rows.groupBy("table", "version").agg(F.collect_list(F.when(F.col("required"), F.col("column"))).alias("required"), keys.alias("primaryKeys"), F.map_from_entries(F.collect_list(field)).alias("properties"))
    text = F.to_json(F.struct("table", F.col("version").alias("modelVersion"), "required", "primaryKeys", "properties"))
    place = scratch(spark, "registry")
    files = rows.select("table", "version").distinct().count() // 100 + 1
    part = F.pmod(F.xxhash64("table", "version"), F.lit(files)).alias("part")
    listed = docs.groupBy(part).agg(F.concat(F.lit("["), F.array_join(F.collect_list(text), ","), F.lit("]")).alias("value"))
    listed.write.partitionBy("part").text(place)
    read = registry.read(spark, place)
    versions = read.groupBy("table").agg(F.max("version").alias("version"))
    return registry.latest(read, versions).select(F.col("table").alias("tbl"), "version", F.col("column").alias("col"), "type", "format", "nullable", "required", "is_pk", "pk_place", "enum")


REGISTRY_SQL = f"""WITH {schemas.PARTS_SQL}
SELECT "table" AS tbl, version, "column" AS col, type, format, nullable, required, is_pk, pk_place, enum FROM schemas s WHERE version = (SELECT max(version) FROM schemas o WHERE o."table" = s."table")"""


def migrate_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of a new database, created for version v1 and widened for v2, which also brings a table; columns as the catalog has them then.

    A table is a size of parts modulo 5, a column a brand; brands above 12 and the last table come with v2. Running both plans
    again changes nothing.
    """
    place = f"changeflow_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {place} LOCATION '{shared_dir(spark).rstrip('/')}/{place}'")
    brand, group = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int"), (F.col("p_size") % 5).cast("string")
    late = (brand > 12) | (group == "4")
    rows = table(spark, sf_dir, "part").select(F.concat(F.lit("g"), group).alias("table"), F.concat(F.lit("c"), brand.cast("string")).alias("column"), F.when(brand % 2 == 0, "number").otherwise("string").alias("type"), late.alias("late")).distinct()
    full = lambda r, v: r.select("table", F.lit(v).alias("version"), "column", "type", F.lit(None).cast("string").alias("format"), F.lit(True).alias("nullable"), F.lit(False).alias("required"), F.lit(False).alias("is_pk"), F.lit(None).cast("int").alias("pk_place"), F.lit(False).alias("enum"))
    steps = []
    for version, schema in (("v1", full(rows.filter("not late"), "v1")), ("v2", full(rows, "v2")), ("again", full(rows, "v2"))):
        plan = evolution.reconcile(schema, catalog.scan(spark, place))
        steps.append((version, len(evolution.migrate(spark, place, schema, plan))))
    there = catalog.scan(spark, place).select(F.col("table").alias("tbl"), F.col("column").alias("col"), "type")
    return there.withColumn("steps", F.lit(",".join(f"{v}:{n}" for v, n in steps)))


MIGRATE_SQL = """
WITH rows AS (SELECT DISTINCT p_size % 5 AS g, regexp_extract(p_brand, '([0-9]+)$', 1)::INT AS b FROM part),
marked AS (SELECT *, b > 12 OR g = 4 AS late FROM rows),
steps AS (SELECT 'v1:' || count(DISTINCT CASE WHEN NOT late THEN g END) || ',v2:' || count(DISTINCT CASE WHEN late THEN g END) || ',again:0' AS steps FROM marked)
SELECT 'g' || g AS tbl, 'c' || b AS col, CASE WHEN b % 2 = 0 THEN 'double' ELSE 'string' END AS type, steps FROM marked, steps"""


def dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two destinations would get: names and contents of objects; nothing is written."""
    good = model.decode(events.wire_json(spark, sf_dir)).filter("error is null")
    parts = [destinations.write(url, good, dry_run=True).select(F.lit(url.split(":")[0]).alias("scheme"), "path", "value") for url in ("file:///nowhere/at/all", "s3://bucket/some/prefix")]
    return parts[0].unionByName(parts[1])


_PATH = "tbl || '/' || (ms // 1000) || '-' || pk || '.json'"
DRY_SQL = f"""WITH {events.WIRE_SQL}, good AS (SELECT {_PATH} AS path, {events._TEXT} AS value FROM wire WHERE {events._GOOD})
SELECT 'file' AS scheme, path, value FROM good UNION ALL SELECT 's3', 'some/prefix/' || path, value FROM good"""


def mask_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of pages, every third with a user and a password, those with parameters with one more, twice."""
    extra = F.when(F.col("url").contains("?"), "&ref=b%2Fc&a=").otherwise("")
    url = F.concat("url", extra)
    url = F.when(F.col("page_id") % 3 == 0, F.replace(url, F.lit("://"), F.concat(F.lit("://u"), F.col("page_id").cast("string"), F.lit(":secret@")))).otherwise(url)
    return table(spark, sf_dir, "pages").select("page_id", naming.mask_url(url).alias("masked"))


def _mask_sql(x: str) -> str:
    return f"(({x})[1:length({x}) // 2] || repeat('*', length({x}) - length({x}) // 2))"


MASK_URLS_SQL = f"""
WITH cut AS (SELECT page_id, split_part(url, '#', 1) AS u FROM pages),
parts AS (SELECT page_id, split_part(u, '://', 1) AS scheme, split_part(split_part(split_part(u, '://', 2), '?', 1), '/', 1) AS host, split_part(split_part(u, '://', 2), '?', 1) AS place, split_part(u, '?', 2) AS q FROM cut),
paths AS (SELECT *, place[length(host) + 2:] AS path, CASE WHEN q <> '' THEN string_split(q, '&') ELSE []::VARCHAR[] END AS pairs FROM parts),
named AS (SELECT *, list_transform(list_filter(pairs, lambda p: NOT starts_with(p, 'ref=')), lambda p: split_part(p, '=', 1) || '=' || {_mask_sql("split_part(p, '=', 2)")}) AS others,
  coalesce(list_filter(pairs, lambda p: starts_with(p, 'ref='))[1][5:] || ',b/c', 'b/c') AS refs FROM paths)
SELECT page_id, scheme || '://' || CASE WHEN page_id % 3 = 0 THEN {_mask_sql("('u' || page_id)")} || ':sec***@' ELSE '' END || host || CASE WHEN path <> '' THEN '/' || {_mask_sql("path")} ELSE '' END
  || CASE WHEN q <> '' THEN '?' || array_to_string(list_sort(list_concat(others, ['a=', 'ref=' || {_mask_sql("refs")}])), '&') ELSE '' END AS masked FROM named"""


def stream_rollback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream whose first batch fails when half of its changes are logged, and that is started again: the table is that of one attempt."""
    place = scratch(spark, "stream")
    target, feed = user_target(spark, sf_dir).select("pk", *COLUMNS), event_feed(spark, sf_dir, streams._stream(spark, sf_dir))
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in target.schema)
    log = runner.LoggedTable(spark, f"{place}/table", ddl, feed.schema, lambda old, new: apply.changed_columns_upsert(old, new, "pk", COLUMNS, "seq"), "pk", streams.BUCKETS)
    log.begin(target)

    def half(rows: DataFrame, batch: int) -> None:
        rows.filter("seq % 2 = 0").write.parquet(f"{log.path}/changes/{folder(runner.stream_of(rows), batch)}")
        raise OSError("the destination is gone")

    try:
        runner.begin(feed, half, f"{place}/checkpoint").awaitTermination()
    except StreamingQueryException:
        left = len(log.pending())
    else:
        raise AssertionError("the batch was taken")
    runner.start(feed, log, f"{place}/checkpoint").awaitTermination()
    return log.read().withColumn("entered_before", F.lit(left))


ROLLBACK_SQL = f"SELECT *, 0 AS entered_before FROM ({changes.APPLY_POSTGRES_SQL})"

QUERIES = {f.__name__: f for f in (update_strategies, import_tables, unknown_tables, schema_registry, migrate_tables, dry_run, mask_urls, stream_rollback)}
ORACLES = {
    "update_strategies": STRATEGIES_SQL, "import_tables": IMPORT_TABLES_SQL, "unknown_tables": UNKNOWN_SQL, "schema_registry": REGISTRY_SQL, "migrate_tables": MIGRATE_SQL, "dry_run": DRY_SQL, "mask_urls": MASK_URLS_SQL,
    "stream_rollback": ROLLBACK_SQL,
}
