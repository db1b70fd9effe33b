"""Queries over decoded events: filters, projections, batching, metrics, sinks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import model
from ..functions import hashing, naming
from ..operators import batches, filters, imports, state
from ..operators.validate import Rules
from ..sinks import messages
from ..sources import generator
from .feeds import EVENTS_SQL, ORDERS_SQL, event_feed, order_feed, table

#: Events as wire JSON: tables user_event and event, keys [region, user], images with a property that no schema has.
WIRE_SQL = """wire AS (
  SELECT event_id, user_id, ts, event_type, value, props, CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS op,
    CASE WHEN user_id % 3 = 0 THEN 'user_event' ELSE 'event' END AS tbl, 'c' || (user_id % 4) AS company, CASE WHEN user_id % 5 <> 0 THEN 'l' || (user_id % 5) END AS location,
    (user_id * 1000 + event_id)::VARCHAR AS pk, epoch_us(ts) // 1000 AS ms FROM events)"""


def wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "*", F.when(kind == "signup", "INSERT").when(kind == "error", "DELETE").otherwise("UPDATE").alias("op"), F.when(F.col("user_id") % 3 == 0, "user_event").otherwise("event").alias("tbl"),
        F.concat(F.lit("c"), (F.col("user_id") % 4).cast("string")).alias("company"), F.when(F.col("user_id") % 5 != 0, F.concat(F.lit("l"), (F.col("user_id") % 5).cast("string"))).alias("location"),
        (F.col("user_id") * 1000 + F.col("event_id")).cast("string").alias("pk"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"),
    )


def wire_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON text an event; every 50th is cut short, every 70th has neither key nor id."""
    w = wire(spark, sf_dir)
    bare = F.col("event_id") % 70 == 0
    image = F.to_json(F.struct(F.when(~bare, F.col("pk")).alias("id"), F.col("event_type").alias("kind"), F.col("event_id").cast("string").alias("extra")))
    text = F.to_json(F.struct(
        F.col("op").alias("operation"), F.col("event_id").cast("string").alias("id"), F.col("tbl").alias("table"), F.when(~bare & (F.col("event_id") % 2 == 0), F.array(F.lit("r1"), F.col("pk"))).alias("key"),
        F.lit("v1").alias("modelVersion"), F.col("company").alias("companyId"), F.col("location").alias("locationId"), image.alias("after"), F.col("ms").alias("timestamp"), F.col("ms").cast("string").alias("mvccTimestamp"), F.lit("x").alias("region"),
    ))
    return w.select("event_id", F.when(F.col("event_id") % 50 == 0, F.substring(text, 1, 20)).otherwise(text).alias("value"))


def decode_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line, good or bad, with what was read of it."""
    d = model.decode(wire_json(spark, sf_dir))
    return d.select("id", F.col("table").alias("tbl"), F.col("operation").alias("op"), "error", "pk", F.try_element_at("object", F.lit("kind")).alias("kind"), "companyId", "locationId", "timestamp", F.array_join("key", "/").alias("key"))


DECODE_SQL = f"""
WITH {WIRE_SQL},
read AS (SELECT *, event_id % 50 = 0 AS cut, event_id % 70 = 0 AS bare FROM wire)
SELECT CASE WHEN NOT cut THEN event_id::VARCHAR END AS id, CASE WHEN NOT cut THEN tbl END AS tbl, CASE WHEN NOT cut THEN op END AS op, CASE WHEN cut THEN 'bad json' WHEN bare THEN 'no primary key' END AS error,
  CASE WHEN cut OR bare THEN '' ELSE pk END AS pk, CASE WHEN NOT cut THEN event_type END AS kind, CASE WHEN NOT cut THEN company END AS "companyId", CASE WHEN NOT cut THEN location END AS "locationId", CASE WHEN NOT cut THEN ms END AS timestamp,
  CASE WHEN NOT cut AND NOT bare AND event_id % 2 = 0 THEN 'r1/' || pk END AS key FROM read"""


def primary_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = model.decode(wire_json(spark, sf_dir)).filter("error is null")
    return d.select(F.col("id").cast("long").alias("event_id"), "pk")


PRIMARY_KEY_SQL = f"WITH {WIRE_SQL} SELECT event_id, pk FROM wire WHERE event_id % 50 <> 0 AND event_id % 70 <> 0"


def omit_unknown_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = model.decode(wire_json(spark, sf_dir)).filter("error is null")
    kept = filters.known_properties(F.col("object"), F.array(F.lit("id"), F.lit("kind")), F.col("operation"))
    return d.select(F.col("id").cast("long").alias("event_id"), F.array_join(F.array_sort(F.map_keys(kept)), ",").alias("keys"))


OMIT_SQL = f"WITH {WIRE_SQL} SELECT event_id, CASE WHEN op = 'DELETE' THEN 'extra,id,kind' ELSE 'id,kind' END AS keys FROM wire WHERE event_id % 50 <> 0 AND event_id % 70 <> 0"


def batch_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = filters.batch_records(model.decode(wire_json(spark, sf_dir)).filter("error is null"))
    return r.select(F.col("table").alias("tbl"), "id", "op", F.element_at("object", "kind").alias("kind"), F.col("event.companyId").alias("company"))


BATCH_SQL = f"WITH {WIRE_SQL} SELECT tbl, pk AS id, op, event_type AS kind, company FROM wire WHERE event_id % 50 <> 0 AND event_id % 70 <> 0"


def filter_export_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table ``event`` was exported at its median event; ``user_event`` never."""
    w = wire(spark, sf_dir)
    marks = w.filter("tbl = 'event'").groupBy("tbl").agg(F.max(F.when(F.col("event_id") % 3 == 0, F.col("ts"))).alias("late"), F.min("ts").alias("early"))
    marks = marks.select(F.col("tbl").alias("table"), F.expr("early + (late - early) / 2").alias("export_ts"))
    return filters.after_export(w, marks, table="tbl").select("event_id", "tbl")


EXPORT_FILTER_SQL = f"""
WITH {WIRE_SQL}, mark AS (SELECT tbl, min(ts) + (max(CASE WHEN event_id % 3 = 0 THEN ts END) - min(ts)) / 2 AS export_ts FROM wire WHERE tbl = 'event' GROUP BY tbl)
SELECT event_id, w.tbl FROM wire w LEFT JOIN mark m ON m.tbl = w.tbl WHERE export_ts IS NULL OR ts >= export_ts"""


def filter_tenant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.of_tenants(wire(spark, sf_dir), ["c1", "c3"], ["c0", "c1", "c3"], "company").select("event_id", "company")


TENANT_SQL = f"WITH {WIRE_SQL} SELECT event_id, company FROM wire WHERE company IN ('c1', 'c3')"


def filter_time_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.updated_after(table(spark, sf_dir, "orders"), "o_orderdate", datetime(1996, 1, 1)).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


OFFSET_SQL = "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY 1"


def skip_trivial_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.without_trivial_updates(order_feed(spark, sf_dir)).select("pk", "seq", "op")


TRIVIAL_SQL = f"WITH {ORDERS_SQL} SELECT pk, seq, op FROM feed WHERE NOT (op = 'UPDATE' AND (len(diff) = 0 OR diff = ['updatedDate'] OR diff = ['updatedDate', 'meta']))"


def effective_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = filters.effective_diff(F.col("diff"), F.array(F.lit("o_totalprice"), F.lit("updatedDate"), F.lit("id")))
    return order_feed(spark, sf_dir).select("seq", F.array_join(d, ",").alias("diff"))


EFFECTIVE_SQL = f"WITH {ORDERS_SQL} SELECT seq, array_to_string(list_filter(diff, lambda d: d IN ('o_totalprice', 'updatedDate')), ',') AS diff FROM feed"


def widen_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_feed(spark, sf_dir).select("seq", F.array_join(filters.widened_diff(F.col("diff"), F.array(F.lit("meta"), F.lit("added"))), ",").alias("diff"))


WIDEN_SQL = f"WITH {ORDERS_SQL} SELECT seq, array_to_string(list_concat(diff, list_filter(['meta', 'added'], lambda d: NOT list_contains(diff, d))), ',') AS diff FROM feed"


def flush_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.flush_batches(event_feed(spark, sf_dir), "seq", batches.flush_limit(25_000, 40), ["pk"]).groupBy("pk", "batch_id").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seq"))


FLUSH_SQL = f"WITH {EVENTS_SQL} SELECT pk, batch_id, count(*) AS n, min(seq) AS first_seq FROM (SELECT *, (row_number() OVER (PARTITION BY pk ORDER BY seq) - 1) // 40 AS batch_id FROM feed) GROUP BY 1, 2"


def sequence_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers of orders after every fifth line was lost."""
    lines = table(spark, sf_dir, "lineitem").filter("(l_orderkey + l_linenumber) % 5 <> 0").select("l_orderkey", "l_linenumber").distinct()
    return batches.sequence_gaps(lines, "l_linenumber", ["l_orderkey"]).select("l_orderkey", "l_linenumber", "expected")


GAPS_SQL = """
WITH kept AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE (l_orderkey + l_linenumber) % 5 <> 0)
SELECT l_orderkey, l_linenumber, expected FROM (SELECT *, lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) + 1 AS expected FROM kept) WHERE l_linenumber <> expected"""


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wire(spark, sf_dir).select(F.col("tbl").alias("table"), F.col("ts").alias("file_ts"), F.concat(F.col("tbl"), F.lit("-"), (F.col("event_id") % 7).cast("string")).alias("file"))


def export_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    cursors = table(spark, sf_dir, "region").select(F.col("r_name").alias("table"), F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("cursor_ts"))
    return batches.export_watermark(_files(spark, sf_dir), cursors).withColumnRenamed("table", "tbl")


WATERMARK_SQL = f"WITH {WIRE_SQL} SELECT tbl, max(ts) AS export_ts FROM wire GROUP BY tbl UNION ALL SELECT r_name, TIMESTAMP '2024-01-01' FROM region"


def start_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the exports' watermarks, with everything asked for, and without any export."""
    marks = batches.export_watermark(_files(spark, sf_dir))
    cases = {"exports": batches.start_position(marks), "all": batches.start_position(marks, deliver_all=True), "none": batches.start_position(marks.filter("false"))}
    out = [df.withColumn("given", F.lit(k)) for k, df in cases.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


START_SQL = f"""WITH {WIRE_SQL} SELECT 'exports' AS given, 'by_start_time' AS policy, min(m) AS start_ts FROM (SELECT max(ts) AS m FROM wire GROUP BY tbl)
UNION ALL SELECT 'all', 'all', NULL UNION ALL SELECT 'none', 'new', NULL"""


def export_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey") % 5
    return batches.export_progress(table(spark, sf_dir, "nation").select(F.when(n < 3, "Completed").when(n == 3, "Pending").otherwise("Failed").alias("status")))


PROGRESS_SQL = """
SELECT count(*) AS total, count(*) FILTER (k < 3) AS completed, count(*) FILTER (k = 3) AS pending, count(*) FILTER (k = 4) AS failed, round(100.0 * count(*) FILTER (k < 3) / count(*), 4) AS percent
FROM (SELECT n_nationkey % 5 AS k FROM nation)"""


def import_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.import_counts(_files(spark, sf_dir).withColumnRenamed("table", "tbl"), "tbl", "file")


COUNTS_SQL = f"WITH {WIRE_SQL}, files AS (SELECT tbl, tbl || '-' || (event_id % 7) AS file FROM wire) SELECT tbl, file, count(*) AS n FROM files GROUP BY ROLLUP (tbl, file)"


#: Which values are put into which set of bounds: events' values as flush counts, thousandths of them as durations.
_SETS = {"flush_count": (batches.FLUSH_COUNTS, 1), "flush_seconds": (batches.FLUSH_SECONDS, 1000), "processing_seconds": (batches.PROCESSING_SECONDS, 10)}


def metric_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = []
    for name, (bounds, unit) in _SETS.items():
        values = table(spark, sf_dir, "events").select("event_type", (F.col("value") / unit).alias("v"))
        h = batches.histogram(values, "v", bounds, ["event_type"])
        parts.append(h.select(F.lit(name).alias("metric"), "event_type", "le", "n", F.col("count").alias("n_all"), F.round("sum", 4).alias("total")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


HISTOGRAM_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS metric, event_type, le::DOUBLE AS le, count(*) FILTER (value / {unit} <= le) AS n, count(value) AS n_all, round(sum(value / {unit}), 4) AS total FROM events, (SELECT unnest({[float(b) for b in bounds]}) AS le) GROUP BY event_type, le"
    for name, (bounds, unit) in _SETS.items()
)


def running_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    flushes = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderkey") % 97).alias("ms"), (F.col("o_orderkey") % 13 + 1).alias("n"))
    return batches.running_average(flushes, "ms", "n", "o_orderkey", ["o_custkey"]).select("o_custkey", "o_orderkey", "mean")


AVERAGE_SQL = "SELECT o_custkey, o_orderkey, sum(o_orderkey % 97) OVER w / sum(o_orderkey % 13 + 1) OVER w AS mean FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING)"


def seen_insert_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = event_feed(spark, sf_dir).select(F.lit("u").alias("table"), F.col("pk").alias("id"), "op", "seq", "ts", F.floor(F.col("seq") / 500).cast("long").alias("flush"))
    return batches.seen_insert_guard(feed, "flush", "ts").filter("op = 'INSERT'").select("id", "seq", "seen")


SEEN_SQL = f"""
WITH {EVENTS_SQL}, f AS (SELECT *, seq // 500 AS flush FROM feed),
touched AS (SELECT pk, flush, max(ts) FILTER (op IN ('INSERT', 'DELETE')) AS t, bool_or(op = 'DELETE') AS gone FROM f GROUP BY 1, 2),
marks AS (SELECT * FROM touched WHERE t IS NOT NULL),
last AS (SELECT f.pk, f.seq, max(m.flush) AS flush FROM f JOIN marks m ON m.pk = f.pk AND m.flush < f.flush WHERE op = 'INSERT' GROUP BY 1, 2)
SELECT f.pk AS id, f.seq, coalesce(NOT m.gone AND m.t > f.ts - INTERVAL 24 HOURS, false) AS seen
FROM f LEFT JOIN last l ON l.pk = f.pk AND l.seq = f.seq LEFT JOIN marks m ON m.pk = l.pk AND m.flush = l.flush WHERE op = 'INSERT'"""


def eventhub_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider batches: runs of equal partition keys, in order of arrival, in each of 8 replayed streams."""
    rows = wire(spark, sf_dir).withColumn("stream", F.col("user_id") % 8)
    rows = messages.eventhub_batches(rows, F.col("tbl"), F.col("company"), F.col("location"), F.col("user_id").cast("string"), "event_id", ["stream"])
    return rows.groupBy("stream", "batch", "partition_key").agg(F.count(F.lit(1)).alias("n"))


HUB_SQL = f"""
WITH {WIRE_SQL}, k AS (SELECT event_id, user_id % 8 AS stream, tbl || '.' || company || '.' || coalesce(location, 'NONE') || '.' || user_id AS partition_key FROM wire),
m AS (SELECT *, CASE WHEN lag(partition_key) OVER (PARTITION BY stream ORDER BY event_id) = partition_key THEN 0 ELSE 1 END AS new FROM k),
r AS (SELECT *, sum(new) OVER (PARTITION BY stream ORDER BY event_id)::BIGINT AS batch FROM m)
SELECT stream, batch, partition_key, count(*) AS n FROM r GROUP BY 1, 2, 3"""


def file_sink_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that stay: the last event of each second and key (keys cut to users, so that some overwrite others)."""
    rows = wire(spark, sf_dir).withColumn("path", naming.file_path(F.col("tbl"), F.col("ms") - F.col("ms") % 60000, F.col("user_id").cast("string")))
    return messages.last_writer(rows, "path", "event_id", ["event_id"]).select("path", "event_id")


FILE_SQL = f"WITH {WIRE_SQL} SELECT tbl || '/' || ((ms - ms % 60000) // 1000) || '-' || user_id || '.json' AS path, max(event_id) AS event_id FROM wire GROUP BY 1"


def object_sink_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = F.when(F.col("event_id") % 10 == 0, F.concat(F.lit("ok/"), F.col("pk")))
    return wire(spark, sf_dir).select("event_id", naming.object_key("withprefix/", F.col("tbl"), F.col("ms"), F.col("pk"), valid).alias("object_key"))


OBJECT_SQL = f"WITH {WIRE_SQL} SELECT event_id, 'withprefix/' || CASE WHEN event_id % 10 = 0 THEN 'ok/' || pk ELSE tbl || '/' || (ms // 1000) || '-' || pk || '.json' END AS object_key FROM wire"


def partition_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wire(spark, sf_dir).select("event_id", naming.partition_key(F.col("tbl"), F.col("company"), F.col("location"), F.col("pk")).alias("partition_key"))


PARTITION_KEY_SQL = f"WITH {WIRE_SQL} SELECT event_id, tbl || '.' || company || '.' || coalesce(location, 'NONE') || '.' || pk AS partition_key FROM wire"


def kafka_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = model.decode(wire_json(spark, sf_dir)).filter("error is null")
    m = messages.kafka(d, partitions=12)
    return m.select(F.col("key").cast("string").alias("key"), F.element_at("headers", 1)["value"].cast("string").alias("header"), F.col("value").cast("string").alias("value"))


_HEADER = "tbl || '.' || company || '.' || coalesce(location, 'NONE') || '.' || pk"
_KEY = "'dbchange.' || tbl || '.' || op || '.' || company || '.' || coalesce(location, 'NONE') || '.' || event_id"
_GOOD = "event_id % 50 <> 0 AND event_id % 70 <> 0"
#: An event as it is written: optional fields only where they are set, the row image as JSON text in a text.
_TEXT = """'{"operation":"' || op || '","id":"' || event_id || '","table":"' || tbl || '"' || CASE WHEN event_id % 2 = 0 THEN ',"key":["r1","' || pk || '"]' ELSE '' END || ',"modelVersion":"v1","companyId":"' || company || '"'
  || CASE WHEN location IS NOT NULL THEN ',"locationId":"' || location || '"' ELSE '' END || ',"after":"{\\"id\\":\\"' || pk || '\\",\\"kind\\":\\"' || event_type || '\\",\\"extra\\":\\"' || event_id || '\\"}","timestamp":' || ms || ',"mvccTimestamp":"' || ms || '"}'"""
KAFKA_SQL = f"WITH {WIRE_SQL} SELECT {_KEY} AS key, {_HEADER} AS header, {_TEXT} AS value FROM wire WHERE {_GOOD}"


def kafka_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = model.decode(wire_json(spark, sf_dir)).filter("error is null")
    return messages.kafka(d, partitions=12).select(F.col("key").cast("string").alias("key"), "partition")


_TWO64 = "18446744073709551616::UHUGEINT"
#: Constants of the published XXH64 (fixed values).
_XX = [11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261]


def _times(a: str, b: str | int) -> str:
    return f"(({a})::UHUGEINT * ({b})::UHUGEINT % {_TWO64})::UBIGINT"


def _plus(a: str, b: int) -> str:
    return f"((({a})::UHUGEINT + {b}::UHUGEINT) % {_TWO64})::UBIGINT"


def _rotated(x: str, r: int) -> str:
    return f"({_times(x, 1 << r)} | (({x}) >> {64 - r}))"


def xxh64_sql(source: str, key: str, text: str) -> str:
    """CTEs that end with ``hashed`` (key, h): XXH64, seed 0, of texts of fewer than 32 bytes, from its published definition."""
    p1, p2, p3, p4, p5 = _XX
    number = lambda n, at: "('0x' || " + " || ".join(f"substr(x, (2 * {at} + {2 * j + 1})::INT, 2)" for j in range(n - 1, -1, -1)) + ")::UBIGINT"
    eight = f"list_transform(range(n // 8), lambda i: {number(8, '(8 * i)')})"
    rest = f"list_transform(range(n // 4 * 4, n), lambda i: {number(1, 'i')})"
    step8 = _plus(_times(_rotated(f"xor(a, {_times(_rotated(_times('k', p2), 31), p1)})", 27), p1), p4)
    step4 = _plus(_times(_rotated(f"xor(a, {_times('k', p1)})", 23), p2), p3)
    step1 = _times(_rotated(f"xor(a, {_times('k', p5)})", 11), p1)
    shifted = lambda c, r: f"xor({c}, {c} >> {r})"
    return f"""raw AS (SELECT {key} AS key, hex(encode({text})) AS x, octet_length(encode({text})) AS n FROM {source}),
by_eight AS (SELECT *, list_reduce(list_prepend(({p5} + n)::UBIGINT, {eight}), lambda a, k: {step8}) AS a FROM raw),
fours AS (SELECT key, x, n, a, CASE WHEN n % 8 >= 4 THEN {number(4, '(n // 8 * 8)')} END AS k FROM by_eight),
by_four AS (SELECT key, x, n, CASE WHEN k IS NULL THEN a ELSE {step4} END AS a FROM fours),
by_one AS (SELECT key, list_reduce(list_prepend(a, {rest}), lambda a, k: {step1}) AS a FROM by_four),
m1 AS (SELECT key, {_times(shifted('a', 33), p2)} AS a FROM by_one),
m2 AS (SELECT key, {_times(shifted('a', 29), p3)} AS a FROM m1),
hashed AS (SELECT key, lower(to_hex({shifted('a', 32)})) AS h FROM m2)"""


_FNV = "list_reduce(list_prepend(2166136261::BIGINT, list_transform(range(1, length({t}) + 1), lambda i: ascii({t}[i:i])::BIGINT)), lambda a, b: (xor(a, b) * 16777619) & 4294967295)"
PARTITION_SQL = f"WITH {WIRE_SQL}, good AS (SELECT {_KEY} AS k, {_HEADER} AS header FROM wire WHERE {_GOOD}), {xxh64_sql('good', 'k', 'header')} SELECT key, ({_FNV.format(t='h')} % 12)::INT AS partition FROM hashed"


def hash64(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", hashing.hash64(F.col("c_name")).alias("hash"))


HASH_SQL = f"WITH {xxh64_sql('customer', 'c_custkey', 'c_name')} SELECT key AS c_custkey, h AS hash FROM hashed"


def eventhub_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows for the provider, with tenants in the row image that differ from the envelope's."""
    d = model.decode(wire_json(spark, sf_dir)).filter("error is null")
    n = F.col("id").cast("long")
    tenants = F.create_map(F.lit("companyId"), F.concat(F.lit("k"), (n % 3).cast("string")), F.lit("locationId"), F.when(n % 2 == 0, F.lit("here")).otherwise(""))
    m = messages.eventhub(d.withColumn("object", F.map_concat("object", tenants)))
    return m.select("message_id", "content_type", F.element_at("properties", "objectId").alias("object_id"), "partition_key", F.col("body").cast("string").alias("body"))


_TENANTS = "'k' || (event_id % 3) || '.' || CASE WHEN event_id % 2 = 0 THEN 'here' ELSE 'NONE' END || '.' || pk"
HUB_ROWS_SQL = f"WITH {WIRE_SQL} SELECT event_id::VARCHAR AS message_id, 'application/json' AS content_type, 'dbchange.' || tbl || '.' || op || '.' || {_TENANTS} AS object_id, tbl || '.' || {_TENANTS} AS partition_key, {_TEXT} AS body FROM wire WHERE {_GOOD}"


GENERATED = {"seed": 7, "now": 1_720_000_000, "shift_days": -30}


def generated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One made-up change for each customer of the table, with dates a month back."""
    made = generator.customer_updates(table(spark, sf_dir, "customer"), "c_custkey", **GENERATED)
    image = F.from_json("after", "firstName string, email string, taxExempt boolean, orderCount long, discountPercent double, paymentTermId string, createdDate string, dotNumber string, lastTimeOrderWorked string, locationIds array<string>")
    rows = made.withColumn("i", image)
    return rows.select(F.element_at("key", 1).alias("pk"), "companyId", "timestamp", "mvccTimestamp", F.size("i.locationIds").cast("long").alias("locations"), *[f"i.{c}" for c in ("firstName", "email", "taxExempt", "orderCount", "discountPercent", "paymentTermId", "createdDate", "dotNumber", "lastTimeOrderWorked")])


def _draw(field: str, below: int) -> str:
    return f"(('0x' || substr(md5('{GENERATED['seed']}:' || c_custkey || ':{field}'), 1, 8))::BIGINT % {below})"


_NOW = GENERATED["now"] + GENERATED["shift_days"] * 86_400
_CREATED = f"({_NOW} - {_draw('createdDate', generator.YEAR)})"
_ISO = "strftime(make_timestamp(({}) * 1000000), '%Y-%m-%dT%H:%M:%SZ')"
GENERATED_SQL = f"""
SELECT 'customer' || c_custkey AS pk, 'company' || {_draw('companyId', 4)} AS "companyId", {_NOW * 1000}::BIGINT AS timestamp, ({_NOW * 10**9} + c_custkey)::VARCHAR AS "mvccTimestamp", CASE WHEN {_draw('locationIds?', 100)} < 50 THEN 2 ELSE 1 END::BIGINT AS locations,
  'FirstName' || {_draw('firstName', 1000)} AS "firstName", 'user' || {_draw('email', 10_000)} || '@example.com' AS email, {_draw('taxExempt?', 100)} < 20 AS "taxExempt", {_draw('orderCount', 100)} AS "orderCount", {_draw('discountPercent', 2500)} / 100 AS "discountPercent",
  regexp_replace(md5('{GENERATED['seed']}:' || c_custkey || ':paymentTermId'), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})', '\\1-\\2-\\3-\\4-') AS "paymentTermId", {_ISO.format(_CREATED)} AS "createdDate",
  CASE WHEN {_draw('customerType', 2)} = 1 THEN lpad({_draw('dotNumber', 1_000_000)}::VARCHAR, 6, '0') END AS "dotNumber",
  CASE WHEN {_draw('lastTimeOrderWorked?', 100)} < 70 THEN {_ISO.format(f"{_CREATED} + floor({_draw('lastTimeOrderWorked', 10_000)} * ({_NOW} - {_CREATED}) / 10000)::BIGINT")} END AS "lastTimeOrderWorked" FROM customer"""

#: A rule with every kind of keyword that events of table ``event`` have to pass, and where they go.
RULES = {"event": {"schema": "event.json", "path": "{{.table}}/{{.operation}}/{{ .id }}.json"}}
DOCUMENTS = {
    "base.json": {"type": "object", "properties": {"operation": {"enum": ["INSERT", "UPDATE"]}, "timestamp": {"type": "integer", "minimum": 1}}, "required": ["operation", "timestamp"]},
    "event.json": {
        "allOf": [{"$ref": "file:///base.json"}], "required": ["table", "after"],
        "properties": {"table": {"const": "event"}, "after": {"type": "object", "required": ["id", "kind"], "properties": {"kind": {"type": "string", "enum": ["click", "view", "signup"]}, "extra": {"type": "string", "minLength": 3, "pattern": "[0-6]$"}, "id": True}, "additionalProperties": False}},
        "oneOf": [{"properties": {"companyId": {"pattern": "^c[01]"}}}, {"properties": {"companyId": {"enum": ["c1", "c2"]}}}],
        "anyOf": [{"properties": {"operation": {"const": "INSERT"}}}, {"properties": {"locationId": {"type": "string", "minLength": 1}}, "required": ["locationId"]}],
    },
}


def validate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that the rule of their table accepts, with their path; tables without a rule have none."""
    d = model.decode(wire_json(spark, sf_dir)).filter("error is null")
    return Rules(rules=RULES, documents=DOCUMENTS).validate(d).select(F.col("id").cast("long").alias("event_id"), F.col("validated_path").alias("path"))


VALIDATE_SQL = f"""WITH {WIRE_SQL} SELECT event_id, 'event/' || op || '/' || event_id || '.json' AS path FROM wire
WHERE {_GOOD} AND tbl = 'event' AND op IN ('INSERT', 'UPDATE') AND event_type IN ('click', 'view', 'signup') AND length(event_id::VARCHAR) >= 3 AND (op = 'INSERT' OR location IS NOT NULL) AND event_id % 10 <= 6 AND company IN ('c0', 'c2')"""


def export_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that an export of some tables, companies and places gives, from a time on."""
    w = imports.of_tables(wire(spark, sf_dir), ["event"], "tbl")
    return imports.exported(w, ["c1", "c2"], ["l1", "l3"], datetime(2024, 1, 15), "company", "location", "ts").select("event_id", "company", "location")


EXPORTED_SQL = f"WITH {WIRE_SQL} SELECT event_id, company, location FROM wire WHERE tbl = 'event' AND company IN ('c1', 'c2') AND location IN ('l1', 'l3') AND ts >= TIMESTAMP '2024-01-15'"


def import_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imports.totals(wire(spark, sf_dir).select(F.col("tbl").alias("table"), F.col("event_id").alias("size")))


TOTALS_SQL = f"WITH {WIRE_SQL} SELECT count(DISTINCT tbl) AS tables, count(*) AS files, sum(event_id)::BIGINT AS bytes FROM wire"


def fnv_modulo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", hashing.fnv1a32(F.col("c_name")).alias("fnv"), hashing.modulo(F.col("c_name"), 10).alias("place"))


FNV_SQL = """
WITH h AS (SELECT c_custkey, list_reduce(list_prepend(2166136261::BIGINT, list_transform(range(1, length(c_name) + 1), lambda i: ascii(c_name[i:i])::BIGINT)), lambda a, b: (xor(a, b) * 16777619) & 4294967295) AS fnv FROM customer)
SELECT c_custkey, fnv, (fnv % 10)::INT AS place FROM h"""


def validated_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = naming.path_template("{{.tbl}}/received/{{.tbl}}_{{.ms}}_{{ .event_id }}.json", F.col)
    return wire(spark, sf_dir).select("event_id", t.alias("path"))


PATH_SQL = f"WITH {WIRE_SQL} SELECT event_id, tbl || '/received/' || tbl || '_' || ms || '_' || event_id || '.json' AS path FROM wire"


def mask_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    mail = F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.co.uk"))
    return table(spark, sf_dir, "customer").select("c_custkey", naming.mask_email(mail).alias("masked"))


MASK_SQL = """
WITH m AS (SELECT c_custkey, lower(replace(c_name, '#', '.')) AS n FROM customer)
SELECT c_custkey, n[1:length(n) // 2] || repeat('*', length(n) - length(n) // 2) || '@exa****.co.uk' AS masked FROM m"""


def table_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = wire(spark, sf_dir).select(F.col("tbl").alias("table"), "event_id", F.concat(F.lit("v"), (F.col("event_id") % 6).cast("string")).alias("modelVersion"))
    return state.table_versions(w, "event_id").withColumnRenamed("table", "tbl")


VERSIONS_SQL = f"WITH {WIRE_SQL} SELECT tbl, arg_max('v' || (event_id % 6), event_id) AS version FROM wire GROUP BY tbl"


def _state(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    c = table(spark, sf_dir, "customer")
    key = F.concat(F.lit("registry:"), F.col("c_mktsegment"), F.lit("-"), F.col("c_custkey").cast("string"))
    old = c.select(key.alias("key"), F.col("c_name").alias("value"), F.lit(None).cast("timestamp_ntz").alias("expires_at"))
    new = c.filter("c_custkey % 3 = 0").select(F.when(F.col("c_custkey") % 2 == 0, key).otherwise(F.concat(F.lit("new:"), key)).alias("key"), F.lit("changed").alias("value"), F.lit(datetime(2030, 1, 1)).cast("timestamp_ntz").alias("expires_at"))
    return old, new


def state_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.upsert(*_state(spark, sf_dir))


_STATE_SQL = """old AS (SELECT 'registry:' || c_mktsegment || '-' || c_custkey AS key, c_name AS value, c_custkey FROM customer),
new AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN key ELSE 'new:' || key END AS key, 'changed' AS value, TIMESTAMP '2030-01-01' AS expires_at FROM old WHERE c_custkey % 3 = 0)"""
UPSERT_SQL = f"WITH {_STATE_SQL} SELECT key, value, NULL::TIMESTAMP AS expires_at FROM old WHERE key NOT IN (SELECT key FROM new) UNION ALL SELECT key, value, expires_at FROM new"


def state_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left on the day before changed entries expire, and on the day itself."""
    whole = state.upsert(*_state(spark, sf_dir))
    days = [state.read(whole, datetime(*day)).select(F.lit(name).alias("day"), "key", "value") for name, day in (("before", (2029, 12, 31)), ("after", (2030, 1, 1)))]
    return days[0].unionByName(days[1])


READ_SQL = f"SELECT 'before' AS day, key, value FROM ({UPSERT_SQL}) UNION ALL SELECT 'after', key, value FROM ({UPSERT_SQL}) WHERE expires_at IS NULL"


def state_delete_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.delete_prefix(state.upsert(*_state(spark, sf_dir)), "registry:BUILDING")


PREFIX_SQL = f"SELECT * FROM ({UPSERT_SQL}) WHERE NOT starts_with(key, 'registry:BUILDING')"

QUERIES = {f.__name__: f for f in (
    decode_events, primary_key, omit_unknown_properties, batch_records, filter_export_watermark, filter_tenant, filter_time_offset, skip_trivial_updates, effective_diff, widen_diff, flush_batches, sequence_gaps,
    export_watermark, start_position, export_progress, import_counts, metric_histogram, running_average, seen_insert_guard, eventhub_batches, file_sink_paths, object_sink_keys, partition_key, kafka_messages,
    kafka_partition, hash64, fnv_modulo, validated_path, mask_email, table_versions, state_upsert, state_delete_prefix, state_read, eventhub_messages, generated_events, validate_events, export_filters, import_totals,
)}
ORACLES = {
    "decode_events": DECODE_SQL, "primary_key": PRIMARY_KEY_SQL, "omit_unknown_properties": OMIT_SQL, "batch_records": BATCH_SQL, "filter_export_watermark": EXPORT_FILTER_SQL, "filter_tenant": TENANT_SQL, "filter_time_offset": OFFSET_SQL,
    "skip_trivial_updates": TRIVIAL_SQL, "effective_diff": EFFECTIVE_SQL, "widen_diff": WIDEN_SQL, "flush_batches": FLUSH_SQL, "sequence_gaps": GAPS_SQL, "export_watermark": WATERMARK_SQL, "start_position": START_SQL,
    "export_progress": PROGRESS_SQL, "import_counts": COUNTS_SQL, "metric_histogram": HISTOGRAM_SQL, "running_average": AVERAGE_SQL, "seen_insert_guard": SEEN_SQL, "eventhub_batches": HUB_SQL, "file_sink_paths": FILE_SQL,
    "object_sink_keys": OBJECT_SQL, "partition_key": PARTITION_KEY_SQL, "kafka_messages": KAFKA_SQL, "fnv_modulo": FNV_SQL, "validated_path": PATH_SQL, "mask_email": MASK_SQL, "table_versions": VERSIONS_SQL,
    "state_upsert": UPSERT_SQL, "state_delete_prefix": PREFIX_SQL, "state_read": READ_SQL, "kafka_partition": PARTITION_SQL, "hash64": HASH_SQL, "eventhub_messages": HUB_ROWS_SQL, "generated_events": GENERATED_SQL, "validate_events": VALIDATE_SQL,
    "export_filters": EXPORTED_SQL, "import_totals": TOTALS_SQL,
}
