"""Snapshot files of table exports: names, scans and conversion to INSERT events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import hash64
from ..model import INSERT, parse_object
from ..operators.filters import small

#: <33 digits of time>-<session>-<n>-<n>-<hex>-<table>-<schema id>.ndjson.gz (a fixed pattern).
NAME = r"^(\d{33})-\w+-[\w-]+-([a-z0-9_]+)-(\w+)\.ndjson\.gz"


def parse_name(name: Column) -> Column:
    """STRUCT(table, ts, ns): table, time to the microsecond, and nanoseconds since 1970; NULL for other names or bad dates.

    The name is matched once: ``_named`` gets the parts, time and table, as one value.
    """
    return _named(F.split(F.regexp_replace(name, NAME + ".*$", "$1\n$2"), "\n"))


def _named(parts: Column) -> Column:
    def of(found: Column) -> Column:
        digits, table = F.get(found, F.lit(0)), F.get(found, F.lit(1))
        part = lambda a, n: F.substring(digits, a, n)
        text = F.concat(part(1, 4), F.lit("-"), part(5, 2), F.lit("-"), part(7, 2), F.lit(" "), part(9, 2), F.lit(":"), part(11, 2), F.lit(":"), part(13, 2), F.lit("."), part(15, 6))
        ts = F.when(table.isNotNull() & (F.length(digits) == 33), text).try_cast("timestamp")
        ns = F.unix_seconds(ts) * F.lit(1_000_000_000).cast("long") + part(15, 9).try_cast("long")
        return F.when(ts.isNotNull(), F.struct(table.alias("table"), ts.alias("ts"), ns.alias("ns")))

    return F.element_at(F.transform(F.array(parts), of), 1)


def scan(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of all snapshot files below a folder with their file's name; ``.gz`` is read as it is, one task a file."""
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.ndjson.gz").text(folder)
    return lines.select(F.col("value").alias("after"), F.col("_metadata.file_name").alias("file"))


def to_events(lines: DataFrame, versions: DataFrame, legacy_tenant: bool = False) -> DataFrame:
    """Rows (after, file) of files with proper names as INSERT events; ``versions``: (table, version), the latest of each.

    ``legacy_tenant`` puts a row's companyId into locationId, as earlier loads did.
    """
    # a generator of one row keeps the parsed name from being worked out again for each of its uses
    name = lines.select("*", F.explode(F.array(parse_name(F.col("file")))).alias("_f")).filter("_f is not null").withColumn("_table", F.col("_f.table"))
    rows = name.join(small(versions.select(F.col("table").alias("_table"), F.col("version").alias("modelVersion"))), "_table", "left")
    rows = rows.withColumn("object", parse_object(F.col("after"))).withColumn("_id", hash64(F.col("file")))
    field = lambda k: F.try_element_at("object", F.lit(k))
    location = F.coalesce(field("companyId"), field("locationId")) if legacy_tenant else field("locationId")
    return rows.select(
        F.lit(INSERT).alias("operation"), F.col("_id").alias("id"), F.col("_table").alias("table"), F.array(F.coalesce(field("id"), F.lit(""))).alias("key"), "modelVersion",
        (F.lit(None).cast("string") if legacy_tenant else field("companyId")).alias("companyId"), location.alias("locationId"), field("userId").alias("userId"), F.lit(None).cast("string").alias("before"), "after",
        F.lit(None).cast("array<string>").alias("diff"), F.expr("unix_millis(_f.ts)").alias("timestamp"), F.col("_f.ns").cast("string").alias("mvccTimestamp"), F.lit(True).alias("imported"), "object",
    )


def unknown_tables(events: DataFrame, versions: DataFrame) -> DataFrame:
    """Tables of files that no schema knows; a load stops if there are any."""
    return events.select("table").distinct().join(versions.select("table"), "table", "left_anti")


def typed_rows(events: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Row images as typed columns; names match regardless of case, unreadable and absent values are null."""
    low = F.transform_keys("object", lambda k, _: F.lower(k))
    picked = [F.try_element_at("_o", F.lit(c.lower())).try_cast(kind).alias(c) for c, kind in columns.items()]
    return events.withColumn("_o", low).select(*picked)
