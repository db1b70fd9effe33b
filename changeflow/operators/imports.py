"""Imports of table snapshots: which tables, what they must have, create, load, count, and the version that holds from then on."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.quoting import SPARK_TYPES, kind_of
from ..model import parse_object
from ..session import remove, scratch
from ..sources import snapshot
from .evolution import migrate


def of_tables(rows: DataFrame, only: list[str] | None, table: str = "table") -> DataFrame:
    """Rows of the tables that are asked for; of all without a list, which is pushed to the scan."""
    return rows.filter(F.col(table).isin(list(only))) if only else rows


def exported(rows: DataFrame, companies: list[str] | None = None, locations: list[str] | None = None, since=None, company: str = "companyId", location: str = "locationId", stamp: str = "updatedDate") -> DataFrame:
    """The filters that an export takes: companies, locations, and rows that were updated at or after a time."""
    if companies:
        rows = rows.filter(F.col(company).isin(list(companies)))
    if locations:
        rows = rows.filter(F.col(location).isin(list(locations)))
    return rows if since is None else rows.filter(F.col(stamp) >= F.lit(since))


def totals(files: DataFrame, table: str = "table", size: str = "size") -> DataFrame:
    """One row: tables, files and bytes."""
    return files.agg(F.countDistinct(table).alias("tables"), F.count(F.lit(1)).alias("files"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes"))


def known_only(tables: DataFrame, versions: DataFrame) -> None:
    """An error with the names of the tables that no schema knows, before anything is written."""
    unknown = sorted(r["table"] for r in snapshot.unknown_tables(tables, versions).limit(100).collect())
    if unknown:
        raise ValueError(f"no schema for the tables {unknown}")


#: Tables that are loaded side by side.
AT_ONCE = 4


def load(spark: SparkSession, database: str, lines: DataFrame, schemas: DataFrame, versions: DataFrame, only: list[str] | None = None) -> DataFrame:
    """Snapshot lines (after, file) into tables of the session's catalog: (table, version, rows).

    ``schemas`` as in ``evolution``, ``versions``: (table, version), the latest. The lines are read once, however many tables they are
    of: one write deals them by table into a scratch folder, from which each table is loaded from its own part. Each table is created
    anew; what is returned says which version a stream goes on from. Loops are over tables, which are metadata; ``AT_ONCE`` tables
    are loaded at a time, each in a scheduler pool of its own, and errors of all of them are raised together.
    """
    place = scratch(spark, "import")
    events = of_tables(snapshot.to_events(lines, versions), only)
    events.select("table", "after").write.partitionBy("table").parquet(place)
    dealt = spark.read.schema("after string, table string").parquet(place)
    try:
        known_only(dealt.select("table").distinct(), versions)
        return _load_each(spark, database, dealt, schemas, of_tables(versions, only))
    finally:
        remove(spark, place)


def _load_each(spark: SparkSession, database: str, dealt: DataFrame, schemas: DataFrame, wanted: DataFrame) -> DataFrame:
    latest = schemas.join(wanted, ["table", "version"], "left_semi")
    create = wanted.select("table", F.lit("create").alias("action"), F.array().cast("array<string>").alias("columns"))
    migrate(spark, database, latest, create, recreate=True)
    kinds = latest.select("table", "column", kind_of(F.col("type"), F.coalesce("format", F.lit("")), F.col("enum"), F.col("is_pk")).alias("kind")).collect()
    columns: dict[str, dict[str, str]] = {}
    for r in kinds:
        columns.setdefault(r["table"], {})[r["column"]] = SPARK_TYPES[r["kind"]]

    def one(table: str) -> tuple[str, int]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"import-{table}")
        target = f"`{database}`.`{table}`"
        mine = dealt.filter(F.col("table") == table).withColumn("object", parse_object(F.col("after")))
        typed = snapshot.typed_rows(mine, columns[table])
        typed.select(*[f"`{f.name}`" for f in spark.table(target).schema]).write.insertInto(target, overwrite=True)
        return table, spark.table(target).count()

    with ThreadPoolExecutor(AT_ONCE) as pool:
        jobs = [pool.submit(inheritable_thread_target(spark)(one), t) for t in sorted(columns)]
    if errors := [e for j in jobs if (e := j.exception())]:
        raise ExceptionGroup("tables that could not be loaded", errors)
    counts = spark.createDataFrame([j.result() for j in jobs], "table string, rows long")
    return wanted.join(counts, "table", "left").select("table", "version", F.coalesce("rows", F.lit(0)).alias("rows"))
