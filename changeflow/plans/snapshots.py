"""Queries over snapshot files, validation and bulk loads."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import imports
from ..session import shared_dir
from ..sources import snapshot
from .feeds import table

NAMES_SQL = """names AS (SELECT c_custkey, c_name, c_acctbal, c_nationkey, CASE WHEN c_custkey % 7 = 0 THEN 'notes-' || c_custkey || '.txt' WHEN c_custkey % 11 = 0 THEN '202413' || lpad(c_custkey::VARCHAR, 27, '0') || '-a-1-2-f-customer-1.ndjson.gz'
  ELSE '2024072420' || lpad((c_custkey % 60)::VARCHAR, 2, '0') || '01585498' || lpad((c_custkey % 1000)::VARCHAR, 3, '0') || '0000000000-s1-2-3-0f-' || CASE WHEN c_custkey % 2 = 0 THEN 'labor_rate' ELSE 'user' END || '-14a.ndjson.gz' END AS file FROM customer)"""


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    text = k.cast("string")
    good = F.concat(F.lit("2024072420"), F.lpad((k % 60).cast("string"), 2, "0"), F.lit("01585498"), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit("0000000000-s1-2-3-0f-"), F.when(k % 2 == 0, "labor_rate").otherwise("user"), F.lit("-14a.ndjson.gz"))
    bad = F.concat(F.lit("202413"), F.lpad(text, 27, "0"), F.lit("-a-1-2-f-customer-1.ndjson.gz"))
    return table(spark, sf_dir, "customer").withColumn("file", F.when(k % 7 == 0, F.concat(F.lit("notes-"), text, F.lit(".txt"))).when(k % 11 == 0, bad).otherwise(good))


def parse_snapshot_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = snapshot.parse_name(F.col("file"))
    return _names(spark, sf_dir).select("c_custkey", f["table"].alias("tbl"), f["ns"].cast("string").alias("ns"))


_NS = "CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 THEN epoch_us(strptime(file[1:14], '%Y%m%d%H%M%S')) * 1000 + file[15:23]::BIGINT END"
PARSE_SQL = f"WITH {NAMES_SQL} SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 THEN CASE WHEN c_custkey % 2 = 0 THEN 'labor_rate' ELSE 'user' END END AS tbl, ({_NS})::VARCHAR AS ns FROM names"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    after = F.to_json(F.struct(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("NAME"), F.col("c_acctbal").alias("balance"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("companyId")))
    return _names(spark, sf_dir).select(after.alias("after"), "file")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = spark.createDataFrame([("user", "u2"), ("labor_rate", "l1")], "table string, version string")
    return snapshot.to_events(_lines(spark, sf_dir), versions)


def snapshot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    return e.select(F.element_at("key", 1).alias("pk"), F.col("table").alias("tbl"), "operation", "modelVersion", "companyId", "timestamp", "mvccTimestamp", "imported")


EVENTS_SQL = f"""WITH {NAMES_SQL}
SELECT c_custkey::VARCHAR AS pk, CASE WHEN c_custkey % 2 = 0 THEN 'labor_rate' ELSE 'user' END AS tbl, 'INSERT' AS operation, CASE WHEN c_custkey % 2 = 0 THEN 'l1' ELSE 'u2' END AS "modelVersion", 'n' || c_nationkey AS "companyId",
  ({_NS}) // 1000000 AS timestamp, ({_NS})::VARCHAR AS "mvccTimestamp", true AS imported FROM names WHERE c_custkey % 7 <> 0 AND c_custkey % 11 <> 0"""


def snapshot_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as a load writes them: typed, names matched without case, a column that files lack is null."""
    return snapshot.typed_rows(_events(spark, sf_dir).filter("table = 'user'"), {"id": "bigint", "name": "string", "Balance": "double", "phone": "string"})


LOAD_SQL = f"WITH {NAMES_SQL} SELECT c_custkey AS id, c_name AS name, c_acctbal AS \"Balance\", NULL::VARCHAR AS phone FROM names WHERE c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 AND c_custkey % 2 = 1"


def bulk_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of both tables as a bulk load reads them from row images."""
    e = _events(spark, sf_dir)
    rows = [snapshot.typed_rows(e.filter(F.col("table") == t), {"id": "bigint", "balance": "double"}).withColumn("tbl", F.lit(t)) for t in ("labor_rate", "user")]
    return rows[0].unionByName(rows[1])


COPY_SQL = f"WITH {NAMES_SQL} SELECT CASE WHEN c_custkey % 2 = 0 THEN 'labor_rate' ELSE 'user' END AS tbl, c_custkey AS id, c_acctbal AS balance FROM names WHERE c_custkey % 7 <> 0 AND c_custkey % 11 <> 0"

def import_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots into tables of a new database: created, loaded, counted; each loaded row with its table's version and count."""
    place = f"changeflow_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {place} LOCATION '{shared_dir(spark).rstrip('/')}/{place}'")
    rows = [("user", "u2", c, t, None, c != "id", c == "id", c == "id", 1 if c == "id" else None, False) for c, t in (("id", "string"), ("name", "string"), ("balance", "number"), ("phone", "string"))]
    rows += [("user", "u1", "id", "string", None, False, True, True, 1, False), ("labor_rate", "l1", "id", "string", None, False, True, True, 1, False), ("other", "o1", "id", "string", None, False, True, True, 1, False)]
    schema = spark.createDataFrame(rows, "table string, version string, column string, type string, format string, nullable boolean, required boolean, is_pk boolean, pk_place int, enum boolean")
    versions = spark.createDataFrame([("user", "u2"), ("labor_rate", "l1"), ("other", "o1")], "table string, version string")
    done = imports.load(spark, place, _lines(spark, sf_dir), schema, versions)
    wide = {"user": ("id", "name", "balance", "phone"), "labor_rate": ("id",), "other": ("id",)}
    kinds = {"id": "string", "name": "string", "balance": "double", "phone": "string"}
    parts = [spark.table(f"{place}.{t}").select(F.lit(t).alias("table"), *[(F.col(c) if c in has else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()]) for t, has in wide.items()]
    loaded = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return done.join(loaded, "table", "left").withColumnRenamed("table", "tbl")


IMPORT_SQL = f"""WITH {NAMES_SQL}, good AS (SELECT * FROM names WHERE c_custkey % 7 <> 0 AND c_custkey % 11 <> 0),
rows AS (SELECT 'labor_rate' AS tbl, 'l1' AS version, c_custkey::VARCHAR AS id, NULL::VARCHAR AS name, NULL::DOUBLE AS balance FROM good WHERE c_custkey % 2 = 0
  UNION ALL SELECT 'user', 'u2', c_custkey::VARCHAR, c_name, c_acctbal FROM good WHERE c_custkey % 2 = 1)
SELECT tbl, version, count(*) OVER (PARTITION BY tbl) AS rows, id, name, balance, NULL::VARCHAR AS phone FROM rows UNION ALL SELECT 'other', 'o1', 0, NULL, NULL, NULL, NULL"""

QUERIES = {f.__name__: f for f in (parse_snapshot_name, snapshot_events, snapshot_load, bulk_copy, import_load)}
ORACLES = {"parse_snapshot_name": PARSE_SQL, "snapshot_events": EVENTS_SQL, "snapshot_load": LOAD_SQL, "bulk_copy": COPY_SQL, "import_load": IMPORT_SQL}
