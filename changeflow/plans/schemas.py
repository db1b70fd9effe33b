"""Queries over schemas, dialects and DDL."""

from __future__ import annotations

import math
from datetime import datetime
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import model
from ..functions import quoting
from ..operators import evolution, filters
from .events import WIRE_SQL, wire
from .feeds import table

#: Three tables in two versions: table, version, column, type, format, nullable, required, is_pk, pk_place, enum.
SCHEMA_ROWS = [
    ("order", "v1", "id", "string", None, False, True, True, 1, False), ("order", "v1", "status", "array", None, False, True, False, None, True), ("order", "v1", "total", "number", None, False, True, False, None, False),
    ("order", "v1", "createdDate", "string", "date-time", False, True, False, None, False), ("order", "v1", "meta", "object", None, True, False, False, None, False),
    ("order", "v2", "id", "string", None, False, True, True, 1, False), ("order", "v2", "status", "array", None, False, True, False, None, True), ("order", "v2", "total", "number", None, False, True, False, None, False),
    ("order", "v2", "createdDate", "string", "date-time", False, True, False, None, False), ("order", "v2", "meta", "object", None, True, False, False, None, False), ("order", "v2", "count", "integer", None, True, False, False, None, False),
    ("customer", "v1", "region", "string", None, False, True, True, 1, False), ("customer", "v1", "id", "string", None, False, True, True, 2, False), ("customer", "v1", "name", "string", None, True, False, False, None, False),
    ("customer", "v1", "active", "boolean", None, False, True, False, None, False), ("customer", "v1", "tags", "array", None, False, False, False, None, False),
    ("labor", "v1", "key", "string", None, False, True, False, None, False), ("labor", "v1", "percent", "geo", None, True, False, False, None, False),
]
NAMES = ["table", "version", "column", "type", "format", "nullable", "required", "is_pk", "pk_place", "enum"]
SCHEMA_DDL = "table string, version string, column string, type string, format string, nullable boolean, required boolean, is_pk boolean, pk_place int, enum boolean"


def _literal(x) -> str:
    return "NULL" if x is None else str(x).lower() if isinstance(x, bool) else str(x) if isinstance(x, int) else f"'{x}'"


SCHEMA_SQL = f"schemas(\"table\", version, \"column\", type, format, nullable, required, is_pk, pk_place, enum) AS (VALUES {', '.join('(' + ', '.join(map(_literal, r)) + ')' for r in SCHEMA_ROWS)})"


def schemas(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SCHEMA_ROWS, SCHEMA_DDL)


#: Columns of the tables that parts stand for, 20 a table: name, type, format, nullable, required, enum.
_SPECS = [
    ("id", "string", None, False, True, False), ("region", "string", None, False, True, False), ("name", "string", None, True, False, False), ("status", "array", None, False, True, True), ("total", "number", None, False, True, False),
    ("createdDate", "string", "date-time", False, True, False), ("meta", "object", None, True, False, False), ("active", "boolean", None, False, True, False), ("tags", "array", None, False, False, False), ("count", "integer", None, True, False, False),
    ("percent", "geo", None, True, False, False), ("select", "string", None, False, True, False), ("user", "string", None, True, True, False), ("type", "string", None, True, False, False), ("order_total", "number", None, True, False, False),
    ("b c", "string", None, False, False, False), ("note", "string", "date-time", True, False, False), ("key", "string", None, False, True, False), ("Mixed", "array", None, True, False, True), ("json", "object", None, False, True, False),
]
_SPEC_KINDS = [("column", "string"), ("type", "string"), ("format", "string"), ("nullable", "boolean"), ("required", "boolean"), ("enum", "boolean")]
_BASES = ["order", "Customer", "labor_", "user", "total"]


def part_schemas(spark: SparkSession, sf_dir: str, latest: bool = False) -> DataFrame:
    """Tables of 20 columns each, one column a part: 17 of them in version v1, all in v2, which every second table has."""
    k = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(F.floor(k / 20).cast("string").alias("t"), (F.floor(k / 20) % 60).cast("int").alias("_m"), (k % 20).cast("int").alias("i"))
    spec = F.element_at(F.array(*[F.struct(*[F.lit(x).cast(kind).alias(n) for x, (n, kind) in zip(r, _SPEC_KINDS, strict=True)]) for r in _SPECS]), F.col("i") + 1)
    ends = F.when(F.col("_m") % 2 == 0, F.translate("t", "0123456789", "abcdefghij")).otherwise(F.col("t"))
    key = ((F.col("i") == 0) & (F.col("_m") % 3 != 1)) | ((F.col("i") == 1) & (F.col("_m") % 3 == 0))
    versions = F.filter(F.array(F.lit("v1"), F.lit("v2")), lambda v: F.when(v == "v1", F.col("i") < 17).otherwise(F.col("_m") % 2 == 0) & (F.lit(not latest) | (v == "v2") | (F.col("_m") % 2 == 1)))
    rows = rows.select(F.concat(F.element_at(F.array(*map(F.lit, _BASES)), F.col("_m") % 5 + 1), ends).alias("table"), F.explode(versions).alias("version"), spec.alias("s"), key.alias("is_pk"), "i")
    return rows.select("table", "version", F.col("s.column").alias("column"), "s.type", "s.format", "s.nullable", "s.required", "is_pk", F.when(F.col("is_pk"), F.col("i") + 1).alias("pk_place"), "s.enum")




def part_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The destination lacks every fourth table, and a fifth of the columns of the others."""
    there = part_schemas(spark, sf_dir, latest=True).filter((F.length("table") + F.ascii("table")) % 4 != 3)
    return there.filter((F.length("column") + F.ascii("column")) % 5 != 2).select("table", "column", F.lit("TEXT").alias("type"))


def _spec_sql(r: tuple) -> str:
    return "{" + ", ".join(f"'{n}': {_literal(x)}{'::VARCHAR' if k == 'string' else ''}" for x, (n, k) in zip(r, _SPEC_KINDS, strict=True)) + "}"


PARTS_SQL = f"""raw AS (SELECT p_partkey // 20 AS t, (p_partkey // 20) % 60 AS m, p_partkey % 20 AS i FROM part),
specs AS (SELECT [{', '.join(map(_spec_sql, _SPECS))}] AS spec),
versioned AS (SELECT *, unnest(['v1', 'v2']) AS version FROM raw),
schemas AS (
  SELECT {_BASES}[m % 5 + 1] || CASE WHEN m % 2 = 0 THEN translate(t::VARCHAR, '0123456789', 'abcdefghij') ELSE t::VARCHAR END AS "table", version, spec[i + 1]."column" AS "column", spec[i + 1].type AS type, spec[i + 1].format AS format,
    spec[i + 1].nullable AS nullable, spec[i + 1].required AS required, (i = 0 AND m % 3 <> 1) OR (i = 1 AND m % 3 = 0) AS is_pk, CASE WHEN (i = 0 AND m % 3 <> 1) OR (i = 1 AND m % 3 = 0) THEN i + 1 END AS pk_place, spec[i + 1].enum AS enum, m
  FROM versioned, specs WHERE CASE version WHEN 'v1' THEN i < 17 ELSE m % 2 = 0 END)"""
LATEST_SQL = "latest AS (SELECT * FROM schemas WHERE version = 'v2' OR m % 2 = 1)"
PART_CATALOG_SQL = """catalog AS (SELECT "table", "column", 'TEXT' AS type FROM latest WHERE (length("table") + ascii("table")) % 4 <> 3 AND (length("column") + ascii("column")) % 5 <> 2)"""


def _out(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"table": "tbl", "column": "col"})


def schema_column_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(evolution.column_order(part_schemas(spark, sf_dir)).select("table", "version", "column", "place"))


ORDER_SQL = f"""WITH {PARTS_SQL}
SELECT "table" AS tbl, version, "column" AS col, row_number() OVER (PARTITION BY "table", version ORDER BY is_pk DESC, pk_place, "column")::INT AS place FROM schemas"""


def type_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [evolution.with_types(part_schemas(spark, sf_dir), d).select("table", "version", "column", F.lit(d).alias("dialect"), "sql_type") for d in [*quoting.DIALECTS, "spark"]]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return _out(out)


_KIND = "CASE WHEN type = 'string' AND format = 'date-time' THEN 'date-time' WHEN type = 'string' AND {pk} THEN 'key' WHEN type = 'array' AND enum THEN 'enum' WHEN type IN ('string', 'integer', 'number', 'boolean', 'object', 'array') THEN type ELSE 'other' END"


def _types_sql(dialect: str, pk: str = "is_pk") -> str:
    types = quoting.SPARK_TYPES if dialect == "spark" else quoting.TYPES[dialect]
    return f"CASE {_KIND.format(pk=pk)} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in types.items()) + " END"


TYPES_SQL = f"WITH {PARTS_SQL} " + " UNION ALL ".join(f"SELECT \"table\" AS tbl, version, \"column\" AS col, '{d}' AS dialect, {_types_sql(d)} AS sql_type FROM schemas" for d in [*quoting.DIALECTS, "spark"])


def _quote_sql(name: str, dialect: str, table_: bool = False) -> str:
    left, right = {"mysql": ("`", "`"), "sqlserver": ("[", "]") if table_ else ('"', '"')}.get(dialect, ('"', '"'))
    quoted = f"'{left}' || {name} || '{right}'"
    if dialect == "snowflake":
        return f"({quoted})"
    words = "|".join(quoting.KEYWORDS + (quoting.SQLSERVER_KEYWORDS if dialect == "sqlserver" else []))
    return f"(CASE WHEN regexp_matches({name}, '[A-Z0-9_\\s]') OR regexp_matches({name}, '(?i)\\b({words})\\b') THEN {quoted} ELSE {name} END)"


def create_table_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [evolution.create_table(part_schemas(spark, sf_dir, latest=True), d).withColumn("dialect", F.lit(d)) for d in quoting.DIALECTS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return _out(out)


def _create_sql(d: str) -> str:
    name = _quote_sql('"table"', d, True)
    head = f"'CREATE OR REPLACE TABLE ' || {name}" if d == "snowflake" else f"'DROP TABLE IF EXISTS ' || {name} || ';' || chr(10) || 'CREATE TABLE ' || {name}"
    end = {"mysql": "chr(10) || ') CHARACTER SET=utf8mb4;' || chr(10)", "sqlserver": "chr(10) || ')'"}.get(d, "chr(10) || ');' || chr(10)")
    col = _quote_sql('"column"', d)
    none = "chr(9) || 'PRIMARY KEY (id)'" if d == "mysql" else "''"
    return f"""SELECT "table" AS tbl, version, {head} || ' (' || chr(10) || string_agg(chr(9) || {col} || ' ' || {_types_sql(d)} || CASE WHEN required AND NOT nullable THEN ' NOT NULL' ELSE '' END || ',' || chr(10), '' ORDER BY is_pk DESC, pk_place, "column")
  || coalesce(chr(9) || 'PRIMARY KEY (' || string_agg({col}, ', ' ORDER BY pk_place) FILTER (is_pk) || ')', {none}) || {end} AS ddl, '{d}' AS dialect FROM latest GROUP BY "table", version"""


CREATE_SQL = f"WITH {PARTS_SQL}, {LATEST_SQL} " + " UNION ALL ".join(map(_create_sql, quoting.DIALECTS))


def missing_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(evolution.missing_tables(part_schemas(spark, sf_dir, latest=True), part_catalog(spark, sf_dir)))


MISSING_TABLES_SQL = f'WITH {PARTS_SQL}, {LATEST_SQL}, {PART_CATALOG_SQL} SELECT DISTINCT "table" AS tbl FROM latest WHERE "table" NOT IN (SELECT "table" FROM catalog)'


def missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(evolution.missing_columns(part_schemas(spark, sf_dir, latest=True), part_catalog(spark, sf_dir)))


_MISSING = 'SELECT "table", "column" FROM latest WHERE "table" IN (SELECT "table" FROM catalog) AND ("table", "column") NOT IN (SELECT ("table", "column") FROM catalog)'
MISSING_COLUMNS_SQL = f'WITH {PARTS_SQL}, {LATEST_SQL}, {PART_CATALOG_SQL} SELECT "table" AS tbl, "column" AS col FROM ({_MISSING})'


def add_columns_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = part_schemas(spark, sf_dir, latest=True)
    missing = evolution.missing_columns(latest, part_catalog(spark, sf_dir))
    parts = [evolution.add_columns(latest, missing, d).withColumn("dialect", F.lit(d)) for d in quoting.DIALECTS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return _out(out)


ADD_SQL = f"WITH {PARTS_SQL}, {LATEST_SQL}, {PART_CATALOG_SQL}, missing AS ({_MISSING}), m AS (SELECT l.* FROM latest l JOIN missing USING (\"table\", \"column\")) " + " UNION ALL ".join(
    f"""SELECT "table" AS tbl, "column" AS col, 'ALTER TABLE ' || {_quote_sql('"table"', d, True)} || '{' ADD ' if d == 'sqlserver' else ' ADD COLUMN '}' || {_quote_sql('"column"', d)} || ' ' || {_types_sql(d, 'false')} || ';' AS ddl, '{d}' AS dialect FROM m"""
    for d in quoting.DIALECTS
)


def reconcile_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(evolution.reconcile(part_schemas(spark, sf_dir, latest=True), part_catalog(spark, sf_dir)).withColumn("columns", F.array_join("columns", ",")))


RECONCILE_SQL = f"""WITH {PARTS_SQL}, {LATEST_SQL}, {PART_CATALOG_SQL}
SELECT DISTINCT "table" AS tbl, 'create' AS action, '' AS columns FROM latest WHERE "table" NOT IN (SELECT "table" FROM catalog)
UNION ALL SELECT "table", 'add_columns', string_agg("column", ',' ORDER BY "column") FROM ({_MISSING}) GROUP BY 1"""


def _versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = wire(spark, sf_dir)
    late = F.col("event_id") % 2 == 1
    return w.select(F.when(F.col("tbl") == "event", "order").otherwise("customer").alias("table"), F.when((F.col("tbl") == "event") & late & (F.col("event_id") > 100), "v2").otherwise("v1").alias("modelVersion"), "event_id")


VERSIONED_SQL = f"""{WIRE_SQL}, v AS (SELECT CASE tbl WHEN 'event' THEN 'order' ELSE 'customer' END AS "table", CASE WHEN tbl = 'event' AND event_id % 2 = 1 AND event_id > 100 THEN 'v2' ELSE 'v1' END AS version, event_id FROM wire)"""


def migration_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = spark.createDataFrame([("order", "v1")], "table string, version string")
    plan = evolution.migration_plan(_versioned(spark, sf_dir), schemas(spark), current, "event_id")
    return _out(plan.withColumn("columns", F.array_join("columns", ",")))


MIGRATION_SQL = f"""WITH {SCHEMA_SQL}, {VERSIONED_SQL}
SELECT "table" AS tbl, version, min(event_id) AS first_seq, CASE "table" WHEN 'customer' THEN 'create' ELSE 'add_columns' END AS action, CASE "table" WHEN 'customer' THEN '' ELSE 'count' END AS columns
FROM v WHERE NOT ("table" = 'order' AND version = 'v1') GROUP BY 1, 2"""


def join_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = schemas(spark).groupBy("table", "version").agg(F.array_sort(F.collect_list("column")).alias("columns"))
    return _out(filters.join_schema(_versioned(spark, sf_dir), dims).select("event_id", "table", F.array_join("columns", ",").alias("columns")))


JOIN_SQL = f"""WITH {SCHEMA_SQL}, {VERSIONED_SQL}, d AS (SELECT "table", version, string_agg("column", ',' ORDER BY "column") AS columns FROM schemas GROUP BY 1, 2)
SELECT event_id, v."table" AS tbl, columns FROM v LEFT JOIN d ON d."table" = v."table" AND d.version = v.version"""


def destination_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog scan over the test tables themselves."""
    from ..sources.catalog import describe

    return _out(describe({n: table(spark, sf_dir, n) for n in TABLES}, spark))


TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
_NAMES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "FLOAT": "float", "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz", "FLOAT[]": "array<float>", "DOUBLE[]": "array<double>"}
_SPARK_NAMES = "CASE data_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _NAMES.items()) + " ELSE 'string' END"
DESTINATION_SQL = f"SELECT table_name AS tbl, column_name AS col, {_SPARK_NAMES} AS type FROM information_schema.columns WHERE table_name IN ({', '.join(repr(t) for t in TABLES)})"


#: Texts that meet every rule of the quoting functions.
def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    text = (
        F.when(k % 9 == 0, F.concat(F.lit("it's "), F.col("c_name"))).when(k % 9 == 1, F.concat(F.lit("a\"b\\c\n"), F.col("c_name"))).when(k % 9 == 2, F.lit("NULL")).when(k % 9 == 3, F.lit(""))
        .when(k % 9 == 4, F.concat(F.lit("2024-0"), (k % 9 + 1).cast("string"), F.lit("-11T12:30:00.120000400Z"))).when(k % 9 == 5, F.lit("1969-12-31T23:59:59Z")).when(k % 9 == 6, F.concat(F.lit("é "), F.col("c_name")))
        .when(k % 9 == 7, F.lit(None).cast("string")).otherwise(F.col("c_name"))
    )
    return table(spark, sf_dir, "customer").select("c_custkey", text.alias("t"))


TEXTS_SQL = """texts AS (SELECT c_custkey, CASE c_custkey % 9 WHEN 0 THEN 'it''s ' || c_name WHEN 1 THEN 'a"b\\c' || chr(10) || c_name WHEN 2 THEN 'NULL' WHEN 3 THEN ''
  WHEN 4 THEN '2024-0' || (c_custkey % 9 + 1) || '-11T12:30:00.120000400Z' WHEN 5 THEN '1969-12-31T23:59:59Z' WHEN 6 THEN 'é ' || c_name WHEN 7 THEN NULL ELSE c_name END AS t FROM customer)"""
_STAMP = "regexp_matches(t, '^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}(.\\d{1,})?Z$')"
_STAMPED = "'''' || CASE WHEN t[1:4] < '1970' THEN '1970-01-01 00:00:01' ELSE t[1:10] || ' ' || t[12:19] || CASE WHEN rtrim(t[21:26], '0Z') <> '' THEN '.' || rtrim(t[21:26], '0Z') ELSE '' END END || ''''"
_ESCAPED = "'''' || replace(replace(replace(replace(t, '\\', '\\\\'), chr(10), '\\n'), '\"', '\\\"'), '''', {q}) || ''''"


def quote_pg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("c_custkey", quoting.quote_postgres(F.col("t")).alias("quoted"))


QUOTE_PG_SQL = f"""WITH {TEXTS_SQL} SELECT c_custkey, CASE WHEN t IS NULL THEN 'null' WHEN t = '' OR regexp_full_match(t, '["/.,;:$%/@!#$%^&*(){{}}\\[\\]|\\\\<>?~a-zA-Z0-9_\\- ]+') THEN '''' || t || '''' ELSE '$_H_$' || t || '$_H_$' END AS quoted FROM texts"""


def quote_mysql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("c_custkey", quoting.quote_mysql(F.col("t")).alias("quoted"))


_back = "'\\'''"
QUOTE_MYSQL_SQL = f"WITH {TEXTS_SQL} SELECT c_custkey, CASE WHEN t IS NULL THEN 'NULL' WHEN {_STAMP} THEN {_STAMPED} ELSE {_ESCAPED.format(q=_back)} END AS quoted FROM texts"


def quote_sqlserver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("c_custkey", quoting.quote_sqlserver(F.col("t")).alias("quoted"))


_twice = "''''''"
QUOTE_SQLSERVER_SQL = f"WITH {TEXTS_SQL} SELECT c_custkey, CASE WHEN t IS NULL THEN 'NULL' WHEN {_STAMP} THEN {_STAMPED} ELSE {_ESCAPED.format(q=_twice)} END AS quoted FROM texts"


def quote_snowflake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("c_custkey", quoting.quote_snowflake(F.col("t")).alias("quoted"), quoting.quote_snowflake(F.col("t"), "PARSE_JSON").alias("wrapped"))


_flake = "'''' || replace(replace(t, '\\', '\\\\'), '''', '''''') || ''''"
QUOTE_SNOWFLAKE_SQL = f"WITH {TEXTS_SQL} SELECT c_custkey, CASE WHEN t IS NULL OR t = 'NULL' THEN 'NULL' ELSE {_flake} END AS quoted, CASE WHEN t IS NULL OR t = 'NULL' THEN 'NULL' ELSE 'PARSE_JSON(' || {_flake} || ')' END AS wrapped FROM texts"


def quote_identifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("c_custkey") % 3 == 0, F.lower("c_mktsegment")).when(F.col("c_custkey") % 3 == 1, F.element_at(F.array(*map(F.lit, ["order", "percent", "total", "plain", "camelCase"])), (F.col("c_custkey") % 5 + 1).cast("int"))).otherwise(F.lit("a_b"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", name.alias("n"))
    return rows.select("c_custkey", *[quoting.quote_identifier(F.col("n"), d).alias(d) for d in quoting.DIALECTS], quoting.quote_identifier(F.col("n"), "sqlserver", True).alias("sqlserver_table"))


IDENTIFIER_SQL = f"""WITH names AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN lower(c_mktsegment) WHEN 1 THEN ['order', 'percent', 'total', 'plain', 'camelCase'][c_custkey % 5 + 1] ELSE 'a_b' END AS n FROM customer)
SELECT c_custkey, {", ".join(f"{_quote_sql('n', d)} AS {d}" for d in quoting.DIALECTS)}, {_quote_sql('n', 'sqlserver', True)} AS sqlserver_table FROM names"""

_VALUES = ["NULL", "''", "12", "true", "0", "", "x", "null", "False"]
_KINDS = ["object", "array", "integer", "boolean", "string"]


def _cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    pick = lambda xs, i: F.element_at(F.array(*map(F.lit, xs)), (i + 1).cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", pick(_VALUES, k % 9).alias("v"), pick(_KINDS, F.floor(k / 9) % 5).alias("type"), (F.floor(k / 45) % 2 == 0).alias("nullable"))


_list = lambda xs: "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + "]"
CASES_SQL = f"cases AS (SELECT c_custkey, {_list(_VALUES)}[c_custkey % 9 + 1] AS v, {_list(_KINDS)}[(c_custkey // 9) % 5 + 1] AS type, (c_custkey // 45) % 2 = 0 AS nullable FROM customer)"


def json_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cases(spark, sf_dir).select("c_custkey", *[quoting.json_default(F.col("v"), F.col("type"), F.col("nullable"), q).alias(n) for q, n in ((False, "plain"), (True, "quoted"))])


_DEFAULT = "CASE WHEN (NOT nullable OR type = 'array') AND v IN ('''''', '', 'NULL', 'null') AND type = 'array' THEN '''[]''' WHEN NOT nullable AND v IN ('''''', '', 'NULL', 'null') AND type = 'object' THEN '''{{}}''' {more} ELSE v END"
DEFAULT_SQL = f"WITH {CASES_SQL} SELECT c_custkey, {_DEFAULT.format(more='')} AS plain, {_DEFAULT.format(more=chr(87) + 'HEN type = ' + chr(39) + 'object' + chr(39) + ' AND v IN (' + chr(39) + '12' + chr(39) + ', ' + chr(39) + 'true' + chr(39) + ', ' + chr(39) + '0' + chr(39) + ') THEN ' + chr(39) * 4 + ' || v || ' + chr(39) * 4)} AS quoted FROM cases"


def coerce_sqlserver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cases(spark, sf_dir).select("c_custkey", quoting.coerce_sqlserver(F.col("v"), F.col("type"), F.col("nullable")).alias("coerced"))


COERCE_SQL = f"""WITH {CASES_SQL} SELECT c_custkey, CASE WHEN type = 'boolean' AND (lower(v) = 'true' OR v = '1') THEN '1' WHEN type = 'boolean' AND ((NOT nullable AND v = '') OR lower(v) IN ('false', 'null')) THEN '0'
  WHEN type = 'integer' AND v = 'NULL' THEN '0' WHEN type = 'array' AND NOT nullable AND v = 'NULL' THEN '''''' ELSE v END AS coerced FROM cases"""


def default_snowflake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cases(spark, sf_dir).select("c_custkey", *[quoting.default_snowflake(F.col("type"), F.col("nullable"), w).alias(n) for w, n in ((False, "plain"), (True, "wrapped"))])


_SNOW = "CASE WHEN nullable THEN 'NULL' ELSE CASE type WHEN 'object' THEN {o} WHEN 'array' THEN {a} WHEN 'integer' THEN '0' WHEN 'boolean' THEN 'false' ELSE '''''' END END"
SNOW_SQL = f"""WITH {CASES_SQL} SELECT c_custkey, {_SNOW.format(o="'''{}'''", a="'''[]'''")} AS plain, {_SNOW.format(o="'PARSE_JSON(''{}'')'", a="'PARSE_JSON(''[]'')'")} AS wrapped FROM cases"""

#: Doubles from the least to the largest, and those that are no numbers.
_DOUBLES = [0.5, 1e6, 1234567.25, 123456.0, 0.00001, -2e7, 0.0, -0.25, 1.5e-18, 1e22, 5e-324, 1.7976931348623157e308, -2.2250738585072014e-308, 2.0**-44, 8.41e21, 0.1, 1 / 3, 123456789012345680.0, float("nan"), float("inf"), float("-inf")]


def _double_texts(x: float) -> tuple[str, str]:
    """A double's texts: plain, and with an exponent of two digits where that is the custom."""
    if math.isnan(x) or math.isinf(x):
        return ({"nan": "NaN", "inf": "+Inf", "-inf": "-Inf"}[repr(x)],) * 2
    sign, digits, place = Decimal(repr(x)).normalize().as_tuple()
    plain, power = format(Decimal(repr(x)).normalize(), "f"), len(digits) + place - 1
    if x == 0 or -5 < power < 6:
        return plain, plain
    mantissa = str(digits[0]) + ("." + "".join(map(str, digits[1:])) if len(digits) > 1 else "")
    return plain, f"{'-' * sign}{mantissa}e{'-' if power < 0 else '+'}{abs(power):02}"


_NUMBERS = [(x, *_double_texts(x)) for x in _DOUBLES]


def quote_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literals of typed columns, one row a customer and dialect."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(k % 10 != 9, k).alias("n"), F.element_at(F.array(*[F.lit(x) for x, _, _ in _NUMBERS]), (k % len(_NUMBERS) + 1).cast("int")).alias("x"), F.when(k % 3 != 2, k % 3 == 0).alias("b"),
        F.when(k % 4 != 0, F.array(F.col("c_mktsegment"), F.lit("it's"))).alias("a"), F.create_map(F.lit("k"), k).alias("m"), F.lit(datetime(2024, 3, 5, 6, 7, 8, 120000)).cast("timestamp_ntz").alias("t"),
    )
    parts = [rows.select("c_custkey", F.lit(d).alias("dialect"), *[quoting.quote_value(F.col(f.name), f.dataType, d).alias(f.name) for f in rows.schema if f.name != "c_custkey"]) for d in quoting.DIALECTS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def _typed_sql(d: str) -> str:
    null = "NULL" if d != "postgres" else "null"
    yes, no = ("true", "false") if d in ("postgres", "snowflake") else ("1", "0")
    texts = [plain if d in ("postgres", "snowflake") else short for _, plain, short in _NUMBERS]
    as_text = lambda s: "'" + s.replace("'", "''") + "'"
    double = '\\"' if d in ("mysql", "sqlserver") else '"'
    left = right = "$_H_$" if d == "postgres" else "'"
    tick = {"postgres": "'", "mysql": "\\'"}.get(d, "''")
    array = f"{as_text(f'{left}[{double}')} || c_mktsegment || {as_text(f'{double},{double}it{tick}s{double}]{right}')}"
    map_ = f"""{as_text(f"'{{{double}k{double}:")} || c_custkey || {as_text("}'")}"""
    stamp = as_text("'2024-03-05 06:07:08.12Z'" if d == "postgres" else "'2024-03-05 06:07:08.12'")
    return f"""SELECT c_custkey, '{d}' AS dialect, CASE WHEN c_custkey % 10 = 9 THEN '{null}' ELSE c_custkey::VARCHAR END AS n, {_list(texts)}[c_custkey % {len(_NUMBERS)} + 1] AS x,
  CASE c_custkey % 3 WHEN 0 THEN '{yes}' WHEN 1 THEN '{no}' ELSE '{null}' END AS b, CASE WHEN c_custkey % 4 = 0 THEN '{null}' ELSE {array} END AS a, {map_} AS m, {stamp} AS t FROM customer"""


TYPED_SQL = " UNION ALL ".join(map(_typed_sql, quoting.DIALECTS))


def quote_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literals of row images by the JSON types of their values, which alone tell the number 7 from the text 7."""
    k = F.col("event_id")
    image = F.struct("value", k.alias("n"), k.cast("string").alias("s"), (k % 2 == 0).alias("b"), F.struct((k % 3).alias("k")).alias("o"), F.array(F.lit("it's")).alias("a"))
    rows = table(spark, sf_dir, "events").select("event_id", model.parse_typed(F.to_json(image)).alias("image"))
    names = ["value", "n", "s", "b", "o", "a", "none"]
    parts = [rows.select("event_id", F.lit(d).alias("dialect"), *[quoting.quote_variant(F.try_element_at("image", F.lit(c)), d).alias(c) for c in names]) for d in quoting.DIALECTS]
    return reduce(DataFrame.unionByName, parts)


def _image_sql(d: str) -> str:
    null, (yes, no) = ("NULL" if d != "postgres" else "null"), (("true", "false") if d in ("postgres", "snowflake") else ("1", "0"))
    double = '\\"' if d in ("mysql", "sqlserver") else '"'
    tick = {"postgres": "'", "mysql": "\\'"}.get(d, "''")
    mark = "$_H_$" if d == "postgres" else "'"
    array = (mark + f"[{double}it{tick}s{double}]" + mark).replace("'", "''")
    return f"""SELECT event_id, '{d}' AS dialect, CASE WHEN value IS NULL THEN '{null}' ELSE regexp_replace(value::VARCHAR, '[.]0$', '') END AS value, event_id::VARCHAR AS n, '''' || event_id || '''' AS s,
  CASE WHEN event_id % 2 = 0 THEN '{yes}' ELSE '{no}' END AS b, '''{{{double}k{double}:' || (event_id % 3) || '}}''' AS o, '{array}' AS a, '{null}' AS none FROM events"""


IMAGE_SQL = " UNION ALL ".join(map(_image_sql, quoting.DIALECTS))


def insert_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How values get into the warehouse's semi-structured columns."""
    items = F.when(F.col("enum"), "string").when(F.col("column") == "tags", "integer")
    return _out(part_schemas(spark, sf_dir).select("table", "version", "column", quoting.insert_function(F.col("type"), F.coalesce(items, F.lit(""))).alias("function")))


INSERT_SQL = f"""WITH {PARTS_SQL} SELECT "table" AS tbl, version, "column" AS col, CASE WHEN type = 'object' OR (type = 'array' AND enum) THEN 'PARSE_JSON' WHEN type = 'array' THEN 'TO_VARIANT' ELSE '' END AS function FROM schemas"""


def column_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(evolution.column_map(part_schemas(spark, sf_dir)).select("table", "version", F.to_json("columns").alias("columns")))


COLUMN_MAP_SQL = f"""WITH {PARTS_SQL} SELECT "table" AS tbl, version, '{{' || string_agg('"' || "column" || '":"' || type || '"', ',' ORDER BY "column") || '}}' AS columns FROM schemas GROUP BY 1, 2"""

QUERIES = {f.__name__: f for f in (
    schema_column_order, type_mapping, create_table_ddl, missing_tables, missing_columns, add_columns_ddl, reconcile_plan, migration_plan, join_schema, destination_schema,
    quote_pg, quote_mysql, quote_sqlserver, quote_snowflake, quote_identifier, json_default, coerce_sqlserver, default_snowflake, quote_typed, quote_image, insert_function, column_map,
)}
ORACLES = {
    "schema_column_order": ORDER_SQL, "type_mapping": TYPES_SQL, "create_table_ddl": CREATE_SQL, "missing_tables": MISSING_TABLES_SQL, "missing_columns": MISSING_COLUMNS_SQL, "add_columns_ddl": ADD_SQL, "reconcile_plan": RECONCILE_SQL,
    "migration_plan": MIGRATION_SQL, "join_schema": JOIN_SQL, "destination_schema": DESTINATION_SQL, "quote_pg": QUOTE_PG_SQL, "quote_mysql": QUOTE_MYSQL_SQL, "quote_sqlserver": QUOTE_SQLSERVER_SQL,
    "quote_snowflake": QUOTE_SNOWFLAKE_SQL, "quote_identifier": IDENTIFIER_SQL, "json_default": DEFAULT_SQL, "coerce_sqlserver": COERCE_SQL, "default_snowflake": SNOW_SQL, "quote_typed": TYPED_SQL, "quote_image": IMAGE_SQL,
    "insert_function": INSERT_SQL, "column_map": COLUMN_MAP_SQL,
}
