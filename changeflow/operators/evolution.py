"""Schemas as rows, add-only evolution, and DDL text.

A schema is a set of rows (table, version, column, type, format, nullable, required, is_pk, pk_place, enum). Destination
catalogs are rows (table, column, type). Both are small dimensions as a rule; larger ones are joined by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.quoting import kind_of, quote_identifier, sql_type
from .filters import small


def column_order(schema: DataFrame) -> DataFrame:
    """Adds ``place``: primary keys as declared, then the other columns by name."""
    by = W.partitionBy("table", "version").orderBy(F.col("is_pk").desc(), F.when(F.col("is_pk"), F.col("pk_place")), "column")
    return schema.withColumn("place", F.row_number().over(by))


def with_types(schema: DataFrame, dialect: str) -> DataFrame:
    return schema.withColumn("sql_type", sql_type(kind_of(F.col("type"), F.coalesce("format", F.lit("")), F.col("enum"), F.col("is_pk")), dialect))


def _lines(schema: DataFrame, dialect: str) -> Column:
    strict = F.when(F.col("required") & ~F.col("nullable"), " NOT NULL").otherwise("")
    return F.concat(F.lit("\t"), quote_identifier(F.col("column"), dialect), F.lit(" "), F.col("sql_type"), strict, F.lit(",\n"))


def create_table(schema: DataFrame, dialect: str) -> DataFrame:
    """(table, version, ddl): drop and create, columns in order, NOT NULL where required and not nullable."""
    rows = with_types(column_order(schema), dialect)
    rows = rows.withColumn("_line", _lines(rows, dialect)).withColumn("_pk", F.when(F.col("is_pk"), quote_identifier(F.col("column"), dialect)))
    listed = rows.groupBy("table", "version").agg(F.array_sort(F.collect_list(F.struct("place", "_line", "_pk"))).alias("_rows"))
    name = quote_identifier(F.col("table"), dialect, table=True)
    keys = F.filter(F.transform("_rows", lambda r: r["_pk"]), lambda k: k.isNotNull())
    pk = F.when(F.size(keys) > 0, F.concat(F.lit("\tPRIMARY KEY ("), F.array_join(keys, ", "), F.lit(")"))).otherwise("\tPRIMARY KEY (id)" if dialect == "mysql" else "")
    head = F.concat(F.lit("CREATE OR REPLACE TABLE "), name) if dialect == "snowflake" else F.concat(F.lit("DROP TABLE IF EXISTS "), name, F.lit(";\nCREATE TABLE "), name)
    end = {"mysql": "\n) CHARACTER SET=utf8mb4;\n", "sqlserver": "\n)"}.get(dialect, "\n);\n")
    return listed.select("table", "version", F.concat(head, F.lit(" (\n"), F.array_join(F.transform("_rows", lambda r: r["_line"]), ""), pk, F.lit(end)).alias("ddl"))


def add_columns(schema: DataFrame, missing: DataFrame, dialect: str) -> DataFrame:
    """(table, column, ddl): one ALTER for each missing column, never NOT NULL, and string keys as plain strings."""
    rows = with_types(schema.withColumn("is_pk", F.lit(False)), dialect).join(small(missing.select("table", "column")), ["table", "column"])
    verb = " ADD " if dialect == "sqlserver" else " ADD COLUMN "
    return rows.select("table", "column", F.concat(F.lit("ALTER TABLE "), quote_identifier(F.col("table"), dialect, table=True), F.lit(verb), quote_identifier(F.col("column"), dialect), F.lit(" "), F.col("sql_type"), F.lit(";")).alias("ddl"))


def missing_tables(schema: DataFrame, destination: DataFrame) -> DataFrame:
    return schema.select("table").distinct().join(small(destination.select("table").distinct()), "table", "left_anti")


def missing_columns(schema: DataFrame, destination: DataFrame) -> DataFrame:
    """Columns that the destination's table lacks; tables that it lacks altogether aren't listed."""
    there = schema.join(small(destination.select("table").distinct()), "table", "left_semi")
    return there.select("table", "column").distinct().join(small(destination.select("table", "column")), ["table", "column"], "left_anti")


def reconcile(schema: DataFrame, destination: DataFrame) -> DataFrame:
    """(table, action, columns) at start: create what is missing, widen what lacks columns."""
    create = missing_tables(schema, destination).select("table", F.lit("create").alias("action"), F.array().cast("array<string>").alias("columns"))
    widen = missing_columns(schema, destination).groupBy("table").agg(F.sort_array(F.collect_set("column")).alias("columns")).select("table", F.lit("add_columns").alias("action"), "columns")
    return create.unionByName(widen)


def migration_plan(events: DataFrame, schemas: DataFrame, current: DataFrame, order: str) -> DataFrame:
    """(table, version, first_seq, action, columns): at which event a batch has to be cut, and what to do before it.

    ``current``: (table, version) known so far. A version's columns are compared with those of all versions before it.
    """
    first = events.groupBy("table", F.col("modelVersion").alias("version")).agg(F.min(order).alias("first_seq"))
    known = current.select("table", "version", F.lit(-1).cast("long").alias("first_seq"))
    steps = known.unionByName(first.join(current, ["table", "version"], "left_anti"))
    columns = schemas.groupBy("table", "version").agg(F.collect_set("column").alias("_cols"))
    by = W.partitionBy("table").orderBy("first_seq")
    before = by.rowsBetween(W.unboundedPreceding, -1)
    steps = steps.join(columns, ["table", "version"], "left").withColumn("_had", F.array_distinct(F.flatten(F.collect_list("_cols").over(before)))).withColumn("_n", F.row_number().over(by))
    new = F.sort_array(F.array_except("_cols", "_had"))
    action = F.when(F.col("_n") == 1, "create").when(F.size(new) > 0, "add_columns").otherwise("advance")
    return steps.filter("first_seq >= 0").select("table", "version", "first_seq", action.alias("action"), F.when(F.col("_n") > 1, new).otherwise(F.array().cast("array<string>")).alias("columns"))


def column_map(schema: DataFrame) -> DataFrame:
    """(table, version, columns): the columns of each version as a map of name to type."""
    return schema.groupBy("table", "version").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("column", "type")))).alias("columns"))


def migrate(spark: SparkSession, database: str, schema: DataFrame, plan: DataFrame, recreate: bool = False) -> list[str]:
    """Carry out a reconcile or migration plan on tables of the session's catalog; returns the statements.

    New tables are created, existing ones get their missing columns; nothing is dropped or retyped, but that ``recreate``
    drops a table that is to be created and is there, with its rows: an import begins with an empty one.
    """
    typed = with_types(column_order(schema), "spark")
    columns: dict[str, list[tuple[str, str]]] = {}
    for r in typed.orderBy("table", "version", "place").select("table", "column", "sql_type").collect():  # metadata, a row a column
        if (r["column"], r["sql_type"]) not in columns.setdefault(r["table"], []):
            columns[r["table"]].append((r["column"], r["sql_type"]))
    done = []
    for step in plan.select("table", "action", "columns").collect():
        name = f"`{database}`.`{step['table']}`"
        wanted = columns.get(step["table"], [])
        if step["action"] == "create":
            if recreate:
                done.append(f"DROP TABLE IF EXISTS {name}")
            done.append(f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(f'`{c}` {t}' for c, t in wanted)}) USING parquet")
        elif step["columns"]:
            there = {f.name for f in spark.table(name).schema}
            new = [(c, t) for c, t in wanted if c in step["columns"] and c not in there]
            if new:
                done.append(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{c}` {t}' for c, t in new)})")
    for statement in done:
        spark.sql(statement)
    return done
