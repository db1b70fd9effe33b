"""Schema registry over JSON files: one document a table and version, as the registry service serves them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import small

_PROPERTY = "struct<type:string,format:string,nullable:boolean,items:struct<type:string,enum:array<string>>,additionalProperties:boolean>"
DOCUMENT = f"table string, modelVersion string, required array<string>, primaryKeys array<string>, properties map<string,{_PROPERTY}>"


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (table, version, column, type, format, nullable, required, is_pk, pk_place, enum) of all documents in a folder; a file is one document or an array of them."""
    docs = spark.read.schema(DOCUMENT).option("multiLine", "true").option("recursiveFileLookup", "true").json(folder)
    rows = docs.select("table", F.col("modelVersion").alias("version"), "required", "primaryKeys", F.explode("properties").alias("column", "p"))
    place = F.array_position("primaryKeys", F.col("column"))
    return rows.select(
        "table", "version", "column", "p.type", "p.format", F.coalesce("p.nullable", F.lit(False)).alias("nullable"), F.array_contains("required", F.col("column")).alias("required"),
        (place > 0).alias("is_pk"), F.when(place > 0, place.cast("int")).alias("pk_place"), F.coalesce(F.size("p.items.enum") > 0, F.lit(False)).alias("enum"),
    )


def latest(schema: DataFrame, versions: DataFrame) -> DataFrame:
    """Rows of each table's version in ``versions`` (table, version)."""
    return schema.join(small(versions), ["table", "version"], "left_semi")
