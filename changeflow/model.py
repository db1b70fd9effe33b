"""Change events: schema, JSON decoding, primary keys and row images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INSERT, UPDATE, DELETE = "INSERT", "UPDATE", "DELETE"

#: The wire format. ``before`` and ``after`` stay raw JSON text; ``imported`` is set by snapshot loads only.
EVENT = T.StructType([
    T.StructField("operation", T.StringType()), T.StructField("id", T.StringType()), T.StructField("table", T.StringType()),
    T.StructField("key", T.ArrayType(T.StringType())), T.StructField("modelVersion", T.StringType()), T.StructField("companyId", T.StringType()),
    T.StructField("locationId", T.StringType()), T.StructField("userId", T.StringType()), T.StructField("before", T.StringType()),
    T.StructField("after", T.StringType()), T.StructField("diff", T.ArrayType(T.StringType())), T.StructField("timestamp", T.LongType()),
    T.StructField("mvccTimestamp", T.StringType()), T.StructField("imported", T.BooleanType()),
])

OBJECT = "map<string,string>"


def image(after: Column, before: Column) -> Column:
    """The row image of an event as JSON text: ``after`` unless it is missing or empty, else ``before``."""
    filled = lambda c: F.when(F.length(c) > 0, c)
    return F.coalesce(filled(after), filled(before))


def parse_object(text: Column) -> Column:
    """JSON object to map of texts; absent keys stay absent and null values stay null."""
    return F.from_json(text, OBJECT)


def parse_typed(text: Column) -> Column:
    """JSON object to a map of typed values, which ``functions.quoting.quote_variant`` writes as literals."""
    return F.from_json(text, "map<string,variant>")


def primary_key(key: Column, obj: Column) -> Column:
    """Last part of the key, else the object's id, else the empty string."""
    return F.coalesce(F.when(F.size(key) >= 1, F.try_element_at(key, F.lit(-1))), F.try_element_at(obj, F.lit("id")), F.lit(""))


def decode(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON lines to event columns plus ``object``, ``pk`` and ``error`` (null for good events).

    Errors are bad JSON, a malformed row image and an empty primary key. Nothing is dropped here: callers filter on
    ``error`` or send such rows aside.
    """
    schema = T.StructType([*EVENT.fields, T.StructField("_bad", T.StringType())])
    # a generator of one row: filters on what it gives can't be moved below it, where they would parse the text once more
    parsed = lines.select(F.inline(F.array(F.from_json(column, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))))
    parsed = parsed.select("*", F.explode(F.array(parse_object(image(F.col("after"), F.col("before"))))).alias("object"))
    has_image = image(F.col("after"), F.col("before")).isNotNull()
    parsed = parsed.withColumn("pk", primary_key(F.col("key"), F.col("object")))
    error = (
        F.when(F.col("_bad").isNotNull() | F.col("operation").isNull(), "bad json")
        .when(has_image & F.col("object").isNull(), "bad row image")
        .when(F.col("pk") == "", "no primary key")
    )
    return parsed.withColumn("error", error).drop("_bad")


def mvcc(text: Column, compare: str = "decimal") -> Column:
    """Sort key of a commit timestamp: exact decimal, or double with its loss of nanoseconds; unreadable text is 0."""
    kind = "decimal(38,10)" if compare == "decimal" else "double"
    return F.coalesce(text.try_cast(kind), F.lit(0).cast(kind))


def event_json() -> Column:
    """An event as sinks write it: wire fields in order, optional fields only when set, empty diffs left out."""
    optional = {"companyId", "locationId", "userId", "before", "after", "diff", "imported"}
    value = {"diff": F.when(F.size("diff") > 0, F.col("diff"))}
    fields = [value.get(f.name, F.col(f.name) if f.name in optional else F.coalesce(F.col(f.name), _zero(f.dataType))).alias(f.name) for f in EVENT.fields]
    return F.to_json(F.struct(*fields))


def _zero(kind: T.DataType) -> Column:
    return F.lit(0).cast("long") if isinstance(kind, T.LongType) else F.lit("") if isinstance(kind, T.StringType) else F.lit(None).cast(kind)
