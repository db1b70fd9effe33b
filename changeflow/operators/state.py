"""Key-value state with expiry, as tables: reads filter, writes are one outer join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def read(state: DataFrame, now) -> DataFrame:
    """Entries that haven't expired."""
    return state.filter(F.col("expires_at").isNull() | (F.col("expires_at") > F.lit(now)))


def upsert(state: DataFrame, changes: DataFrame) -> DataFrame:
    """(key, value, expires_at): changed keys take the change whole, expiry included; others stay."""
    new = changes.select("key", F.struct("value", "expires_at").alias("_new"))
    both = state.select("key", F.struct("value", "expires_at").alias("_old")).join(new, "key", "full_outer")
    return both.select("key", F.coalesce("_new", "_old").alias("_e")).select("key", "_e.value", "_e.expires_at")


def delete_prefix(state: DataFrame, prefix: str) -> DataFrame:
    return state.filter(~F.col("key").startswith(prefix))


def table_versions(events: DataFrame, order: str, version: str = "modelVersion") -> DataFrame:
    """(table, version): the version of each table's latest event."""
    return events.groupBy("table").agg(F.max_by(version, order).alias("version"))
