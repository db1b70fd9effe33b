"""Filters and projections of change events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import DELETE, UPDATE

#: Names that say nothing about a row's content (fixed values).
TRIVIAL = ["updatedDate", "meta"]
SMALL_ROWS = 100_000


def small(df: DataFrame) -> DataFrame:
    """A dimension that may be sent to all tasks, if its counted rows allow it; a shuffle join serves the rest.

    The rest is marked for a sort-merge join: sizes that Spark estimates from files would have it sent to all tasks whatever its rows.
    """
    return F.broadcast(df) if df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else df.hint("merge")


def after_export(events: DataFrame, watermarks: DataFrame, table: str = "table", stamp: str = "ts") -> DataFrame:
    """Drops events older than their table's snapshot; equal stamps and tables without a snapshot pass."""
    marks = small(watermarks.select(F.col("table").alias("_table"), F.col("export_ts")))
    return events.join(marks, events[table] == F.col("_table"), "left").filter(F.col("export_ts").isNull() | (F.col(stamp) >= F.col("export_ts"))).drop("_table", "export_ts")


def of_tenants(events: DataFrame, allowed: list, credentials: list | None = None, column: str = "companyId") -> DataFrame:
    """Events of the given companies, which have to be among the credentials' own."""
    if credentials is not None and (more := set(allowed) - set(credentials)):
        raise ValueError(f"no access to companies {sorted(more)}")
    return events.filter(F.col(column).isin(list(allowed)))


def updated_after(rows: DataFrame, column: str, offset) -> DataFrame:
    """Pushed to the scan: rows updated at or after a point in time."""
    return rows.filter(F.col(column) >= F.lit(offset))


def without_trivial_updates(records: DataFrame, op: str = "op", diff: str = "diff") -> DataFrame:
    """Drops UPDATEs whose diff is empty, names only ``updatedDate``, or ``updatedDate`` and ``meta``."""
    rest = F.size(F.array_except(F.coalesce(diff, F.array().cast("array<string>")), F.array(*map(F.lit, TRIVIAL))))
    only = (F.coalesce(F.size(diff), F.lit(0)) <= 0) | ((rest == 0) & F.array_contains(diff, TRIVIAL[0]))
    return records.filter(~((F.col(op) == UPDATE) & only))


def known_properties(obj: Column, columns: Column, op: Column | None = None) -> Column:
    """The object without keys that the event's schema doesn't have; DELETEs keep theirs."""
    pruned = F.map_filter(obj, lambda k, _: F.array_contains(columns, k))
    return pruned if op is None else F.when(op == DELETE, obj).otherwise(pruned)


def effective_diff(diff: Column, columns: Column, drop_id: bool = True) -> Column:
    """Names of the diff that are columns, without ``id`` where the dialect leaves it out."""
    kept = F.array_intersect(F.coalesce(diff, F.array().cast("array<string>")), columns)
    return F.array_except(kept, F.array(F.lit("id"))) if drop_id else kept


def widened_diff(diff: Column, new_columns: Column) -> Column:
    """A diff after a migration: columns that were added count as changed."""
    return F.array_union(F.coalesce(diff, F.array().cast("array<string>")), new_columns)


def batch_records(events: DataFrame) -> DataFrame:
    """Decoded events as records of a batch: table, id, op, diff, object, event."""
    return events.select("table", F.col("pk").alias("id"), F.col("operation").alias("op"), "diff", "object", F.struct(*[c for c in events.columns if c not in ("pk", "object", "error")]).alias("event"))


def join_schema(events: DataFrame, schemas: DataFrame) -> DataFrame:
    """Each event with the columns of its table at its version; events of unknown versions have null columns."""
    return events.join(small(schemas.select("table", F.col("version").alias("modelVersion"), "columns")), ["table", "modelVersion"], "left")
