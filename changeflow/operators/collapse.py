"""Order and collapse of change records per key, with windows over blocks of a key's history and one grouped aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..model import DELETE, UPDATE, mvcc
from . import blocks


def sort_by_mvcc(events: DataFrame, arrival: str, compare: str = "decimal", column: str = "mvccTimestamp") -> DataFrame:
    """Adds ``seq_key``, a total order: commit timestamp, then arrival."""
    return events.withColumn("seq_key", F.struct(mvcc(F.col(column), compare).alias("mvcc"), F.col(arrival).alias("arrival")))


def islands(records: DataFrame, keys: list[str], order: str, op: str = "op") -> DataFrame:
    """Rows that survive the last DELETE of their key, numbered by runs: UPDATE after UPDATE goes on, all else starts anew.

    Runs are numbered inside blocks first; a block's number of runs, and whether its first goes on from the block before, carry over.
    """
    dealt = blocks.Blocks(records, keys, order)
    rows = dealt.carry(dealt.rows, {"_d": F.max(F.when(F.col(op) == DELETE, F.col(order)))}, {"_ld": F.max("_d").over(blocks.whole())}, alone={"_ld": F.col("_d")})
    by = dealt.inside()
    tail = rows.filter(F.col("_ld").isNull() | (F.col(order) >= F.col("_ld")))
    tail = tail.withColumn("_starts", F.when((F.col(op) == UPDATE) & (F.lag(op).over(by) == UPDATE), 0).otherwise(1)).withColumn("_run", F.sum("_starts").over(by.rowsBetween(W.unboundedPreceding, W.currentRow)))
    goes_on = F.when((F.col("_head") == UPDATE) & (F.lag("_tail").over(blocks.in_order()) == UPDATE), 1).otherwise(0)
    facts = {"_head": F.min_by(op, order), "_tail": F.max_by(op, order), "_n": F.sum("_starts")}
    offset = F.coalesce(F.sum(F.col("_n") - F.col("_on")).over(blocks.before()), F.lit(0)) - F.col("_on")
    tail = dealt.carry(tail, facts, {"_on": goes_on}, {"_offset": offset}, alone={"_offset": F.lit(0).cast("long")})
    return dealt.clean(tail.withColumn("grp", F.col("_run") + F.col("_offset")), "_ld", "_starts", "_run", "_offset")


def _entries(diff: str) -> Column:
    """(kind, pos, name) of each name of a diff: kind 1."""
    return F.coalesce(F.transform(diff, lambda x, i: F.struct(F.lit(1).alias("kind"), i.alias("pos"), x.cast("string").alias("name"))), F.array())


def _runs(rows: DataFrame, keys: list[str], order: str, op: str, diff: str, first: bool, aggs: dict[str, Column], obj: str | None = None) -> DataFrame:
    """One row a run. Changes are dealt into (run, name) and combined name by name, so that what is collected of a run is as
    long as its distinct names, however many changes it has. ``aggs`` are over the changes themselves.
    """
    entry = "struct<kind:int,pos:int,name:string"
    own = F.array(F.struct(F.lit(0).alias("kind"), F.lit(0).alias("pos"), F.lit(None).cast("string").alias("name")))
    entries = F.concat(own.cast(f"array<{entry}>>"), _entries(diff).cast(f"array<{entry}>>"))
    if obj:
        kind = rows.schema[obj].dataType.valueType.simpleString()
        fields = F.transform(F.map_entries(obj), lambda x, i: F.struct(F.lit(2).alias("kind"), i.alias("pos"), x["key"].alias("name"), x["value"].alias("value")))
        none = F.lit(None).cast(kind)
        entries = F.transform(entries, lambda x: F.struct(x["kind"].alias("kind"), x["pos"].alias("pos"), x["name"].alias("name"), none.alias("value")))
        whole = f"array<{entry},value:{kind}>>"
        entries = F.concat(entries.cast(whole), F.coalesce(fields.cast(whole), F.array().cast(whole)))
    dealt = rows.withColumn("_e", F.explode(entries)).withColumn("_kind", F.col("_e.kind")).withColumn("_name", F.col("_e.name"))
    at = F.struct(F.col(order), F.col("_e.pos"))
    parts = {"_op": F.min_by(op, order), "_n": F.count(F.lit(1)), "_first": F.min(order), "_last": F.max(order), "_begin": F.min(at), "_end": F.max(at)} | aggs
    if obj:
        parts["_value"] = F.max_by("_e.value", at)
    named = dealt.groupBy(*keys, "grp", "_kind", "_name").agg(*[c.alias(n) for n, c in parts.items()])
    itself = lambda n: F.max_by(n, F.when(F.col("_kind") == 0, 1))
    names = F.transform(F.array_sort(F.collect_list(F.when(F.col("_kind") == 1, F.struct("_begin", "_name")))), lambda x: x["_name"])
    out = [itself("_op").alias(op), names.alias(diff), itself("_n").alias("n")]
    out += [itself("_first").alias("first_" + order)] if first else []
    out += [itself("_last").alias("last_" + order), *[itself(n).alias(n) for n in aggs]]
    if obj:
        listed = F.array_sort(F.collect_list(F.when(F.col("_kind") == 2, F.struct("_end", "_name", "_value"))))
        out.append(F.map_from_entries(F.transform(listed, lambda x: F.struct(x["_name"], x["_value"]))).alias(obj))
    return named.groupBy(*keys, "grp").agg(*out)


def collapse(records: DataFrame, keys: list[str], order: str, values: list[str], op: str = "op", diff: str = "diff", present: str | None = None) -> DataFrame:
    """One row a run: keys, grp, op, diff, n, first and last order, and the latest of each value column.

    ``present`` names an array column of the value columns a record really has; without it all of them count. No window holds
    more than one block of a key's rows; merged columns are combined before the result is shuffled again.
    """
    rows = islands(records, keys, order, op)
    latest = {c: F.max_by(F.when(F.col("_kind") == 0, F.col(c)), F.when(F.array_contains(present, c), F.col(order)) if present else F.col(order)) for c in values}
    return _runs(rows, keys, order, op, diff, True, latest)


def collapse_objects(records: DataFrame, keys: list[str], order: str, obj: str = "object", op: str = "op", diff: str = "diff") -> DataFrame:
    """As ``collapse`` for records whose row image is a map: later keys overwrite earlier ones."""
    rows = islands(records, keys, order, op)
    return _runs(rows, keys, order, op, diff, False, {}, obj)
