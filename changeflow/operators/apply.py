"""Application of ordered changes to a target table, one function a rule.

All rules fold the changes of a key to one row first (windows over blocks of its history and grouped aggregates, combined
before the shuffle) and meet the target in a single full outer join on the key: a MERGE without a MERGE statement. Target and
changes are dealt by the same key, so a target bucketed by it isn't shuffled. Changes have ``op``, ``diff``, the order column and
one column a target column. Within a key, ``seq`` after its last DELETE is the tail; a key survives if the target has it and
no DELETE came, or if the tail isn't empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..model import DELETE, INSERT, UPDATE
from .blocks import Blocks, before, in_order, whole


def _merge(target: DataFrame, folded: DataFrame, key: str, columns: list[str], value: Callable[[str, Column, Column], Column]) -> DataFrame:
    """Full outer join; ``value`` gets a column's name, whether the old row still counts, and its old value."""
    old = target.select(F.col(key), *[F.col(c).alias(f"_old_{c}") for c in columns], F.lit(True).alias("_base"))
    both = old.join(folded, key, "full_outer")
    deleted, tail = F.coalesce(F.col("_deleted"), F.lit(False)), F.coalesce(F.col("_tail"), F.lit(0)) > 0
    base = F.coalesce(F.col("_base"), F.lit(False)) & ~deleted
    return both.filter(base | tail).select(key, *[value(c, base, F.col(f"_old_{c}")).alias(c) for c in columns])


def _fold_columns(changes: DataFrame, key: str, columns: list[str], order: str, hit: Callable[[str], Column]) -> DataFrame:
    """One row a key: changes after the last DELETE (_tail), whether there was one (_deleted), place of the first change after it
    (_first), and for each column the place and value of its last hit (_at_, _hit_) and its value in the first change (_ins_).

    Changes are folded in blocks of the order first, if there are several, then the blocks' rows: a key with very many changes is many
    groups, each in a task of its own, and only its few block rows meet.
    """
    dealt = Blocks(changes, [key], order)
    rows = dealt.rows.withColumn("_ld", F.max(F.when(F.col("op") == DELETE, F.col(order))).over(W.partitionBy(*dealt.keys)))
    in_tail = F.col("_ld").isNull() | (F.col(order) > F.col("_ld"))
    at = lambda cond: F.when(in_tail & cond, F.col(order))
    first = at(F.lit(True))
    part = [F.count(first).alias("_tail"), F.max("_ld").isNotNull().alias("_deleted"), F.min(first).alias("_first")]
    total = [F.sum("_tail").alias("_tail"), F.max("_deleted").alias("_deleted"), F.min("_first").alias("_first")]
    for c in columns:
        part += [F.max(at(hit(c))).alias(f"_at_{c}"), F.max_by(c, at(hit(c))).alias(f"_hit_{c}"), F.min_by(c, first).alias(f"_ins_{c}")]
        total += [F.max(f"_at_{c}").alias(f"_at_{c}"), F.max_by(f"_hit_{c}", f"_at_{c}").alias(f"_hit_{c}"), F.min_by(f"_ins_{c}", "_first").alias(f"_ins_{c}")]
    folded = rows.groupBy(*dealt.keys).agg(*part)
    if dealt.many:
        folded = folded.withColumn("_from", F.max(F.when(F.col("_deleted"), F.col("_block"))).over(whole()))
        folded = folded.filter(F.col("_from").isNull() | (F.col("_block") >= F.col("_from"))).groupBy("_k").agg(*total)
    return folded.select(F.col("_k")[key].alias(key), *[c for c in folded.columns if c not in ("_k", "_block")])


def changed_columns_upsert(target: DataFrame, changes: DataFrame, key: str, columns: list[str], order: str) -> DataFrame:
    """PostgreSQL rule: an UPDATE sets the columns of its diff, or inserts the whole row if there is none; an INSERT sets all."""
    folded = _fold_columns(changes, key, columns, order, lambda c: (F.col("op") != UPDATE) | F.coalesce(F.array_contains("diff", c), F.lit(False)))
    return _merge(target, folded, key, columns, lambda c, base, old: F.when(F.col(f"_at_{c}").isNotNull(), F.col(f"_hit_{c}")).when(base, old).otherwise(F.col(f"_ins_{c}")))


def replace_rows(target: DataFrame, changes: DataFrame, key: str, columns: list[str], order: str) -> DataFrame:
    """MySQL rule: the last row image replaces the row."""
    folded = _fold_columns(changes, key, columns, order, lambda c: F.lit(True))
    return _merge(target, folded, key, columns, lambda c, base, old: F.when(F.coalesce("_tail", F.lit(0)) > 0, F.col(f"_hit_{c}")).otherwise(old))


def coercing_merge(target: DataFrame, changes: DataFrame, key: str, columns: list[str], order: str, coerce: dict[str, object]) -> DataFrame:
    """SQL Server rule: a matched row takes the diff's columns, or all if the diff is empty; an inserted row has nulls coerced.

    ``coerce`` maps columns to what stands for null in inserted rows; values that later updates set are not coerced.
    """
    empty = F.coalesce(F.size("diff") <= 0, F.lit(True))
    folded = _fold_columns(changes, key, columns, order, lambda c: empty | F.coalesce(F.array_contains("diff", c), F.lit(False)))

    def value(c: str, base: Column, old: Column) -> Column:
        filled = (lambda v: F.coalesce(v, F.lit(coerce[c]))) if c in coerce else (lambda v: v)
        hit = F.col(f"_at_{c}").isNotNull()
        inserted = ~base & (~hit | (F.col(f"_at_{c}") == F.col("_first")))
        return F.when(inserted, filled(F.col(f"_ins_{c}"))).when(hit, F.col(f"_hit_{c}")).otherwise(old)

    return _merge(target, folded, key, columns, value)


def merge_if_newer(target: DataFrame, changes: DataFrame, key: str, columns: list[str], order: str, stamp: str, present: str | None = None) -> DataFrame:
    """Snowflake rule with strategy ``after``: a row applies if its stamp is later than all before it, the target's included.

    A NULL stamp never compares: a row that starts with one is never updated until it is deleted. Only present columns are set.
    """
    dealt = Blocks(changes, [key], order)
    rows = dealt.carry(dealt.rows, {"_d": F.max(F.when(F.col("op") == DELETE, F.col(order)))}, {"_ld": F.max("_d").over(whole())}, alone={"_ld": F.col("_d")})
    tail = rows.filter(F.col("_ld").isNull() | (F.col(order) > F.col("_ld")))
    dates = _dates(target, key, stamp, changes)
    by = dealt.inside()
    if dealt.many:
        # what the target has joins the blocks, one row each, and comes to the rows with what is known of the blocks before
        facts = tail.groupBy("_k", "_block").agg(F.min_by(stamp, order).alias("_head"), F.max(stamp).alias("_most"))
        facts = facts.withColumns({"_first": F.first("_head").over(in_order().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)), "_earlier": F.max("_most").over(before()), "_nth": F.row_number().over(in_order())})
        tail = tail.join(facts.join(dates, "_k", "left").select("_k", "_block", "_first", "_earlier", "_nth", "_base_stamp", "_had"), ["_k", "_block"])
    else:
        kind = changes.schema[stamp].dataType
        tail = tail.withColumns({"_first": F.first(stamp).over(by), "_earlier": F.lit(None).cast(kind), "_nth": F.lit(1)}).join(dates, "_k", "left")
    tail = tail.withColumn("_based", F.coalesce("_had", F.lit(False)) & F.col("_ld").isNull()).withColumn("_rn", F.row_number().over(by))
    start = F.when(F.col("_based"), F.col("_base_stamp")).otherwise(F.col("_first"))
    so_far = F.greatest(F.col("_earlier"), F.max(stamp).over(by.rowsBetween(W.unboundedPreceding, -1)))
    newest = F.greatest(F.when(F.col("_based"), F.col("_base_stamp")), so_far)
    first = (F.col("_rn") == 1) & (F.col("_nth") == 1)
    applies = (~F.col("_based") & first) | F.coalesce(start.isNotNull() & (F.col(stamp) > newest), F.lit(False))
    tail = tail.withColumn("_at", F.when(applies, F.col(order)))
    has = (lambda c: F.array_contains(present, c)) if present else (lambda c: F.lit(True))
    folded = tail.groupBy(key).agg(F.count(F.lit(1)).alias("_tail"), *_hits(columns, lambda c: F.when(has(c), F.col("_at"))))
    return _with_hits(target, rows, folded, key, columns)


def _dates(target: DataFrame, key: str, stamp: str, changes: DataFrame) -> DataFrame:
    """Stamps of the target's rows, by the key as a struct; a null key is no row's."""
    rows = target.filter(F.col(key).isNotNull())
    return rows.select(F.struct(F.col(key).cast(changes.schema[key].dataType).alias(key)).alias("_k"), F.col(stamp).alias("_base_stamp"), F.lit(True).alias("_had"))


def _hits(columns: list[str], at: Callable[[str], Column]) -> list[Column]:
    return [x for c in columns for x in (F.max(at(c)).alias(f"_at_{c}"), F.max_by(c, at(c)).alias(f"_hit_{c}"))]


def _with_hits(target: DataFrame, rows: DataFrame, folded: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The target with the last hit of each column; keys of ``rows`` with a DELETE (_ld) begin anew."""
    gone = rows.groupBy("_k").agg(F.max("_ld").isNotNull().alias("_deleted")).join(folded.withColumn("_k", F.struct(key)).drop(key), "_k", "left")
    gone = gone.withColumn(key, F.col("_k")[key]).drop("_k")
    return _merge(target, gone, key, columns, lambda c, base, old: F.when(F.col(f"_at_{c}").isNotNull(), F.col(f"_hit_{c}")).when(base, old))


def update_or_merge(target: DataFrame, records: DataFrame, key: str, columns: list[str], order: str, stamp: str) -> DataFrame:
    """Snowflake rule with strategy ``standard``, over collapsed records; keys of the target are unique.

    INSERT merges if newer, UPDATE sets its diff's columns on a row that exists and is lost on one that doesn't, DELETE removes. A
    key's row exists from its first INSERT on, or from the beginning. An UPDATE may set the stamp back: from such a record on, stamps
    are compared with that one and with those after it only, so a key's history is cut there (``_cut``) and each piece has its own maximum.
    Windows run over a key's collapsed records.
    """
    kinds = {f.name: f.dataType for f in target.schema}
    records = records.withColumns({c: F.col(c).cast(kinds[c]) for c in (key, *columns)})
    rows = records.withColumn("_k", F.struct(key)).withColumn("_ld", F.max(F.when(F.col("op") == DELETE, F.col(order))).over(W.partitionBy("_k")))
    tail = rows.filter(F.col("_ld").isNull() | (F.col(order) > F.col("_ld"))).join(_dates(target, key, stamp, records), "_k", "left")
    by = W.partitionBy("_k").orderBy(order)
    inserts, names = F.col("op") == INSERT, lambda c: F.coalesce(F.array_contains("diff", c), F.lit(False))
    tail = tail.withColumn("_based", F.coalesce("_had", F.lit(False)) & F.col("_ld").isNull())
    born = F.coalesce(F.sum(inserts.cast("long")).over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) > 0
    tail = tail.withColumn("_there", F.col("_based") | born)
    sets = (F.col("op") == UPDATE) & F.col("_there")
    tail = tail.withColumn("_cut", F.sum((sets & names(stamp)).cast("long")).over(by.rowsBetween(W.unboundedPreceding, W.currentRow)))
    piece = W.partitionBy("_k", "_cut").orderBy(order)
    # what a piece begins with: the UPDATE that cuts it, or the INSERT that makes the row; the target's stamp stands for the latter
    opens = F.when((F.col("_cut") > 0) | inserts, F.struct(F.col(stamp).alias("s")))
    tail = tail.withColumn("_head", F.first(opens, ignorenulls=True).over(piece.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    start = F.when((F.col("_cut") == 0) & F.col("_based"), F.col("_base_stamp")).otherwise(F.col("_head.s"))
    newest = F.greatest(start, F.max(F.when(inserts, F.col(stamp))).over(piece.rowsBetween(W.unboundedPreceding, -1)))
    applies = inserts & (~F.col("_there") | F.coalesce(start.isNotNull() & (F.col(stamp) > newest), F.lit(False)))
    tail = tail.withColumn("_applies", applies)
    folded = tail.groupBy(key).agg(F.count(F.when(inserts, 1)).alias("_tail"), *_hits(columns, lambda c: F.when(F.col("_applies") | (sets & names(c)), F.col(order))))
    return _with_hits(target, rows, folded, key, columns)


#: Rules of the warehouse by the name of its update strategy.
STRATEGIES = {"": update_or_merge, "standard": update_or_merge, "after": merge_if_newer}


def by_strategy(strategy: str, target: DataFrame, records: DataFrame, key: str, columns: list[str], order: str, stamp: str) -> DataFrame:
    """The warehouse's rule of that name; changes have to be collapsed for ``standard``."""
    if strategy not in STRATEGIES:
        raise ValueError(f"no update strategy {strategy!r}")
    return STRATEGIES[strategy](target, records, key, columns, order, stamp)


def delete_by_key(target: DataFrame, deletes: DataFrame, key: str, parts: str = "key", which: str = "first") -> DataFrame:
    """Rows of the target whose key isn't deleted; ``which`` part of a multi-part key names the row (dialects differ)."""
    part = F.get(F.col(parts), F.lit(0) if which == "first" else F.size(parts) - 1)
    gone = deletes.filter(F.col("op") == DELETE).select(part.cast(target.schema[key].dataType).alias(key)).distinct()
    return target.join(gone, key, "left_anti")
