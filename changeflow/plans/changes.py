"""Collapse, ordering and application queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import apply, collapse
from .feeds import COLUMNS, EVENTS_SQL, TARGET_SQL, event_feed, order_feed, ORDERS_SQL, user_target

TAIL_SQL = f"""{EVENTS_SQL}, {TARGET_SQL},
deletes AS (SELECT pk, max(seq) AS ld FROM feed WHERE op = 'DELETE' GROUP BY pk),
tail AS (SELECT f.*, ld, row_number() OVER (PARTITION BY f.pk ORDER BY seq) AS rn FROM feed f LEFT JOIN deletes d ON d.pk = f.pk WHERE ld IS NULL OR seq > ld),
base AS (SELECT * FROM target WHERE pk NOT IN (SELECT pk FROM deletes)),
keys AS (SELECT pk FROM tail UNION SELECT pk FROM base)"""


def collapse_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = collapse.collapse(event_feed(spark, sf_dir), ["pk"], "seq", COLUMNS)
    return out.select("pk", "grp", "op", F.concat_ws(",", "diff").alias("diff"), "n", "first_seq", "last_seq", *COLUMNS)


COLLAPSE_SQL = f"""
WITH {EVENTS_SQL},
tail AS (SELECT *, max(CASE WHEN op = 'DELETE' THEN seq END) OVER (PARTITION BY pk) AS ld FROM feed),
marked AS (SELECT *, CASE WHEN op = 'UPDATE' AND lag(op) OVER (PARTITION BY pk ORDER BY seq) = 'UPDATE' THEN 0 ELSE 1 END AS starts FROM tail WHERE ld IS NULL OR seq >= ld),
runs AS (SELECT *, sum(starts) OVER (PARTITION BY pk ORDER BY seq) AS grp FROM marked),
names AS (SELECT pk, grp, d, min(seq * 10 + i) AS place FROM (SELECT pk, grp, seq, unnest(diff) AS d, generate_subscripts(diff, 1) AS i FROM runs) GROUP BY ALL),
diffs AS (SELECT pk, grp, string_agg(d, ',' ORDER BY place) AS diff FROM names GROUP BY ALL)
SELECT r.pk, r.grp::BIGINT AS grp, min_by(op, seq) AS op, coalesce(any_value(d.diff), '') AS diff, count(*) AS n, min(seq) AS first_seq, max(seq) AS last_seq,
  arg_max_null(value, seq) AS value, arg_max_null(props, seq) AS props, arg_max_null(ts, seq) AS ts
FROM runs r LEFT JOIN diffs d ON d.pk = r.pk AND d.grp = r.grp GROUP BY r.pk, r.grp"""


def apply_postgres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply.changed_columns_upsert(user_target(spark, sf_dir), event_feed(spark, sf_dir), "pk", COLUMNS, "seq")


def _hit_sql(condition: str, insert: str = "{c}") -> str:
    parts = []
    for c in COLUMNS:
        hit = condition.format(c=c)
        parts.append(f"CASE WHEN max(CASE WHEN {hit} THEN seq END) IS NOT NULL THEN arg_max_null({c}, CASE WHEN {hit} THEN seq END) END AS {c}, max(CASE WHEN {hit} THEN seq END) AS at_{c}, arg_min_null({insert.format(c=c)}, seq) AS ins_{c}, min(seq) AS first_seq_{c}")
    return f"folded AS (SELECT t.pk, {', '.join(parts)} FROM tail t GROUP BY t.pk)"


APPLY_POSTGRES_SQL = f"""
WITH {TAIL_SQL},
{_hit_sql("op <> 'UPDATE' OR list_contains(diff, '{c}')")}
SELECT k.pk, {", ".join(f"CASE WHEN f.at_{c} IS NOT NULL THEN f.{c} WHEN b.pk IS NOT NULL THEN b.{c} ELSE f.ins_{c} END AS {c}" for c in COLUMNS)}
FROM keys k LEFT JOIN folded f ON f.pk = k.pk LEFT JOIN base b ON b.pk = k.pk"""


def apply_mysql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply.replace_rows(user_target(spark, sf_dir), event_feed(spark, sf_dir), "pk", COLUMNS, "seq")


APPLY_MYSQL_SQL = f"""
WITH {TAIL_SQL},
last AS (SELECT * FROM tail QUALIFY row_number() OVER (PARTITION BY pk ORDER BY seq DESC) = 1)
SELECT k.pk, {", ".join(f"CASE WHEN l.pk IS NOT NULL THEN l.{c} ELSE b.{c} END AS {c}" for c in COLUMNS)}
FROM keys k LEFT JOIN last l ON l.pk = k.pk LEFT JOIN base b ON b.pk = k.pk"""


def _with_nulls(feed: DataFrame) -> DataFrame:
    """Every third event carries no value."""
    return feed.withColumn("value", F.when(F.col("seq") % 3 != 0, F.col("value")))


def apply_sqlserver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply.coercing_merge(user_target(spark, sf_dir), _with_nulls(event_feed(spark, sf_dir)), "pk", COLUMNS, "seq", {"value": 0.0})


APPLY_SQLSERVER_SQL = f"""
WITH {TAIL_SQL.replace("value, props, ts FROM events", "CASE WHEN event_id % 3 <> 0 THEN value END AS value, props, ts FROM events")},
{_hit_sql("len(diff) = 0 OR list_contains(diff, '{c}')")}
SELECT k.pk, {", ".join(f"CASE WHEN b.pk IS NULL AND (f.at_{c} IS NULL OR f.at_{c} = f.first_seq_{c}) THEN {'coalesce(f.ins_value, 0)' if c == 'value' else f'f.ins_{c}'} WHEN f.at_{c} IS NOT NULL THEN f.{c} ELSE b.{c} END AS {c}" for c in COLUMNS)}
FROM keys k LEFT JOIN folded f ON f.pk = k.pk LEFT JOIN base b ON b.pk = k.pk"""


def _shuffled_dates(feed: DataFrame) -> DataFrame:
    """Stamps out of step with arrival: late rows turn up."""
    return feed.withColumn("ts", F.col("ts") - F.expr("make_dt_interval(cast(seq * 7919 % 40 as int))"))


NEWER_SQL = TAIL_SQL.replace("value, props, ts FROM events)", "value, props, ts - to_days((event_id * 7919 % 40)::INT) AS ts FROM events)")


def apply_snowflake_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply.merge_if_newer(user_target(spark, sf_dir), _shuffled_dates(event_feed(spark, sf_dir)), "pk", COLUMNS, "seq", "ts")


APPLY_AFTER_SQL = f"""
WITH {NEWER_SQL},
dated AS (
  SELECT t.*, b.pk IS NOT NULL AS based, b.ts AS base_ts, max(t.ts) OVER (PARTITION BY t.pk ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier,
    first_value(t.ts) OVER (PARTITION BY t.pk ORDER BY seq) AS first_ts FROM tail t LEFT JOIN base b ON b.pk = t.pk),
judged AS (
  SELECT *, (NOT based AND rn = 1) OR coalesce((CASE WHEN based THEN base_ts ELSE first_ts END) IS NOT NULL AND ts > greatest(CASE WHEN based THEN base_ts END, earlier), false) AS applies FROM dated),
last AS (SELECT * FROM judged WHERE applies QUALIFY row_number() OVER (PARTITION BY pk ORDER BY seq DESC) = 1)
SELECT k.pk, {", ".join(f"CASE WHEN l.pk IS NOT NULL THEN l.{c} ELSE b.{c} END AS {c}" for c in COLUMNS)}
FROM keys k LEFT JOIN last l ON l.pk = k.pk LEFT JOIN base b ON b.pk = k.pk"""


def apply_snowflake_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = collapse.collapse(_shuffled_dates(event_feed(spark, sf_dir)), ["pk"], "seq", COLUMNS).withColumnRenamed("last_seq", "seq")
    return apply.update_or_merge(user_target(spark, sf_dir), records, "pk", COLUMNS, "seq", "ts")


def _standard_sql() -> str:
    runs = COLLAPSE_SQL.strip().removeprefix("WITH ").replace("value, props, ts FROM events)", "value, props, ts - to_days((event_id * 7919 % 40)::INT) AS ts FROM events)")
    head, _, tail = runs.rpartition("\nSELECT r.pk")
    return f"""
WITH RECURSIVE {head}, {TARGET_SQL},
records AS (SELECT r.pk{tail.removesuffix("")}),
numbered AS (SELECT *, row_number() OVER (PARTITION BY pk ORDER BY grp) AS k FROM records),
ids AS (SELECT pk FROM records UNION SELECT pk FROM target),
fold AS (
  SELECT i.pk, 0 AS k, t.pk IS NOT NULL AS there, t.value, t.props, t.ts FROM ids i LEFT JOIN target t ON t.pk = i.pk
  UNION ALL
  SELECT f.pk, n.k, CASE n.op WHEN 'DELETE' THEN false WHEN 'UPDATE' THEN f.there ELSE true END AS there,
    {", ".join(f"CASE WHEN n.op = 'DELETE' THEN NULL WHEN n.op = 'UPDATE' THEN CASE WHEN f.there AND list_contains(string_split(n.diff, ','), '{c}') THEN n.{c} ELSE f.{c} END WHEN NOT f.there OR coalesce(n.ts > f.ts, false) THEN n.{c} ELSE f.{c} END AS {c}" for c in COLUMNS)}
  FROM fold f JOIN numbered n ON n.pk = f.pk AND n.k = f.k + 1)
SELECT pk, value, props, ts FROM fold QUALIFY there AND k = max(k) OVER (PARTITION BY pk)"""


def delete_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both readings of a two-part key [half of pk, pk]: by the first part and by the last."""
    target = user_target(spark, sf_dir).select("pk")
    deletes = event_feed(spark, sf_dir).select("op", F.array(F.floor(F.col("pk") / 2).cast("string"), F.col("pk").cast("string")).alias("key"))
    parts = [apply.delete_by_key(target, deletes, "pk", "key", which).select(F.lit(which).alias("which"), "pk") for which in ("first", "last")]
    return parts[0].unionByName(parts[1])


DELETE_SQL = f"""
WITH {EVENTS_SQL}, {TARGET_SQL}
SELECT 'first' AS which, pk FROM target WHERE pk NOT IN (SELECT pk // 2 FROM feed WHERE op = 'DELETE')
UNION ALL SELECT 'last' AS which, pk FROM target WHERE pk NOT IN (SELECT pk FROM feed WHERE op = 'DELETE')"""


def sort_mvcc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of each order in its customer's history by a commit timestamp that needs more digits than a double has."""
    text = F.concat(F.lit("17207326117085"), F.lpad((F.col("seq") * 7 % 100000).cast("string"), 5, "0"), F.lit(".0000000000"))
    feed = order_feed(spark, sf_dir).withColumn("mvccTimestamp", F.when(F.col("seq") % 17 == 0, "x").otherwise(text))
    keyed = collapse.sort_by_mvcc(feed, "seq")
    from pyspark.sql import Window as W

    return keyed.select("pk", "seq", F.row_number().over(W.partitionBy("pk").orderBy("seq_key")).alias("place"))


SORT_SQL = f"""
WITH {ORDERS_SQL}
SELECT pk, seq, row_number() OVER (PARTITION BY pk ORDER BY CASE WHEN seq % 17 = 0 THEN 0 ELSE ('17207326117085' || lpad((seq * 7 % 100000)::VARCHAR, 5, '0') || '.0000000000')::DECIMAL(38, 10) END, seq)::INT AS place FROM feed"""

QUERIES = {f.__name__: f for f in (collapse_by_key, apply_postgres, apply_mysql, apply_sqlserver, apply_snowflake_after, apply_snowflake_standard, delete_by_key, sort_mvcc)}
ORACLES = {
    "collapse_by_key": COLLAPSE_SQL, "apply_postgres": APPLY_POSTGRES_SQL, "apply_mysql": APPLY_MYSQL_SQL, "apply_sqlserver": APPLY_SQLSERVER_SQL, "apply_snowflake_after": APPLY_AFTER_SQL,
    "apply_snowflake_standard": _standard_sql(), "delete_by_key": DELETE_SQL, "sort_mvcc": SORT_SQL,
}
