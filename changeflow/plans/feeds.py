"""Change feeds over the test tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ["value", "props", "ts"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_feed(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """``events``, or a stream of its rows, as changes of users: pk, seq, op, diff, value, props, ts."""
    kind = F.col("event_type")
    return (table(spark, sf_dir, "events") if events is None else events).select(
        F.col("user_id").alias("pk"), F.col("event_id").alias("seq"), F.when(kind == "signup", "INSERT").when(kind == "error", "DELETE").otherwise("UPDATE").alias("op"),
        F.when(kind == "click", F.array(F.lit("value"))).when(kind == "view", F.array(F.lit("props"))).when(kind == "purchase", F.array(F.lit("value"), F.lit("props"))).otherwise(F.array().cast("array<string>")).alias("diff"),
        *COLUMNS,
    )


EVENTS_SQL = """feed AS (
  SELECT user_id AS pk, event_id AS seq, CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS op,
    CASE event_type WHEN 'click' THEN ['value'] WHEN 'view' THEN ['props'] WHEN 'purchase' THEN ['value', 'props'] ELSE []::VARCHAR[] END AS diff,
    value, props, ts FROM events)"""


def user_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target that has every even user already, stamped in the middle of the feed."""
    users = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("pk")).agg(F.min("ts").alias("ts"))
    return users.filter("pk % 2 = 0").select("pk", F.col("pk").cast("double").alias("value"), F.lit("base").alias("props"), "ts")


TARGET_SQL = "target AS (SELECT user_id AS pk, user_id::DOUBLE AS value, 'base' AS props, min(ts) AS ts FROM events WHERE user_id % 2 = 0 GROUP BY user_id)"


def order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as changes of customers' latest order, with a tenant (nation) and a diff by order key."""
    digit = F.col("o_orderkey") % 10
    orders = table(spark, sf_dir, "orders").select(
        F.lit("order").alias("tbl"), F.col("o_custkey").alias("pk"), F.col("o_orderkey").alias("seq"), F.when(digit == 0, "INSERT").when(digit == 1, "DELETE").otherwise("UPDATE").alias("op"),
        F.when(digit < 4, F.array(F.lit("updatedDate"))).when(digit < 6, F.array(F.lit("updatedDate"), F.lit("meta"))).when(digit == 6, F.array().cast("array<string>")).otherwise(F.array(F.lit("o_totalprice"), F.lit("foo"))).alias("diff"),
        "o_totalprice", "o_orderstatus", "o_orderdate",
    )
    tenants = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pk"), F.col("c_nationkey").alias("tenant"))
    return orders.join(tenants, "pk", "left")


ORDERS_SQL = """feed AS (
  SELECT 'order' AS tbl, o_custkey AS pk, o_orderkey AS seq, CASE o_orderkey % 10 WHEN 0 THEN 'INSERT' WHEN 1 THEN 'DELETE' ELSE 'UPDATE' END AS op,
    CASE WHEN o_orderkey % 10 < 4 THEN ['updatedDate'] WHEN o_orderkey % 10 < 6 THEN ['updatedDate', 'meta'] WHEN o_orderkey % 10 = 6 THEN []::VARCHAR[] ELSE ['o_totalprice', 'foo'] END AS diff,
    o_totalprice, o_orderstatus, o_orderdate, c_nationkey AS tenant FROM orders LEFT JOIN customer ON c_custkey = o_custkey)"""
