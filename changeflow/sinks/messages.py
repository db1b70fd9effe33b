"""Message queues and object stores: rows as they are written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hashing, naming
from ..model import event_json, mvcc
from ..operators.batches import runs

#: Name of the header that carries the partition key; consumers of an existing topic may need another.
PARTITION_HEADER = "partitionkey"


def kafka(events: DataFrame, partitions: int, header_name: str = PARTITION_HEADER, in_order: bool = False) -> DataFrame:
    """key, value, headers and partition, ready for the Kafka writer. Events are decoded ones (``pk`` is there).

    ``in_order`` sorts them by partition and commit time, so that a key's events are sent in order.
    """
    header = naming.partition_key(F.col("table"), F.col("companyId"), F.col("locationId"), F.col("pk"))
    key = naming.message_key(F.col("table"), F.col("operation"), F.col("companyId"), F.col("locationId"), F.col("id"))
    headers = F.array(F.struct(F.lit(header_name).alias("key"), header.cast("binary").alias("value")))
    rows = hashing.with_kafka_partition(events.withColumn("_header", header), F.col("_header"), partitions, "_partition")
    if in_order:
        rows = rows.repartition("_partition").sortWithinPartitions("_partition", mvcc(F.col("mvccTimestamp")), "id")
    return rows.select(
        key.cast("binary").alias("key"), event_json().cast("binary").alias("value"), headers.alias("headers"), F.col("_partition").alias("partition")
    )


def eventhub(events: DataFrame) -> DataFrame:
    """Rows as the provider's batches take them: body, message id, content type, properties and the key that deals them.

    Tenants are those of the row image, not of the envelope. A batch has one partition key, so rows of one key in order are
    batches; ``eventhub_batches`` numbers them.
    """
    tenant = lambda k: F.try_element_at("object", F.lit(k))
    company, location = tenant("companyId"), tenant("locationId")
    key = naming.message_key(F.col("table"), F.col("operation"), company, location, F.col("pk"))
    return events.select(
        event_json().cast("binary").alias("body"), F.col("id").alias("message_id"), F.lit("application/json").alias("content_type"),
        F.create_map(F.lit("objectId"), key).alias("properties"), naming.partition_key(F.col("table"), company, location, F.col("pk")).alias("partition_key"),
    )


def eventhub_batches(rows: DataFrame, table: Column, company: Column, location: Column, pk: Column, order: str, partition: list[str]) -> DataFrame:
    """Adds ``partition_key`` and ``batch``: a batch is a run of equal keys, since a provider batch has one key."""
    key = naming.partition_key(table, company, location, pk)
    return runs(rows.withColumn("partition_key", key), F.col("partition_key"), order, partition, "batch")


def last_writer(rows: DataFrame, path: str, order: str, columns: list[str]) -> DataFrame:
    """One row a path: objects of the same name overwrite each other."""
    return rows.groupBy(path).agg(*[F.max_by(c, order).alias(c) for c in columns])
