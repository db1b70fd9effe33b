"""What streams have written to a place.

Batch numbers belong to a checkpoint: each stream counts from 0. So what is written is known by stream and batch together, one small
Parquet file each, in a folder of its own: streams that write side by side never share a folder, and an entry that is written again
replaces itself. An entry comes after the rows of its batch; rows without an entry are those of an attempt that failed.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = "rows long, versions map<string,string>"


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def folder(stream: str, batch: int) -> str:
    return f"stream={quote(stream, safe='')}/batch={batch}"


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, stream: str, batch: int, rows: int, versions: dict[str, str] | None = None) -> None:
        """Enter a batch; ``versions``: table versions that hold from it on."""
        row = self.spark.createDataFrame([(rows, versions or {})], ENTRY)
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{folder(stream, batch)}")

    def entries(self) -> DataFrame:
        """stream, batch, rows, versions."""
        schema = f"{ENTRY}, stream string, batch long"
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def has(self, stream: str, batch: int) -> bool:
        return exists(self.spark, f"{self.path}/{folder(stream, batch)}/_SUCCESS")

    def last(self) -> dict[str, int]:
        """The latest batch of each stream."""
        return {r["stream"]: r["batch"] for r in self.entries().groupBy("stream").agg(F.max("batch").alias("batch")).collect()}

    def versions(self) -> dict[str, str]:
        """Table versions after each stream's latest entry that has any."""
        found = self.entries().filter(F.size("versions") > 0).groupBy("stream").agg(F.max_by("versions", "batch").alias("versions")).collect()
        return {table: version for r in found for table, version in r["versions"].items()}
