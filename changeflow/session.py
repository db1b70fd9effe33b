"""Session helpers: sending the package to Python workers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_sent: set[str] = set()

#: Rows and bytes of an Arrow batch. Documents are large rows, and a batch is held several times over in every Python worker.
ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "4m")}


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable in Python workers, once for each application, wherever the driver was started.

    Arrow batches are made smaller too, unless the session has limits of its own.
    """
    for name, (usual, ours) in ARROW.items():
        if spark.conf.get(name, usual) == usual:
            spark.conf.set(name, ours)
    app = spark.sparkContext.applicationId
    if app not in _sent:
        here = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="changeflow-"), "changeflow.zip")
        with zipfile.ZipFile(path, "w") as out:
            for folder, _, names in os.walk(here):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        out.write(full, os.path.relpath(full, os.path.dirname(here)))
        spark.sparkContext.addPyFile(path)
        _sent.add(app)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where it is unset."""
    where = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = "file://" + os.path.join(tempfile.gettempdir(), "changeflow-checkpoints")
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(where)
    return where


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/changeflow-{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
