"""One object an event under the name that the row gives, over whatever is there: written by tasks, then made visible all together.

Tasks write into a hidden folder of their run and attempt, some objects at a time, and go on after an error, so that all errors of a flush
come back together. Only if there are none the run is committed: a list of the attempts that count, those of tasks that ended. From it a
second job moves the objects to their names, each task those of one attempt. A lost or killed task leaves nothing that is seen; a run that
is committed is published to its end by whoever calls ``publish`` next, and moving an object twice is the same as once.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

#: Objects that a task writes at a time, and the hidden folder below the root (names of objects don't begin with it).
AT_ONCE, HIDDEN = 4, "_runs"


@dataclass(frozen=True)
class Store:
    """Where objects go, in a form that tasks can open: a local or mounted folder, or a bucket of an S3-like store."""

    root: str
    s3: tuple[tuple[str, str], ...] | None = None

    def open(self) -> fs.FileSystem:
        if self.s3 is None:
            return fs.LocalFileSystem()
        o = dict(self.s3)
        endpoint = o.get("endpoint", "")
        scheme, _, host = endpoint.rpartition("://")
        keys = {"access_key": o["access-key-id"], "secret_key": o.get("secret-access-key", ""), "session_token": o.get("session-token")} if "access-key-id" in o else {}
        place = {"endpoint_override": host, "scheme": scheme} if endpoint else {}
        return fs.S3FileSystem(region=o.get("region"), retry_strategy=fs.AwsStandardS3RetryStrategy(max_attempts=int(o.get("max-retries", 5))), **keys, **place)


@dataclass
class Written(WriterCommitMessage):
    """What an attempt has written: how many objects, and what went wrong with others."""

    attempt: str
    n: int
    errors: list[str] = field(default_factory=list)


class ObjectWriter(DataSourceArrowWriter):
    def __init__(self, store: Store, run: str):
        self.store, self.run = store, run

    def _folder(self, *parts: str) -> str:
        return posixpath.join(self.store.root, HIDDEN, self.run, *parts)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, attempt, names, errors = self.store.open(), uuid.uuid4().hex, [], []
        at = self._folder(attempt)
        if isinstance(files, fs.LocalFileSystem):
            files.create_dir(at, recursive=True)

        def one(number: int, path: str, value: str) -> str | None:
            try:
                target = posixpath.normpath(posixpath.join(self.store.root, path))
                if not target.startswith(self.store.root.rstrip("/") + "/") or path.startswith(HIDDEN):
                    raise ValueError("leads out of the destination")
                with files.open_output_stream(f"{at}/{number}") as out:
                    out.write(value.encode())
                return None
            except Exception as e:  # told with all others when the flush ends
                return f"{path!r} {e}"

        with ThreadPoolExecutor(AT_ONCE) as pool:
            for batch in iterator:
                paths, values = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                done = list(pool.map(one, range(len(names), len(names) + len(paths)), paths, values))
                errors += [e for e in done if e is not None]
                names += paths
        with files.open_output_stream(f"{at}/names") as out:
            out.write(json.dumps(names).encode())
        return Written(attempt, len(names), errors)

    def commit(self, messages: list[Written | None]) -> None:
        if errors := [e for m in messages if m for e in m.errors]:
            self.abort(messages)
            raise ExceptionGroup("objects that could not be written", [OSError(e) for e in errors])
        files = self.store.open()
        if isinstance(files, fs.LocalFileSystem):
            files.create_dir(self._folder(), recursive=True)
        with files.open_output_stream(self._folder("committed")) as out:  # one small object: there or not
            out.write(json.dumps([m.attempt for m in messages if m and m.n]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        files = self.store.open()
        if files.get_file_info(self._folder()).type != fs.FileType.NotFound:
            files.delete_dir(self._folder())


class Objects(DataSource):
    @classmethod
    def name(cls) -> str:
        return "objects"

    def schema(self) -> str:
        return "path string, value string"

    def writer(self, schema: StructType, overwrite: bool) -> ObjectWriter:
        s3 = self.options.get("s3")
        return ObjectWriter(Store(self.options["root"], tuple(map(tuple, json.loads(s3))) if s3 else None), self.options["run"])


def publish(spark: SparkSession, store: Store, run: str) -> int:
    """Give a committed run's objects their names; how many there are. Again after a failure, it goes on."""
    files, at = store.open(), posixpath.join(store.root, HIDDEN, run)
    with files.open_input_stream(f"{at}/committed") as f:
        attempts = json.loads(f.read())

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, made, n = store.open(), set(), 0
        local = isinstance(files, fs.LocalFileSystem)
        for batch in batches:
            for attempt in batch.column(0).to_pylist():
                with files.open_input_stream(f"{at}/{attempt}/names") as f:
                    names = json.loads(f.read())
                for number, path in enumerate(names):
                    held, target = f"{at}/{attempt}/{number}", posixpath.normpath(posixpath.join(store.root, path))
                    folder = posixpath.dirname(target)
                    if local and folder not in made:
                        files.create_dir(folder, recursive=True)
                        made.add(folder)
                    if files.get_file_info(held).type != fs.FileType.NotFound:  # else it was moved before
                        files.move(held, target)
                n += len(names)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    n = 0
    if attempts:
        rows = spark.createDataFrame([(a,) for a in attempts], "attempt string").repartition(len(attempts))
        n = sum(r["n"] for r in rows.mapInArrow(move, "n long").collect())  # one number a task
    files.delete_dir(at)
    return n


def unpublished(store: Store) -> list[str]:
    """Runs that are committed and not yet published."""
    files, at = store.open(), posixpath.join(store.root, HIDDEN)
    if files.get_file_info(at).type == fs.FileType.NotFound:
        return []
    runs = [f.base_name for f in files.get_file_info(fs.FileSelector(at)) if f.type == fs.FileType.Directory]
    return sorted(r for r in runs if files.get_file_info(f"{at}/{r}/committed").type == fs.FileType.File)


def put(rows: DataFrame, store: Store) -> int:
    """Writes ``value`` at ``path`` below the store's root; the number of objects. Rows of one path were reduced to one before."""
    spark, run = rows.sparkSession, uuid.uuid4().hex
    for old in unpublished(store):  # of a driver that was lost in between
        publish(spark, store, old)
    spark.dataSource.register(Objects)
    writer = rows.select("path", "value").write.format("objects").mode("append").option("root", store.root).option("run", run)
    (writer.option("s3", json.dumps(store.s3)) if store.s3 is not None else writer).save()
    return publish(spark, store, run)
