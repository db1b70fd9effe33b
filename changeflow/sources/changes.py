"""A change source of its own: newline-delimited JSON files as they arrive, with offsets, a limit a batch and a delivery count.

Files (plain or .gz) are complete when they appear and their names grow, as those of a log that is cut by time. An offset is a file and a
byte: all files of smaller names are read, and so many bytes of that one. Planning lists files and looks at sizes only; tasks read
ranges of bytes of plain files and whole .gz files, and a line belongs to the range in which it begins.

``state`` is a small file beside the query's checkpoint: the last batch that was planned and how often it was handed out. A batch that
is planned again after a restart is a redelivery; its events carry the count, and ``streaming.guard`` sets aside those that fail every time.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

MAX_BYTES, SPLIT_BYTES, CHUNK, ROWS = 1 << 28, 1 << 25, 1 << 20, 10_000


def _at(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


class Range(InputPartition):
    def __init__(self, file: str, begin: int, end: int | None, deliveries: int):
        self.file, self.begin, self.end, self.deliveries = file, begin, end, deliveries


def lines(path: str, begin: int, end: int | None) -> Iterator[tuple[int, bytes]]:
    """(place, line) of the lines that begin in a range of bytes of a file; ``end`` None: the whole of a compressed one."""
    fs, name = _at(path)
    with fs.open_input_stream(name, compression="detect") if end is None else fs.open_input_file(name) as f:
        place, held = begin, b""
        if end is not None and begin:
            f.seek(begin - 1)  # the line that has the byte before goes on, if that isn't its end
            place, skip = begin - 1, True
        else:
            skip = False
        while chunk := f.read(CHUNK):
            held += chunk
            *whole, held = held.split(b"\n")
            for line in whole:
                if skip:
                    skip = False
                elif end is not None and place >= end:
                    return
                else:
                    yield place, line
                place += len(line) + 1
            if end is not None and place >= end:
                return
        if held and not skip and (end is None or place < end):
            yield place, held


class ChangeReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.state = options["path"].rstrip("/"), options["state"]
        self.max_bytes, self.split = int(options.get("maxbytes", MAX_BYTES)), int(options.get("splitbytes", SPLIT_BYTES))
        self.planned = self._load()
        self.at = self.planned["end"]
        self.counted: tuple | None = None

    def _load(self) -> dict:
        fs, name = _at(self.state)
        if fs.get_file_info(name).type == pafs.FileType.NotFound:
            return {"start": None, "end": self.initialOffset(), "deliveries": 0}
        with fs.open_input_stream(name) as f:
            return json.loads(f.read())

    def _save(self) -> None:
        fs, name = _at(self.state)
        fs.create_dir(name.rpartition("/")[0], recursive=True)
        with fs.open_output_stream(f"{name}.new") as f:
            f.write(json.dumps(self.planned).encode())
        fs.move(f"{name}.new", name)

    def initialOffset(self) -> dict:
        return {"file": "", "at": 0}

    def _files(self, after: str) -> list[tuple[str, int]]:
        fs, name = _at(self.path)
        found = fs.get_file_info(pafs.FileSelector(name, recursive=False))
        return sorted((f.base_name, f.size) for f in found if f.is_file and not f.base_name.startswith((".", "_")) and f.base_name >= after)

    def latestOffset(self) -> dict:
        """As far on as the limit allows, a file's part at least; asked again, it goes on from there."""
        left = self.max_bytes
        for file, size in self._files(self.at["file"]):
            done = self.at["at"] if file == self.at["file"] else 0
            take = size - done if file.endswith(".gz") else min(size - done, left)
            if left <= 0:
                break
            self.at = {"file": file, "at": done + take}
            left -= take
        return self.at

    def partitions(self, start: dict, end: dict) -> list[Range]:
        if start == end:
            return []
        if (start, end) != self.counted:  # a plan may be made several times in one run; that is one delivery
            again = (start, end) == (self.planned["start"], self.planned["end"])
            self.planned = {"start": start, "end": end, "deliveries": self.planned["deliveries"] + 1 if again else 1}
            self._save()
            self.counted = (start, end)
        self.at = max(self.at, end, key=lambda o: (o["file"], o["at"]))
        out, n = [], self.planned["deliveries"]
        for file, size in self._files(start["file"]):
            if file > end["file"]:
                break
            first, last = (start["at"] if file == start["file"] else 0), (end["at"] if file == end["file"] else size)
            if file.endswith(".gz"):
                out += [Range(file, 0, None, n)] if first < last else []
            else:
                out += [Range(file, a, min(a + self.split, last), n) for a in range(first, last, self.split)]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        names, held = ["value", "file", "place", "deliveries"], []

        def batch() -> pa.RecordBatch:
            values = pa.array([line.decode("utf-8", "replace") for _, line in held], pa.string())
            n = len(held)
            return pa.RecordBatch.from_arrays([values, pa.array([partition.file] * n, pa.string()), pa.array([p for p, _ in held], pa.int64()), pa.array([partition.deliveries] * n, pa.int32())], names)

        for found in lines(f"{self.path}/{partition.file}", partition.begin, partition.end):
            held.append(found)
            if len(held) == ROWS:
                yield batch()
                held = []
        if held:
            yield batch()

    def commit(self, end: dict) -> None:
        """Nothing to do: what was planned last is kept, and Spark asks for nothing before it any more."""


class ChangeFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "changefiles"

    def schema(self) -> str:
        return "value string, file string, place long, deliveries int"

    def streamReader(self, schema: StructType) -> ChangeReader:
        return ChangeReader(dict(self.options))


def stream(spark: SparkSession, path: str, state: str, max_bytes: int = MAX_BYTES, split_bytes: int = SPLIT_BYTES):
    """A stream of lines (value, file, place, deliveries); ``state`` is a file path of this query's own."""
    spark.dataSource.register(ChangeFiles)
    return spark.readStream.format("changefiles").option("path", path).option("state", state).option("maxbytes", str(max_bytes)).option("splitbytes", str(split_bytes)).load()
