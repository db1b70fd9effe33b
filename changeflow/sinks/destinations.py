"""Destinations by URL: a registry of schemes, options for Spark's writers, and checks of configuration values."""

from __future__ import annotations

import os
import socket
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import SplitResult, parse_qsl, quote, unquote, urlencode, urlsplit

from pyarrow.fs import FileSelector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.masking import is_localhost
from ..functions.naming import file_path, object_key
from ..model import event_json
from .messages import PARTITION_HEADER, eventhub, kafka, last_writer
from .objects import Store, put

ALIASES = {"postgresql": "postgres", "mssql": "sqlserver", "snowflake-keypair": "snowflake", "gs": "s3", "azeventhub": "eventhub"}
JDBC = {"postgres": ("jdbc:postgresql", 5432), "mysql": ("jdbc:mysql", 3306), "sqlserver": ("jdbc:sqlserver", 1433)}
#: Events a flush holds at most, by destination (fixed values; -1: no limit).
BATCH = {"postgres": 500, "mysql": 500, "sqlserver": 500, "snowflake": 200, "s3": 1000, "kafka": -1, "eventhub": -1, "file": -1}
#: Name of the object stores' public hosts (a fixed value).
GOOGLE = "storage.googleapis.com"
DEFAULT_REGION = "us-west-2"

#: Fields of a destination's form: name, kind, whether it has to be there, default.
_DATABASE = [("Database", str, True, None), ("Username", str, False, ""), ("Password", str, False, ""), ("Hostname", str, True, None)]
FORMS = {
    **{k: [*_DATABASE, ("Port", int, False, port)] for k, (_, port) in JDBC.items()},
    "snowflake": [*_DATABASE, ("Schema", str, True, None)],
    "s3": [("Bucket", str, True, None), ("Prefix", str, False, ""), ("Region", str, False, ""), ("Access Key ID", str, False, ""), ("Secret Access Key", str, False, ""), ("Endpoint", str, False, "")],
    "kafka": [("Hostname", str, True, None), ("Port", int, False, 9092), ("Topic", str, True, None)],
    "eventhub": [("Connection String", str, True, None)],
    "file": [("Directory", str, True, None)],
}


@dataclass
class Destination:
    scheme: str
    options: dict[str, str] = field(default_factory=dict)

    @property
    def max_batch(self) -> int:
        return BATCH[self.scheme]


def parse(url: str) -> Destination:
    """Writer options of a destination URL; bad URLs raise ValueError with what is missing."""
    u = urlsplit(url)
    scheme = ALIASES.get(u.scheme, u.scheme)
    query = dict(parse_qsl(u.query))
    if scheme not in BATCH:
        raise ValueError(f"no destination for {u.scheme!r}")
    if scheme in JDBC:
        if not u.hostname:
            raise ValueError("a host is missing")
        database = u.path.strip("/") or query.pop("database", "")
        if not database:
            raise ValueError("a database is missing")
        head, port = JDBC[scheme]
        place = f"{head}://{u.hostname}:{u.port or port}"
        options = {"url": f"{place};databaseName={database}" if scheme == "sqlserver" else f"{place}/{database}", "user": unquote(u.username or ""), "password": unquote(u.password or "")}
        return Destination(scheme, options | query)
    if scheme == "snowflake":
        parts = [p for p in u.path.split("/") if p]
        if len(parts) < 2:
            raise ValueError("database and schema are missing")
        return Destination(scheme, {"sfURL": f"{u.hostname}.snowflakecomputing.com", "sfUser": unquote(u.username or ""), "sfPassword": unquote(u.password or ""), "sfDatabase": parts[0], "sfSchema": parts[1]} | query)
    if scheme == "s3":
        if not u.netloc:
            raise ValueError("a bucket is missing")
        return Destination(scheme, _bucket(u, query))
    if scheme == "kafka":
        topic = u.path.strip("/")
        if not u.netloc or not topic:
            raise ValueError("a broker or topic is missing")
        return Destination(scheme, {"kafka.bootstrap.servers": u.netloc, "topic": topic} | query)
    if scheme == "eventhub":
        text = url.split("://", 1)[1]
        if "EntityPath=" not in text:
            raise ValueError("EntityPath is missing")
        return Destination(scheme, {"connectionString": f"Endpoint=sb://{text.removeprefix('Endpoint=sb://')}"})
    if not u.path:
        raise ValueError("a folder is missing")
    return Destination(scheme, {"path": unquote((u.netloc + u.path) if u.netloc else u.path)})


def _bucket(u: SplitResult, query: dict[str, str]) -> dict[str, str]:
    """Bucket, prefix and endpoint. A host of one's own machine or of a known store comes before the bucket; else the host is the bucket."""
    parts = [p for p in u.path.split("/") if p]
    options = {"region": DEFAULT_REGION} | query
    if u.scheme == "gs":
        return options | {"bucket": u.netloc, "prefix": "/".join(parts), "endpoint": f"https://{GOOGLE}", "region": "auto"}
    if is_localhost(u.netloc) or u.netloc.endswith("googleapis.com"):
        if not parts:
            raise ValueError("a bucket is missing")
        google = u.netloc.endswith("googleapis.com")
        place = {"endpoint": f"https://{u.netloc}", "region": "auto"} if google else {"endpoint": f"http://{u.netloc}"}
        return options | {"bucket": parts[0], "prefix": "/".join(parts[1:])} | place
    return options | {"bucket": u.netloc, "prefix": "/".join(parts)}


def check(scheme: str, values: dict[str, object]) -> tuple[str | None, dict[str, str]]:
    """The URL of a filled-in form, or what is wrong with it by field."""
    scheme = ALIASES.get(scheme, scheme)
    if scheme not in FORMS:
        raise ValueError(f"no destination for {scheme!r}")
    got, wrong = {}, {}
    for name, kind, needed, default in FORMS[scheme]:
        value = values.get(name)
        if value is None or value == "":
            if needed:
                wrong[name] = "is required"
            got[name] = default
            continue
        try:
            got[name] = kind(value)
        except (TypeError, ValueError):
            wrong[name] = "is not a number"
    if not wrong and _bad_port(got):
        wrong["Port"] = "is not a port"
    if wrong:
        return None, wrong
    user = f"{quote(got['Username'], safe='')}:{quote(got['Password'], safe='')}@" if got.get("Username") else ""
    if scheme in JDBC:
        return f"{scheme}://{user}{got['Hostname']}:{got['Port']}/{got['Database']}", {}
    if scheme == "snowflake":
        return f"snowflake://{user}{got['Hostname']}/{got['Database']}/{got['Schema']}", {}
    if scheme == "s3":
        names = {"Region": "region", "Access Key ID": "access-key-id", "Secret Access Key": "secret-access-key"}
        query = urlencode({k: got[n] for n, k in names.items() if got[n]})
        place = f"{got['Endpoint'].split('://')[-1].rstrip('/')}/{got['Bucket']}" if got["Endpoint"] else got["Bucket"]
        return "/".join(x for x in (f"s3://{place}", got["Prefix"].strip("/")) if x) + (f"?{query}" if query else ""), {}
    if scheme == "kafka":
        return f"kafka://{got['Hostname']}:{got['Port']}/{got['Topic']}", {}
    if scheme == "eventhub":
        text = got["Connection String"].removeprefix("Endpoint=sb://")
        return (f"eventhub://{text}", {}) if "EntityPath=" in text else (None, {"Connection String": "has no EntityPath"})
    return f"file://{got['Directory']}", {}


def _bad_port(got: dict[str, object]) -> bool:
    """Whether a port is given that none can have."""
    return "Port" in got and not 0 < int(got["Port"]) < 65536


def reachable(url: str, seconds: float = 5.0) -> str | None:
    """None if the driver gets to a destination, else what is in the way: a port that answers, a folder or bucket that can be listed."""
    d = parse(url)
    u = urlsplit(url)
    try:
        if d.scheme == "file":
            return None if os.path.isdir(d.options["path"]) or os.access(os.path.dirname(d.options["path"].rstrip("/")) or "/", os.W_OK) else "the folder can't be made"
        if d.scheme == "s3":
            _store(d).open().get_file_info(FileSelector(d.options["bucket"], recursive=False))
            return None
        default = JDBC[d.scheme][1] if d.scheme in JDBC else {"kafka": 9092, "snowflake": 443, "eventhub": 5671}[d.scheme]
        host = {"snowflake": d.options.get("sfURL"), "eventhub": d.options.get("connectionString", "").split("sb://")[-1].split("/")[0]}.get(d.scheme) or u.hostname
        socket.create_connection((host, u.port or default if d.scheme != "eventhub" else default), seconds).close()
    except OSError as e:
        return str(e)
    return None


_writers: dict[str, Callable[[Destination, DataFrame], None]] = {}


def writer(scheme: str):
    """Register a writer of decoded events for a scheme."""

    def add(f: Callable[[Destination, DataFrame], None]):
        _writers[scheme] = f
        return f

    return add


def write(url: str, events: DataFrame, dry_run: bool = False) -> DataFrame:
    """Send decoded events to a destination; a dry run only returns what would be written."""
    d = parse(url)
    rows = prepare(d, events)
    if not dry_run:
        if d.scheme not in _writers:
            raise NotImplementedError(f"{d.scheme}: no writer is registered; a dry run gives the rows that one would send")
        _writers[d.scheme](d, rows)
    return rows


def prepare(d: Destination, events: DataFrame) -> DataFrame:
    if d.scheme in ("file", "s3"):
        path = file_path(F.col("table"), F.col("timestamp"), F.col("pk"))
        if d.scheme == "s3":
            path = object_key(d.options["prefix"], F.col("table"), F.col("timestamp"), F.col("pk"), F.col("validated_path") if "validated_path" in events.columns else None)
        rows = events.select(F.struct("timestamp", "mvccTimestamp", "id").alias("_o"), path.alias("path"), event_json().alias("value"))
        return last_writer(rows, "path", "_o", ["value"])
    if d.scheme == "kafka":
        return kafka(events, int(d.options.get("partitions", 1)), d.options.get("header", PARTITION_HEADER), in_order=True)
    if d.scheme == "eventhub":
        return eventhub(events)
    raise ValueError(f"{d.scheme} takes folded tables, not events; see write_table")


@writer("file")
def _files(d: Destination, rows: DataFrame) -> None:
    put(rows, Store(d.options["path"]))


def _store(d: Destination) -> Store:
    return Store(d.options["bucket"], tuple(sorted((k, v) for k, v in d.options.items() if k not in ("bucket", "prefix"))))


@writer("s3")
def _objects(d: Destination, rows: DataFrame) -> None:
    put(rows, _store(d))


@writer("kafka")
def _kafka(d: Destination, rows: DataFrame) -> None:
    rows.write.format("kafka").options(**{k: v for k, v in d.options.items() if k.startswith("kafka.") or k == "topic"}).option("includeHeaders", "true").save()


def write_table(url: str, table: str, rows: DataFrame, mode: str = "overwrite") -> None:
    """A folded table over JDBC or the warehouse's connector; both need their jar on the class path."""
    d = parse(url)
    if d.scheme == "snowflake":
        rows.write.format("net.snowflake.spark.snowflake").options(**d.options).option("dbtable", table).mode(mode).save()
    elif d.scheme in JDBC:
        rows.write.format("jdbc").options(**d.options).option("dbtable", table).option("batchsize", str(d.max_batch)).mode(mode).save()
    else:
        raise ValueError(f"{d.scheme} takes events, not tables; see write")
