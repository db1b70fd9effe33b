"""FNV-1a as an expression, XXH64 as an Arrow function."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: FNV-1a, 32 bits (fixed values).
FNV_OFFSET, FNV_PRIME = 2166136261, 16777619


def fnv1a32(text: Column) -> Column:
    """Unsigned 32-bit FNV-1a of the UTF-8 bytes; stays in the JVM. Bytes are read as Latin-1 letters, whose codes they are."""
    letters = F.split(F.decode(F.encode(text, "UTF-8"), "ISO-8859-1"), "")
    step = lambda acc, b: (acc.bitwiseXOR(F.ascii(b).cast("long")) * F.lit(FNV_PRIME).cast("long")).bitwiseAND(F.lit((1 << 32) - 1))
    offset = F.lit(FNV_OFFSET).cast("long")
    return F.when(F.octet_length(text) == 0, offset).otherwise(F.aggregate(letters, offset, step))


def modulo(text: Column, n: int) -> Column:
    """Partition of a text: its unsigned hash modulo n."""
    return (fnv1a32(text) % n).cast("int")


def _hex64(text: str | None) -> str | None:
    return None if text is None else f"{xxhash.xxh64_intdigest(text.encode()):x}"


def hash64(text: Column) -> Column:
    """Lower hex of XXH64 with seed 0, which Spark's own function of that name doesn't give (its seed is 42)."""
    return F.pandas_udf(lambda t: t.map(_hex64), "string")(text)


def fnv_of(texts: list[str]) -> np.ndarray:
    """FNV-1a of many short ASCII texts, a place of all of them at a time."""
    size = max(map(len, texts), default=0)
    letters = np.frombuffer("".join(t.ljust(size, "\0") for t in texts).encode("ascii"), np.uint8).reshape(len(texts), size)
    total = np.full(len(texts), FNV_OFFSET, np.uint64)
    for column in letters.T:
        total = np.where(column > 0, (total ^ column) * np.uint64(FNV_PRIME) & np.uint64((1 << 32) - 1), total)
    return total


def with_kafka_partition(rows: DataFrame, key: Column, n: int, out: str = "partition") -> DataFrame:
    """Partition of a message, whose key is hashed twice: FNV-1a of the hex text of XXH64. Arrow runs once, for both."""
    if n == 1:
        return rows.withColumn(out, F.lit(0))

    def place(keys: pd.Series) -> pd.Series:
        return pd.Series((fnv_of([_hex64(k or "") for k in keys]) % np.uint64(n)).astype(np.int32))

    return rows.withColumn(out, F.pandas_udf(place, "int")(key))
