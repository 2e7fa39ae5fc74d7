"""Size checks that decide between a scan filter, a broadcast and a shuffle join."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .sources.scratch import scratch_path
from .sources.tables import CODEC

#: Largest table, in rows and in bytes of its strings, that is broadcast.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
#: Most rows whose keys are written into a scan filter.
FILTER_ROWS = 1_000
#: Most rows of a table of words or numbers that is kept as a local table.
LOCAL_ROWS = 20_000


@dataclass(frozen=True)
class KeySide:
    """A join side after a look at its size."""

    df: DataFrame
    #: Its keys if they are few, else None.
    keys: list | None
    #: Whether it may be broadcast.
    small: bool

    def same_size(self, df: DataFrame) -> "KeySide":
        """``df`` with the same keys and at most as many rows."""
        return KeySide(df, self.keys, self.small)


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df``: whether it has at most ``rows`` rows and ``max_bytes`` string bytes."""
    strings = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    width = sum((F.coalesce(F.octet_length(s), F.lit(0)) for s in strings), F.lit(0))
    size = df.agg(
        F.count("*").alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")
    ).first()
    return size["n"] <= rows and size["b"] <= max_bytes


def key_side(df: DataFrame, key: str) -> KeySide:
    """Look at the size of ``df`` and, if it has few rows, at its keys."""
    rows = df.select(key).limit(FILTER_ROWS + 1).collect()
    if len(rows) <= FILTER_ROWS:
        return KeySide(df, sorted({r[0] for r in rows if r[0] is not None}), True)
    return KeySide(df, None, is_small(df))


def join_on_key(big: DataFrame, side: KeySide, key: str, how: str = "inner", on: list[str] | None = None) -> DataFrame:
    """Join a stored table with a side that is usually a handful of keys.

    Few keys become a filter that reaches the Parquet scan of ``big`` and, on a table
    sorted by ``key``, skips its row groups. A small side is broadcast. Beyond both limits
    the join shuffles and adaptive execution splits hot keys. ``on`` names all columns of the
    join, by default the key.
    """
    if side.keys is not None:
        big = big.where(F.col(key).isin(side.keys))
    return big.join(F.broadcast(side.df) if side.small else side.df, on or key, how)


def settle(df: DataFrame, rows: int = FILTER_ROWS) -> tuple[DataFrame, list | None]:
    """``df`` as a local table, and its rows, if it has at most ``rows``; else as it is."""
    found = df.limit(rows + 1).toArrow()
    if found.num_rows > rows:
        return df, None
    return df.sparkSession.createDataFrame(found, schema=df.schema), found.to_pylist()


def local(like: DataFrame, rows: list[dict]) -> DataFrame:
    """A local table of ``rows`` with the columns of ``like``."""
    found = pa.Table.from_pylist(rows, schema=to_arrow_schema(like.schema))
    return like.sparkSession.createDataFrame(found, schema=like.schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the scratch folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held(df: DataFrame, name: str, rows: int = FILTER_ROWS) -> tuple[DataFrame, list | None]:
    """``df`` evaluated once: a local table with its rows if it is short, else a stored table.

    What is derived from it several times does not run its query again, and losing an
    executor does not either.
    """
    df, found = settle(df, rows)
    return (stored(df, name), None) if found is None else (df, found)
