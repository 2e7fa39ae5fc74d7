"""Searches of many queries in shards: a shard's rows are read once, queries stream past them."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

#: Makes a shard's index of its rows; answers some queries from it.
Build = Callable[[pa.Table], object]
Answer = Callable[[object, pa.Table], pa.Table]


def shard_of(row: Column, shards: int) -> Column:
    """Number of a row's shard; shards get about the same number of rows, whatever these hold."""
    return F.pmod(F.xxhash64(row), F.lit(shards)).cast("int")


def everywhere(queries: DataFrame, shards: int) -> DataFrame:
    """``queries`` once for each shard."""
    return queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Runs of rows of one place."""
    places = batch.column("place").to_numpy()
    ends = [*(np.flatnonzero(np.diff(places)) + 1).tolist(), len(places)]
    for a, b in zip([0, *ends], ends):
        if b > a:
            yield int(places[a]), batch.slice(a, b - a)


def searched(rows: DataFrame, queries: DataFrame, shards: int, build: Build, answer: Answer, schema: str) -> DataFrame:
    """What ``answer`` returns for the queries of every shard.

    ``rows`` and ``queries`` have a column ``shard``, the queries one of the shards they are sent
    to. Each shard is sorted so that its rows come before its queries: a task holds the index of
    one shard and one batch of queries. A shard without rows or without queries answers nothing.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current, index = None, None
        for batch in batches:
            for place, part in _runs(batch):
                if place // 2 != current:
                    current, index, held = place // 2, None, []
                if place % 2 == 0:
                    held.append(part)
                elif index is not None or held:
                    if index is None:
                        index, held = build(pa.Table.from_batches(held)), []
                    asked = [json.loads(q) for q in part.column("query").to_pylist()]
                    yield from answer(index, pa.Table.from_pylist(asked, schema=kind)).to_batches()

    # One number to sort by: shards in order, rows before queries.
    place = F.col("shard").cast("long") * 2
    # A query travels as text: an empty list beside each of the rows would cost more than the row.
    own = F.struct(*[c for c in queries.columns if c != "shard"])
    kind = to_arrow_schema(queries.drop("shard").schema)
    asked = queries.select("shard", (place + 1).alias("place"), F.to_json(own, {"ignoreNullFields": "false"}).alias("query"))
    both = rows.withColumn("place", place).unionByName(asked, allowMissingColumns=True)
    dealt = both.repartitionById(shards, "shard").drop("shard")
    return dealt.sortWithinPartitions("place").mapInArrow(work, schema)
