"""Searches for requests that arrive over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import requests as rq
from ..plans.search import search_batch
from ..sizing import stored
from ..sources.index_store import Index
from ..sources.scratch import scratch_scope

#: Characters of a request, beyond which it is not answered.
MOST_CHARS = 10_000
REQUEST_SCHEMA = "request_id BIGINT, msg STRING"


def read_requests(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """Stream of requests from Parquet files that are dropped into a folder."""
    return (
        spark.readStream.schema(REQUEST_SCHEMA)
        .option("maxFilesPerTrigger", max_files)
        .parquet(path)
    )


def request_error(request_id: Column, msg: Column) -> Column:
    """What is wrong with a request, null if nothing is."""
    digits = rq.leading_number(rq.trimmed(msg))
    words = rq.words_behind(rq.trimmed(msg))
    return (
        F.when(request_id.isNull(), "no request_id")
        .when(msg.isNull(), "no message")
        .when(F.length(msg) > MOST_CHARS, "message too long")
        .when(digits == "", "no limit")
        .when(F.trim(words) == "", "no words")
    )


def search_stream(
    requests: DataFrame,
    index: Index,
    out: str,
    checkpoint: str,
    honour_strategy: bool = False,
    available_now: bool = False,
    errors: str | None = None,
) -> StreamingQuery:
    """Answer each micro-batch of ``requests`` against the index into Parquet below ``out``.

    No state is kept between batches. A batch owns the folder ``batch_id=n`` and replaces it
    when it runs again after a failure, so each request is answered exactly once. What a batch writes to the scratch
    folder goes when its results are written.

    A request that cannot be answered has a row ``(request_id, msg, error)`` below ``errors``, by default
    ``{out}_errors``, in place of results: one without an id, a message, a limit or words, one beyond
    ``MOST_CHARS`` characters, and all but the first of several with one id in a batch.
    """
    spark = requests.sparkSession
    errors = errors or f"{out.rstrip('/')}_errors"
    own = Window.partitionBy("request_id").orderBy(F.col("error").isNotNull(), "msg")

    def answer(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(spark):
            checked = batch.select("request_id", "msg", request_error(F.col("request_id"), F.col("msg")).alias("error"))
            again = F.col("request_id").isNotNull() & (F.row_number().over(own) > 1)
            checked = checked.withColumn("again", again)
            checked = checked.withColumn("error", F.coalesce("error", F.when(F.col("again"), "repeated request_id")))
            checked = stored(checked.drop("again"), "requests")
            bad = checked.where("error IS NOT NULL")
            bad.write.mode("overwrite").parquet(f"{errors}/batch_id={batch_id}")
            results = search_batch(checked.where("error IS NULL").drop("error"), index, honour_strategy)
            results.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer = requests.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
