"""Page tables as input and as files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a bucket of pages, on average, and the most buckets of a store.
BUCKET_ROWS, MOST_BUCKETS = 1 << 14, 1 << 16
#: Rows of a range of titles, on average, and the most ranges of a directory.
RANGE_ROWS, MOST_RANGES = 1 << 14, 1 << 12
#: Compression of large tables.
CODEC = "zstd"
#: Metadata of the column ``id_bucket`` of a page store, and of ``home`` of an index.
BUCKETS = "buckets"


def spread(scan: DataFrame) -> DataFrame:
    """Use all cores on a small table that is read without a shuffle.

    Word counting and markup extraction work on single rows, so they run in as many tasks as
    the scan has. A table with at least as many splits as cores is left as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def store_sorted(df: DataFrame, path: str, keys: list[str], unique: bool = True) -> DataFrame:
    """Write ``df`` as files that follow each other in the order of ``keys``; read it back.

    Without ``unique`` keys, rows of one key may go on in the next file, so a frequent key
    does not end in one task.
    """
    order = keys
    if not unique:
        df, order = df.withColumn("_row", F.monotonically_increasing_id()), [*keys, "_row"]
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.drop("_row").write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def id_bucket(c: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")


def store_by_id(pages: DataFrame, path: str, buckets: int | None = None) -> DataFrame:
    """Write ``pages`` in folders by a hash of their ids, each sorted by id; read them back.

    A hot id makes a large bucket, which the rebalancing splits among tasks.
    """
    if buckets is None:
        buckets = min(MOST_BUCKETS, max(1, -(-pages.count() // BUCKET_ROWS)))
    placed = pages.withColumn("id_bucket", id_bucket("id", buckets)).hint("rebalance", F.col("id_bucket"))
    ordered = placed.sortWithinPartitions("id_bucket", "id")
    ordered.write.mode("overwrite").partitionBy("id_bucket").parquet(path, compression=CODEC)
    counts = pages.sparkSession.createDataFrame([(buckets,)], f"{BUCKETS} INT")
    counts.write.mode("overwrite").json(f"{path}_layout")
    return read_by_id(pages.sparkSession, path)


def read_by_id(spark: SparkSession, path: str) -> DataFrame:
    """Pages written by :func:`store_by_id`; the column ``id_bucket`` knows how many buckets there are."""
    buckets = spark.read.schema(f"{BUCKETS} INT").json(f"{path}_layout").first()[BUCKETS]
    return spark.read.parquet(path).withMetadata("id_bucket", {BUCKETS: buckets})


def store_by_title(directory: DataFrame, path: str, ranges: int | None = None) -> DataFrame:
    """Write a directory sorted by title, in a folder for each of some ranges of titles; read it back.

    ``{path}_ranges`` has the first title of each range that is not empty.
    """
    if ranges is None:
        ranges = min(MOST_RANGES, max(1, -(-directory.count() // RANGE_ROWS)))
    rows = directory.withColumn("_row", F.monotonically_increasing_id())
    order = ["title_norm", "id", "_row"]
    ranged = rows.repartitionByRange(ranges, *order).withColumn("title_range", F.spark_partition_id())
    sorted_ = ranged.sortWithinPartitions("title_range", *order).drop("_row")
    sorted_.write.mode("overwrite").partitionBy("title_range").parquet(path)
    stored = directory.sparkSession.read.parquet(path)
    starts = stored.groupBy("title_range").agg(F.min("title_norm").alias("start"))
    starts.coalesce(1).write.mode("overwrite").parquet(f"{path}_ranges")
    return stored
