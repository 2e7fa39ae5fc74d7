"""Text output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def export_tsv(df: DataFrame, path: str, key: list[str], value: list[str]) -> None:
    """Write ``key TAB value`` lines, ordered by key over all files.

    Key columns are joined by a blank, as are value columns. The order is that of the text;
    equal lines may continue in the next file, so a frequent key does not end in one task.
    """
    text = lambda names: F.concat_ws(" ", *[F.col(c).cast("string") for c in names])
    (
        df.select(text(key).alias("key"), text(value).alias("value"))
        .withColumn("row", F.monotonically_increasing_id())
        .orderBy("key", "value", "row")
        .select(F.concat_ws("\t", "key", "value").alias("value"))
        .write.mode("overwrite")
        .text(path)
    )
