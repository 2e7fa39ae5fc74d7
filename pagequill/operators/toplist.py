"""First rows per group, without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sizing import stored

#: Up to this length Spark cuts each partition before it shuffles a ranking.
CUT_BEFORE_SHUFFLE = 1_000


def top_per_group(
    df: DataFrame,
    group: list[str],
    order: list[Column],
    k: Column,
    max_k: int,
    rank: str,
    distinct_order: bool = False,
) -> DataFrame:
    """Rows of ``df`` with ``rank`` at most ``k`` in their ``group``.

    ``k`` may differ by group; ``max_k`` is its largest value. With ``distinct_order`` rows
    that are equal in ``order`` are returned once. A short list compares the
    rank with a constant, and Spark then keeps ``max_k`` rows per group and partition before
    the shuffle. A longer list is ranked over as many tasks as it needs.
    """
    if max_k > CUT_BEFORE_SHUFFLE:
        return ranked_by_range(df, group, order, rank, distinct_order).where(F.col(rank) <= k)
    number = F.dense_rank if distinct_order else F.row_number
    whole = Window.partitionBy(*group).orderBy(*order)
    out = df.withColumn(rank, number().over(whole)).where(F.col(rank) <= max_k).where(F.col(rank) <= k)
    return out.dropDuplicates([*group, rank]) if distinct_order else out


def ranked_by_range(
    df: DataFrame, group: list[str], order: list[Column], rank: str, distinct_order: bool = False
) -> DataFrame:
    """``df`` with the ``rank`` of each row in its ``group``; a group may be ranked by many tasks.

    Rows are range-partitioned by group and order. A row's rank is its place in its part of the
    group, plus the sizes of the parts before: one number for each group and partition.
    """
    if distinct_order:
        keys = [f"_order{i}" for i in range(len(order))]
        keyed = df.select("*", *[o.alias(n) for o, n in zip(order, keys)])
        df = keyed.dropDuplicates([*group, *keys]).drop(*keys)
    ranged = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    # The number of a row says its partition and its place in it; it is fixed by writing it.
    placed = stored(ranged.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")), "ranked")
    parts = placed.groupBy(*group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_size"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    own = {c: f"_of_{c}" for c in (*group, "_part")}
    parts = parts.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0))).drop("_size")
    parts = parts.withColumnsRenamed(own)
    joined = placed.join(parts, [F.col(c).eqNullSafe(F.col(o)) for c, o in own.items()])
    number = F.col("_at") - F.col("_first") + F.col("_before") + 1
    return joined.select(*df.columns, number.alias(rank))
