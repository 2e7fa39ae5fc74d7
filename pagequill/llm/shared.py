"""Tables in the shared folder and connected components, used by several operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path

#: What counts as white space in texts, as a class for Java and DuckDB patterns.
SPACE = r"[\x20\x09-\x0D]"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def carried(df: DataFrame) -> DataFrame:
    """``df`` as one column ``row``, so that no column of it clashes with those added beside it."""
    return df.select(F.struct("*").alias("row"))


def unpacked(df: DataFrame) -> DataFrame:
    """The columns that ``carried`` packed, and no other."""
    return df.select("row.*")


def field(name: str) -> Column:
    """A column of a table that ``carried`` packed."""
    return F.col(f"row.`{name}`")


def numbered(df: DataFrame) -> DataFrame:
    """``df`` as ``carried`` packs it, with a ``number`` for each row, written so that the numbers stay."""
    return saved(carried(df).withColumn("number", F.monotonically_increasing_id()), "rows")


def row_key(id_col: str) -> Column:
    """Key of a numbered row that no other has; sorts by id, null ids last."""
    own = field(id_col)
    return F.struct(own.isNull().alias("none"), own.alias("id"), F.col("number").alias("row"))


def without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of ``numbered`` that are not in ``gone(number)``, unpacked."""
    return unpacked(rows.join(gone, "number", "left_anti"))


def remove(df: DataFrame) -> None:
    """Delete the files of a table that ``saved`` wrote and nothing reads any more."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def hashed_share(h: Column, wanted: int, total: int) -> Column:
    """Condition on a hash that about twice the ``wanted`` of ``total`` rows meet, or all.

    A sort with a limit behind it then gets few rows, however many there are.
    """
    share = min(1.0, 2.0 * wanted / max(1, total))
    return F.pmod(h, F.lit(1 << 40)) < int(share * (1 << 40))


def components(links: DataFrame) -> DataFrame:
    """Connected components of the undirected ``links(a, b)`` of BIGINT nodes.

    Returns (node, component) for every node of a link between different nodes; the component
    is its smallest node. Null ends, loops and repeated links add nothing. Large-star and
    small-star steps alternate: each ties the neighbours of a node to the smallest of them, by
    an aggregate and a join on the node, so no neighbourhood is gathered in one place.
    """
    lo, hi = F.least("a", "b"), F.greatest("a", "b")
    links = links.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    edges = saved(links.select(lo.alias("lo"), hi.alias("hi")).where("lo < hi").distinct(), "links")
    mark = F.struct(F.count("*"), F.bit_xor(F.xxhash64("lo", "hi")))
    before = edges.agg(mark.alias("m")).first()["m"]
    while before[0]:
        both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(
            edges.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
        )
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m")
        )
        large = both.where("v > u").join(smallest, "u").select(
            F.col("m").alias("lo"), F.col("v").alias("hi")
        )
        large = saved(large.distinct(), "large-star")
        smallest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(smallest, "hi").select(
            F.col("m").alias("lo"), F.explode(F.array("lo", "hi")).alias("hi")
        )
        previous, edges = edges, saved(small.where("lo < hi").distinct(), "links")
        remove(previous)
        remove(large)
        after = edges.agg(mark.alias("m")).first()["m"]
        if after == before:
            break
        before = after
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )
