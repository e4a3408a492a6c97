"""Connected components of an edge table, by alternating large and small stars.

Every round is joins and aggregates over tables staged in the shared folder:
no link and no component passes the driver.  The minimum of a node's
neighbours is a partial aggregate and the joins have plain exchanges on both
sides, so Spark can split a hub's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegraph.llm.common import stage


def _sum(edges: DataFrame):
    return edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()


def components(edges: DataFrame) -> DataFrame:
    """(a, b): each node with a link and the smallest node it reaches (not for that node itself).

    ``edges`` has the columns a and b, of one type that has an order.  Loops
    and repeated links are ignored; an empty table gives an empty one.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    e = stage(e, "edges")
    last = _sum(e)
    while last[0]:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stage(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "large-star")
        e = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        e = stage(e, "edges")
        low = stage(e.groupBy("a").agg(F.min("b").alias("m")), "small-star")
        e = e.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").union(low.toDF("a", "b")).distinct()
        e = stage(e, "edges")
        now = _sum(e)
        if now == last:
            break
        last = now
    return e
