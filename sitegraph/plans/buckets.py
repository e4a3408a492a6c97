"""Bucketed tables in the shared checkpoint folder.

A table bucketed and sorted by its join columns is read where it lies: a join or
an aggregate on these columns shuffles the other side only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from sitegraph.session import checkpoint_dir


def bucketed(df: DataFrame, name: str, *keys: str) -> DataFrame:
    """``df`` written as a table bucketed and sorted by ``keys``, and read back.

    The files lie under the checkpoint folder, which all executors share, never in the
    session's warehouse.  The catalog entry goes at once; what has been read from it
    keeps the buckets.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/{table}"
    df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return out
