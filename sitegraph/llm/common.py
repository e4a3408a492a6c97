"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegraph.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; ASCII texts take the quicker function, which then does the same."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parallelism(spark: SparkSession) -> int:
    """Shuffle partitions of the session."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def row_key(*cols: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes naming a row by its values.

    Rows that repeat all values share a key, so what is computed per key holds
    for each of them.  The hash passes over nulls, so which values are null is
    hashed too: (null, x) and (x, null) are different rows.
    """
    null = [c.isNull() for c in cols]
    return (F.xxhash64(F.lit("a"), *null, *cols).alias("k1"), F.xxhash64(F.lit("b"), *null, *cols).alias("k2"))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores behind it as no column of ``df`` is named alike."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table under the shared checkpoint folder and read it back.

    The table cuts the lineage (a lost executor re-reads files, it does not
    recompute) and gives the planner its true size, so Spark broadcasts it
    only while it is under the session's threshold.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
