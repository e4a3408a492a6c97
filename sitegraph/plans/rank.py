"""Exact row numbers inside groups that may be huge.

``row_number() OVER (PARTITION BY g ORDER BY o)`` puts a whole group into
one task.  When one group can hold a large share of all rows (one site
with a third of the pages), the rank is built from pieces instead:

1. range-partition the rows by ``(g, o)``: sampled bounds split a hot group
   over many partitions, each holding a contiguous slice of its order;
2. checkpoint the rows with their partition number (so a re-run cannot
   move a row to another slice);
3. count rows per (slice, group): a small table, at most one row per
   slice and group that meet;
4. the offset of a slice inside its group is the sum of the counts of the
   earlier slices of that group (a window over the small table);
5. the local rank is a row number inside (slice, group), which is bounded
   by the slice size.

The result equals the plain window's row number (ties broken by the order
columns, which must be unique inside a group for a deterministic answer).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitegraph.session import checkpoint_dir


def split_row_number(df: DataFrame, group: list[str], order: list[str], out: str = "rn",
                     slices: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based row number of each row inside its group."""
    n = slices or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    s = df.repartitionByRange(n, *group, *order).withColumn("_slice", F.spark_partition_id())
    checkpoint_dir(df.sparkSession)
    s = s.checkpoint(eager=True)
    counts = s.groupBy("_slice", *group).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("_slice", *group, F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    local = Window.partitionBy("_slice", *group).orderBy(*order)
    ranked = s.withColumn("_local", F.row_number().over(local))
    return (ranked.join(offs, ["_slice", *group])
            .withColumn(out, (F.col("_off") + F.col("_local")).cast("bigint"))
            .drop("_slice", "_local", "_off"))
