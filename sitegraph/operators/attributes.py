"""Response attributes as an open map, and the fields that stored responses hold.

The reference returns every result with a map of attributes that has no fixed
schema.  Here the map is a VARIANT column: fields that no schema knows are kept, read by
path (``variant_get``) and listed (``fields``).  The document is parsed once per row and
its binary form is walked; nothing is grouped by response.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attributes(**fields: Column) -> Column:
    """VARIANT of the named values; null ones are left out of the map."""
    names, values = list(fields), list(fields.values())
    entries = F.filter(F.array(*[F.struct(F.lit(n).alias("k"), F.to_variant_object(F.struct(v.alias("v"))).alias("v"), v.isNotNull().alias("there"))
                                 for n, v in zip(names, values)]), lambda e: e["there"])
    whole = F.map_from_entries(F.transform(entries, lambda e: F.struct(e["k"], F.variant_get(e["v"], "$.v", "variant"))))
    return F.to_variant_object(whole)


def parsed(body: Column) -> Column:
    """A stored response as VARIANT; null where it is no JSON."""
    return F.try_parse_json(body)


def fields(df: DataFrame, variant: str, depth: int = 16) -> DataFrame:
    """Every field of a VARIANT column: ``path, type, n_values, n_rows`` over all rows.

    Array places are written ``[]``, so the inventory is as long as the documents' shapes
    are many, not as the arrays are long.  A level of nesting is one lateral explode; levels
    end where no value is an object or an array (``depth`` at most, deeper ones raise).
    Values are counted where they stand: only (path, type) counts are shuffled, and the rows
    that hold a path by a sum of ones per row.
    """
    spark = df.sparkSession
    rows = df.select(F.xxhash64(F.monotonically_increasing_id()).alias("_r"), F.lit("$").alias("_p"), F.col(variant).alias("_v")).where("_v is not null")
    out = None
    for level in range(depth + 1):
        kind = F.schema_of_variant("_v")
        shown = F.when(kind.startswith("OBJECT"), "OBJECT").when(kind.startswith("ARRAY"), "ARRAY").otherwise(kind)
        here = rows.select("_r", F.col("_p").alias("path"), shown.alias("type")).groupBy("_r", "path", "type").agg(F.count("*").alias("n"))
        found = here.groupBy("path", "type").agg(F.sum("n").alias("n_values"), F.count("*").alias("n_rows"))
        out = found if out is None else out.unionByName(found)
        inner = rows.where(kind.startswith("OBJECT") | kind.startswith("ARRAY"))
        if level == depth:
            if not inner.isEmpty():
                raise ValueError(f"values nested deeper than {depth}")
            break
        each = inner.lateralJoin(spark.tvf.variant_explode(F.col("_v").outer()))
        step = F.when(F.col("key").isNull(), F.lit("[]")).otherwise(F.concat(F.lit("."), F.col("key")))
        rows = each.select("_r", F.concat("_p", step).alias("_p"), F.col("value").alias("_v"))
        if rows.isEmpty():
            break
    return out


def merged_schema(df: DataFrame, variant: str) -> DataFrame:
    """One row: the schema that all values of a VARIANT column have in common (``schema``)."""
    return df.agg(F.schema_of_variant_agg(variant).alias("schema"))
