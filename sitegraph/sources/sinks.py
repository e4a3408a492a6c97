"""Sinks: page JSON records and their file names.

The reference writes one JSON file per page, named from the title and the time of the
run.  ``write_page_json`` writes these files from the tasks (``sources.files``);
``write_page_lines`` is the form for crawls of many small pages: the same documents as
lines of text, partitioned by root.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegraph.functions import urls as U

def run_timestamp(at: datetime | None = None) -> str:
    """Timestamp part of saved file names (``yyyyMMddHHmmssSSS``): of one moment for a whole run, so that all
    plans of the run name a file alike."""
    return (at or datetime.now(timezone.utc)).strftime("%Y%m%d%H%M%S%f")[:17]


def page_file_name(title: Column, ts: Column) -> Column:
    """``<sanitised title>_<timestamp>.json``."""
    return F.concat(U.sanitize_file_name(title), F.lit("_"), ts, F.lit(".json"))


def page_records(records: DataFrame, ts: Column) -> DataFrame:
    """Add ``file_name`` and ``json`` (the record without empty fields)."""
    fields = [c for c in ["url", "title", "imageFiles", "documentFiles", "metaTags", "content"]
              if c in records.columns]
    cleaned = [F.when(F.size(F.col(c)) > 0, F.col(c)).alias(c) if dict(records.dtypes)[c].startswith("array")
               else F.nullif(F.col(c), F.lit("")).alias(c) for c in fields]
    return records.withColumn("file_name", page_file_name(F.col("title"), ts)) \
                  .withColumn("json", F.to_json(F.struct(*cleaned)))


def write_page_json(records: DataFrame, path: str) -> DataFrame:
    """One file per record under its ``file_name``; records of like names are told apart by URL.  Returns what was
    saved (``key, file_name, n_bytes, path``, the key being the URL)."""
    from sitegraph.sources import files
    return files.save(records.select(F.col("url").alias("key"), "file_name", F.col("json").alias("content")), path)


def write_page_lines(records: DataFrame, path: str, partition_by: str | None = None) -> None:
    """The records' JSON documents as lines of text."""
    columns = [partition_by] if partition_by else []
    w = records.select("json", *columns).write.mode("overwrite")
    (w.partitionBy(*columns) if columns else w).text(path)
