"""Saved files: a Spark data source that writes one file per row.

``df.write.format("sitefiles").mode("append").save(folder)`` writes each row's
``content`` (string or binary) under its ``file_name``; ``files.save`` does it with the
bookkeeping around it.  Writing is a task's work and follows Spark's commit protocol:

* a task attempt writes into a folder of its own below ``_pending``, under a name no
  other attempt has;
* when all tasks have ended well, the driver moves the folder of every attempt that
  counts into place, one move a task whatever the number of files;
* what other attempts of a task, or an aborted job, have written goes with ``_pending``.

Names told alike within a task (``a.png`` of two pages) are told apart by a hash of the
row's ``key`` column; tasks have folders of their own.  A row without a name or without
content is not written and is counted as skipped.
"""

from __future__ import annotations

import hashlib
import os
import re
import time
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "sitefiles"
PENDING = "_pending"
MANIFEST = "saved-files.parquet"


@dataclass
class Saved(WriterCommitMessage):
    """What one attempt has written: its folder and its counts."""
    folder: str
    files: int
    skipped: int
    size: int


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path there (not escaped: names may hold any character)."""
    if "://" in path and not path.startswith("file:"):
        scheme, _, rest = path.partition("://")
        host, _, at = rest.partition("/")
        return fs.FileSystem.from_uri(f"{scheme}://{host}/")[0], "/" + at
    return fs.LocalFileSystem(), os.path.abspath(re.sub("^file:(//)?", "", path))


def apart(name: str, key: str, taken: set[str]) -> str:
    """``name``, with a hash of ``key`` before its extension where the name is taken."""
    stem, dot, ext = name.rpartition(".") if "." in name.strip(".") else (name, "", "")
    mark, n = hashlib.sha256(key.encode()).hexdigest(), 8
    out = name
    while out.lower() in taken:  # the same key twice: more of the hash, then a count
        out = f"{stem}~{mark[:n] if n <= 64 else mark + str(n)}{dot}{ext}"
        n += 8
    taken.add(out.lower())
    return out


class FileWriter(DataSourceArrowWriter):
    def __init__(self, path: str, job: str, names: list[str]):
        self.path, self.job = path, job
        self.at = {n: names.index(n) for n in ("file_name", "content")} | {"key": names.index("key") if "key" in names else names.index("file_name")}

    def _pending(self) -> tuple[fs.FileSystem, str]:
        system, root = _filesystem(self.path)
        return system, f"{root}/{PENDING}/{self.job}"

    def write(self, batches) -> Saved:
        system, root = self._pending()
        folder = uuid.uuid4().hex
        system.create_dir(f"{root}/{folder}", recursive=True)
        taken: set[str] = {MANIFEST}
        files = skipped = size = 0
        saved = []
        for batch in batches:
            names, contents, keys = (batch.column(self.at[c]).to_pylist() for c in ("file_name", "content", "key"))
            for name, content, key in zip(names, contents, keys):
                if not name or content is None:
                    skipped += 1
                    continue
                data = content.encode() if isinstance(content, str) else content
                name = apart(name.replace("/", "_"), str(key), taken)
                with system.open_output_stream(f"{root}/{folder}/{name}") as out:
                    out.write(data)
                saved.append((str(key), name, len(data)))
                files, size = files + 1, size + len(data)
        if saved:
            import pyarrow.parquet as pq
            pq.write_table(pa.table(dict(zip(("key", "file_name", "n_bytes"), map(list, zip(*saved))))), f"{root}/{folder}/{MANIFEST}",
                           filesystem=system)
        return Saved(folder, files, skipped, size)

    def commit(self, messages: list[Saved | None]) -> None:
        system, root = self._pending()
        _, target = _filesystem(self.path)
        for i, m in enumerate(m for m in messages if m is not None and m.files):
            system.move(f"{root}/{m.folder}", f"{target}/{self.job}-{i:05d}")
        self._drop(system, root)

    def abort(self, messages) -> None:
        self._drop(*self._pending())

    @staticmethod
    def _drop(system: fs.FileSystem, root: str) -> None:
        for wait in (0.1, 0.5, 2, 5, 0):  # tasks that are being killed may still write: again until nothing is left
            try:
                if system.get_file_info(root).type == fs.FileType.NotFound:
                    return
                system.delete_dir(root)
            except OSError:
                if not wait:
                    raise
            time.sleep(wait)


class SiteFiles(DataSource):
    """Options: ``path`` (a folder all executors share) and ``job`` (prefix of the task folders)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "file_name string, content binary, key string"

    def writer(self, schema, overwrite: bool) -> FileWriter:
        if overwrite:
            raise ValueError("saved files are added to a folder; use mode append")
        names = schema.fieldNames()
        for n in ("file_name", "content"):
            if n not in names:
                raise ValueError(f"a column {n} is needed")
        return FileWriter(self.options["path"], self.options["job"], names)


def save(files: DataFrame, folder: str) -> DataFrame:
    """Writes ``files`` (file_name, content and, to tell like names apart, key); what was saved as
    ``key, file_name, n_bytes, path``."""
    spark = files.sparkSession
    spark.dataSource.register(SiteFiles)
    job = uuid.uuid4().hex[:12]
    columns = ["file_name", "content", *(["key"] if "key" in files.columns else [])]
    out = files.select(*columns)
    if "key" in columns:
        out = out.withColumn("key", F.col("key").cast("string"))
    out.write.format(FORMAT).option("path", folder).option("job", job).mode("append").save()
    return saved(spark, folder, job)


def saved(spark: SparkSession, folder: str, job: str = "") -> DataFrame:
    """``key, file_name, n_bytes, path`` of the files in a folder (of one job): read from the tasks' manifests."""
    schema = "key string, file_name string, n_bytes long"
    system, root = _filesystem(folder)
    there = [f for f in system.get_file_info(fs.FileSelector(root, allow_not_found=True)) if f.base_name.startswith(job) and f.base_name != PENDING]
    if not there:
        return spark.createDataFrame([], schema + ", path string")
    df = spark.read.schema(schema).parquet(f"{folder.rstrip('/')}/{job}*/{MANIFEST}")
    return df.withColumn("path", F.concat(F.lit(folder.rstrip("/") + "/"), F.element_at(F.split(F.input_file_name(), "/"), -2),
                                         F.lit("/"), "file_name"))


def read_back(files: DataFrame) -> DataFrame:
    """What ``save`` or ``saved`` returned, with the ``content`` as it lies on disk; tasks open the files, also those
    whose names Spark's own sources take for hidden."""
    schema = files.select("key", "file_name", "n_bytes", "path", F.lit(b"").alias("content")).schema

    def each(batches):
        for b in batches:
            out = []
            for path in b.column("path").to_pylist():
                system, at = _filesystem(path)
                with system.open_input_stream(at) as f:
                    out.append(f.read())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], [*b.schema.names, "content"])

    return files.select("key", "file_name", "n_bytes", "path").mapInArrow(each, schema)
