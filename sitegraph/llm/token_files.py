"""Token-id files: Arrow streams of fixed-size-list batches.

The ids of all documents, in ascending doc_id order, are one long run.  It is
cut into files by ranges of doc_id, and in each file into sequences of
``width`` ids; the last one is filled up, and the mask tells ids from filling.
A file is an Arrow stream of record batches of ``BATCH`` sequences:

    ids   fixed_size_list<uint16 or uint32>[width]   (uint16 if the vocabulary fits)
    mask  fixed_size_list<bool>[width]

so sequence i is row i % BATCH of batch i // BATCH, and a mapped file gives it
without a copy.  A sidecar stream lists the file's documents: doc_id, start in
the file, n_tokens.  File names carry the task attempt; the manifest that Spark
commits names those that count, so a lost executor leaves at most files that
nobody reads.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitegraph.llm.common import parallelism, stage
from sitegraph.llm import tokens
from sitegraph.llm.tokens import default_path, read_definition
from sitegraph.session import checkpoint_dir

BATCH = 256


def _place(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)


class _SequenceWriter:
    """Cuts a run of ids into sequences and writes them batch by batch."""

    def __init__(self, sink, dtype: np.dtype, width: int):
        self.width, self.dtype, self.left, self.held, self.total = width, dtype, [], 0, 0
        self.kind = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("ids", pa.list_(self.kind, width)), ("mask", pa.list_(pa.bool_(), width))])
        self.out = pa.ipc.new_stream(sink, self.schema)

    def add(self, ids: np.ndarray) -> None:
        self.left.append(ids)
        self.held += len(ids)
        self.total += len(ids)
        if self.held >= BATCH * self.width:
            run = np.concatenate(self.left)
            cut = len(run) // (BATCH * self.width) * BATCH * self.width
            for i in range(0, cut, BATCH * self.width):
                self._write(run[i:i + BATCH * self.width], BATCH * self.width)
            self.left, self.held = [run[cut:]], len(run) - cut

    def _write(self, run: np.ndarray, n: int) -> None:
        size = -(-len(run) // self.width) * self.width
        run = np.concatenate([run, np.zeros(size - len(run), self.dtype)])
        arrays = [pa.FixedSizeListArray.from_arrays(pa.array(run, self.kind), self.width),
                  pa.FixedSizeListArray.from_arrays(pa.array(np.arange(size) < n), self.width)]
        self.out.write_batch(pa.RecordBatch.from_arrays(arrays, schema=self.schema))

    def close(self) -> None:
        if self.held:
            self._write(np.concatenate(self.left), self.held)
        self.out.close()


class TokenFile:
    """A file's sequences; ``ids`` and ``mask`` views share the mapped memory."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        if isinstance(fs, pafs.LocalFileSystem):
            source = pa.memory_map(path)
        else:
            with fs.open_input_file(path) as f:
                source = pa.BufferReader(f.read_buffer())
        self.batches = list(pa.ipc.open_stream(source))
        self._runs = [b.column("ids").flatten().to_numpy(zero_copy_only=True) for b in self.batches]

    def __len__(self) -> int:
        return sum(map(len, self.batches))

    def sequence(self, i: int) -> np.ndarray:
        b = self.batches[i // BATCH].column("ids")
        return b[i % BATCH].values.to_numpy(zero_copy_only=True)

    def mask(self, i: int) -> pa.Array:
        return self.batches[i // BATCH].column("mask")[i % BATCH].values

    def slice(self, start: int, n: int) -> np.ndarray:
        """Ids start to start + n of the file: a view, or a copy where they cross batches."""
        size = len(self._runs[0]) if self._runs else 1  # all batches but the last are full
        first, last = start // size, (start + max(n, 1) - 1) // size
        parts = [self._runs[i][max(start - i * size, 0):start + n - i * size] for i in range(first, last + 1)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 0,
                      width: int = 1024) -> DataFrame:
    """Writes the files and returns the manifest: (part, file, docs, tokens, first) in order of the run.

    ``docs`` needs doc_id and text; other columns are ignored.  A null or empty
    text is its end id alone.  A null doc_id comes first; rows of one doc_id
    stand in the order of their text's hash.  An empty table writes no files.
    ``first`` is the number of ids in earlier files.
    """
    spark = docs.sparkSession
    packet = spark.sparkContext.broadcast(read_definition(tokenizer or default_path("byte_bpe_50k.json")))
    fs, root = _place(folder)
    fs.create_dir(root, recursive=True)
    d = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    d = d.repartitionByRange(parallelism(spark), "doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")

    def write(batches):
        here, root = _place(folder)
        context, encoder = TaskContext.get(), tokens.encoder(packet.value)
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}"
        end, writer, side, n_docs, lo = np.array([end_id], encoder.dtype), None, None, 0, None
        for batch in batches:
            if not len(batch):
                continue
            if writer is None:
                sink = here.open_output_stream(f"{root}/{name}.arrow")
                writer = _SequenceWriter(sink, encoder.dtype, width)
                fields = pa.schema([("doc_id", batch.schema.field(0).type), ("start", pa.int64()), ("n_tokens", pa.int64())])
                side_sink = here.open_output_stream(f"{root}/{name}.docs.arrow")
                side = pa.ipc.new_stream(side_sink, fields)
            starts, sizes = [], []
            for ids in encoder.ids(batch.column(1).to_pylist()):
                starts.append(writer.total)
                sizes.append(len(ids) + 1)
                writer.add(np.concatenate([ids, end]))
            n_docs += len(sizes)
            side.write_batch(pa.RecordBatch.from_arrays([batch.column(0), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())],
                                                        schema=fields))
        if writer is not None:
            for stream, out in ((writer, sink), (side, side_sink)):
                stream.close()
                out.close()
            yield pa.RecordBatch.from_pylist([{"part": context.partitionId(), "file": name, "docs": n_docs, "tokens": writer.total}])

    files = stage(d.mapInArrow(write, "part bigint, file string, docs bigint, tokens bigint"), "token-files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    return files.withColumn("first", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_token_files(files: DataFrame, folder: str, id_type: T.DataType = T.LongType(), with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) and ids if asked, for each document of the manifest's files."""
    schema = T.StructType([T.StructField("doc_id", id_type), *[T.StructField(c, T.LongType()) for c in ("start", "n_tokens", "ids_crc32")],
                           *([T.StructField("ids", T.ArrayType(T.LongType()))] if with_ids else [])])

    def read(batches):
        here, root = _place(folder)
        for batch in batches:
            for row in batch.to_pylist():
                tokens = TokenFile(here, f"{root}/{row['file']}.arrow")
                with here.open_input_file(f"{root}/{row['file']}.docs.arrow") as f:
                    for docs in pa.ipc.open_stream(f):
                        start, n = docs.column("start").to_numpy(), docs.column("n_tokens").to_numpy()
                        parts = [tokens.slice(s, k) for s, k in zip(start.tolist(), n.tolist())]
                        crc = [zlib.crc32(p.astype("<u4").tobytes()) for p in parts]
                        more = [pa.array([p.astype(np.int64) for p in parts], pa.list_(pa.int64()))] if with_ids else []
                        yield pa.RecordBatch.from_arrays([docs.column("doc_id"), pa.array(start + row["first"]), docs.column("n_tokens"),
                                                          pa.array(crc, pa.int64()), *more], schema.fieldNames())

    n = parallelism(files.sparkSession)
    return files.select("file", "first").repartitionByRange(n, "file").mapInArrow(read, schema)


def token_round_trip(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0, width: int = 1024,
                     folder: str | None = None, with_ids: bool = False) -> DataFrame:
    """Writes ``docs`` to token files (under the shared folder unless one is given) and reads each document back."""
    folder = folder or f"{checkpoint_dir(docs.sparkSession).rstrip('/')}/llm-ids-{uuid.uuid4().hex[:12]}"
    files = write_token_files(docs, folder, tokenizer, end_id, width)
    return read_token_files(files, folder, docs.schema["doc_id"].dataType, with_ids)
