"""Token-id files: Arrow stream files of equal-length sequences (operator 10).

Documents are range-partitioned by id and sorted, encoded, and the ids of a
partition are laid end to end (each document followed by ``end_id``) in
sequences of ``length`` ids: record batches with a fixed-size list of ids
(16 bits wide where the vocabulary allows) and a fixed-size list of mask bits,
which are false in the padding of a file's last sequence only. A reader maps the
file into memory, reads the batches' headers once and then takes any sequence
as a view, without a copy (``SequenceFile``).

Each task writes its own file into the shared folder under a name of its own
(partition and attempt), so retried and speculative attempts never mix: the
index table, written when all tasks have ended, names the files that count.
Files follow each other by partition number, which is ascending doc_id order;
a document's place among *all* ids is the sum of the files before plus its
place in the file. Only one row per file (its number of ids) is gathered.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inforce.llm.common import batch_of, scratch_path, text_pieces, texts_of, written
from inforce.llm.subwords import encoder, load_tokenizer

#: Ids per sequence, and sequences per record batch.
LENGTH, BATCH_ROWS = 2048, 256

_INDEX = pa.schema([("file_no", pa.int32()), ("path", pa.string()), ("row_no", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64())])


def file_schema(length: int, wide: bool) -> pa.Schema:
    ids = pa.uint32() if wide else pa.uint16()
    return pa.schema([pa.field("ids", pa.list_(pa.field("item", ids, False), length), False), pa.field("mask", pa.list_(pa.field("item", pa.bool_(), False), length), False)])


class SequenceWriter:
    """Writes ids that arrive in any portions as batches of equal-length sequences."""

    def __init__(self, sink, length: int, wide: bool, batch_rows: int = BATCH_ROWS):
        self.schema, self.length, self.batch = file_schema(length, wide), length, batch_rows * length
        self.dtype = np.uint32 if wide else np.uint16
        self.out = pa.ipc.new_stream(sink, self.schema)
        self.rest: list[np.ndarray] = []
        self.held = self.total = 0

    def write(self, ids: np.ndarray) -> None:
        self.rest.append(ids.astype(self.dtype))
        self.held += ids.size
        self.total += ids.size
        if self.held >= self.batch:
            flat = np.concatenate(self.rest)
            whole = flat.size // self.batch * self.batch
            for i in range(0, whole, self.batch):
                self._put(flat[i : i + self.batch], self.batch)
            self.rest, self.held = [flat[whole:]], flat.size - whole

    def _put(self, ids: np.ndarray, real: int) -> None:
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(a), type=self.schema.field(i).type) for i, a in enumerate((ids, np.arange(ids.size) < real))]
        self.out.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        if self.held:
            flat = np.concatenate(self.rest)
            padded = np.zeros(-(-flat.size // self.length) * self.length, dtype=self.dtype)
            padded[: flat.size] = flat
            self._put(padded, flat.size)
        self.out.close()


class SequenceFile:
    """Random access to a token-id file; local files are mapped, not read."""

    def __init__(self, path: str):
        fs, where = pyarrow.fs.FileSystem.from_uri(path)
        self.file = pa.memory_map(where) if isinstance(fs, pyarrow.fs.LocalFileSystem) else fs.open_input_file(where)
        self.batches = list(pa.ipc.open_stream(self.file))
        self.length = self.batches[0].schema.field("ids").type.list_size if self.batches else 1
        self.per_batch = self.batches[0].num_rows if self.batches else 1
        self.flat = [b.column("ids").flatten().to_numpy(zero_copy_only=True) for b in self.batches]

    def sequence(self, n: int) -> np.ndarray:
        """The ids of sequence ``n``, as a view of the file."""
        at = n % self.per_batch * self.length
        return self.flat[n // self.per_batch][at : at + self.length]

    def mask(self, n: int) -> np.ndarray:
        return self.batches[n // self.per_batch].column("mask").slice(n % self.per_batch, 1).flatten().to_numpy(zero_copy_only=False)

    def ids(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from place ``start`` of the file."""
        size, parts = self.per_batch * self.length, []
        while count > 0:
            b, at = divmod(start, size)
            part = self.flat[b][at : at + count]
            parts.append(part)
            start, count = start + part.size, count - part.size
        return parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, np.uint32), *parts])

    def close(self) -> None:
        self.flat = self.batches = []
        self.file.close()


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 0, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the files under ``folder`` (a URI that every executor reaches) and
    returns the index: file_no, path, row_no, doc_id, at (place in the file),
    n_tokens (with the end id), start (ids of all documents before).

    Null or empty text: the end id alone. Repeated ids keep one entry per row;
    null ids come first. An empty table gives an empty index. Extra columns are
    not read.
    """
    wide = max(end_id, load_tokenizer(tokenizer_path).get_vocab_size(True) - 1) > 0xFFFF

    def write(batches):
        task = TaskContext.get()
        path = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}.arrow"
        fs, where = pyarrow.fs.FileSystem.from_uri(path)
        enc, writer, sink, row = encoder(tokenizer_path), None, None, 0
        for ids, texts in text_pieces(batches):
            if writer is None:
                fs.create_dir(where.rpartition("/")[0], recursive=True)
                sink = fs.open_output_stream(where)
                writer = SequenceWriter(sink, length, wide)
            done = 0
            for flat, n in enc.encode_blocks(texts):
                ends = np.cumsum(n)
                at = writer.total + np.concatenate([[0], ends[:-1] + np.arange(1, len(n))])
                writer.write(np.insert(flat, ends, end_id))
                yield batch_of(_INDEX, file_no=np.full(len(n), task.partitionId()), path=[path] * len(n), row_no=np.arange(row, row + len(n)), doc_id=ids.slice(done, len(n)), at=at, n_tokens=n + 1)
                done, row = done + len(n), row + len(n)
        if writer is not None:
            writer.close()
            sink.close()

    # a key of the text as second key: rows that share an id, or have none, spread too
    keyed = texts_of(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    sorted_docs = keyed.repartitionByRange("doc_id", "text_key").sortWithinPartitions("doc_id", "text_key").select("doc_id", "text")
    index = written(sorted_docs.mapInArrow(write, "file_no int, path string, row_no long, doc_id long, at long, n_tokens long"), "token-index")
    return with_starts(index)


def with_starts(index: DataFrame) -> DataFrame:
    """Adds ``start`` to an index; the running sum is over one row per file."""
    files = index.groupBy("file_no").agg(F.sum("n_tokens").alias("n"))
    before = files.select("file_no", F.coalesce(F.sum("n").over(Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return index.join(before, "file_no").withColumn("start", F.col("before") + F.col("at")).drop("before")


def read_token_files(index: DataFrame) -> DataFrame:
    """Reads the documents of an index back from the files: doc_id, start,
    n_tokens and the crc32 of the ids as little-endian 32-bit integers."""
    out = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches):
        file = path = None
        for b in batches:
            crc = np.zeros(b.num_rows, dtype=np.int64)
            for i, (p, at, n) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)):
                if p != path:
                    if file is not None:
                        file.close()
                    file, path = SequenceFile(p), p
                crc[i] = zlib.crc32(file.ids(at, n).astype("<u4"))
            yield batch_of(out, doc_id=b.column(3), start=b.column(4), n_tokens=b.column(2), ids_crc32=crc)

    return index.select("path", "at", "n_tokens", "doc_id", "start").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_folder(spark: SparkSession) -> str:
    """A new folder for token files in the shared folder, as a URI."""
    path = scratch_path(spark, "token-files")
    return path if "://" in path or path.startswith("file:") else f"file://{path}"
