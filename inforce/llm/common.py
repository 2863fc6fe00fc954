"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import functools
import sys
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inforce.session import ensure_checkpoint_dir

#: Bytes with values above 127 never belong to a word break, so UTF-8 bytes do.
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: lineage ends
    there, and a lost executor costs no recomputation of what came before."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_tables() -> None:
    """Called by operators that encode nothing: Python workers are reused, and one
    that encoded before would go on holding its table of sub-words. What is free is
    given back to the system, where it can be."""
    subwords = sys.modules.get("inforce.llm.subwords")
    if subwords is not None:
        subwords.release()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


@functools.lru_cache(maxsize=1)
def one_blas_thread() -> None:
    """Called by operators that multiply matrices: Spark runs a task per core, and a
    numpy that starts further threads for small products mostly waits for them (a
    gradient step took 2.6 times its CPU time with two threads). Does nothing where
    numpy's library is not OpenBLAS."""
    try:
        with open("/proc/self/maps") as f:
            paths = {line.split()[-1] for line in f if "openblas" in line}
    except OSError:
        return
    for path in paths:
        lib = ctypes.CDLL(path)
        for name in ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(lib, name):
                getattr(lib, name)(1)


#: Bytes of an Arrow batch that goes to a Python task.
BATCH_BYTES = "4m"


def bound_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by bytes, so that memory in tasks does not follow the
    length of texts. A bound that the session sets itself stays."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, as (doc_id, text); null text: empty.
    Other columns, whatever they are called, are left out."""
    bound_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def spare(columns: list[str], name: str) -> str:
    """A column name like ``name`` that none of ``columns`` has (whatever the case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Bytes of texts in a group of documents that one task holds.
GROUP_BYTES = 64 << 20


def dealt(docs: DataFrame, group_bytes: int = GROUP_BYTES) -> tuple[DataFrame, int]:
    """``docs`` (doc_id, text) with a group number ``grp``, and how many groups there
    are: as many as the bytes of all texts ask for (one scan), the session's number of
    shuffle partitions at least. Rows are dealt by id and text, so rows without an
    id, or with one that many rows share, spread too."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(total) // group_bytes))
    return docs.withColumn("grp", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int")), groups


def crc_mod(id_col: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (null id: the text is empty)."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % n


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def text_pieces(batches, most: int = 4_000_000):
    """(ids, texts) of Arrow batches, in pieces of about ``most`` characters, so
    that memory in a task follows this bound and not the batch's row count."""
    for b in batches:
        ids, col = b.column(0), b.column(1)
        if b.num_rows == 0:
            continue
        size = np.diff(np.frombuffer(col.buffers()[1], dtype=np.int32 if pa.types.is_string(col.type) else np.int64)[col.offset : col.offset + len(col) + 1].astype(np.int64))
        group = np.cumsum(size) // most
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1), b.num_rows]
        for i, j in zip(edges[:-1], edges[1:], strict=True):
            yield ids.slice(i, j - i), col.slice(i, j - i).to_pylist()


def word_spans(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased (A-Z) bytes, and start and end of every word: the runs
    without space, tab, line feed, vertical tab, form feed and return."""
    raw = _LOWER[np.frombuffer(text, dtype=np.uint8)]
    if raw.size == 0:
        return raw, np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = np.concatenate([[False], ~_BREAK[raw], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return raw, edge[0::2], edge[1::2]


_MUL1, _MUL2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_POLY = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (shift-multiply), wrapping on purpose."""
    x = (x ^ (x >> np.uint64(30))) * _MUL1
    x = (x ^ (x >> np.uint64(27))) * _MUL2
    return x ^ (x >> np.uint64(31))


_POWERS = np.ones(1 << 16, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    """Powers of the (odd) base, kept per process and grown by doubling."""
    global _POWERS
    if _POWERS[1] == 1 or len(_POWERS) < n:
        size = max(len(_POWERS), 1 << max(16, int(n - 1).bit_length()))
        p = np.full(size, _POLY, dtype=np.uint64)
        p[0] = 1
        _POWERS = np.multiply.accumulate(p)
    return _POWERS


def _inverse() -> np.uint64:
    return np.uint64(pow(int(_POLY), -1, 1 << 64))


def word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes: a polynomial over all bytes of the text,
    taken between the word's ends, then mixed."""
    if start.size == 0:
        return np.zeros(0, dtype=np.uint64)
    n = raw.size
    p = _powers(n + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(raw.astype(np.uint64) + np.uint64(1)) * p[:n])])
    inv = _powers_inverse(n + 1)
    return mix((total[end] - total[start]) * inv[start] + (end - start).astype(np.uint64))


_INVERSES = np.ones(1, dtype=np.uint64)


def _powers_inverse(n: int) -> np.ndarray:
    global _INVERSES
    if len(_INVERSES) < n:
        p = np.full(1 << max(16, int(n - 1).bit_length()), _inverse(), dtype=np.uint64)
        p[0] = 1
        _INVERSES = np.multiply.accumulate(p)
    return _INVERSES


def text_blocks(texts: list[str], most: int = 200_000):
    """Consecutive texts as UTF-8, in blocks of about ``most`` bytes."""
    block, size, first = [], 0, 0
    for i, t in enumerate(texts):
        raw = t.encode()
        block.append(raw)
        size += len(raw)
        if size >= most:
            yield first, block
            block, size, first = [], 0, i + 1
    if block:
        yield first, block


def block_shingles(block: list[bytes], words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the runs of ``words`` words of several texts, text after
    text (repeats included), and where each text's end (0 first). A text with
    fewer words has its whole sequence as one; without words, none."""
    raw, start, end = word_spans(b"\n".join(block))
    ends = np.cumsum([len(t) + 1 for t in block])
    h = word_hashes(raw, start, end)
    at = np.concatenate([[0], np.searchsorted(start, ends)])
    n = np.diff(at)
    runs = np.maximum(n - words + 1, 0)
    if h.size >= words:
        full = h[: h.size - words + 1].copy()
        for i in range(1, words):
            full = full * _POLY + h[i : h.size - words + 1 + i]
        keep = np.ones(full.size, dtype=bool)
        for e in at[1:-1]:  # runs that reach over a text's end
            keep[max(0, e - words + 1) : e] = False
        full = mix(full[keep])
    else:
        full = np.zeros(0, dtype=np.uint64)
    short = np.flatnonzero((n > 0) & (n < words))
    if short.size:
        whole = np.empty(short.size, dtype=np.uint64)
        for k, d in enumerate(short.tolist()):
            x = np.uint64(n[d])
            for w in h[at[d] : at[d + 1]]:
                x = x * _POLY + w
            whole[k] = x
        full = np.insert(full, np.cumsum(runs)[short], mix(whole))
        runs[short] = 1
    return full, np.concatenate([[0], np.cumsum(runs)])


def shingle_sets(texts: list[str], words: int = 5):
    """Sorted distinct shingle hashes of each text, one after the other."""
    for _, block in text_blocks(texts):
        h, at = block_shingles(block, words)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            yield np.unique(h[a:b])


np.seterr(over="ignore")
