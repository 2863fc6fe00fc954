"""Embedding near-duplicates by spherical-cap filters (operator 6).

Filters are caps around directions of structured random product codes: after a
random rotation a vector is cut into blocks, each block has its own small random
codebook, and a direction is one codeword from each block. ``c`` codewords in two
blocks give ``c * c`` filters, but a vector finds all filters whose cap it is in
(its score reaches the threshold) by adding up block scores, best codewords
first: no pass over all filters. Several independent codes make a miss unlikely:
two vectors with a high cosine exceed many filters together, unrelated ones few.

Vectors with equal components are one class from the start, with a number of its
own: ids play no part until the result. Neighbouring filters
of a code form a *cell*; the number of cells follows the number of vectors, so a
cell holds about a thousand of them at any size and the work grows in
proportion. Vectors meet in the cells they share; a crowded cell is split into
chunks, and chunks meet in pairs, so no task holds more than two chunks. In a
meeting all cosines are computed in double precision. A link is counted in its
smallest common cell only, and a meeting returns per vector its number of links
and the root of its group in the meeting, never the pairs: output grows with the
vectors, not with the square of a group.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inforce.llm.common import batch_of, bound_batches, one_blas_thread, written
from inforce.llm.components import connected_components

COSINE = 0.9
#: Independent codes, blocks of a code, filters that a vector exceeds per code (on
#: average), least codewords of a block, vectors wanted in a cell, vectors of a chunk.
CODES, BLOCKS, FILTERS_EACH, CODEWORDS, PER_CELL, CHUNK = 10, 2, 4, 100, 1000, 1024
SEED = 1729

_VECTOR_ARROW = pa.schema([("vec_id", pa.int64()), ("set_key", pa.binary()), ("dim", pa.int32()), ("vector", pa.binary())])


def code_sizes(vectors: int, each: int = FILTERS_EACH, per_cell: int = PER_CELL) -> tuple[int, int]:
    """(codewords per block, filters per cell) for a number of vectors."""
    cells = max(1, vectors * each // per_cell)
    codewords = min(1024, max(CODEWORDS, int(np.ceil(np.sqrt(cells)))))
    return codewords, max(1, codewords * codewords // cells)


@functools.lru_cache(maxsize=8)
def product_code(dim: int, codewords: int, blocks: int = BLOCKS, each: float = FILTERS_EACH, seed: int = SEED):
    """(rotation, codebook per block, first dimension of each block, threshold):
    a random unit vector exceeds ``each`` of the filters on average."""
    rng = np.random.default_rng([seed, dim, codewords])
    rotation = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    edges = np.linspace(0, dim, blocks + 1).round().astype(int)
    books = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        w = rng.normal(size=(codewords, b - a))
        books.append(w / np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-12) / np.sqrt(blocks))
    x = rng.normal(size=(400, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    scores = [x[:, a:b] @ w.T for a, b, w in zip(edges[:-1], edges[1:], books, strict=True)]
    pick = rng.integers(0, codewords, size=(20_000, blocks))
    total = sum(s[:, pick[:, k]] for k, s in enumerate(scores))
    threshold = float(np.quantile(total, max(0.5, 1 - each / codewords**blocks)))
    return rotation, books, edges, threshold


def list_decode(x: np.ndarray, code, most: int = 2_000_000) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter number), ascending, of all filters that each unit vector (row)
    exceeds; one at least, its best. Block after block, only codewords that the best
    of the blocks still to come could lift over the threshold go on; about ``most``
    scores are held at a time."""
    rotation, books, edges, threshold = code
    c = len(books[0])
    step = max(1, most // (c * c))
    rows, numbers = [], []
    for first in range(0, len(x), step):
        part = x[first : first + step] @ rotation
        scores = [part[:, a:b] @ w.T for a, b, w in zip(edges[:-1], edges[1:], books, strict=True)]
        best = np.stack([s.max(axis=1) for s in scores])
        bound = np.minimum(threshold, best.sum(axis=0)) - 1e-12
        row, number, value = np.arange(len(part)), np.zeros(len(part), dtype=np.int64), np.zeros(len(part))
        for k, s in enumerate(scores):
            total = value[:, None] + s[row]
            alive, word = np.nonzero(total >= (bound - best[k + 1 :].sum(axis=0))[row][:, None])
            value, number, row = total[alive, word], number[alive] * c + word, row[alive]
        rows.append(row + first)
        numbers.append(number)
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *rows]), np.concatenate([none, *numbers])


def usable_vectors(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, and for vectors that can be compared a key of the components, the
    dimension and the components (32-bit floats stay so, others become 64-bit
    ones); else nulls (null or empty vectors, null or non-finite components, zero
    vectors)."""
    narrow = embeddings.schema[vector_col].dataType.elementType.typeName() == "float"
    dtype = np.float32 if narrow else np.float64

    def run(batches):
        for b in batches:
            keys, dims, raw = [], [], []
            for v in b.column(1).to_pylist():
                x = None if v is None or not v or any(c is None for c in v) else np.asarray(v, dtype=dtype) + dtype(0)
                ok = x is not None and bool(np.isfinite(x).all()) and bool(x.any())
                raw.append(x.tobytes() if ok else None)
                keys.append(hashlib.blake2b(raw[-1], digest_size=16).digest() if ok else None)
                dims.append(x.size if ok else None)
            yield batch_of(_VECTOR_ARROW, vec_id=b.column(0), set_key=keys, dim=dims, vector=raw)

    return embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")).mapInArrow(run, "vec_id long, set_key binary, dim int, vector binary")


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    # scaled first, so that squares neither overflow nor vanish
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _stacked(raw: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(raw), dtype=np.float32 if len(raw[0]) == 4 * dim else np.float64).reshape(len(raw), dim)


def cell_rows(classes: DataFrame, codewords: int, span: int, each: int, codes: int) -> DataFrame:
    """(rep, cells): all cells of a class, ascending, as 64-bit integers."""

    def run(batches):
        one_blas_thread()
        for b in batches:
            dim, raw = b.column(1).to_pylist(), b.column(2).to_pylist()
            for d in sorted(set(dim)):
                every = [i for i, x in enumerate(dim) if x == d]
                for at in (every[i : i + 500] for i in range(0, len(every), 500)):
                    x = _unit(_stacked([raw[i] for i in at], d))
                    row, cell = [], []
                    for k in range(codes):
                        found, number = list_decode(x, product_code(d, codewords, each=each, seed=SEED + k))
                        number = ((d * codes + k) << 24) + number // span
                        new = np.concatenate([[True], (np.diff(found) != 0) | (np.diff(number) != 0)])
                        row.append(found[new])
                        cell.append(number[new])
                    row, cell = np.concatenate(row), np.concatenate(cell)
                    order = np.lexsort((cell, row))
                    row, cell = row[order], cell[order]
                    ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(at)))])
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(cell.astype(np.int64)))], names=["rep", "cells"])

    return classes.select("rep", "dim", "vector").mapInArrow(run, "rep long, cells array<long>")


def _meet(key: tuple, rep: np.ndarray, chunk: np.ndarray, copies: np.ndarray, dim: int, vectors: list[bytes], cells: list[np.ndarray], cosine: float):
    """Links of one meeting: (rep, root in the meeting, links counted here)."""
    own, lo, hi = key
    x = _unit(_stacked(vectors, dim))
    linked = x @ x.T >= cosine
    np.fill_diagonal(linked, False)
    if lo != hi:
        linked &= chunk[:, None] != chunk[None, :]
    touched = np.flatnonzero(linked.any(axis=1))
    if touched.size == 0:
        return None
    linked = linked[np.ix_(touched, touched)]
    # links that a smaller common cell counts already
    lists = [cells[i] for i in touched]
    lists = [f[f < own] for f in lists]
    flat = np.concatenate(lists)
    values, inverse, count = np.unique(flat, return_inverse=True, return_counts=True)
    column = np.cumsum(count > 1) - 1
    width = int((count > 1).sum())
    first = linked
    if width:
        member = np.zeros((touched.size, width), dtype=np.float32)
        row = np.repeat(np.arange(touched.size), [f.size for f in lists])
        keep = count[inverse] > 1
        member[row[keep], column[inverse[keep]]] = 1
        first = linked & (member @ member.T == 0)
    links = first @ copies[touched]
    label = np.arange(touched.size)
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], touched.size).min(axis=1))
        new = new[new]
        if (new == label).all():
            break
        label = new
    ids = rep[touched]
    return ids, ids[label], links


def meetings(rows: DataFrame, cosine: float) -> DataFrame:
    """Runs every meeting of rows sorted by (cell, lo, hi) within partitions;
    at most one meeting's rows are held at a time."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])

    def run(batches):
        one_blas_thread()
        held: list[pa.RecordBatch] = []
        last = None

        def close():
            t = pa.Table.from_batches(held)
            cols = [t.column(c).to_numpy() for c in ("rep", "chunk", "copies")]
            got = _meet(last, *cols, t.column("dim")[0].as_py(), t.column("vector").to_pylist(), [c.values.to_numpy() for c in t.column("cells")], cosine) if t.num_rows > 1 else None
            return batch_of(out, a=got[0], b=got[1], links=got[2]) if got else None

        for b in batches:
            if b.num_rows == 0:
                continue
            k = [b.column(i).to_numpy() for i in range(3)]
            cut = np.flatnonzero((np.diff(k[0]) != 0) | (np.diff(k[1]) != 0) | (np.diff(k[2]) != 0)) + 1
            for i, j in zip([0, *cut], [*cut, b.num_rows], strict=True):
                key = tuple(int(c[i]) for c in k)
                if key != last and held:
                    if (made := close()) is not None:
                        yield made
                    held = []
                last = key
                held.append(b.slice(i, j - i))
        if held and (made := close()) is not None:
            yield made

    return rows.mapInArrow(run, "a long, b long, links long")


def embedding_duplicates(embeddings: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding", codes: int = CODES, each: int = FILTERS_EACH, chunk: int = CHUNK) -> DataFrame:
    """One row per input row: vec_id, n_links (other rows linked directly),
    component_id (smallest vec_id reachable), kept.

    Rows are linked at a cosine of at least ``cosine``; every pair returned as
    linked is verified. At 64 dimensions and the settings above, fewer than one
    pair in a thousand exactly at the threshold shares no cell, and none was missed
    in 20,000 at a cosine of 0.95, for tables of up to some 2.5 million vectors;
    beyond that cells become finer and about three in a thousand at the threshold
    are missed at 25 million (recall above 0.99 at 250 million). Vectors that are
    null, empty, zero or hold null or non-finite components, and vectors of other
    dimensions, link with nothing; a null vec_id links with nothing and has a null
    component. Repeated rows are rows; rows are linked by their vectors alone, so an
    id that names two vectors has each row's own links. An empty table gives an
    empty result; extra columns are not read.
    """
    spark = embeddings.sparkSession
    bound_batches(spark)
    made = written(usable_vectors(embeddings, id_col, vector_col), "vectors")
    usable = made.filter(F.col("set_key").isNotNull() & F.col("vec_id").isNotNull())
    classes = usable.groupBy("set_key").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("dim").alias("dim"), F.first("vector").alias("vector"))
    # written with its numbers, so they stay what they are
    classes = written(classes.withColumn("rep", F.monotonically_increasing_id()), "vector-classes")
    codewords, span = code_sizes(classes.count(), each)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # each vector is decoded once; from here on its cells are numbers
    decoded = written(cell_rows(classes.repartition(tasks), codewords, span, each, codes), "cells")
    places = decoded.select("rep", F.explode("cells").alias("cell"))
    crowd = places.groupBy("cell").agg(F.count("*").alias("n")).filter(F.col("n") > 1).select("cell", F.ceil(F.col("n") / chunk).cast("int").alias("chunks"))
    own = F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")
    met = places.join(crowd, "cell").withColumn("chunk", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    met = met.select("cell", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"), "rep", "chunk")
    carried = classes.join(decoded, "rep").select("rep", "copies", "dim", "vector", "cells")
    met = met.join(carried, "rep").select("cell", "lo", "hi", "rep", "chunk", "copies", "dim", "vector", "cells")
    met = met.repartition(tasks, "cell", "lo", "hi").sortWithinPartitions("cell", "lo", "hi")
    found = written(meetings(met, cosine), "meetings")
    links = found.groupBy("a").agg(F.sum("links").alias("links"))
    component = connected_components(found.select("a", "b"))
    of_class = (
        classes.select("set_key", "rep", "least", "copies")
        .join(links.withColumnRenamed("a", "rep"), "rep", "left")
        .join(component.withColumnRenamed("node", "rep"), "rep", "left")
        .select("set_key", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    )
    least = of_class.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = of_class.join(least, "component").select("set_key", "n_links", "component_id")
    key = F.when(F.col("vec_id").isNotNull(), F.col("set_key"))
    joined = made.select("vec_id", key.alias("set_key")).join(of_class, "set_key", "left")
    component_id = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component_id.alias("component_id"), F.coalesce(F.col("vec_id") == component_id, F.lit(False)).alias("kept"))
