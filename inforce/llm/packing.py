"""Best-fit packing by a grouping genetic algorithm (operator 8).

Every document is encoded and closed with an end id; only documents longer than
a sequence are cut, into full pieces and a last shorter one. Full pieces are
sequences by themselves. The others are dealt by a hash into shards of a few
thousand pieces; a shard wastes at most part of one sequence compared with
packing everything together, and shards are packed independently on all
executors, however many pieces there are.

In a shard, several *islands* evolve populations of packings. A crossover
injects the best-filled bins of one parent whole into the other; bins of the
receiver that hold any of the injected pieces are dissolved, so nothing is
packed twice, and the displaced pieces are put back by best fit. After each
epoch an island sends its elite to the next island of its shard, which gives up
its worst packing. An island stops as soon as a packing reaches the lower bound
(total length / capacity, rounded up): it cannot be beaten.

Only (doc_id, piece, length) rows are shuffled, never texts or ids.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inforce.llm.common import batch_of, release_tables, text_pieces, texts_of, written
from inforce.llm.subwords import TABLE_CHUNKS, encoder, has_encoder

CAPACITY = 4096
#: Pieces of a shard, islands of a shard, packings of an island, epochs and generations of one.
SHARD_PIECES, ISLANDS, POPULATION, EPOCHS, GENERATIONS = 2000, 2, 4, 2, 6

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PIECE_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", table_chunks: int = TABLE_CHUNKS) -> DataFrame:
    """The pieces of every document: its ids and the end id, cut every
    ``capacity`` ids, with the crc32 of the piece's 32-bit ids. ``table_chunks``
    bounds the table of sub-words that a worker keeps."""

    def cut(batches):
        if not has_encoder(tokenizer_path, table_chunks):
            release_tables()  # what a reused worker still holds of other operators
        enc = encoder(tokenizer_path, table_chunks)
        for ids, texts in text_pieces(batches):
            done = 0
            for flat, n in enc.encode_blocks(texts):
                ends = np.cumsum(n)
                flat = np.insert(flat, ends, end_id).astype("<u4")
                size = n + 1
                first = np.cumsum(size) - size
                pieces = -(-size // capacity)
                row = np.repeat(np.arange(len(n)), pieces)
                no = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = no * capacity
                length = np.minimum(capacity, size[row] - start)
                lo = (first[row] + start) * 4
                raw = memoryview(flat).cast("B")
                crc = [zlib.crc32(raw[a : a + 4 * k]) for a, k in zip(lo.tolist(), length.tolist(), strict=True)]
                yield batch_of(_PIECE_ARROW, doc_id=ids.slice(done, len(n)).take(pa.array(row)), piece=no, start=start, length=length, ids_crc32=crc)
                done += len(n)

    return texts_of(docs, id_col, text_col).mapInArrow(cut, _PIECE)


def best_fit(lengths: np.ndarray, items: np.ndarray, bins: list[list[int]], room: list[int], capacity: int) -> None:
    """Puts ``items``, longest first, each into the bin with the least room that
    still holds it, opening bins as needed. Changes ``bins`` and ``room``."""
    order = sorted((r, b) for b, r in enumerate(room))
    for i in items[np.argsort(-lengths[items], kind="stable")].tolist():
        need = int(lengths[i])
        at = bisect.bisect_left(order, (need, -1))
        if at == len(order):
            bins.append([])
            room.append(capacity)
            left, b = capacity, len(bins) - 1
        else:
            left, b = order.pop(at)
        bins[b].append(i)
        room[b] = left - need
        bisect.insort(order, (left - need, b))


def _bins_of(label: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(label, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(label[order])) + 1)


def _label(bins: list) -> np.ndarray:
    sizes = [len(b) for b in bins]
    out = np.empty(sum(sizes), dtype=np.int32)
    out[np.concatenate([np.asarray(b, dtype=np.int64) for b in bins])] = np.repeat(np.arange(len(bins)), sizes)
    return out


def fitness(lengths: np.ndarray, label: np.ndarray, capacity: int) -> float:
    """Fewer bins first; among equals, the more unevenly filled (mean squared fill)."""
    fill = np.bincount(label, lengths) / capacity
    return float(-len(fill) + np.mean(fill**2))


def crossover(lengths: np.ndarray, giver: np.ndarray, taker: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """A child: whole well-filled bins of ``giver`` injected into ``taker``."""
    fill = np.bincount(giver, lengths)
    good = np.flatnonzero(fill >= np.quantile(fill, 0.5))
    chosen = np.zeros(len(fill), dtype=bool)
    chosen[rng.choice(good, max(1, len(good) // 4), replace=False)] = True
    injected = chosen[giver]
    hit = np.zeros(int(taker.max()) + 1, dtype=bool)
    hit[taker[injected]] = True
    # now and then the worst-filled bins go too, so that their pieces find better places
    own = np.bincount(taker, lengths, minlength=len(hit))
    hit[np.argsort(own)[: max(1, len(hit) // 50)]] = True
    displaced = np.flatnonzero(hit[taker] & ~injected)
    stays = ~hit[taker]
    parts = [*_sub_bins(giver, injected), *_sub_bins(taker, stays)]
    bins = [b.tolist() for b in parts]
    room = [capacity - int(lengths[b].sum()) for b in parts]
    best_fit(lengths, displaced, bins, room, capacity)
    return _label(bins)


def _sub_bins(label: np.ndarray, mask: np.ndarray) -> list[np.ndarray]:
    at = np.flatnonzero(mask)
    if at.size == 0:
        return []
    return [at[b] for b in _bins_of(label[at])]


def seed_packings(lengths: np.ndarray, capacity: int, count: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Best-fit packings: the first longest first, the others by lengths with
    some noise, so that their bins differ. A packing that cannot be beaten ends the
    search: it is returned alone."""
    out: list[np.ndarray] = []
    least = -(-int(lengths.sum()) // capacity)
    for k in range(count):
        keys = lengths * (1 if k == 0 else rng.uniform(0.8, 1.2, lengths.size))
        bins, room = [], []
        order = np.argsort(-keys, kind="stable")
        if k == 0:
            best_fit(lengths, order, bins, room, capacity)
        else:  # in blocks, so that the noise has its way
            for block in np.array_split(order, 20):
                best_fit(lengths, block, bins, room, capacity)
        out.append(_label(bins))
        if len(bins) <= least:
            return [out[-1]]
    return out


def evolve(lengths: np.ndarray, population: list[np.ndarray], capacity: int, generations: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Some generations on one island, best packing first."""
    least = -(-int(lengths.sum()) // capacity)
    scored = sorted(((fitness(lengths, p, capacity), k, p) for k, p in enumerate(population)), key=lambda x: (-x[0], x[1]))
    for _ in range(generations):
        if int(scored[0][2].max()) + 1 <= least:
            break
        a, b = rng.choice(len(scored), 2, replace=len(scored) < 2)
        child = crossover(lengths, scored[min(a, b)][2], scored[max(a, b)][2], capacity, rng)
        f = fitness(lengths, child, capacity)
        if f > scored[-1][0]:
            scored = sorted([*scored[:-1], (f, len(scored), child)], key=lambda x: -x[0])
    return [p for _, _, p in scored]


def _in_order(pieces: pa.Table) -> pa.Table:
    return pieces.sort_by([("length", "descending"), ("row_no", "ascending")])


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES, islands: int = ISLANDS, population: int = POPULATION, epochs: int = EPOCHS, generations: int = GENERATIONS) -> DataFrame:
    """Adds sequence_id and offset to pieces (columns of ``token_pieces``), which
    are written to the shared folder with a number for every row.

    Sequences hold at most ``capacity`` ids and are gapless from 0. Identical
    rows are separate pieces, dealt by their numbers. An empty table gives an empty
    result.
    """
    spark = pieces.sparkSession
    pieces = written(pieces.withColumn("row_no", F.monotonically_increasing_id()), "pieces")
    small = pieces.filter(F.col("length") < capacity)
    shards = max(1, -(-small.count() // shard_pieces))
    tasks = min(shards, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    shard = F.pmod(F.xxhash64("row_no"), F.lit(shards)).cast("int")
    dealt = pieces.withColumn("shard", shard).repartition(tasks, "shard")

    def start(pdf: pd.DataFrame) -> pd.DataFrame:
        release_tables()
        pdf = pdf.sort_values(["length", "row_no"], ascending=[False, True], kind="stable").reset_index(drop=True)
        lengths = pdf.length.to_numpy()
        lengths = lengths[lengths < capacity]
        rows = []
        for k in range(islands if lengths.size else 0):
            rng = np.random.default_rng([int(pdf.shard[0]), k])
            seeds = seed_packings(lengths, capacity, population, rng)
            rows.append((int(pdf.shard[0]), k, lengths, seeds))
            if len(seeds) == 1:  # at the lower bound: the shard needs no other island
                rows = rows[-1:]
                break
        return pd.DataFrame(rows, columns=["shard", "island", "lengths", "packings"])

    def epoch(number: int):
        def run(frames):
            for pdf in frames:
                rows = []
                for r in pdf.itertuples():
                    lengths = np.asarray(r.lengths, dtype=np.int64)
                    rng = np.random.default_rng([r.shard, r.island, number])
                    best = evolve(lengths, [np.asarray(p, dtype=np.int32) for p in r.packings], capacity, generations, rng)
                    rows.append((r.shard, r.island, lengths, best, fitness(lengths, best[0], capacity)))
                yield pd.DataFrame(rows, columns=["shard", "island", "lengths", "packings", "fitness"])

        return run

    state = "shard int, island int, lengths array<long>, packings array<array<int>>"
    now = dealt.select("shard", "length", "row_no").groupBy("shard").applyInPandas(start, state)
    for e in range(epochs):
        now = written(now.mapInPandas(epoch(e), state + ", fitness double"), "islands")
        if e + 1 < epochs and islands > 1:
            # the elite takes the place of the next island's worst packing
            elite = now.select("shard", ((F.col("island") + 1) % islands).cast("int").alias("island"), F.col("packings")[0].alias("elite"))
            joined = now.repartition(tasks, "shard").join(elite.repartition(tasks, "shard"), ["shard", "island"], "left")
            sent = F.concat(F.slice("packings", 1, population - 1), F.array("elite"))
            now = joined.select("shard", "island", "lengths", F.when(F.col("elite").isNull(), F.col("packings")).otherwise(sent).alias("packings"))
    best = now.groupBy("shard").agg(F.max_by(F.col("packings")[0], F.struct("fitness", -F.col("island"))).alias("packing"))

    def place(pieces: pa.Table, best: pa.Table) -> pa.Table:
        pieces = _in_order(pieces)  # Arrow throughout: an id next to a null stays an integer
        lengths = pieces.column("length").to_numpy()
        full = int((lengths >= capacity).sum())  # these come first
        label = np.arange(full)
        if best.num_rows:
            label = np.concatenate([label, full + best.column("packing").combine_chunks().flatten().to_numpy().astype(np.int64)])
        order = np.argsort(label, kind="stable")
        before = np.cumsum(lengths[order]) - lengths[order]
        first = np.concatenate([[True], np.diff(label[order]) != 0]) if len(label) else np.zeros(0, bool)
        offset = np.empty(len(label), dtype=np.int64)
        offset[order] = before - np.repeat(before[first], np.diff(np.append(np.flatnonzero(first), len(label))))
        sequence = pieces.column("shard").to_numpy().astype(np.int64) * (1 << 32) + label
        return pieces.select(_PIECE_ARROW.names).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return dealt.groupBy("shard").cogroup(best.repartition(tasks, "shard").groupBy("shard")).applyInArrow(place, _PIECE + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", table_chunks: int = TABLE_CHUNKS) -> DataFrame:
    """Packs all documents into sequences of at most ``capacity`` ids: one row
    per piece with doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null or empty text: one piece that holds the end id alone. Null ids and
    repeated rows are packed like any other row; an empty table gives an empty
    result; other columns are not read. Texts are encoded once: the pieces are
    written to the shared folder before they are packed.
    """
    return pack_pieces(token_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col, table_chunks), capacity)
