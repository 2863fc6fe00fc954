"""Benchmark decontamination by size-partitioned MinHash containment (operator 4).

An item is *contained* in a document if at least ``threshold`` of the item's
distinct five-word shingles occur in it. Jaccard-based signatures miss short
items in long documents, so items are partitioned by size (powers of two of
their number of shingles) and each partition has its own sketch length: an item
of ``n`` shingles that is contained has at least ``ceil(threshold * n)`` of them
in the document, so at least one of its ``n - ceil(threshold * n) + 1`` smallest
MinHash values occurs there. That sketch finds *every* containing document,
however long. A document's values are compared with a partition only below the
largest value that any sketch of the partition holds. Candidates are verified
by exact containment of the item's shingles.

Items go to the tasks in blocks whose sketches have a checked number of values;
a larger benchmark takes several passes over the documents, not a larger
broadcast. Nothing is shuffled.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inforce.llm.common import batch_of, block_shingles, bound_batches, release_tables, shingle_sets, text_blocks, text_pieces, texts_of

THRESHOLD, WORDS = 0.8, 5
#: Shingles of the items sent to the tasks at once (8 bytes each).
BLOCK_VALUES = 2_000_000

_PAIR = "doc_id long, item_id long, n_item long, n_shared long, containment double"
_PAIR_ARROW = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_item", pa.int64()), ("n_shared", pa.int64()), ("containment", pa.float64())])


def sketch_length(n: int, threshold: float) -> int:
    """How many of the smallest of ``n`` values suffice to meet any set that
    holds at least ``threshold`` of them."""
    return n - max(1, math.ceil(threshold * n - 1e-9)) + 1


class ItemIndex:
    """Items by size partition, and the inverted lists of their sketches."""

    def __init__(self, ids: list, sets: list[np.ndarray], threshold: float):
        self.ids, self.sets, self.threshold = ids, sets, threshold
        by_size: dict[int, list[int]] = {}
        for i, s in enumerate(sets):
            if s.size:
                by_size.setdefault(int(s.size).bit_length(), []).append(i)
        self.parts = []
        for _, members in sorted(by_size.items()):
            sketches = [sets[i][: sketch_length(sets[i].size, threshold)] for i in members]
            values = np.concatenate(sketches)
            owner = np.repeat(np.array(members), [s.size for s in sketches])
            order = np.argsort(values, kind="stable")
            values, owner = values[order], owner[order]
            # a bit per bucket of the high bits rejects nearly all other values
            shift = np.uint64(64 - 20)
            seen = np.zeros(1 << 20, dtype=bool)
            seen[(values >> shift).astype(np.int64)] = True
            self.parts.append((values[-1], seen, shift, values, owner))

    def candidates(self, h: np.ndarray):
        """(position in ``h``, item) where a value of ``h`` is in an item's sketch."""
        for top, seen, shift, values, owner in self.parts:
            at = np.flatnonzero(h <= top)
            at = at[seen[(h[at] >> shift).astype(np.int64)]]
            lo, hi = np.searchsorted(values, h[at], "left"), np.searchsorted(values, h[at], "right")
            while (left := lo < hi).any():
                yield at[left], owner[lo[left]]
                lo = lo + left

    def find(self, h: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int]]:
        """(text, item, shared) of the contained items of several texts."""
        pairs = set()
        for at, item in self.candidates(h):
            text = np.searchsorted(ends, at, "right") - 1
            pairs.update(zip(text.tolist(), item.tolist(), strict=True))
        out, own, last = [], None, -1
        for text, item in sorted(pairs):
            if text != last:
                own, last = np.unique(h[ends[text] : ends[text + 1]]), text
            want = self.sets[item]
            pos = np.minimum(np.searchsorted(own, want), own.size - 1)
            shared = int((own[pos] == want).sum())
            if shared >= max(1, math.ceil(self.threshold * want.size - 1e-9)):
                out.append((text, item, shared))
        return out


def item_shingles(items: DataFrame, id_col: str = "item_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(item_id, shingles: sorted distinct hashes as bytes) of items that have words."""

    def run(batches):
        for ids, texts in text_pieces(batches):
            yield pa.RecordBatch.from_arrays([ids, pa.array([s.tobytes() for s in shingle_sets(texts, words)], pa.binary())], names=["item_id", "shingles"])

    return texts_of(items, id_col, text_col).mapInArrow(run, "item_id long, shingles binary").filter(F.length("shingles") > 0)


def _blocks(shingles: DataFrame, most: int):
    """Items in blocks of at most ``most`` shingles (one item at least)."""
    ids, sets, size = [], [], 0
    for r in shingles.toLocalIterator():
        s = np.frombuffer(bytes(r["shingles"]), dtype=np.uint64)
        if sets and size + s.size > most:
            yield ids, sets
            ids, sets, size = [], [], 0
        ids.append(r["item_id"])
        sets.append(s)
        size += s.size
    if sets:
        yield ids, sets


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, block_values: int = BLOCK_VALUES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per (document row, item) with containment of at least
    ``threshold``: doc_id, item_id, n_item (the item's distinct shingles),
    n_shared, containment.

    Texts of fewer than ``words`` words are one shingle, the whole sequence.
    Items and documents that are null, empty or hold no word match nothing.
    Repeated documents give their rows each; items with the same text or id are
    separate items. Empty tables give an empty result; extra columns are not read.
    """
    spark = docs.sparkSession
    base = texts_of(docs, id_col, text_col)
    out = spark.createDataFrame([], _PAIR)
    for ids, sets in _blocks(item_shingles(items, "item_id", "text", words), block_values):
        sent = spark.sparkContext.broadcast((ids, sets))

        def run(batches, sent=sent):
            release_tables()
            index = ItemIndex(*sent.value, threshold)
            for doc_ids, texts in text_pieces(batches):
                for first, block in text_blocks(texts):
                    found = index.find(*block_shingles(block, words))
                    if found:
                        n = [index.sets[i].size for _, i, _ in found]
                        yield batch_of(_PAIR_ARROW, doc_id=doc_ids.take(pa.array([first + t for t, _, _ in found])), item_id=[index.ids[i] for _, i, _ in found], n_item=n, n_shared=[s for _, _, s in found], containment=[s / k for (_, _, s), k in zip(found, n, strict=True)])

        out = out.unionAll(base.mapInArrow(run, _PAIR))
    return out


def without_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text contains an item."""
    spark = docs.sparkSession
    bound_batches(spark)
    out = docs
    schema, at = docs.schema, docs.columns.index(text_col)
    for ids, sets in _blocks(item_shingles(items), BLOCK_VALUES):
        sent = spark.sparkContext.broadcast((ids, sets))

        def run(batches, sent=sent):
            release_tables()
            index = ItemIndex(*sent.value, threshold)
            for b in batches:
                texts = [t or "" for t in b.column(at).to_pylist()]
                keep = np.ones(b.num_rows, dtype=bool)
                for first, block in text_blocks(texts):
                    for t, _, _ in index.find(*block_shingles(block, WORDS)):
                        keep[first + t] = False
                yield b.filter(pa.array(keep))

        out = out.mapInArrow(run, schema)
    return out
