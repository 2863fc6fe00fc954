"""Exact repeated spans across documents by suffix sorting (operator 9).

Bytes covered by a ``length``-byte string that also starts in a document with a
smaller id are removed. Suffixes of the whole corpus are never gathered; strings
are routed so that equal ones meet, and each task sorts the suffixes it gets:

1. Documents are dealt into groups of bounded size. Every
   ``length``-byte string chooses an *anchor* in itself (``suffixes.anchors``),
   so equal strings choose equal anchors. Each group sends its distinct anchors
   (``KEY_BITS`` of their hashes), with counts, to a bucket by the hash; a bucket
   answers with a bit for each, set if it occurs in more than one document. With
   them go the digests of *chunks*, the strings of some neighbouring anchors end to
   end; there the bit says that a smaller id has an equal chunk. All strings of such
   a chunk are repeated, so it is removed at once. Both ways one entry per group
   and anchor or chunk moves, however often it occurs.
2. Text around the shared anchors of the other chunks becomes *pieces*: the strings
   of one occurrence of an anchor, end to end. (The smallest id that holds a string
   never loses its chunk, so it is among them.) Strings of very frequent anchors travel
   alone, routed by their own hash, so that a passage that a third of all
   documents share spreads over all tasks. Equal pieces of a group travel once,
   for the smallest id.
3. A task collapses equal pieces of several groups in the same way, builds the
   suffix order of the distinct ones by two-stage sorting, and reads the runs of adjacent suffixes with a common
   prefix of ``length``: the smallest id of a run owns its string, all other
   places of it are removed.
4. Groups get their places back and cut their texts.

The texts are shuffled once, compressed; steps 1, 2 and 4 read the same exchange.
Sorted numbers travel as differences, by bytes (``planes``).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from inforce.llm.common import dealt, texts_of
from inforce.llm.suffixes import anchors, chunk_starts, smallest_owner

LENGTH = 50
#: Anchors that occur at least this often send their strings one by one.
FREQUENT = 4096
#: Text in which anchors are chosen at once (bytes).
BLOCK_BYTES = 100_000
#: Texts that a task holds before it sends them to their groups (bytes).
HELD_BYTES = 32 << 20
#: Bits of an anchor's hash that travel. Different anchors that agree in them only
#: cause pieces that no other document turns out to have.
KEY_BITS = 40

_TEXTS_ARROW = pa.schema([("grp", pa.int32()), ("payload", pa.binary())])
_MESSAGE = "target int, origin int, payload binary"
_MESSAGE_ARROW = pa.schema([("target", pa.int32()), ("origin", pa.int32()), ("payload", pa.binary())])
_OUT_ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.int64()))])


def pack(*arrays: np.ndarray, level: int = 1) -> bytes:
    """Arrays as compressed bytes."""
    head = np.array([len(arrays), *(a.nbytes for a in arrays)], dtype=np.int64)
    return zstandard.ZstdCompressor(level=level).compress(b"".join([head.tobytes(), *(np.ascontiguousarray(a).tobytes() for a in arrays)]))


def unpack(raw: bytes, *dtypes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(raw)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    sizes = np.frombuffer(data, np.int64, n, 8).tolist()
    at, out = 8 * (n + 1), []
    for size, dtype in zip(sizes, dtypes, strict=True):
        out.append(np.frombuffer(data[at : at + size], dtype=dtype))
        at += size
    return out


def planes(numbers: np.ndarray) -> np.ndarray:
    """64-bit numbers by bytes: all lowest ones, all second ones and so on. The high
    bytes of small numbers are equal and compress to almost nothing."""
    return np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, 8).T.ravel()


def from_planes(raw: np.ndarray) -> np.ndarray:
    """int64 numbers of ``planes``."""
    return np.ascontiguousarray(raw.reshape(8, -1).T).view(np.int64).ravel()


def steps(numbers: np.ndarray) -> np.ndarray:
    """Numbers in an order of their own as differences to the one before, as planes."""
    return planes(np.diff(numbers, prepend=numbers.dtype.type(0)))


def from_steps(raw: np.ndarray) -> np.ndarray:
    return np.cumsum(from_planes(raw))


def _messages(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.table([pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(_MESSAGE_ARROW)], schema=_MESSAGE_ARROW)


def packed_texts(batches):
    """(group, its documents compressed) of rows (doc_id, text, grp)."""

    def sent():
        rows = []
        for g, docs in held.items():
            ids = np.array([i or 0 for i, _ in docs], dtype=np.int64)
            known = np.array([i is not None for i, _ in docs], dtype=np.uint8)
            sizes = np.array([len(t) for _, t in docs], dtype=np.int64)
            rows.append((g, pack(known, steps(ids), planes(sizes), np.frombuffer(b"".join(t for _, t in docs), dtype=np.uint8), level=3)))
        return pa.record_batch([pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(_TEXTS_ARROW)], schema=_TEXTS_ARROW)

    held: dict[int, list[tuple[int | None, bytes]]] = {}
    size = 0
    for b in batches:
        for i, t, g in zip(b.column(0).to_pylist(), b.column(1).cast(pa.large_binary()).to_pylist(), b.column(2).to_pylist(), strict=True):
            held.setdefault(g, []).append((i, t))
            size += len(t)
            if size >= HELD_BYTES:
                yield sent()
                held.clear()
                size = 0
    if held:
        yield sent()


class Group:
    """The documents of a group in a fixed order, as bytes: ``ids``, all texts end to
    end in ``raw``, and where they end in ``ends`` (0 first)."""

    def __init__(self, table: pa.Table):
        rows = []
        for payload in table.column("payload").to_pylist():
            known, ids, sizes, text = unpack(payload, np.uint8, np.uint8, np.uint8, np.uint8)
            text, sizes = text.tobytes(), from_planes(sizes)
            end = np.cumsum(sizes)
            rows += [(i if k else None, text[b:e]) for k, i, b, e in zip(known.tolist(), from_steps(ids).tolist(), (end - sizes).tolist(), end.tolist(), strict=True)]
        rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        self.ids = [i for i, _ in rows]
        self.raw = b"".join(t for _, t in rows)
        self.ends = np.concatenate([[0], np.cumsum([len(t) for _, t in rows], dtype=np.int64)])

    def blocks(self):
        """(first document, document behind the last) of consecutive documents that
        have an id, ids ascending."""
        known = sum(i is not None for i in self.ids)
        first = 0
        while first < known:
            last = min(known, int(np.searchsorted(self.ends, self.ends[first] + BLOCK_BYTES)))
            yield first, max(last, first + 1)
            first = max(last, first + 1)


class Strings:
    """Anchors and chunks of a group's documents, in the order of their places.

    Of each anchor: ``hash``, ``key`` (the bits that travel), ``first`` and ``last``
    string (places in ``group.raw``), ``doc`` and ``chunk``; of each chunk: ``digest``
    (two numbers), ``begin``, ``end``, ``chunk_doc`` and ``owner``, the document's id.
    ``keys`` and ``digests``: the distinct ones, ascending; ``key_no`` and
    ``digest_no`` lead there.
    """

    def __init__(self, group: Group, length: int):
        found, digests, begins, ends, chunks = [], [], [], [], 0
        text, raw = memoryview(group.raw), np.frombuffer(group.raw, dtype=np.uint8)
        for a, b in group.blocks():
            base = int(group.ends[a])
            h, _, first, last = anchors(raw[base : group.ends[b]], group.ends[a : b + 1] - base, length)
            if not h.size:
                continue
            first, last = first + base, last + base
            doc = np.searchsorted(group.ends, first, "right") - 1
            start = chunk_starts(h, doc)
            at = np.flatnonzero(start)
            begin, end = first[at], last[np.append(at[1:] - 1, h.size - 1)] + length
            found.append((h, first, last, doc, np.cumsum(start) - 1 + chunks))
            digests += [hashlib.blake2b(text[i:j], digest_size=16).digest() for i, j in zip(begin.tolist(), end.tolist(), strict=True)]
            begins.append(begin)
            ends.append(end)
            chunks += at.size
        none = np.zeros(0, dtype=np.int64)
        found.append((none.astype(np.uint64), none, none, none, none))
        self.hash, self.first, self.last, self.doc, self.chunk = (np.concatenate(x) for x in zip(*found, strict=True))
        self.begin, self.end = np.concatenate([none, *begins]), np.concatenate([none, *ends])
        ids = np.array([-1 if i is None else i for i in group.ids], dtype=np.int64)
        self.chunk_doc = np.searchsorted(group.ends, self.begin, "right") - 1
        self.owner, self.owners = ids[self.chunk_doc] if chunks else none, ids[self.doc]
        self.keys, self.key_no = np.unique((self.hash >> np.uint64(64 - KEY_BITS)).astype(np.int64), return_inverse=True)
        digest = np.frombuffer(b"".join(digests), dtype=np.uint64).reshape(-1, 2)
        order = np.lexsort((digest[:, 1], digest[:, 0]))  # stable: ids ascend
        digest = digest[order]
        new = np.concatenate([[True], (digest[1:] != digest[:-1]).any(axis=1)]) if chunks else np.zeros(0, bool)
        self.digests, self.digest_no = digest[new], np.empty(chunks, dtype=np.int64)
        self.digest_no[order] = np.cumsum(new) - 1
        self.least = self.owner[order][new]

    def edges(self, buckets: int) -> tuple[list[int], list[int]]:
        """Where the keys and the digests of each bucket begin, and the last ones end."""
        low = [-(-(t << KEY_BITS) // buckets) for t in range(buckets)]
        wide = np.array([-(-(t << 64) // buckets) for t in range(buckets)], dtype=np.uint64)
        return [*np.searchsorted(self.keys, low).tolist(), self.keys.size], [*np.searchsorted(self.digests[:, 0], wide).tolist(), self.least.size]


def group_anchors(buckets: int, length: int):
    """Step 1: a group's distinct anchors, by bucket, with the number of their
    occurrences (doubled, plus one if they are in several documents), and its
    distinct chunks with the smallest id that has them."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        s = Strings(Group(table), length)
        if not s.keys.size:
            return _messages([])
        order = np.argsort(s.key_no, kind="stable")
        count = np.bincount(s.key_no)
        start, owner = np.cumsum(count) - count, s.owners[order]
        note = 2 * count + (owner[start] != owner[start + count - 1])  # ids ascend
        anchor, chunk = s.edges(buckets)
        rows = []
        for t in range(buckets):
            k, c = slice(anchor[t], anchor[t + 1]), slice(chunk[t], chunk[t + 1])
            if k.stop > k.start or c.stop > c.start:
                rows.append((t, key[0].as_py(), pack(steps(s.keys[k]), planes(note[k]), steps(s.digests[c, 0]), s.digests[c, 1], planes(s.least[c]))))
        return _messages(rows)

    return run


def shared_anchors(frequent: int):
    """Step 1, answer of a bucket: to each group a bit for each of its anchors, set
    if it is in several documents, one for each of those, set if it is frequent,
    and one for each of its chunks, set if a smaller id than the group's has it."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        origin = table.column("origin").to_pylist()
        keys, notes, chunks, owners = [], [], [], []
        for p in table.column("payload").to_pylist():
            k, n, d0, d1, o = unpack(p, np.uint8, np.uint8, np.uint8, np.uint64, np.uint8)
            keys.append(from_steps(k))
            notes.append(from_planes(n))
            chunks.append(np.stack([from_steps(d0).view(np.uint64), d1], axis=1))
            owners.append(from_planes(o))
        _, where = np.unique(np.concatenate(keys), return_inverse=True)
        note = np.concatenate(notes)
        shared = ((np.bincount(where) > 1) | (np.bincount(where, note & 1) > 0))[where]
        often = (np.bincount(where, note >> 1) >= frequent)[where]
        digest, owner = np.concatenate(chunks), np.concatenate(owners)
        gone = np.zeros(owner.size, dtype=bool)
        if owner.size:
            order = np.lexsort((digest[:, 1], digest[:, 0]))
            digest = digest[order]
            start = np.flatnonzero(np.concatenate([[True], (digest[1:] != digest[:-1]).any(axis=1)]))
            least = np.minimum.reduceat(owner[order], start)
            gone[order] = owner[order] > np.repeat(least, np.diff(np.append(start, owner.size)))
        rows, a, c = [], 0, 0
        for o, k, d in zip(origin, keys, owners, strict=True):
            mask, mark, lost = shared[a : a + k.size], often[a : a + k.size], gone[c : c + d.size]
            a, c = a + k.size, c + d.size
            if mask.any() or lost.any():
                rows.append((o, key[0].as_py(), pack(np.packbits(mask), np.packbits(mark[mask]), np.packbits(lost))))
        return _messages(rows)

    return run


def _bits(raw: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(raw, count=n).astype(bool)


def _intervals(begin: np.ndarray, end: np.ndarray) -> bytes:
    """Places that are removed, as a message."""
    order = np.argsort(begin, kind="stable")
    return pack(steps(begin[order]), planes((end - begin)[order]))


def group_pieces(buckets: int, length: int):
    """Step 2: the distinct pieces of a group, by bucket, each with the smallest
    document id that has it, and all their occurrences (piece, place in the group;
    whether its id is a larger one). What the group loses with its chunks goes to
    ``buckets`` plus its own number."""

    def run(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        if table.num_rows == 0 or answers.num_rows == 0:
            return _messages([])
        group = Group(table)
        s = Strings(group, length)
        shared, mark, gone = np.zeros(s.keys.size, dtype=bool), np.zeros(s.keys.size, dtype=bool), np.zeros(s.least.size, dtype=bool)
        anchor, chunk = s.edges(buckets)
        for t, p in zip(answers.column("origin").to_pylist(), answers.column("payload").to_pylist(), strict=True):
            k, c = slice(anchor[t], anchor[t + 1]), slice(chunk[t], chunk[t + 1])
            several, often, lost = unpack(p, np.uint8, np.uint8, np.uint8)
            shared[k] = _bits(several, k.stop - k.start)
            mark[k][shared[k]] = _bits(often, int(shared[k].sum()))
            gone[c] = _bits(lost, c.stop - c.start)
        lost = gone[s.digest_no] | (s.owner > s.least[s.digest_no])
        rows = []
        if lost.any():
            at = np.flatnonzero(lost)
            new = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(s.chunk_doc[at]) != 0)])
            rows.append((buckets + key[0].as_py(), key[0].as_py(), _intervals(s.begin[at[new]], s.end[at[np.append(np.flatnonzero(new)[1:] - 1, at.size - 1)]])))
        hit = np.flatnonzero(shared[s.key_no] & ~lost[s.chunk])
        alone = mark[s.key_no[hit]]
        # frequent anchors: each string is a piece of its own
        single, whole = hit[alone], hit[~alone]
        n = s.last[single] - s.first[single] + 1
        string = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(s.first[single], n)
        begin, end = np.concatenate([s.first[whole], string]), np.concatenate([s.last[whole], string]) + length
        target = np.concatenate([(s.hash[whole] % np.uint64(buckets)).astype(np.int64), np.full(string.size, -1)])
        owner = np.concatenate([s.owners[whole], np.repeat(s.owners[single], n)])
        del s
        order = np.argsort(begin, kind="stable")  # so documents come in ascending order of ids
        numbers: list[dict[bytes, int]] = [{} for _ in range(buckets)]
        owners: list[list[int]] = [[] for _ in range(buckets)]
        found: list[list[int]] = [[] for _ in range(buckets)]
        for b, e, t, o in zip(*(x[order].tolist() for x in (begin, end, target, owner)), strict=True):
            piece = group.raw[b:e]
            if t < 0:
                t = int.from_bytes(hashlib.blake2b(piece, digest_size=4).digest(), "little") % buckets
            own = owners[t]
            k = numbers[t].setdefault(piece, len(own))
            if k == len(own):
                found[t] += (0, b, 0)  # a new piece
                own.append(o)
            else:
                found[t] += (len(own) - k, b, own[k] != o)
        for t in range(buckets):
            if found[t]:
                back, at, later = np.array(found[t], dtype=np.int64).reshape(-1, 3).T
                pieces = list(numbers[t])
                size = np.array([len(x) for x in pieces], dtype=np.int64)
                rows.append((t, key[0].as_py(), pack(np.frombuffer(b"".join(pieces), dtype=np.uint8), planes(size), steps(np.array(owners[t], dtype=np.int64)), planes(back), steps(at), np.packbits(later > 0), level=3)))
        return _messages(rows)

    return run


def removed_places(buckets: int, length: int):
    """Step 3: to each group (begin, size) of what is removed."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        if key[0].as_py() >= buckets:  # chunks, known before
            return _messages([(o, key[0].as_py(), p) for o, p in zip(table.column("origin").to_pylist(), table.column("payload").to_pylist(), strict=True)])
        number: dict[bytes, int] = {}
        least: list[int] = []
        messages = []
        for origin, raw in zip(table.column("origin").to_pylist(), table.column("payload").to_pylist(), strict=True):
            text, size, owner, back, at, later = unpack(raw, *[np.uint8] * 6)
            size, owner, back, at = from_planes(size), from_steps(owner), from_planes(back), from_steps(at)
            known = np.cumsum(back == 0) - (back == 0)
            data, end, classes = text.tobytes(), 0, []
            for n, o in zip(size.tolist(), owner.tolist(), strict=True):
                piece = data[end : end + n]
                end += n
                k = number.setdefault(piece, len(least))
                if k == len(least):
                    least.append(o)
                elif o < least[k]:
                    least[k] = o
                classes.append(k)
            messages.append((origin, np.array(classes, dtype=np.int64), owner, (known - back, at, _bits(later, at.size))))
        pieces, owners = list(number), np.array(least, dtype=np.int64)
        number.clear()
        sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        piece, place, smallest = smallest_owner(pieces, owners, length)
        lost = smallest < owners[piece]
        piece, place = piece[lost], place[lost]
        order = np.lexsort((place, piece))
        piece, place = piece[order], place[order]
        # runs of neighbouring strings as (piece, begin, end)
        new = np.concatenate([[True], (np.diff(piece) != 0) | (np.diff(place) != 1)]) if piece.size else np.zeros(0, bool)
        run_piece, run_begin = piece[new], place[new]
        run_end = place[np.append(np.flatnonzero(new)[1:] - 1, piece.size - 1)] + length if piece.size else run_begin
        first = np.searchsorted(run_piece, np.arange(len(pieces) + 1))
        rows = []
        for origin, classes, owner, (k, at, later) in messages:
            whole = later | (owner[k] > owners[classes[k]])
            parts = [(at[whole], at[whole] + sizes[classes[k[whole]]])]
            rest = np.flatnonzero(~whole)
            c = classes[k[rest]]
            n = first[c + 1] - first[c]
            runs = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[c], n)
            rest = np.repeat(rest, n)
            parts.append((at[rest] + run_begin[runs], at[rest] + run_end[runs]))
            begin, end = (np.concatenate(x) for x in zip(*parts, strict=True))
            if begin.size:
                rows.append((origin, key[0].as_py(), _intervals(begin, end)))
        return _messages(rows)

    return run


def _merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by intervals (touching ones are one run)."""
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], begin[1:] > reach[:-1]])
    return begin[new], reach[np.append(np.flatnonzero(new)[1:] - 1, begin.size - 1)]


def cut_group(key: tuple, table: pa.Table, places: pa.Table) -> pa.Table:
    """Step 4: what is left of each document of a group."""
    group = Group(table)
    parts = [unpack(p, np.uint8, np.uint8) for p in places.column("payload").to_pylist()]
    begin = np.concatenate([np.zeros(0, np.int64), *(from_steps(b) for b, _ in parts)])
    size = np.concatenate([np.zeros(0, np.int64), *(from_planes(n) for _, n in parts)])
    order = np.argsort(begin, kind="stable")
    begin, size = begin[order], size[order]
    edge, ends = np.searchsorted(begin, group.ends).tolist(), group.ends.tolist()
    removed, spans, digests, lists = [], [], [], []
    for i, (low, high) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
        raw = kept = group.raw[low:high]
        a = b = np.zeros(0, np.int64)
        if edge[i + 1] > edge[i]:
            here = slice(edge[i], edge[i + 1])
            a, b = _merged(begin[here] - low, begin[here] - low + size[here])
            kept = b"".join(raw[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(raw)], strict=True))
        removed.append(len(raw) - len(kept))
        spans.append(a.size)
        digests.append(hashlib.sha256(kept).hexdigest())
        lists.append(np.stack([a, b], axis=1).ravel())
    columns = [group.ids, np.diff(group.ends), removed, spans, digests, lists]
    return pa.table([pa.array(c, type=f.type) for c, f in zip(columns, _OUT_ARROW, strict=True)], schema=_OUT_ARROW)


def repeated_spans(docs: DataFrame, length: int = LENGTH, frequent: int = FREQUENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes (UTF-8), n_removed, n_spans
    (maximal removed runs), kept_sha256 (of the remaining bytes), spans (begin and
    end of each removed run, in bytes, one after the other).

    A byte is removed if a ``length``-byte string over it also starts in a row with
    a smaller id; strings are judged on the input. Null and empty texts and texts
    shorter than ``length`` lose nothing. Rows with a null id lose nothing and take
    nothing from others; rows with equal ids do not remove each other. An empty
    table gives an empty result; extra columns are not read. ``length`` is at
    least the 20 bytes of an anchor.
    """
    rows, groups = dealt(texts_of(docs, id_col, text_col))
    buckets = 2 * groups
    grouped = rows.select("doc_id", "text", "grp").mapInArrow(packed_texts, "grp int, payload binary").groupBy("grp")
    seen = grouped.applyInArrow(group_anchors(buckets, length), _MESSAGE)
    shared = seen.groupBy("target").applyInArrow(shared_anchors(frequent), _MESSAGE)
    pieces = grouped.cogroup(shared.groupBy("target")).applyInArrow(group_pieces(buckets, length), _MESSAGE)
    places = pieces.groupBy("target").applyInArrow(removed_places(buckets, length), _MESSAGE)
    return grouped.cogroup(places.groupBy("target")).applyInArrow(cut_group, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>")
