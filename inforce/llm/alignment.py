"""Cross-tokenizer alignment by lockstep merging (operator 11).

Both tokenizers cut the same bytes (a space, then the text). All documents of a
batch are merged at once: one pair of NumPy state vectors holds each document's
A and B pointer; a step emits the pair of tokens that every document stands at
(a link), emits a cut where both tokens end at the same byte, advances the
pointer whose token ends first (both at a cut), and drops finished documents
from the vectors. Long documents enter as several lanes, parted at places where
a token of each side ends, so a batch's number of steps follows the length of a
lane and not of its longest document.

Cuts part the tokens into groups, and all A-B pairs of a group are linked. With
one token on a side the steps have visited every pair; where both sides have
several, the pairs are counted from the group's id histograms, so no list of
token pairs is made for a long group.

How many documents hold an id pair is counted over the whole corpus: documents
lie in blocks of bounded size, a block states its distinct pairs once with
their number of documents, Spark sums them, and each block gets one answer per
distinct pair it holds. No table of all pairs is collected or broadcast.
"""

from __future__ import annotations

import hashlib
import os
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inforce.llm.common import text_pieces, texts_of, written
from inforce.llm.rank_bpe import BYTE_OF, BoundedEncoder, read_fields
from inforce.llm.subwords import Encoder, byte_level_chunks, chunk_rule, encoder, gather_runs

#: Characters of the texts in a block, and A tokens of a lane.
BLOCK_CHARS, LANE_TOKENS = 1_200_000, 2048
#: Bytes searched for a common end where a long document is parted.
LANE_WINDOW = 512
#: Token pairs of a group up to which they are listed, not counted from histograms.
LISTED_PAIRS = 4096
#: Distinct pairs in one row of the table that is summed.
PAIRS_PER_ROW = 500_000
#: Chunks kept per process, with their ids on both sides.
TABLE_CHUNKS = 500_000


# ----------------------------------------------------------------------------- the two tokenizers
class PlainEncoder(BoundedEncoder):
    """Ids of a ``tokenizers`` file; strings of special tokens are ordinary text."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.tok.encode_special_tokens = True
        if chunk_rule(self.tok) is not byte_level_chunks:
            raise ValueError(f"{path}: not a byte-level tokenizer with the usual pattern")
        self.cut, self.model, self.lower = byte_level_chunks, self.tok.model, False
        vocabulary = self.tok.get_vocab(with_added_tokens=True)
        special = {t.content for t in self.tok.get_added_tokens_decoder().values()}
        back = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            back[i] = token.encode() if token in special else bytes(map(BYTE_OF.__getitem__, token))
        self.bytes, self.bytes_at = _byte_table(back)
        super().__init__(TABLE_CHUNKS)

    def _learn(self, chunks: list[str]) -> None:
        self.chars += sum(map(len, chunks))
        Encoder._learn(self, chunks)  # words straight through the model, all else through the tokenizer


class PieceEncoder(BoundedEncoder):
    """Ids of a sentencepiece model for texts that already begin with the space
    that the model would add (the prefix is switched off in the loaded copy).

    Chunks are encoded on their own where that cannot change the ids: the
    normalisation is the identity, no piece holds a space after another
    character, and none holds a newline beside another character, so no merge
    reaches over a cut. Otherwise texts are encoded whole."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            data = f.read()
        # a later field overrides an earlier one: normaliser without prefix
        self.model = model = sentencepiece.SentencePieceProcessor(model_proto=data + bytes([0x1A, 2, 0x18, 0]))
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        back = [bytes([int(p[3:-1], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.bytes, self.bytes_at = _byte_table(back)
        normaliser: dict[int, object] = {}
        for no, value in read_fields(data):
            if no == 3:
                normaliser.update(read_fields(value))
        if not normaliser.get(3, 1):
            raise ValueError(f"{path}: the model adds no space of its own")
        identity = not normaliser.get(2, b"") and not normaliser.get(4, 1) and normaliser.get(5, 1)
        free = all("▁" not in p.lstrip("▁") and (len(p) == 1 or "\n" not in p) for p in pieces)
        self.cut = byte_level_chunks if identity and free else lambda text: [text]
        super().__init__(TABLE_CHUNKS)

    def _encode(self, chunks: list[str]) -> list[list[int]]:
        return self.model.encode(chunks, num_threads=1)


def _byte_table(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(tokens), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)


class PairEncoder:
    """Both encoders of a process, over one table of chunks."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = PlainEncoder(a_path), PieceEncoder(b_path)
        self.digits = _digit_table(len(self.a.bytes_at) - 1, ",|"), _digit_table(len(self.b.bytes_at) - 1, ",;")
        self.at = self.a.at

    def _side_ids(self, spaced: list[str]):
        """(A ids, A tokens of each text, B ids, B tokens of each text)."""
        if self.b.cut is not byte_level_chunks:  # no common chunks
            for side in (self.a, self.b):
                ids, n = zip(*side.encode_blocks(spaced), strict=True)
                yield from (np.concatenate(ids), np.concatenate(n))
            return
        if len(self.at) > TABLE_CHUNKS or self.a.full() or self.b.full():
            self.a._reset()
            self.b._reset()
            self.at = self.a.at
        cut = [byte_level_chunks(t) for t in spaced]
        n = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
        code = np.fromiter(map(self.at.__getitem__, chain.from_iterable(cut)), dtype=np.int64, count=int(n.sum()))
        del cut
        new, self.at.new = self.at.new, []
        self.b.at = self.at
        at = np.concatenate([[0], np.cumsum(n)])
        for side in (self.a, self.b):
            if new:
                side._learn(new)
            ids, ends = gather_runs(side.ids, side.start[code], side.start[code + 1])
            yield from (ids, np.diff(ends[at]))

    def encode(self, texts: list[str]):
        """(A ids, B ids, A and B tokens of each text) of space + text. A text has
        no tokens if it is empty or one side's bytes differ from it."""
        spaced = [" " + t for t in texts]
        same = np.array([len(t) > 0 for t in texts])
        raw = [t.encode() for t in spaced]
        expected, size = np.frombuffer(b"".join(raw), dtype=np.uint8), np.array([len(r) for r in raw], dtype=np.int64)
        del raw
        a, n_a, b, n_b = self._side_ids(spaced)
        sides = [(a, n_a), (b, n_b)]
        for side, (ids, n) in zip((self.a, self.b), sides, strict=True):
            got, ends = gather_runs(side.bytes, side.bytes_at[ids], side.bytes_at[ids + np.uint32(1)])
            at = np.concatenate([[0], np.cumsum(n)])
            start, have = ends[at[:-1]], np.diff(ends[at])
            same &= have == size
            if got.size == expected.size and (have == size).all():
                wrong = got != expected
                if wrong.any():
                    same &= np.add.reduceat(wrong, start, dtype=np.int64) == 0
            else:
                where = np.concatenate([[0], np.cumsum(size)])
                for d in np.flatnonzero(have == size).tolist():
                    if not np.array_equal(got[start[d] : start[d] + size[d]], expected[where[d] : where[d + 1]]):
                        same[d] = False
        out = []
        for ids, n in sides:
            if not same.all():
                ids, n = ids[np.repeat(same, n)], np.where(same, n, 0)
            out += [ids.astype(np.int64), n]
        return out[0], out[2], out[1], out[3]

    def ends(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte offset of every token's end, counted over all documents in turn."""
        return tuple(np.cumsum(s.bytes_at[ids + 1] - s.bytes_at[ids]) for s, ids in ((self.a, a), (self.b, b)))


# ----------------------------------------------------------------------------- lockstep merging
def lanes(end_a: np.ndarray, end_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, most: int = LANE_TOKENS) -> tuple[np.ndarray, ...]:
    """First and last-plus-one A and B token of every lane. Documents of more than
    ``most`` A tokens are parted where both sides end within a window; where the
    window holds no common end, the lane goes on."""
    at_a, at_b = np.concatenate([[0], np.cumsum(n_a)]), np.concatenate([[0], np.cumsum(n_b)])
    live = np.flatnonzero(n_a > 0)
    start_a, start_b = [at_a[live]], [at_b[live]]
    for d in live[n_a[live] > most].tolist():
        last = at_a[d]
        for goal in range(int(at_a[d]) + most, int(at_a[d + 1]) - 1, most):
            if goal <= last:
                continue
            lo = end_a[goal]
            own = end_a[goal : min(goal + LANE_WINDOW, at_a[d + 1] - 1)]
            first_b = int(np.searchsorted(end_b, lo))
            other = end_b[first_b : min(first_b + LANE_WINDOW, at_b[d + 1] - 1)]
            _, i, j = np.intersect1d(own, other, assume_unique=True, return_indices=True)
            if i.size:
                last = goal + int(i[0]) + 1
                start_a.append(np.array([last]))
                start_b.append(np.array([first_b + int(j[0]) + 1]))
    start_a, start_b = np.sort(np.concatenate(start_a)), np.sort(np.concatenate(start_b))
    return start_a, np.concatenate([start_a[1:], at_a[-1:]]), start_b, np.concatenate([start_b[1:], at_b[-1:]])


def lockstep(end_a: np.ndarray, end_b: np.ndarray, first_a: np.ndarray, stop_a: np.ndarray, first_b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Links (A token, B token) and cuts (A and B tokens before each), of all
    lanes at once. Every lane must end with a common end of both sides."""
    i, j, stop = first_a, first_b, stop_a
    links, cuts = [], []
    while i.size:
        x, y = end_a[i], end_b[j]
        links.append((i, j))
        cut = x == y
        if cut.any():
            cuts.append((i[cut] + 1, j[cut] + 1))
        i, j = i + (x <= y), j + (y <= x)
        live = i < stop
        if not live.all():
            i, j, stop = i[live], j[live], stop[live]
    none = np.zeros(0, dtype=np.int64)
    a, b = (np.concatenate([p[k] for p in links]) if links else none for k in (0, 1))
    ca, cb = (np.sort(np.concatenate([p[k] for p in cuts])) if cuts else none for k in (0, 1))
    return a, b, ca, cb


def _digit_table(n: int, marks: str) -> np.ndarray:
    """Decimal id and mark, for row ``2 id`` with the first mark and the next row with the last."""
    return np.array([f"{i}{m}".encode() for i in range(n) for m in marks])


def group_texts(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, digits: tuple[np.ndarray, np.ndarray]) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;`` of all groups in turn, and where each group's text ends."""
    n_a, n_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
    last_a, last_b = np.zeros(a.size, dtype=np.int64), np.zeros(b.size, dtype=np.int64)
    last_a[cut_a - 1] = last_b[cut_b - 1] = 1
    # group by group: its A tokens, then its B tokens
    place_a = np.arange(a.size) + np.repeat(cut_b - n_b, n_a)
    place_b = np.arange(b.size) + np.repeat(cut_a, n_b)
    width = max(digits[0].itemsize, digits[1].itemsize)
    text = np.zeros(a.size + b.size, dtype=f"S{width}")
    text[place_a] = digits[0][2 * a + last_a]
    text[place_b] = digits[1][2 * b + last_b]
    raw = text.view(np.uint8).reshape(-1, width)
    shown = raw != 0
    ends = np.cumsum(shown.sum(axis=1))
    return raw[shown].tobytes(), ends[cut_a + cut_b - 1]


class Alignment:
    """The groups and links of a block's documents."""

    def __init__(self, pair: PairEncoder, texts: list[str], lane_tokens: int = LANE_TOKENS):
        self.a, self.b, self.n_a, self.n_b = pair.encode(texts)
        end_a, end_b = pair.ends(self.a, self.b)
        first_a, stop_a, first_b, _ = lanes(end_a, end_b, self.n_a, self.n_b, lane_tokens)
        self.at_a = np.concatenate([[0], np.cumsum(self.n_a)])
        self.link_a, self.link_b, self.cut_a, self.cut_b = lockstep(end_a, end_b, first_a, stop_a, first_b)
        self.size_a, self.size_b = np.diff(self.cut_a, prepend=0), np.diff(self.cut_b, prepend=0)
        #: groups before each document
        self.at_group = np.searchsorted(self.cut_a, self.at_a, side="right")
        self.at_group[0] = 0
        self.pair = pair

    def links_of_documents(self) -> np.ndarray:
        ends = np.concatenate([[0], np.cumsum(self.size_a * self.size_b)])
        return np.diff(ends[self.at_group])

    def digests(self) -> list[str]:
        """Digest of each document's groups ('' without tokens)."""
        if not self.cut_a.size:
            return [""] * len(self.n_a)
        raw, ends = group_texts(self.a, self.b, self.cut_a, self.cut_b, self.pair.digits)
        ends = np.concatenate([[0], ends])[self.at_group].tolist()
        view = memoryview(raw)
        return [hashlib.sha256(view[i : j - 1]).hexdigest() if j > i else "" for i, j in zip(ends[:-1], ends[1:], strict=True)]

    def weighted_links(self):
        """Portions of (document, A id, B id, number of links; None: one each)."""
        several = (self.size_a > 1) & (self.size_b > 1)
        group = np.searchsorted(self.cut_a, self.link_a, side="right")
        doc_of = np.repeat(np.arange(len(self.n_a)), np.diff(self.at_group))
        plain = ~several[group]
        yield doc_of[group[plain]], self.a[self.link_a[plain]], self.b[self.link_b[plain]], None
        pairs = self.size_a * self.size_b
        start_a, start_b = self.cut_a - self.size_a, self.cut_b - self.size_b
        listed = np.flatnonzero(several & (pairs <= LISTED_PAIRS))
        for part in np.array_split(listed, max(1, int(pairs[listed].sum()) // 2_000_000)):
            if part.size:
                n = pairs[part]
                k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                wide = np.repeat(self.size_b[part], n)
                yield np.repeat(doc_of[part], n), self.a[np.repeat(start_a[part], n) + k // wide], self.b[np.repeat(start_b[part], n) + k % wide], None
        for g in np.flatnonzero(several & (pairs > LISTED_PAIRS)).tolist():
            a, n_a = np.unique(self.a[start_a[g] : self.cut_a[g]], return_counts=True)
            b, n_b = np.unique(self.b[start_b[g] : self.cut_b[g]], return_counts=True)
            rows = max(1, 2_000_000 // b.size)
            for i in range(0, a.size, rows):
                m = a[i : i + rows].size
                yield np.full(m * b.size, doc_of[g]), np.repeat(a[i : i + rows], b.size), np.tile(b, m), np.multiply.outer(n_a[i : i + rows], n_b).ravel()

    def document_pairs(self, n_b_ids: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct id pairs of the block (A id * n_b_ids + B id, ascending), and for
        each document's distinct pairs, document after document: document,
        index among the block's pairs, number of links."""
        width = (len(self.pair.a.bytes_at) - 1) * n_b_ids
        if len(self.n_a) * width >= 2**63:
            raise ValueError("too many documents in a block for these vocabularies")
        keys, counts = [], []
        for doc, a, b, n in self.weighted_links():
            key = doc * width + a * n_b_ids + b
            if n is None:  # one link each
                key.sort()
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if key.size else np.zeros(0, dtype=np.int64)
                keys.append(key[first])
                counts.append(np.diff(np.append(first, key.size)))
            else:
                keys.append(key)
                counts.append(n)
        key, n = keys[0], counts[0]
        if len(keys) > 1:
            key, n = np.concatenate(keys), np.concatenate(counts)
            order = np.argsort(key, kind="stable")
            key, n = key[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if key.size else np.zeros(0, dtype=np.int64)
            key, n = key[first], np.add.reduceat(n, first) if first.size else n
        doc, key = np.divmod(key, width)
        pairs, code = np.unique(key, return_inverse=True)
        return pairs, doc, code, n


# ----------------------------------------------------------------------------- operators
_ALIGNED = pa.schema([("doc_id", pa.int64()), ("a_ids", pa.list_(pa.int32())), ("b_ids", pa.list_(pa.int32())), ("a_cuts", pa.list_(pa.int32())), ("b_cuts", pa.list_(pa.int32()))])


def _list_array(values: np.ndarray, n: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(values.astype(np.int32)))


def aligned_tokens(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: doc_id, the ids of both sides, and for each group how many
    A and B tokens lie before its end (a_cuts, b_cuts). Rows without tokens (null
    or empty text, or bytes that a tokenizer does not give back) have empty
    lists. Nothing is shuffled."""

    def align(batches):
        pair = encoder(a_path, b_path, kind=PairEncoder)
        for ids, texts in text_pieces(batches):
            got = Alignment(pair, texts)
            groups = np.diff(got.at_group)
            before_a, before_b = np.repeat(got.at_a[:-1], groups), np.repeat(np.cumsum(got.n_b) - got.n_b, groups)
            yield pa.RecordBatch.from_arrays([pa.array(ids), _list_array(got.a, got.n_a), _list_array(got.b, got.n_b), _list_array(got.cut_a - before_a, groups), _list_array(got.cut_b - before_b, groups)], schema=_ALIGNED)

    return texts_of(docs, id_col, text_col).mapInArrow(align, "doc_id long, a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>")


_STORED = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes binary, links binary, first_pair long, a array<int>, b array<int>, docs array<int>"
_STORED_ARROW = pa.schema(
    [("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("codes", pa.binary()), ("links", pa.binary())]
    + [("first_pair", pa.int64())]
    + [(c, pa.list_(pa.int32())) for c in ("a", "b", "docs")]
)
_COUNTED = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())])


def _blocks(batches, most: int):
    """(ids, texts) of about ``most`` characters; a longer text is a block of its own."""
    held_ids, held, chars = [], [], 0
    for ids, texts in text_pieces(batches):
        held_ids.append(ids)
        held += texts
        chars += sum(map(len, texts))
        if chars >= most:
            yield pa.chunked_array(held_ids).combine_chunks(), held
            held_ids, held, chars = [], [], 0
    if held:
        yield pa.chunked_array(held_ids).combine_chunks(), held


def stored_alignment(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The written table behind ``alignment_counts``: a row per document with its
    figures, the distinct pairs it links (as places in its block's list) and how
    often; and the block's distinct pairs with their number of documents."""

    def align(batches):
        pair, task = encoder(a_path, b_path, kind=PairEncoder), TaskContext.get().partitionId()
        n_b_ids = len(pair.b.bytes_at) - 1
        for no, (ids, texts) in enumerate(_blocks(batches, block_chars)):
            block, got = (task << 32) + no, Alignment(pair, texts)
            pairs, doc, code, n = got.document_pairs(n_b_ids)
            edge = np.searchsorted(doc, np.arange(len(texts) + 1)).tolist()
            code = code.astype("<i4")
            # within a document places ascend: the differences are small
            step = np.diff(code, prepend=0).astype("<i4")
            starts = np.array(edge[:-1])[np.diff(edge) > 0]
            step[starts] = code[starts]
            count = len(texts)
            columns = {
                "block": np.full(count, block), "doc_id": ids, "n_a": got.n_a, "n_b": got.n_b, "n_groups": np.diff(got.at_group), "n_links": got.links_of_documents(), "groups_sha256": got.digests(),
                "codes": [step[i:j].tobytes() for i, j in zip(edge[:-1], edge[1:], strict=True)], "links": [_narrow(n[i:j]) for i, j in zip(edge[:-1], edge[1:], strict=True)],
            }
            rows = iter(range(count))
            while part := list(islice(rows, 500)):
                cut = slice(part[0], part[-1] + 1)
                yield _stored({k: v[cut] for k, v in columns.items()}, len(part))
            holding = np.bincount(code, minlength=pairs.size)
            for i in range(0, pairs.size, PAIRS_PER_ROW):
                cut = slice(i, i + PAIRS_PER_ROW)
                a, b = np.divmod(pairs[cut], n_b_ids)
                yield _stored({"block": [block], "first_pair": [i], "a": [a.astype(np.int32)], "b": [b.astype(np.int32)], "docs": [holding[cut].astype(np.int32)]}, 1)

    return written(texts_of(docs, id_col, text_col).mapInArrow(align, _STORED), "aligned")


def _narrow(n: np.ndarray) -> bytes:
    """Counts in the least number of bytes each that holds the largest."""
    most = int(n.max(initial=0))
    return n.astype("<u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u8").tobytes()


def _wide(raw, count: int) -> np.ndarray:
    return np.frombuffer(raw, dtype=f"<u{len(raw) // count if count else 8}").astype(np.int64)


def _stored(columns: dict, rows: int) -> pa.RecordBatch:
    arrays = [pa.nulls(rows, f.type) if f.name not in columns else columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], type=f.type) for f in _STORED_ARROW]
    return pa.RecordBatch.from_arrays(arrays, schema=_STORED_ARROW)


def pair_statistics(stored: DataFrame) -> DataFrame:
    """(a, b, count, best): how many documents of the corpus hold a linked id
    pair, and whether that is the most of all pairs of its A id (ties included)."""
    held = _held_pairs(stored)
    counts = written(held.groupBy("a", "b").agg(F.sum("docs").alias("count")), "pair-counts")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def _held_pairs(stored: DataFrame) -> DataFrame:
    rows = stored.filter(F.col("first_pair").isNotNull()).select("block", "first_pair", F.posexplode(F.arrays_zip("a", "b", "docs")).alias("at", "pair"))
    return rows.select("block", (F.col("first_pair") + F.col("at")).alias("code"), "pair.a", "pair.b", "pair.docs")


def alignment_counts(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per input row: doc_id, n_a, n_b (tokens of each side), n_groups, n_links,
    n_best (links whose pair no other pair of the same A id exceeds in number of
    documents), count_sum (of the documents of every link's pair), groups_sha256.

    A row counts as a document: repeated rows and rows with a null id do too.
    Rows without tokens have zeros and '' (see ``aligned_tokens``). An empty table
    gives an empty result; other columns are not read. The alignment is written
    when this is called; the rest is lazy.
    """
    stored = stored_alignment(docs, a_path, b_path, id_col, text_col, block_chars)
    asked = _held_pairs(stored).select(F.col("block").alias("asking"), "code", "a", "b")
    answers = asked.join(pair_statistics(stored), ["a", "b"]).select("asking", "code", "count", "best")
    figures = stored.filter(F.col("n_a").isNotNull()).select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "codes", "links")

    def look_up(rows: pa.Table, found: pa.Table) -> pa.Table:
        n = found.num_rows
        count, best = np.zeros(n + 1, dtype=np.int64), np.zeros(n + 1, dtype=np.int64)
        code = found.column("code").to_numpy()
        count[code], best[code] = found.column("count").to_numpy(), found.column("best").to_numpy().astype(np.int64)
        n_best, count_sum = [], []
        for steps, links in zip(rows.column("codes"), rows.column("links"), strict=True):
            at = np.cumsum(np.frombuffer(steps.as_buffer(), dtype="<i4"), dtype=np.int64)
            times = _wide(links.as_buffer(), at.size)
            n_best.append(int(times @ best[at]))
            count_sum.append(int(times @ count[at]))
        return pa.Table.from_arrays([rows.column(f.name) if f.name in rows.column_names else pa.chunked_array([pa.array({"n_best": n_best, "count_sum": count_sum}[f.name], pa.int64())]) for f in _COUNTED], schema=_COUNTED)

    return figures.groupBy("block").cogroup(answers.groupBy("asking")).applyInArrow(look_up, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
