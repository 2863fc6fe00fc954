"""Byte-level BPE by a rank file, through a sentencepiece model (operator 12).

A sentencepiece BPE model is serialised straight from the vocabulary: each
token's bytes as letters of the byte-level alphabet, scored by its negative
rank, identity normalisation, no prefix and no white-space rules. Of all
neighbouring symbols whose union is a piece, sentencepiece merges the pair with
the best score, the leftmost of equals; with these scores that is the lowest
rank first, the merge rule of rank files. Ids are the ranks; the unknown piece,
which the format demands, follows the last rank and is never met, because every
byte must be a token. A rank encoder takes a pre-token that is itself a token
without merging: tokens that their own merges would not rebuild are found once
when the model is loaded, and looked up.

Texts are cut at lone spaces and newlines, where the pattern always starts a
new match, and each distinct chunk is split by the pattern and encoded once
(``subwords``). Decoding maps an id's letters back to bytes. Everything runs
beside the scan: no shuffle, nothing gathered.
"""

from __future__ import annotations

import base64
import functools
import re
import struct
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from inforce.llm.common import batch_of, bound_batches, text_pieces, texts_of
from inforce.llm.subwords import _BYTES, Encoder, byte_level_chunks, encoder, gather_runs

#: Ids and characters that the table of chunks keeps before it starts anew.
TABLE_IDS, TABLE_CHARS = 4_000_000, 24_000_000
#: Characters of the parts in which a long text is encoded.
PART_CHARS = 1_000_000

#: Letter of each byte, and back. Printable bytes stand for themselves.
LETTERS = [_BYTES.get(b, chr(b)) for b in range(256)]
BYTE_OF = {letter: b for b, letter in enumerate(LETTERS)}

_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])


# ----------------------------------------------------------------------------- protocol buffer wire format
def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1  # negative numbers take ten bytes
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def number_field(no: int, value: int) -> bytes:
    return _varint(no << 3) + _varint(value)


def bytes_field(no: int, value: bytes) -> bytes:
    return _varint(no << 3 | 2) + _varint(len(value)) + value


def float_field(no: int, value: float) -> bytes:
    return _varint(no << 3 | 5) + struct.pack("<f", value)


def read_fields(data: bytes):
    """(field number, value) of a serialised message, in order: numbers as int,
    everything else as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        n = shift = 0
        while True:
            b = data[at]
            at += 1
            n |= (b & 127) << shift
            shift += 7
            if b < 128:
                return n

    while at < len(data):
        no, kind = divmod(varint(), 8)
        if kind == 0:
            yield no, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        size = varint() if size is None else size
        yield no, data[at : at + size]
        at += size


def serialised_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model of ``tokens`` in the order of their ranks."""
    normal, unknown, bpe = 1, 2, 2
    pieces = [bytes_field(1, "".join(map(LETTERS.__getitem__, t)).encode()) + float_field(2, -float(rank)) + number_field(3, normal) for rank, t in enumerate(tokens)]
    pieces.append(bytes_field(1, b"<unk>") + float_field(2, 0.0) + number_field(3, unknown))
    unk = number_field(40, len(tokens))
    none = number_field(41, -1) + number_field(42, -1) + number_field(43, -1)
    trainer = number_field(3, bpe) + number_field(4, len(pieces)) + unk + none + bytes_field(45, b"<unk>")
    normalizer = bytes_field(1, b"identity") + bytes_field(2, b"") + number_field(3, 0) + number_field(4, 0) + number_field(5, 0)
    return b"".join(bytes_field(1, p) for p in pieces) + bytes_field(2, trainer) + bytes_field(3, normalizer)


# ----------------------------------------------------------------------------- vocabulary
def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file by rank. Ranks must run from 0 without gaps, stay
    below 2^24 (scores are 32-bit floats) and hold every single byte."""
    with open(path, "rb") as f:
        ranks = {int(rank): base64.b64decode(token) for token, rank in (line.split() for line in f if line.strip())}
    if sorted(ranks) != list(range(len(ranks))) or len(ranks) >= 1 << 24:
        raise ValueError(f"{path}: ranks must run from 0 without gaps, below 2^24")
    tokens = [ranks[i] for i in range(len(ranks))]
    if len({*tokens}) != len(tokens) or not {bytes([b]) for b in range(256)} <= {*tokens}:
        raise ValueError(f"{path}: tokens must be distinct and hold every single byte")
    return tokens


class Vocabulary:
    """The serialised model of a rank file, and the inverse mapping of its ids."""

    def __init__(self, path: str):
        import sentencepiece

        tokens = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialised_model(tokens))
        letters = [self.model.id_to_piece(i) for i in range(len(tokens))]
        back = [bytes(map(BYTE_OF.__getitem__, p)) for p in letters]
        self.bytes = np.frombuffer(b"".join(back), dtype=np.uint8)
        self.at = np.concatenate([[0], np.cumsum([len(b) for b in back])]).astype(np.int64)
        self.whole = {p: i for i, (p, got) in enumerate(zip(letters, self.model.encode(letters, num_threads=1), strict=True)) if got != [i]}

    def encode_letters(self, words: list[str]) -> list[list[int]]:
        got = self.model.encode(words, num_threads=1)
        if self.whole:
            got = [[self.whole[w]] if w in self.whole else g for w, g in zip(words, got, strict=True)]
        return got

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids in turn, and where each id's bytes end (0 first).
        An id outside the vocabulary is an error."""
        if ids.size and (ids.min() < 0 or ids.max() >= self.at.size - 1):
            raise ValueError("id outside the vocabulary")
        return gather_runs(self.bytes, self.at[ids], self.at[ids + 1])


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def to_letters(text: str) -> str:
    return text.replace(" ", LETTERS[32]) if text.isascii() and text.isprintable() else "".join(map(LETTERS.__getitem__, text.encode()))


class BoundedEncoder(Encoder):
    """An encoder whose table is bounded by ids and characters too."""

    def __init__(self, table_chunks: int):
        self.most = table_chunks
        self._reset()

    def _reset(self) -> None:
        super()._reset()
        self.chars = 0

    def full(self) -> bool:
        return self.used > TABLE_IDS or self.chars > TABLE_CHARS

    def _lookup(self, chunks: list[str]) -> np.ndarray:
        if self.full():
            self._reset()
        return super()._lookup(chunks)

    def _learn(self, chunks: list[str]) -> None:
        self.chars += sum(map(len, chunks))
        lists = self._encode(chunks)
        n = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        self._append(np.fromiter(chain.from_iterable(lists), dtype=np.uint32, count=int(n.sum())), n)

    def _encode(self, chunks: list[str]) -> list[list[int]]:
        raise NotImplementedError


class RankEncoder(BoundedEncoder):
    """Ids by the ranks: every match of the pattern is encoded on its own."""

    def __init__(self, path: str, pattern: str):
        import public_tokenizers
        import regex

        self.vocabulary = vocabulary(path)
        # the cuts are proven for this pattern only; others see texts whole
        self.cut = byte_level_chunks if pattern == public_tokenizers.PATTERN else lambda text: [text] if text else []
        self.split = regex.compile(pattern).findall
        super().__init__(400_000)

    def _encode(self, chunks: list[str]) -> list[list[int]]:
        words: dict[str, int] = {}
        code, n = array("q"), []
        for chunk in chunks:
            found = self.split(chunk)
            n.append(len(found))
            code.extend([words.setdefault(w, len(words)) for w in found])
        lists = self.vocabulary.encode_letters([to_letters(w) for w in words])
        at, out = 0, []
        for k in n:
            out.append(lists[code[at]] if k == 1 else [i for c in code[at : at + k] for i in lists[c]])
            at += k
        return out


_LONE_SPACE = re.compile(r"(?<=\S)(?= \S)")


def text_parts(text: str, most: int = PART_CHARS):
    """Parts of a long text, cut where the pattern starts a new match; they join
    to the text. A stretch without such a place stays whole."""
    at = 0
    while len(text) - at > most:
        found = _LONE_SPACE.search(text, at + most)
        if found is None:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


# ----------------------------------------------------------------------------- operators
def encode_texts(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) per input row: the ids that a rank encoder without
    special tokens gives the whole text.

    Null or empty text: no ids. Null ids and repeated rows stay as they are, an
    empty table gives an empty result, other columns are not read. Strings of
    special tokens are ordinary text. The pattern must match every character.
    """

    def encode(batches):
        enc = encoder(ranks_path, pattern, kind=RankEncoder)
        cut = text_parts if enc.cut is byte_level_chunks else lambda text: [text]
        for ids, texts in text_pieces(batches):
            parts, owner = [], []
            for i, t in enumerate(texts):
                mine = list(cut(t))
                parts += mine
                owner += [i] * len(mine)
            flat, n = zip(*enc.encode_blocks(parts), strict=True)
            total = np.bincount(owner, weights=np.concatenate(n), minlength=len(texts)).astype(np.int64)
            values = pa.array(np.concatenate(flat).astype(np.int32))
            yield batch_of(_ENCODED, doc_id=ids, ids=pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(total)]).astype(np.int32)), values))

    return texts_of(docs, id_col, text_col).mapInArrow(encode, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, ranks_path: str, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """Adds the bytes of each row's ids (null ids: null; no ids: no bytes). All
    other columns are kept; ``into`` takes the place of ``ids_col``. A null inside
    a list, or an id outside the vocabulary, is an error: it has no bytes."""
    bound_batches(encoded.sparkSession)
    kept = [f for f in encoded.schema.fields if f.name not in (ids_col, into)]
    schema = StructType([*kept, StructField(into, BinaryType())])

    def decode(batches):
        words = vocabulary(ranks_path)
        for b in batches:
            col = b.column(0)
            if col.values.null_count:
                raise ValueError("null among ids")
            at = np.concatenate([[0], np.cumsum(col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
            raw, ends = words.decode(col.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
            raw, cuts = raw.tobytes(), ends[at]
            values = [raw[i:j] if ok else None for i, j, ok in zip(cuts[:-1].tolist(), cuts[1:].tolist(), col.is_valid().to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(values, pa.binary())], names=[*(f.name for f in kept), into])

    return encoded.select(F.col(ids_col).cast("array<int>").alias(ids_col), *(F.col(f"`{f.name}`") for f in kept)).mapInArrow(decode, schema)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Digests of the encoded and again decoded texts: doc_id, n_tokens, ids_sha256
    (of the decimal ids, joined by one space), decoded_sha256."""
    encoded = encode_texts(docs, ranks_path, pattern).withColumn("n_tokens", F.size("ids").cast("long")).withColumn("ids_sha256", F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256))
    return decode_ids(encoded, ranks_path).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
