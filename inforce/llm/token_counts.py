"""Token counts by overlap resynchronisation (operator 3).

A huge document is encoded in overlapping chunks, with offsets. Two
neighbouring chunks are spliced at a common boundary that is *proven* stable:
both encodings start a token there, and the character there is a lone space
between two characters that are not white space. The byte-level pattern starts
a pre-token at such a place whatever surrounds it, pre-tokens are encoded
independently, and no special string holds a space; so tokens before it do not
depend on what follows, nor tokens after it on what came before. When an
overlap holds no such boundary, it is doubled and the left chunk encoded
again, up to the whole rest of the text: the count is always exact.

Shorter texts are encoded whole, word by word from a table (``subwords``).
Everything happens beside the scan: no shuffle, nothing gathered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from inforce.llm.common import batch_of, text_pieces, texts_of
from inforce.llm.subwords import byte_level_chunks, encoder

#: Characters of a chunk, of the first overlap, and from which on a document is split.
CHUNK_CHARS = 32_768
OVERLAP_CHARS = 256

_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("n_chunks", pa.int32()), ("n_widened", pa.int32())])


def stable_boundary(text: str, left, left_at: int, right, right_at: int, lo: int, hi: int) -> tuple[int, int, int] | None:
    """The first place in [lo, hi) where two encodings may be spliced, as
    (character, token of ``left``, token of ``right``); None if there is none.
    ``left_at`` / ``right_at``: where their chunks begin in ``text``."""
    at = text.find(" ", lo, hi)
    while at >= 0:
        if at > 0 and at + 1 < len(text) and not text[at - 1].isspace() and not text[at + 1].isspace():
            i, j = left.char_to_token(at - left_at), right.char_to_token(at - right_at)
            if i is not None and j is not None and left.token_to_chars(i)[0] == at - left_at and right.token_to_chars(j)[0] == at - right_at:
                return at, i, j
        at = text.find(" ", at + 1, hi)
    return None


def spliced_ids(tok, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> Iterator[tuple[list[int], int]]:
    """Yields (ids, number of widenings) piece by piece; the ids of all pieces
    are those of the whole text. One or two chunks are in memory at a time."""
    begin, skip = 0, 0
    left_end = min(len(text), chunk)
    left = tok.encode(text[:left_end], add_special_tokens=False)
    while left_end < len(text):
        room, widened = overlap, 0
        while True:
            right_at = max(begin, left_end - room)
            right_end = min(len(text), left_end + chunk)
            right = tok.encode(text[right_at:right_end], add_special_tokens=False)
            # the last character of the left chunk may be cut from its pre-token
            found = stable_boundary(text, left, begin, right, right_at, max(right_at + 1, begin + 1), left_end - 1)
            if found and found[1] >= skip:
                break
            widened += 1
            room *= 2
            left_end = min(len(text), left_end + room)
            left = tok.encode(text[begin:left_end], add_special_tokens=False)
            if left_end == len(text):
                found = None
                break
        if found is None:
            yield left.ids[skip:], widened
            return
        yield left.ids[skip : found[1]], widened
        begin, left, left_end, skip = right_at, right, right_end, found[2]
    yield left.ids[skip:], 0


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """One row per input row: doc_id, n_bytes (UTF-8), n_tokens, and how many
    chunks the text took and how many overlaps had to be widened.

    Null or empty text: 0 bytes, 0 tokens. Null ids and repeated rows stay as
    they are; an empty table gives an empty result; other columns are not read.
    Tokenizers without a known splitting rule encode every text whole.
    """

    def count(batches):
        enc = encoder(tokenizer_path)
        resync = enc.cut is byte_level_chunks
        for ids, texts in text_pieces(batches):
            huge = [i for i, t in enumerate(texts) if resync and len(t) > chunk_chars]
            n = enc.counts(["" if resync and len(t) > chunk_chars else t for t in texts])
            chunks, widened = np.ones(len(texts), np.int32), np.zeros(len(texts), np.int32)
            for i in huge:
                chunks[i] = 0
                for part, wide in spliced_ids(enc.tok, texts[i], chunk_chars, overlap_chars):
                    n[i] += len(part)
                    chunks[i] += 1
                    widened[i] += wide
            yield batch_of(_OUT, doc_id=ids, n_bytes=[len(t.encode()) for t in texts], n_tokens=n, n_chunks=chunks, n_widened=widened)

    return texts_of(docs, id_col, text_col).mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, n_chunks int, n_widened int")
