"""Exact, cached sub-word encoding inside tasks.

A text is cut only at places where the tokenizer's own pre-tokenizer always
starts a new pre-token, so the ids of a text are the ids of its chunks, one
after the other. Each distinct chunk is encoded once by the ``tokenizers``
library and kept in a bounded per-process table; natural text repeats its
words, so most chunks come from the table.

Cuts that are safe, and why:

* byte-level BPE with the usual pattern (``byte_bpe_50k.json``): before a lone
  ASCII space and around a lone newline, when both neighbours are not white
  space. A pre-token has at most one space and only at its start, and a lone
  newline is a pre-token of its own.
* lower-casing BPE with word ends (``word_bpe_49k.json``): at every ASCII space
  and newline, because white space never belongs to a pre-token and neither
  normalisation nor special strings reach across it.

Other tokenizers (or texts that hold no safe cut) go to the library whole.
"""

from __future__ import annotations

import functools
import gc
import os
import re
from array import array
from itertools import chain

import numpy as np

#: Chunks kept per process and tokenizer before the table starts anew (about 250 bytes each).
TABLE_CHUNKS = 600_000
#: Characters handled at once inside a task.
BLOCK_CHARS = 1_500_000

_RUN = re.compile(r"\s\s")
_SAFE_SPACE = re.compile(r"(?<=\S)(?= \S)")


def byte_level_chunks(text: str) -> list[str]:
    """Chunks of ``text`` for the byte-level pattern; they join to ``text``."""
    if not text:
        return []
    if "\x00" in text or _RUN.search(text):
        return _SAFE_SPACE.split(text)
    parts = text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00")
    return [p for p in parts if p] if "\n" in text or text[0] == " " else parts


def word_end_chunks(text: str) -> list[str]:
    """Chunks of ``text`` for tokenizers that drop white space."""
    return text.replace("\n", " ").split(" ") if text else []


@functools.lru_cache(maxsize=4)
def load_tokenizer(path: str):
    """The ``tokenizers`` tokenizer of a ``.json`` file, without truncation or padding."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def chunk_rule(tok):
    """The safe way to cut texts for ``tok``; None where none is known."""
    import json

    spec = json.loads(tok.to_str())
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and norm is None:
        rule = byte_level_chunks
    elif (
        spec["model"].get("end_of_word_suffix")
        and pre.get("type") == "Sequence"
        and pre["pretokenizers"][0].get("behavior") == "Removed"
        and [n.get("type") for n in (norm or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
    ):
        rule = word_end_chunks
    else:
        return None
    plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"]) and not re.search(r"\s", t["content"]) for t in spec["added_tokens"])
    return rule if plain else None


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the other
    ones, in ascending order, for the code points from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(256 + i) for i, b in enumerate(hidden)}


_BYTES = _byte_letters()


_SPACE = _BYTES[32]


class _Numbers(dict):
    """Numbers new keys in the order in which they are looked up first."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        self.new.append(key)
        return n


class Encoder:
    """Ids of many texts, as one flat array and the number of ids of each text."""

    def __init__(self, path: str, table_chunks: int = TABLE_CHUNKS):
        self.tok, self.most = load_tokenizer(path), table_chunks
        self.cut, self.model = chunk_rule(self.tok), self.tok.model
        self.lower = self.cut is word_end_chunks
        self._reset()

    def _reset(self) -> None:
        self.at = _Numbers()
        self.ids = np.empty(1 << 16, dtype=np.uint32)
        self.start = np.zeros(1 << 14, dtype=np.int64)
        self.used = 0

    def _pieces(self, word: str) -> list[int]:
        """Ids of one pre-token of letters or one mark (with its leading space)."""
        mapped = word.replace(" ", _SPACE) if word.isascii() else word.encode().decode("latin-1").translate(_BYTES)
        return [t.id for t in self.model.tokenize(mapped)]

    def _learn(self, chunks: list[str]) -> None:
        """Encodes new chunks. Where a chunk is letters and at most one full stop or
        comma, its pre-tokens are known and only the model is needed; all other
        chunks go through the whole tokenizer."""
        ids, n, odd = array("I"), array("q"), []
        words: dict[str, list[int]] = {m: self._pieces(m) for m in (".", ",")}
        collecting = gc.isenabled()
        gc.disable()  # very many small lists live at once, and none in a cycle
        for i, chunk in enumerate(chunks):
            mark = chunk[-1:]
            marked = mark == "." or mark == ","
            word = chunk[:-1] if marked else chunk
            if self.lower:
                letters, word = word, word.lower()
                # letters below U+0250 are their own normal form
                known = letters.isalpha() and (word.isascii() or (max(word) <= "\u024f" and len(word) == len(letters)))
            else:
                known = (word[1:] if word[:1] == " " else word).isalpha()
            if not known:
                odd.append(i)
                n.append(0)
                continue
            got = words.get(word)
            if got is None:
                got = words[word] = self._pieces(word)
            ids.extend(got)
            if marked:
                ids.extend(words[mark])
                n.append(len(got) + len(words[mark]))
            else:
                n.append(len(got))
        del words
        if collecting:
            gc.enable()
        ids, n = np.frombuffer(ids, dtype=np.uint32), np.frombuffer(n, dtype=np.int64).copy()
        if odd:
            others = [e.ids for e in self.tok.encode_batch_fast([chunks[i] for i in odd], add_special_tokens=False)]
            at = np.cumsum(n)[odd]
            n[odd] = [len(x) for x in others]
            ids = np.insert(ids, np.repeat(at, n[odd]), np.fromiter(chain.from_iterable(others), dtype=np.uint32, count=int(n[odd].sum())))
        self._append(ids, n)

    def _append(self, ids: np.ndarray, n: np.ndarray) -> None:
        """Adds the newest chunks to the table: all their ids, and how many each has."""
        first = len(self.at) - len(n)
        while self.used + ids.size > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while len(self.at) + 1 > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
        self.ids[self.used : self.used + ids.size] = ids
        self.start[first + 1 : first + 1 + len(n)] = self.used + np.cumsum(n)
        self.used += ids.size

    def _lookup(self, chunks: list[str]) -> np.ndarray:
        if len(self.at) > self.most:
            self._reset()
        code = np.fromiter(map(self.at.__getitem__, chunks), dtype=np.int64, count=len(chunks))
        if self.at.new:
            self._learn(self.at.new)
            self.at.new = []
        return code

    @functools.cached_property
    def _plain(self):
        """(a tokenizer of the model alone, cutting at spaces; which ids end a word), or
        None where not every byte has a letter that ends a word."""
        vocab, suffix = self.tok.get_vocab(True), self.model.end_of_word_suffix
        if not suffix or any(_BYTES.get(b, chr(b)) + end not in vocab for b in range(256) for end in ("", suffix)):
            return None
        from tokenizers import Tokenizer, pre_tokenizers

        plain, ends = Tokenizer(self.model), np.zeros(max(vocab.values()) + 1, dtype=bool)
        plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        return plain, ends

    def encode_once(self, chunks: list[str], most: int = 2000) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks that do not come again, end to end, and where each ends (0
        first). They stay out of the table; those whose pre-tokens are known (``_learn``)
        go through the model many at once, cut by the ids that end a word."""
        if not self.lower or self._plain is None:
            code = self._lookup(chunks)
            return gather_runs(self.ids, self.start[code], self.start[code + 1])
        words, n, odd = [], np.zeros(len(chunks), dtype=np.int64), []
        for i, chunk in enumerate(chunks):
            mark = chunk[-1:]
            marked = mark == "." or mark == ","
            letters = chunk[:-1] if marked else chunk
            word = letters.lower()
            if not letters.isalpha():
                odd.append(i)
                continue
            if not word.isascii():
                if max(word) > "\u024f" or len(word) != len(letters):
                    odd.append(i)
                    continue
                word = word.encode().decode("latin-1").translate(_BYTES)
            words.append(word)
            n[i] = 1
            if marked:
                words.append(mark)
                n[i] = 2
        plain, last = self._plain
        parts = [" ".join(words[i : i + most]) for i in range(0, len(words), most)]
        ids = np.concatenate([np.zeros(0, dtype=np.uint32), *(np.array(e.ids, dtype=np.uint32) for e in plain.encode_batch_fast(parts, add_special_tokens=False))])
        ends = np.concatenate([[0], np.flatnonzero(last[ids]) + 1])[np.concatenate([[0], np.cumsum(n)])]
        if odd:
            others = [e.ids for e in self.tok.encode_batch_fast([chunks[i] for i in odd], add_special_tokens=False)]
            n = np.diff(ends)
            at = ends[1:][odd]
            n[odd] = [len(x) for x in others]
            ids = np.insert(ids, np.repeat(at, n[odd]), np.fromiter(chain.from_iterable(others), dtype=np.uint32, count=int(n[odd].sum())))
            ends = np.concatenate([[0], np.cumsum(n)])
        return ids, ends

    def _blocks(self, texts: list[str]):
        """Consecutive texts in blocks of about BLOCK_CHARS characters."""
        block, chars = [], 0
        for t in texts:
            block.append(t)
            chars += len(t)
            if chars >= BLOCK_CHARS:
                yield block
                block, chars = [], 0
        if block:
            yield block

    def _codes(self, block: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Table position of every chunk of a block and the chunk count of each text."""
        cut = [self.cut(t) for t in block]
        return self._lookup(list(chain.from_iterable(cut))), np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))

    def counts(self, texts: list[str]) -> np.ndarray:
        """Number of ids of each text."""
        out = []
        for block in self._blocks(texts):
            if self.cut is None:
                out.append(np.array([len(e.ids) for e in self.tok.encode_batch_fast(block, add_special_tokens=False)], dtype=np.int64))
                continue
            code, n = self._codes(block)
            ends = np.concatenate([[0], np.cumsum((self.start[1:] - self.start[:-1])[code])])
            at = np.concatenate([[0], np.cumsum(n)])
            out.append(ends[at[1:]] - ends[at[:-1]])
        return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)

    def encode_blocks(self, texts: list[str]):
        """Yields (flat ids, ids per text) for consecutive blocks of ``texts``."""
        for block in self._blocks(texts):
            if self.cut is None:
                lists = [e.ids for e in self.tok.encode_batch_fast(block, add_special_tokens=False)]
                n = np.array([len(x) for x in lists], dtype=np.int64)
                yield np.fromiter((i for x in lists for i in x), dtype=np.uint32, count=int(n.sum())), n
                continue
            code, chunks = self._codes(block)
            flat, ends = gather_runs(self.ids, self.start[code], self.start[code + 1])
            at = np.concatenate([[0], np.cumsum(chunks)])
            yield flat, ends[at[1:]] - ends[at[:-1]]


def gather_runs(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``values[start:stop]`` one after the other, and where each ends (0 first)."""
    n = stop - start
    ends = np.concatenate([[0], np.cumsum(n)])
    pick = np.arange(ends[-1], dtype=np.int64) + np.repeat(start - ends[:-1], n)
    return values[pick], ends


_ENCODERS: dict[tuple, Encoder] = {}


def has_encoder(path: str, *more) -> bool:
    """Whether the process holds this encoder already."""
    return (Encoder, path, *more) in _ENCODERS


def encoder(path: str, *more, kind: type = Encoder):
    """The process's encoder for tokenizer files (Python workers are reused)."""
    key = (kind, path, *more)
    if key not in _ENCODERS:
        _ENCODERS.clear()  # one table per process
        _ENCODERS[key] = kind(path, *more)
    return _ENCODERS[key]


def release() -> None:
    """Drops the process's table; the next encoder starts anew."""
    _ENCODERS.clear()
