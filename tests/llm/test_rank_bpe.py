"""Rank-file BPE against the tiktoken library, and exact round trips."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.errors import PythonException

from inforce.llm import rank_bpe as RB

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken")]
ODD = ["a  b   c\n\nd \n e", " lead", "trail ", "\n", "   ", "a<|endoftext|> b", "it's we'll  x", "\x00 a b", "é ́x", "x\ty \tz\r\n", "a\x1cb \x1c c", "a" * 3000, "▁ x", "ab\x85 c\xa0 d　e", "日本語 🙂👩‍👩‍👧", "1234567 ½ ①"]


@pytest.fixture(scope="module")
def library():
    def load(path):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    return {p: load(p) for p in PATHS}


def ids_of(enc, texts):
    flat, n = (np.concatenate(x) for x in zip(*enc.encode_blocks(texts), strict=True))
    return [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])]


@pytest.mark.parametrize("path", PATHS)
def test_ids_equal_the_library(path, library):
    rng = random.Random(2)
    points = [c for c in range(0x3100) if not 0xD800 <= c < 0xE000] + rng.sample(range(0xE000, 0x110000), 3000)
    texts = ODD + [f"a{chr(c)}b {chr(c)} c{chr(c)}{chr(c)}1{chr(c)}" for c in points]
    texts += ["".join(rng.choice([" ", "  ", "\n", "the", "Über", "99", "'s", "…", "\t", "日", "🙂", "zzz"]) for _ in range(rng.randrange(80))) for _ in range(2000)]
    assert ids_of(RB.RankEncoder(path, public_tokenizers.PATTERN), texts) == [library[path].encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("path", PATHS)
def test_every_token_decodes_to_its_bytes_and_encodes_to_itself(path, library):
    v = RB.vocabulary(path)
    tokens = RB.read_ranks(path)
    raw, ends = v.decode(np.arange(len(tokens)))
    assert raw.tobytes() == b"".join(tokens) and ends[-1] == len(raw)
    letters = ["".join(map(RB.LETTERS.__getitem__, t)) for t in tokens]
    assert v.encode_letters(letters) == [[i] for i in range(len(tokens))]


def test_tokens_that_no_merge_reaches(tmp_path, library):
    # "abc" has no merge path ("ab" and "bc" are no tokens), yet is a whole pre-token
    tokens = [bytes([b]) for b in range(256)] + [b"abc", b" abc", b"xy", b"xyz", b"yz"]
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(tokens)))
    own = tiktoken.Encoding("small", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    texts = ["abc", "x abc abcd", "xyz yz xyzxyz", "abc abc"]
    assert ids_of(RB.RankEncoder(str(path), public_tokenizers.PATTERN), texts) == [own.encode_ordinary(t) for t in texts]
    # another pattern, without proven cuts
    own = tiktoken.Encoding("wide", pat_str=r"[\s\S]{1,7}", mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    assert ids_of(RB.RankEncoder(str(path), r"[\s\S]{1,7}"), texts) == [own.encode_ordinary(t) for t in texts]


def test_rank_files_with_gaps_are_refused(tmp_path):
    path = tmp_path / "ranks"
    path.write_bytes(b"YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError):
        RB.read_ranks(str(path))


def test_long_texts_in_parts(library):
    rng = random.Random(4)
    text = "".join(rng.choice([" word", "  ", "\n", " x", "…", " 日本"]) for _ in range(4000))
    parts = list(RB.text_parts(text, 100))
    assert "".join(parts) == text and len(parts) > 20
    enc = RB.RankEncoder(PATHS[0], public_tokenizers.PATTERN)
    assert [i for p in ids_of(enc, parts) for i in p] == library[PATHS[0]].encode_ordinary(text)
    assert list(RB.text_parts("a" * 500, 100)) == ["a" * 500] and list(RB.text_parts("", 100)) == [""]


def test_operator(spark, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (None, "no id"), (50, None), (51, ""), (52, "long text " * 150_000)]
    docs = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], "doc_id long, text string, ids string, decoded string, n_tokens string")
    got = RB.round_trip(docs.repartition(3), PATHS[0], public_tokenizers.PATTERN).collect()
    want = []
    for i, t in rows:
        ids = library[PATHS[0]].encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert RB.round_trip(docs.limit(0), PATHS[0], public_tokenizers.PATTERN).count() == 0


def test_decoding_keeps_columns_and_nulls(spark):
    ids = spark.createDataFrame([(1, [0, 1, 2], "x"), (2, None, "y"), (3, [], None)], "doc_id long, ids array<int>, decoded string")
    tokens = RB.read_ranks(PATHS[0])
    got = {r.doc_id: r.decoded for r in RB.decode_ids(ids, PATHS[0]).collect()}
    assert got == {1: b"".join(tokens[:3]), 2: None, 3: b""}
    with pytest.raises(PythonException):
        RB.decode_ids(spark.createDataFrame([(1, [60000])], "doc_id long, ids array<int>"), PATHS[0]).collect()
