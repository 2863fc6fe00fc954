"""Cross-tokenizer alignment against a plain loop over tokens."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from inforce.llm import alignment as AL

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, block string, codes string, a string, docs string, count string"
ODD = [
    "a  b   c\n\nd \n e", " lead", "trail ", "\n", "   ", "x", "it's we'll  x", "\x00 a b", "é ́x ΣΑΣ ς", "x\ty \tz\r\n", "日本語のテキスト, 東京 2024", "🙂👩‍👩‍👧 family", "plain ▁ lower block", "<s> </s> <|endoftext|> <unk> <0x41>",
    "a" * 700, "  \n  \n\t x", "https://example.com/a_b?c=d&e=%20", "\x1c b\x1d c\x85d\xa0e　f", "ñandú œuvre ﬁn ①", "10,000.50 +49 (0)30 123",
]


def byte_letters():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(b): b for b in shown}
    back.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)})
    return back


@pytest.fixture(scope="module")
def plain():
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    return tok, sentencepiece.SentencePieceProcessor(model_file=B), byte_letters()


def piece_bytes(sp, i):
    p = sp.id_to_piece(i)
    return bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()


def groups_of(plain, text):
    """[(A ids, B ids)] of a text, by a loop."""
    tok, sp, back = plain
    if not text:
        return []
    a = tok.encode(" " + text, add_special_tokens=False).ids
    b = sp.encode(text)
    bytes_a = [bytes(back[c] for c in tok.id_to_token(i)) if i != 50256 else b"<|endoftext|>" for i in a]
    bytes_b = [piece_bytes(sp, i) for i in b]
    want = (" " + text).encode()
    if b"".join(bytes_a) != want or b"".join(bytes_b) != want:
        return []
    ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
    out, i, j = [], 0, 0
    for e in sorted({*ends_a} & {*ends_b}):
        ga, gb = [], []
        while i < len(a) and ends_a[i] <= e:
            ga.append(a[i])
            i += 1
        while j < len(b) and ends_b[j] <= e:
            gb.append(b[j])
            j += 1
        out.append((ga, gb))
    return out


def brute(plain, rows):
    groups = [groups_of(plain, t) for _, t in rows]
    held = Counter()
    for g in groups:
        held.update({(x, y) for ga, gb in g for x in ga for y in gb})
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for (i, _), g in zip(rows, groups, strict=True):
        links = [(x, y) for ga, gb in g for x in ga for y in gb]
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in g)
        out.append((i, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return out


def key(r):
    return tuple((x is None, x) for x in r)


def rows_of(rng):
    some = "the of and river stone Light über garden, quick. moon-tall road deep naïve glass 日本 🙂 x\ty".split(" ")
    rows = [(i, " ".join(rng.choice(some) + rng.choice(["", "", "s", "17", "\n", "  "]) for _ in range(rng.randrange(1, 60)))) for i in range(40)]
    rows += [(100 + i, t) for i, t in enumerate(ODD)]
    return rows + [(200, None), (201, ""), (202, rows[0][1]), (202, rows[0][1]), (None, rows[1][1]), (None, None), (203, " ".join(rng.choice(some) for _ in range(9000)))]


def test_counts_equal_a_plain_loop(spark, plain):
    rows = rows_of(random.Random(3))
    docs = spark.createDataFrame([(i, t, "x", "y", "z", "u", "v") for i, t in rows], DOCS)
    want = sorted(brute(plain, rows), key=key)
    for block in (400, 1_000_000):  # many blocks, one block
        got = AL.alignment_counts(docs.repartition(3), A, B, block_chars=block)
        assert sorted(map(tuple, got.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=key) == want


def test_aligned_tokens_rebuild_the_groups(spark, plain):
    rows = rows_of(random.Random(4))
    got = AL.aligned_tokens(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string"), A, B).collect()
    assert len(got) == len(rows)
    for r in got:
        cuts = list(zip([0, *r.a_cuts], [0, *r.b_cuts], strict=True))
        groups = [(r.a_ids[i:k], r.b_ids[j:m]) for (i, j), (k, m) in zip(cuts[:-1], cuts[1:], strict=True)]
        assert groups == groups_of(plain, rows[r.doc_id][1])


def test_lanes_and_long_groups_change_nothing(monkeypatch):
    pair = AL.PairEncoder(A, B)
    rng = random.Random(8)
    texts = [t for _, t in rows_of(rng) if t] + ["", " ".join(ODD * 30), "日本🙂" * 800]
    whole = AL.Alignment(pair, texts, lane_tokens=1 << 40)
    parted = AL.Alignment(pair, texts, lane_tokens=16)
    assert whole.digests() == parted.digests() and np.array_equal(whole.links_of_documents(), parted.links_of_documents())
    expected = whole.document_pairs(32000)
    assert int(expected[3].sum()) == int(whole.links_of_documents().sum())
    monkeypatch.setattr(AL, "LISTED_PAIRS", 1)  # every group of several tokens from histograms
    for x, y in zip(expected, parted.document_pairs(32000), strict=True):
        assert np.array_equal(x, y)


def test_chunks_give_the_ids_of_whole_texts(plain):
    tok, sp, _ = plain
    pair = AL.PairEncoder(A, B)
    texts = [t for t in ODD if t] + [" ".join(ODD)]
    for side, want in ((pair.a, [tok.encode(" " + t, add_special_tokens=False).ids for t in texts]), (pair.b, [sp.encode(t) for t in texts])):
        flat, n = (np.concatenate(x) for x in zip(*side.encode_blocks([" " + t for t in texts]), strict=True))
        assert [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])] == want


def test_empty_table(spark):
    none = spark.createDataFrame([], DOCS)
    assert AL.alignment_counts(none, A, B).count() == 0
    assert AL.aligned_tokens(none, A, B).count() == 0


def test_texts_without_tokens_only(spark):
    got = AL.alignment_counts(spark.createDataFrame([(1, None), (2, ""), (3, "▁")], "doc_id long, text string"), A, B).collect()
    assert sorted(map(tuple, got)) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)]
