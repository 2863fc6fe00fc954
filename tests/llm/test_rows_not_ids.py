"""Operators judge rows: repeated ids with different content, large ids next to nulls, nearly complete labels."""

import random

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline as CP
from inforce.llm import near_duplicates as ND
from inforce.llm import packing as PK
from inforce.llm import pii as PII
from inforce.llm import toxicity as TX
from inforce.llm.embedding_duplicates import embedding_duplicates
from tests.llm.test_text_operators import sentence, shingles

TEXTS = "doc_id long, text string"


def near(text, at=7):
    w = text.split()
    w[at] = "changed"
    return " ".join(w)


def test_an_id_with_two_texts_links_each_row_by_its_own(spark):
    rng = random.Random(3)
    a, u = sentence(rng, 200), sentence(rng, 150)
    for rows in ([(5, a), (5, u), (9, near(a))], [(5, u), (5, a), (9, near(a))], [(9, near(a)), (5, u), (7, near(u)), (5, a)]):
        got = {(r.doc_id, r.component_id) for r in ND.near_duplicates(spark.createDataFrame(rows, TEXTS).repartition(2)).collect()}
        assert got == {(i, min(5, i)) for i, _ in rows}


def test_dedup_keeps_one_row_of_a_group_and_all_others(spark):
    rng = random.Random(4)
    a, u = sentence(rng, 200), sentence(rng, 150)
    rows = [(3, a), (5, a), (5, u), (6, near(a)), (7, u), (7, u), (8, None), (8, None), (9, ""), (None, a), (None, a), (10, "one two"), (11, "ONE  two"), (12, "three"), (12, "three")]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], TEXTS + ", row_id string, row_key string")
    got = ND.without_near_duplicates(docs)
    assert got.columns == docs.columns
    key = lambda r: (str(r[0]), str(r[1]))
    want = [(3, a), (5, u), (8, None), (8, None), (9, ""), (None, a), (None, a), (10, "one two"), (12, "three")]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=key) == sorted(want, key=key)
    stage = dict(CP.STAGES)["near_dedup"](spark, docs, "")
    assert sorted(((r.doc_id, r.text) for r in stage.collect()), key=key) == sorted(want, key=key)


def test_hubs_of_many_components(spark, monkeypatch):
    """Members outside a hub's largest component meet all chunks: equal to brute force."""
    monkeypatch.setattr(ND, "CHUNK_TEXTS", 4)
    rng = random.Random(9)
    rows, start = [], sentence(rng, 60).split()
    for i in range(70):  # a long shared part, and tails that only some share
        tail = [f"t{i % 11}x{j}" for j in range(rng.choice([3, 8, 20]))]
        rows.append((i, " ".join([*start[: rng.choice([40, 50, 60])], *tail])))
    sets = [shingles(t) for _, t in rows]
    best = list(range(len(rows)))
    while True:
        new = [min(best[b] for b in range(len(rows)) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])) for a in range(len(rows))]
        if new == best:
            break
        best = new
    got = {r.doc_id: r.component_id for r in ND.near_duplicates(spark.createDataFrame(rows, TEXTS)).collect()}
    assert got == dict(enumerate(best)) and len({*best}) > 3


def test_meetings_join_strangers_with_everyone(spark, monkeypatch):
    monkeypatch.setattr(ND, "CHUNK_TEXTS", 2)
    members = spark.createDataFrame([(1, i, 10) for i in range(2, 12)], "hub long, rep long, n long")
    component = spark.createDataFrame([(i, 2) for i in range(2, 8)], "node long, component long")
    rows = ND.mixed_meetings(members, component).collect()
    together = set()
    for lo, hi in {(r.lo, r.hi) for r in rows}:
        held = [r for r in rows if (r.lo, r.hi) == (lo, hi)]
        together |= {frozenset((x.rep, y.rep)) for x in held for y in held if x.rep != y.rep and (lo == hi or x.chunk != y.chunk)}
    strangers = set(range(8, 12))
    wanted = {frozenset((i, j)) for i in strangers for j in range(2, 12) if i != j}
    assert wanted <= together and not any(p <= set(range(2, 8)) for p in together)


def test_an_id_with_two_vectors(spark):
    rng = np.random.default_rng(1)
    u, v = rng.normal(size=(2, 16))
    w = v + rng.normal(size=16) * 0.01
    rows = [(1, u), (1, v), (7, w), (8, u), (None, v), (2, v)]
    table = spark.createDataFrame([(i, x.tolist()) for i, x in rows], "vec_id long, embedding array<double>")
    got = sorted((r.vec_id is None, r.vec_id, r.n_links, r.component_id) for r in embedding_duplicates(table).collect())
    assert got == sorted([(False, 1, 1, 1), (False, 1, 2, 1), (False, 7, 2, 1), (False, 8, 1, 1), (True, None, 0, None), (False, 2, 2, 1)])
    alone = spark.createDataFrame([(1, u.tolist()), (1, v.tolist()), (7, (u + rng.normal(size=16) * 0.01).tolist())], "vec_id long, embedding array<double>")
    assert sorted((r.vec_id, r.n_links) for r in embedding_duplicates(alone).collect()) == [(1, 0), (1, 1), (7, 1)]


def test_packing_keeps_large_ids_next_to_nulls(spark):
    ids = [2**53 + 1, 2**53 + 3, None, 2**62 + 1, -(2**60) - 7]
    docs = spark.createDataFrame([(i, f"some words number {k}") for k, i in enumerate(ids)], TEXTS)
    got = PK.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")).collect()
    assert sorted((r.doc_id for r in got), key=str) == sorted(ids, key=str)


def test_equal_rows_spread_over_shards(spark):
    docs = spark.range(900).selectExpr("cast(null as long) as doc_id", "'the same words in every row' as text")
    pieces = PK.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    got = PK.pack_pieces(pieces, capacity=64, shard_pieces=100).collect()
    per_shard = {}
    for r in got:
        per_shard[r.sequence_id >> 32] = per_shard.get(r.sequence_id >> 32, 0) + 1
    assert len(got) == 900 and len(per_shard) >= 8 and max(per_shard.values()) < 200
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 64


@pytest.fixture(scope="module")
def toxic_table():
    rng = random.Random(6)
    return [(i, sentence(rng, rng.randrange(8, 60)) + (" scumlike vileword nastyterm" if i % 10 == 0 else "")) for i in range(1200)]


@pytest.mark.parametrize("unlabelled", [0, 1, 600])
def test_toxicity_does_not_turn_on_missing_labels(spark, toxic_table, unlabelled):
    docs = spark.createDataFrame(toxic_table, TEXTS)
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i, _ in toxic_table if i >= unlabelled], "doc_id long, toxic int")
    model = TX.fit_toxicity(docs, labels)
    scores = TX.toxicity_scores(docs, model).filter(f"score >= {TX.THRESHOLD}").collect()
    assert {r.doc_id for r in scores} == set(range(0, 1200, 10))


def test_toxicity_samples_rows_not_ids(spark, toxic_table):
    rng = random.Random(8)
    many = [(-1, sentence(rng, 12) + f" scumlike vileword nastyterm e{k}") for k in range(900)]
    rows = [r for r in toxic_table if r[0] % 10] + many + [(-2, "scumlike vileword nastyterm again")] * 500
    docs = spark.createDataFrame(rows, TEXTS)
    labels = spark.createDataFrame([(-1, 1), (-2, 1), *((i, 0) for i, _ in toxic_table if i % 10)], "doc_id long, toxic int")
    model = TX.fit_toxicity(docs, labels, most_positive=300, most_unlabelled=800)
    found = {r.doc_id for r in TX.toxicity_scores(docs, model).filter(f"score >= {TX.THRESHOLD}").collect()}
    assert found == {-1, -2}


def test_spelled_addresses_do_not_depend_on_the_rest_of_the_text():
    for text, what in [("write to jane at example.com now", "jane at example.com"), ("jane (at) example . com", "jane (at) example . com"), ("x jane at mail dot example dot org!", "jane at mail dot example dot org")]:
        for more in ("", " (dot)", " and joe [at] x", " meet at noon. Then go"):
            spans = PII.wide_spans(text + more, [])
            assert any(k == 0 and (text + more)[a:b].startswith(what) for a, k, b in spans), (text, more, spans)
    assert PII.wide_spans("we meet at noon. Then we go at 5", []) == []
    assert PII.wide_spans("at at.at a at b.c", PII.base_spans("at at.at a at b.c")) != []


def test_many_candidates_in_one_text():
    text = " ".join(f"a{i}@b.com c{i} (at) d.org 4000 0000 0000 {i:04d}" for i in range(20_000))
    base = PII.base_spans(text)
    found = PII.wide_spans(text, base)  # linear: some seconds at most
    assert len(base) >= 20_000 and len(found) >= 20_000
    small = " ".join(f"a{i}@b.com c{i} (at) d.org 4000 0000 0000 {i:04d} 10.0.0.{i}" for i in range(40))
    base = PII.base_spans(small)
    assert all(not any(a < s[2] and s[0] < b for a, _, b in base) for s in PII.wide_spans(small, base))


def test_groups_follow_the_bytes_and_spread_rows_without_an_id(spark):
    from inforce.llm.common import dealt, texts_of

    rows = [(None if i % 3 == 0 else i, f"text number {i} " * 20) for i in range(3000)]
    docs = texts_of(spark.createDataFrame(rows, TEXTS))
    grouped, groups = dealt(docs, 20_000)
    assert groups > 30
    nulls = [r["count"] for r in grouped.filter("doc_id is null").groupBy("grp").count().collect()]
    assert len(nulls) > groups * 0.9 and max(nulls) < 100
    assert dealt(docs.limit(0))[1] == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_repeated_spans_in_many_groups(spark, monkeypatch):
    from inforce.llm import common
    from inforce.llm import repeated_spans as RS

    rng = random.Random(12)
    shared = sentence(rng, 30)
    rows = [(i % 40 if i % 5 else None, sentence(rng, 20) + (" " + shared if i % 4 == 0 else "")) for i in range(120)]
    docs = spark.createDataFrame(rows, TEXTS)
    want = sorted(map(tuple, RS.repeated_spans(docs).collect()), key=str)
    real = common.dealt
    monkeypatch.setattr(RS, "dealt", lambda d: real(d, 500))
    assert sorted(map(tuple, RS.repeated_spans(docs).collect()), key=str) == want
    assert any(r[2] for r in want)
