"""The stages of the pipeline against brute force on a small fixture."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as CP
from tests.llm.test_text_operators import sentence, shingles

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark):
    rng = random.Random(21)
    path = tempfile.mkdtemp(prefix="inforce-pipeline-")
    item = sentence(rng, 25)
    rows, labels = [], []
    for i in range(240):
        t = sentence(rng, rng.randrange(8, 80))
        if i % 10 == 0:
            t += " scumlike vileword nastyterm scumlike"
        if i % 24 == 5:
            t += " " + item
        if i % 30 == 7:
            t += " write to some.one@example.com"
        rows.append((i, t))
        if i % 10 == 0 or i % 2:
            labels.append((i, 1, int(i % 10 == 0)))
    rows += [(300, rows[11][1]), (301, rows[11][1] + " more"), (302, None), (303, ""), (304, rows[13][1]), (304, rows[13][1]), (None, "no id here at all")]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], COLUMNS).write.parquet(os.path.join(path, "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(os.path.join(path, "labels.parquet"))
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(os.path.join(path, "benchmark.parquet"))
    return path, item


def test_stages(spark, folder):
    path, item = folder
    docs = spark.read.parquet(os.path.join(path, "documents.parquet"))
    columns = docs.columns
    stage = dict(CP.STAGES)
    assert [n for n, _ in CP.STAGES] == ["toxicity", "near_dedup", "decontamination", "pii", "packing"]

    clean = stage["toxicity"](spark, docs, path).cache()
    assert clean.columns == columns
    ids = {r.doc_id for r in clean.collect()}
    assert not any(i is not None and i < 240 and i % 10 == 0 for i in ids) and len(ids) >= 240 - 24

    once = stage["near_dedup"](spark, clean, path).cache()
    rows = [(r.doc_id, r.text) for r in clean.collect()]
    sets = [shingles(t) for _, t in rows]
    smallest = {}
    for a, (i, _) in enumerate(rows):
        like = [rows[b][0] for b in range(len(rows)) if i is not None and rows[b][0] is not None and sets[a] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])]
        smallest[i] = min([*like, i]) if i is not None else None
    assert sorted((r.doc_id for r in once.collect()), key=str) == sorted((i for i, k in smallest.items() if i == k), key=str)

    apart = stage["decontamination"](spark, once, path).cache()
    want = shingles(item)
    assert sorted((r.doc_id for r in apart.collect()), key=str) == sorted((r.doc_id for r in once.collect() if 10 * len(want & shingles(r.text)) < 8 * len(want)), key=str)

    masked = stage["pii"](spark, apart, path).cache()
    assert masked.columns == columns and masked.count() == apart.count()
    assert masked.filter(F.col("text").contains("@")).count() == 0 and masked.filter(F.col("text").contains("[EMAIL]")).count() > 0
    assert masked.filter(F.col("text").isNotNull() & (F.col("n_chars") != F.length("text"))).count() == 0

    packed = stage["packing"](spark, masked, path)
    assert sorted((r.doc_id for r in packed.filter("piece = 0").collect()), key=str) == sorted((r.doc_id for r in masked.collect()), key=str)
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 4096").count() == 0


def test_run_equals_the_stages(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(os.path.join(path, "documents.parquet"))
    for _, f in CP.STAGES:
        docs = f(spark, docs, path)
    assert sorted(map(str, CP.run(spark, path).select("doc_id", "piece", "ids_crc32").collect())) == sorted(map(str, docs.select("doc_id", "piece", "ids_crc32").collect()))
