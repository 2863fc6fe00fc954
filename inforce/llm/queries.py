"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inforce.llm.alignment import alignment_counts
from inforce.llm.common import crc_mod
from inforce.llm.decontaminate import contained_items
from inforce.llm.embedding_duplicates import embedding_duplicates
from inforce.llm.lm_scoring import lm_scores
from inforce.llm.near_duplicates import near_duplicates
from inforce.llm.packing import pack_documents
from inforce.llm.pii import find_pii, fit_pii
from inforce.llm.rank_bpe import round_trip
from inforce.llm.repeated_spans import repeated_spans
from inforce.llm.token_counts import token_counts
from inforce.llm.token_files import read_token_files, token_file_folder, write_token_files
from inforce.llm.toxicity import THRESHOLD, fit_toxicity, toxicity_scores
from inforce.llm.whitening import whitened_embeddings
from inforce.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts(read_table(spark, sf_dir, "documents"), path).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"), "n_chunks", "n_widened")


@_query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, read_table(spark, sf_dir, "labels"), crc_mod("doc_id", 3) != 1)
    return toxicity_scores(docs, model).select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


@_query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    index = write_token_files(read_table(spark, sf_dir, "documents"), path, token_file_folder(spark))
    return read_token_files(index)


@_query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@_query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return find_pii(docs, fit_pii(docs))


@_query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


# A-Z in lower case, split at the six ASCII white-space characters.
_WORDS_SQL = "regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"
_SHINGLES_SQL = """{name}_words AS (SELECT {id} AS id, {words} AS w FROM {table} WHERE text IS NOT NULL),
{name} AS (
  SELECT DISTINCT id, s FROM (
    SELECT id, unnest(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]
                           ELSE [array_to_string(w, ' ') || ' <' || len(w) || '>'] END) AS s
    FROM {name}_words WHERE len(w) > 0))"""


def _shingles_sql(name: str, table: str, id_col: str) -> str:
    return _SHINGLES_SQL.format(name=name, table=table, id=id_col, words=_WORDS_SQL.format(text="text"))


ORACLES["op4_decontamination"] = f"""
WITH {_shingles_sql("ds", "documents", "doc_id")},
{_shingles_sql("bs", "benchmark", "item_id")},
sizes AS (SELECT id, count(*) AS n FROM bs GROUP BY id),
shared AS (SELECT ds.id AS doc_id, bs.id AS item_id, count(*) AS k FROM ds JOIN bs USING (s) GROUP BY 1, 2)
SELECT doc_id, item_id, n AS n_item, k AS n_shared, CAST(k AS DOUBLE) / n AS containment
FROM shared JOIN sizes ON sizes.id = shared.item_id
WHERE k >= ceil(0.8 * n - 1e-9)
"""


@_query
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), percent=85)


ORACLES["op5_near_duplicates"] = f"""
WITH RECURSIVE {_shingles_sql("ds", "documents", "doc_id")},
sizes AS (SELECT id, count(*) AS n FROM ds GROUP BY id),
shared AS (SELECT a.id AS a, b.id AS b, count(*) AS k FROM ds a JOIN ds b ON a.s = b.s AND a.id <> b.id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.id = a JOIN sizes y ON y.id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach(id, other) AS (SELECT id, id FROM sizes UNION SELECT reach.id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT d.doc_id, coalesce(sizes.n, 0) AS n_shingles, coalesce(min(reach.other), d.doc_id) AS component_id,
       d.doc_id = coalesce(min(reach.other), d.doc_id) AS kept
FROM documents d LEFT JOIN sizes ON sizes.id = d.doc_id LEFT JOIN reach ON reach.id = d.doc_id
GROUP BY d.doc_id, sizes.n
"""


@_query
def op6_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_duplicates(read_table(spark, sf_dir, "embeddings"))


@_query
def op9_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(read_table(spark, sf_dir, "documents")).drop("spans")


@_query
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), crc_mod("doc_id", 7) == 2)


@_query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@_query
def op12_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@_query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_embeddings(read_table(spark, sf_dir, "embeddings"))
