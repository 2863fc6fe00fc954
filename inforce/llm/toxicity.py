"""Toxicity by non-negative positive-unlabelled learning (operator 7).

Confirmed toxic rows (P) and text whose labels are not looked at (U) train a small ensemble of
numpy classifiers. The risk is corrected by the class prior ``pi``::

    R = pi * E_P[l(g)] + max(0, E_U[l(-g)] - pi * E_P[l(-g)])

with the sigmoid loss; when the second part turns negative, the step goes
against it (the non-negative correction), which keeps the classifiers from
explaining every confirmed row away. Features are the distinct words of a text
and their beginnings (3 to 6 bytes), hashed; only those clearly more frequent
in P than in U (both by a z value and by a ratio) are kept, so that the words
of a language that happens to be common in P say nothing.

Training reads a sample whose size is bounded by parameters (rows chosen by a
hash of id and text, so the sample does not depend on partitioning); scoring reads
every text whole and needs no shuffle. The model is a few thousand numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inforce.llm.common import batch_of, bound_batches, mix, release_tables, text_pieces, texts_of, word_hashes, word_spans

FEATURE_BITS = 20
PREFIXES = (3, 4, 5, 6)
#: Bounds of the training sample: confirmed toxic rows, and unlabelled rows.
MOST_POSITIVE, MOST_UNLABELLED = 4000, 10_000
#: Predicted toxic from this score on.
THRESHOLD = 0.7

_OUT = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def features(text: str) -> np.ndarray:
    """Sorted distinct feature numbers of a text."""
    raw, start, end = word_spans(text.encode())
    if start.size == 0:
        return np.zeros(0, dtype=np.int32)
    # punctuation at a word's ends is not part of it
    letter = (raw >= 97) & (raw <= 122) | (raw >= 128) | (raw >= 48) & (raw <= 57)
    before = np.concatenate([[0], np.cumsum(letter)])
    keep = before[end] > before[start]
    start, end = start[keep], end[keep]
    at = np.flatnonzero(letter)
    if at.size == 0:
        return np.zeros(0, dtype=np.int32)
    start, end = at[before[start]], at[before[end] - 1] + 1
    parts = [word_hashes(raw, start, end)]
    for n in PREFIXES:
        long = end - start > n
        parts.append(mix(word_hashes(raw, start[long], start[long] + n) + np.uint64(n)))
    return np.unique((np.concatenate(parts) >> np.uint64(64 - FEATURE_BITS)).astype(np.int32))


@dataclass(frozen=True)
class Rows:
    """Feature numbers of many texts, row after row."""

    column: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, rows: list[np.ndarray]) -> Rows:
        return cls(np.concatenate([np.zeros(0, np.int32), *rows]), np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64))

    def __len__(self) -> int:
        return len(self.ends) - 1

    def shares(self) -> np.ndarray:
        return np.bincount(self.column, minlength=1 << FEATURE_BITS) / max(1, len(self))

    def only(self, number: np.ndarray) -> Rows:
        """Renumbered by ``number`` (negative: left out)."""
        new = number[self.column]
        kept = np.concatenate([[0], np.cumsum(new >= 0)])
        return Rows(new[new >= 0], kept[self.ends])

    def times(self, weight: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(weight[self.column])])
        return total[self.ends[1:]] - total[self.ends[:-1]]

    def back(self, value: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.column, np.repeat(value, np.diff(self.ends)), minlength=width)

    def pick(self, rows: np.ndarray) -> Rows:
        n = np.diff(self.ends)[rows]
        ends = np.concatenate([[0], np.cumsum(n)])
        return Rows(self.column[np.arange(ends[-1]) + np.repeat(self.ends[rows] - ends[:-1], n)], ends)


@dataclass(frozen=True)
class Model:
    """Kept features (sorted), one weight column and bias per classifier."""

    kept: np.ndarray
    weight: np.ndarray
    bias: np.ndarray

    def score(self, found: np.ndarray) -> float:
        hit = np.zeros(0, dtype=np.int64)
        if len(found):
            at = np.minimum(np.searchsorted(found, self.kept), len(found) - 1)
            hit = np.flatnonzero(found[at] == self.kept)
        g = self.weight[hit].sum(axis=0) + self.bias
        return float(np.mean(1 / (1 + np.exp(-np.clip(g, -60, 60)))))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _one_of_each(rows: list[np.ndarray]) -> list[np.ndarray]:
    """One row of every group of (near) copies: rows that agree in the two
    smallest values of a hash of their features count once, or the words of a
    much copied text would look like evidence."""
    seen: dict[tuple, np.ndarray] = {}
    for r in rows:
        h = mix(r.astype(np.uint64) + np.uint64(1))
        seen.setdefault(tuple(np.sort(h)[:2].tolist()), r)
    return list(seen.values())


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, classifiers: int = 3, steps: int = 400, rate: float = 0.05, decay: float = 3e-5, least_z: float = 6.0, least_purity: float = 0.5, least_share: float = 0.01, seed: int = 7) -> Model:
    """The ensemble; each classifier sees its own bootstrap of P and U. Without
    confirmed rows, or without unlabelled ones, the model scores by the prior."""
    p, u = Rows.of(_one_of_each(positive)), Rows.of(_one_of_each(unlabelled))
    if not len(p) or not len(u):
        base = np.log(max(prior, 1e-3) / max(1 - prior, 1e-3))
        return Model(np.zeros(0, np.int32), np.zeros((0, 1)), np.array([base]))
    sp, su = p.shares(), u.shares()
    spread = np.sqrt(su * (1 - su) * (1 / len(p) + 1 / len(u)) + 1 / len(u) / len(p) / 4 + 1e-12)
    kept = np.flatnonzero(((sp - su) / spread >= least_z) & (prior * sp >= least_purity * su) & (sp >= least_share)).astype(np.int32)
    number = np.full(1 << FEATURE_BITS, -1, dtype=np.int32)
    number[kept] = np.arange(len(kept))
    p, u, rng = p.only(number), u.only(number), np.random.default_rng(seed)
    weights, biases = [], []
    for _ in range(classifiers):
        bp, bu = p.pick(rng.integers(0, len(p), len(p))), u.pick(rng.integers(0, len(u), len(u)))
        w, m, v = (np.zeros(len(kept) + 1) for _ in range(3))
        w[-1] = -2.0
        for step in range(1, steps + 1):
            sig_p, sig_u = _sigmoid(bp.times(w[:-1]) + w[-1]), _sigmoid(bu.times(w[:-1]) + w[-1])
            d_p, d_u = sig_p * (1 - sig_p) / len(bp), sig_u * (1 - sig_u) / len(bu)
            # l(g) = sigmoid(-g) on P; the part of the negatives: l(-g) = sigmoid(g)
            negative = sig_u.mean() - prior * sig_p.mean()
            if negative >= 0:
                by_p, by_u = -2 * prior * d_p, d_u
            else:
                by_p, by_u = prior * d_p, -d_u
            grad = np.append(bp.back(by_p, len(kept)) + bu.back(by_u, len(kept)), by_p.sum() + by_u.sum())
            grad[:-1] += decay * w[:-1]
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        weights.append(w[:-1])
        biases.append(w[-1])
    return Model(kept, np.stack(weights, axis=1), np.array(biases))


def _feature_rows(df: DataFrame) -> list[np.ndarray]:
    """Features of a sample of texts of bounded size, on the driver."""

    def make(batches):
        for _, texts in text_pieces(batches):
            yield pa.RecordBatch.from_arrays([pa.array([features(t).tobytes() for t in texts], pa.binary())], names=["f"])

    found = texts_of(df).mapInArrow(make, "f binary").toArrow().column("f")
    return sorted((np.frombuffer(b.as_py(), dtype=np.int32) for b in found), key=lambda a: (len(a), a.tobytes()))


def _sampled(rows: DataFrame, total: int, most: int) -> DataFrame:
    """About ``most`` of the different rows (doc_id, key of the text) at most, by a
    hash of both (all, if there are fewer)."""
    if total <= most:
        return rows
    return rows.filter(F.pmod(F.xxhash64("doc_id", "text_key", F.lit("sample")), F.lit(1 << 30)) < int(most / total * (1 << 30)))


def fit_toxicity(docs: DataFrame, labels: DataFrame, may_learn: Column | None = None, most_positive: int = MOST_POSITIVE, most_unlabelled: int = MOST_UNLABELLED) -> Model:
    """Trains on the rows of ``docs`` for which ``may_learn`` (a column over
    ``doc_id``) holds. P: rows whose id any label row calls toxic; U: all these rows
    whatever their labels, the mixture that the risk estimator assumes; the prior
    is the toxic share of the labelled rows. Rows that repeat id and text count
    once. At most about ``most_positive`` + ``most_unlabelled`` rows, drawn by a
    hash of id and text, are read for training. Without label rows, or without
    rows to learn from, the model scores by the prior."""
    base = texts_of(docs).filter(F.col("doc_id").isNotNull())
    marks = labels.filter(F.col("toxic").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    if may_learn is not None:
        base, marks = base.filter(may_learn), marks.filter(may_learn)
    marks = marks.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    base = base.withColumn("text_key", F.xxhash64("text"))
    rows = base.select("doc_id", "text_key").distinct().join(marks, "doc_id", "left")
    n = rows.agg(F.count(F.when(F.col("toxic") == 1, 1)), F.count(F.when(F.col("toxic") == 0, 1)), F.count("*")).first()
    prior = min(0.9, max(0.001, n[0] / max(1, n[0] + n[1])))

    def texts(sample: DataFrame) -> DataFrame:
        # the stated numbers of rows at most, about: a bound on what is broadcast
        keys = F.broadcast(sample.select("doc_id", "text_key"))
        return base.join(keys, ["doc_id", "text_key"], "left_semi").dropDuplicates(["doc_id", "text_key"])

    positive = texts(_sampled(rows.filter(F.col("toxic") == 1), n[0], most_positive))
    unlabelled = texts(_sampled(rows, n[2], most_unlabelled))
    return train(_feature_rows(positive), _feature_rows(unlabelled), prior)


def toxicity_scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, score in [0, 1]. Null and empty texts get
    the score of a text without any feature; repeated rows and null ids stay;
    an empty table gives an empty result; other columns are not read."""

    def run(batches):
        release_tables()
        for ids, texts in text_pieces(batches):
            yield batch_of(_OUT, doc_id=ids, score=[model.score(features(t)) for t in texts])

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")


def without_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more."""
    bound_batches(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches):
        release_tables()
        for b in batches:
            keep = [model.score(features(t or "")) < threshold for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(keep, type=pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
