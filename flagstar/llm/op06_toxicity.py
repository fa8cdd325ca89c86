"""Toxicity scores from a counterfactually regularised classifier.

A logistic model over the distinct lower-cased words of a text. It is fitted on
a bounded sample of labelled rows (``MAX_TRAIN`` documents, lowest seeded hash
first); everything else - vocabulary weights are applied to every word of every
text - covers all rows.

Counterfactuals: group mentions must not move the score by themselves. For each
training text, its identity terms are swapped for another group's (a text with
none gets one inserted), and the squared change of the log-odds is penalised
with weight ``SWAP_WEIGHT``. Texts that mention a group neutrally are thus
scored by their other words, even if mentions and toxic labels coincide in the
training rows.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flagstar.llm.common import fresh, ship, table

ship(__name__)

# Group terms that are swapped for each other (fixed values).
IDENTITY_TERMS = (
    "women men woman man girls boys gay lesbian straight transgender muslim muslims christian christians jewish jews "
    "hindu buddhist atheist black white asian latino african european american mexican arab immigrant immigrants refugee "
    "refugees disabled blind deaf old young femmes hommes musulmans juifs frauen männer muslime juden mujeres hombres musulmanes judíos"
).split()

MAX_TRAIN = 8_000  # labelled documents used for fitting
MAX_VOCABULARY = 4_000  # words with a weight
MIN_DOCS = 3
L2, SWAP_WEIGHT = 0.4, 0.5
ROUNDS, RATE = 250, 0.15
SEED = 11
FOLDS, HELD_OUT = 5, 0
WORD_PATTERN = r"\w+"


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, modulo FOLDS; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % FOLDS


def tokens(text: str | None) -> set[str]:
    return set(re.findall(WORD_PATTERN, (text or "").lower()))


class Model:
    """Bias and word weights; ``score`` is the probability of label 1."""

    def __init__(self, bias: float = 0.0, weights: dict[str, float] | None = None):
        self.bias, self.weights = bias, weights or {}

    def score(self, text: str | None) -> float:
        known = tokens(text) & self.weights.keys()
        z = self.bias + sum(self.weights[w] for w in sorted(known))
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))))


def fit(texts: list[set[str]], labels: np.ndarray, swap_weight: float = SWAP_WEIGHT) -> Model:
    """Full-batch fit. Without rows of both labels: no weights, and the
    (smoothed) share of label 1 as the score of every text."""
    n, pos = len(texts), float(np.sum(labels))
    prior = (pos + 0.5) / (n + 1)
    if pos == 0 or pos == n:
        return Model(float(np.log(prior / (1 - prior))))
    counts: dict[str, list[int]] = {}
    for words, y in zip(texts, labels):
        for w in words:
            counts.setdefault(w, [0, 0])[int(y)] += 1
    identity = set(IDENTITY_TERMS)
    rate = lambda c: abs(np.log((c[1] + 0.5) / (pos + 1)) - np.log((c[0] + 0.5) / (n - pos + 1))) * np.sqrt(sum(c))
    ranked = sorted((w for w, c in counts.items() if sum(c) >= MIN_DOCS or w in identity), key=lambda w: (-rate(counts[w]), w))
    vocabulary = ranked[:MAX_VOCABULARY] + [w for w in ranked[MAX_VOCABULARY:] if w in identity]
    place = {w: i for i, w in enumerate(vocabulary)}
    groups = np.array([place[w] for w in vocabulary if w in identity], dtype=np.int64)
    rows = [np.array(sorted(place[w] for w in words if w in place), dtype=np.int64) for words in texts]
    at = np.repeat(np.arange(n), [len(r) for r in rows])
    col = np.concatenate([*rows, np.zeros(0, np.int64)])
    # swaps: the change of the log-odds is a difference of identity weights
    rng = np.random.default_rng(SEED)
    out_of, into = [], []
    for i, r in enumerate(rows):
        mine = r[np.isin(r, groups)]
        if len(groups):
            out_of += [(i, c) for c in mine]
            into += [(i, groups[k]) for k in rng.integers(0, len(groups), max(1, len(mine)))]
    out_of, into = np.array(out_of, dtype=np.int64).reshape(-1, 2), np.array(into, dtype=np.int64).reshape(-1, 2)
    y = labels.astype(float)
    # both labels weigh in alike
    balance = np.where(y == 1, n / (2 * pos), n / (2 * (n - pos)))
    balance /= balance.mean()
    w, b = np.zeros(len(vocabulary)), float(np.log(prior / (1 - prior)))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, ROUNDS + 1):
        z = b + np.bincount(at, w[col], n)
        err = balance * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y)
        g = np.bincount(col, err[at], len(w)) + L2 * w
        gb = err.sum()
        if len(into):
            change = np.bincount(into[:, 0], w[into[:, 1]], n) - np.bincount(out_of[:, 0], w[out_of[:, 1]], n)
            g += 2 * swap_weight * (np.bincount(into[:, 1], change[into[:, 0]], len(w)) - np.bincount(out_of[:, 1], change[out_of[:, 0]], len(w)))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        scale = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        w -= scale * m / (np.sqrt(v) + 1e-8)
        b -= scale * mb / (np.sqrt(vb) + 1e-8)
    return Model(float(b), {word: float(w[i]) for word, i in place.items() if abs(w[i]) > 1e-4})


def _features(batches):
    for b in batches:
        words = [" ".join(sorted(tokens(t))) for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.string()), b.column(2)], names=["doc_id", "words", "label"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on labelled rows outside the held-out fold. Rows with a null id, null
    label or a label of an id that has both labels take no part."""
    marked = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .where((fold(F.col("doc_id")) != HELD_OUT) & F.col("label").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("_max"))
        .where("label = _max")
        .drop("_max")
    )
    chosen = marked.orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(MAX_TRAIN)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # MAX_TRAIN ids at most: a proven bound for the broadcast
    rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label").mapInArrow(_features, "doc_id long, words string, label int")
    got = sorted({(r["doc_id"], r["words"], r["label"]) for r in rows.toLocalIterator()})
    return fit([set(r[1].split()) for r in got], np.array([r[2] for r in got], dtype=int))


def _score(model: Model, text_at: int, names: list[str]):
    def run(batches):
        for b in batches:
            scores = [model.score(t.as_py()) for t in b.column(text_at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64())], names=names)

    return run


def with_score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score of each whole text. Null and empty
    texts get the bias alone; repeated rows equal scores."""
    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])
    return docs.mapInArrow(_score(model, docs.columns.index(text_col), schema.names), schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = with_score(docs, model).drop("text")
    held_out = F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject, with their own columns."""
    model = train(docs, table(spark, sf_dir, "labels"))
    score = fresh(docs, "_toxicity")
    return with_score(docs, model, "text", score).where(F.col(score) < 0.5).drop(score)


def fold_of(doc_id: int) -> int:
    """:func:`fold` of one id, outside Spark."""
    return zlib.crc32(str(doc_id).encode()) % FOLDS
