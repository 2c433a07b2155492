"""Quality classifier: a factorisation machine over hashed words, structure statistics and length metadata.

score = sigmoid(w0 + <w, x> + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)): every pair of inputs
interacts through a low rank, at the cost of the linear model. Words are hashed, so that a vocabulary never
has to be gathered. It is learnt on at most MAX_LABELLED labelled rows, chosen by a hash of doc_id, and
scores every document in one pass over the texts, without a shuffle.

Defined cases: a null text counts as empty, and an empty text is scored like any other; rows repeat as they
come; of repeated labels the smallest counts, a null label does not. Without labels of both kinds the score is
the share of ones (or 1.0 where nothing is labelled). doc_id, lang, source and labels are never inputs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from pavilion.llm.common import map_rows

WORD_BUCKETS = 8192
RANK = 8
# Bound on the labelled rows that are learnt from; they are the only rows that reach the driver.
MAX_LABELLED = 6000
EPOCHS = 12
BATCH = 128
# Steps at least, so that few labels are gone over more often.
STEPS = 400
LEARNING_RATE = 0.05
DECAY = 1e-4
THRESHOLD = 0.3
# doc_ids whose crc32 leaves this remainder are held out and never learnt from.
FOLDS, HELD_OUT = 5, 0
SYMBOLS = b"#*$%&|<>!"
STRUCTURE = 15


def held_out(doc_id="doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == HELD_OUT


def structure(raw: bytes, words: list[bytes]) -> list[float]:
    """Statistics of form, most of them shares in 0..1; an empty text has zeros."""
    n, size = len(words), len(raw)
    if not n:
        return [0.0] * STRUCTURE
    lines = [line for line in raw.split(b"\n") if line.strip()]
    letters = sum(len(w) for w in words)
    counts = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    upper = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    lower = len(raw) - len(raw.translate(None, b"abcdefghijklmnopqrstuvwxyz"))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    return [
        1.0,
        np.log1p(size) / 10,  # length metadata
        np.log1p(n) / 10,
        np.log1p(len(lines)) / 10,
        letters / n / 20,
        upper / max(upper + lower, 1),
        min(symbols / n, 3.0),
        min(raw.count(b"!!") / n, 1.0),
        min(raw.count(b" | ") / n, 1.0),
        (raw.count(b".") + raw.count(b",")) / n,
        len(counts) / n,
        max(counts.values()) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        len(set(lines)) / max(len(lines), 1),
        sum(w.isdigit() for w in words) / n,
    ]


def features(text: str | None, buckets=WORD_BUCKETS):
    """(word buckets, their weights, structure); the weights have length one."""
    raw = (text or "").encode()
    words = raw.split()
    counts = np.bincount([zlib.crc32(w) % buckets for w in raw.lower().split()], minlength=buckets) if words else np.zeros(buckets)
    at = np.flatnonzero(counts)
    weights = np.log1p(counts[at])
    norm = np.sqrt((weights**2).sum()) or 1.0
    return at, weights / norm, structure(raw, words)


def raw_scores(x: np.ndarray, model) -> np.ndarray:
    """The sum-of-squares identity gives all pairs in time linear in the inputs."""
    bias, linear, factors = model
    sums = x @ factors
    squares = (x * x) @ (factors * factors)
    return bias + x @ linear + 0.5 * (sums * sums - squares).sum(axis=1)


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, rank=RANK, epochs=EPOCHS, batch=BATCH, rate=LEARNING_RATE, decay=DECAY, seed=7):
    """Adagrad on the log loss, from the share of ones."""
    rng = np.random.default_rng(seed)
    n, width = x.shape
    ones = y.mean()
    prior = float(np.log(ones / (1 - ones)))
    model = [prior, np.zeros(width, np.float32), rng.normal(0, 0.02, (width, rank)).astype(np.float32)]
    sums = [1e-6, np.full(width, 1e-6, np.float32), np.full((width, rank), 1e-6, np.float32)]
    for _ in range(max(epochs, -(-STEPS // -(-n // batch)))):
        order = rng.permutation(n)
        for start in range(0, n, batch):
            rows = order[start : start + batch]
            xb = x[rows]
            error = (sigmoid(raw_scores(xb, model)) - y[rows]).astype(np.float32) / len(rows)
            factors = model[2]
            pair = xb.T @ (error[:, None] * (xb @ factors)) - factors * ((xb * xb).T @ error)[:, None]
            steps = [float(error.sum()), xb.T @ error + decay * model[1], pair + decay * factors]
            for i, step in enumerate(steps):
                sums[i] = sums[i] + step * step
                model[i] = model[i] - rate * step / np.sqrt(sums[i])
    return model


def dense(rows, buckets=WORD_BUCKETS) -> np.ndarray:
    x = np.zeros((len(rows), buckets + STRUCTURE), np.float32)
    for i, (at, weights, form) in enumerate(rows):
        x[i, at] = weights
        x[i, buckets:] = form
    return x


class Sparse:
    """Learnt rows as they are collected; only the batch at hand is laid out in full."""

    def __init__(self, rows, buckets=WORD_BUCKETS):
        self.rows, self.shape = rows, (len(rows), buckets + STRUCTURE)

    def __getitem__(self, some) -> np.ndarray:
        return dense([self.rows[i] for i in some], self.shape[1] - STRUCTURE)


def in_order(rows) -> list:
    """By id, quality and buckets; as bytes from the highest down, these compare like the numbers."""
    return sorted(rows, key=lambda r: (r.id, r.quality, np.frombuffer(r["at"], "<i4").astype(">i4").tobytes()))


def train(docs: DataFrame, labels: DataFrame, max_labelled=MAX_LABELLED):
    """A model from at most max_labelled labelled rows outside the held-out fold, or the share of ones alone."""
    known = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    learnt = known.filter(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    learnt = learnt.select(F.col("doc_id").alias("__id"), F.col("quality").cast("int").alias("__quality"))
    texts = docs.select(F.col("doc_id").alias("__id"), "text")
    # At most max_labelled rows of two numbers: bounded by the parameter.
    rows = texts.join(F.broadcast(learnt), "__id").select("__id", "__quality", "text")

    def factory():
        def made(doc_id, quality, text):
            at, weights, form = features(text)
            return doc_id, quality, at.astype("<i4").tobytes(), weights.astype("<f4").tobytes(), np.array(form, "<f4").tobytes()

        return made

    shaped = map_rows(rows, factory, "id long, quality int, at binary, weights binary, form binary").limit(max_labelled)
    found = in_order(shaped.collect())
    y = np.array([r.quality for r in found], np.float32)
    if not len(y) or y.min() == y.max():
        return float(y.mean()) if len(y) else 1.0
    return fit(Sparse([(np.frombuffer(r["at"], "<i4"), np.frombuffer(r.weights, "<f4"), np.frombuffer(r.form, "<f4")) for r in found]), y)


def score(docs: DataFrame, model, threshold=THRESHOLD) -> DataFrame:
    """The given columns and __score, one pass over the texts."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = shared.value
        for texts in batches:
            out = np.empty(len(texts))
            for start in range(0, len(texts), BATCH):
                part = [features(t) for t in texts.iloc[start : start + BATCH]]
                constant = isinstance(known, float)
                out[start : start + BATCH] = known if constant else sigmoid(raw_scores(dense(part), known).astype(float))
            yield pd.Series(out)

    return docs.withColumn("__score", scored(F.col("text")))


def classify(docs: DataFrame, labels: DataFrame, max_labelled=MAX_LABELLED, threshold=THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    rows = score(docs.select("doc_id", "text"), train(docs, labels, max_labelled))
    return rows.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        F.col("__score").alias("score"),
        (F.col("__score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, max_labelled=MAX_LABELLED, threshold=THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject, with their own columns."""
    rows = score(docs, train(docs, labels, max_labelled))
    return rows.filter(F.col("__score") >= threshold).select(*[F.col(f"`{c}`") for c in docs.columns])
