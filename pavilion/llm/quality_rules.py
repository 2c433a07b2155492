"""Quality rules: fixed rules over document statistics, then gradient-boosted trees over the same statistics.

The trees are grown on histograms with monotonic constraints: more symbols, repeats or doubled lines never raise a
score. A forest is flattened into node arrays (feature, threshold, left, right, value), and a batch of
documents walks all trees at once, a level at a step.

The trees are learnt on at most MAX_LABELLED labelled rows, chosen by a hash of doc_id; statistics cover every whole
text. Defined cases: a null text has no words; a text without words fails the fixed rules; rows repeat as they come; of repeated
labels the smallest counts, a null one does not; without labels of both kinds the trees keep everything.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from collections.abc import Iterator
from pyspark.sql import DataFrame, functions as F

from pavilion.llm.common import map_rows
from pavilion.session import materialize

# Fixed values of the rules.
SPACES = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"
MIN_WORDS, WINDOW, MAX_REPEAT_PERCENT = 50, 3, 50
# Bound on the labelled rows that are learnt from; they are the only rows that reach the driver.
MAX_LABELLED = 20_000
TREES, DEPTH, BINS, RATE, L2, MIN_ROWS = 60, 4, 64, 0.2, 1.0, 10
THRESHOLD = 0.3
# Inputs of the trees, and the direction in which each may move a score: -1 never up, 1 never down, 0 either way.
DIRECTIONS = {
    "symbols_per_word": -1, "repeat_share": -1, "dup_line_share": -1, "top_word_share": -1, "doubled_share": -1,
    "upper_share": -1, "bang_share": -1, "bar_share": -1, "distinct_share": 1, "mean_word": 0, "mean_line": 0,
    "log_words": 0, "stop_share": 0,
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeat_words(words: list[bytes]) -> int:
    """Words within windows of WINDOW words that occur twice or more in the text."""
    n = len(words)
    if n <= WINDOW:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    starts = n - WINDOW + 1
    # Windows are numbered pair by pair, so that numbers stay exact for texts of any length.
    code = ids[:starts]
    for k in range(1, WINDOW):
        _, code = np.unique(code, return_inverse=True)
        code = code.astype(np.int64) * len(known) + ids[k : k + starts]
    _, code, counts = np.unique(code, return_inverse=True, return_counts=True)
    again = counts[code] > 1
    covered = np.zeros(n, bool)
    for k in range(WINDOW):
        covered[k : k + starts] |= again
    return int(covered.sum())


def base(text: str | None):
    """(words, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)"""
    text = text or ""
    words = text.encode().split()
    chars = len(text) - sum(text.count(c) for c in SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    seen, doubled = set(), 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            if line in seen:
                doubled += 1
            seen.add(line)
    return words, len(words), chars, symbols, doubled, repeat_words(words)


def statistics(text: str | None) -> tuple:
    """The base counts as long, then the trees' inputs as one array of double."""
    words, n, chars, symbols, doubled, repeats = base(text)
    if not n:
        return (0, 0, symbols, 0, 0, [0.0] * len(DIRECTIONS))
    raw = text.encode()
    lines = text.count("\n") + 1
    counts: dict[bytes, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    upper = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    lower = len(raw) - len(raw.translate(None, b"abcdefghijklmnopqrstuvwxyz"))
    inputs = [
        symbols / n, repeats / n, doubled / lines, max(counts.values()) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n, upper / max(upper + lower, 1), text.count("!") / n,
        text.count("|") / n, len(counts) / n, chars / n, n / lines, float(np.log1p(n)),
        sum(c for w, c in counts.items() if len(w) <= 3) / n,
    ]
    return n, chars, symbols, doubled, repeats, inputs


def measure(docs: DataFrame, keys=("doc_id",)) -> DataFrame:
    """The key columns, the base counts and __inputs of every text, in one pass."""

    def factory():
        return lambda text, *key: (*key, *statistics(text))

    schema = ", ".join([f"`{k}` long" for k in keys] + [f"{c} long" for c in BASE]) + ", __inputs array<double>"
    return map_rows(docs.select("text", *keys), factory, schema)


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


# --- trees


class Forest:
    """All trees in one set of node arrays; a leaf leads to itself."""

    def __init__(self, bias: float):
        self.bias, self.roots = bias, []
        self.feature, self.threshold, self.left, self.right, self.value = [], [], [], [], []

    def leaf(self, value: float) -> int:
        at = len(self.value)
        for column, v in zip((self.feature, self.threshold, self.left, self.right, self.value), (0, np.inf, at, at, value)):
            column.append(v)
        return at

    def flat(self):
        return tuple(np.array(c) for c in (self.roots, self.feature, self.threshold, self.left, self.right, self.value))


def score(x: np.ndarray, bias: float, flat, depth=DEPTH) -> np.ndarray:
    roots, feature, threshold, left, right, value = flat
    if not len(roots):
        return np.full(len(x), 1 / (1 + np.exp(-bias)))
    at = np.broadcast_to(roots, (len(x), len(roots))).copy()
    rows = np.arange(len(x))[:, None]
    for _ in range(depth):
        at = np.where(x[rows, feature[at]] <= threshold[at], left[at], right[at])
    return 1 / (1 + np.exp(-np.clip(bias + value[at].sum(axis=1), -30, 30)))


def _best_split(binned, grad, hess, rows, directions, low, high):
    """(gain, feature, bin, left value, right value) of the best split that keeps to its direction and bounds."""
    g, h = grad[rows], hess[rows]
    total_g, total_h = g.sum(), h.sum()
    best = None
    for f, direction in enumerate(directions):
        bins = binned[rows, f]
        gl = np.cumsum(np.bincount(bins, g, BINS))[:-1]
        hl = np.cumsum(np.bincount(bins, h, BINS))[:-1]
        nl = np.cumsum(np.bincount(bins, minlength=BINS))[:-1]
        vl = np.clip(-gl / (hl + L2), low, high)
        vr = np.clip(-(total_g - gl) / (total_h - hl + L2), low, high)
        fits = (nl >= MIN_ROWS) & (len(rows) - nl >= MIN_ROWS) & (direction * (vr - vl) >= 0)
        if not fits.any():
            continue
        # What the clipped values gain on the second-order loss.
        gain = -(gl * vl + 0.5 * (hl + L2) * vl**2) - ((total_g - gl) * vr + 0.5 * (total_h - hl + L2) * vr**2)
        gain = np.where(fits, gain, -np.inf)
        b = int(gain.argmax())
        if best is None or gain[b] > best[0]:
            best = (float(gain[b]), f, b, float(vl[b]), float(vr[b]))
    value = float(np.clip(-total_g / (total_h + L2), low, high))
    own = -(total_g * value + 0.5 * (total_h + L2) * value**2)
    return (best, value) if best and best[0] > own + 1e-9 else (None, value)


def grow(x: np.ndarray, y: np.ndarray, directions, trees=TREES, depth=DEPTH, rate=RATE) -> tuple[float, tuple]:
    """(bias, node arrays) of a forest for the log loss."""
    mean = float(np.clip(y.mean(), 1e-6, 1 - 1e-6))
    forest = Forest(float(np.log(mean / (1 - mean))))
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T)], axis=1)
    margin = np.full(len(y), forest.bias)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-6)

        def node(rows, level, low, high):
            best, value = _best_split(binned, grad, hess, rows, directions, low, high) if level < depth else (None, None)
            if best is None:
                if value is None:
                    value = float(np.clip(-grad[rows].sum() / (hess[rows].sum() + L2), low, high))
                margin[rows] += rate * value
                return forest.leaf(rate * value)
            _, f, b, vl, vr = best
            at = forest.leaf(0.0)
            goes = binned[rows, f] <= b
            middle = (vl + vr) / 2
            # A constrained split bounds all leaves below, so that the whole tree keeps to the direction.
            bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}.get(directions[f], ((low, high),) * 2)
            left = node(rows[goes], level + 1, *bounds[0])
            right = node(rows[~goes], level + 1, *bounds[1])
            forest.feature[at], forest.threshold[at] = f, float(edges[f][b])
            forest.left[at], forest.right[at] = left, right
            return at

        forest.roots.append(node(np.arange(len(y)), 0, -np.inf, np.inf))
    return forest.bias, forest.flat()


def train(measured: DataFrame, labels: DataFrame, max_labelled=MAX_LABELLED):
    """(bias, node arrays) from at most max_labelled labelled rows."""
    known = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("__quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled).withColumnRenamed("doc_id", "__id")
    rows = measured.select("doc_id", "__inputs").join(chosen, F.col("doc_id") == F.col("__id"))
    # Of documents that share an id one is learnt from, whichever way the rows come: as many rows as chosen labels at most.
    rows = rows.groupBy("doc_id").agg(F.min("__inputs").alias("__inputs"), F.min("__quality").cast("int").alias("q"))
    found = sorted(rows.collect())
    y = np.array([r.q for r in found], float)
    if not len(y) or y.min() == y.max():
        return 10.0 if not len(y) or y.min() else -10.0, tuple(np.zeros(0, int) for _ in range(6))
    return grow(np.array([r["__inputs"] for r in found]), y, list(DIRECTIONS.values()))


def judge(docs: DataFrame, labels: DataFrame, max_labelled=MAX_LABELLED, threshold=THRESHOLD) -> DataFrame:
    """doc_id, n_words, the base counts, base_failed, quality (the trees' score) and kept of every row."""
    measured = materialize(measure(docs), "statistics")
    shared = docs.sparkSession.sparkContext.broadcast(train(measured, labels, max_labelled))

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bias, flat = shared.value
        for inputs in batches:
            x = np.stack(inputs.to_numpy()) if len(inputs) else np.zeros((0, len(DIRECTIONS)))
            yield pd.Series(score(x, bias, flat))

    rows = measured.withColumn("quality", scored("__inputs")).withColumn("base_failed", base_failed())
    return rows.select(
        "doc_id", *BASE, "base_failed", (~F.col("base_failed") & (F.col("quality") >= threshold)).alias("kept"), "quality"
    )
