"""Importance resampling towards a target: documents are weighed by hashed word runs and drawn with their weights.

Runs of 1 to RUN consecutive words are hashed into BUCKETS buckets. A bucket's gain is the logarithm of its share among the
target's features over its share among all documents', times SCALE, as a whole number. A document's weight is the mean gain of its
features, rounded down. Drawing without replacement by weight is taking the highest of weight plus noise, whose noise follows
from a hash of doc_id.

The weights are bit-sliced sums. A document's bucket counts become planes of BUCKETS bits, plane p holding bit p of every
count; the gains become planes of their magnitudes' bits, apart by sign. The sum over buckets of count times gain is the sum over
pairs of planes of 2^(p+q) times the number of bits that both have set, so it is exact, whatever the order.

Texts are tokenised twice, once for the buckets' totals and once for the weights, so that no counts are written. Of a task only
its BUCKETS totals leave it; BUCKETS gains go to the tasks.

Defined cases: a null or empty text has no features and weight 0; rows repeat as they come, and equal rows take one rank each; a
null doc_id is hashed as an empty text and comes after all others of its score; without documents or target every total is 0.
Columns besides doc_id and text are only read if they are to be carried along.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pavilion.llm.common import SLICE, id_or_last
from pavilion.operators.ordinals import row_numbers
from pavilion.session import materialize

BUCKETS, RUN, SCALE, SEED = 10_000, 1, 1000, 2024
MIN_WORDS, PERCENT = 20, 10

# Bytes of words as they are, capitals lower-cased, all others as a space; above 127 every byte belongs to a word.
_LETTERS = b"0123456789abcdefghijklmnopqrstuvwxyz"
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or c in _LETTERS else 32 for c in range(256))


def features(text: str | None, run: int) -> tuple[int, list[bytes]]:
    """The number of words, and the features of a text."""
    words = (text or "").encode().translate(_WORDS).split()
    runs = list(words)
    for size in range(2, run + 1):
        runs += [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
    return len(words), runs


def buckets_of(runs: list[bytes], buckets: int) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, runs), np.int64, len(runs)) % buckets


def bucket_totals(docs: DataFrame, buckets=BUCKETS, run=RUN) -> DataFrame:
    """bucket, n: how many features of all texts fall into each bucket that has any."""

    def count(batches):
        totals = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                totals += np.bincount(buckets_of(features(text.as_py(), run)[1], buckets), minlength=buckets)
        (some,) = totals.nonzero()
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(totals[some])], names=["bucket", "n"])

    rows = docs.select("text").mapInArrow(count, "bucket long, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of every bucket from its totals in all documents and in the target."""
    buckets = len(source)
    all_source, all_target = float(source.sum() + buckets), float(target.sum() + buckets)
    ratios = ((t + 1.0) * all_source / ((s + 1.0) * all_target) for s, t in zip(source.tolist(), target.tolist()))
    return np.array([math.floor(SCALE * math.log(r)) for r in ratios], np.int64)


def bit_planes(rows: np.ndarray, places: np.ndarray, n_rows: int, buckets: int) -> np.ndarray:
    """A row of bits, as 64-bit words, for each of n_rows, set at the given places."""
    bits = np.zeros((n_rows, -(-buckets // 64) * 64), np.uint8)
    bits[rows, places] = 1
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


def signed_planes(gain: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(power of two with its sign, the buckets whose gain has that bit), without empty planes."""
    planes = []
    for sign in (1, -1):
        size = np.where(gain * sign > 0, np.abs(gain), 0)
        for q in range(int(size.max(initial=0)).bit_length()):
            (places,) = (size >> q & 1).nonzero()
            if len(places):
                planes.append((sign << q, bit_planes(np.zeros(len(places), np.int64), places, 1, len(gain))[0]))
    return planes


def gain_sums(found: list[np.ndarray], planes: list[tuple[int, np.ndarray]], buckets: int) -> np.ndarray:
    """The sum of gains over each document's buckets, repeats included."""
    sums = np.zeros(len(found), np.int64)
    # An empty array keeps the type where no document has any.
    at = np.concatenate([np.zeros(0, np.int64), *[i * buckets + b for i, b in enumerate(found)]])
    cells, counts = np.unique(at, return_counts=True)
    rows, places = cells // buckets, cells % buckets
    for p in range(int(counts.max(initial=0)).bit_length()):
        here = (counts >> p & 1).astype(bool)
        some, row = np.unique(rows[here], return_inverse=True)
        of_counts = bit_planes(row, places[here], len(some), buckets)
        for power, of_gain in planes:
            sums[some] += (power << p) * np.bitwise_count(of_counts & of_gain).sum(axis=1, dtype=np.int64)
    return sums


def weights(docs: DataFrame, target: DataFrame, buckets=BUCKETS, run=RUN, carry=()) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row of docs(doc_id, text), with the columns to be carried along."""

    def totals(texts):
        found = np.zeros(buckets, np.int64)
        for row in bucket_totals(texts, buckets, run).collect():  # as many rows as there are buckets
            found[row.bucket] = row.n
        return found

    gain = docs.sparkSession.sparkContext.broadcast(gains(totals(docs), totals(target)))

    def weigh(batches):
        planes = signed_planes(gain.value)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                sizes, found = [], []
                for text in part.column(1):
                    n_words, runs = features(text.as_py(), run)
                    sizes.append(n_words)
                    found.append(buckets_of(runs, buckets))
                n = np.array([len(b) for b in found], np.int64)
                # Whole-number division of numpy goes down.
                weight = np.where(n > 0, gain_sums(found, planes, buckets) // np.maximum(n, 1), 0)
                made = [part.column(0), pa.array(sizes, pa.int64()), pa.array(n), pa.array(weight), *part.columns[2:]]
                yield pa.RecordBatch.from_arrays(made, names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carry)
    names = ["doc_id", "n_words", "n_features", "weight", *carry]
    carried = "".join(f", `{c}` {rows.schema[c].dataType.simpleString()}" for c in carry)
    return rows.mapInArrow(weigh, f"doc_id long, n_words long, n_features long, weight long{carried}")


def noise(seed: int = SEED):
    """A fixed draw of the extreme-value law per doc_id, times SCALE, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-SCALE * F.ln(-F.ln((h + 0.5) / 4294967296))).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent=PERCENT, min_words=MIN_WORDS, buckets=BUCKETS, run=RUN, seed=SEED, carry=()):
    """weights(), with score and the rank of the rows drawn: of those with at least min_words words, percent of a hundred.

    The scored rows are written before they are ranked, by ranges of the score, so no task has all of them.
    """
    scored = weights(docs, target, buckets, run, carry).withColumn("score", F.col("weight") + noise(seed))
    # Tells equal rows apart, so that any number of them can be cut into ranges.
    scored = materialize(scored.withColumn("__row", F.monotonically_increasing_id()), "scores")
    enough = F.col("n_words") >= min_words
    drawn = scored.filter(enough).count() * percent // 100
    order = [F.desc("score"), "__last", "__row"]
    ranked = row_numbers(scored.filter(enough).withColumn("__last", id_or_last()), [], order, "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.filter(~enough).withColumn("rank", F.lit(None).cast("long"))
    columns = ["doc_id", "n_words", "n_features", "weight", "score", "rank", *carry]
    return ranked.select(*columns).union(rest.select(*columns))


def sample(docs: DataFrame, target: DataFrame, **how) -> DataFrame:
    """The drawn rows of docs with all their columns."""
    others = [c for c in docs.columns if c != "doc_id"]
    hidden = {c: f"__own_{i}" for i, c in enumerate(others)}
    rows = docs.select("doc_id", "text", *[F.col(c).alias(h) for c, h in hidden.items()])
    drawn = resample(rows, target, carry=tuple(hidden.values()), **how).filter("rank is not null")
    return drawn.select(*[F.col(hidden.get(c, c)).alias(c) for c in docs.columns])
