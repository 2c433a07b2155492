import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pavilion.llm import importance

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LONG = "the quick Brown fox, jumps over 12 lazy dogs; " * 4
ROWS = [
    (1, LONG), (2, None), (3, ""), (4, " .,;\n"), (5, LONG + "ünïcode 日本 x" * 30), (6, LONG * 200), (7, LONG), (7, LONG),
    (7, "another text of the same id " * 5), (None, LONG), (None, LONG), (8, "few words"), (9, "a " * 5000),
]
TARGET = ["Lazy dogs jump over the fox", None, "日本 12", ""]


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def runs(text, run):
    w = words(text)
    return [" ".join(w[i : i + n]) for n in range(1, run + 1) for i in range(len(w) - n + 1)]


def brute(rows, target, buckets=10_000, run=1, percent=10, min_words=20):
    def of(text):
        return [zlib.crc32(f.encode()) % buckets for f in runs(text, run)]

    source, wanted = Counter(b for _, t in rows for b in of(t)), Counter(b for t in target for b in of(t))
    all_s, all_t = sum(source.values()), sum(wanted.values())

    def gain(b):
        return math.floor(1000 * math.log((wanted[b] + 1) * (all_s + buckets) / ((source[b] + 1) * (all_t + buckets))))

    made = []
    for doc_id, text in rows:
        found = of(text)
        weight = sum(map(gain, found)) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        made.append([doc_id, len(found), weight, score, None, len(words(text))])
    enough = sorted((r for r in made if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, row in enumerate(enough[: len(enough) * percent // 100], 1):
        row[4] = place
    return sorted((tuple(r[:5]) for r in made), key=str)


def frames(spark, rows, target):
    docs = spark.createDataFrame([(*r, 3, "x") for r in rows], "doc_id long, text string, n_features int, rank string")
    return docs, spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(target)], "item_id int, text string, weight double")


@pytest.mark.parametrize("how", [{}, {"buckets": 70, "run": 3, "percent": 60, "min_words": 2}, {"buckets": 1, "percent": 100}])
def test_against_brute_force(spark, how):
    docs, target = frames(spark, ROWS, TARGET)
    got = importance.resample(docs, target, **how).select("doc_id", "n_features", "weight", "score", "rank").collect()
    want = brute(ROWS, TARGET, **how)
    # Rows of one id and score may take each other's ranks.
    assert sorted(map(str, (tuple(r)[:4] for r in got))) == sorted(str(r[:4]) for r in want)
    assert sorted(str((r.doc_id, r.score, r["rank"])) for r in got) == sorted(str((r[0], r[3], r[4])) for r in want)


def test_empty_tables(spark):
    docs, target = frames(spark, ROWS, TARGET)
    assert importance.resample(docs.limit(0), target).collect() == []
    some = importance.resample(docs, target.limit(0)).collect()
    assert len(some) == len(ROWS)
    assert {tuple(r)[:5] for r in importance.resample(docs.filter("text is null"), target.limit(0)).drop("n_words").collect()} == {(2, 0, 0, some_score(2), None)}


def some_score(doc_id):
    return brute([(doc_id, None)], [])[0][3]


def test_plane_sums_are_exact():
    rng = np.random.default_rng(1)
    for buckets in (1, 63, 64, 65, 10_000):
        gain = rng.integers(-20_000, 20_000, buckets)
        found = [rng.integers(0, buckets, n) ** 2 % buckets for n in (0, 1, 7, 3000, 100_000)]
        got = importance.gain_sums(found, importance.signed_planes(gain), buckets)
        assert got.tolist() == [int(gain[b].sum()) for b in found]
    assert importance.gain_sums([], [], 5).tolist() == []


def test_whole_table(spark, sf_dir):
    docs, target = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    got = importance.resample(docs, target).drop("n_words").collect()
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])
    assert sorted(map(tuple, got), key=str) == want


def test_sample_keeps_the_columns(spark):
    docs, target = frames(spark, ROWS, TARGET)
    drawn = importance.sample(docs, target, percent=50)
    assert drawn.columns == docs.columns and drawn.count() == 4
    assert {r.text for r in drawn.collect()} <= {t for _, t in ROWS}
