import collections
import re

import numpy as np
from pavilion.llm import quality_rules
from pyspark.sql import functions as F


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts, covered = collections.Counter(windows), set()
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered |= {i, i + 1, i + 2}
    seen, doubled = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            doubled += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), doubled, len(covered)


ROWS = [(1, None), (2, ""), (3, " \n\n"), (4, "a b c a b c a b c"), (4, "a b"), (5, "x\nx\n x\nx\n\n"), (6, "é\u00a0ü #|< " * 60), (None, "w1 w2 w3\x0bw4 " * 40)]


def test_counts(spark, sf_dir):
    docs = spark.createDataFrame([(*r, 1) for r in ROWS], "doc_id long, text string, n_words int")
    labels = spark.createDataFrame([(1, 1), (4, 0), (4, 1), (None, 1), (6, None)], "doc_id long, quality int")
    whole = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for table, known in ((docs, labels), (whole, spark.read.parquet(f"{sf_dir}/labels.parquet"))):
        got = quality_rules.judge(table, known).collect()
        rows = [(r.doc_id, r.text) for r in table.collect()]
        assert sorted(((r.doc_id, *(r[c] for c in quality_rules.BASE)) for r in got), key=str) == sorted(((i, *brute(t)) for i, t in rows), key=str)
        for r in got:
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert not (r.kept and r.base_failed)


def test_held_out_accuracy(spark, more_labels):
    docs, labels = (spark.read.parquet(f"{more_labels}/{t}.parquet") for t in ("documents", "labels"))
    train, test = labels.filter("doc_id % 5 <> 0"), labels.filter("doc_id % 5 = 0")
    rows = quality_rules.judge(docs, train).join(test, "doc_id").filter("not base_failed").collect()
    right = sum(r.kept == bool(r.quality) for r in rows)
    assert len(rows) > 30 and right >= 0.9 * len(rows)


def test_forest_is_monotonic_and_flat():
    rng = np.random.default_rng(3)
    x = rng.random((600, 3))
    y = (x[:, 0] + rng.normal(0, 0.3, 600) < 0.5).astype(float)
    bias, flat = quality_rules.grow(x, y, [-1, 1, 0])
    grid = np.linspace(0, 1, 50)
    for other in rng.random((20, 2)):
        first = np.column_stack([grid, np.tile(other, (50, 1))])
        second = np.column_stack([np.full(50, other[0]), grid, np.full(50, other[1])])
        assert (np.diff(quality_rules.score(first, bias, flat)) <= 1e-12).all()
        assert (np.diff(quality_rules.score(second, bias, flat)) >= -1e-12).all()
    assert ((quality_rules.score(x, bias, flat) >= 0.5) == y).mean() > 0.75
    # Walked tree by tree, node by node, the arrays give the same scores.
    roots, feature, threshold, left, right, value = flat
    for row, s in zip(x[:30], quality_rules.score(x[:30], bias, flat)):
        total = bias
        for at in roots:
            while left[at] != at:
                at = left[at] if row[feature[at]] <= threshold[at] else right[at]
            total += value[at]
        assert abs(1 / (1 + np.exp(-total)) - s) < 1e-9


def test_without_labels_the_rules_decide(spark):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(60))), (2, "short")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.doc_id: r.kept for r in quality_rules.judge(docs, none).collect()} == {1: True, 2: False}


def test_kept_against_a_plain_walk(spark, more_labels):
    """Every tree walked node by node for every document, and learning that does not hang on the order of repeated ids."""
    docs, labels = (spark.read.parquet(f"{more_labels}/{t}.parquet") for t in ("documents", "labels"))
    measured = quality_rules.measure(docs)
    bias, flat = quality_rules.train(measured, labels)
    roots, feature, threshold, left, right, value = (c.tolist() for c in flat)

    def walked(x):
        total = bias
        for at in roots:
            while left[at] != at:
                at = left[at] if x[feature[at]] <= threshold[at] else right[at]
            total += value[at]
        return 1 / (1 + np.exp(-total)) >= quality_rules.THRESHOLD

    want = sorted((r.doc_id, bool(walked(r["__inputs"]))) for r in measured.collect())
    got = sorted((r.doc_id, r.kept) for r in quality_rules.judge(docs, labels).collect() if not r.base_failed)
    passed = {doc for doc, _ in got}
    assert got == [w for w in want if w[0] in passed] and len({kept for _, kept in got}) == 2
    twice = measured.union(measured.filter("doc_id % 2 = 0").withColumn("__inputs", F.transform("__inputs", lambda v: v + 1)))
    for a, b in zip(quality_rules.train(twice.repartition(3), labels, 50)[1], quality_rules.train(twice.repartition(5), labels, 50)[1]):
        assert a.tolist() == b.tolist()
