import zlib

import numpy as np
from pavilion.llm import quality_fm


def test_sum_of_squares_identity():
    rng = np.random.default_rng(1)
    x, linear, factors = rng.normal(size=(5, 7)), rng.normal(size=7), rng.normal(size=(7, 3))
    got = quality_fm.raw_scores(x, (0.5, linear, factors))
    for row, score in zip(x, got):
        pairs = sum(factors[i] @ factors[j] * row[i] * row[j] for i in range(7) for j in range(i + 1, 7))
        assert abs(0.5 + row @ linear + pairs - score) < 1e-9


def test_held_out_rows(spark, more_labels):
    docs, labels = (spark.read.parquet(f"{more_labels}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_fm.classify(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 40 and sum(r.predicted == r.quality for r in held) >= 0.93 * len(held)


def test_labels_lang_and_source_do_not_count(spark, more_labels):
    docs, labels = (spark.read.parquet(f"{more_labels}/{t}.parquet") for t in ("documents", "labels"))
    held = quality_fm.held_out()
    told = labels.withColumn("quality", 1 - labels.quality).filter(held).union(labels.filter(~held).select("doc_id", "quality", "toxic").toDF("doc_id", "quality", "toxic").select(*labels.columns))
    a = {r.doc_id: r.score for r in quality_fm.classify(docs, labels).collect()}
    b = {r.doc_id: r.score for r in quality_fm.classify(docs.drop("lang", "source", "n_chars"), told).collect()}
    assert a == b


def test_small_cases(spark):
    rows = [(1, None, "x"), (2, "", None), (2, "", None), (None, "words here", "y"), (3, "é \x00 " * 5000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    ones = spark.createDataFrame([(1, 1), (3, 1), (3, None), (None, 0)], "doc_id long, quality int")
    for labels in (none, ones):
        got = quality_fm.classify(docs, labels).collect()
        assert len(got) == 5 and all(r.score == 1.0 and r.predicted == 1 for r in got)
        kept = quality_fm.keep_good(docs, labels)
        assert kept.columns == docs.columns and kept.count() == 5
    assert quality_fm.classify(docs.limit(0), ones).count() == 0
    mixed = spark.createDataFrame([(2, 0), (1, 1), (3, 1), (4, 1)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in quality_fm.classify(docs, mixed).collect())


def test_order_of_learnt_rows():
    """Rows of one id are told apart by their buckets as numbers, without a list of these for each row."""
    import tracemalloc

    from pyspark.sql import Row

    rng = np.random.default_rng(5)
    many = [np.flatnonzero(rng.random(quality_fm.WORD_BUCKETS) < 0.05).astype("<i4") for _ in range(2000)]
    many += [many[0][:n] for n in (0, 3, 2, 200)] + [np.array(a, "<i4") for a in ([1], [256], [255, 1], [65536], [2, 9], [2])]
    rows = [Row(id=i % 7, quality=i % 2, at=at.tobytes()) for i, at in enumerate(many)]
    want = sorted(rows, key=lambda r: (r.id, r.quality, np.frombuffer(r["at"], "<i4").tolist()))
    tracemalloc.start()
    got = quality_fm.in_order(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == want and peak < 2 * sum(len(r["at"]) for r in rows)
