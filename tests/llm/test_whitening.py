import math
from fractions import Fraction

import numpy as np
import pytest
from pavilion.llm import whitening

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, x string, n int, label int"


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, "x", 5, 1) for i, v in rows], SCHEMA.replace("float", kind))


def exact(rows):
    """Kept rows as whole vectors, sums and covariance of the distinct ones, in fractions."""
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(x) for _, x in kept), default=0)
    kept = [(i, tuple(x + [0] * (width - len(x)))) for i, x in kept]
    fit = sorted(set(x for _, x in kept))
    sums = [sum(c) for c in zip(*fit)]
    centred = [[Fraction(c) - Fraction(s, len(fit)) for c, s in zip(x, sums)] for x in fit]
    matrix = [[sum(r[i] * r[j] for r in centred) / len(fit) for j in range(width)] for i in range(width)]
    return kept, fit, sums, matrix


def assert_whitened(got, rows):
    kept, fit, sums, matrix = exact(rows)
    n, v = len(fit), np.array(matrix, float)
    k = min(4, len(v))
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:k], vectors.T[::-1][:k]
    want = [
        (i, c + 1, n, sum((n * a - s) ** 2 for a, s in zip(x, sums)), values[c] / np.trace(v), abs(sum((a - s / n) * e for a, s, e in zip(x, sums, vectors[c]))) / math.sqrt(values[c]))
        for i, x in kept for c in range(k)
    ]
    rows = sorted(((r.vec_id, r.component, r.n, r.deviation, r.explained, abs(r.whitened)) for r in got), key=str)
    want = sorted(want, key=str)
    assert [r[:4] for r in rows] == [w[:4] for w in want]
    assert np.allclose([r[4:] for r in rows], [w[4:] for w in want], rtol=1e-6, atol=1e-9)
    assert {r.identity_error for r in got} and all(r.identity_error <= 1e-4 for r in got)
    # One sign for all rows of a component.
    for c in range(k):
        signs = {round(np.sign(r.whitened * sum((a - s / n) * e for a, s, e in zip(dict(kept)[r.vec_id], sums, vectors[c])))) for r in got if r.component == c + 1 and abs(r.whitened) > 1e-6 and r.vec_id is not None}
        assert len(signs) == 1


def random_rows(n=300, width=7, seed=1):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(n, width)) @ rng.normal(size=(width, width)) + rng.normal(size=width) * 5
    return [(i, [float(c) for c in v]) for i, v in enumerate(mixed.astype("f4"))]


def test_against_fractions(spark):
    rows = random_rows()
    rows += [rows[0]] * 50 + [(1000, rows[1][1]), (None, rows[2][1]), (7000, None), (7001, [None] * 7), (7002, [NAN] * 7), (7003, [1.0] * 6 + [INF]), (7004, [-0.0] * 7)]
    assert_whitened(whitening.whiten(frame(spark, rows)).collect(), rows)


def test_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    assert_whitened(whitening.whiten(table).collect(), [(r.vec_id, r.embedding) for r in table.collect()])


def test_short_vectors_end_in_zeros(spark):
    rows = random_rows(60, 3) + [(i, [0.5 * i]) for i in range(100, 110)] + [(200, [])]
    assert_whitened(whitening.whiten(frame(spark, rows)).collect(), rows)


def test_no_variance(spark):
    got = whitening.whiten(frame(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).collect()
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {(1, 0, 0.0, 0.0, 0.0)} and len(got) == 4
    line = whitening.whiten(frame(spark, [(i, [float(i), 2.0 * i]) for i in range(9)])).collect()
    assert [r.whitened for r in line if r.component == 2] == [0.0] * 9
    assert max(r.identity_error for r in line) < 1e-9 and line[0].explained == pytest.approx(1)


def test_nothing_to_fit(spark):
    rows = frame(spark, [(1, None), (2, [NAN])])
    for df in (rows, rows.limit(0), frame(spark, [(1, [])])):
        assert whitening.whiten(df).collect() == []


@pytest.mark.parametrize("unit", [1e6, 1e13, 1e18])
def test_large_entries_stay_exact(spark, unit):
    rows = [(i, [float(c) * unit for c in v]) for i, v in random_rows(40, 3, seed=5)]
    kept, fit, sums, matrix = exact([(i, [max(-(2.0**63) / 256, min(c, (2.0**63 - 1025) / 256)) for c in v]) for i, v in rows])
    table = whitening.whole_vectors(frame(spark, rows, "double")).select("x").distinct()
    mean = whitening.means(table)
    if unit < 1e17:
        assert mean.sums == sums
        got = whitening.covariance(mean, whitening.pair_squares(table, mean))
        assert got.tolist() == [[float(c) for c in row] for row in matrix]
    assert len(whitening.whiten(frame(spark, rows, "double")).collect()) == 120
