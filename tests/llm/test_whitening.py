"""Whitening: spectral divide-and-conquer against a library decomposition, the query against a plain version, hard rows."""

import math
from collections import Counter

import numpy as np
import pytest

from ventaria.llm import whitening as W

SCHEMA = "vec_id long, embedding array<double>, label int, x string, component int, n long"


def spread(rng, values):
    basis = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    return basis @ np.diag(values) @ basis.T


SPECTRA = {
    "one": [3.0], "falling": 1.0 / np.arange(1, 41), "wide": np.logspace(0, -14, 30), "equal": np.ones(12), "clusters": np.repeat([5.0, 5 + 1e-9, 1.0], 6),
    "rank one": [1e6] + [0.0] * 20, "zeros": np.zeros(5), "both signs": np.linspace(-3, 3, 25), "two": [2.0, 1.0], "pairs": np.repeat(np.arange(1.0, 9), 2),
    "close": 1 + np.arange(16) * 1e-7, "middle": [1.0, 0.0, -1.0],
}


@pytest.mark.parametrize("name", SPECTRA)
def test_eigenvectors(name):
    matrix = spread(np.random.default_rng(len(name)), np.array(SPECTRA[name]))
    matrix = (matrix + matrix.T) / 2
    values, vectors = W.eigen(matrix)
    scale = max(1e-300, np.linalg.norm(matrix))
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1], atol=1e-13 * scale)
    assert np.linalg.norm(vectors.T @ vectors - np.eye(len(values))) < 1e-12
    assert np.linalg.norm(matrix @ vectors - vectors * values) <= 2e-13 * scale * len(values)


def test_diagonal_matrix():
    values, vectors = W.eigen(np.diag([1.0, 4.0, 2.0, 4.0]))
    assert np.allclose(values, [4, 4, 2, 1]) and np.allclose(np.abs(vectors[:, 3]), [1, 0, 0, 0])


def test_polar_factor_is_the_sign():
    matrix = spread(np.random.default_rng(1), np.array([2.0, 1e-9, -1e-12, -7.0]))
    sign = W.polar_factor((matrix + matrix.T) / 2)
    assert np.allclose(sign @ sign, np.eye(4), atol=1e-13) and round(np.trace(sign)) == 0


def plain(rows, components=16):
    good = [(i, [math.floor(64.0 * c) + 1_000_000 for c in v]) for i, v in rows
            if v is not None and v and all(c is not None and math.isfinite(c) and abs(c) < 2 ** 54 for c in v)]
    lengths = Counter(len(x) for _, x in good)
    d = max(lengths, key=lambda k: (lengths[k], k))
    good = [(i, x) for i, x in good if len(x) == d]
    listed = sorted({tuple(x) for _, x in good})
    n, sums = len(listed), [sum(c) for c in zip(*listed)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for x in listed])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    made = []
    for i, x in good:
        apart = [n * c - s for c, s in zip(x, sums)]
        for k in range(min(components, d)):
            made.append((i, k + 1, n, sum(a * a for a in apart), abs(np.array(apart) / n @ vectors[:, k]) / math.sqrt(values[k]), values[k] / values.sum()))
    return made


def told(df):
    return [(r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in df.collect()]


def same(found, wanted):
    key = lambda r: (str(r[0]), r[1], r[3], round(r[4], 6))
    found, wanted = sorted(found, key=key), sorted(wanted, key=key)
    assert [r[:4] for r in found] == [r[:4] for r in wanted]
    assert np.allclose([r[4:] for r in found], [r[4:] for r in wanted], rtol=1e-7, atol=1e-8)


def test_whole_table(spark, small):
    table = spark.read.parquet(f"{small}/embeddings.parquet")
    made = W.op13_whitening(spark, small)
    same(told(made), plain([(r.vec_id, list(r.embedding)) for r in table.select("vec_id", "embedding").collect()]))
    assert {r.identity_error < 1e-9 for r in made.select("identity_error").distinct().collect()} == {True}


def test_hard_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in rng.standard_normal(5) * [9, 5, 3, 2, 1]]) for i in range(40)]
    rows += [rows[3], rows[3], (3, rows[4][1]), (None, rows[5][1]), (None, None), (90, None), (91, []), (92, [1.0, None, 2.0, 3.0, 4.0]), (93, [float("nan")] * 5),
             (94, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (95, [1e300, 0.0, 0.0, 0.0, 0.0]), (96, [1.0, 2.0]), (97, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0])]
    df = spark.createDataFrame([(i, v, 1, "clash", 7, 8) for i, v in rows], SCHEMA)
    same(told(W.whiten(df)), plain(rows))


def test_no_variance(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 0, "", 0, 0), (2, [1.0, 2.0], 0, "", 0, 0)], SCHEMA)
    assert [(r.n, r.deviation, r.whitened, r.identity_error) for r in W.whiten(df).collect()] == [(1, 0, None, None)] * 4
    flat = spark.createDataFrame([(k, [float(k), 5.0, 2.0 * k], 0, "", 0, 0) for k in range(9)], SCHEMA)
    rows = W.whiten(flat).where("vec_id = 0").orderBy("component").collect()
    assert rows[0].whitened is not None and [r.whitened for r in rows[1:]] == [None, None] and rows[0].identity_error < 1e-9


def test_numbers_beyond_a_long(spark):
    df = spark.createDataFrame([(k, [float(2 ** (20 * k)), 1.0 * k], 0, "", 0, 0) for k in range(1, 3)], SCHEMA)
    assert {r.deviation for r in W.whiten(df).collect()} == {None}


def test_empty_table(spark):
    assert W.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert W.whiten(spark.createDataFrame([(1, None, 0, "", 0, 0)], SCHEMA)).count() == 0
