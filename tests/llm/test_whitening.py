"""Whitening against the dense eigenproblem in one process."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemill.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def dense(vectors, k=4):
    """(n, sums, values, vectors, trace) of the distinct integer vectors."""
    x = np.unique(np.floor(256 * np.asarray(vectors, np.float32).astype(np.float64)).astype(np.int64), axis=0)
    centred = x - x.mean(axis=0)
    values, turn = np.linalg.eigh(centred.T @ centred / len(x))
    return len(x), x.sum(axis=0), values[::-1][:k], turn[:, ::-1][:, :k], values.sum()


def table(spark, vectors, ids=None):
    rows = [(i, v if v is None else [None if c is None else float(c) for c in v], 0) for i, v in zip(ids or range(len(vectors)), vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def check(found, model, vectors, tolerance=1e-8):
    n, sums, values, turn, trace = dense(vectors)
    assert (model.n, model.sums) == (n, sums.tolist())
    assert np.allclose(model.values, values, rtol=1e-10) and np.allclose(model.explained, values / trace, rtol=1e-10)
    assert np.abs(np.abs((turn * model.vectors).sum(axis=0)) - 1).max() < tolerance
    assert model.identity_error < 1e-9
    x = np.floor(256 * np.asarray(vectors, np.float32).astype(np.float64)).astype(np.int64)
    sign = np.sign((turn * model.vectors).sum(axis=0))
    expect = (x - sums / n) @ (turn * sign) / np.sqrt(values)
    for r in found:
        i = r.vec_id
        assert r.deviation == sum((n * int(v) - int(s)) ** 2 for v, s in zip(x[i], sums))
        assert np.allclose(r.whitened, expect[i], atol=1e-7)


@pytest.mark.parametrize(("n", "d", "seed"), [(300, 40, 1), (500, 5, 2), (60, 90, 3), (400, 16, 4)])
def test_whitening_equals_the_dense_eigenproblem(spark, n, d, seed):
    draw = np.random.default_rng(seed)
    vectors = draw.standard_normal((n, d)) @ np.diag(1 / np.arange(1, d + 1) ** 0.5)
    vectors[: n // 3] = vectors[0]  # a hot vector counts once
    docs = table(spark, vectors.tolist()).repartition(3)
    rows = whitening.integers(docs)
    model = whitening.fit(rows)
    found = whitening.whiten(rows, model).collect()
    assert len(found) == n
    check(found, model, vectors)


def test_a_flat_spectrum_widens_the_block(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ROUNDS", 1)
    monkeypatch.setattr(whitening, "EXTRA", 1)
    vectors = np.random.default_rng(5).standard_normal((200, 30))
    rows = whitening.integers(table(spark, vectors.tolist()))
    model = whitening.fit(rows)
    check(whitening.whiten(rows, model).collect(), model, vectors)


def test_awkward_rows(spark):
    base = [[1.0, 2.0, 0.5], [0.25, -1.0, 3.0], [2.0, 0.0, 1.0], [5.0, 1.0, -2.0]]
    odd = [None, [None, 1.0, 2.0], [float("nan"), 1.0, 1.0], [float("inf"), 0.0, 0.0], [1.0], [], [-0.0, 0.0, 0.0], [0.0, 0.0, 0.0]]
    docs = table(spark, [*base, *odd, base[0]], [*range(12), None])
    docs = docs.withColumn("x", F.lit("clash")).withColumn("v", F.lit(1)).withColumn("place", F.lit(2))
    rows = whitening.integers(docs)
    model = whitening.fit(rows)
    found = {r.vec_id: r for r in whitening.whiten(rows, model).collect()}
    assert set(found) == {0, 1, 2, 3, 10, 11, None} and model.n == 5
    assert found[10].whitened == found[11].whitened and found[None].whitened == found[0].whitened
    assert len(found[0].whitened) == 3


def test_huge_entries_are_held_and_exact(spark):
    docs = table(spark, [[1e30, 0.0], [-1e30, 1.0], [0.5, 2.0], [2e10, 3.0]])
    rows = whitening.integers(docs)
    model = whitening.fit(rows)
    found = {r.vec_id: r.deviation for r in whitening.whiten(rows, model).collect()}
    assert found[0] is None and model.n == 4
    assert model.sums[0] == (2**63 - 1024) - 2**63 + 128 + 256 * int(np.float32(2e10))


def test_no_variance_and_no_rows(spark):
    same = whitening.integers(table(spark, [[1.0, 2.0]] * 5))
    model = whitening.fit(same)
    assert model.n == 1 and [(r.deviation, r.whitened) for r in whitening.whiten(same, model).collect()] == [(0, [])] * 5
    for vectors in ([], [None], [[]]):
        rows = whitening.integers(table(spark, vectors) if vectors else spark.createDataFrame([], SCHEMA))
        assert [r.whitened for r in whitening.whiten(rows, whitening.fit(rows)).collect()] == [[]] * (vectors == [[]])


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    rows = queries.op11_chebyshev_whitening(spark, small).collect()
    n, sums, values, turn, trace = dense([d.embedding for d in docs])
    assert len(rows) == 4 * len(docs)
    white = {(r.vec_id, r.component): r for r in rows}
    x = {d.vec_id: np.floor(256 * np.array(d.embedding)) for d in docs}
    for (i, c), r in white.items():
        assert abs(abs(r.whitened) - abs((x[i] - sums / n) @ turn[:, c - 1] / np.sqrt(values[c - 1]))) < 1e-7
        assert abs(r.explained / (values[c - 1] / trace) - 1) < 1e-9 and r.identity_error < 1e-9 and r.n == n
