"""Whitening against the definition in plain integers, clustered eigenvalues, odd vectors."""

import math

import numpy as np
import pytest

from tickspark.llm import whitening as W

SF001 = "/root/testdata/sf0.001"


def _checked(a, values, vectors):
    """Residual and orthogonality of an eigenbasis, relative to the matrix."""
    size = np.abs(a).max()
    assert np.abs(a @ vectors - vectors * values).max() <= 1e-14 * size * len(a)
    assert np.abs(vectors.T @ vectors - np.eye(len(a))).max() <= 1e-14
    assert np.all(np.diff(values) <= 1e-15 * size * len(a))


def _with_spectrum(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))[0]
    return (q * np.asarray(values, float)) @ q.T


@pytest.mark.parametrize("values", [
    np.arange(1, 65.0), 2.0 ** -np.arange(40), np.ones(30), np.r_[np.ones(10), 1 + 1e-7 * np.arange(10), 5, 7],
    np.r_[1 + 1e-10 * np.arange(12), 0.5 + 1e-13 * np.arange(6), 1e-3], np.r_[np.zeros(5), 3, 3, 3, 9], [4.0],
    np.r_[1e9, 1e9 + 1e-2, 1.0, 1.0 + 1e-6]])
def test_refined_eigenvectors_are_double_precision(values):
    a = _with_spectrum(values)
    a = (a + a.T) / 2
    got, x = W.refined_eigen(a)
    _checked(a, got, x)
    assert np.abs(got - np.linalg.eigvalsh(a)[::-1]).max() <= 1e-14 * np.abs(a).max() * len(a)


def test_refinement_beats_its_start():
    a = _with_spectrum(np.r_[1 + 1e-5 * np.arange(20), 0.1])
    start = np.linalg.eigh(a.astype(np.float32))[1].astype(float)
    off = start.T @ a @ start
    assert np.abs(off - np.diag(np.diag(off))).max() > 1e-9
    _, x = W.refined_eigen(a)
    off = x.T @ a @ x
    assert np.abs(off - np.diag(np.diag(off))).max() < 1e-14


def test_zero_and_empty_matrices():
    assert W.refined_eigen(np.zeros((3, 3)))[0].tolist() == [0, 0, 0]
    assert W.refined_eigen(np.zeros((0, 0)))[1].shape == (0, 0)


def _by_definition(vectors):
    x = [[math.floor(64 * v) + 1_000_000 for v in vec] for vec in vectors]
    n, s = len(x), [sum(col) for col in zip(*x)]
    centred = np.array([[(n * v - t) for v, t in zip(row, s)] for row in x], object)
    cov = np.array([[sum(a * b for a, b in zip(p, q)) / n**3 for q in centred.T] for p in centred.T], float)
    return n, [sum(int(v) ** 2 for v in row) for row in centred], cov, centred.astype(float) / n


def _queried(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n int").repartition(3)
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    return W.op12_whitening(spark, str(tmp_path)).collect()


def _compared(got, vectors, ids):
    n, deviation, cov, centred = _by_definition(vectors)
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1], basis[:, ::-1]
    k = min(32, int((values > values[0] * len(values) * 1e-14).sum()))
    assert len(got) == len(ids) * k
    table = {(r.vec_id, r.component): r for r in got}
    want = centred @ basis[:, :k] / np.sqrt(values[:k])
    for c in range(k):
        mine = np.array([table[i, c + 1].whitened for i in ids])
        sign = np.sign((mine * want[:, c]).sum())
        assert np.abs(mine - sign * want[:, c]).max() < 1e-6
        assert table[ids[0], c + 1].explained == pytest.approx(values[c] / np.trace(cov), rel=1e-9)
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1
    assert got[0].identity_error < 1e-9
    assert [table[i, 1].deviation for i in ids] == deviation


def test_query_follows_the_definition(spark, tmp_path):
    rng = np.random.default_rng(3)
    v = (rng.normal(size=(80, 6)) @ rng.normal(size=(6, 6))).astype(np.float32)
    rows = [(i, [float(e) for e in row], 9) for i, row in enumerate(v)]
    odd = [(900, None, 1), (901, [1.0] * 5 + [None], 1), (902, [float("nan")] * 6, 1), (903, [float("inf")] * 6, 1),
           (904, [1.0, 2.0], 1), (905, [], 1), (906, [1e30] * 6, 1)]
    _compared(_queried(spark, tmp_path, rows + odd), v.astype(float), list(range(80)))


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SF001}/embeddings.parquet").orderBy("vec_id").collect()
    good = [r for r in rows if r.embedding and all(e is not None and math.isfinite(e) for e in r.embedding)]
    _compared(W.op12_whitening(spark, SF001).collect(), [r.embedding for r in good], [r.vec_id for r in good])


def test_no_variance_and_no_rows(spark, tmp_path):
    assert _queried(spark, tmp_path / "one", [(1, [1.0, 2.0], 0)]) == []
    assert _queried(spark, tmp_path / "same", [(i, [1.0, 2.0], 0) for i in range(5)]) == []
    assert _queried(spark, tmp_path / "none", []) == []
    assert _queried(spark, tmp_path / "nulls", [(1, None, 0)]) == []
    flat = _queried(spark, tmp_path / "flat", [(i, [float(i % 4), 7.0, -float(i % 4)], 0) for i in range(9)])
    assert {r.component for r in flat} == {1} and len(flat) == 9   # one direction has variance


def test_repeated_rows_and_ids_count_each_time(spark, tmp_path):
    rows = [(1, [0.0, 1.0], 0), (1, [0.0, 1.0], 0), (None, [2.0, 0.5], 0), (2, [3.0, -1.0], 0)]
    got = _queried(spark, tmp_path, rows)
    assert len(got) == 8 and {r.n for r in got} == {4} and sum(r.vec_id is None for r in got) == 2


def test_model_does_not_depend_on_partitions(spark):
    df = spark.read.parquet(f"{SF001}/embeddings.parquet").selectExpr(
        "vec_id", "transform(embedding, v -> cast(floor(v * 64) as long)) as x")
    one, many = W.fit_whitening(df.coalesce(1), "x"), W.fit_whitening(df.repartition(70), "x")
    assert one.sums == many.sums and np.array_equal(one.vectors, many.vectors) and np.array_equal(one.values, many.values)


def test_apply_keeps_other_columns(spark):
    df = spark.createDataFrame([(float(i), [float(i), float(i * i)], "a") for i in range(6)], "`x.y` double, v array<double>, whitened string")
    out = W.fit_whitening(df, "v").apply(df)
    assert out.columns == ["x.y", "v", "whitened"]
    w = np.array([r.whitened for r in out.collect()])
    assert np.abs(np.cov(w.T, bias=True) - np.eye(2)).max() < 1e-12
