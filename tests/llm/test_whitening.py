"""Whitening by spectrum slicing, against exact fractions and a dense eigensolver."""

from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from depthbook.llm import spectrum_whitening as sw

SPECTRA = {
    "plain": np.linspace(9, 0.5, 40),
    "repeated": np.r_[np.full(6, 5.0), np.full(34, 1.0)],
    "close": np.r_[5, 5 - 1e-9, 5 - 2e-9, 4, 4 - 1e-13, np.linspace(3, 1, 35)],
    "flat": np.r_[np.linspace(9, 1, 10), np.zeros(30)],
    "one": np.array([3.0]),
}


@pytest.mark.parametrize("name", SPECTRA)
def test_leading_pairs(name):
    rng, values = np.random.default_rng(1), SPECTRA[name]
    turn = np.linalg.qr(rng.standard_normal((len(values),) * 2))[0]
    matrix = turn @ np.diag(values) @ turn.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = sw.leading(matrix, 32)
    assert len(found) == min(32, int((values > 1e-9).sum()))
    assert np.allclose(found, np.sort(np.linalg.eigvalsh(matrix))[::-1][: len(found)], atol=1e-13)
    assert np.allclose(vectors.T @ vectors, np.eye(len(found)), atol=1e-13)
    assert np.allclose(matrix @ vectors, vectors * found, atol=1e-12)


def test_counts_are_those_of_the_spectrum():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 17):
        for _ in range(20):
            matrix = np.round(rng.standard_normal((n, n)) * 3)
            matrix = matrix + matrix.T
            np.fill_diagonal(matrix, 0)  # single pivots alone would divide by zero
            values = np.linalg.eigvalsh(matrix)
            for shift in rng.uniform(-9, 9, 5):
                assert sw.count_above(matrix, shift) == (values > shift).sum()
    parts = sw.slices(np.diag([5.0, 5.0, 3.0, 1.0]), 3)
    assert [(p.first, p.last) for p in parts] == [(1, 2), (3, 3)]


def brute(rows):
    """(n, deviations, covariance, x) with exact fractions."""
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in rows]
    n, total = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, total, strict=True)) for v in x]
    centred = [[Fraction(n * c - s, n) for c, s in zip(v, total, strict=True)] for v in x]
    matrix = [[float(sum(v[i] * v[j] for v in centred) / n) for j in range(len(total))] for i in range(len(total))]
    return n, deviation, np.array(matrix), np.array([[float(c) for c in v] for v in centred])


def check(frame, rows, components):
    n, deviation, matrix, centred = brute([v for _, v in rows])
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1], vectors[:, ::-1]
    got = defaultdict(list)
    for r in frame.collect():
        got[r["component"]].append(r)
    assert sorted(got) == list(range(1, components + 1))
    for k, found in got.items():
        assert {r["n"] for r in found} == {n}
        assert sorted((r["vec_id"], r["deviation"]) for r in found) == sorted(
            (i, d) for (i, _), d in zip(rows, deviation, strict=True)
        )
        assert np.allclose([r["explained"] for r in found], values[k - 1] / np.trace(matrix), rtol=1e-12)
        want = centred @ vectors[:, k - 1] / np.sqrt(values[k - 1])
        by_id = sorted((r["vec_id"], r["whitened"]) for r in found)
        plain = sorted((i, w) for (i, _), w in zip(rows, want, strict=True))
        mirrored = sorted((i, -w) for (i, _), w in zip(rows, want, strict=True))
        assert any(np.allclose([w for _, w in by_id], [w for _, w in side], atol=1e-9) for side in (plain, mirrored))
        assert max(r["identity_error"] for r in found) < 1e-9
        assert len({r["identity_error"] for r in found}) == 1


def query(spark, tmp_path, rows, schema="vec_id long, embedding array<float>, label int, z long, component string"):
    spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], schema).write.parquet(f"{tmp_path}/embeddings.parquet")
    return sw.op11_spectrum_whitening(spark, str(tmp_path))


def test_query_op11_equals_fractions(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(i // 2, [float(c) for c in rng.standard_normal(7) * [1, 2, 3, 4, 5, 6, 7]]) for i in range(120)]
    rows += rows[:5]  # equal rows count each
    bad = [(900, None), (901, [1.0, None] + [0.0] * 5), (902, [float("nan")] + [0.0] * 6), (903, [float("-inf")] * 7), (904, [])]
    check(query(spark, tmp_path, rows + bad), [(i, np.float32(v)) for i, v in rows], 7)


def test_whitening_of_given_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    check(sw.op11_spectrum_whitening(spark, "/root/testdata/sf0.001"), rows, 32)


def test_large_entries_stay_exact(spark, tmp_path):
    """Products beyond 2**53 go through whole numbers; deviations beyond a long are decimals."""
    rows = [(1, [1e9, 2.0]), (2, [-3e9, 5.0]), (None, [7e8, -4.5])]
    frame = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<double>")
    vectors = sw.whole_vectors(frame)
    fitted = sw.fit(vectors)
    n, deviation, matrix, _ = brute([v for _, v in rows])
    assert np.array_equal(sw.covariance(vectors, fitted.sums), matrix)
    assert {(r["vec_id"], int(r["deviation"])) for r in sw.whitened(vectors, fitted).collect()} == {
        (i, d) for (i, _), d in zip(rows, deviation, strict=True)
    }


def test_nothing_to_whiten(spark, tmp_path):
    empty = query(spark, tmp_path / "a", [])
    assert empty.count() == 0 and empty.columns == sw.op11_spectrum_whitening(spark, "/root/testdata/sf0.001").columns
    assert query(spark, tmp_path / "b", [(1, None), (2, [])]).count() == 0
    assert query(spark, tmp_path / "c", [(1, [1.0, 2.0]), (2, [1.0, 2.0])]).count() == 0  # no direction to scale
    flat = query(spark, tmp_path / "d", [(1, [1.0, 2.0]), (None, [1.0, 3.0]), (1, [1.0, 2.0])])
    assert {r["component"] for r in flat.collect()} == {1}


def test_refused_vectors(spark):
    for rows in ([(1, [1.0]), (2, [1.0, 2.0])], [(1, [1e30])]):
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        with pytest.raises(Exception, match="different lengths|an entry beyond"):
            sw.fit(sw.whole_vectors(frame))
