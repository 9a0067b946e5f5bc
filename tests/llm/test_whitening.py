import numpy as np
import pytest

from corpusloom.llm import spectrum, whitening
from corpusloom.llm.registry import op11_embedding_whitening

SCHEMA = "vec_id bigint, embedding array<double>"


def made(values, seed=0):
    """A symmetric matrix with the given eigenvalues."""
    turn, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values),) * 2))
    return turn @ np.diag(values) @ turn.T


MATRICES = {
    "spread": made(np.linspace(1, 40, 40)),
    "close": made(1 + np.arange(30) * 1e-7),
    "equal": made([3.0] * 5 + [1.0] * 10),
    "two equal": made([9.0, 5.0, 5.0, 4.0, 1.0, 0.5]),
    "no rank": made([2.0, 1.0] + [0.0] * 20),
    "axes": np.diag([1.0, 4.0, 2.0, 3.0]),
    "zeros": np.zeros((4, 4)),
    "one": np.array([[7.0]]),
    "tiny": made(np.geomspace(1e-14, 1e-9, 20)),
    "huge": made(np.geomspace(1, 1e12, 20)),
    "swap": np.array([[0.0, 1.0], [1.0, 0.0]]),
    "negative": made([-5.0, -1.0, 2.0, 3.0, -2.0]),
}


@pytest.mark.parametrize("name", MATRICES)
def test_leading_pairs(name):
    matrix = MATRICES[name]
    want = np.linalg.eigvalsh(matrix)[::-1]
    values, axes = spectrum.leading_pairs(matrix, 8)
    scale = max(np.abs(want).max(), 1e-300)
    assert np.allclose(values, want[:8], atol=1e-13 * scale, rtol=0)
    assert np.abs(axes @ axes.T - np.eye(len(axes))).max() < 1e-12
    assert np.abs(matrix @ axes.T - axes.T * values).max() <= 1e-13 * scale


def test_counts_of_shifted_matrices():
    matrix = MATRICES["spread"]
    for shift in (-1, 0.5, 1.5, 17.3, 39.99, 41):
        assert spectrum.count_above(matrix, shift) == (np.linspace(1, 40, 40) > shift).sum()


def test_solve():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 40):
        a = rng.standard_normal((n, n))
        a, b = a + a.T, rng.standard_normal(n)
        assert np.allclose(a @ spectrum.Factors(a).solve(b), b)


def brute(vectors, most=8):
    """n, exact deviations, whitened coordinates and shares, straight from the definition."""
    x = np.array([[int(np.floor(1024 * float(c))) + 100000 for c in v] for v in vectors], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    deviation = [sum(int(d) ** 2 for d in n * row - sums) for row in x]
    z = ((n * x - sums) / n).astype(float)
    values, axes = np.linalg.eigh(z.T @ z / n)
    values, axes = values[::-1][:most], axes[:, ::-1][:, :most]
    return n, deviation, z @ axes / np.sqrt(values), values / np.trace(z.T @ z / n)


def usable(rows):
    return [(k, v) for k, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]


def test_equals_definition(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.standard_normal(12) * np.geomspace(0.05, 2, 12)).tolist()) for i in range(300)]
    rows += [(7, rows[7][1]), (None, rows[3][1]), (400, None), (401, [0.1] * 11 + [None]), (402, [float("nan")] * 12),
             (403, [1.0] * 11 + [float("-inf")]), (404, [0.5] * 3), (405, [])]
    docs = spark.createDataFrame([(k, v, 1, "x") for k, v in rows], SCHEMA + ", n int, component string")
    got = whitening.whiten(docs, most=8).collect()
    kept = [(k, v) for k, v in usable(rows) if len(v) == 12]
    n, deviation, white, share = brute([v for _, v in kept])
    assert len(got) == 8 * len(kept)
    assert {r["n"] for r in got} == {n}
    assert {r["identity_error"] < 1e-9 for r in got} == {True}
    keyed = sorted((str(k), d) for (k, _), d in zip(kept, deviation))
    assert sorted((str(r["vec_id"]), r["deviation"]) for r in got if r["component"] == 3) == keyed
    for c in range(8):
        mine = sorted(abs(r["whitened"]) for r in got if r["component"] == c + 1)
        assert np.allclose(mine, sorted(abs(white[:, c])), atol=1e-9)
        assert np.allclose([r["explained"] for r in got if r["component"] == c + 1], share[c], rtol=1e-10)
        by_key = {r["vec_id"]: r["whitened"] for r in got if r["component"] == c + 1}
        assert abs(np.corrcoef([by_key[i] for i in range(300)], white[:300, c])[0, 1]) > 1 - 1e-9


def test_small_tables(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], SCHEMA)).count() == 0
    same = whitening.whiten(spark.createDataFrame([(1, [0.5, 2.0]), (2, [0.5, 2.0])], SCHEMA)).collect()
    assert [(r["component"], r["whitened"], r["explained"], r["deviation"]) for r in same] == [
        (1, None, None, 0), (2, None, None, 0)] * 2
    line = whitening.whiten(spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 1.0])], SCHEMA)).collect()
    assert sorted((r["component"], r["whitened"] and round(abs(r["whitened"]), 12)) for r in line) == [
        (1, 1.0), (1, 1.0), (2, None), (2, None)]


def test_numbers_beyond_a_long(spark):
    rows = [(i, [float(1 << 40) * (i % 3), 1.0]) for i in range(9)] + [(9, [1e300, 0.0])]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["vec_id"] for r in got} == set(range(9))
    assert {r["vec_id"] for r in got if r["deviation"] is None} == {i for i in range(9) if i % 3 != 1}


def test_floats_and_the_registered_query(spark):
    got = op11_embedding_whitening(spark, "/root/testdata/sf0.001").collect()
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    n, deviation, white, share = brute([r["embedding"] for r in vectors])
    want = {(r["vec_id"], c + 1): (n, d, w[c], share[c]) for r, d, w in zip(vectors, deviation, white) for c in range(8)}
    assert len(got) == len(want)
    for r in got:
        n, d, w, s = want[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"]) == (n, d)
        assert abs(abs(r["whitened"]) - abs(w)) < 1e-9 and abs(r["explained"] - s) < 1e-12
