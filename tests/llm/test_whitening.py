import math

import numpy as np
import pytest

from meterline.llm import queries, whitening

SF = "/root/testdata/sf0.001"
KIND = "vec_id long, embedding array<float>"


def brute(vectors, k=32):
    """n, sums, x and (eigenvalue, vector) by falling eigenvalue, from the covariance itself."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(col) for col in zip(*x)]
    centred = np.array([[(n * c - s) for c, s in zip(row, sums)] for row in x], float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)
    return n, sums, x, centred, values[order], axes[:, order], values.sum()


def check(found, ids, vectors, k=32):
    n, sums, x, centred, values, axes, trace = brute(vectors)
    rank = min(k, int((values > 1e-9 * values[0]).sum()))
    white = np.full((len(ids), rank), np.nan)
    place = {v: i for i, v in enumerate(ids)}
    assert len(found) == len(ids) * rank
    for r in found:
        i, c = place[r["vec_id"]], r["component"] - 1
        white[i, c] = r["whitened"]
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert r["deviation"] == sum((n * a - s) ** 2 for a, s in zip(x[i], sums))
        assert abs(r["explained"] / (values[c] / trace) - 1) < 1e-9
    assert np.abs(white.T @ white / n - np.eye(rank)).max() < 1e-9
    # The same directions, but for their signs and turns among equal eigenvalues.
    raw = white * np.sqrt(values[:rank])
    first = 0
    for last in range(1, rank + 1):
        if last < rank and values[last - 1] - values[last] < 1e-7 * values[last - 1]:
            continue
        if last == rank and rank < len(values) and values[rank - 1] - values[rank] < 1e-7 * values[rank]:
            break
        own = centred @ axes[:, first:last]
        assert np.allclose(raw[:, first:last] @ raw[:, first:last].T, own @ own.T, atol=1e-6)
        first = last


def test_query_on_given_vectors(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    found = queries.op13_whitening(spark, SF).collect()
    check(found, [r[0] for r in rows], [r[1] for r in rows])


@pytest.mark.parametrize("tasks", [1, 3, 40])
def test_many_tasks_with_few_rows(spark, tasks):
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(90, 12)) * np.arange(1, 13)).astype(np.float32).tolist()
    df = spark.createDataFrame(list(enumerate(vectors)), KIND).repartition(tasks)
    check(whitening.whiten(df).collect(), list(range(90)), vectors)


def test_equal_eigenvalues_and_missing_dimensions(spark):
    base = np.vstack([np.eye(6), -np.eye(6)]) * 4
    vectors = np.hstack([base, np.zeros((12, 2)), base[:, :1] * 2]).tolist()
    df = spark.createDataFrame(list(enumerate(vectors)), KIND)
    check(whitening.whiten(df).collect(), list(range(12)), vectors)


def test_components_are_cut(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(200, 50)).astype(np.float32).tolist()
    df = spark.createDataFrame(list(enumerate(vectors)), KIND).repartition(4)
    check(whitening.whiten(df).collect(), list(range(200)), vectors)
    assert {r["component"] for r in whitening.whiten(df, 5).collect()} == {1, 2, 3, 4, 5}


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    good = [[1.0, 2.0], [3.0, -1.5], [0.25, 7.0], [1.0, 2.0]]
    other = [[1.0, 2.0, 3.0], [2.0, 1.0, 0.5]]
    rows = [(1, good[0]), (2, good[1]), (None, good[2]), (1, good[3]), (20, other[0]), (21, other[1]),
            (5, None), (6, []), (7, [1.0, None]), (8, [inf, 1.0]), (9, [1.0, nan]), (10, [1e30, 1.0]),
            (11, [4.0] * 4)]
    df = spark.createDataFrame([(*r, 1, 0.5) for r in rows], KIND + ", n int, whitened double")
    found = whitening.whiten(df).collect()
    two = [r for r in found if r["vec_id"] in (1, 2, None)]
    assert len(two) == 8 and {r["n"] for r in two} == {4}
    assert sorted(str(r["vec_id"]) for r in two) == sorted(["1", "1", "2", "None"] * 2)
    assert sorted((r["vec_id"], r["component"]) for r in found if r not in two) == [(20, 1), (21, 1)]
    assert max(r["identity_error"] for r in found) < 1e-9
    assert whitening.whiten(df.where("vec_id = 11")).count() == 0
    assert whitening.whiten(df.where("vec_id = 5")).count() == 0


def test_large_entries_are_counted_exactly(spark):
    vectors = [[2.0**40, 1.0], [-(2.0**40), 3.0], [2.0**39, 8.0]]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id int, embedding array<double>")
    found = whitening.whiten(df).collect()
    assert {r["deviation"] for r in found} == {None}
    assert max(r["identity_error"] for r in found) < 1e-6
    vectors = [[2.0**22, 1.0], [-(2.0**22), 3.0], [2.0**21, 8.0]]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id int, embedding array<double>")
    _, sums, x, *_ = brute(vectors)
    for r in whitening.whiten(df).collect():
        assert r["deviation"] == sum((3 * a - s) ** 2 for a, s in zip(x[r["vec_id"]], sums))


def test_solver():
    rng = np.random.default_rng(0)
    turn = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    spectra = [np.r_[np.ones(20), np.full(20, 0.5)], np.r_[np.ones(5), np.zeros(35)],
               1 + 1e-9 * np.arange(40), np.linspace(1, 1e-6, 40), 10.0 ** -np.arange(40)]
    forms = [np.linalg.qr((turn.T[::-1] * s) @ turn, mode="r") for s in spectra]
    # Pairs of values that agree to the last digit although nothing falls apart.
    forms.append(np.diag(np.abs(np.arange(21) - 10) + 1.0) + np.diag(np.full(20, 1e-5), 1))
    forms += [np.round(rng.normal(size=(n, n))) for n in range(1, 12) for _ in range(10)]
    # Zeros on the diagonal of the bidiagonal form, with values beside them.
    forms += [np.diag(d) + np.diag(u, 1) for d, u in (([1, 0, 0, 0, 0.0], [2, 1, 1, 1]),
              ([0, 1, 0, 3, 0.0], [1, 2, 2, 1]), ([1, 1e-9, 1, 1e-13, 1.0], [1, 1, 1, 1]))]
    forms += [np.zeros((3, 3)), np.eye(9), np.ones((4, 4))]
    for r in forms:
        values, vectors = whitening.right_vectors(r, len(r))
        want = np.linalg.svd(r, compute_uv=False)
        assert np.allclose(values, want[: len(values)], rtol=1e-9, atol=1e-14 * want[0])
        assert (want[len(values) :] <= 1e-12 * max(want[0], 1)).all()
        assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-9)
        assert np.abs(r.T @ (r @ vectors) - vectors * values**2).max(initial=0) <= 1e-10 * want[0] ** 2
