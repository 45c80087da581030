"""FEAST whitening: plain eigenvectors, exact sums, spectra that are hard to cut, odd rows."""

import numpy as np
import pytest

from saldo.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>"


def frame(spark, vectors, first=0):
    return spark.createDataFrame([(first + k, [float(c) for c in v]) for k, v in enumerate(vectors)], SCHEMA)


def plain(vectors, k=8):
    """Components, exact deviations and whitened rows by hand."""
    x = [[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v] for v in vectors]
    n, s = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - b) ** 2 for a, b in zip(row, s)) for row in x]
    centred = np.array([[(n * a - b) / n for a, b in zip(row, s)] for row in x])
    v = centred.T @ centred / n
    values, vectors_ = np.linalg.eigh(v)
    values, vectors_ = values[::-1][:k], vectors_[:, ::-1][:, :k]
    return deviation, values / np.trace(v), centred @ vectors_ / np.sqrt(values)


def grid(rows, k):
    rows = sorted(rows, key=lambda r: (r.vec_id, r.component))
    return np.array([r.whitened for r in rows]).reshape(-1, k)


def aligned(got, want):
    return got * np.sign((got * want).sum(axis=0))


def test_query_equals_plain_eigenvectors(spark, small):
    table = queries.table(spark, small, "embeddings").orderBy("vec_id").collect()
    rows = queries.op11_feast_whitening(spark, small).collect()
    deviation, explained, whitened = plain([r.embedding for r in table])
    assert len(rows) == 8 * len(table) and {r.n for r in rows} == {len(table)}
    assert {(r.vec_id, r.deviation) for r in rows} == {(t.vec_id, d) for t, d in zip(table, deviation)}
    got = grid(rows, 8)
    assert np.abs(aligned(got, whitened) - whitened).max() < 1e-9
    for r in rows[:8]:
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-12) and r.identity_error < 1e-9


@pytest.mark.parametrize("d, k", [(1, 8), (2, 8), (5, 3), (12, 8), (40, 17)])
def test_other_sizes(spark, d, k):
    draw = np.random.default_rng(d)
    vectors = draw.standard_normal((300, d)) * np.linspace(1, 3, d)
    k = min(k, d)
    rows = whitening.whiten(frame(spark, vectors), components=k).collect()
    deviation, _, want = plain(vectors, k)
    assert np.abs(aligned(grid(rows, k), want) - want).max() < 1e-8
    assert {(r.vec_id, int(r.deviation)) for r in rows} == set(enumerate(deviation))


def spectrum(values, seed=3):
    draw = np.random.default_rng(seed)
    q = np.linalg.qr(draw.standard_normal((len(values), len(values))))[0]
    return (q * values) @ q.T, np.sort(values)[::-1]


@pytest.mark.parametrize(
    "values",
    [
        np.ones(30),  # one eigenvalue thirty times
        np.array([5.0] * 10 + [1.0] * 20),  # the eighth and ninth are equal
        np.geomspace(1, 1e-10, 30),
        1 + 1e-6 * np.arange(30),  # narrow gaps
        np.append(1e6, np.linspace(0, 1, 29)),
        np.array([3.0, 2.0, 1.0] + [0.0] * 27),
    ],
)
def test_spectra_that_are_hard_to_cut(spark, values):
    v, want = spectrum(values)
    k = min(8, int((want > 1e-12).sum()))
    got, vectors = whitening.feast(spark, v, k)
    assert got == pytest.approx(want[:k], rel=1e-9, abs=1e-12 * want[0])
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12
    assert np.abs(v @ vectors - vectors * got).max() < 1e-11 * want[0]


def test_inertia_counts_eigenvalues():
    draw = np.random.default_rng(8)
    for d in (1, 2, 3, 17):
        a = draw.standard_normal((d, d))
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        shifts = np.append(values - 1e-6, values + 1e-6)
        counted = whitening.inertia(*whitening.tridiagonal(a), shifts)
        assert counted.tolist() == [(values > s).sum() for s in shifts]


def test_sums_are_exact_and_do_not_depend_on_tasks(spark):
    draw = np.random.default_rng(1)
    vectors = draw.standard_normal((500, 3)) * 10.0 ** draw.integers(-3, 5, (500, 3))
    docs = frame(spark, vectors)
    one = whitening.moments(whitening.scaled(docs.coalesce(1), "embedding", "vec_id"))
    many = whitening.moments(whitening.scaled(docs.repartition(7, "vec_id"), "embedding", "vec_id"))
    assert one.sums == many.sums and (one.covariance == many.covariance).all()
    x = [[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v] for v in vectors]
    n, s = len(x), [sum(c) for c in zip(*x)]
    for i in range(3):
        for j in range(3):
            exact = sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x)
            assert one.covariance[i, j] == exact / n**3


def test_odd_rows(spark):
    draw = np.random.default_rng(2)
    good = draw.standard_normal((60, 4)).tolist()
    rows = [(k, v) for k, v in enumerate(good)] + [(None, good[0]), (5, good[5]), (5, good[5])]
    bad = [(90, None), (91, [1.0, None, 2.0, 3.0]), (92, [float("nan")] * 4), (93, [1.0, float("inf"), 0.0, 0.0]), (94, []), (95, [1.0])]
    docs = spark.createDataFrame(rows + bad, SCHEMA)
    for name in ("x", "w", "deviation", "component", "_entries", "i", "n"):
        docs = docs.selectExpr("*", f"'clash' as {name}")
    got = whitening.whiten(docs).collect()
    assert len(got) == 4 * len(rows) and {r.n for r in got} == {len(rows)}
    assert {r.vec_id for r in got} == {i for i, _ in rows}
    deviation, _, _ = plain([v for _, v in rows], 4)
    assert {int(r.deviation) for r in got if r.vec_id is None} == {deviation[0]}
    assert len({r.whitened for r in got if r.vec_id == 5 and r.component == 1}) == 1
    assert all(r.identity_error < 1e-9 for r in got)


def test_tables_without_variance(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for docs in (empty, frame(spark, [[1.0, 2.0]]), frame(spark, [[1.0, 2.0]] * 5), spark.createDataFrame([(1, None), (2, [])], SCHEMA)):
        got = whitening.whiten(docs)
        assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert got.count() == 0


def test_components_without_variance_are_left_out(spark):
    draw = np.random.default_rng(4)
    flat = [[a, b, 2.0, a] for a, b in draw.integers(0, 50, (80, 2))]
    got = whitening.whiten(frame(spark, flat)).collect()
    assert {r.component for r in got} == {1, 2} and got[0].identity_error < 1e-9


def test_entries_out_of_range_are_an_error(spark):
    with pytest.raises(Exception, match="beyond"):
        whitening.whiten(frame(spark, [[1e30, 1.0], [0.0, 2.0]])).collect()
