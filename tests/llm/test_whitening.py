import math

import numpy as np
import pytest

from newsvane.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n long, component string"


def whitened(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1, 0, "c") for i, v in rows], SCHEMA)
    return whitening.whiten(df, **options).collect()


def brute(rows, wanted=16):
    """Per row its exact deviation and whitened values up to sign; the shares of the variance."""
    good = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows if v is not None
            and all(c is not None and math.isfinite(c) for c in v)]
    dim = max(len(v) for _, v in good)
    good = [(i, v + [1_000_000] * (dim - len(v))) for i, v in good]
    fit = sorted({tuple(v) for _, v in good})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = lambda v: [(n * x - s) for x, s in zip(v, sums)]
    z = np.array([centred(v) for v in fit], dtype=float) / n
    cov = z.T @ z / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = [j for j in range(min(wanted, dim)) if values[j] > 1e-12 * values[0]]
    out = []
    for i, v in good:
        deviation = sum(x * x for x in centred(v))
        w = np.array(centred(v), dtype=float) / n @ vectors[:, keep] / np.sqrt(values[keep])
        out.append((i, n, deviation, w))
    return out, values[keep] / np.trace(cov)


def same(spark, rows, **options):
    want, shares = brute(rows)
    got = whitened(spark, rows, **options)
    assert len(got) == len(want) * len(shares)
    by_row = {}
    for r in got:
        by_row.setdefault((r.vec_id, r.deviation), {})[r.component] = r
    signs = None
    for i, n, deviation, w in sorted(want, key=lambda r: -np.abs(r[3]).min()):
        mine = by_row[i, deviation]
        assert sorted(mine) == list(range(1, len(shares) + 1))
        found = np.array([mine[k].whitened for k in sorted(mine)])
        signs = np.sign(found * w) if signs is None else signs
        assert np.allclose(found, signs * w, rtol=1e-7, atol=1e-7)
        assert all(r.n == n for r in mine.values())
    assert np.allclose([by_row[want[0][0], want[0][2]][k + 1].explained for k in range(len(shares))], shares, rtol=1e-8)
    assert all(r.identity_error < 1e-8 for r in got)


def random_rows(n, dim, seed=1, decay=0.97):
    rng = np.random.default_rng(seed)
    scales = 3 * decay ** np.arange(dim)
    turned = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    return [(i, ((rng.normal(size=dim) * scales) @ turned + 5).astype(np.float32).tolist()) for i in range(n)]


def test_filtered_iteration_equals_a_full_decomposition(spark):
    rows = random_rows(400, 60, decay=0.9)
    same(spark, rows + [(1000 + i, v) for i, v in rows[:50]])


def test_narrow_blocks_and_flat_spectrum(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ROWS_PER_BLOCK", 7)
    same(spark, random_rows(200, 52, decay=1.0))


def test_few_dimensions_left_out_rows_and_uneven_lengths(spark):
    rows = [(i, v) for i, v in random_rows(40, 5)] + [(40, [1.0, 2.0]), (41, []), (None, [3.0, 1.0, 2.0]), (0, [9.0] * 5)]
    bad = [(50, None), (51, [1.0, None, 2.0]), (52, [float("nan")] * 5), (53, [float("-inf"), 1.0])]
    same(spark, rows + bad)


def test_few_directions_vary(spark):
    rows = [(i, [float(i % 7), 2.0 * (i % 7), -1.0, float(i % 3)] + [4.0] * 60) for i in range(60)]
    same(spark, rows)


def test_copies_count_once(spark):
    rows = random_rows(30, 4)
    same(spark, rows + [(100 + i, rows[3][1]) for i in range(500)])


def test_large_entries_stay_exact(spark):
    same(spark, [(i, [1e5 * (i % 5) - 3e5, 7.0 * i, -1e4 * (i % 3)]) for i in range(30)])
    got = whitened(spark, [(i, [3e38 if i == 2 else 0.0, float(i)]) for i in range(9)])
    # The second direction varies by less than rounding beside the first.
    assert len(got) == 9 and {r.deviation for r in got} == {None}


def test_nothing_to_whiten(spark):
    assert whitened(spark, []) == []
    assert whitened(spark, [(1, [2.0, 3.0])]) == []
    assert whitened(spark, [(i, [2.0, 3.0]) for i in range(5)]) == []
    assert whitened(spark, [(1, []), (2, []), (3, None)]) == []


def test_filter_separates_close_eigenvalues_and_skips_constant_ones():
    rng = np.random.default_rng(5)
    turned = np.linalg.qr(rng.normal(size=(300, 300)))[0]
    spectrum = np.concatenate([[1e6, 50, 49.9], 20 * 0.99 ** np.arange(97), np.zeros(200)])
    matrix = (turned * spectrum) @ turned.T
    passes = []

    def product(q):
        passes.append(q.shape)
        return matrix @ q

    values, vectors = whitening.leading_pairs(product, 300)
    assert np.allclose(values, spectrum[:16], rtol=1e-8)
    assert np.allclose(np.abs((vectors * turned[:, :16]).sum(axis=0)), 1, atol=1e-8)
    assert all(width <= 48 for _, width in passes)


@pytest.mark.parametrize("cores", [1, 5])
def test_fit_does_not_depend_on_partitions(spark, cores):
    rows = random_rows(200, 20)
    df = spark.createDataFrame([(i, v, 1, 0, "c") for i, v in rows], SCHEMA)
    model = whitening.fit(df.repartition(cores))
    again = whitening.fit(df)
    assert np.allclose(model.vectors, again.vectors, atol=1e-9)
