import numpy as np
import pytest

from newsvane.operators import regression

SCHEMA = "id bigint, v array<double>, a double, b double"


@pytest.fixture
def table(rows):
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(300, 5)), 6)
    y = np.round(np.column_stack([x @ [1, -2, 0.5, 0, 3] + 0.25, rng.normal(size=300)]), 6)
    data = [(i, x[i].tolist(), float(y[i, 0]), float(y[i, 1])) for i in range(300)]
    odd = [(900, None, 1.0, 1.0), (901, [1.0, None, 0.0, 0.0, 0.0], 1.0, 1.0), (902, [0.0] * 5, None, 1.0)]
    return x, y, rows(data + odd, SCHEMA)


def test_sums_are_exact_in_any_layout(table):
    x, y, df = table
    m = np.rint(np.column_stack([np.ones(300), x, y]) * 1e6).astype(np.int64).astype(object)
    want = m.T @ m
    for made in (df.repartition(1), df.repartition(9)):
        got = {(r.i, r.j): int(r.total) for r in regression.gram(made, "v", ["a", "b"], 5).collect()}
        assert got == {(i, j): want[i, j] for i in range(8) for j in range(i, 8)}


def test_heads_are_least_squares(table):
    x, y, df = table
    weights = regression.fit_heads(regression.gram(df, "v", ["a", "b"], 5), 5, ["a", "b"], ridge=0.0)
    design = np.column_stack([np.ones(300), x])
    best = np.linalg.lstsq(design, y, rcond=None)[0]
    assert weights["a"] == pytest.approx([0.25, 1, -2, 0.5, 0, 3], abs=1e-5)
    assert weights["b"] == pytest.approx(best[:, 1], abs=1e-8)
    got = {r.id: r for r in regression.predict(df, "v", weights).collect()}
    assert [got[i].pred_b for i in range(300)] == pytest.approx((design @ best[:, 1]).tolist(), abs=1e-6)
    assert got[900].pred_a is None


def test_large_values_and_no_rows(rows):
    df = rows([(1, [1e9, -3e8], 5e8, 1.0), (2, [2e9, 1.0], 1.0, 0.0)], SCHEMA)
    got = {(r.i, r.j): int(r.total) for r in regression.gram(df, "v", ["a"], 2).collect()}
    assert got[1, 1] == (10**15) ** 2 + (2 * 10**15) ** 2 and got[0, 0] == 2 * 10**12 and got[2, 3] == -3 * 10**14 * 5 * 10**14 + 10**12
    with pytest.raises(ValueError):
        regression.fit_heads(regression.gram(df.where("false"), "v", ["a"], 2), 2, ["a"])
