import numpy as np
import pytest

from catalith.llm.whitening import WhitenConfig, refined_eigen, whitened_vectors


def _matrix(values, seed=1):
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    a = q @ np.diag(values) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("values", [
    np.linspace(1, 9, 40), np.r_[5, 5 + 1e-9, 5 + 2e-9, np.linspace(0.1, 1, 20)], np.r_[3, 3, 3, 1, 1, 1e-8], np.geomspace(1e-9, 1e6, 32), np.ones(5), np.zeros(4),
    np.r_[7.0], np.r_[2, 2 + 1e-7, 2 + 2e-7, 2 + 3e-7, 1, 1 + 1e-12],
])
def test_refined_eigenvectors_reach_double_precision(values):
    a = _matrix(values)
    found, x = refined_eigen(a)
    top = max(np.abs(values).max(), 1e-300)
    assert np.abs(found - np.sort(values)[::-1]).max() <= 1e-14 * top * len(values)
    assert np.abs(x.T @ x - np.eye(len(a))).max() <= 1e-13
    assert np.abs(a @ x - x * found).max() <= 2e-14 * top * len(values)


def test_float32_alone_would_not_do():
    a = _matrix(np.linspace(1, 9, 40))
    rough = np.linalg.eigh(a.astype(np.float32))[1].astype(float)
    exact = np.linalg.eigh(a)[1]
    assert np.abs(np.abs(np.sum(rough * exact, 0)) - 1).max() > 1e-13
    fine = refined_eigen(a)[1][:, ::-1]
    assert np.abs(np.abs(np.sum(fine * exact, 0)) - 1).max() < 1e-14


def _brute(rows, components=4):
    good = [(k, [int(np.floor(256 * float(c))) for c in v]) for k, v in rows if v is not None and None not in v and np.isfinite(np.array(v, float)).all()]
    out = {}
    for width in {len(v) for _, v in good if v}:
        mine = [(k, v) for k, v in good if len(v) == width]
        fit = sorted({tuple(v) for _, v in mine})
        n, s = len(fit), [sum(c) for c in zip(*fit)]
        y = np.array([[c - t / n for c, t in zip(v, s)] for v in fit])
        values, vectors = np.linalg.eigh(y.T @ y / n)
        for k, v in mine:
            dev = sum((n * c - t) ** 2 for c, t in zip(v, s))
            for j in range(min(components, width)):
                e, u = values[-1 - j], vectors[:, -1 - j]
                w = float((np.array(v) - np.array(s) / n) @ u / np.sqrt(e)) if e > 1e-12 * values.sum() else None
                out.setdefault((k, j + 1), []).append((n, dev, w, e / values.sum() if values.sum() > 0 else None))
    return out


def _check(spark, rows, kind="float"):
    got = whitened_vectors(spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>, n string, component int"))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert dict(got.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    got = got.collect()
    want = _brute([r[:2] for r in rows])
    assert len(got) == sum(len(v) for v in want.values())
    signs = {}
    for r in got:
        match = [w for w in want[(r["vec_id"], r["component"])] if w[:2] == (r["n"], r["deviation"])]
        assert match, r
        w = match[0]
        if w[2] is None:
            assert r["whitened"] is None
        else:
            sign = signs.setdefault((r["n"], r["component"]), np.sign(w[2] * r["whitened"]) or 1)
            assert abs(r["whitened"] * sign - w[2]) <= 1e-9 * max(1, abs(w[2]))
            assert r["identity_error"] <= 1e-4
        assert (r["explained"] is None) == (w[3] is None) and (w[3] is None or abs(r["explained"] - w[3]) <= 1e-9)
    return got


def test_equal_to_brute_force(spark):
    rng = np.random.default_rng(5)
    mix = rng.standard_normal((12, 12)) * np.linspace(3, 0.05, 12)[:, None]
    rows = [(i, (rng.standard_normal(12) @ mix + 5).astype(np.float32).tolist(), "x", 1) for i in range(600)]
    rows += [(2000 + i, rows[7][1], "copy", 2) for i in range(400)]
    rows += [(3000, None, None, 1), (3001, [None] * 12, "", 1), (3002, [float("nan")] * 12, "", 1), (3003, [float("inf")] + [0.0] * 11, "", 1), (None, rows[3][1], "", 1), (5, rows[4][1], "", 1)]
    _check(spark, rows)


def test_odd_tables(spark):
    assert _check(spark, []) == []
    one = _check(spark, [(1, [0.5, -0.25, 3.0], None, None), (2, [0.5, -0.25, 3.0], None, None)])
    assert len(one) == 6 and all(r["whitened"] is None and r["deviation"] == 0 and r["identity_error"] is None for r in one)
    _check(spark, [(1, [1.0, 2.0], "", 1), (2, [2.0, 4.5], "", 1), (3, [-0.001, 7.0], "", 1), (4, [1.0], "", 1), (5, [3.0], "", 1), (6, [], "", 1)])


def test_values_beyond_longs(spark):
    rows = [(1, [1e16, 0.0], "", 1), (2, [-1e16, 1.0], "", 1), (3, [5e15, 2.0], "", 1), (4, [1e308, 0.0], "", 1)]
    got = whitened_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, n string, component int"), WhitenConfig(components=1)).collect()
    assert len(got) == 4 and all(r["deviation"] is None and r["n"] == 4 and r["whitened"] is not None for r in got)
