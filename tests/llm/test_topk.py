import numpy as np

from catalith.llm.topk import TopConfig, best_of, inner_products, top_scores


def _brute(rows, k=20):
    good = [(n, key, [int(np.floor(64 * float(c))) for c in v]) for n, (key, v) in enumerate(rows) if v is not None and None not in v and np.isfinite(np.array(v, float)).all()]
    out = []
    for n, key, v in good:
        if key is None or key % 20:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), other is None, other or 0) for m, other, w in good if m != n and len(w) == len(v)]
        out += [(key, r + 1, None if void else other, -s) for r, (s, void, other) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def _found(spark, rows, config=TopConfig(), kind="float"):
    out = top_scores(spark.createDataFrame([(*r, 1, "x") for r in rows], f"vec_id bigint, embedding array<{kind}>, rank int, width string"), config=config)
    assert out.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    return sorted((tuple(r) for r in out.collect()), key=str)


def test_equal_to_brute_force_with_ties_and_copies(spark):
    rng = np.random.default_rng(2)
    hot = rng.standard_normal(8).tolist()
    rows = [(i, hot if i % 3 == 0 else (rng.integers(-2, 3, 8) / 4).tolist()) for i in range(700)]
    rows += [(None, hot), (None, hot), (40, hot), (40, [0.0] * 8), (900, None), (901, [None] * 8), (920, [float("nan")] * 8), (940, [1.0]), (941, [2.0]), (960, []), (961, []), (980, [3.0, 4.0])]
    want = _brute(rows)
    assert _found(spark, rows) == want
    assert _found(spark, rows, TopConfig(cells=512, strip=7, fan=2)) == want
    assert _found(spark, []) == []


def test_few_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (20, [-1.0, 0.0])]
    assert _found(spark, rows) == _brute(rows)
    assert _found(spark, rows[:1]) == []


def test_large_entries_stay_exact(spark):
    for size in (1e4, 1e7, 1e17):
        rows = [(i * 10, [size + i, -size, float(i % 3) * size]) for i in range(30)]
        got = _found(spark, rows, kind="double")
        if size < 1e17:
            assert got == _brute(rows)
        else:
            assert len(got) == 15 * 20 and all(abs(r[3]) <= 1 << 63 for r in got)


def test_selection_and_products():
    scores = np.array([[3, 5, 5, 5, 1], [2, 2, 2, 2, 2]], np.float64)
    i, j = best_of(scores, 3)
    assert list(zip(i, j)) == [(0, 1), (0, 2), (0, 3), (1, 0), (1, 1), (1, 2)]
    big = np.array([[1 << 40, 3]]), np.array([[(1 << 20) + 1, 1], [-1, 5]])
    assert inner_products(*big).tolist() == [[(1 << 60) + (1 << 40) + 3, -(1 << 40) + 15]]
