import numpy as np

from brute import smallest_reachable

from catalith.llm.vectors import VectorConfig, clean_vectors, near_vectors, plan_tables


def _brute(rows, threshold=0.95):
    good = {k: np.array(v, float) for k, v in rows if v is not None and None not in v and len(v) and np.isfinite(np.array(v, float)).all() and np.any(v)}
    links, edges = {k: 0 for k, _ in rows}, []
    keys = sorted(good)
    for n, a in enumerate(keys):
        for b in keys[n + 1 :]:
            x, y = good[a], good[b]
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links[a] += 1
                links[b] += 1
                edges.append((a, b))
    comp = smallest_reachable(links, edges)
    return {k: (links[k], comp[k], comp[k] == k) for k in links}


def _found(spark, rows, config=VectorConfig()):
    out = near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int"), config)
    return {r[0]: (r[1], r[2], r[3]) for r in out.select("vec_id", "n_links", "component_id", "kept").collect()}


def test_groups_of_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows, hot = [], rng.standard_normal(64)
    for i in range(400):
        if i % 3 == 0:
            v = hot + rng.standard_normal(64) * 0.12
        elif i % 7 == 0 and rows:
            v = np.array(rows[int(rng.integers(len(rows)))][1])
        else:
            v = rng.standard_normal(64)
        rows.append((i, v.astype(np.float32).tolist(), i % 5))
    rows += [(1000, None, 1), (1001, [0.0] * 64, 1), (1002, [float("nan")] * 64, None), (1003, [None] * 64, 1), (1004, [], 1), (1005, [1.0, 2.0], 1), (1006, [2.0, 4.0], 1)]
    want = _brute([(k, v) for k, v, _ in rows])
    assert _found(spark, rows) == want
    assert _found(spark, rows, VectorConfig(block=16)) == want
    assert _found(spark, []) == {}


def test_recall_just_above_the_threshold(spark):
    """Pairs at a cosine of 0.951: the hardest that count."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(1500):
        v = rng.standard_normal(64)
        v /= np.linalg.norm(v)
        w = rng.standard_normal(64)
        w -= w @ v * v
        w /= np.linalg.norm(w)
        rows += [(2 * i, v.tolist(), 0), (2 * i + 1, (0.951 * v + (1 - 0.951**2) ** 0.5 * w).tolist(), 0)]
    got = _found(spark, rows)
    found = sum(got[2 * i + 1][1] == 2 * i for i in range(1500))
    assert found >= 0.97 * 1500
    assert all(n <= 1 for n, _, _ in got.values())


def test_null_and_repeated_keys(spark):
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(None, a, 1), (5, a, 1), (5, b, 1), (3, b, 1), (3, b, 1)]
    out = near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, kept int"))
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in out.collect()), key=str)
    assert got == sorted([(None, 0, None), (5, 0, 3), (5, 2, 3), (3, 2, 3), (3, 2, 3)], key=str)


def test_plan_grows_with_the_rows(spark):
    small, large = plan_tables(1000, 64, VectorConfig()), plan_tables(10**9, 64, VectorConfig())
    assert small.bits < large.bits and small.tables < large.tables
    assert clean_vectors(spark.createDataFrame([(1, [1.0])], "k bigint, v array<double>"), "k", "v").count() == 1
