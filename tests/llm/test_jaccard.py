import random

import numpy as np
import pyarrow as pa
from brute import jaccard, smallest_reachable

from catalith.llm import jaccard as operator
from catalith.llm.jaccard import JaccardConfig, _Group, shared_posts, shingle_set, similar_documents


def _found(spark, rows, schema="doc_id bigint, text string", **config):
    out = similar_documents(spark.createDataFrame(rows, schema), JaccardConfig(**config))
    return {r[0]: (r[1], r[2]) for r in out.select("doc_id", "n_shingles", "component_id").collect()}


def _corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    passage = [rng.choice(words) for _ in range(60)]
    rows, texts = [], []
    for i in range(160):
        kind = rng.random()
        if kind < 0.35 and texts:
            body = list(rng.choice(texts))
            for _ in range(rng.choice((0, 1, 1, 2, 3, 5))):
                body[rng.randrange(len(body))] = rng.choice(words)
        else:
            body = [rng.choice(words) for _ in range(rng.choice((2, 4, 5, 9, 40, 120, 300)))]
            if kind > 0.6:
                at = rng.randrange(len(body))
                body[at:at] = passage
        texts.append(body)
        rows.append((i, rng.choice((" ", "\n", "  ")).join(w.upper() if rng.random() < 0.1 else w for w in body)))
    return rows


def test_equals_brute_force(spark):
    rows = _corpus(5)
    assert _found(spark, rows) == jaccard(rows)


def test_settings_that_change_the_work_leave_the_result(spark):
    rows = _corpus(6)
    assert _found(spark, rows, common=2, front=0.5, memory=10) == jaccard(rows)


def test_edge_cases(spark):
    long = " ".join(f"x{i % 700}y{i % 13}" for i in range(60000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "Ünë"), (7, "ünë"), (8, long), (9, long + " end"), (10, "a b c d e"), (11, "a b c d e")]
    assert _found(spark, rows) == jaccard(rows)
    assert _found(spark, []) == {}


def test_null_and_repeated_keys_and_clashing_columns(spark):
    a, b = "a b c d e f g h i j", "k l m n o p q r s t"
    rows = [(None, a, "x"), (3, a, "x"), (2, b, "x"), (3, b, "y"), (1, a, "x"), (1, a, "x")]
    out = similar_documents(spark.createDataFrame(rows, "doc_id bigint, text string, n string").withColumnRenamed("n", "component_id"))
    got = sorted(((r["doc_id"], r["component_id"]) for r in out.collect()), key=str)
    assert got == sorted([(None, None), (3, 1), (2, 1), (3, 1), (1, 1), (1, 1)], key=str)


def test_answers_derived_from_a_leader():
    """Groups of sets around one set, and sets far from it: every pair's answer equals that of the whole sets."""
    rng = np.random.default_rng(4)
    for spread in (3, 12, 200):
        base = rng.choice(1 << 40, 120, replace=False).astype(np.uint64)
        sets = []
        for _ in range(40):
            kept = rng.random(120) >= spread / 240
            sets.append(np.unique(np.r_[base[kept], rng.choice(1 << 10, spread // 2).astype(np.uint64)]))
        group = _Group(sets[7])
        for sid, tokens in enumerate(sets):
            group.add(sid, tokens)
        edges = [(a, b) for a in range(40) for b in range(a) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))]
        want = smallest_reachable(range(40), edges)
        a, b = group.edges(JaccardConfig())
        assert smallest_reachable(range(40), list(zip(a, b))) == want and len(a) == sum(k != v for k, v in want.items())


def test_groups_in_parts_and_rows_grow_with_classes(spark):
    """One large group of near copies of which no two link: what leaves the workers is a row per class and token list, not per pair."""
    rng = np.random.default_rng(9)
    words = [f"w{k}" for k in range(130)]
    rows = []
    for i in range(160):
        own = list(words)
        for at in rng.choice(len(own) - 4, 4, replace=False):
            own[at] = f"x{i}_{at}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, " ".join(words[:100] + [f"y{i}"] * (1 if i % 2 else 2))) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = None
    for config in (JaccardConfig(), JaccardConfig(members=7, rounds=1), JaccardConfig(block=16, rounds=1)):
        got = {r["doc_id"]: r["component_id"] for r in similar_documents(docs, config).collect()}
        want = want or got
        assert got == want
    sets = {k: shingle_set(t, JaccardConfig()) for k, t in rows}
    edges = [(a, b) for a in sets for b in sets if a < b and 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))]
    assert want == smallest_reachable(list(sets), edges)


def test_posts_in_passes(spark):
    """A pass over its share of the tokens stores the posts of that share; posts and results do not change with their number."""
    rows = [(i, i % 50, [i % 40, 100 + i % 7, *range(1000 * i + 1000, 1000 * i + 1400)]) for i in range(400)]
    classes = spark.createDataFrame(rows, "sid bigint, comp bigint, tokens array<bigint>")
    found = {}
    for passes in (1, 3):
        parts = shared_posts(classes, JaccardConfig(passes=passes, common=20))
        assert len(parts) == passes
        shares = [{tuple(r) for r in part.select("token", "sid", "pos", "common").collect()} for part in parts]
        assert all(token % passes == k for k, share in enumerate(shares) for token, *_ in share)
        found[passes] = set().union(*shares)
    assert found[1] == found[3] == {(t, i, p, t >= 100) for i, _, tokens in rows for p, t in enumerate(tokens[:2]) if t >= 100 or t < 40 and len({j % 50 for j in range(t, 400, 40)}) > 1}
    texts = _corpus(7)
    sets = {k: shingle_set(t, JaccardConfig()) for k, t in texts}
    low = {k: k for k in sets}
    links = [(a, b) for a in sets for b in sets if len(sets[a]) and 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))]
    for _ in sets:
        for a, b in links:
            low[a] = min(low[a], low[b])
    assert _found(spark, texts, passes=3) == {k: (len(v), low[k]) for k, v in sets.items()}


def test_passes_read_stored_components_and_join_nothing(spark, monkeypatch):
    rows, seen = _corpus(8), []

    def watched(classes, config):
        seen.append(classes._jdf.queryExecution().toString())
        return shared_posts(classes, config)

    monkeypatch.setattr(operator, "shared_posts", watched)
    assert _found(spark, rows) == jaccard(rows)
    assert len(seen) == 1 and "Join" not in seen[0]


def test_sets_of_a_column_are_the_sets_of_its_texts():
    rng = random.Random(3)
    texts = [None, "", " \n", "a", " A b ", "a b c d e f a b c d e f"] + ["".join(rng.choice("aAbÄ \t\n\x0b\x0c\r\x1c\x85") for _ in range(rng.randrange(50))) for _ in range(300)]
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(["cut off", *texts], kind).slice(1)
        for text, tokens in zip(texts, operator.shingle_sets(column, JaccardConfig()), strict=True):
            words = (text or "").encode().lower().split()
            assert len(tokens) == len({tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else ()))
            assert tokens.tolist() == shingle_set(text, JaccardConfig()).tolist() == sorted(set(tokens.tolist()))
