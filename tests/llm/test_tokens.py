import random

from catalith.llm.tokens import CountConfig, LongestMatch, token_counts, vocabulary_pieces


def _greedy(word, first, inner):
    n, at = 0, 0
    while at < len(word):
        pieces = first if at == 0 else inner
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return 1
        n, at = n + 1, end
    return n


def test_automaton_equals_greedy_search():
    rng = random.Random(1)
    for _ in range(300):
        piece = lambda: bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 5)))
        first, inner = {piece() for _ in range(rng.randint(0, 12))}, {piece() for _ in range(rng.randint(0, 12))}
        automaton = LongestMatch(first, inner)
        for _ in range(60):
            word = bytes(rng.choice(b"abcd" if rng.random() < 0.1 else b"abc") for _ in range(rng.randint(0, 12)))
            assert automaton.count(word) == _greedy(word, first, inner), (word, first, inner)


def test_counts_of_whole_texts(spark):
    pieces = vocabulary_pieces(CountConfig())
    longest = max(map(len, pieces))
    greedy = lambda w: _greedy_bounded(w, pieces, longest)
    rows = [
        (1, "The Quick brown foxes", "x"), (2, None, "x"), (3, "", "x"), (4, " \n\t", "x"), (None, "ünïcödé 日本 😀", "x"), (5, "unbelievable " * 30000, "x"),
        (5, "q" * 300, None), (5, "q" * 300, None),
    ]
    got = token_counts(spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string"), CountConfig(memory=3)).collect()
    want = []
    for key, text, _ in rows:
        words = (text or "").encode().lower().split()
        counts = {w: greedy(w) for w in set(words)}
        want.append((key, len(words), sum(counts[w] for w in words)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert token_counts(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def _greedy_bounded(word, pieces, longest):
    n, at = 0, 0
    while at < len(word):
        at = next(e for e in range(min(len(word), at + longest), at, -1) if word[at:e] in pieces)
        n += 1
    return n
