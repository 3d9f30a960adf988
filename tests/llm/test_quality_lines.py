import random

from brute import line_dedup, quality

from catalith.llm.lines import deduped_lines
from catalith.llm.quality import QualityConfig, beta_prior, host_rules, repeated_words

NAMES = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def test_quality_equals_brute_force(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(40)] + ["ä#", "日本", "|", "$9"]
    rows = []
    for i in range(150):
        n = rng.choice((0, 1, 4, 5, 9, 10, 40, 200))
        body = [rng.choice(words[: 3 if i % 3 == 0 else 44]) for _ in range(n)]
        rows.append((i, rng.choice(("a", "a", "bad", None)), "".join(w + rng.choice((" ", "\n", "  ", "\x0b")) for w in body)))
        if rows[-1][1] == "bad" and i % 4:
            rows[-1] = (i, "bad", "short")
    rows += [(None, "a", None), (7, "a", ""), (7, "a", ""), (8, "only", " \n ")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string").selectExpr("*", "'x' as kept", "1 as n_words")
    got = sorted((tuple(r) for r in host_rules(docs).select(*NAMES).collect()), key=str)
    assert got == sorted(quality(rows), key=str)
    assert any(r[7] is False and r[6] is False for r in got), "a host's verdict must matter here"
    assert host_rules(docs.limit(0)).count() == 0


def test_repeated_words_and_prior():
    w = "a b c d e".split()
    assert repeated_words(w * 2) == 10 and repeated_words(w) == 0 and repeated_words(["x"] * 9) == 9 and repeated_words([*w, "q", *w]) == 10
    assert repeated_words([str(i) for i in range(200000)]) == 0
    assert beta_prior(1, 0.5, 0.0, QualityConfig()) == (1.0, 1.0) and beta_prior(9, 0.1, 0.0, QualityConfig()) == (100.0, 900.0)


def test_lines_equal_brute_force(spark):
    rng = random.Random(3)
    pool = [[f"line {i} {j} some words" for j in range(rng.randint(2, 9))] for i in range(12)]
    rows = []
    for i in range(120):
        lines = []
        for _ in range(rng.randint(0, 4)):
            lines += rng.choice(pool) if rng.random() < 0.6 else [f"own {i} {rng.random()}"]
        rows.append((i, rng.choice(("\n", "\n\n")).join(lines) + rng.choice(("", "\n"))))
    rows += [(200, None), (201, ""), (202, "\n\n\n"), (203, "\n\n\n"), (204, "one line"), (205, "one line"), (206, "\n".join(f"x{i}" for i in range(30000))), (207, "\n".join(f"x{i}" for i in range(30000)))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "3 as n_lines", "doc_id as own", "doc_id as chunk")
    got = {r["doc_id"]: r for r in deduped_lines(docs).collect()}
    assert {k: r["text"] for k, r in got.items()} == line_dedup(rows)
    assert got[207]["text"] == "" and got[207]["n_lines"] == 30000 == got[207]["removed_lines"] and got[206]["removed_lines"] == 0
    assert got[207]["own"] == 207 and got[200]["n_lines"] == 0 and got[203]["removed_chunks"] == 0
    assert deduped_lines(docs.limit(0)).count() == 0


def test_lines_with_null_and_repeated_keys(spark):
    text = "a b\nc d\n"
    rows = [(None, text), (4, text), (4, text), (2, text + "z")]
    got = sorted(((r["doc_id"], r["text"]) for r in deduped_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()), key=str)
    # The two equal rows are one document, the first to hold the chunk; a NULL id comes last.
    assert got == sorted([(None, ""), (4, text), (4, text), (2, text + "z")], key=str)
