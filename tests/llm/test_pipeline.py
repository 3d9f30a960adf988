import random
import zlib

import numpy as np
import public_tokenizers
import xxhash
from brute import WORD, jaccard, line_dedup, mix, quality
from tokenizers import Tokenizer

import corpus_pipeline


def _corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    pools = [[" ".join(rng.choice(words) for _ in range(12)) for _ in range(rng.randint(2, 6))] for _ in range(6)]
    rows, bodies = [], []
    for i in range(130):
        kind = rng.random()
        if kind < 0.1:
            text = rng.choice((None, "", "a b c", "spam spam spam spam spam " * 9))
        elif kind < 0.4 and bodies:
            text = rng.choice(bodies)
            if rng.random() < 0.7:
                parts = text.split(" ")
                parts[rng.randrange(len(parts))] = "changed"
                text = " ".join(parts)
        else:
            lines = [" ".join(rng.choice(words) for _ in range(rng.choice((12, 30, 90)))) for _ in range(rng.randint(1, 5))]
            if rng.random() < 0.5:
                lines[1:1] = rng.choice(pools)
            text = "\n".join(lines)
            bodies.append(text)
        source = rng.choice(("a", "a", "a", "b", "c", None, "bad"))
        rows.append((i, "no" if source == "bad" and i % 5 else text, "en", source, 0))
    return rows


def _taken(text, n):
    words = list(WORD.finditer(text))
    out = []
    while n > 0:
        out.append(text if n >= len(words) else text[: words[n - 1].end()])
        n -= len(words)
    return "\n".join(out)


def _expected(rows):
    fine = {r[0] for r in quality([(k, s, t) for k, t, _, s, _ in rows]) if r[-1]}
    rows = [r for r in rows if r[0] in fine]
    texts = line_dedup([(r[0], r[1]) for r in rows])
    was = {r[0]: r[1] for r in rows}
    rows = [(k, texts[k], lang, s, n) for k, _, lang, s, n in rows if texts[k] == was[k] or WORD.search(texts[k])]
    comp = jaccard([(r[0], r[1]) for r in rows])
    rows = [r for r in rows if comp[r[0]][1] == r[0]]
    name = lambda r: f"{{{r[0]}, {np.uint64(xxhash.xxh64_intdigest(r[1].encode(), seed=42)).astype(np.int64)}}}"
    taken = mix([(name(r), r[3], len(WORD.findall(r[1]))) for r in rows])
    return {r[0]: _taken(r[1], taken[name(r)]) for r in rows if taken[name(r)]}


def test_pipeline_equals_brute_force(spark, tmp_path):
    rows = _corpus(11)
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    direct = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {k: [*direct.encode(t, add_special_tokens=False).ids, 1] for k, t in _expected(rows).items()}
    assert len(want) > 40
    assert {(r["doc_id"], r["doc_tokens"]) for r in got} == {(k, len(ids)) for k, ids in want.items()}
    for r in got:
        ids = want[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == r["ids_crc32"]
    assert sum(r["length"] for r in got) == sum(map(len, want.values()))


def test_stages_take_odd_tables(spark, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    body = " ".join(f"v{i}" for i in range(40))
    rows = [(None, body, "en", None, 1), (None, None, None, None, None), (5, body, "en", "s", 1), (5, body, "en", "s", 1), (6, "x y\nx z", "en", "s", 2), (7, body + " more\nlines", None, "t", 3)]
    for k, table in enumerate((rows, [])):
        docs = spark.createDataFrame(table, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            if name != "sequence_packing":
                assert out.columns == list(corpus_pipeline.COLUMNS)
            out.write.parquet(f"{tmp_path}/{k}-{name}")
            docs = spark.read.parquet(f"{tmp_path}/{k}-{name}")
        assert {r["doc_id"] for r in docs.collect()} == ({None, 5} if k == 0 else set())


def test_near_duplicates_where_ids_repeat(spark, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    one, two, three = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(3, one, "en", "s", 1), (3, two, "en", "s", 2), (5, two, "en", "s", 2), (4, three, "en", "t", 3), (4, three, "en", "s", 3), (4, three + " more", "en", "s", 4)]
    got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, schema), str(tmp_path))
    hashed = lambda r: np.uint64(xxhash.xxh64_intdigest(r[1].encode(), seed=42)).astype(np.int64)
    fourth = min((r for r in rows if r[0] == 4), key=lambda r: (hashed(r), r[3]))
    assert sorted(tuple(r) for r in got.collect()) == sorted([rows[0], rows[1], fourth])
