import random
import zlib

import numpy as np
import pytest

from brute import WORD, mix, targets

from catalith.llm.mixing import MixConfig, mix_pieces, mixed_documents, slot_schedule, source_targets, taken_texts
from catalith.llm.packing import PackConfig, encoder, first_fit, packed_documents


def _rows(seed):
    rng = random.Random(seed)
    rows = [(i, "big" if i % 3 == 0 else rng.choice(("a", "b", "ä", "tiny", None)), rng.choice((0, 1, 3, 50, 400, 3000))) for i in range(300)]
    return [(k, s, min(n, 3) if s == "tiny" else n) for k, s, n in rows]


def _docs(spark, rows):
    return spark.createDataFrame([(k, s, " w" * n if n else None, 1) for k, s, n in rows], "doc_id bigint, source string, text string, size int")


@pytest.mark.parametrize("block", [64, 1024])
def test_mix_equals_brute_force(spark, block):
    rows = _rows(4)
    got = {r["doc_id"]: r for r in mixed_documents(_docs(spark, rows), MixConfig(block=block, run=16)).collect()}
    assert {k: r["taken"] for k, r in got.items()} == mix(rows)
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    goal = targets(sizes)
    for k, s, n in rows:
        r = got[k]
        assert (r["size"], r["source_size"]) == (n, sizes[s]) and r["target"] == pytest.approx(goal[s]) and r["taken"] <= 2 * n
    for s in sizes:
        assert abs(sum(got[k]["taken"] for k, x, _ in rows if x == s) - goal[s]) <= 1


def test_schedule_is_even(spark):
    sizes = spark.createDataFrame([("a", 50000), ("b", 30000), (None, 20000), ("zero", 0)], "source string, source_size bigint")
    t = source_targets(sizes)
    slots = slot_schedule(t, MixConfig(block=100, run=64)).collect()
    goal = {r["source"]: r["target"] for r in t.collect()}
    total = sum(goal.values())
    assert sorted(r["slot"] for r in slots) == list(range(1500)) and goal["zero"] == 0
    for s in ("a", "b", None):
        own = sorted((r["slot"], r["rank"]) for r in slots if r["source"] == s)
        assert [k for _, k in own] == list(range(len(own)))
        for i, (slot, _) in enumerate(own):  # every start of the schedule holds its share
            assert abs(i - slot * goal[s] / total) < 6


def test_mix_of_odd_tables(spark):
    assert mixed_documents(_docs(spark, [])).count() == 0
    assert [r["taken"] for r in mixed_documents(_docs(spark, [(1, "a", 0)])).collect()] == [0]
    same = [(1, "a", 5), (1, "a", 5), (None, "a", 5), (None, None, 7), (1, "a", 6)]
    got = mixed_documents(_docs(spark, same)).collect()
    assert len(got) == 5 and sum(r["taken"] for r in got) in (41, 42) and all(r["taken"] <= 2 * r["size"] for r in got)


def test_pieces_cover_each_round_once(spark):
    rows = [(k, s, n) for k, s, n in _rows(5)]
    sized = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint")
    pieces, _ = mix_pieces(sized, MixConfig(block=37))
    held = {}
    for p in pieces.collect():
        held.setdefault((p["doc_id"], p["round"]), []).append((p["from"], p["to"]))
    taken = {}
    for (key, _), spans in held.items():
        spans.sort()
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
        taken[key] = taken.get(key, 0) + spans[-1][1]
    assert taken == {k: n for k, n in mix(rows).items() if n}


def test_taken_texts(spark):
    spans = [[(0, 0, 3)], [(0, 0, 2)], [(0, 0, 3), (1, 0, 1)], [(0, 1, 2)]]
    rows = spark.createDataFrame([(i, " a b\nc ", s) for i, s in enumerate(spans)], "k int, text string, spans array<struct<round:int,first:bigint,last:bigint>>")
    assert [r["text"] for r in taken_texts(rows, "spans").orderBy("k").collect()] == [" a b\nc ", " a b", " a b\nc \n a", "b"]


def test_first_fit_tree_equals_search():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 7, 300):
        sizes = np.sort(rng.integers(1, 101, n))[::-1]
        room, want = [], []
        for s in sizes:
            k = next((k for k, r in enumerate(room) if r >= s), len(room))
            if k == len(room):
                room.append(100)
            want.append((k, 100 - room[k]))
            room[k] -= s
        where, offset = first_fit(sizes, 100)
        assert list(zip(where.tolist(), offset.tolist(), strict=True)) == want


def test_packing_keeps_every_id(spark):
    from tokenizers import Tokenizer
    import public_tokenizers

    direct = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(6)
    words = ["the", "Ünï", "it's", "don't", "日本語", "😀", "3.14", "x" * 90, "\x1c", "<|endoftext|>", "á"]
    rows = [(i, "".join(rng.choice(words) + rng.choice((" ", "  ", "\n", "\n\n", "\t", " ", " \n ")) for _ in range(rng.choice((0, 1, 5, 60, 900, 4000)))), 1) for i in range(90)]
    rows += [(200, None, 1), (None, "null key", 1), (3, "again", 1), (3, "again", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, offset int")
    got = packed_documents(docs, PackConfig(group=40), keep_ids=True).collect()
    want = sorted(([k, *direct.encode(t or "", add_special_tokens=False).ids, 1] for k, t, _ in rows), key=str)
    parts = {}
    for r in got:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] <= 2048
        parts.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    found = []
    for (key, n), pieces in parts.items():
        pieces.sort(key=lambda r: r["start"])
        copies = sum(r["start"] == 0 for r in pieces)
        assert sum(r["length"] for r in pieces) == copies * n
        found += [[key, *[x for r in pieces[:: copies] for x in r["ids"]]]] * copies
    assert sorted(found, key=str) == want
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert packed_documents(docs.limit(0)).count() == 0


def test_encoder_forgets_and_agrees():
    import public_tokenizers
    from tokenizers import Tokenizer

    direct = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode, rng = encoder(None, 50), random.Random(7)
    texts = ["".join(rng.choice(" \n\t  ab'sé,.\x1c  १1\r!<|😀日‍́") for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    assert encode(texts) == [np.array(direct.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert WORD.findall("a b c") == ["a b", "c"]
