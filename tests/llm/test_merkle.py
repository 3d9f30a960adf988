import binascii
import hashlib

import numpy as np
import pytest

from catalith.llm import merkle


def _h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def _tree(leaves):
    """Levels from the leaves up."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([_h("".join(last[i : i + 8])) for i in range(0, len(last), 8)])
    return levels


def _brute(rows):
    def leaf(row):
        return _h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = _tree([leaf(r) for r in groups[g]])
    top = _tree([trees[g][-1][0] for g in order])
    out = []
    for at, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            text = r[4]
            if r[0] is not None and binascii.crc32(str(r[0]).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node, proof = leaf((*r[:4], text)), ""
            for levels, k in ((trees[g], i), (top, at)):
                for level in levels[:-1]:
                    left, right = "".join(level[k - k % 8 : k]), "".join(level[k + 1 : k - k % 8 + 8])
                    node, proof, k = _h(left + node + right), proof + left + right, k // 8
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], _h(proof), node, node == top[-1][0]))
    return sorted(out, key=str)


def _found(spark, rows, **config):
    data = [(*r, "x", 5) for r in rows]
    out = merkle.audited_documents(spark.createDataFrame(data, "doc_id bigint, source string, lang string, n_chars bigint, text string, key string, i int"), **config)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def _rows(n):
    return [(i, f"s{i % 3}", ["en", "de", None, "é", "fr", "z"][min(5, (i * i) % 11)], i, f"Text {i} ÄA") for i in range(n)]


def test_equal_to_brute_force(spark):
    rows = _rows(700)
    rows += [(None, None, None, None, None), (None, "", "en", 0, ""), (5, "s", "en", 1, "again"), (5, "s", "en", 1, "again"), (2**62, "s", "only", -1, "LONG " * 50_000), (9, "-", "", 3, "3:abc")]
    rows += [(77, "copy", "en", 1, "Copy")] * 300
    assert _found(spark, rows) == _brute(rows)


def test_blocks_of_several_tiers(spark):
    rows = _rows(150) + [(500 + i, "s", f"lang{i}", 1, "X") for i in range(20)]
    assert _found(spark, rows, height=1) == _brute(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 8, 9])
def test_small_tables(spark, n):
    rows = _rows(n)
    assert _found(spark, rows) == _brute(rows)


def test_layout_is_a_permutation_and_keeps_subtrees_together():
    for heights in range(1, 6):
        places = np.concatenate([merkle.address(d, np.arange(8**d), heights) for d in range(heights)])
        assert sorted(places) == list(range(merkle.tree_size(heights)))
    # The lower trees of a tree of four levels are stretches of nine addresses each.
    for k in range(64):
        below = [merkle.address(2, np.array([k]), 4), merkle.address(3, np.arange(8 * k, 8 * k + 8), 4)]
        assert sorted(np.concatenate(below)) == list(range(9 + 9 * k, 18 + 9 * k))


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 64, 65, 513, 4096])
def test_block_equals_plain_tree(n):
    leaves = [_h(str(i)) for i in range(n)]
    levels = merkle.levels_of(n)
    tree = _tree(leaves)
    assert levels == len(tree) - 1
    nodes = merkle.built_block([v.encode() for v in leaves], levels)
    for d, level in enumerate(reversed(tree)):
        assert nodes[merkle.address(d, np.arange(len(level)), levels + 1)].tolist() == [v.encode() for v in level]
    paths = merkle.block_paths(nodes, n, levels)
    for i in (0, n // 2, n - 1):
        node = leaves[i]
        for left, right in paths[i]:
            node = _h(left + node + right)
        assert node == tree[-1][0]
