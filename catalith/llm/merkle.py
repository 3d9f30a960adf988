"""Merkle manifest of a table: trees of digests in blocks laid out as van Emde Boas trees, and inclusion proofs read out of them."""

from __future__ import annotations

import hashlib
import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalith.llm.common import stored

#: Children of a node.
FAN = 8
_PATH = "array<struct<left: string, right: string>>"


def tree_size(heights: int) -> int:
    """Nodes of a complete tree with ``heights`` levels of nodes."""
    return (FAN**heights - 1) // (FAN - 1)


def address(depth: int, index: np.ndarray, heights: int) -> np.ndarray:
    """Places of the nodes ``index`` of level ``depth`` in the layout of a complete tree with ``heights`` levels of nodes.

    The tree is cut at half its height. The upper tree comes first, then the lower trees from left to right, each laid out in the same way, so that a walk
    from a leaf to the root stays inside few stretches of memory whatever the size of a cache line or page.
    """
    if heights == 1:
        return np.zeros_like(index)
    upper = heights // 2
    if depth < upper:
        return address(depth, index, upper)
    lower = heights - upper
    below = FAN ** (depth - upper)
    return tree_size(upper) + index // below * tree_size(lower) + address(depth - upper, index % below, lower)


def levels_of(n: int) -> int:
    """Levels of edges above ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def counts_by_depth(leaves: int, levels: int) -> list[int]:
    """Nodes at each depth, root first."""
    counts = [leaves]
    for _ in range(levels):
        counts.append(-(-counts[-1] // FAN))
    return counts[::-1]


def digest(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def built_block(leaves: list[bytes], levels: int) -> np.ndarray:
    """Digests of all nodes over ``leaves``, each run of up to eight under one node, at their addresses."""
    nodes = np.zeros(tree_size(levels + 1), "S64")
    counts = counts_by_depth(len(leaves), levels)
    nodes[address(levels, np.arange(len(leaves)), levels + 1)] = leaves
    for depth in range(levels - 1, -1, -1):
        below = nodes[address(depth + 1, np.arange(counts[depth + 1]), levels + 1)].tolist()
        nodes[address(depth, np.arange(counts[depth]), levels + 1)] = [digest(b"".join(below[i : i + FAN])) for i in range(0, len(below), FAN)]
    return nodes


def block_paths(nodes: np.ndarray, leaves: int, levels: int) -> list[list[tuple[str, str]]]:
    """For every leaf, from its own level up, the digests to the left and to the right of the node in its run."""
    counts, paths = counts_by_depth(leaves, levels), [[] for _ in range(leaves)]
    for depth in range(levels, 0, -1):
        level = nodes[address(depth, np.arange(counts[depth]), levels + 1)].tolist()
        pairs = []
        for start in range(0, len(level), FAN):
            run = b"".join(level[start : start + FAN]).decode()
            pairs += [(run[: 64 * k], run[64 * (k + 1) :]) for k in range(len(level[start : start + FAN]))]
        below = FAN ** (levels - depth)
        for i in range(leaves):
            paths[i].append(pairs[i // below])
    return paths


def leaf_digest(values: list[Column]) -> Column:
    """SHA-256 of the values in turn: ``-`` for NULL, else the length in UTF-8 bytes, ``:`` and the value."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` (g, ..) with their place ``i`` in their group by ``order`` and the group's ``total``.

    One range sort; rows equal in all of ``order`` are told apart by a number, so that many equal rows are split as well. Places follow from the row numbers
    of partitions and the counts of each group per partition, of which a group has one per partition.
    """
    ranged = nodes.repartitionByRange("g", *order, "tie").sortWithinPartitions("g", *order, "tie")
    placed = stored(ranged.withColumn("seq", F.monotonically_increasing_id()), "ordered").withColumn("part", F.shiftright("seq", 33))
    runs = placed.groupBy("g", "part").agg(F.count("*").alias("n"), F.min("seq").alias("low"))
    group = Window.partitionBy("g")
    before = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("g", "part", "low", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(group).alias("total"))
    return placed.join(runs, ["g", "part"]).withColumn("i", F.col("seq") - F.col("low") + F.col("before")).drop("seq", "part", "low", "before", "tie")


@dataclass
class Manifest:
    """``leaves`` (g, i, total, digest and what else the rows hold), and for each tier its ``blocks`` (g, block, total, leaves, levels, root, nodes)."""

    leaves: DataFrame
    tiers: list[DataFrame]

    @property
    def roots(self) -> DataFrame:
        """(g, digest) of each group's root."""
        return self.tiers[-1].select("g", F.col("root").alias("digest"))


def _cut(nodes: DataFrame, height: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("i") / FAN**height))


def built_tier(nodes: DataFrame, height: int) -> DataFrame:
    """One row per block of up to 8 ** ``height`` neighbouring nodes of a group: its root, and all its digests in the layout, 32 bytes each."""

    def run(t: pa.Table) -> pa.Table:
        order = np.argsort(t["i"].to_numpy())
        leaves = [v.encode() for v in t["digest"].take(pa.array(order)).to_pylist()]
        total = t["total"][0].as_py()
        levels = min(height, levels_of(total))
        nodes = built_block(leaves, levels)
        raw = np.zeros((len(nodes), 32), np.uint8)
        held = np.flatnonzero(nodes != b"")
        raw[held] = np.frombuffer(bytes.fromhex(b"".join(nodes[held].tolist()).decode()), np.uint8).reshape(-1, 32)
        fixed = [pa.array([v], kind) for v, kind in ((total, pa.int64()), (len(leaves), pa.int32()), (levels, pa.int32()), (nodes[0].decode(), pa.string()))]
        return pa.table(
            [t["g"].slice(0, 1), t["block"].slice(0, 1), *fixed, pa.array([raw.tobytes()], pa.binary())],
            names=["g", "block", "total", "leaves", "levels", "root", "nodes"],
        )

    schema = "g string, block bigint, total bigint, leaves int, levels int, root string, nodes binary"
    return _cut(nodes, height).select("g", "block", "i", "total", "digest").groupBy("g", "block").applyInArrow(run, schema)


def built_tiers(nodes: DataFrame, height: int, purpose: str) -> list[DataFrame]:
    """Blocks over ``nodes``, blocks over their roots, and so on until each group has one root; a tier is 8 ** ``height`` times smaller than the one below."""
    tiers = []
    while True:
        tiers.append(stored(built_tier(nodes, height), purpose))
        most = tiers[-1].agg(F.max("total")).first()[0]
        if (most or 0) <= FAN**height:
            return tiers
        above = F.ceil(F.col("total") / FAN**height).alias("total")
        nodes = tiers[-1].select("g", F.col("block").alias("i"), above, F.col("root").alias("digest"))


def _layout(raw: bytes) -> np.ndarray:
    """Digests of a stored block as text."""
    text = raw.hex().encode()
    return np.frombuffer(text, "S64")


def walked_down(nodes: DataFrame, blocks: DataFrame, height: int) -> DataFrame:
    """(g, i, up, subroot, root): for each of ``nodes`` its path in its block, followed by the path ``up`` of that block, and the roots of the block."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        block = right.slice(0, 1).to_pylist()[0]
        found = block_paths(_layout(block["nodes"]), block["leaves"], block["levels"])
        places = left["i"].to_numpy() % FAN**height
        paths = [[{"left": a, "right": b} for a, b in found[k]] + block["up"] for k in places]
        kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
        roots = [pa.array([block[name]] * len(places), pa.string()) for name in ("subroot", "root")]
        return pa.table([left["g"], left["i"], pa.array(paths, kind), *roots], names=["g", "i", "up", "subroot", "root"])

    return _cogrouped(nodes.select("g", "i"), blocks, height).applyInArrow(run, f"g string, i bigint, up {_PATH}, subroot string, root string")


def _cogrouped(nodes: DataFrame, blocks: DataFrame, height: int):
    cut = _cut(nodes, height).select(*[F.col(c).alias(c) for c in [*nodes.columns, "block"]])
    return cut.groupBy("g", "block").cogroup(blocks.groupBy("g", "block"))


def paths_of_blocks(tiers: list[DataFrame], tops: DataFrame, height: int) -> DataFrame:
    """The lowest tier's blocks with the path ``up`` from their root to the root of all; ``tops`` (g, up, subroot, root) has the paths of the groups' roots."""

    def above(rows: DataFrame) -> DataFrame:
        return rows.select(F.col("g").alias("_g"), F.col("i").alias("_i"), "up", "subroot", "root")

    up = above(tops.withColumn("i", F.lit(0).cast("bigint")))
    for k in range(len(tiers) - 1, -1, -1):
        own = tiers[k].withColumnRenamed("root", "head")
        blocks = own.join(up, (F.col("g") == F.col("_g")) & (F.col("block") == F.col("_i"))).drop("_g", "_i", "head")
        if k:
            up = above(stored(walked_down(tiers[k - 1].select("g", F.col("block").alias("i")), blocks, height), "up"))
    return blocks


def built_manifest(rows: DataFrame, group: str, height: int = 4) -> tuple[Manifest, Manifest, DataFrame]:
    """(trees of the groups, tree over their roots, tops) of ``rows``, which hold ``digest``, ``key`` and ``group``.

    ``tops`` (g, subroot, root, up) has a row per group. Groups are ordered by their UTF-8 bytes, NULL first; inside a group rows go by key and digest, NULL
    first.
    """
    named = rows.withColumn("g", F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")))
    kept = stored(named.drop(group).withColumn("tie", F.monotonically_increasing_id()), "leaves")
    leaves = numbered(kept, ["key", "digest"])
    trees = Manifest(leaves, built_tiers(leaves, height, "blocks"))
    head = numbered(trees.roots.select(F.lit("").alias("g"), F.col("g").alias("name"), "digest", F.lit(0).alias("tie")), ["name"])
    top = Manifest(head, built_tiers(head, height, "top"))
    end = top.roots.select("g", F.array().cast(_PATH).alias("up"), F.lit("").alias("subroot"), F.col("digest").alias("root"))
    up = walked_down(head, paths_of_blocks(top.tiers, end, height), height).select(F.col("i").alias("_i"), "up", "root")
    tops = head.join(up, F.col("i") == F.col("_i")).select(F.col("name").alias("g"), F.col("digest").alias("subroot"), "root", "up")
    return trees, top, stored(tops, "tops")


def proved_leaves(leaves: DataFrame, blocks: DataFrame, other: str, height: int) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root) per leaf: the digest of its siblings up to the root, and what ``other``, or else the leaf, folds to."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        block = right.slice(0, 1).to_pylist()[0]
        found = block_paths(_layout(block["nodes"]), block["leaves"], block["levels"])
        above = [(p["left"].encode(), p["right"].encode()) for p in block["up"]]
        tail = b"".join(a + b for a, b in above)
        proofs, folds = [], []
        for k, own, changed in zip((left["i"].to_numpy() % FAN**height).tolist(), left["digest"].to_pylist(), left[other].to_pylist()):
            path = [(a.encode(), b.encode()) for a, b in found[k]]
            proofs.append(hashlib.sha256(b"".join(a + b for a, b in path) + tail).hexdigest())
            node = (changed or own).encode()
            for a, b in path + above:
                node = digest(a + node + b)
            folds.append(node.decode())
        same = [pa.array([block[name]] * len(proofs), pa.string()) for name in ("subroot", "root")]
        return pa.table([left["key"], left["digest"], *same, pa.array(proofs, pa.string()), pa.array(folds, pa.string())], names=names)

    names = ["key", "leaf", "subroot", "root", "proof_sha256", "folded_root"]
    schema = f"key {dict(leaves.dtypes)['key']}, " + ", ".join(f"{n} string" for n in names[1:])
    side = blocks.select("g", "block", "nodes", "leaves", "levels", "up", "subroot", "root")
    return _cogrouped(leaves.select("g", "i", "key", "digest", other), side, height).applyInArrow(run, schema)


def audited_documents(docs: DataFrame, fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), changed: dict[str, Column] | None = None, height: int = 4) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): every row of ``docs`` with its proof in the manifest by language.

    The first of ``fields`` is the key. ``changed`` holds expressions put in place of columns before a leaf is folded again, NULL where a row stays as it is.
    By default rows whose decimal id has a CRC-32 divisible by 3 get their text's A-Z lower-cased, so a row verifies exactly if it has nothing to change.

    NULL values, ids and languages make leaves like others (a NULL id is not changed); equal ids go by leaf, and repeated rows have proofs of their own, as
    equal leaves at different places. Empty and very long texts are hashed whole inside the JVM. Other columns are not read, and an empty table gives an
    empty result. The manifest (leaves, blocks) is written to the shared folder; a group of a task holds one block of 8 ** ``height`` digests.
    """
    if changed is None:
        hit = F.crc32(F.col(fields[0]).cast("string").cast("binary")) % 3 == 0
        changed = {"text": F.when(hit, F.translate("text", string.ascii_uppercase, string.ascii_lowercase))}
    touched = F.coalesce(*[F.when(c.isNotNull(), True) for c in changed.values()], F.lit(False))
    again = F.when(touched, leaf_digest([F.coalesce(changed[f], F.col(f)) if f in changed else F.col(f) for f in fields]))
    rows = docs.select(F.col(fields[0]).alias("key"), "lang", leaf_digest([F.col(f) for f in fields]).alias("digest"), again.alias("changed"))
    trees, _, tops = built_manifest(rows, "lang", height)
    proved = proved_leaves(trees.leaves, paths_of_blocks(trees.tiers, tops, height), "changed", height)
    return proved.withColumnRenamed("key", fields[0]).withColumn("verified", F.col("folded_root") == F.col("root"))
