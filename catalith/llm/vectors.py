"""Near-duplicate vectors: randomised-rotation binary codes find the pairs, estimate their cosine, and say which need the exact one."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.llm.common import components, finished_groups, long_column, run_pairs, stored, values, widened


@dataclass(frozen=True)
class VectorConfig:
    """Pairs with a cosine of ``threshold`` or more link.

    ``recall`` is the chance to bring together a pair just at the threshold; closer pairs have a better one. ``slack`` is the half-width of the confidence
    bound in units of an estimate's error. ``bucket`` vectors share a key on average, ``block`` rows of a bucket are held together at most.
    """

    threshold: float = 0.95
    recall: float = 0.99
    slack: float = 3.0
    bucket: int = 4
    block: int = 1024
    seed: int = 4


@dataclass(frozen=True)
class Plan:
    """How many tables of how many bits, for vectors of a width."""

    width: int
    tables: int
    bits: int
    seed: int

    @property
    def rotations(self) -> int:
        return -(-self.tables * self.bits // self.width)


def plan_tables(n: int, width: int, config: VectorConfig) -> Plan:
    """Bits by the number of vectors; tables by the chance that a pair at the threshold agrees in all bits of one: a sign differs with angle / pi."""
    bits = max(1, math.ceil(math.log2(max(2, n / config.bucket))))
    agree = (1 - math.acos(config.threshold) / math.pi) ** bits
    return Plan(width, math.ceil(math.log(1 - config.recall) / math.log(1 - agree)), bits, config.seed)


@functools.cache
def rotations(plan: Plan) -> np.ndarray:
    """Random orthogonal matrices, stacked: (rotations * width, width)."""
    rng = np.random.default_rng(plan.seed)
    return np.vstack([np.linalg.qr(rng.standard_normal((plan.width, plan.width)))[0] for _ in range(plan.rotations)])


@functools.cache
def table_bits(plan: Plan) -> np.ndarray:
    """(tables, bits): which signs make each table's key; no sign is used twice."""
    order = np.random.default_rng(plan.seed + 1).permutation(plan.rotations * plan.width)
    return order[: plan.tables * plan.bits].reshape(plan.tables, plan.bits)


def unit_rows(raw: list[bytes]) -> np.ndarray:
    """Vectors out of their bytes, scaled to length 1."""
    x = np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def codes(x: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code words, correction factors, table keys) of unit vectors.

    The code is the signs under the first rotation, one bit a dimension; the factor is the inner product of a vector and its code as a unit vector.
    """
    turned = x @ rotations(plan).T
    signs = turned > 0
    first = turned[:, : plan.width]
    factors = np.abs(first).sum(1) / math.sqrt(plan.width)
    chosen = signs[:, table_bits(plan)]
    keys = chosen @ (1 << np.arange(min(plan.bits, 62), dtype=np.int64)) if plan.bits <= 62 else chosen @ np.random.default_rng(0).integers(1, 1 << 62, plan.bits)
    return pack_words(signs[:, : plan.width]), factors, keys


def pack_words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    wide = np.zeros((len(bits), -(-bits.shape[1] // 64) * 64), bool)
    wide[:, : bits.shape[1]] = bits
    return np.packbits(wide, axis=1, bitorder="little").view("<u8")


@dataclass
class Queries:
    """Rotated vectors in four bits a dimension, as bit planes, so that an inner product with a code is a few population counts."""

    planes: list[np.ndarray]
    low: np.ndarray
    step: np.ndarray
    total: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray, plan: Plan) -> Queries:
        turned = x @ rotations(plan)[: plan.width].T
        low = turned.min(1)
        step = np.maximum((turned.max(1) - low) / 15, 1e-12)
        noise = np.random.default_rng(plan.seed + 2).random(plan.width)  # rounding up by chance keeps the sums unbiased
        level = np.clip(np.floor((turned - low[:, None]) / step[:, None] + noise), 0, 15).astype(np.uint8)
        return cls([pack_words((level >> k) & 1 > 0) for k in range(4)], low, step, turned.sum(1))


def estimates(words: np.ndarray, factors: np.ndarray, queries: Queries, i: np.ndarray, j: np.ndarray, width: int) -> np.ndarray:
    """Unbiased estimates of the cosines of pairs (i, j): j's rotated vector on i's code, over i's correction factor."""
    code = words[i]
    ones = np.bitwise_count(code).sum(1)
    weighted = sum((np.bitwise_count(code & plane[j]).sum(1).astype(np.int64) << k) for k, plane in enumerate(queries.planes))
    on = queries.low[j] * ones + queries.step[j] * weighted
    return (2 * on - queries.total[j]) / math.sqrt(width) / factors[i]


def margin(factors: np.ndarray, width: int, slack: float) -> np.ndarray:
    """Half-width of the confidence bound of estimates with these factors, rounding to four bits included."""
    return slack * (np.sqrt(np.maximum(0, 1 - factors**2)) / factors / math.sqrt(max(1, width - 1)) + 1 / (30 * math.sqrt(width) * factors))


def clean_vectors(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """(key, raw): bytes of the vectors that have a direction. NULL, empty, zero, and those with NULL or non-finite components are left out."""
    schema = widened(vectors.select(key).schema, "raw binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, raw = [], []
            for i, v in enumerate(values(batch, column)):
                if not v or None in v:
                    continue
                x = np.array(v, "<f8")
                if np.isfinite(x).all() and x.any():
                    at.append(i)
                    raw.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(at, pa.int32())), pa.array(raw, pa.binary())], names=[key, "raw"])

    return vectors.select(key, column).mapInArrow(run, schema)


def coded_vectors(classes: DataFrame, plan: Plan) -> DataFrame:
    """``classes`` (sid, raw, weight) with code, factor and keys."""
    schema = widened(classes.schema, "code binary, factor double, keys array<bigint>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            words, factors, keys = codes(unit_rows(values(batch, "raw")), plan)
            arrays = [pa.array([w.tobytes() for w in words], pa.binary()), pa.array(factors), pa.array(list(keys.astype(np.int64)), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(batch.columns + arrays, names=schema.names)

    return classes.mapInArrow(run, schema)


def bucket_blocks(coded: DataFrame, config: VectorConfig) -> DataFrame:
    """Rows dealt to (table, key, block_a, block_b): every two rows of a bucket meet in one group, and no group holds more than about two blocks.

    A bucket within one block is one group. A larger one is cut into blocks by a hash of the vector, and each block goes to its pairs with all others.
    """
    rows = coded.select("sid", "raw", "weight", "code", "factor", "keys", F.posexplode("keys").alias("table", "key"))
    sizes = rows.groupBy("table", "key").agg(F.count("*").alias("held")).where("held > 1")
    rows = rows.join(sizes, ["table", "key"])
    blocks = F.ceil(F.col("held") / config.block).cast("long")
    rows = rows.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("sid"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    rows = rows.select("*", other).drop("held", "blocks")
    return rows.withColumn("block_a", F.least("own", "other")).withColumn("block_b", F.greatest("own", "other")).drop("other")


def _labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row that each row is joined to by the pairs."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def linked_blocks(blocks: DataFrame, plan: Plan, config: VectorConfig) -> DataFrame:
    """(sid, links, edge) per row of a group that links: the weight of its partners there, and a vector it is joined to.

    A pair counts in the first table where its keys agree, so sums over groups count each pair once. Pairs whose bound stays below the threshold are dropped;
    all others get their exact cosine. Edges join what a group links with one edge a vector, however many pairs it has.
    """
    rows = blocks.repartition("table", "key", "block_a", "block_b").sortWithinPartitions("table", "key", "block_a", "block_b", "sid")

    def work(t: pa.Table) -> Iterator[pa.RecordBatch]:
        x = unit_rows(t["raw"].to_pylist())
        words = np.frombuffer(b"".join(t["code"].to_pylist()), "<u8").reshape(len(x), -1)
        factors, keys = t["factor"].to_numpy(), np.array(t["keys"].to_pylist(), np.int64)
        sid, weight, own, table = (t[c].to_numpy() for c in ("sid", "weight", "own", "table"))
        group = np.stack([t[c].to_numpy().astype(np.int64) for c in ("table", "key", "block_a", "block_b")], 1)
        two = group[:, 2] != group[:, 3]
        queries, bound = Queries.of(x, plan), margin(factors, plan.width, config.slack)
        starts = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]).any(1)])
        links, ei, ej = np.zeros(len(x), np.int64), [], []
        for i, j in run_pairs(starts, np.r_[starts[1:], len(x)], 200_000):
            fine = ~two[i] | (own[i] != own[j])
            i, j = i[fine], j[fine]
            hopeful = estimates(words, factors, queries, i, j, plan.width) + bound[i] >= config.threshold
            i, j = i[hopeful], j[hopeful]
            early = ((keys[i] == keys[j]) & (np.arange(plan.tables)[None, :] < table[i][:, None])).any(1)
            i, j = i[~early], j[~early]
            exact = np.einsum("ij,ij->i", x[i], x[j]) >= config.threshold
            i, j = i[exact], j[exact]
            np.add.at(links, i, weight[j])
            np.add.at(links, j, weight[i])
            ei.append(i)
            ej.append(j)
        if ei:
            label = _labels(len(x), np.concatenate(ei), np.concatenate(ej))
            held = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [long_column(sid[held]), long_column(links[held]), long_column(sid[label[held]])], names=["sid", "links", "edge"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in finished_groups(batches, ("table", "key", "block_a", "block_b")):
            yield from work(t)

    return rows.mapInArrow(run, "sid bigint, links bigint, edge bigint")


def near_vectors(vectors: DataFrame, config: VectorConfig = VectorConfig(), key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """One row per row of ``vectors``: key, n_links, component_id, kept.

    Vectors without a direction (NULL, zero, NULL or non-finite components) and rows with a NULL key link with nothing. Vectors of different widths never
    link. Equal vectors are one class with a weight, so copies are counted, not paired. Rows that repeat a key are vectors of their own with one
    component. Other columns are not read. An empty table gives an empty result.
    """
    rows = vectors.select(key, column)
    clean = stored(clean_vectors(rows.where(F.col(key).isNotNull()), key, column).withColumn("digest", F.md5("raw")), "vectors")
    classes = clean.groupBy("digest").agg(F.min(key).alias("low"), F.count("*").alias("weight"), F.first("raw").alias("raw"))
    classes = stored(classes.withColumn("sid", F.monotonically_increasing_id()).withColumn("width", F.length("raw") / 8), "classes")
    found = None
    for width, n in sorted((int(r[0]), r[1]) for r in classes.groupBy("width").count().collect()):
        plan = plan_tables(n, width, config)
        own = classes.where(F.col("width") == width).select("sid", "raw", "weight")
        part = linked_blocks(bucket_blocks(stored(coded_vectors(own, plan), "codes"), config), plan, config)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "sid bigint, links bigint, edge bigint")
    found = stored(found, "links")
    same = clean.groupBy(key).agg(F.min("digest").alias("first"), F.max("digest").alias("last")).where("first <> last").select(key, "first")
    by = classes.select("digest", "sid")
    same = clean.join(same, key).join(by, "digest").join(by.select(F.col("digest").alias("first"), F.col("sid").alias("a")), "first").select("a", F.col("sid").alias("b"))
    comps = components(found.select(F.col("sid").alias("a"), F.col("edge").alias("b")).unionByName(same))
    sums = found.groupBy("sid").agg(F.sum("links").alias("links"))
    info = classes.select("digest", "sid", "low", "weight").join(sums, "sid", "left").join(comps.withColumnRenamed("node", "sid"), "sid", "left")
    info = info.withColumn("comp", F.coalesce("component", "sid"))
    lowest = info.groupBy("comp").agg(F.min("low").alias("component_id"))
    n_links = (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    info = stored(info.join(lowest, "comp").select(F.col("digest").alias("_digest"), n_links, "component_id"), "answers")
    known = clean.join(info, F.col("digest") == F.col("_digest")).select(key, "n_links", "component_id")
    direct = F.transform(column, lambda v: v.cast("double"))
    bad = F.exists(direct, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) | ~F.exists(direct, lambda v: v != 0)
    rest = rows.where(F.col(key).isNull() | F.col(column).isNull() | F.coalesce(bad, F.lit(True)))
    rest = rest.select(key, F.lit(0).cast("long").alias("n_links"), F.col(key).alias("component_id"))
    return known.unionByName(rest).withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False)))
