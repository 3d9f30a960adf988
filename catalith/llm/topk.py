"""Exact top-k by inner product: tiles of queries and shards are multiplied as matrices, each keeps its best, and lists are merged as a tree."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.llm.common import join_width, long_column, matrices, stored, whole_vectors

LISTS = "width int, block bigint, shard bigint, row bigint, query_id bigint, vec_id bigint, score bigint, rank int"
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


@dataclass(frozen=True)
class TopConfig:
    """The ``k`` best of each query; entries are floor(``scale`` * entry).

    A block of queries or shard of candidates holds about ``cells`` entries; ``strip`` queries of a block are multiplied at once, and ``fan`` lists of a query
    meet in a merge.
    """

    k: int = 20
    scale: int = 64
    cells: int = 1 << 18
    strip: int = 256
    fan: int = 16


def inner_products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of integers, in the narrowest arithmetic that holds them all; beyond longs the nearest long."""
    bound = _reach(q) * _reach(c) * q.shape[1]
    if bound < 1 << 53:
        kind = np.float32 if bound < 1 << 24 else np.float64
        return q.astype(kind) @ c.astype(kind).T
    if bound <= _MOST:
        return q @ c.T
    return np.clip(q.astype(object) @ c.astype(object).T, _LEAST, _MOST).astype(np.int64)


def _reach(x: np.ndarray) -> int:
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


def best_of(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, columns) of the ``k`` highest of each row, of equal ones the first columns: all above the k-th highest, then as many equal to it as fit."""
    k = min(k, scores.shape[1])
    if not k:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    last = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
    i, j = np.nonzero(scores >= last[:, None])
    order = np.lexsort((j, -scores[i, j].astype(np.float64) if scores.dtype != np.int64 else ~scores[i, j], i))
    i, j = i[order], j[order]
    starts = np.searchsorted(i, np.arange(len(scores)))
    keep = np.arange(len(i)) - starts[i] < k
    return i[keep], j[keep]


def _ids(t: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(values, which are NULL)."""
    column = t[name].combine_chunks()
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), column.is_null().to_numpy(zero_copy_only=False)


def _lists(t: pa.Table, shard: int, row, query_id, vec_id, void, score, k: int) -> pa.Table:
    """The first ``k`` of each query row with their ranks: by score, smaller id, NULL ids last."""
    order = np.lexsort((vec_id, void, ~score, row))
    row, query_id, vec_id, void, score = (v[order] for v in (row, query_id, vec_id, void, score))
    rank = np.arange(len(row)) - np.searchsorted(row, row) + 1
    at = rank <= k
    n = int(at.sum())
    fixed = [pa.array(np.full(n, v), kind) for v, kind in ((t["width"][0].as_py(), pa.int32()), (t["block"][0].as_py(), pa.int64()), (shard, pa.int64()))]
    arrays = [*fixed, long_column(row[at]), long_column(query_id[at]), pa.array(vec_id[at], pa.int64(), mask=void[at]), long_column(score[at]), pa.array(rank[at].astype(np.int32))]
    return pa.table(arrays, names=["width", "block", "shard", "row", "query_id", "vec_id", "score", "rank"])


def scored_tiles(queries: DataFrame, shards: DataFrame, config: TopConfig) -> DataFrame:
    """The best of each query in each shard; both sides hold (width, block, shard, row, key, x), and a tile is a group of both."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({f.name: pa.array([], f.type) for f in kind})
        (_, q), (_, c) = next(matrices(left["x"].combine_chunks())), next(matrices(right["x"].combine_chunks()))
        own, query_id = left["row"].to_numpy(), left["key"].to_numpy()
        ids, void = _ids(right, "key")
        order = np.lexsort((right["row"].to_numpy(), ids, void))
        c, ids, void, rows = c[order], ids[order], void[order], right["row"].to_numpy()[order]
        found: list[tuple] = []
        for at in range(0, len(q), config.strip):
            scores = inner_products(q[at : at + config.strip], c)
            i, j = best_of(scores, config.k + 1)  # one more, as the query itself may be among them
            keep = own[at + i] != rows[j]
            i, j = i[keep], j[keep]
            found.append((at + i, j, scores[i, j].astype(np.int64)))
        i, j, score = (np.concatenate(v) for v in zip(*found))
        return _lists(left, right["shard"][0].as_py(), own[i], query_id[i], ids[j], void[j], score, config.k)

    kind = pa.schema([("width", pa.int32())] + [(n, pa.int64()) for n in ("block", "shard", "row", "query_id", "vec_id", "score")] + [("rank", pa.int32())])
    by = ("width", "block", "shard")
    return queries.groupBy(*by).cogroup(shards.groupBy(*by)).applyInArrow(run, LISTS)


def merged_lists(lists: DataFrame, config: TopConfig) -> DataFrame:
    """Lists of ``fan`` neighbouring shards become one."""

    def run(t: pa.Table) -> pa.Table:
        ids, void = _ids(t, "vec_id")
        return _lists(t, t["shard"][0].as_py(), t["row"].to_numpy(), t["query_id"].to_numpy(), ids, void, t["score"].to_numpy(), config.k)

    return lists.withColumn("shard", F.floor(F.col("shard") / config.fan)).groupBy("width", "block", "shard").applyInArrow(run, LISTS)


def top_scores(vectors: DataFrame, queries: Column | None = None, config: TopConfig = TopConfig(), key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for every row that ``queries`` selects (by default ids divisible by 20) its best rows other than itself.

    Scores are exact inner products of the whole entries; ties go to the smaller id, NULL ids last. Rows are told apart even where ids repeat: a second row
    with a query's id is a candidate, and a repeated query gives its list once per row. Vectors that are NULL or hold NULL or non-finite entries take no
    part, rows of NULL id are candidates only, and vectors of different widths do not meet (vectors without entries meet with score 0). A query with fewer
    than ``k`` others gets all; one with none gives no row. Other columns are not read; an empty table gives an empty result.

    Every row is sent once per block of queries and every query once per shard, so with b rows a block n rows and m queries move about n * m * 2 / b vectors
    for n * m products; blocks and shards are dealt by a hash of the row number, so none is larger than about ``cells`` entries whatever keys repeat.
    """
    wanted = (F.col("key") % 20 == 0) if queries is None else queries
    whole = whole_vectors(vectors, key, column, config.scale).withColumn("key", F.col("key").cast("bigint"))
    rows = stored(whole.select("*", (F.coalesce(wanted, F.lit(False)) & F.col("key").isNotNull()).alias("asks"), F.monotonically_increasing_id().alias("row")), "rows")
    most = F.greatest(F.lit(64), F.floor(F.lit(config.cells) / F.greatest("width", F.lit(1))))
    sizes = rows.groupBy("width").agg(F.count("*").alias("n"), F.count_if("asks").alias("m")).where("m > 0")
    sizes = stored(sizes.select("width", F.ceil(F.col("n") / most).alias("shards"), F.ceil(F.col("m") / most).alias("blocks")), "sizes")
    placed = join_width(rows, sizes)

    def all_of(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(count) - 1))

    same = [F.col(c).alias(c) for c in ("width", "row", "key", "x")]  # named anew: both sides of the tiles come from one table
    asks = placed.where("asks").select(*same, F.pmod(F.xxhash64("row", F.lit(1)), "blocks").alias("block"), all_of("shards").alias("shard"))
    holds = placed.select("width", "row", "key", "x", all_of("blocks").alias("block"), F.pmod(F.xxhash64("row"), "shards").alias("shard"))
    lists = scored_tiles(asks, holds, config)
    left = sizes.agg(F.max("shards")).first()[0] or 1
    while left > 1:
        lists = merged_lists(lists, config)
        left = -(-left // config.fan)
    return lists.select("query_id", "rank", "vec_id", "score")
