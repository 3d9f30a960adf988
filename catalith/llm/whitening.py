"""Whitening of vectors: a distributed covariance, float32 eigenvectors of it, and their correction by matrix products in double precision."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.llm.common import discard, join_width, matrices, stored, whole_vectors


@dataclass(frozen=True)
class WhitenConfig:
    """Entries are floor(``scale`` * entry); the first ``components`` eigenvectors are kept.

    An eigenvalue of ``flat`` times the trace or less is rounding noise: its direction has no scale. ``cells`` entries of covariance are held per task.
    """

    components: int = 4
    scale: int = 256
    flat: float = 1e-12
    cells: int = 1 << 24


def _spectral(a: np.ndarray) -> float:
    return float(np.linalg.norm(a, 2)) if a.size else 0.0


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Runs of two or more eigenvalues that follow each other within ``gap``."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [run for run in np.split(order, cuts) if len(run) > 1]


def refined_eigen(a: np.ndarray, depth: int = 0, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors in columns) of a symmetric matrix, by falling eigenvalue.

    Starts from eigenvectors in float32. A round takes R = I - X'X and S = X'AX in double precision, reads the eigenvalues off S, and adds X E, where E is
    (S + lambda R) / gap between separate eigenvalues and R / 2 between close ones, so that X turns and stays orthonormal with the square of its error.
    Eigenvalues too close for that form a cluster: the matrix is shifted by their mean and projected on their span, where the gaps are large against the
    rest, and the small problem is solved in the same way.
    """
    size = len(a)
    scale = np.abs(a).max(initial=0.0)
    if scale == 0:
        return np.zeros(size), np.eye(size)
    b = a / scale
    x = np.linalg.eigh(b.astype(np.float32))[1].astype(np.float64)
    norm, last = _spectral(b), np.inf
    for _ in range(rounds):
        r = np.eye(size) - x.T @ x
        s = x.T @ (b @ x)
        s = (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        close = 2 * (_spectral(s - np.diag(values)) + norm * _spectral(r))
        gap = values[None, :] - values[:, None]
        near = np.abs(gap) <= close
        e = np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, 1, gap))
        x = x + x @ e
        for run in _clusters(values, close):
            x[:, run] = _separated(b, x[:, run], float(values[run].mean()), depth)
        step = np.abs(e).max()
        if step <= 4 * np.finfo(float).eps or step >= last and step < 1e-12:
            break
        last = step
    values = np.einsum("ij,ij->j", x, b @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-values, kind="stable")
    return values[order] * scale, x[:, order] / np.linalg.norm(x[:, order], axis=0)


def _separated(b: np.ndarray, q: np.ndarray, shift: float, depth: int) -> np.ndarray:
    """The span of ``q`` in eigenvectors of the shifted matrix on it; the shift is taken off in extended precision, where the small gaps survive."""
    q, _ = np.linalg.qr(q)
    wide = q.astype(np.longdouble)
    small = wide.T @ (b.astype(np.longdouble) @ wide - np.longdouble(shift) * wide)
    small = np.asarray((small + small.T) / 2, np.float64)
    turn = np.linalg.eigh(small)[1] if depth >= 3 else refined_eigen(small, depth + 1)[1]
    return q @ turn


def fit_sums(fit: DataFrame) -> DataFrame:
    """(width, n, sums, reach) of the distinct vectors ``x``: exact sums per dimension and the largest magnitude."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for _, x in matrices(batch.column(0)):
                width = x.shape[1]
                reach = max(int(x.max(initial=0)), -int(x.min(initial=0)))
                small = reach * len(x) < 1 << 62
                sums = x.sum(0) if small else x.astype(object).sum(0)
                n, before, most = held.get(width, (0, np.zeros(width, object), 0))
                held[width] = [n + len(x), before + sums.astype(object), max(most, reach)]
        for width, (n, sums, reach) in held.items():
            exact = pa.array([int(v) for v in sums], pa.decimal128(38, 0))
            same = [pa.array([v] * width, t) for v, t in ((width, pa.int32()), (n, pa.int64()))]
            arrays = [*same, pa.array(range(width), pa.int32()), exact, pa.array([reach] * width, pa.decimal128(38, 0))]
            yield pa.RecordBatch.from_arrays(arrays, names=["width", "n", "place", "total", "reach"])

    parts = fit.select("x").mapInArrow(run, "width int, n bigint, place int, total decimal(38,0), reach decimal(38,0)")
    places = parts.groupBy("width", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("reach").alias("reach"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("place", "total"))), lambda p: p["total"])
    return places.groupBy("width").agg(F.max("n").alias("n"), listed.alias("sums"), F.max("reach").alias("reach"))


def _less(x: Column, n: Column) -> Column:
    """n * x - sums as longs; only evaluated where it fits."""
    return F.zip_with("x", "sums", lambda v, s: n * v - s.cast("bigint"))


def _less_wide() -> Column:
    return F.zip_with("x", "sums", lambda v, s: F.col("n").cast("decimal(19,0)") * v.cast("decimal(19,0)") - s)


def centred() -> Column:
    """x - S / n in doubles: one exact difference of integers and one division."""
    fits = F.col("reach") * F.col("n") < F.lit(1 << 61)
    narrow = F.transform(_less(F.col("x"), F.col("n")), lambda v: v.cast("double") / F.col("n"))
    return F.when(fits, narrow).otherwise(F.transform(_less_wide(), lambda v: v.cast("double") / F.col("n")))


def deviation() -> Column:
    """Sum over dimensions of (n * x - S) squared, exact; NULL where it leaves the range of a long."""
    spread = F.col("reach").cast("double") * F.col("n") * 2
    fits = spread * spread * F.col("width") < float(1 << 62)
    narrow = F.aggregate(_less(F.col("x"), F.col("n")), F.lit(0).cast("bigint"), lambda t, v: t + v * v)
    zero = F.lit(0).cast("decimal(38,0)")
    wide = F.aggregate(
        F.transform(_less_wide(), lambda v: v.cast("decimal(38,0)")), zero,
        lambda t, v: F.try_add(t, F.try_multiply(v, v).cast("decimal(38,0)")).cast("decimal(38,0)"),
    )
    return F.when(fits, narrow).otherwise(wide.try_cast("bigint"))


def scatter(centred_rows: DataFrame, cells: int) -> DataFrame:
    """(width, place, line): the sum of y y' over the rows ``y``, one line of it per row.

    Tasks add up matrix products and let lines out when they end or hold ``cells`` entries; the lines of each place are added in a group of their own.
    """

    def lines(held: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for width, total in held.items():
            arrays = [pa.array([width] * width, pa.int32()), pa.array(range(width), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["width", "place", "line"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, y in matrices(batch.column(0)):
                width = y.shape[1]
                held[width] = held.get(width, 0) + y.T @ y
                if sum(v.size for v in held.values()) > max(cells, width * width):
                    yield from lines(held)
                    held = {}
        yield from lines(held)

    def add(t: pa.Table) -> pa.Table:
        total = np.vstack([v for _, v in matrices(t["line"].combine_chunks())]).sum(0)
        return pa.table([t["width"].slice(0, 1), t["place"].slice(0, 1), pa.array([total], pa.list_(pa.float64()))], names=["width", "place", "line"])

    schema = "width int, place int, line array<double>"
    return centred_rows.select("y").mapInArrow(run, schema).groupBy("width", "place").applyInArrow(add, schema)


def eigen_directions(lines: DataFrame, config: WhitenConfig) -> DataFrame:
    """(width, trace, directions): trace and first eigenvectors of each width's matrix; a matrix of the vectors' width is what one task holds."""

    def run(t: pa.Table) -> pa.Table:
        order = np.argsort(t["place"].to_numpy())
        a = np.array(t["line"].to_pylist(), float)[order]
        values, vectors = refined_eigen((a + a.T) / 2)
        trace = float(np.trace(a))
        first = []
        for k in range(min(config.components, len(a))):
            v = vectors[:, k] * (1 if vectors[np.argmax(np.abs(vectors[:, k])), k] > 0 else -1)
            value = float(values[k])
            first.append({"value": value if value > config.flat * trace else None, "part": max(0.0, value) / trace if trace > 0 else None, "vector": v.tolist()})
        kind = pa.list_(pa.struct([("value", pa.float64()), ("part", pa.float64()), ("vector", pa.list_(pa.float64()))]))
        return pa.table([t["width"].slice(0, 1), pa.array([trace]), pa.array([first], kind)], names=["width", "trace", "directions"])

    return lines.groupBy("width").applyInArrow(run, "width int, trace double, directions array<struct<value: double, part: double, vector: array<double>>>")


def _along(y: Column, direction: Column) -> Column:
    """Projection over the square root of the variance there; NULL without one."""
    dot = F.aggregate(F.zip_with(y, direction["vector"], lambda a, b: a * b), F.lit(0.0), lambda t, v: t + v)
    return dot / F.sqrt(direction["value"] / F.col("n"))


def whitened_vectors(vectors: DataFrame, config: WhitenConfig = WhitenConfig(), key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): one row per row of ``vectors`` and component.

    Rows whose vector is NULL or holds NULL or non-finite entries are left out; NULL and repeated keys are kept. The fit is over distinct vectors, so copies
    weigh nothing. Vectors of each width have a fit of their own; a vector without entries has no component and no row. Along a direction without variance
    (one distinct vector, fewer vectors than components) ``whitened`` is NULL, and such directions are left out of ``identity_error``, which is NULL when
    none is left; ``explained`` is NULL when all vectors are equal. Equal eigenvalues leave the choice of directions in their span free. Other columns are
    not read; an empty table gives an empty result.
    """
    rows = whole_vectors(vectors, key, column, config.scale)
    fit = stored(rows.select("x", "width").distinct(), "fit")
    sums = stored(fit_sums(fit), "sums")
    around = join_width(fit, sums)
    lines = stored(scatter(around.select(centred().alias("y")), config.cells), "scatter")
    found = stored(eigen_directions(lines, config).join(sums, "width"), "directions")
    seen = join_width(fit, found).withColumn("y", centred())
    seen = seen.select("width", F.transform("directions", lambda d: _along(F.col("y"), d)).alias("w"))
    pairs = [(i, j) for i in range(config.components) for j in range(i, config.components)]
    spread = seen.groupBy("width").agg(*[F.covar_pop(F.get("w", F.lit(i)), F.get("w", F.lit(j))).alias(f"c{i}_{j}") for i, j in pairs])
    off = [F.abs(F.col(f"c{i}_{j}") - float(i == j)) for i, j in pairs]
    error = (F.greatest(*off) if len(off) > 1 else off[0]).alias("identity_error")
    fits = stored(found.join(spread.select("width", error), "width"), "fits")
    discard(fit, sums, lines, found)
    out = join_width(rows, fits).select("key", "n", "identity_error", centred().alias("y"), deviation().alias("deviation"), F.posexplode("directions").alias("place", "d"))
    return out.select(
        F.col("key").alias(key), (F.col("place") + 1).alias("component"), "n", "deviation", _along(F.col("y"), F.col("d")).alias("whitened"),
        F.col("d.part").alias("explained"), "identity_error",
    )
