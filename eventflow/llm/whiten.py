"""Whitening of embeddings from exact cross-products of bit planes.

Every entry c of a vector becomes the integer ``x = floor(scale * c) + offset``. The *fit list* holds each
distinct integer vector once (one shuffle with map-side combine, written as a table, read by the later
passes). Per dimension the smallest value is taken off, so that what is left needs few bits:

1. one pass gives the number of vectors and each dimension's least and greatest value;
2. one pass cuts each dimension into bit planes, packs a plane over the rows of a block into 64-bit words,
   and counts the ones of ``plane AND plane`` for all pairs of planes; the counts weighted by 2**(a+b) are the
   exact cross-products. A task adds up its blocks and emits one row per pair of dimensions, which Spark sums;
3. the driver centres as integers, ``n * P_ij - S_i * S_j`` (Python integers, no rounding), divides once,
   and takes the eigenvectors of that d x d matrix;
4. one pass over the fit list measures the covariance of what whitening gives (``identity_error``);
5. the rows are whitened batch by batch.

The driver and each task hold d x d figures, d the number of dimensions (a property of the vectors, not of
their number), and a task one block of rows besides.

Corner cases: rows whose vector is null, empty, or holds null or non-finite entries, or entries whose integer
would not fit (``|scale * c| >= 2**62``), take no part; where lengths differ the commonest one counts (ties:
the smaller) and rows of other lengths take no part. Rows of equal vectors, or of one id, all stay; a null id
stays null. Other columns are not read. An empty table gives an empty result. A component without variance
(eigenvalue at most d * 2**-52 of the largest) has whitened values of null and is left out of ``identity_error``,
which is null when none is left. ``deviation`` is exact at any size (decimal); see ``whiten``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventflow.llm.shared import Tables

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Rows whose bit planes are packed at a time: 256 words a plane.
BLOCK_ROWS = 16_384
#: Rows whitened at a time.
OUT_ROWS = 2_048


@dataclass
class Whitening:
    """A fitted whitening. ``values`` and ``vectors`` (columns) fall by eigenvalue; ``low`` and ``total`` are
    per dimension: what is taken off every x, and the sum of what is left over the ``n`` fitted vectors."""

    n: int
    low: np.ndarray
    high: np.ndarray
    total: list[int]
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float | None = None

    @property
    def trace(self) -> float:
        return float(np.trace(self.covariance))

    def live(self, components: int) -> np.ndarray:
        """Which of the first components have variance."""
        top = self.values[0] if len(self.values) else 0.0
        return self.values[:components] > max(top, 0.0) * len(self.values) * 2.0 ** -52


def integers(vector: Column, scale: int = SCALE, offset: int = OFFSET) -> Column:
    """The integer vector of ``vector``, null where it takes no part."""
    d = F.transform(vector, lambda c: c.cast("double") * F.lit(float(scale)))
    fine = F.forall(d, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(2.0 ** 62)), F.lit(False)))
    return F.when((F.size(vector) > 0) & fine, F.transform(d, lambda c: F.floor(c) + F.lit(offset)))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.int64).reshape(-1, d)


def _blocks(batches: Iterator[pa.RecordBatch], d: int, rows: int) -> Iterator[np.ndarray]:
    for b in batches:
        x = _matrix(b.column(0), d)
        for lo in range(0, len(x), rows):
            yield x[lo:lo + rows]


def _ranges(d: int):
    def run(batches):
        n, low, high = 0, None, None
        for x in _blocks(batches, d, BLOCK_ROWS):
            a, b = x.min(0), x.max(0)
            n, low, high = n + len(x), (a if low is None else np.minimum(low, a)), (b if high is None else np.maximum(high, b))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.array(np.full(d, n)), pa.array(low), pa.array(high)],
                                             ["i", "n", "low", "high"])
    return run


def plane_products(y: np.ndarray, bits: int) -> np.ndarray:
    """Ones of ``plane AND plane`` for all pairs of bit planes of the non-negative ``y`` (rows x d):
    an array [d * bits, d * bits] of which the upper triangle is filled; plane i * bits + a is bit a of dimension i."""
    rows, d = y.shape
    words = -(-rows // 64)
    planes = np.zeros((d * bits, words * 8), np.uint8)
    for a in range(bits):
        packed = np.packbits(((y >> a) & 1).astype(np.uint8), axis=0).T
        planes[a::bits, :packed.shape[1]] = packed
    planes = planes.view(np.uint64)
    out = np.zeros((d * bits, d * bits), np.int64)
    for p in range(d * bits):
        out[p, p:] = np.bitwise_count(planes[p] & planes[p:]).sum(1, dtype=np.int64)
    return out


def _scatter(low: np.ndarray, bits: int):
    """One row per pair of dimensions i <= j and task: the exact sum of y_i * y_j; pairs (i, -1): the sum of y_i."""
    d = len(low)

    def run(batches):
        counts = None
        for x in _blocks(batches, d, BLOCK_ROWS):
            got = plane_products(x - low, bits)
            counts = got if counts is None else counts + got
        if counts is None:
            return
        counts = np.triu(counts) + np.triu(counts, 1).T
        planes = counts.reshape(d, bits, d, bits)
        product = np.zeros((d, d), object)
        for a in range(bits):
            for b in range(bits):
                product += planes[:, a, :, b].astype(object) * (1 << (a + b))
        ones = np.diagonal(counts).reshape(d, bits)
        i, j = np.triu_indices(d)
        sums = [sum(int(ones[k, a]) << a for a in range(bits)) for k in range(d)]
        rows = [*(int(v) for v in product[i, j]), *sums]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([i, np.arange(d)]).astype(np.int32)), pa.array(np.concatenate([j, np.full(d, -1)]).astype(np.int32)),
             pa.array([Decimal(v) for v in rows], pa.decimal128(38, 0))], ["i", "j", "s"])
    return run


def centred(x: np.ndarray, w: Whitening) -> np.ndarray:
    """``n * x - S`` per entry, exact: 64-bit integers, or Python integers where these would overflow."""
    wide = w.n * (int((w.high - w.low).max(initial=0)) + 1) >= 1 << 62
    y = (x - w.low).astype(object) if wide else x - w.low
    return y * w.n - np.array(w.total, object if wide else np.int64)


def _deviation(c: np.ndarray) -> list[int]:
    """Per row the exact sum of squares."""
    top = max(int(abs(c).max(initial=0)), 1)
    c = c if c.dtype == object or top * top * c.shape[1] < 1 << 63 else c.astype(object)
    return [int(v) for v in (c * c).sum(1)]


def _project(c: np.ndarray, w: Whitening, k: int) -> np.ndarray:
    live = w.live(k)
    factors = w.vectors[:, :k][:, live] / np.sqrt(w.values[:k][live])
    out = np.full((len(c), k), np.nan)
    out[:, live] = (c.astype(float) / w.n) @ factors
    return out


def _second_moments(w: Whitening, k: int):
    def run(batches):
        n, total, square = 0, np.zeros(k), np.zeros((k, k))
        for x in _blocks(batches, len(w.low), BLOCK_ROWS):
            z = _project(centred(x, w), w, k)
            n, total, square = n + len(z), total + z.sum(0), square + z.T @ z
        if n:
            i, j = np.triu_indices(k)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([i, np.arange(k)]).astype(np.int32)),
                                              pa.array(np.concatenate([j, np.full(k, -1)]).astype(np.int32)),
                                              pa.array(np.concatenate([square[i, j], total]))], ["i", "j", "s"])
    return run


def _prepared(df: DataFrame, id_col: str, vector_col: str, scale: int, offset: int) -> tuple[DataFrame, int]:
    rows = df.select(F.col(id_col).cast("long").alias("id"), integers(F.col(vector_col), scale, offset).alias("x")).where(F.col("x").isNotNull())
    top = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    d = top[0]["d"] if top else 0
    return rows.where(F.size("x") == d), d


def fit(x: DataFrame, d: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of the distinct vectors ``x`` (one column of integer arrays of length ``d``)."""
    stats = (x.mapInArrow(_ranges(d), "i int, n long, low long, high long").groupBy("i")
             .agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).orderBy("i").collect())
    n, low, high = stats[0]["n"], np.array([r["low"] for r in stats], np.int64), np.array([r["high"] for r in stats], np.int64)
    bits = max(int((high - low).max()).bit_length(), 1)
    product, total = [[0] * d for _ in range(d)], [0] * d
    for r in x.mapInArrow(_scatter(low, bits), "i int, j int, s decimal(38,0)").groupBy("i", "j").agg(F.sum("s").cast("string").alias("s")).collect():
        if r["j"] < 0:
            total[r["i"]] = int(r["s"])
        else:
            product[r["i"]][r["j"]] = product[r["j"]][r["i"]] = int(r["s"])
    covariance = np.array([[(n * product[i][j] - total[i] * total[j]) / (n * n) for j in range(d)] for i in range(d)])
    values, vectors = np.linalg.eigh(covariance)
    w = Whitening(n, low, high, total, covariance, values[::-1].copy(), vectors[:, ::-1].copy())
    k = min(components, d)
    live = np.flatnonzero(w.live(k))
    if len(live):
        moment, mean = np.zeros((k, k)), np.zeros(k)
        for r in x.mapInArrow(_second_moments(w, k), "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
            if r["j"] < 0:
                mean[r["i"]] = r["s"] / n
            else:
                moment[r["i"], r["j"]] = moment[r["j"], r["i"]] = r["s"] / n
        cov = (moment - np.outer(mean, mean))[np.ix_(live, live)]
        w.identity_error = float(np.abs(cov - np.eye(len(live))).max())
    return w


def _whitened(w: Whitening, k: int):
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, OUT_ROWS):
                part = b.slice(lo, OUT_ROWS)
                c = centred(_matrix(part.column(1), len(w.low)), w)
                z, rows = _project(c, w, k), part.num_rows
                deviation = [Decimal(v) if v < 10 ** 38 else None for v in _deviation(c)]
                at = np.repeat(np.arange(rows), k)
                flat = z.ravel()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                     pa.array(deviation, pa.decimal128(38, 0)).take(pa.array(at)), pa.array(flat, mask=np.isnan(flat))],
                    ["id", "component", "deviation", "whitened"])
    return run


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """Rows and components: ``id_col``, component (from 1), n, deviation (decimal(38,0): the exact sum over the
    dimensions of (n*x - S)**2, null from 10**38 on), whitened, explained, identity_error, eigenvalue."""
    spark = df.sparkSession
    schema = f"{id_col} long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double, eigenvalue double"
    rows, d = _prepared(df, id_col, vector_col, scale, offset)
    if not d:
        return spark.createDataFrame([], schema)
    with Tables(spark, "whiten") as tables:
        w = fit(tables.put(rows.select("x").distinct(), "fit"), d, components)
    k = min(components, d)
    trace = w.trace
    table = F.array(*[F.struct(F.lit(float(e)).alias("e"), F.lit(float(e) / trace if trace > 0 else None).cast("double").alias("x")) for e in w.values[:k]])
    out = rows.mapInArrow(_whitened(w, k), "id long, component int, deviation decimal(38,0), whitened double")
    error = None if w.identity_error is None or math.isnan(w.identity_error) else w.identity_error
    return out.select(F.col("id").alias(id_col), "component", F.lit(w.n).cast("long").alias("n"), "deviation", "whitened",
                      F.element_at(table, F.col("component"))["x"].alias("explained"), F.lit(error).cast("double").alias("identity_error"),
                      F.element_at(table, F.col("component"))["e"].alias("eigenvalue"))
