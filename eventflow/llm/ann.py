"""Approximate nearest neighbours by shifted space-filling curves.

Vectors are projected several times to a few axes (seeded orthonormal projections), each axis is
rank-scaled on a bounded sample, shifted, cut into a grid and read off along a Hilbert curve. Each
curve is range-partitioned into ``ranges`` equal key ranges; a query meets the rows of its own
range and of ``reach`` neighbouring ranges on either side, on every curve. Those windows are
scored in blocks on the original vectors in double precision, and the windows' best rows merge.

The share of rows a query meets per curve is (2 reach + 1) / ranges. Vectors without any cluster
structure need a large share: with six curves, 8 ranges and a reach of 1, recall at 20 is above
0.95 on isotropic 64-axis vectors; clustered vectors get by with more and smaller ranges. Hot
ranges and many queries are dealt out in blocks of bounded rows, so no task holds a whole range.

Corner cases: rows with a null id take no part; vectors that are null, zero, hold null or
non-finite components or have another length than most take no part, neither as query nor as
candidate; of rows that repeat an id the smallest vector counts; equal vectors are one candidate
that stands for its k + 1 smallest ids; ties go to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventflow.llm.hilbert import hilbert_keys

CURVES, AXES, BITS, RANGES, REACH = 6, 4, 10, 8, 1
# Rows that the axes' scales are fitted on, at most (those with the smallest id hashes).
FIT_ROWS = 10_000
# Rows of a candidate block and of a query block, at most.
BLOCK_ROWS, BLOCK_QUERIES = 16_384, 8_192


class Curves:
    """The projections, scales and shifts of all curves."""

    def __init__(self, sample: np.ndarray, curves: int, axes: int, bits: int, seed: int = 11):
        rng = np.random.Generator(np.random.PCG64(seed))
        dims = sample.shape[1]
        self.bits, self.maps = bits, []
        axes = min(axes, dims)
        for _ in range(curves):
            rotation = np.linalg.qr(rng.normal(size=(dims, axes)))[0]
            steps = np.quantile(sample @ rotation, np.linspace(0, 1, 1025)[1:-1], axis=0)
            self.maps.append((rotation, steps, rng.random(axes) * 0.25))

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        out = np.empty((len(vectors), len(self.maps)), np.int64)
        for c, (rotation, steps, shift) in enumerate(self.maps):
            y = vectors @ rotation
            rank = np.stack([np.searchsorted(steps[:, a], y[:, a]) / 1024 for a in range(y.shape[1])], axis=1)
            cells = np.minimum((rank * 0.75 + shift) * (1 << self.bits), (1 << self.bits) - 1).astype(np.int64)
            out[:, c] = hilbert_keys(cells, self.bits)
        return out


def usable(vector: Column) -> Column:
    """Not null, not zero, every component present and finite."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("vec"))).groupBy("id").agg(F.min("vec").alias("vec"))
    lengths = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").head()
    return rows.where(F.size("vec") == (lengths["n"] if lengths else 0))


def _search(k: int):
    def best(key, left, right):
        names = ["query_id", "rep", "score"]
        types = [pa.int64(), pa.int64(), pa.float64()]
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_arrays([pa.array([], t) for t in types], names=names)
        ids = left["rep"].to_numpy()
        rows = np.stack(left["vec"].to_numpy())
        queries = np.stack(right["vec"].to_numpy())
        q_ids = right["query_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, rows = ids[order], rows[order]
        n = min(k + 1, len(ids))
        out_q, out_r, out_s = [], [], []
        for at in range(0, len(queries), 256):
            part = queries[at:at + 256]
            sims = part @ rows.T
            if n < len(ids):
                # Everything within rounding of the n-th best is kept, then scored exactly.
                floor = np.partition(sims, len(ids) - n, axis=1)[:, len(ids) - n]
                q, r = np.nonzero(sims >= (floor - 1e-9 * (1 + np.abs(floor)))[:, None])
            else:
                q, r = np.nonzero(np.ones_like(sims, dtype=bool))
            s = (part[q] * rows[r]).sum(axis=1)
            got = np.lexsort((ids[r], -s, q))
            q, r, s = q[got], r[got], s[got]
            first = np.searchsorted(q, np.arange(len(part)))
            keep = np.arange(len(q)) - first[q] < n
            out_q.append(q_ids[at + q[keep]])
            out_r.append(ids[r[keep]])
            out_s.append(s[keep])
        return pa.Table.from_arrays([pa.array(np.concatenate(x), t) for x, t in zip((out_q, out_r, out_s), types, strict=True)], names=names)
    return best


def nearest(df: DataFrame, is_query: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
            curves: int = CURVES, axes: int = AXES, bits: int = BITS, ranges: int = RANGES, reach: int = REACH) -> DataFrame:
    """The ``k`` nearest found rows (largest inner product) of each row for which ``is_query`` (over
    the column ``id``) holds: query_id, rank, vec_id, score; a query's own row is no candidate."""
    spark = df.sparkSession
    rows = _vectors(df, id_col, vector_col)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS).toArrow()["vec"]
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = spark.sparkContext.broadcast(Curves(np.stack(sample.to_numpy()), curves, axes, bits))

    def keys(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in batches:
            yield pd.Series(list(shared.value.keys(np.stack(vectors.to_numpy())))) if len(vectors) else pd.Series([], dtype=object)

    keys.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    keys_udf = F.pandas_udf(keys, "array<long>")

    # Equal vectors are one candidate with its k + 1 smallest ids (a query may be one of them).
    same = Window.partitionBy("vec").orderBy("id")
    reps = (rows.withColumn("n", F.row_number().over(same)).where(F.col("n") <= k + 1)
            .groupBy("vec").agg(F.min("id").alias("rep"), F.sort_array(F.collect_list("id")).alias("ids")))
    keyed = reps.select("rep", "vec", F.posexplode(keys_udf("vec")).alias("curve", "key"))
    cuts = {r["curve"]: r["cuts"] for r in keyed.groupBy("curve").agg(
        F.percentile_approx("key", [i / ranges for i in range(1, ranges)], 20_000).alias("cuts")).collect()} if ranges > 1 else {c: [] for c in range(curves)}
    counts = reps.agg(F.count("*").alias("n")).head()["n"]
    n_queries = rows.where(is_query).count()
    splits = -(-counts // (ranges * BLOCK_ROWS))
    query_splits = max(1, -(-n_queries * (2 * reach + 1) // (ranges * BLOCK_QUERIES)))

    def range_of(curve: Column, key: Column) -> Column:
        found = F.lit(0)
        for c, bounds in cuts.items():
            below = sum((F.when(key > b, 1).otherwise(0) for b in bounds), F.lit(0))
            found = F.when(curve == c, below).otherwise(found)
        return found

    blocks = keyed.select("rep", "vec", "curve", range_of(F.col("curve"), F.col("key")).alias("range"),
                          F.pmod(F.xxhash64("rep"), F.lit(splits)).cast("int").alias("split"),
                          F.explode(F.sequence(F.lit(0), F.lit(query_splits - 1))).alias("query_split"))
    asked = rows.where(is_query).select(F.col("id").alias("query_id"), "vec")
    asked = asked.select("query_id", "vec", F.pmod(F.xxhash64("query_id"), F.lit(query_splits)).cast("int").alias("query_split"),
                         F.posexplode(keys_udf("vec")).alias("curve", "key"))
    own = range_of(F.col("curve"), F.col("key"))
    asked = asked.select("query_id", "vec", "curve", "query_split",
                         F.explode(F.sequence(F.greatest(own - reach, F.lit(0)), F.least(own + reach, F.lit(ranges - 1)))).alias("range"))
    asked = asked.select("*", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))).alias("split"))
    group = ["curve", "range", "split", "query_split"]
    found = blocks.groupBy(*group).cogroup(asked.groupBy(*group)).applyInArrow(_search(k), "query_id long, rep long, score double")
    best = found.groupBy("query_id", "rep").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "rep")
    best = best.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    spread = best.join(reps.select("rep", "ids"), "rep").select("query_id", "score", F.explode("ids").alias("vec_id"))
    spread = spread.where(F.col("vec_id") != F.col("query_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (spread.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
