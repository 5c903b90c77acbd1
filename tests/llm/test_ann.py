import numpy as np
import pytest
from helpers import with_clashes
from pyspark.sql import functions as F

from eventflow.llm import ann
from eventflow.llm.hilbert import hilbert_keys

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k):
    good = {}
    for i, v in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, str(r[1]))):
        if i is not None and v and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = min(good.get(i, v), v)
    out = {}
    for q in (i for i in good if i % 20 == 0):
        sims = sorted((-sum(float(np.float32(a)) * float(np.float32(b)) for a, b in zip(good[q], good[i], strict=True)), i) for i in good if i != q)
        out[q] = [i for _, i in sims[:k]]
    return out


def test_hilbert_neighbours_are_adjacent():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3), -1).reshape(-1, 3)
    keys = hilbert_keys(grid, 3)
    assert sorted(keys.tolist()) == list(range(512))
    assert np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1).max() == 1


def test_corner_cases_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 8)]) for i in range(90)]
    rows += [(100 + i, [1.0] * 8) for i in range(30)]  # equal vectors: ties by id
    rows += [(200, None), (220, [0.0] * 8), (240, [float("nan")] * 8), (260, [1.0, None] * 4), (280, [float("inf")] * 8), (300, [1.0, 2.0]),
             (None, [1.0] * 8), (20, rows[20][1]), (320, []), (7, rows[7][1])]
    df = with_clashes(spark.createDataFrame(rows, SCHEMA))
    got = {}
    for r in ann.nearest(df, F.col("id") % 20 == 0, ranges=1, reach=0, curves=1).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == brute(rows, 20)


def test_empty_and_blocks(spark, monkeypatch):
    assert ann.nearest(spark.createDataFrame([], SCHEMA), F.col("id") % 20 == 0).count() == 0
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    whole = {(r[0], r[1], r[2]) for r in ann.nearest(df, F.col("id") % 20 == 0).collect()}
    monkeypatch.setattr(ann, "BLOCK_ROWS", 16)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 4)
    assert {(r[0], r[1], r[2]) for r in ann.nearest(df, F.col("id") % 20 == 0).collect()} == whole


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_recall(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = df.collect()
    ids, m = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    got = {}
    for r in ann.nearest(df, F.col("id") % 20 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q, found in got.items():
        sims = m @ m[ids == q][0]
        sims[ids == q] = -9
        hits += len(found & set(ids[np.lexsort((ids, -sims))[:20]].tolist()))
    assert hits >= 0.9 * 20 * len(got) and len(got) == (ids % 20 == 0).sum()
