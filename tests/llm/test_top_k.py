"""Exact top-k against brute force."""

import math

import numpy as np
from pyspark.sql import functions as F

from playmart.llm import topk


def brute(rows, k, scale=64):
    v = {}
    for r, (i, x) in enumerate(rows):
        if i is not None and x is not None and all(c is not None and np.isfinite(c) for c in x):
            v[r] = i, [math.floor(float(c) * scale) if math.isfinite(float(c) * scale) else int(c) * scale for c in x]
    out = set()
    for r, (i, x) in v.items():
        if i % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y)), j) for s, (j, y) in v.items() if s != r)[:k]
            out |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(scores)}
    return out


def found(df, k=20):
    return {tuple(r) for r in topk.top_k(df, F.col("vec_id") % 20 == 0, k).collect()}


def test_whole_table(spark, tiny):
    table = spark.read.parquet(f"{tiny}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    assert found(table) == brute(rows, 20)


def test_several_blocks_ties_and_scales(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(1)
    for spread in (0.05, 1.0, 300.0):
        rows = [(int(i), [float(np.float32(c)) for c in rng.normal(0, spread, 8)]) for i in range(300)]
        rows += [(300 + i, rows[i % 7][1]) for i in range(60)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        assert found(df) == brute(rows, 20)


def test_components_of_any_size(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(topk, "GROUP_BYTES", 500)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    rng = np.random.default_rng(2)
    rows = [(int(i), rng.normal(0, 1, 4).tolist()) for i in range(120)]
    rows += [(120 + i, (rng.normal(0, 1, 4) * 10.0 ** rng.choice([0, 4, 8])).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    shown = lambda rows: {(q, r, v, max(-(1 << 63), min((1 << 63) - 1, s))) for q, r, v, s in brute(rows, 20)}
    assert found(df) == shown(rows)
    # scores beyond 64 bits are ranked as they are
    rows += [(200 + i, [1e300 * s, 1e9, float(i), -1.7e308]) for i, s in enumerate([1, -1, 1 + 1e-15, 0.5, 0, 1, 1e-300])]
    rows += [(220 + i, [20000.0, 1e9 + i, 0.3, 1e9]) for i in range(30)]
    got = found(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert got == shown(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, [1.0]), (40, []), (60, None), (80, [1.0, None]), (100, [nan, 1.0]), (120, [inf, 1.0]), (7, [-1.0, 0.3]), (7, [-1.0, 0.3]), (None, [1.0, 1.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    assert found(df) == brute(rows, 20)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert found(empty) == set()
    assert found(spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")) == set()
