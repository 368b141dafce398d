"""Hard negatives against brute force over all rows."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from playmart.llm import hard_negatives, queries

LABEL = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"


def brute(rows, scale=256):
    held = []
    for i, label, x in rows:
        if i is not None and label is not None and x is not None and all(c is not None and math.isfinite(c) and math.isfinite(c * scale) for c in x):
            held.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(float(c) * scale) for c in x]))
    clip = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    out = []
    for a, (i, label, x) in enumerate(held):
        if i % 100:
            continue
        scored = sorted((-clip(sum(p * q for p, q in zip(x, y))), j, other) for b, (j, other, y) in enumerate(held) if b != a)  # noqa: B905
        for p, positive in [(-s, j) for s, j, other in scored if other == label][:5]:
            fit = [(j, -s) for s, j, other in scored if other != label and 30 * p <= -100 * s <= 90 * p][:10]
            out += [(i, positive, k + 1, j, p, s) for k, (j, s) in enumerate(fit)]
    return sorted(out)


def mined(df, **kwargs):
    return sorted(map(tuple, hard_negatives.hard_negatives(df, F.col("id") % 100 == 0, F.expr(LABEL), **kwargs).collect()))


def test_whole_table_and_sql(spark, tiny):
    table = spark.read.parquet(f"{tiny}/embeddings.parquet")
    rows = [(r.vec_id, r.label, r.embedding) for r in table.collect()]
    got = sorted(map(tuple, queries.op12_hard_negatives(spark, tiny).collect()))
    assert got == brute(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tiny}/embeddings.parquet'")
    assert sorted(con.execute(queries.ORACLE_SQL["op12_hard_negatives"]).fetchall()) == got


@pytest.mark.parametrize("spread", [0.02, 0.5, 40.0])
def test_two_rounds_chunks_ties_and_hot_vectors(spark, spread):
    """Clustered rows, of which a third are one vector: the second round and several chunks have work, bounds cut cells off."""
    rng = np.random.default_rng(3)
    centers = rng.normal(0, 1, (6, 10))
    rows = [(int(i), int(rng.integers(0, 4)), (centers[i % 6] + rng.normal(0, spread, 10)).tolist()) for i in range(400)]
    rows += [(400 + i, i % 3, rows[0][2]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    want = brute(rows)
    assert want
    for kwargs in ({"first_rows": 5, "chunk_rows": 30, "code_words": 5}, {"first_rows": 1, "chunk_rows": 7, "code_words": 3, "fit_rows": 20}, {}):
        assert mined(df, **kwargs) == want


def test_bounds_leave_cells_out(spark):
    """Far clusters are certified not to matter, and are not visited."""
    rng = np.random.default_rng(4)
    centers = rng.normal(0, 5, (16, 8))
    rows = [(int(i), int(i % 2), (centers[i % 16] + rng.normal(0, 0.01, 8)).tolist()) for i in range(800)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    index = hard_negatives.Index(hard_negatives.participants(df, F.col("label"), 256, "vec_id", "embedding"), 16, 1000, 64)
    cells = int((index.directory.rows > 0).sum())
    q = np.floor(np.array(rows[0][2]) * 256)
    best = max(sum(math.floor(a * 256) * b for a, b in zip(r[2], q.tolist(), strict=True)) for r in rows)
    assert 1 <= len(list(index.directory.cells(q, best, best))) < cells / 2
    assert len(list(index.directory.cells(q, -math.inf, math.inf))) == cells


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(8)
    rows = [(i, i % 3, rng.normal(0, 1, 4).tolist()) for i in range(250)]
    rows += [(None, 1, [1.0] * 4), (300, None, [1.0] * 4), (301, 1, None), (302, 1, [1.0, None, 0.0, 0.0]), (303, 1, [nan] * 4), (304, 1, [inf, 0.0, 0.0, 0.0])]
    rows += [(100, 1, rows[100][2]), (305, 2, [0.5]), (306, 2, []), (400, 0, [1e9, -1e9, 1e-9, 3.0]), (401, 0, [1e18, 1e18, 1e18, 1e18]), (402, 1, [1e307, 0.0, 0.0, 0.0]), (403, 1, [5e8, -5e8, 0.0, 0.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, label int, embedding array<double>, `row.x` int")
    assert mined(df, chunk_rows=50, first_rows=10) == brute(rows)
    assert mined(spark.createDataFrame([], df.schema)) == []
    assert mined(df.where("label = 1 AND vec_id % 7 > 0")) == []  # no row of another label
