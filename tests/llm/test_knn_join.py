import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from logweave.llm import knn_join
from logweave.llm.knn_join import top_inner_products
from logweave.llm.oracle import KNN_JOIN

SF = "/root/testdata/sf0.01"


def brute(rows, k=5, every=50):
    whole = {(i, tuple(math.floor(256 * float(np.float64(x))) for x in v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q in {i for i, _ in whole if i % every == 0}:
        best = sorted((-sum(a * b for a, b in zip(x, v)), i) for j, x in whole if j == q for i, v in whole if i != q)[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    return sorted(out)


def result(df, every=50):
    return sorted(tuple(r) for r in top_inner_products(df, F.col("vec_id") % every == 0).collect())


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    assert result(df) == sorted(con.sql(KNN_JOIN).fetchall()) == brute([(r.vec_id, r.embedding) for r in df.collect()])


@pytest.mark.parametrize("spread", [0.01, 1.0])
def test_clusters_hot_vector_and_small_blocks(spark, spread, monkeypatch):
    monkeypatch.setattr(knn_join, "GROUP_ROWS", 7)
    monkeypatch.setattr(knn_join, "BLOCK_ROWS", 40)
    monkeypatch.setattr(knn_join, "PIVOTS", 12)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 6))
    rows = [(i, (centres[i % 8] + spread * rng.normal(size=6)).astype("float32").tolist()) for i in range(600)]
    rows += [(1000 + i, rows[3][1]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert result(df, 25) == brute(rows, every=25)


def test_pruning_leaves_cells_out(spark):
    pivots = np.array([[100.0, 0], [-100.0, 0], [0, 100.0]])
    import pyarrow as pa

    run = knn_join._needed(pivots, np.array([0, 1, 2]), np.array([5.0, 5.0, 5.0]), np.array([0] * 6 + [1] * 6 + [2] * 6), np.ones(18), 6)
    batch = pa.record_batch([pa.array([7]), pa.array([[90, 0]])], names=["g", "v"])
    assert next(run([batch])).to_pylist() == [{"g": 7, "cell": 0}]


def test_edge_cases(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0]), (2, None), (3, [None, 1.0]), (4, [inf, 0.0]), (5, [nan, 0.0]), (None, [5.0, 5.0]), (50, [0.5, -0.25]), (6, []), (7, [1e30, -1e30]), (100, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as score", "2 as rank")
    got = result(df)
    cut = [(i, [min(max(x, -(2**31 - 1) / 256), (2**31 - 1) / 256) for x in v] if v and None not in v and all(map(math.isfinite, v)) else v) for i, v in rows]
    assert got == brute(cut)


def test_few_and_none(spark):
    assert result(spark.createDataFrame([], "vec_id long, embedding array<float>")) == []
    assert result(spark.createDataFrame([(50, [1.0])], "vec_id long, embedding array<float>")) == []
    assert result(spark.createDataFrame([(50, [1.0]), (3, [2.0])], "vec_id long, embedding array<float>")) == [(50, 1, 3, 256 * 512)]
    assert result(spark.createDataFrame([(1, [1.0]), (3, [2.0])], "vec_id long, embedding array<float>")) == []
