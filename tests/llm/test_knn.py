import random

import numpy as np
from brute import rows, top_k
from pyspark.sql import functions as F

from tripmill.llm import knn, queries


def found(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def test_every_query_against_all_pairs(spark, sf_dir):
    table = [(r["vec_id"], r["embedding"]) for r in rows(sf_dir, "embeddings")]
    assert found(queries.op2_voronoi_knn(spark, sf_dir)) == top_k(table, lambda i: i % 20 == 0, 20)


def test_many_cells_and_blocks_with_a_hot_vector(spark):
    rng = random.Random(5)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(9)]
    table = [(i, [c + rng.gauss(0, 0.05) for c in centres[i % 9]]) for i in range(600)]
    table += [(600 + i, [0.5] * 6) for i in range(300)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>")
    got = knn.top_k(df, F.col("vec_id") % 20 == 0, 20, max_pivots=12, rows_per_pivot=50, block=40)
    assert found(got) == top_k(table, lambda i: i % 20 == 0, 20)


def test_far_cells_are_left_out():
    pivots = np.array([[0.0, 0.0], [100.0, 0.0]])
    low, high = knn.reach(pivots, np.array([1.0, -1.0]), [np.array([0.1, 0.2, 0.3])] * 2, 2)
    assert low[0, 0] < 0 < high[0, 0] and low[0, 1] > 90 and high[1, 0] == -np.inf


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    table = [(0, [1.0, 2.0]), (20, [1.0]), (20, [1.0]), (40, []), (1, [0.5, -3.0]), (2, None),
             (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (None, [9.0, 9.0]), (60, None),
             (7, [2.0, 2.0]), (7, [2.0, 2.0]), (8, [-0.001, 0.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in table],
                               "vec_id long, embedding array<double>, score string")
    got = found(knn.top_k(df, F.col("vec_id") % 20 == 0, 4))
    assert got == top_k(table, lambda i: i % 20 == 0, 4)
    assert found(knn.top_k(df.limit(0), F.col("vec_id") % 20 == 0)) == []


def test_the_driver_sends_only_cell_pairs(spark, monkeypatch):
    table = [(i, [float(i % 7), float(i % 5)]) for i in range(400)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>")
    sent, make = [], type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame",
                        lambda self, data, *a, **k: (sent.append(len(data)), make(self, data, *a, **k))[1])
    got = knn.top_k(df, F.col("vec_id") % 4 == 0, 3, max_pivots=2, block=4)
    assert found(got) == top_k(table, lambda i: i % 4 == 0, 3)
    assert sent and sum(sent) <= 2 * 2
