import math
import random

import pytest
from pyspark.sql import functions as F

from tripmill.operators import monitoring as M


def test_completeness_counts_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(1, None), (2, None), (None, None)], "a int, `b c` string")
    got = {r.column_name: (r.present, r.total, r.completeness) for r in M.completeness(df).collect()}
    assert got == {"a": (2, 3, 2 / 3), "b c": (0, 3, 0.0)}
    assert {r.completeness for r in M.completeness(df.limit(0)).collect()} == {None}


@pytest.mark.parametrize("bins", [2, 3, 1024])
@pytest.mark.parametrize("kind", ["spread", "ties", "one", "tiny"])
def test_value_at_rank(spark, monkeypatch, bins, kind):
    monkeypatch.setattr(M, "HISTOGRAM_BINS", bins)
    rng = random.Random(3)
    values = {"spread": [rng.gauss(0, 1e6) for _ in range(200)],
              "ties": [float(rng.randint(0, 3)) for _ in range(200)], "one": [7.5],
              "tiny": [1.0 + i * 2 ** -52 for i in range(8)]}[kind]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
    for share in (0.25, 0.75, 1.0):
        want = sorted(values)[max(1, math.ceil(share * len(values))) - 1]
        assert M.value_at_rank(df, "x", share) == (want, len(values))


def test_outliers_and_no_values(spark):
    df = spark.createDataFrame([(float(i), None) for i in range(1, 21)] + [(100.0, None)],
                               "x double, y double")
    x, y = M.outliers(df, ["x", "y"]).orderBy("column_name").collect()
    assert (x.n_outliers, x.total, y.n_outliers, y.q1) == (1, 21, 0, None)


def test_drift_of_equal_and_moved_rows(spark):
    df = spark.range(1000).select((F.col("id") % 10).cast("double").alias("same"),
                                  F.when(F.col("id") < 500, F.col("id") % 5).otherwise(
                                      F.col("id") % 10).cast("double").alias("moved"),
                                  (F.col("id") >= 500).alias("now"))
    drift = M.feature_drift(df, F.col("now"), {"same": (0.0, 10.0, 10), "moved": (0.0, 10.0, 10)})
    got = {r.feature: (r.psi, r.alert) for r in M.drift_alert(drift).collect()}
    assert got["same"] == (pytest.approx(0.0), False)
    e, a = [0.2] * 5 + [1e-6] * 5, [0.1] * 10
    assert got["moved"] == (pytest.approx(sum((y - x) * math.log(y / x) for x, y in zip(e, a))), True)


def test_bins_and_quality(spark):
    got = spark.createDataFrame([(-1.0,), (0.0,), (9.9,), (10.0,)], "x double").select(
        M.bin_of(F.col("x"), 0.0, 10.0, 5).alias("b")).collect()
    assert [r.b for r in got] == [0, 1, 5, 6]
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, 3.0), ("b", 5.0, 5.5), ("b", None, 1.0)],
                               "g string, duration double, prediction double")
    a, b = M.model_quality(df, F.col("g")).orderBy("g").collect()
    assert (a.n, a.rmse, a.mae, a.r2) == (2, pytest.approx(0.5 ** 0.5), 0.5, pytest.approx(0.5))
    assert (b.n, b.r2) == (1, None)


def test_ranks_of_several_columns_together(spark):
    rng = random.Random(5)
    rows = [(rng.gauss(0, 3), float(rng.randint(0, 4)), None) for _ in range(500)]
    df = spark.createDataFrame(rows, "a double, `b c` double, d double")
    shares = [0.01, 0.25, 0.5, 0.999]
    got = M.values_at_ranks(df, {"a": shares, "b c": shares, "d": [0.5]})
    for name, place in (("a", 0), ("b c", 1)):
        values = sorted(r[place] for r in rows)
        assert got[name] == ([values[math.ceil(s * 500) - 1] for s in shares], 500)
    assert got["d"] == ([None], 0)


def test_jobs_do_not_grow_with_the_columns(spark):
    df = spark.range(20_000).select(*[(F.rand(i) * 1000).alias(f"c{i}") for i in range(6)])

    def jobs(columns):
        group = f"outliers-{len(columns)}"
        spark.sparkContext.setJobGroup(group, "")
        M.outliers(df, columns)
        spark.sparkContext.setJobGroup("other", "")
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    one, six = jobs(["c0"]), jobs([f"c{i}" for i in range(6)])
    assert six <= one + 3


def psi(e, a):
    te, ta = sum(e), sum(a)
    pairs = [(max(x / te, 1e-6), max(y / ta, 1e-6)) for x, y in zip(e, a)]
    return sum((y - x) * math.log(y / x) for x, y in pairs)


def test_drift_of_a_column_of_many_values(spark):
    rng = random.Random(7)
    rows = [(f"v{int(rng.random() ** 3 * 400)}", False) for _ in range(3000)]
    rows += [(f"v{int(rng.random() ** 2 * 400)}", True) for _ in range(2000)]
    rows += [(None, False), (None, True)]
    df = spark.createDataFrame(rows, "v string, now boolean")
    counts = {}
    for v, now in rows:
        counts.setdefault(v, [0, 0])[now] += 1
    heavy = {v for v, (e, _) in counts.items() if v is not None and e >= 0.01 * 3001}
    bins = [counts[v] for v in sorted(heavy)]
    bins.append([sum(c[k] for v, c in counts.items() if v not in heavy) for k in (0, 1)])
    got = M.value_drift(df, F.col("now"), "v", 0.01).first()
    assert 5 < len(heavy) < 60 and got.feature == "v"
    assert got.psi == pytest.approx(psi(*zip(*bins)))
    assert M.value_drift(df.limit(0), F.col("now"), "v", 0.01).count() == 0


def test_summaries_merge_and_hold_every_frequent_value(spark):
    df = spark.range(60_000).select(F.concat(F.lit("x"), F.floor(F.pow(F.rand(3), 4) * 30_000).cast("int"))
                                    .alias("v"), (F.col("id") % 5).alias("month")).cache()
    parts = M.heavy_summary(df, "v", F.col("month"))
    assert parts.count() == 5
    found = {r.value for r in M.frequent_values(parts, 0.002).collect()}
    true = {r.v for r in df.groupBy("v").count().where("count >= 0.002 * 60000").collect()}
    assert true and true <= found and len(found) <= 1 / (0.002 - M.SUMMARY_ERROR) + 1
    with pytest.raises(ValueError):
        M.frequent_values(parts, M.SUMMARY_ERROR)


def test_quantile_edges_and_their_drift(spark):
    df = spark.createDataFrame([(float(i % 7), i < 40) for i in range(100)] + [(None, True)],
                               "x double, now boolean")
    edges = M.quantile_edges(df.where("NOT now"), ["x"], 4)["x"]
    values = sorted(float(i % 7) for i in range(40, 100))
    assert edges == sorted({values[math.ceil(s * 60) - 1] for s in (0.25, 0.5, 0.75)})
    bins = [[0, 0] for _ in range(len(edges) + 1)]
    for i in range(100):
        bins[sum(e < i % 7 for e in edges)][i < 40] += 1
    got = M.feature_drift(df, F.col("now"), {"x": edges}).first()
    assert got.psi == pytest.approx(psi(*zip(*bins)))


def test_the_range_of_a_value_is_found_without_a_join(spark):
    spans = {(0, 1.0, 2.0): 0, (1, 0.0, 9.0): 1, (0, 4.0, 6.0): 2, (0, 2.5, 3.0): 3}
    df = spark.createDataFrame([(0, 0.5), (0, 1.0), (0, 2.0), (0, 2.2), (0, 3.0), (0, 5.0), (0, 7.0),
                                (1, 9.0), (1, 10.0), (2, 1.0)], "c int, v double")
    found = df.withColumn("s", M._span_of(F.col("v"), F.col("c"), spans))
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    got = {(r.c, r.v): r.s.span if r.s and r.s.low <= r.v else None for r in found.collect()}
    assert got == {(0, 0.5): None, (0, 1.0): 0, (0, 2.0): 0, (0, 2.2): None, (0, 3.0): 3, (0, 5.0): 2,
                   (0, 7.0): None, (1, 9.0): 1, (1, 10.0): None, (2, 1.0): None}
