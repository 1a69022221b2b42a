import json
import os
import random
import subprocess
import sys
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tripmill import schemas
from tripmill.operators import monitoring as M
from tripmill.session import fresh_folder
from tripmill.streaming import quality
from tripmill.streaming.rides import finish

START = datetime(2024, 5, 1)


def tables(spark, n=400, seed=2):
    rng = random.Random(seed)
    asked, came = [], []
    for i in range(n):
        at = START + timedelta(seconds=rng.randrange(5 * 86_400))
        asked.append((f"r{i}", at, rng.uniform(5, 30)))
        kind = rng.random()
        if kind < 0.7:
            came.append((f"r{i}", at + timedelta(seconds=rng.randrange(7_000)), rng.uniform(5, 30)))
        elif kind < 0.85:
            came.append((f"r{i}", at + timedelta(seconds=rng.randrange(7_300, 90_000)), 9.0))
    came += [came[0]] * 3 + [("nobody", START, 1.0), (None, START, 1.0)]
    asked.append((None, START, 3.0))
    return (spark.createDataFrame(asked, schemas.PREDICTION), spark.createDataFrame(came, schemas.ACTUAL),
            asked, came)


def plain(asked, came, within, closed=None):
    first = {}
    for ride, at, minutes in came:
        if ride is not None and (ride not in first or (at, minutes) < first[ride]):
            first[ride] = (at, minutes)
    out = []
    for ride, at, prediction in asked:
        found = first.get(ride)
        end = at + timedelta(seconds=within)
        if found and at <= found[0] <= end:
            out.append((ride, prediction, found[1], "matched"))
        elif closed is not None and end >= closed:
            out.append((ride, prediction, None, "pending"))
        else:
            out.append((ride, prediction, None, "late" if found else "missing"))
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r.ride_id, r.prediction, r.duration, r.outcome) for r in df.collect()), key=repr)


def test_batch_tells_matched_late_and_missing(spark):
    predictions, actuals, asked, came = tables(spark)
    got = rows(M.match_actuals(predictions, actuals, 7_200))
    assert got == plain(asked, came, 7_200)
    assert {r[3] for r in got} == {"matched", "late", "missing"}
    assert M.match_actuals(predictions.limit(0), actuals, 7_200).count() == 0
    assert rows(M.match_actuals(predictions, actuals.limit(0), 7_200)) == plain(asked, [], 7_200)


def test_stream_equals_batch_up_to_the_watermark(spark):
    predictions, actuals, asked, came = tables(spark)
    folders = [fresh_folder(spark, n) for n in ("asked", "came", "rated", "progress")]
    predictions.where("ride_id IS NOT NULL").write.parquet(folders[0])
    actuals.write.parquet(folders[1])
    finish(quality.stream_match(quality.stream_of(spark, folders[0], schemas.PREDICTION),
                                quality.stream_of(spark, folders[1], schemas.ACTUAL),
                                7_200, "1 hour", folders[2], folders[3]))
    closed = min(max(a[1] for a in asked), max(c[1] for c in came)) - timedelta(hours=1)
    named = [a for a in asked if a[0] is not None]
    got = rows(quality.stream_outcomes(spark, predictions.where("ride_id IS NOT NULL"), actuals,
                                       folders[2]))
    assert got == plain(named, came, 7_200, closed)
    batch = M.match_actuals(predictions.where("ride_id IS NOT NULL"), actuals, 7_200,
                            F.lit(closed).cast("timestamp"))
    assert rows(batch) == got
    assert {r[3] for r in got} == {"matched", "late", "missing", "pending"}


def test_an_actual_of_a_later_run_is_matched_from_the_state(spark):
    folders = [fresh_folder(spark, n) for n in ("asked", "came", "rated", "progress")]

    def run():
        finish(quality.stream_match(quality.stream_of(spark, folders[0], schemas.PREDICTION),
                                    quality.stream_of(spark, folders[1], schemas.ACTUAL),
                                    7_200, "1 hour", folders[2], folders[3]))
        return spark.read.schema(schemas.RATED_PREDICTION).parquet(folders[2]).collect()

    later = START + timedelta(minutes=30)
    spark.createDataFrame([("a", START, 8.0), ("b", START, 9.0)], schemas.PREDICTION).write.parquet(folders[0])
    spark.createDataFrame([("x", START, 1.0)], schemas.ACTUAL).write.parquet(folders[1])
    assert run() == []
    spark.createDataFrame([("a", later, 7.0)], schemas.ACTUAL).write.mode("append").parquet(folders[1])
    assert [(r.ride_id, r.duration) for r in run()] == [("a", 7.0)]
    end = START + timedelta(days=1)
    spark.createDataFrame([("c", end, 8.0)], schemas.PREDICTION).write.mode("append").parquet(folders[0])
    spark.createDataFrame([("c", end, 7.5)], schemas.ACTUAL).write.mode("append").parquet(folders[1])
    assert sorted((r.ride_id, r.duration) for r in run()) == [("a", 7.0), ("b", None), ("c", 7.5)]


def test_groups_count_outcomes_and_rate_the_matched(spark):
    df = spark.createDataFrame(
        [("g", 1.0, 2.0, "matched"), ("g", 3.0, 3.0, "matched"), ("g", None, 5.0, "late"),
         ("h", None, 1.0, "missing"), ("h", None, 1.0, "pending")],
        "k string, duration double, prediction double, outcome string")
    g, h = M.quality_over_time(df, F.col("k")).orderBy("k").collect()
    assert (g.n, g.n_matched, g.n_late, g.n_missing, g.n_pending) == (3, 2, 1, 0, 0)
    assert (g.rmse, g.mae, g.r2) == (0.5 ** 0.5, 0.5, 0.5)
    assert (h.n_missing, h.n_pending, h.rmse) == (1, 1, None)


def test_a_backlog_is_rated_span_by_span(spark, monkeypatch):
    ran = []
    monkeypatch.setattr(quality, "finish", lambda query: (finish(query), ran.append(query)))
    predictions, actuals, asked, came = tables(spark, 600)
    predictions = predictions.where("ride_id IS NOT NULL")
    folders = [fresh_folder(spark, n) for n in ("asked", "came", "rated", "progress")]
    spans = quality.land_in_order([(predictions, "predicted_ts", folders[0]),
                                   (actuals, "actual_ts", folders[1])], 250)
    assert spans > 3
    quality.match_backlog(spark, folders[0], folders[1], spans, 7_200, "1 hour", folders[2], folders[3])
    closed = min(max(a[1] for a in asked), max(c[1] for c in came)) - timedelta(hours=1)
    got = rows(quality.stream_outcomes(spark, predictions, actuals, folders[2]))
    assert got == plain([a for a in asked if a[0] is not None], came, 7_200, closed)
    # The state never held all rows: each run adds a span, and what was rated has left before the next.
    most = max(o["numRowsTotal"] for q in ran for p in q.recentProgress
               for o in json.loads(p.json)["stateOperators"] if o["operatorName"] == "symmetricHashJoin")
    assert len(ran) == spans and 0 < most < (len(asked) + len(came)) / 2


def test_a_span_may_lack_one_side(spark):
    folders = [fresh_folder(spark, n) for n in ("asked", "came", "rated", "progress")]
    predictions = spark.createDataFrame(
        [(f"r{i}", START + timedelta(days=i), 1.0) for i in range(6)], schemas.PREDICTION)
    actuals = spark.createDataFrame(
        [(f"r{i}", START + timedelta(days=i, hours=1), 2.0) for i in (0, 5)], schemas.ACTUAL)
    spans = quality.land_in_order([(predictions, "predicted_ts", folders[0]),
                                   (actuals, "actual_ts", folders[1])], 1)
    assert spans == 6
    quality.match_backlog(spark, folders[0], folders[1], spans, 7_200, "1 hour", folders[2], folders[3])
    outcomes = {r[0]: r[3] for r in rows(quality.stream_outcomes(spark, predictions, actuals, folders[2]))}
    assert outcomes == {"r0": "matched", "r5": "matched", **{f"r{i}": "missing" for i in (1, 2, 3, 4)}}


LONG_BACKLOG = """
import json, sys, time
from collections import Counter
from datetime import timedelta
from pathlib import Path
from test_quality import START, schemas
from tripmill.session import build_session, fresh_folder
from tripmill.streaming import quality

top = sys.argv[1]
spark = build_session("backlog", "local[2]", {
    "spark.ui.enabled": "false", "spark.driver.memory": "1g", "spark.driver.host": "127.0.0.1",
    "spark.sql.shuffle.partitions": "1", "spark.local.dir": f"{top}/local",
    "spark.checkpoint.dir": f"{top}/shared", "spark.sql.warehouse.dir": f"{top}/tables"})
quality.RETAINED["spark.sql.streaming.stateStore.maintenanceInterval"] = "200ms"
times = [START + timedelta(hours=12 * i) for i in range(16)]
folders = [fresh_folder(spark, n) for n in ("asked", "came", "rated", "progress")]
spans = quality.land_in_order([
    (spark.createDataFrame([(f"r{t}", t, 1.0) for t in times], schemas.PREDICTION), "predicted_ts", folders[0]),
    (spark.createDataFrame([(f"r{t}", t, 2.0) for t in times], schemas.ACTUAL), "actual_ts", folders[1])], 4)
quality.match_backlog(spark, folders[0], folders[1], spans, 7_200, "1 hour", folders[2], folders[3])
until = time.time() + 20
while time.time() < until and [*Path(top, "local").rglob("shuffle_*.data")]:
    time.sleep(0.1)
versions = Counter(str(f.parent) for f in Path(folders[3], "state").rglob("*.delta"))
print(json.dumps({
    "spans": spans, "stores": len(versions), "versions": max(versions.values()),
    "shuffles": len([*Path(top, "local").rglob("shuffle_*.data")]),
    "rated": spark.read.schema(schemas.RATED_PREDICTION).parquet(folders[2]).where("duration = 2").count(),
    "kept": spark.conf.get("spark.sql.streaming.minBatchesToRetain")}))
"""


def test_a_backlog_leaves_the_state_of_a_few_spans_and_no_shuffles(tmp_path):
    # Apart, since the first stream of a process sets how often the state is tidied up.
    done = subprocess.run(
        [sys.executable, "-c", LONG_BACKLOG, str(tmp_path)], capture_output=True, text=True, timeout=300,
        env=os.environ | {"PYTHONPATH": os.pathsep.join(sys.path)})
    assert done.returncode == 0, done.stderr[-2000:]
    left = json.loads(done.stdout.splitlines()[-1])
    assert left["spans"] == 8 and left["rated"] == 16 and left["kept"] == "100"
    assert left["shuffles"] == 0
    assert left["stores"] == 5 and left["versions"] < 8  # of two a span
