from pyspark.sql import functions as F

from tripmill import schemas
from tripmill.operators import model, predictions, rides
from tripmill.plans.registry import _rate
from tripmill.session import fresh_folder
from tripmill.sources import fixtures, records
from tripmill.streaming import rides as streams


def landed(spark, sf_dir, files=4):
    root = fresh_folder(spark, "records")
    fixtures.ride_records(spark, sf_dir).repartition(files).write.parquet(root)
    return root


def batch_entries(spark, sf_dir):
    accepted, _ = rides.quarantine_split(rides.ride_requests(fixtures.ride_records(spark, sf_dir)))
    return predictions.prediction_log(model.with_default(_rate(accepted)))


def test_stream_equals_batch_over_several_micro_batches(spark, sf_dir):
    source, out, progress = (landed(spark, sf_dir), fresh_folder(spark, "out"),
                             fresh_folder(spark, "progress"))

    def run():
        query = streams.stream_score(
            records.stream_rides(spark, source, max_files_per_trigger=1), _rate, out, progress)
        streams.finish(query)
        return query

    query = run()
    assert len([p for p in query.recentProgress if p.numInputRows > 0]) == 4
    expected = batch_entries(spark, sf_dir)
    got = streams.read_predictions(spark, out)
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()

    run()  # the same progress folder: nothing is processed twice
    assert streams.read_predictions(spark, out).count() == expected.count()


def test_new_files_are_picked_up_by_the_next_run(spark, sf_dir):
    source, out, progress = (landed(spark, sf_dir, 1), fresh_folder(spark, "out"),
                             fresh_folder(spark, "progress"))
    for _ in range(2):
        streams.finish(streams.stream_score(records.stream_rides(spark, source), _rate, out,
                                            progress))
        fixtures.ride_records(spark, sf_dir).limit(0).union(
            fixtures.ride_records(spark, sf_dir)).write.mode("append").parquet(source)
    entries = streams.read_predictions(spark, out)
    assert entries.count() == 2 * batch_entries(spark, sf_dir).count()
    once = predictions.latest_predictions(batch_entries(spark, sf_dir))
    assert predictions.latest_predictions(entries).count() == once.count()


def test_quarantine_counts_per_micro_batch(spark, sf_dir):
    source, out = landed(spark, sf_dir, 3), fresh_folder(spark, "out")
    streams.finish(streams.stream_quarantine(
        records.stream_rides(spark, source, max_files_per_trigger=1), _rate, out,
        fresh_folder(spark, "progress")))
    written = spark.read.parquet(out)
    outcome = rides.batch_outcome(written, F.col("batch_id")).collect()
    assert len(outcome) == 3
    total = fixtures.ride_records(spark, sf_dir).count()
    assert sum(r.processed + r.failed for r in outcome) == sum(r.total for r in outcome) == total
    rejected = written.where("outcome = 'rejected'")
    assert rejected.where("predicted_duration is not null or reason is null").isEmpty()
    assert written.where("outcome = 'accepted' and predicted_duration is null").isEmpty()


def test_ingest_keeps_every_trip_valid_or_not(spark, sf_dir):
    out = fresh_folder(spark, "out")
    trips = fixtures.trips_from(fixtures.table_stream(spark, sf_dir, "lineitem"))
    streams.finish(streams.stream_ingest_validated(trips, out, fresh_folder(spark, "progress")))
    got = spark.read.schema(schemas.LANDED_ENVELOPE).parquet(out)
    assert got.count() == fixtures.trips(spark, sf_dir).count()
    assert got.where("valid <> (error is null)").isEmpty()
    from tripmill.operators import validation
    again = validation.validate_events(got.where("valid").select("trip_id", "payload"))
    assert again.where("not valid").isEmpty()  # what landed as valid is valid as text, too


def test_quarantine_with_a_trained_model(spark, sf_dir):
    from tripmill.operators.cleaning import clean_trips
    params = model.TrainingParams(rounds=1, depth=2)
    fitted = model.train_duration_model(clean_trips(fixtures.trips(spark, sf_dir)),
                                        fresh_folder(spark, "model"), params)
    source, out = landed(spark, sf_dir, 1), fresh_folder(spark, "out")
    streams.finish(streams.stream_quarantine(
        records.stream_rides(spark, source), lambda df: model.predict(df, fitted), out,
        fresh_folder(spark, "progress")))
    written = spark.read.parquet(out)
    assert written.count() == fixtures.ride_records(spark, sf_dir).count()
    assert written.where("outcome = 'accepted' and (is_default or predicted_duration is null)"
                         ).isEmpty()


def test_any_source_maps_to_records(spark):
    stream = records.stream_from(
        spark, "rate-micro-batch", {"rowsPerBatch": "10"},
        F.base64(F.concat(F.lit('{"trip_distance":'), F.col("value"), F.lit("}"))),
        F.col("value"), F.col("timestamp").cast("timestamp_ntz"))
    out = fresh_folder(spark, "out")
    streams.finish(streams.stream_score(stream, _rate, out, fresh_folder(spark, "progress"),
                                        {"once": True}))
    got = streams.read_predictions(spark, out)
    assert got.count() == 10
    assert got.where("features.trip_distance <> sequence_number").isEmpty()


def test_latest_by_stream_under_replay_and_disorder(spark):
    import random
    from datetime import datetime, timedelta
    from tripmill.streaming import latest
    rng = random.Random(6)
    rows = []
    for i in range(300):
        at = datetime(2024, 3, 1) + timedelta(seconds=rng.randrange(2 * 86_400))
        rows.append((f"r{rng.randrange(40)}", at.isoformat(), ("1", "2", 1.0), float(i), False, i,
                     at.year, at.month, at.day))
    rows += rows[:50]                 # sent again
    rng.shuffle(rows)                 # and out of order
    root, out, progress = (fresh_folder(spark, n) for n in ("entries", "latest", "progress"))
    whole = spark.createDataFrame(rows, schemas.PREDICTION_LOG)

    def run():
        streams.finish(latest.stream_latest(latest.stream_entries(spark, root, max_files_per_trigger=1),
                                            out, progress, delay="3 days"))
        return latest.latest_view(spark, out)

    for begin in range(0, len(rows), 100):
        part = spark.createDataFrame(rows[begin:begin + 100], schemas.PREDICTION_LOG)
        part.coalesce(1).write.mode("append").partitionBy("year", "month", "day").json(root)
        got = run()
    want = predictions.latest_predictions(whole)
    assert got.count() == want.count() > 60
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert run().exceptAll(want).isEmpty()


def test_days_behind_the_watermark_leave_the_state(spark):
    from tripmill.streaming import latest
    root, out, progress = (fresh_folder(spark, n) for n in ("entries", "latest", "progress"))

    def add(day, number):
        row = ("r1", f"2024-03-{day:02d}T10:00:00", ("1", "2", 1.0), 5.0, False, number, 2024, 3, day)
        spark.createDataFrame([row], schemas.PREDICTION_LOG).write.mode("append").partitionBy(
            "year", "month", "day").json(root)
        query = latest.stream_latest(latest.stream_entries(spark, root), out, progress, delay="1 hour")
        streams.finish(query)
        return query

    add(1, 1)
    add(9, 2)
    query = add(10, 3)
    kept = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert kept[-1] == 1  # the day before is past
    add(1, 9)             # too late
    days = {(r.day, r.sequence_number) for r in latest.latest_view(spark, out).collect()}
    assert days == {(1, 1), (9, 2), (10, 3)}


def test_sessions_write_to_few_folders_without_a_sort(spark):
    from tripmill import session
    other = spark.newSession()
    session.prepare(other)
    assert other.conf.get(session.OPEN_FILES_KEY) == str(session.OPEN_FILES)
    other.conf.set(session.OPEN_FILES_KEY, "3")
    session.prepare(other)
    assert other.conf.get(session.OPEN_FILES_KEY) == "3"
