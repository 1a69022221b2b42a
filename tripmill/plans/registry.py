"""Registered queries: each runs one operator over the whole tables it reads."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill import schemas
from tripmill.functions import calendar, wire
from tripmill.functions import trips as tf
from tripmill.operators import (
    cleaning, events, features, metrics, model, monitoring, predictions, rides, sampling, validation,
)
from tripmill.plans import flows
from tripmill.session import fresh_folder, prepare
from tripmill.sinks import tables as sinks
from tripmill.sources import documents, fixtures, records
from tripmill.sources import trips as trip_source
from tripmill.streaming import latest as latest_streams
from tripmill.streaming import quality as quality_streams
from tripmill.streaming import rides as streams

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries.
SCAN_MONTH = (1998, 3)
CACHE_MONTH = (1997, 6)
FIRST_VALIDATION_DAY = date(2000, 7, 1)
SAMPLE_ROWS = 20_000
RECORD_INDEX = 1234
SLICE_START, SLICE_SIZE = 12_345, 500
BATCH_ROWS = 100
LOOKUP_DAY = (2024, 1, 15)
LOOKUP_TEXT = "r4"
REPORT_TIME, REPORT_HOURS = datetime(2024, 1, 20, 6, 0, 0), 30
PARAMS = model.TrainingParams()
DRIFT_FROM = date(1999, 1, 1)
DRIFT_EDGES = {"trip_distance": (0.0, 20.0, 10), "duration": (0.0, 60.0, 12),
               "total_amount": (0.0, 100.0, 10)}
DECILES = 10
FENCED = ("trip_distance", "duration", "total_amount")
PLAUSIBLE_MINUTES = (0.0, 120.0)
# Seconds that a prediction waits for its trip, how late rows may come, and how late some are told.
ACTUAL_WITHIN, ACTUAL_DELAY, LATE_MINUTES = 7200, "6 hours", 3 * 24 * 60

_made: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    """What several queries share (a landed table, a stored model) is made once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _made:
        _made[key] = make()
    return _made[key]


# ---- inputs ------------------------------------------------------------------------------------

def _trips(spark, sf_dir):
    return fixtures.trips(spark, sf_dir)


def _clean(spark, sf_dir):
    return cleaning.clean_trips(_trips(spark, sf_dir))


def _requests(spark, sf_dir):
    return rides.ride_requests(fixtures.ride_records(spark, sf_dir))


def _rate(df: DataFrame) -> DataFrame:
    """Stand-in scorer that SQL can repeat: minutes by distance, nothing within one zone."""
    known = F.col("PULocationID") != F.col("DOLocationID")
    return df.withColumn("prediction", F.when(known, F.col("trip_distance") / F.lit(0.4)))


def _evaluated(spark, sf_dir):
    return _clean(spark, sf_dir).select(
        "duration", (F.col("trip_distance") / F.lit(0.4)).alias("prediction"))


def landed_months(spark, sf_dir) -> str:
    def make():
        root = fresh_folder(spark, "months")
        sinks.write_trips_month(_trips(spark, sf_dir), root)
        return root
    return _once(spark, sf_dir, "months", make)


def ranked_trips(spark, sf_dir) -> sampling.RankedTable:
    """The trips laid out in their seeded order, shared by the queries for slices."""
    return _once(spark, sf_dir, "ranked", lambda: sampling.store_ranked(
        _trips(spark, sf_dir), "trip_id", fresh_folder(spark, "ranked")))


def landed_records(spark, sf_dir) -> str:
    def make():
        root = fresh_folder(spark, "records")
        fixtures.ride_records(spark, sf_dir).write.parquet(root)
        return root
    return _once(spark, sf_dir, "records", make)


def _entries(spark, sf_dir) -> DataFrame:
    accepted, _ = rides.quarantine_split(_requests(spark, sf_dir))
    return predictions.prediction_log(model.with_default(_rate(accepted)))


def landed_predictions(spark, sf_dir) -> DataFrame:
    def make():
        root = fresh_folder(spark, "predictions")
        streams.finish(streams.stream_score(
            records.stream_rides(spark, landed_records(spark, sf_dir)), _rate, root,
            fresh_folder(spark, "progress")))
        return root
    return streams.read_predictions(spark, _once(spark, sf_dir, "predictions", make))


def _flat(entries: DataFrame) -> DataFrame:
    return entries.select(
        "ride_id", "timestamp", "features.*", "predicted_duration", "is_default",
        "sequence_number", "year", "month", "day")


# ---- sources and sinks -------------------------------------------------------------------------

def scan_trips_month(spark, sf_dir):
    return trip_source.scan_trips_month(spark, landed_months(spark, sf_dir), *SCAN_MONTH)


def load_month_with_backfill(spark, sf_dir):
    cache = fresh_folder(spark, "cache")

    def load():
        return trip_source.load_month_with_backfill(
            spark, cache, *CACHE_MONTH, lambda y, m: fixtures.trips(spark, sf_dir, y, m))
    load()
    return load()


def dataset_catalog(spark, sf_dir):
    """Months of the landed trips as the catalogue shows them: files there, and months in all."""
    files = documents.dataset_catalog(spark, landed_months(spark, sf_dir))
    months = trip_source.month_files(files)
    total = months.select(F.count(F.lit(1))).scalar()
    return months.select("year", "month", (F.col("n_files") > 0).alias("has_files"),
                         (F.col("n_bytes") > 0).alias("has_bytes"), total.alias("total_months"))


def month_availability(spark, sf_dir):
    run_date = F.col("o_orderdate").cast("date")
    required = (
        fixtures.table(spark, sf_dir, "orders").select(run_date.alias("run_date")).distinct()
        .select("run_date", *calendar.training_months(F.col("run_date")))
    )
    catalog = documents.dataset_catalog(spark, landed_months(spark, sf_dir))
    return trip_source.month_availability(required, trip_source.present_months(catalog))


def read_json_docs(spark, sf_dir):
    root = fresh_folder(spark, "json")
    payloads = fixtures.payloads_from(fixtures.table(spark, sf_dir, "events"))
    sinks.export_text(payloads, F.col("payload"), root)
    docs = documents.read_json_docs(spark, root, schemas.JSON_RIDE)
    return docs.select("ride_id", "PULocationID", "DOLocationID", "trip_distance",
                       F.col(documents.CORRUPT).alias("corrupt_text"))


def text_preview(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "documents").select(
        "doc_id", *documents.text_preview(F.col("text")))


def table_preview(spark, sf_dir):
    return documents.table_preview(_trips(spark, sf_dir), "trip_id")


def recent_events(spark, sf_dir):
    return records.recent_events(fixtures.payloads_from(fixtures.table(spark, sf_dir, "events")))


def stream_rides(spark, sf_dir):
    out = fresh_folder(spark, "landed")
    stream = records.stream_rides(spark, landed_records(spark, sf_dir))
    streams.finish(
        stream.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", fresh_folder(spark, "progress"))
        .trigger(availableNow=True).start())
    return spark.read.schema(schemas.STREAM_RECORD).parquet(out)


def write_trips_month(spark, sf_dir):
    root = landed_months(spark, sf_dir)
    return spark.read.schema(schemas.TRIP_MONTHS).parquet(root)


def write_predictions(spark, sf_dir):
    root = fresh_folder(spark, "entries")
    sinks.write_predictions(_entries(spark, sf_dir), root)
    return _flat(streams.read_predictions(spark, root))


def latest_predictions(spark, sf_dir):
    return _flat(predictions.latest_predictions(landed_predictions(spark, sf_dir)))


def export_json(spark, sf_dir):
    path = fresh_folder(spark, "export")
    ride_events = events.trip_to_ride_event(_trips(spark, sf_dir))
    sinks.export_json(ride_events, path)
    return spark.read.schema(schemas.RIDE_EVENT).json(path)


def export_text(spark, sf_dir):
    path = fresh_folder(spark, "export")
    line = F.concat_ws(" ", "trip_id", "PULocationID", "DOLocationID")
    sinks.export_text(_trips(spark, sf_dir), line, path)
    return spark.read.text(path)


# ---- projections -------------------------------------------------------------------------------

def trip_duration(spark, sf_dir):
    return cleaning.trip_duration(_trips(spark, sf_dir)).select("trip_id", "duration")


def trip_duration_if_absent(spark, sf_dir):
    given = _trips(spark, sf_dir).withColumn("duration", F.col("passenger_count") * F.lit(1.5))
    return cleaning.trip_duration_if_absent(given).select("trip_id", "duration")


def cast_zone_ids(spark, sf_dir):
    return cleaning.cast_zone_ids(_trips(spark, sf_dir)).select("trip_id", *cleaning.ZONES)


def pu_do(spark, sf_dir):
    zones = cleaning.cast_zone_ids(_trips(spark, sf_dir))
    return cleaning.pu_do(zones).select("trip_id", "PU_DO")


def training_columns(spark, sf_dir):
    return cleaning.training_columns(_clean(spark, sf_dir))


def _flat_envelopes(envelopes: DataFrame) -> DataFrame:
    return envelopes.select("trip_id", "event_id", "event_type", "timestamp", "data.*", "reason")


def trip_to_envelope(spark, sf_dir):
    return _flat_envelopes(events.trip_to_envelope(_trips(spark, sf_dir)))


def trip_to_envelope_filled(spark, sf_dir):
    return _flat_envelopes(events.trip_to_envelope(_trips(spark, sf_dir), fill=True))


def trip_to_ride_event(spark, sf_dir):
    return events.trip_to_ride_event(_trips(spark, sf_dir))


def ride_json_roundtrip(spark, sf_dir):
    typed = rides.ride_to_json(events.trip_to_ride_event(_trips(spark, sf_dir)))
    return rides.ride_from_json(typed.select("payload")).drop("payload")


def ride_from_json(spark, sf_dir):
    payloads = fixtures.payloads_from(fixtures.table(spark, sf_dir, "events"))
    return rides.ride_from_json(payloads).drop("payload", "arrival_ts")


def fill_event_timestamp(spark, sf_dir):
    decoded = rides.decode_records(fixtures.ride_records(spark, sf_dir))
    stamped = decoded.withColumn("timestamp", F.col("ride.timestamp"))
    return events.fill_event_timestamp(stamped).select("sequence_number", "timestamp")


def _normalized(spark, sf_dir):
    return rides.normalize_event(rides.decode_records(fixtures.ride_records(spark, sf_dir)))


def normalize_event(spark, sf_dir):
    return _normalized(spark, sf_dir).select("sequence_number", "pickup", "dropoff", "distance")


def serving_features(spark, sf_dir):
    return rides.serving_features(_normalized(spark, sf_dir)).select(
        "sequence_number", "PULocationID", "DOLocationID", "trip_distance", "reason")


# ---- filters and validation --------------------------------------------------------------------

def duration_filter(spark, sf_dir):
    timed = cleaning.trip_duration(_trips(spark, sf_dir))
    return cleaning.duration_filter(timed).select("trip_id", "duration")


def pickup_month_filter(spark, sf_dir):
    stored = spark.read.schema(schemas.TRIP_MONTHS).parquet(landed_months(spark, sf_dir))
    return cleaning.pickup_month_filter(stored, *SCAN_MONTH).select("trip_id", cleaning.PICKUP)


def clean_trips(spark, sf_dir):
    return _clean(spark, sf_dir)


def validate_events(spark, sf_dir):
    texts = fixtures.envelope_texts_from(fixtures.table(spark, sf_dir, "events"))
    return validation.validate_events(texts).select("sequence_number", "valid", "error")


def zone_range_check(spark, sf_dir):
    """Zones shifted beyond the last one for a part of the rides, then checked."""
    shifted = _trips(spark, sf_dir).withColumn(
        "DOLocationID", F.col("DOLocationID") + F.coalesce(F.col("passenger_count"), F.lit(0)))
    envelopes = events.trip_to_envelope(shifted, fill=True)
    return validation.validate_envelopes(envelopes, check_zones=True).select(
        "trip_id", "valid", "error")


def quarantine_split(spark, sf_dir):
    accepted, rejected = rides.quarantine_split(_requests(spark, sf_dir))
    return (
        accepted.withColumn("outcome", F.lit("accepted"))
        .unionByName(rejected.withColumn("outcome", F.lit("rejected")))
        .groupBy("outcome", "reason").agg(F.count(F.lit(1)).alias("n"))
    )


def load_transform_validate(spark, sf_dir):
    checked = sampling.load_transform_validate(
        ranked_trips(spark, sf_dir), "trip_id", SLICE_START, SLICE_SIZE)
    return checked.select("trip_id", "event_id", "valid", "error")


def ride_id_lookup(spark, sf_dir):
    return _flat(predictions.ride_id_lookup(
        landed_predictions(spark, sf_dir), LOOKUP_TEXT, *LOOKUP_DAY))


def ride_id_lookup_stored(spark, sf_dir):
    """The same from entries and runs of characters that are laid out once."""
    def make():
        path = fresh_folder(spark, "lookup")
        predictions.store_lookup(landed_predictions(spark, sf_dir), path)
        return path
    path = _once(spark, sf_dir, "lookup", make)
    entries = spark.read.schema(schemas.PREDICTION_LOG).parquet(f"{path}/{predictions.ENTRIES}")
    grams = spark.read.schema(schemas.ID_GRAMS).parquet(f"{path}/{predictions.GRAMS}")
    return _flat(predictions.stored_lookup(entries, grams, LOOKUP_TEXT, *LOOKUP_DAY))


# ---- aggregates --------------------------------------------------------------------------------

def cleaning_funnel(spark, sf_dir):
    """Files hold the trips that ended in their month, so some pick-ups are strays."""
    ended = F.col(cleaning.DROPOFF)
    return cleaning.cleaning_funnel(_trips(spark, sf_dir), F.year(ended), F.month(ended))


def rmse(spark, sf_dir):
    return metrics.rmse(_evaluated(spark, sf_dir)).select(F.round("rmse", 4).alias("rmse"))


def rmse_gate(spark, sf_dir):
    return metrics.rmse_gate(_evaluated(spark, sf_dir)).withColumn("rmse", F.round("rmse", 4))


def batch_outcome(spark, sf_dir):
    batch = F.floor(F.col("sequence_number") / BATCH_ROWS).cast("bigint")
    return rides.batch_outcome(_requests(spark, sf_dir), batch)


def predictions_per_day(spark, sf_dir):
    latest = predictions.latest_predictions(landed_predictions(spark, sf_dir))
    return predictions.predictions_per_day(latest)


def stream_latest_predictions(spark, sf_dir):
    """The latest prediction per day and ride as a stream keeps it."""
    landed_predictions(spark, sf_dir)
    out = fresh_folder(spark, "latest")
    entries = latest_streams.stream_entries(
        spark, _once(spark, sf_dir, "predictions", lambda: None), schemas.PREDICTION_LOG)
    streams.finish(latest_streams.stream_latest(entries, out, fresh_folder(spark, "progress")))
    return _flat(latest_streams.latest_view(spark, out))


def recent_predictions(spark, sf_dir):
    latest = predictions.latest_predictions(landed_predictions(spark, sf_dir))
    return _flat(predictions.since(latest, REPORT_TIME, REPORT_HOURS))


# ---- samples and order -------------------------------------------------------------------------

def seeded_sample(spark, sf_dir):
    return sampling.stored_slice(spark, ranked_trips(spark, sf_dir), 0, SAMPLE_ROWS)


def record_at_index(spark, sf_dir):
    return sampling.stored_record(spark, ranked_trips(spark, sf_dir), RECORD_INDEX)


def batch_slice(spark, sf_dir):
    return _flat_envelopes(
        sampling.batch_slice(ranked_trips(spark, sf_dir), "trip_id", SLICE_START, SLICE_SIZE))


def shuffled_replay(spark, sf_dir):
    return sampling.shuffled_replay(_trips(spark, sf_dir), "trip_id")


def sort_by_event_time(spark, sf_dir):
    return events.sort_by_event_time(
        fixtures.table(spark, sf_dir, "events").select("event_id", "ts", "event_type"),
        "ts", "event_id")


# ---- scalar functions --------------------------------------------------------------------------

def _runs(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("run_date"))


def training_months(spark, sf_dir):
    return _runs(spark, sf_dir).select("*", *calendar.training_months(F.col("run_date")))


def training_months_fallback(spark, sf_dir):
    run = F.col("run_date")
    return _runs(spark, sf_dir).select(
        "*", *calendar.training_months_fallback(F.year(run), F.month(run)))


def data_month(spark, sf_dir):
    return _runs(spark, sf_dir).select(
        "*", *calendar.data_month(F.col("run_date")),
        calendar.month_key(F.year("run_date"), F.month("run_date")).alias("run_month"))


def prediction_path(spark, sf_dir):
    return _requests(spark, sf_dir).select(
        "sequence_number",
        calendar.prediction_path(F.col("arrival_ts"), F.col("ride_id")).alias("path"))


def iso_timestamp(spark, sf_dir):
    key, ts = F.col("event_id"), F.col("ts")
    iso = wire.iso_text(ts)
    text = (
        F.when(key % 5 == 0, iso).when(key % 5 == 1, F.concat(iso, F.lit("Z")))
        .when(key % 5 == 2, F.concat(iso, F.lit("+02:00")))
        .when(key % 5 == 3, F.date_format(ts, "yyyy"))
        .otherwise(F.concat(F.lit("at "), iso))
    )
    return fixtures.table(spark, sf_dir, "events").select(
        "event_id", text.alias("text"), wire.iso_instant(text).alias("instant"))


def decode_records(spark, sf_dir):
    """Every third record is damaged by a character that base64 does not have."""
    damaged = fixtures.ride_records(spark, sf_dir).withColumn(
        "data", F.when(F.col("sequence_number") % 3 == 0, F.concat("data", F.lit("%")))
        .otherwise(F.col("data")))
    return rides.decode_records(damaged).select(
        "sequence_number", "payload", F.col("ride").isNotNull().alias("is_object"), "reason")


def ensure_ride_id(spark, sf_dir):
    decoded = rides.decode_records(fixtures.ride_records(spark, sf_dir))
    return rides.ensure_ride_id(decoded).select("sequence_number", "ride_id")


# ---- features and model ------------------------------------------------------------------------

def _split(spark, sf_dir):
    return flows.split_at(_clean(spark, sf_dir), FIRST_VALIDATION_DAY)


def _fitted(spark, sf_dir):
    return _once(spark, sf_dir, "features",
                 lambda: features.fit_features(_split(spark, sf_dir)[0],
                                               fresh_folder(spark, "features")))


def fit_features(spark, sf_dir):
    return features.vocabulary(_fitted(spark, sf_dir))


def transform_features(spark, sf_dir):
    _, validation_rows = _split(spark, sf_dir)
    made = features.transform_features(validation_rows, _fitted(spark, sf_dir))
    vector = F.unwrap_udt(features.FEATURES)
    return made.select("trip_id", "PU_DO", features.ROUTE_INDEX, vector.alias("v")).select(
        "trip_id", "PU_DO", features.ROUTE_INDEX, F.col("v.size").alias("vector_size"),
        F.size("v.indices").alias("n_set"), F.get("v.indices", F.lit(0)).alias("first_index"),
        F.get("v.values", F.lit(0)).alias("first_value"),
        F.element_at("v.indices", -1).alias("last_index"),
        F.element_at("v.values", -1).alias("last_value"))


def trained(spark, sf_dir):
    """Model folder, run table and run id of one training, shared by the model queries."""
    def make():
        model_path, runs_path = fresh_folder(spark, "model"), fresh_folder(spark, "runs")
        trained = flows.train_and_record(spark, *_split(spark, sf_dir), model_path, runs_path,
                                         PARAMS)
        return model_path, runs_path, trained
    return _once(spark, sf_dir, "trained", make)


def _model(spark, sf_dir):
    return model.load_model(spark, trained(spark, sf_dir)[0])


def _scored(spark, sf_dir):
    return model.predict(_split(spark, sf_dir)[1], _model(spark, sf_dir))


def _training_mean(spark, sf_dir) -> float:
    return _split(spark, sf_dir)[0].agg(F.avg("duration")).first()[0]


def train_duration_model(spark, sf_dir):
    """One row per round, and whether the whole model is better than the mean of the training rows."""
    better = metrics.against_baseline(_scored(spark, sf_dir), _training_mean(spark, sf_dir)).first()
    return model.tree_summary(spark, trained(spark, sf_dir)[2].model).select(
        "round", F.round("weight", 6).alias("weight"),
        F.lit(round(better["baseline_rmse"], 4)).alias("baseline_rmse"),
        F.lit(better["beats_baseline"]).alias("beats_baseline"))


def train_with_validation(spark, sf_dir):
    """The validation error of every round as measured while training, and the best round by then."""
    return model.training_errors(trained(spark, sf_dir)[2].model).select(
        "round", F.round("rmse", 6).alias("rmse"), "best_round", "out_of_patience")


def batch_score(spark, sf_dir):
    scored = _scored(spark, sf_dir)
    gate = metrics.rmse_gate(scored).first()
    return metrics.against_baseline(scored, _training_mean(spark, sf_dir)).select(
        "n", F.round("baseline_rmse", 4).alias("baseline_rmse"), "beats_baseline",
        F.lit(gate["passed"]).alias("passed"))


def _scored_requests(spark, sf_dir):
    accepted, _ = rides.quarantine_split(_requests(spark, sf_dir))
    return model.score_or_default(accepted, _model(spark, sf_dir))


def score_or_default(spark, sf_dir):
    return _scored_requests(spark, sf_dir).select(
        "sequence_number", "ride_id", "PULocationID", "DOLocationID", "trip_distance", "arrival_ts",
        "is_default", F.col("predicted_duration").between(*PLAUSIBLE_MINUTES).alias("plausible"))


def default_prediction(spark, sf_dir):
    accepted, _ = rides.quarantine_split(_requests(spark, sf_dir))
    return model.score_or_default(accepted, None).select(
        "ride_id", "sequence_number", "predicted_duration", "is_default")


def model_store(spark, sf_dir):
    """Whether the fitted and the stored model predict the same, for each validation trip."""
    _, validation_rows = _split(spark, sf_dir)
    fitted = model.predict(validation_rows, trained(spark, sf_dir)[2].model)
    both = model.predict(fitted.withColumnRenamed("prediction", "fitted_prediction"),
                         _model(spark, sf_dir))
    same = F.col("fitted_prediction").eqNullSafe(F.col("prediction"))
    return both.select("trip_id", same.alias("same_prediction"))


def training_runs(spark, sf_dir):
    """The parameters of the run, and whether its error is recorded."""
    _, runs_path, made = trained(spark, sf_dir)
    run = model.training_runs(spark, runs_path, made.run_id)
    return run.select(F.explode("params").alias("name", "value"),
                      (F.col("metrics")["rmse"] > 0).alias("has_rmse"))


# ---- monitoring --------------------------------------------------------------------------------

def completeness(spark, sf_dir):
    return monitoring.completeness(_trips(spark, sf_dir))


def outliers(spark, sf_dir):
    return monitoring.outliers(_clean(spark, sf_dir), FENCED)


def _drift(spark, sf_dir):
    current = F.col(cleaning.PICKUP) >= F.lit(DRIFT_FROM).cast("timestamp_ntz")
    return monitoring.feature_drift(_clean(spark, sf_dir), current, DRIFT_EDGES)


def feature_drift(spark, sf_dir):
    return _drift(spark, sf_dir).select("feature", F.round("psi", 6).alias("psi"))


def _is_current() -> Column:
    return F.col(cleaning.PICKUP) >= F.lit(DRIFT_FROM).cast("timestamp_ntz")


def route_drift(spark, sf_dir):
    return monitoring.value_drift(_clean(spark, sf_dir), _is_current(), "PU_DO").select(
        "feature", F.round("psi", 6).alias("psi"))


def quantile_drift(spark, sf_dir):
    """Drift over the deciles of the reference trips."""
    clean = _clean(spark, sf_dir)
    edges = monitoring.quantile_edges(clean.where(~_is_current()), FENCED, DECILES)
    return monitoring.feature_drift(clean, _is_current(), edges).select(
        "feature", F.round("psi", 6).alias("psi"))


def drift_alert(spark, sf_dir):
    return monitoring.drift_alert(_drift(spark, sf_dir)).select("feature", "alert")


def _predictions(spark, sf_dir):
    """Clean trips as predicted when they begin; rides within a zone get the default."""
    scored = model.with_default(_rate(_clean(spark, sf_dir)))
    return scored.select(F.col("trip_id").alias("ride_id"),
                         F.col(cleaning.PICKUP).cast("timestamp").alias("predicted_ts"),
                         F.col("predicted_duration").alias("prediction"))


def _actuals(spark, sf_dir):
    """The same trips as they are told after their end: a tenth never, a tenth days later."""
    kind = (F.col("PULocationID").cast("int") + F.col("DOLocationID").cast("int")) % 10
    minutes = F.when(kind == 1, LATE_MINUTES).otherwise(kind)
    return _clean(spark, sf_dir).where(kind != 0).select(
        F.col("trip_id").alias("ride_id"),
        (F.col(cleaning.DROPOFF).cast("timestamp") + F.make_dt_interval(mins=minutes)).alias("actual_ts"),
        "duration")


def _quality(outcomes: DataFrame) -> DataFrame:
    quality = monitoring.quality_over_time(outcomes, F.year("predicted_ts").alias("year"))
    return quality.select("year", "n", "n_matched", "n_late", "n_missing", "n_pending",
                          *[F.round(c, 4).alias(c) for c in ("rmse", "mae", "r2")])


def model_quality(spark, sf_dir):
    """Predictions of each year against the trips that came out, by when they came."""
    return _quality(monitoring.match_actuals(
        _predictions(spark, sf_dir), _actuals(spark, sf_dir), ACTUAL_WITHIN))


def stream_model_quality(spark, sf_dir):
    """The same from two streams, which leave the last hours open. The trips of years are a backlog, which
    is landed in spans of time."""
    asked, came = fresh_folder(spark, "asked"), fresh_folder(spark, "came")
    spans = quality_streams.land_in_order([
        (_predictions(spark, sf_dir), "predicted_ts", asked),
        (_actuals(spark, sf_dir), "actual_ts", came)])
    out = fresh_folder(spark, "rated")
    quality_streams.match_backlog(spark, asked, came, spans, ACTUAL_WITHIN, ACTUAL_DELAY, out,
                                  fresh_folder(spark, "progress"))
    return _quality(quality_streams.stream_outcomes(
        spark, spark.read.schema(schemas.PREDICTION).parquet(asked),
        spark.read.schema(schemas.ACTUAL).parquet(came), out))


def envelope_ids_unique(spark, sf_dir):
    enveloped = events.trip_to_envelope(_trips(spark, sf_dir))
    return enveloped.agg(F.count(F.lit(1)).alias("n"),
                         F.count_distinct("event_id").alias("n_ids"))


# ---- streams -----------------------------------------------------------------------------------

def stream_score(spark, sf_dir):
    """The trained model on the stream; each entry is compared with scoring the same in batch."""
    out = fresh_folder(spark, "scored")
    fitted = _model(spark, sf_dir)
    streams.finish(streams.stream_score(
        records.stream_rides(spark, landed_records(spark, sf_dir)),
        lambda requests: model.predict(requests, fitted), out, fresh_folder(spark, "progress")))
    batch = _scored_requests(spark, sf_dir).select(
        "sequence_number", F.col("predicted_duration").alias("batch_duration"))
    same = F.col("predicted_duration").eqNullSafe(F.col("batch_duration"))
    return _flat(streams.read_predictions(spark, out)).join(
        batch, "sequence_number", "full").select(
        "sequence_number", "ride_id", "timestamp", "PULocationID", "DOLocationID",
        "trip_distance", "is_default", "year", "month", "day", same.alias("same_as_batch"))


def stream_write_predictions(spark, sf_dir):
    return _flat(landed_predictions(spark, sf_dir))


def stream_quarantine(spark, sf_dir):
    out = fresh_folder(spark, "quarantine")
    streams.finish(streams.stream_quarantine(
        records.stream_rides(spark, landed_records(spark, sf_dir)), _rate, out,
        fresh_folder(spark, "progress")))
    return spark.read.parquet(out).groupBy("outcome", "reason").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_default").alias("defaults"))


def stream_ingest_validated(spark, sf_dir):
    out = fresh_folder(spark, "ingested")
    trips = fixtures.trips_from(fixtures.table_stream(spark, sf_dir, "lineitem"))
    streams.finish(streams.stream_ingest_validated(trips, out, fresh_folder(spark, "progress")))
    landed = spark.read.schema(schemas.LANDED_ENVELOPE).parquet(out)
    return landed.select("trip_id", "event_id", "error", "valid")


REGISTERED = (
    scan_trips_month, load_month_with_backfill, dataset_catalog, month_availability,
    read_json_docs, text_preview, table_preview, recent_events, stream_rides,
    write_trips_month, write_predictions, latest_predictions, export_json, export_text,
    trip_duration, trip_duration_if_absent, cast_zone_ids, pu_do, training_columns,
    trip_to_envelope, trip_to_envelope_filled, trip_to_ride_event, ride_json_roundtrip,
    ride_from_json, fill_event_timestamp, serving_features, normalize_event,
    duration_filter, pickup_month_filter, clean_trips, validate_events, quarantine_split,
    load_transform_validate, ride_id_lookup, ride_id_lookup_stored, zone_range_check,
    cleaning_funnel, rmse, rmse_gate, batch_outcome, predictions_per_day, recent_predictions, stream_latest_predictions,
    seeded_sample, record_at_index, batch_slice, shuffled_replay, sort_by_event_time,
    training_months, data_month, training_months_fallback, prediction_path, iso_timestamp,
    decode_records, ensure_ride_id,
    fit_features, transform_features, train_duration_model, train_with_validation, batch_score,
    score_or_default, default_prediction, model_store, training_runs,
    stream_score, stream_write_predictions, stream_quarantine, stream_ingest_validated,
    completeness, outliers, feature_drift, route_drift, quantile_drift, drift_alert, model_quality, stream_model_quality, envelope_ids_unique,
)


def registered() -> dict[str, Query]:
    def with_session(query: Query) -> Query:
        return lambda spark, sf_dir: query(prepare(spark), sf_dir.rstrip("/"))
    return {query.__name__: with_session(query) for query in REGISTERED}
