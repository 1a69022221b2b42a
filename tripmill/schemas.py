"""Declared schemas of the tables and wire formats, as DDL."""

RAW_TRIP = (
    "trip_id STRING, tpep_pickup_datetime TIMESTAMP_NTZ, tpep_dropoff_datetime TIMESTAMP_NTZ, "
    "PULocationID INT, DOLocationID INT, passenger_count INT, trip_distance DOUBLE, "
    "total_amount DOUBLE, payment_type INT"
)

TRIP_MONTHS = f"{RAW_TRIP}, year INT, month INT"

CLEAN_MONTHS = (
    "trip_id STRING, tpep_pickup_datetime TIMESTAMP_NTZ, tpep_dropoff_datetime TIMESTAMP_NTZ, "
    "PULocationID STRING, DOLocationID STRING, passenger_count INT, trip_distance DOUBLE, "
    "total_amount DOUBLE, payment_type INT, duration DOUBLE, PU_DO STRING, year INT, month INT"
)

STREAM_RECORD = "data STRING, sequence_number BIGINT, arrival_ts TIMESTAMP_NTZ"

# What is read from JSON text, all as text; typing comes after the checks. Only fields that are
# used are listed: the parser skips the others.
RIDE_FIELDS = (
    "ride_id: STRING, timestamp: STRING, PULocationID: STRING, DOLocationID: STRING, "
    "trip_distance: STRING, data: STRUCT<pickup_location_id: STRING, "
    "dropoff_location_id: STRING, trip_distance: STRING>"
)

ENVELOPE_FIELDS = (
    "event_id: STRING, event_type: STRING, timestamp: STRING, "
    "data: STRUCT<pickup_location_id: STRING, dropoff_location_id: STRING, "
    "passenger_count: STRING, trip_distance: STRING, duration_minutes: STRING, "
    "total_amount: STRING>"
)

JSON_RIDE = (
    "ride_id STRING, PULocationID STRING, DOLocationID STRING, trip_distance STRING"
)

RIDE_EVENT = (
    "ride_id STRING, PULocationID STRING, DOLocationID STRING, trip_distance DOUBLE, "
    "pickup_datetime STRING"
)

TRIP_ENVELOPE = (
    "event_id STRING, event_type STRING, timestamp STRING, "
    "data STRUCT<pickup_datetime: STRING, dropoff_datetime: STRING, pickup_location_id: STRING, "
    "dropoff_location_id: STRING, passenger_count: INT, trip_distance: DOUBLE, "
    "duration_minutes: DOUBLE, total_amount: DOUBLE, payment_type: INT>"
)

PREDICTION_LOG = (
    "ride_id STRING, timestamp STRING, "
    "features STRUCT<PULocationID: STRING, DOLocationID: STRING, trip_distance: DOUBLE>, "
    "predicted_duration DOUBLE, is_default BOOLEAN, sequence_number BIGINT, "
    "year INT, month INT, day INT"
)

TRAINING_RUN = "run_id STRING, params MAP<STRING,STRING>, metrics MAP<STRING,DOUBLE>"

LANDED_ENVELOPE = "trip_id STRING, event_id STRING, payload STRING, error STRING, valid BOOLEAN"

ROUTE_MEANS = "PU_DO STRING, route_mean DOUBLE, route_bin INT"

ROUTE_SUMS = "PU_DO STRING, trips BIGINT, minutes DOUBLE, low DOUBLE, high DOUBLE"

CELLS = "cell INT, trips BIGINT, minutes DOUBLE, squares DOUBLE"

MODEL_HEADER = (
    "overall DOUBLE, low DOUBLE, high DOUBLE, route_edges ARRAY<DOUBLE>, distance_edges ARRAY<DOUBLE>, "
    "params MAP<STRING,STRING>, patience INT"
)

ROUNDS = (
    "round INT, weight DOUBLE, depth INT, nodes INT, features ARRAY<INT>, bins ARRAY<INT>, "
    "lefts ARRAY<INT>, rights ARRAY<INT>, leaf_values ARRAY<DOUBLE>, leaf_rows ARRAY<DOUBLE>, "
    "margins ARRAY<DOUBLE>, train_rmse DOUBLE, validation_rmse DOUBLE"
)

PREDICTION = "ride_id STRING, predicted_ts TIMESTAMP, prediction DOUBLE"

ACTUAL = "ride_id STRING, actual_ts TIMESTAMP, duration DOUBLE"

RATED_PREDICTION = (
    "ride_id STRING, predicted_ts TIMESTAMP, prediction DOUBLE, actual_ts TIMESTAMP, duration DOUBLE"
)

ID_GRAMS = "gram STRING, ride_id STRING, year INT, month INT, day INT"
