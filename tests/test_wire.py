"""JSON, base64, numbers and times, compared with Python's own parsers where they agree."""

import base64
import json
from datetime import datetime

import pytest
from hypothesis import given, settings, HealthCheck, strategies as st
from pyspark.sql import functions as F

from tripmill.functions import wire
from tripmill.operators import rides, validation

ARRIVAL = datetime(2024, 1, 2, 3, 4, 5, 60)


def records(spark, payloads):
    data = [(base64.b64encode(p.encode()).decode() if isinstance(p, str) else p.decode(), i, ARRIVAL)
            for i, p in enumerate(payloads)]
    return spark.createDataFrame(
        data, "data string, sequence_number bigint, arrival_ts timestamp_ntz")


def requests(spark, payloads):
    return rides.ride_requests(records(spark, payloads)).orderBy("sequence_number").collect()


RIDE = '"PULocationID":1,"DOLocationID":2,"trip_distance":3.5'


@pytest.mark.parametrize("payload, reason", [
    ("{" + RIDE + "}", None),
    ("{" + RIDE + "} tail", rides.NOT_OBJECT),
    ("{" + RIDE + "}{" + RIDE + "}", rides.NOT_OBJECT),
    ("{" + RIDE + "},{" + RIDE + "}", rides.NOT_OBJECT),
    ("{" + RIDE, rides.NOT_OBJECT),
    ("[1]", rides.NOT_OBJECT),
    ("5", rides.NOT_OBJECT),
    ("null", rides.NOT_OBJECT),
    ("", rides.NOT_OBJECT),
    ("{}", None),
    (b"%%%", rides.NOT_TEXT),
    (base64.b64encode(b"\xff\xfe"), rides.NOT_TEXT),
    ('{"PULocationID":null}', rides.NULL_PICKUP),
    ('{"DOLocationID":null}', rides.NULL_DROPOFF),
    ('{"trip_distance":null}', rides.NULL_DISTANCE),
    ('{"trip_distance":"abc"}', rides.BAD_DISTANCE),
    ('{"trip_distance":"2.5d"}', rides.BAD_DISTANCE),
    ('{"trip_distance":true}', rides.BAD_DISTANCE),
    ('{"trip_distance":" 2.5 "}', None),
    ('{"data":{"trip_distance":null}}', rides.NULL_DISTANCE),
    ('{"data":null}', None),
    ('{"data":"text"}', None),
    ('{"PULocationID":null,"data":{"pickup_location_id":"4"}}', rides.NULL_PICKUP),
])
def test_reason(spark, payload, reason):
    assert requests(spark, [payload])[0].reason == reason


def test_defaults_and_both_shapes(spark):
    got = requests(spark, [
        "{}", '{"PULocationID":161.0,"DOLocationID":"7"}',
        '{"data":{"pickup_location_id":"4","dropoff_location_id":5,"trip_distance":"6"}}',
        '{"PULocationID":9,"data":{"pickup_location_id":"4"}}',
        '{"trip_distance":1,"trip_distance":2}',
    ])
    assert [(r.PULocationID, r.DOLocationID, r.trip_distance) for r in got] == [
        ("1", "1", 1.0), ("161", "7", 1.0), ("4", "5", 6.0), ("9", "1", 1.0), ("1", "1", 2.0)]


def test_generated_id_is_stable_and_null_counts_as_missing(spark):
    payloads = ["{}", '{"ride_id":null}', '{"ride_id":"mine"}']
    first, second = requests(spark, payloads), requests(spark, payloads)
    assert [r.ride_id for r in first] == [r.ride_id for r in second] == [
        "ride_20240102_030405_000060_0", "ride_20240102_030405_000060_1", "mine"]


def test_nothing_is_lost_in_the_split(spark):
    df = rides.ride_requests(records(spark, ["{}", "x", '{"trip_distance":null}', "[]"]))
    accepted, rejected = rides.quarantine_split(df)
    assert accepted.count() + rejected.count() == df.count() == 4
    outcome = rides.batch_outcome(df, F.lit(1)).first()
    assert (outcome.processed, outcome.failed, outcome.total) == (1, 3, 4)


scalar = st.one_of(st.none(), st.integers(-10**6, 10**6), st.floats(-1e6, 1e6),
                   st.text(alphabet="ab1.\"\\{}[], é", max_size=6))
ride = st.dictionaries(st.sampled_from(["PULocationID", "DOLocationID", "trip_distance", "other"]),
                       st.one_of(scalar, st.lists(scalar, max_size=2)), max_size=4)


@settings(max_examples=5, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(objects=st.lists(ride, min_size=20, max_size=40))
def test_same_acceptance_as_a_python_reader(spark, objects):
    def accepted(obj):
        if any(k in obj and obj[k] is None
               for k in ("PULocationID", "DOLocationID", "trip_distance")):
            return False
        try:
            float(obj.get("trip_distance", 1.0))
        except (TypeError, ValueError):
            return False
        return True

    got = requests(spark, [json.dumps(o) for o in objects])
    assert [r.reason is None for r in got] == [accepted(o) for o in objects]


@pytest.mark.parametrize("text, instant", [
    ("2024-01-01T00:00:00Z", datetime(2024, 1, 1)),
    ("2024-01-01", datetime(2024, 1, 1)),
    ("2024-01-01 10:00", datetime(2024, 1, 1, 10)),
    ("2024-01-01T00:00:00.5+02:00", datetime(2023, 12, 31, 22, 0, 0, 500000)),
    ("2024", None), ("12:00:00", None), ("now", None), ("2024-02-30T00:00:00", None), ("", None),
])
def test_iso_instant(spark, text, instant):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(wire.iso_instant(F.col("t"))).first()[0] == instant


def test_iso_text_shows_a_fraction_only_if_there_is_one(spark):
    df = spark.createDataFrame([(ARRIVAL,), (ARRIVAL.replace(microsecond=0),)], "t timestamp_ntz")
    assert [r[0] for r in df.select(wire.iso_text(F.col("t"))).collect()] == [
        ARRIVAL.isoformat(), ARRIVAL.replace(microsecond=0).isoformat()]


@pytest.mark.parametrize("text, number", [
    ("1e3", 1000.0), ("-inf", float("-inf")), ("1_0", None), ("2.5f", None), ("", None)])
def test_number(spark, text, number):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(wire.number(F.col("t"))).first()[0] == number


GOOD = {"event_id": "t", "event_type": "x", "timestamp": "2024-01-01T00:00:00",
        "data": {"pickup_location_id": "3", "dropoff_location_id": "4"}}


def without(*keys):
    return {k: v for k, v in GOOD.items() if k not in keys}


def with_data(**fields):
    return {**GOOD, "data": {**GOOD["data"], **fields}}


@pytest.mark.parametrize("event, error", [
    (GOOD, None),
    (without("event_id"), "Missing required field: event_id"),
    (without("timestamp", "data"), "Missing required field: timestamp"),
    (without("data"), "Missing required field: data"),
    ({**GOOD, "event_id": None}, None),
    ({**GOOD, "data": None}, "data is not an object"),
    ({**GOOD, "data": "text"}, "data is not an object"),
    ({**GOOD, "data": {}}, "Missing required data field: pickup_location_id"),
    (with_data(pickup_location_id=None), None),
    ({**GOOD, "timestamp": None}, "timestamp is not ISO-8601"),
    ({**GOOD, "timestamp": 5}, "timestamp is not ISO-8601"),
    (with_data(passenger_count="two"), "passenger_count is not a number"),
    (with_data(passenger_count="2", total_amount=None), None),
])
def test_validation(spark, event, error):
    df = spark.createDataFrame([(json.dumps(event),)], "payload string")
    got = validation.validate_events(df).first()
    assert (got.error, got.valid) == (error, error is None)


@pytest.mark.parametrize("zone, ok", [("1", True), ("265", True), ("0", False), ("266", False),
                                      ("x", False), (None, False)])
def test_zone_rule(spark, zone, ok):
    df = spark.createDataFrame([(json.dumps(with_data(dropoff_location_id=zone)),)],
                               "payload string")
    assert validation.validate_events(df, check_zones=True).first().valid is ok
    assert validation.validate_events(df).first().valid is True
