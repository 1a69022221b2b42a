"""Trips as events: envelopes, flat ride events, time stamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill import settings as S
from tripmill.functions import trips as tf
from tripmill.functions import wire
from tripmill.operators.cleaning import DROPOFF, PICKUP, trip_duration_if_absent

REQUIRED_COUNTS = ("passenger_count", "payment_type")
AMOUNTS = {"trip_distance": "trip_distance", "duration": "duration_minutes",
           "total_amount": "total_amount"}


def _or_default(df: DataFrame, column: str, kind: str, default) -> Column:
    """The column as ``kind``, or the default if the table has no such column."""
    return F.col(column).try_cast(kind) if column in df.columns else F.lit(default).cast(kind)


def trip_to_envelope(trips: DataFrame, fill: bool = False,
                     event_time: Column | None = None) -> DataFrame:
    """Trips to nested events, with a ``reason`` for rows that have no valid event.

    Event id and timestamp come from the event time (the pick-up unless given), so a replay gives
    the same events; a hash of the trip's id, or of all its fields where it has none, keeps trips of
    one zone and second apart. Counts must be integers: a null (or NaN) one rejects the row, or becomes 1
    with ``fill``.
    """
    df = trip_duration_if_absent(trips) if {PICKUP, DROPOFF} <= set(trips.columns) else trips
    when = event_time if event_time is not None else F.col(PICKUP)
    pickup_zone = (
        tf.zone_text(F.col("PULocationID")) if "PULocationID" in df.columns else F.lit("")
    )
    dropoff_zone = (
        tf.zone_text(F.col("DOLocationID")) if "DOLocationID" in df.columns else F.lit("")
    )
    id_zone = pickup_zone if "PULocationID" in df.columns else F.lit(S.UNKNOWN_ZONE)
    counts = {name: _or_default(df, name, "int", 1) for name in REQUIRED_COUNTS}
    if fill:
        counts = {name: F.coalesce(value, F.lit(1)) for name, value in counts.items()}
    whole = F.col("trip_id") if "trip_id" in df.columns else F.to_json(F.struct(*trips.columns))
    own = F.substring(F.md5(F.coalesce(whole, F.lit(""))), 1, S.EVENT_HASH_CHARACTERS)
    epoch = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), when)
    data = F.struct(
        (wire.iso_text(F.col(PICKUP)) if PICKUP in df.columns else F.lit(None).cast("string"))
        .alias("pickup_datetime"),
        (wire.iso_text(F.col(DROPOFF)) if DROPOFF in df.columns else F.lit(None).cast("string"))
        .alias("dropoff_datetime"),
        pickup_zone.alias("pickup_location_id"),
        dropoff_zone.alias("dropoff_location_id"),
        counts["passenger_count"].alias("passenger_count"),
        *[_or_default(df, source, "double", 0.0).alias(name) for source, name in AMOUNTS.items()],
        counts["payment_type"].alias("payment_type"),
    )
    reasons = [F.when(counts[name].isNull(), f"{name} is null") for name in REQUIRED_COUNTS]
    reasons += [
        F.when(F.col(source).isNotNull() & F.col(source).try_cast("double").isNull(),
               f"{name} is not a number")
        for source, name in AMOUNTS.items() if dict(df.dtypes).get(source) == "string"
    ]
    return df.select(
        *[c for c in ("trip_id",) if c in df.columns],
        F.concat(F.lit(S.ENVELOPE_ID_PREFIX), epoch.cast("string"), F.lit("_"), id_zone,
                 F.lit("_"), own)
        .alias("event_id"),
        F.lit(S.ENVELOPE_TYPE).alias("event_type"),
        wire.iso_text(when).alias("timestamp"),
        data.alias("data"),
        F.coalesce(*reasons).alias("reason"),
    )


def envelope_json(envelopes: DataFrame) -> Column:
    """Envelope as JSON text with null fields kept, as they travel on the stream."""
    return F.to_json(F.struct("event_id", "event_type", "timestamp", "data"),
                     {"ignoreNullFields": "false"})


def trip_to_ride_event(trips: DataFrame) -> DataFrame:
    """Trips to flat ride events; the id follows from the trip, not from a clock."""
    return trips.select(
        F.concat(F.lit(S.GENERATED_ID_PREFIX), F.col("trip_id")).alias("ride_id"),
        tf.zone_text(F.col("PULocationID")).alias("PULocationID"),
        tf.zone_text(F.col("DOLocationID")).alias("DOLocationID"),
        F.col("trip_distance").cast("double").alias("trip_distance"),
        wire.iso_text(F.col(PICKUP)).alias("pickup_datetime"),
    )


def fill_event_timestamp(events: DataFrame, arrival: str = "arrival_ts") -> DataFrame:
    """Events without a timestamp get their arrival time."""
    return events.withColumn(
        "timestamp", F.coalesce(F.col("timestamp"), wire.iso_text(F.col(arrival)))
    )


def sort_by_event_time(events: DataFrame, ts: str, key: str) -> DataFrame:
    """Ascending by time. The unique key breaks ties and lets the range partitioning split even a
    timestamp that a third of all rows share."""
    return events.orderBy(ts, key)
