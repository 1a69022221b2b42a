"""Ride requests from the stream: decode, normalise, derive features, tell bad rows apart.

Rows are never dropped on the way. A row that cannot be scored gets a ``reason``; what happens to
such rows is the caller's choice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill import schemas
from tripmill import settings as S
from tripmill.functions import wire
from tripmill.operators.parsing import DATA_KEYS, KEYS, has_key, parse_object

FLAT_FIELDS = ("PULocationID", "DOLocationID", "trip_distance")
NESTED_FIELDS = ("pickup_location_id", "dropoff_location_id", "trip_distance")

NOT_TEXT = "payload is not base64 UTF-8 text"
NOT_OBJECT = "payload is not a JSON object"
NULL_PICKUP = "PULocationID is null"
NULL_DROPOFF = "DOLocationID is null"
NULL_DISTANCE = "trip_distance is null"
BAD_DISTANCE = "trip_distance is not a number"


def decode_records(records: DataFrame) -> DataFrame:
    """Base64 to JSON object; ``payload`` and ``ride`` are null where a step failed, with a
    ``reason``."""
    decoded = records.withColumn("payload", wire.decoded_text(F.col("data"))).drop("data")
    return _parse_payload(decoded).withColumn(
        "reason",
        F.when(F.col("payload").isNull(), NOT_TEXT).when(F.col("ride").isNull(), NOT_OBJECT),
    )


def _parse_payload(df: DataFrame) -> DataFrame:
    return parse_object(df, "payload", schemas.RIDE_FIELDS, "ride", FLAT_FIELDS,
                        NESTED_FIELDS)


def normalize_event(decoded: DataFrame) -> DataFrame:
    """One flat request from either shape: flat ride event or trip envelope.

    A key that is present wins even if its value is null; a field missing in both shapes gets its
    default. Adds ``pickup``, ``dropoff`` and ``distance`` as text.
    """
    def pick(flat: str, inner: str, default: str) -> Column:
        flat_value, inner_value = F.col(f"ride.{flat}"), F.col(f"ride.data.{inner}")
        return (
            F.when(F.col("ride").isNull(), None)
            .when(flat_value.isNotNull(), flat_value)
            .when(has_key(KEYS, flat), None)
            .when(inner_value.isNotNull(), inner_value)
            .when(has_key(DATA_KEYS, inner), None)
            .otherwise(default)
        )

    return decoded.withColumns({
        "pickup": pick("PULocationID", "pickup_location_id", S.DEFAULT_ZONE),
        "dropoff": pick("DOLocationID", "dropoff_location_id", S.DEFAULT_ZONE),
        "distance": pick("trip_distance", "trip_distance", str(S.DEFAULT_DISTANCE)),
    })


def serving_features(normalized: DataFrame) -> DataFrame:
    """Typed features of a request, with the reason where they cannot be derived."""
    typed = normalized.withColumns({
        "PULocationID": wire.plain_zone(F.col("pickup")),
        "DOLocationID": wire.plain_zone(F.col("dropoff")),
        "trip_distance": wire.number(F.col("distance")),
    })
    reason = (
        F.when(F.col("reason").isNotNull(), F.col("reason"))
        .when(F.col("pickup").isNull(), NULL_PICKUP)
        .when(F.col("dropoff").isNull(), NULL_DROPOFF)
        .when(F.col("distance").isNull(), NULL_DISTANCE)
        .when(F.col("trip_distance").isNull(), BAD_DISTANCE)
    )
    return typed.withColumn("reason", reason).drop("pickup", "dropoff", "distance")


def ensure_ride_id(df: DataFrame) -> DataFrame:
    """The ride's own id, else one from arrival time and sequence number, the same at a replay."""
    generated = F.concat(
        F.lit(S.GENERATED_ID_PREFIX), F.date_format("arrival_ts", S.GENERATED_ID_TIME),
        F.lit("_"), F.col("sequence_number").cast("string"),
    )
    return df.withColumn("ride_id", F.coalesce(F.col("ride.ride_id"), generated))


def ride_requests(records: DataFrame) -> DataFrame:
    """Records to scoring requests: decode, normalise, features, id. Narrow all the way."""
    return ensure_ride_id(serving_features(normalize_event(decode_records(records)))).select(
        "ride_id", "PULocationID", "DOLocationID", "trip_distance", "reason", "payload",
        "sequence_number", "arrival_ts",
    )


def quarantine_split(df: DataFrame, reason: str = "reason") -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows; together they are all rows."""
    return df.where(F.col(reason).isNull()), df.where(F.col(reason).isNotNull())


def batch_outcome(df: DataFrame, batch: Column, reason: str = "reason") -> DataFrame:
    """Processed, failed and total rows per batch."""
    return df.groupBy(batch.alias("batch_id")).agg(
        F.count_if(F.col(reason).isNull()).alias("processed"),
        F.count_if(F.col(reason).isNotNull()).alias("failed"),
        F.count(F.lit(1)).alias("total"),
    )


def ride_to_json(rides: DataFrame) -> DataFrame:
    """Typed rides to JSON text; a missing id or time is an explicit null."""
    when = F.col("timestamp" if "timestamp" in rides.columns else "pickup_datetime")
    return rides.select("*", F.to_json(F.struct(
        "ride_id", F.col("PULocationID").try_cast("int").alias("PULocationID"),
        F.col("DOLocationID").try_cast("int").alias("DOLocationID"), "trip_distance",
        when.cast("string").alias("timestamp"),
    ), {"ignoreNullFields": "false"}).alias("payload"))


def ride_from_json(df: DataFrame) -> DataFrame:
    """JSON text to typed rides: integer zones and a distance are required, the id is optional."""
    typed = _parse_payload(df).withColumns({
        "ride_id": F.col("ride.ride_id"),
        "PULocationID": wire.plain_zone(F.col("ride.PULocationID")).try_cast("int"),
        "DOLocationID": wire.plain_zone(F.col("ride.DOLocationID")).try_cast("int"),
        "trip_distance": wire.number(F.col("ride.trip_distance")),
    })
    return typed.withColumn(
        "rejected",
        F.col("ride").isNull() | F.col("PULocationID").isNull() | F.col("DOLocationID").isNull()
        | F.col("trip_distance").isNull(),
    ).drop("ride", KEYS, DATA_KEYS)
