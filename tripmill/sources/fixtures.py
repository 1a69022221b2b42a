"""Trip, record and envelope views over the supplied test tables.

Each view is a plain projection, so filters and column pruning reach the Parquet scan, and the same
projection serves batch and streaming reads.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.sources.trips import next_month


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str,
                 max_files_per_trigger: int = 1000) -> DataFrame:
    """The same table as a file stream."""
    return (
        spark.readStream.schema(table(spark, sf_dir, name).schema)
        .option("pathGlobFilter", f"{name}.parquet")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(sf_dir)
    )


def trips_from(lineitem: DataFrame) -> DataFrame:
    pickup_second = F.expr("(l_orderkey * 7 + l_linenumber * 3601) % 86400")
    ride_seconds = F.expr(
        "CAST(l_quantity * 60 - 90 + (l_orderkey * 131 + l_partkey * 17) % 1800 AS BIGINT)"
    )

    def at(seconds: Column) -> Column:
        return F.timestamp_add("SECOND", seconds, F.col("l_shipdate"))

    return lineitem.select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in
                           ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
                    ).alias("trip_id"),
        at(pickup_second).alias("tpep_pickup_datetime"),
        at(pickup_second + ride_seconds).alias("tpep_dropoff_datetime"),
        F.expr("CAST(l_suppkey % 265 + 1 AS INT)").alias("PULocationID"),
        F.expr("CAST(l_partkey % 265 + 1 AS INT)").alias("DOLocationID"),
        F.expr("CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber END")
        .alias("passenger_count"),
        F.expr("l_quantity * 0.4D").alias("trip_distance"),
        F.expr("l_extendedprice / 1000").alias("total_amount"),
        F.expr("CASE WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag = 'R' THEN 2 ELSE 3 END")
        .alias("payment_type"),
    )


def trips(spark: SparkSession, sf_dir: str, year: int | None = None,
          month: int | None = None) -> DataFrame:
    """All trips, or those of one pick-up month.

    A pick-up lies within its ship day, so the month range is also a range on the stored column,
    which the Parquet reader can use.
    """
    lineitem = table(spark, sf_dir, "lineitem")
    if year is not None and month is not None:
        end = next_month(year, month)
        lineitem = lineitem.where(
            (F.col("l_shipdate") >= F.lit(date(year, month, 1)).cast("timestamp_ntz"))
            & (F.col("l_shipdate") < F.lit(end).cast("timestamp_ntz"))
        )
    return trips_from(lineitem)


def payloads_from(events: DataFrame) -> DataFrame:
    """Ride payloads: good, incomplete, null, non-numeric, non-JSON and enveloped, by event id."""
    zone_u = F.expr("CAST(user_id % 265 + 1 AS STRING)")
    zone_w = F.expr("CAST(event_id % 265 + 1 AS STRING)")
    value = F.col("value").cast("string")
    own_id = F.concat(F.lit('{"ride_id":"r'), F.col("event_id").cast("string"), F.lit('"'))
    numbers = F.concat(F.lit('"PULocationID":'), zone_u, F.lit(',"DOLocationID":'), zone_w)
    kind = F.col("event_id") % 9
    payload = (
        F.when(kind == 0, F.concat(F.lit("{"), numbers, F.lit(',"trip_distance":'), value,
                                   F.lit("}")))
        .when(kind == 1, F.concat(own_id, F.lit(","), numbers, F.lit("}")))
        .when(kind == 2, F.concat(own_id, F.lit(","), numbers, F.lit(',"trip_distance":null}')))
        .when(kind == 3, F.concat(own_id, F.lit(","), numbers, F.lit(',"trip_distance":"abc"}')))
        .when(kind == 4, F.concat(own_id, F.lit(',"DOLocationID":'), zone_w,
                                  F.lit(',"trip_distance":'), value, F.lit("}")))
        .when(kind == 5, F.concat(F.lit("not json "), F.col("event_id").cast("string")))
        .when(kind == 6, F.concat(
            F.lit('{"event_id":"t'), F.col("event_id").cast("string"),
            F.lit('","event_type":"taxi_trip_request","timestamp":"2024-01-01T00:00:00Z",'
                  '"data":{"pickup_location_id":"'), zone_u,
            F.lit('","dropoff_location_id":"'), zone_w, F.lit('","trip_distance":'), value,
            F.lit("}}")))
        .otherwise(F.concat(
            F.lit('{"ride_id":"r'), (F.col("event_id") - kind).cast("string"),
            F.lit('","PULocationID":"'), zone_u, F.lit('","DOLocationID":"'), zone_w,
            F.lit('","trip_distance":'), value, F.lit("}")))
    )
    return events.select(
        payload.alias("payload"), F.col("event_id").alias("sequence_number"),
        F.col("ts").alias("arrival_ts"),
    )


def records_from(events: DataFrame) -> DataFrame:
    """Stream records: the payloads in base64 without line breaks."""
    encoded = F.regexp_replace(F.base64(F.col("payload").cast("binary")), r"[\r\n]", "")
    return payloads_from(events).select(encoded.alias("data"), "sequence_number", "arrival_ts")


def ride_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records_from(table(spark, sf_dir, "events"))


def envelope_texts_from(events: DataFrame) -> DataFrame:
    """Envelope JSON with one defect per kind: each validation rule meets rows that break it."""
    kind = F.col("event_id") % 11
    key = F.col("event_id").cast("string")
    value = F.col("value").cast("string")

    def envelope(ts: str, data: Column, event_type: str = '"event_type":"taxi_trip_request",',
                 ) -> Column:
        return F.concat(F.lit('{"event_id":"t'), key, F.lit(f'",{event_type}"timestamp":{ts}'),
                        data, F.lit("}"))

    zones = '"pickup_location_id":"12","dropoff_location_id":"7"'
    iso = '"2024-01-05T06:07:08Z"'
    good = F.concat(F.lit(',"data":{' + zones + ',"trip_distance":'), value, F.lit("}"))
    text = (
        F.when(kind == 0, envelope(iso, good))
        .when(kind == 1, envelope(iso, good, event_type=""))
        .when(kind == 2, envelope('"yesterday"', good))
        .when(kind == 3, envelope(iso, F.lit("")))
        .when(kind == 4, envelope(iso, F.lit(',"data":{"dropoff_location_id":"7"}')))
        .when(kind == 5, envelope(iso, F.lit(',"data":{' + zones + ',"total_amount":"free"}')))
        .when(kind == 6, envelope(iso, F.lit(',"data":{' + zones + ',"passenger_count":null}')))
        .when(kind == 7, envelope('"2024-01-05T06:07:08.250+02:00"', good))
        .when(kind == 8, envelope("null", good))
        .when(kind == 9, envelope('"2024-02-30T00:00:00"', good))
        .otherwise(F.concat(F.lit('{"event_id":"t'), key))
    )
    return events.select(F.col("event_id").alias("sequence_number"), text.alias("payload"))
