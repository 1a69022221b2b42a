"""Cleaning of trip rows: duration, bounds, month, zone text, route key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions import trips as tf
from tripmill.sources.trips import next_month

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
ZONES = ("PULocationID", "DOLocationID")


def trip_duration(df: DataFrame) -> DataFrame:
    return df.withColumn("duration", tf.minutes_between(F.col(PICKUP), F.col(DROPOFF)))


def trip_duration_if_absent(df: DataFrame) -> DataFrame:
    """Keep a duration that came with the row and compute the others."""
    computed = tf.minutes_between(F.col(PICKUP), F.col(DROPOFF))
    if "duration" in df.columns:
        computed = F.coalesce(F.col("duration"), computed)
    return df.withColumn("duration", computed)


def duration_filter(df: DataFrame) -> DataFrame:
    """Rows of 1 to 60 minutes, both ends included; a null duration fails."""
    return df.where(tf.duration_in_bounds(F.col("duration")))


def in_pickup_month(year: int, month: int) -> Column:
    """A half-open range on the stored column: unlike ``year()`` and ``month()`` it is pushed down
    to the Parquet scan."""
    start = F.make_timestamp_ntz(F.lit(year), F.lit(month), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    after = next_month(year, month)
    end = F.make_timestamp_ntz(F.lit(after.year), F.lit(after.month), F.lit(1), F.lit(0), F.lit(0),
                               F.lit(0))
    return (F.col(PICKUP) >= start) & (F.col(PICKUP) < end)


def pickup_month_filter(df: DataFrame, year: int, month: int) -> DataFrame:
    return df.where(in_pickup_month(year, month))


def cast_zone_ids(df: DataFrame) -> DataFrame:
    return df.withColumns({zone: tf.zone_text(F.col(zone)) for zone in ZONES})


def pu_do(df: DataFrame) -> DataFrame:
    return df.withColumn("PU_DO", tf.route(*[F.col(zone) for zone in ZONES]))


def clean_trips(df: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """The whole cleaning; the month filter is optional.

    Applying it to its own result changes nothing, so it does not matter whether a stored month is
    raw or clean. One narrow stage: no shuffle and no Python.
    """
    if (year is None) != (month is None):
        raise ValueError("year and month go together")
    if year is not None:
        df = pickup_month_filter(df, year, month)
    return pu_do(cast_zone_ids(duration_filter(trip_duration(df))))


def training_columns(clean: DataFrame) -> DataFrame:
    """Features and label only; the pruning reaches the scan."""
    return clean.select("PU_DO", "trip_distance", "duration")


def cleaning_funnel(df: DataFrame, file_year: Column, file_month: Column) -> DataFrame:
    """Rows of each month file before and after each cleaning step.

    Every step is a condition on the raw row, so one pass with partial counts gives all of them.
    """
    bounded = tf.duration_in_bounds(F.col("duration"))
    in_month = (F.year(PICKUP) == F.col("year")) & (F.month(PICKUP) == F.col("month"))
    return (
        trip_duration(df.withColumns({"year": file_year, "month": file_month}))
        .groupBy("year", "month")
        .agg(
            F.count(F.lit(1)).alias("raw_rows"),
            F.count_if(bounded).alias("after_duration"),
            F.count_if(bounded & in_month).alias("after_month"),
        )
        .withColumns({
            "raw_columns": F.lit(len(df.columns)),
            "clean_columns": F.lit(len(set(df.columns) | {"duration", "PU_DO"})),
        })
    )
