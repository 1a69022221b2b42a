"""Feature stages for training and serving; both derive the route key the same way."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.functions import trips as tf

ROUTE_INDEX = "route_index"
FEATURES = "features_vector"


def with_route(df: DataFrame) -> DataFrame:
    """Add the route key from the two zone ids unless it is there."""
    if "PU_DO" in df.columns:
        return df
    return df.withColumn(
        "PU_DO",
        tf.route(tf.zone_text(F.col("PULocationID")), tf.zone_text(F.col("DOLocationID"))),
    )


@dataclass(frozen=True)
class FittedFeatures:
    """A stored vocabulary (route, place), its length, and the encoder for so many places."""

    vocabulary: DataFrame
    size: int
    encoder: OneHotEncoderModel


def fit_features(train: DataFrame, path: str) -> FittedFeatures:
    """One-hot route beside the distance, as sparse vectors; the vocabulary is stored under ``path``.

    Places are given by a range sort of the routes and one count per range, so the vocabulary is a
    table of any length that no single machine holds. Only its length comes to the driver.
    """
    spark = train.sparkSession
    routes = train.select("PU_DO").where(F.col("PU_DO").isNotNull()).distinct()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    routes.repartitionByRange(n, "PU_DO").withColumn("part", F.spark_partition_id()).write.mode(
        "overwrite").parquet(f"{path}/routes")
    ranged = spark.read.schema("PU_DO string, part int").parquet(f"{path}/routes")
    # One row per range.
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = ranged.groupBy("part").count().select(
        "part", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("shift"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("PU_DO"))
    ranged.withColumn("place", inside).join(shift, "part").select(
        "PU_DO", (F.col("shift") + F.col("place") - 1).cast("bigint").alias(ROUTE_INDEX)
    ).write.mode("overwrite").parquet(f"{path}/vocabulary")
    stored = spark.read.schema(f"PU_DO string, {ROUTE_INDEX} bigint").parquet(f"{path}/vocabulary")
    size = stored.count()
    # One more place than routes: the last one, for unseen routes, is the dropped one.
    widest = spark.range(1).select(F.lit(size).cast("double").alias("_slot"))
    encoder = OneHotEncoder(inputCol="_slot", outputCol="route_vector", dropLast=True).fit(widest)
    return FittedFeatures(stored, size, encoder)


def transform_features(df: DataFrame, fitted: FittedFeatures) -> DataFrame:
    """Feature vectors by an already fitted vocabulary; the index is null for unseen routes."""
    placed = with_route(df).join(fitted.vocabulary, "PU_DO", "left").withColumn(
        "_slot", F.coalesce(ROUTE_INDEX, F.lit(fitted.size)).cast("double"))
    together = VectorAssembler(inputCols=["route_vector", "trip_distance"], outputCol=FEATURES,
                               handleInvalid="keep")
    return together.transform(fitted.encoder.transform(placed)).drop("route_vector", "_slot")


def vocabulary(fitted: FittedFeatures) -> DataFrame:
    """Feature names and their positions."""
    spark = fitted.vocabulary.sparkSession
    distance = spark.range(1).select(F.lit(fitted.size).cast("bigint").alias("feature_index"),
                                     F.lit("trip_distance").alias("feature"))
    return fitted.vocabulary.select(
        F.col(ROUTE_INDEX).alias("feature_index"),
        F.concat(F.lit("PU_DO="), "PU_DO").alias("feature")).unionByName(distance)


def route_sums(train: DataFrame) -> DataFrame:
    """Trips, minutes and their range per route; partial sums reach the shuffle, so a route with very many trips is
    one row per task there. Sums are exact, so they do not depend on the order of rows."""
    return train.groupBy("PU_DO").agg(
        F.count("duration").alias("trips"),
        F.sum(F.col("duration").cast("decimal(20,10)")).cast("double").alias("minutes"),
        F.min("duration").alias("low"), F.max("duration").alias("high"))


def smoothed_mean(minutes: Column, trips: Column, overall: float, smoothing: float) -> Column:
    """Mean duration, drawn towards the overall mean where there are few trips; null without weight.

    The order of these means is the order in which the trees bundle the one-hot columns of routes.
    """
    weight = trips + F.lit(smoothing)
    return F.when(weight > 0, (minutes + F.lit(smoothing * overall)) / weight)


def with_other_trips_mean(train: DataFrame, sums: DataFrame, overall: float,
                          smoothing: float) -> DataFrame:
    """Training rows with the mean of the other trips of their route, so that no row's own duration
    is part of its feature."""
    own = F.col("duration")
    return train.join(sums.select("PU_DO", "trips", "minutes"), "PU_DO", "left").withColumn("route_mean", smoothed_mean(
        F.col("minutes") - own, F.col("trips") - 1, overall, smoothing)).drop("trips", "minutes")
