"""Predictions rated while actual trips arrive: a stream joined with a stream.

Both sides have a watermark and the join a bound in time, so a prediction waits in the state for its
actual until the bound has passed on both, and then leaves it without one. The state holds no more than
what arrives within the bound and the delay, and the rows of one micro-batch: the watermark moves between
batches. ``land_in_order`` cuts a long backlog into spans of time, and ``match_backlog`` runs the stream over
one after another.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripmill import schemas
from tripmill.operators import monitoring
from tripmill.session import setting, settings
from tripmill.streaming.rides import AVAILABLE_NOW, finish

#: Rows of both sides that one run over a backlog takes; a day with more is still one run.
SPAN_ROWS = 8_000_000
STATES_PER_CORE = 2
PARTITIONS_KEY = "spark.sql.shuffle.partitions"
COMPRESSION = "zstd"
#: The files of a shuffle go with the query or the micro-batch that wrote them; else they stay until the
#: driver happens to collect its garbage.
CLEARED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: A run over a backlog goes on from where the one before ended and never from further back, so of the state
#: two versions are kept on disk and one in memory. Older files go once there is a snapshot after them, which
#: two changes make due. The first stream of an executor sets the interval of its maintenance.
#: Beside the stores of a run, those of the one before may still be open, and both write the snapshot of the
#: version between them: equal entries in another order. A checksum of one is no checksum of the other, so
#: there are none beside the files; a store of files that has its own (HDFS, a cloud) keeps it.
RETAINED = CLEARED | {
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.maxBatchesToRetainInMemory": "1",
    "spark.sql.streaming.stateStore.minDeltasForSnapshot": "1",
    "spark.sql.streaming.stateStore.maintenanceInterval": "5s",
    "spark.sql.streaming.checkpoint.fileChecksum.enabled": "false",
    "fs.AbstractFileSystem.file.impl": "org.apache.hadoop.fs.local.RawLocalFs",
}


def stream_of(spark: SparkSession, path: str, schema: str, max_files_per_trigger: int = 1000,
              ) -> DataFrame:
    """Landed files as a stream."""
    return spark.readStream.schema(schema).option(
        "maxFilesPerTrigger", max_files_per_trigger).parquet(path)


def stream_match(predictions: DataFrame, actuals: DataFrame, within_seconds: int, delay: str,
                 out: str, checkpoint: str, trigger: dict = AVAILABLE_NOW) -> StreamingQuery:
    """Every prediction once: with its actual as soon as both are there, or without one when its time
    has run out. An actual that is sent again within the delay counts once."""
    asked = predictions.withWatermark("predicted_ts", delay)
    came = actuals.withWatermark("actual_ts", delay).dropDuplicatesWithinWatermark(["ride_id"])
    joined = asked.alias("p").join(came.alias("a"), monitoring.in_time(within_seconds), "leftOuter")
    writer = (
        joined.select("p.*", "a.actual_ts", "a.duration")
        .writeStream.format("parquet").option("path", out).option("compression", COMPRESSION)
        .option("checkpointLocation", checkpoint).trigger(**trigger)
    )
    # Every part of the state writes five files a batch, however few its rows are. A stream keeps the
    # number that it began with.
    spark = predictions.sparkSession
    parts = min(int(spark.conf.get(PARTITIONS_KEY)), STATES_PER_CORE * spark.sparkContext.defaultParallelism)
    with setting(spark, PARTITIONS_KEY, str(parts)):
        return writer.start()


def span_starts(sides: list[tuple[DataFrame, str]], span_rows: int) -> list[date]:
    """First days of spans of about so many rows of all sides; the driver gets one row per day."""
    days = [rows.select(F.to_date(at).alias("day")) for rows, at in sides]
    every = days[0]
    for more in days[1:]:
        every = every.unionByName(more)
    counted = every.where("day IS NOT NULL").groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    starts, held = [], 0
    for day, n in sorted(tuple(r) for r in counted.collect()):
        if not starts or held + n > span_rows:
            starts.append(day)
            held = 0
        held += n
    return starts


def land_in_order(sides: list[tuple[DataFrame, str, str]], span_rows: int = SPAN_ROWS) -> int:
    """Write each side (rows, name of its time, folder) by spans of time that all sides share, and
    return how many there are. Rows without a time are in the first."""
    with settings(sides[0][0].sparkSession, CLEARED):
        starts = span_starts([(rows, at) for rows, at, _ in sides], span_rows)
    for rows, at, folder in sides:
        span = sum((F.when(F.to_date(at) >= F.lit(s), 1).otherwise(0) for s in starts[1:]), F.lit(0))
        landed = rows.withColumn("span", span)
        if len(starts) > 1:
            landed = landed.hint("rebalance", "span")
        with settings(rows.sparkSession, CLEARED):
            landed.write.partitionBy("span").parquet(folder, compression=COMPRESSION)
    return max(1, len(starts))


def match_backlog(spark: SparkSession, asked: str, came: str, spans: int, within_seconds: int,
                  delay: str, out: str, checkpoint: str) -> None:
    """``stream_match`` over landed spans in the order of time. The watermark ends below the start of the
    next span, so no row of it comes too late, and what was rated leaves the state between runs. On disk
    there is the state of a few spans, whatever their number."""
    for span in range(spans):
        with settings(spark, RETAINED):
            rated = stream_match(
                stream_of(spark, f"{asked}/span={span}/*", schemas.PREDICTION),
                stream_of(spark, f"{came}/span={span}/*", schemas.ACTUAL),
                within_seconds, delay, out, checkpoint)
        finish(rated)


def stream_outcomes(spark: SparkSession, predictions: DataFrame, actuals: DataFrame, out: str,
                    ) -> DataFrame:
    """Outcomes as the stream has told them so far, and pending where it has told none yet.

    ``predictions`` and ``actuals`` are what was landed; an unmatched prediction whose actual has come
    by now is late.
    """
    told = spark.read.schema(schemas.RATED_PREDICTION).parquet(out).drop("prediction")
    came = monitoring.first_actuals(actuals).select("ride_id", F.lit(True).alias("came"))
    # Only what was told without an actual is looked up; the others would be shuffled for it whole.
    without = told.where("actual_ts IS NULL").join(came, "ride_id", "left").withColumn(
        "outcome", F.when(F.col("came"), monitoring.LATE).otherwise(monitoring.MISSING)).drop("came")
    matched = told.where("actual_ts IS NOT NULL").withColumn("outcome", F.lit(monitoring.MATCHED))
    return predictions.join(
        matched.unionByName(without), ["ride_id", "predicted_ts"], "left").fillna(
        monitoring.PENDING, "outcome")
