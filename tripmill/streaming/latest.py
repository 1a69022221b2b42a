"""The latest prediction per day and ride, kept by a stream.

The state holds one entry per day and ride and lets a day go when the watermark has passed its end. Every
micro-batch writes the entries that changed into its own folder, so a batch that is repeated replaces
what it wrote, and the view is the newest of the changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripmill import schemas
from tripmill.functions import wire
from tripmill.operators.predictions import latest_predictions
from tripmill.streaming.rides import AVAILABLE_NOW

KEYS = ("year", "month", "day", "ride_id")


def stream_entries(spark: SparkSession, path: str, schema: str = schemas.PREDICTION_LOG,
                   max_files_per_trigger: int = 1000) -> DataFrame:
    """Dated prediction files as a stream."""
    return spark.readStream.schema(schema).option(
        "maxFilesPerTrigger", max_files_per_trigger).json(path)


def stream_latest(entries: DataFrame, out: str, checkpoint: str, delay: str = "1 day",
                  trigger: dict = AVAILABLE_NOW) -> StreamingQuery:
    """Keep the last entry of every day and ride; entries of days that are past by ``delay`` are late
    and left out."""
    rest = [c for c in entries.columns if c not in KEYS]
    timed = entries.withColumn(
        "_at", wire.iso_instant(F.col("timestamp")).cast("timestamp")).withWatermark("_at", delay)
    newest = F.max_by(F.struct(*rest), F.struct("_at", "sequence_number")).alias("entry")
    kept = timed.groupBy(F.window("_at", "1 day"), *KEYS).agg(newest)

    def write(batch: DataFrame, batch_id: int) -> None:
        changed = batch.select(*KEYS, "entry.*", F.lit(batch_id).cast("bigint").alias("batch_id"))
        changed.write.partitionBy("batch_id").mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").parquet(out)

    return (
        kept.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def latest_view(spark: SparkSession, out: str) -> DataFrame:
    """The latest entry per day and ride by the changes written so far."""
    changes = spark.read.schema(schemas.PREDICTION_LOG + ", batch_id BIGINT").parquet(out)
    return latest_predictions(changes.drop("batch_id"))
