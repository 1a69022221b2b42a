"""Stream records: base64 payload, sequence number and arrival time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill import schemas
from tripmill import settings as S
from tripmill.functions.wire import is_json


def stream_rides(spark: SparkSession, path: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Landed record files as a stream; the trigger limit bounds each micro-batch."""
    return (
        spark.readStream.schema(schemas.STREAM_RECORD)
        .option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)
    )


def stream_from(spark: SparkSession, source: str, options: dict[str, str], data: Column,
                sequence_number: Column, arrival_ts: Column) -> DataFrame:
    """Any other installed stream source, its columns mapped to a stream record."""
    return spark.readStream.format(source).options(**options).load().select(
        data.alias("data"), sequence_number.alias("sequence_number"),
        arrival_ts.alias("arrival_ts"),
    )


def recent_events(records: DataFrame, payload: str = "payload", limit: int = S.RECENT_RECORDS,
                  since: datetime | None = None) -> DataFrame:
    """The newest records whose payload is JSON, newest first: a top-k per task, then a merge.

    ``since`` is a range on the stored arrival time, so that a long history is not read.
    """
    if since is not None:
        records = records.where(F.col("arrival_ts") >= F.lit(since).cast("timestamp_ntz"))
    return (
        records.where(is_json(F.col(payload)))
        .select(F.col("arrival_ts"), F.col(payload).alias("payload"), F.col("sequence_number"))
        .orderBy(F.desc("arrival_ts"), F.desc("sequence_number"))
        .limit(limit)
    )
