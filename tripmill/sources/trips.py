"""Trip-month tables: one folder per month, read with partition pruning."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill import schemas

log = logging.getLogger(__name__)

_FAILURES = (PySparkException, Py4JJavaError)  # the latter where Spark has no error class


def next_month(year: int, month: int) -> date:
    return date(year + month // 12, month % 12 + 1, 1)


def scan_trips_month(spark: SparkSession, root: str, year: int, month: int,
                     schema: str = schemas.TRIP_MONTHS) -> DataFrame:
    """One month of a table laid out as ``year=/month=``.

    The month's folder is read directly, so the folders of all other months are not even listed;
    a month that does not exist is an error.
    """
    return (
        spark.read.schema(schema).option("basePath", root)
        .parquet(f"{root}/year={year}/month={month}")
    )


def month_exists(spark: SparkSession, root: str, year: int, month: int) -> bool:
    """Whether a month has a folder: a look-up of one path, no job."""
    try:
        scan_trips_month(spark, root, year, month)
        return True
    except AnalysisException:
        return False


def month_files(catalog: DataFrame) -> DataFrame:
    """Files and bytes per month, from the paths of a catalogue alone: no file is opened."""
    def part(name: str) -> Column:
        return F.regexp_extract("key", rf"/{name}=(\d+)/", 1).try_cast("int").alias(name)

    return catalog.select(part("year"), part("month"), "size").where(
        F.col("year").isNotNull() & F.col("month").isNotNull()
    ).groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_files"),
                                   F.sum("size").alias("n_bytes"))


def present_months(catalog: DataFrame) -> DataFrame:
    """Months that have files."""
    return month_files(catalog).select("year", "month")


MANIFEST, MANIFEST_COLUMNS = "manifest", "data STRING, n_rows BIGINT"


def _cached_month(spark: SparkSession, path: str) -> DataFrame | None:
    """The month that the manifest names, if all its rows are there."""
    published = spark.read.schema(MANIFEST_COLUMNS).parquet(f"{path}/{MANIFEST}").collect()
    if len(published) != 1:
        return None
    data = f"{path}/{published[0]['data']}"
    stored = spark.read.schema(spark.read.parquet(data).schema).parquet(data)
    # The count comes from the footers alone.
    return stored if stored.count() == published[0]["n_rows"] else None


def load_month_with_backfill(spark: SparkSession, cache_root: str, year: int, month: int,
                             origin: Callable[[int, int], DataFrame]) -> DataFrame:
    """The cached month, or the origin's month, which is then written to the cache.

    A month is written into a folder of its own; its manifest, with that folder and the number of
    rows, is published last. A month without a manifest, or with other rows than it says, is not there.
    A cache that cannot be written costs a warning only.
    """
    path = f"{cache_root}/year={year}/month={month}"
    try:
        stored = _cached_month(spark, path)
        if stored is not None:
            return stored
        log.warning("cached month %s is incomplete, reading the origin", path)
    except _FAILURES as missing:
        if not isinstance(missing, AnalysisException):
            log.warning("cached month %s is unreadable, reading the origin: %s", path, missing)
    fresh = origin(year, month)
    data = f"data-{uuid.uuid4().hex}"
    try:
        fresh.write.parquet(f"{path}/{data}")
        stored = spark.read.schema(fresh.schema).parquet(f"{path}/{data}")
        manifest = spark.createDataFrame([(data, stored.count())], MANIFEST_COLUMNS)
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{path}/{MANIFEST}")
    except _FAILURES as failure:
        log.warning("month %s-%02d was not cached: %s", year, month, failure)
        return fresh
    return stored


def month_availability(required: DataFrame, present: DataFrame) -> DataFrame:
    """Which required train and validation months exist.

    ``required`` has ``run_date, train_year, train_month, val_year, val_month``; ``present`` has one
    row per existing ``year`` and ``month``. Nothing here grows with the number of trips.
    """
    def months(prefix: str) -> DataFrame:
        return present.select(
            F.col("year").alias(f"{prefix}_year"), F.col("month").alias(f"{prefix}_month"),
            F.lit(True).alias(f"{prefix}_found"),
        )

    def label(kind: str, prefix: str) -> Column:
        return F.when(
            ~F.col(f"{prefix}_available"),
            F.format_string(f"{kind} (%d-%02d)", f"{prefix}_year", f"{prefix}_month"),
        )

    return (
        required
        .join(months("train"), ["train_year", "train_month"], "left")
        .join(months("val"), ["val_year", "val_month"], "left")
        .withColumns({
            "train_available": F.coalesce("train_found", F.lit(False)),
            "val_available": F.coalesce("val_found", F.lit(False)),
        })
        .select(
            "run_date", "train_available", "val_available",
            (F.col("train_available") & F.col("val_available")).alias("both_available"),
            F.concat_ws(", ", label("training", "train"), label("validation", "val"))
            .alias("missing"),
        )
    )
