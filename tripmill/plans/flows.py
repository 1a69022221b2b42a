"""Whole flows: monthly training and month preparation."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.functions import calendar
from tripmill.operators import cleaning, metrics
from tripmill.operators import model as duration_model
from tripmill.operators.model import TrainingParams
from tripmill.settings import RMSE_LIMIT
from tripmill.sinks.tables import write_trips_month
from tripmill.sources.trips import load_month_with_backfill, month_exists

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Trained:
    model: duration_model.DurationModel
    rmse: float
    run_id: str


def split_at(clean: DataFrame, first_validation_day: date) -> tuple[DataFrame, DataFrame]:
    """Training rows before a day and validation rows from it on."""
    cut = F.lit(first_validation_day).cast("timestamp_ntz")
    return (clean.where(F.col(cleaning.PICKUP) < cut), clean.where(F.col(cleaning.PICKUP) >= cut))


def prepare_month(trips: DataFrame, root: str, year: int, month: int) -> None:
    """Clean one month, strays of other months removed, and store it in the clean zone."""
    clean = cleaning.clean_trips(trips, year, month).drop("year", "month")
    write_trips_month(clean, root)


def train_and_record(spark: SparkSession, train: DataFrame, validation: DataFrame,
                     model_path: str, runs_path: str,
                     params: TrainingParams = TrainingParams()) -> Trained:
    """Train on clean trips, with the validation trips to stop by and to measure on; store model and
    run.

    Whether the error is good enough is a separate step (``metrics.require_rmse``).
    """
    fitted = duration_model.train_with_validation(train, validation, model_path, params)
    scored = duration_model.predict(validation, fitted)
    error = metrics.rmse(scored).first()["rmse"]
    run_id = duration_model.record_run(spark, runs_path, params, {"rmse": error})
    return Trained(fitted, error, run_id)


def monthly_run(spark: SparkSession, run_date: date | None, cache_root: str,
                origin: Callable[[int, int], DataFrame], model_path: str, runs_path: str,
                params: TrainingParams = TrainingParams(),
                training_month: tuple[int, int] | None = None) -> Trained:
    """One monthly run: months, availability, load with backfill, clean, train, record, gate.

    Without a run date a given training month and the one after it are taken. The run is recorded
    before the gate, so a failed one can be looked up, too.
    """
    if run_date is not None:
        months = calendar.training_months(F.lit(run_date))
    elif training_month is not None:
        months = calendar.training_months_fallback(*map(F.lit, training_month))
    else:
        raise ValueError("a run date or a training month is needed")
    train_year, train_month, val_year, val_month = spark.range(1).select(*months).first()
    for kind, year, month in (("training", train_year, train_month),
                              ("validation", val_year, val_month)):
        if not month_exists(spark, cache_root, year, month):
            log.warning("%s month %d-%02d is not cached, reading the origin", kind, year, month)
    train, validation = [
        cleaning.clean_trips(load_month_with_backfill(spark, cache_root, year, month, origin))
        for year, month in ((train_year, train_month), (val_year, val_month))
    ]
    trained = train_and_record(spark, train, validation, model_path, runs_path, params)
    if trained.rmse is None or trained.rmse >= RMSE_LIMIT:
        raise ValueError(f"model validation failed, RMSE {trained.rmse} of run {trained.run_id}")
    return trained
