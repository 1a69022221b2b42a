"""Column functions for month arithmetic and dated paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmill import settings as S


def training_months(run_date: Column) -> list[Column]:
    """Train and validation month for a run date; the day is clipped at month ends."""
    train = F.add_months(run_date, -S.TRAIN_LAG_MONTHS)
    validation = F.add_months(run_date, -S.VALIDATION_LAG_MONTHS)
    return [
        F.year(train).alias("train_year"), F.month(train).alias("train_month"),
        F.year(validation).alias("val_year"), F.month(validation).alias("val_month"),
    ]


def training_months_fallback(year: Column, month: Column) -> list[Column]:
    """A given training month and the month after it for validation."""
    following = F.add_months(F.make_date(year, month, F.lit(1)), 1)
    return [
        year.cast("int").alias("train_year"), month.cast("int").alias("train_month"),
        F.year(following).alias("val_year"), F.month(following).alias("val_month"),
    ]


def data_month(run_date: Column) -> list[Column]:
    """The month whose data a preparation run on ``run_date`` loads."""
    past = F.add_months(run_date, -S.DATA_LAG_MONTHS)
    return [F.year(past).alias("data_year"), F.month(past).alias("data_month")]


def month_key(year: Column, month: Column) -> Column:
    """``YYYY-MM`` with a zero-padded month."""
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


def prediction_path(ts: Column, ride_id: Column) -> Column:
    """Dated path of one prediction."""
    return F.concat_ws("/", F.lit(S.PREDICTION_ROOT), F.date_format(ts, S.PREDICTION_DAY),
                       F.concat(ride_id, F.lit(".json")))


def day_parts(ts: Column) -> list[Column]:
    """The partition columns of dated tables."""
    return [F.year(ts).alias("year"), F.month(ts).alias("month"), F.day(ts).alias("day")]
