"""Model error as whole-table aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill import settings as S


def rmse_of(label: str = "duration", prediction: str = "prediction") -> Column:
    return F.sqrt(F.avg(F.pow(F.col(label) - F.col(prediction), F.lit(2.0))))


def rmse(scored: DataFrame, label: str = "duration", prediction: str = "prediction") -> DataFrame:
    return scored.agg(rmse_of(label, prediction).alias("rmse"))


def rmse_gate(scored: DataFrame, label: str = "duration", prediction: str = "prediction",
              limit: float = S.RMSE_LIMIT) -> DataFrame:
    """The error and whether it is below the limit; without rows there is no error and no pass."""
    return rmse(scored, label, prediction).withColumn(
        "passed", F.coalesce(F.col("rmse") < limit, F.lit(False))
    )


def require_rmse(scored: DataFrame, limit: float = S.RMSE_LIMIT) -> float:
    """The error if it passes the gate; the job fails otherwise."""
    row = rmse_gate(scored, limit=limit).first()
    if not row["passed"]:
        raise ValueError(f"model validation failed, RMSE {row['rmse']} is not below {limit}")
    return row["rmse"]


def against_baseline(scored: DataFrame, baseline: float, label: str = "duration",
                     prediction: str = "prediction") -> DataFrame:
    """Rows, the error of predicting ``baseline`` for all, and whether the model's is lower."""
    plain = F.sqrt(F.avg(F.pow(F.col(label) - F.lit(baseline), F.lit(2.0))))
    return scored.agg(F.count(F.lit(1)).alias("n"), plain.alias("baseline_rmse"),
                      F.coalesce(rmse_of(label, prediction) < plain, F.lit(False))
                      .alias("beats_baseline"))
