"""Batch writers: trip months, dated predictions, JSON and text exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.operators.cleaning import PICKUP


def write_trips_month(trips: DataFrame, root: str) -> None:
    """Write trips under ``year=/month=`` of their pick-up and replace just the months written.

    The rebalance hint groups each month's rows into few files and splits a month that is too
    large for one task, so a task has few months; they are not sorted (see ``session.prepare``).
    """
    months = trips.withColumns({"year": F.year(PICKUP), "month": F.month(PICKUP)})
    (
        months.hint("rebalance", "year", "month")
        .write.partitionBy("year", "month").mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").parquet(root)
    )


def write_predictions(entries: DataFrame, root: str) -> None:
    """Append dated JSON entries, many per file."""
    (
        entries.hint("rebalance", "year", "month", "day")
        .write.partitionBy("year", "month", "day").mode("append").json(root)
    )


def export_json(df: DataFrame, path: str) -> None:
    """Rows as JSON lines; null fields are written too."""
    df.write.option("ignoreNullFields", "false").mode("overwrite").json(path)


def export_text(df: DataFrame, text: Column, path: str) -> None:
    """One line per row."""
    df.select(text.alias("value")).write.mode("overwrite").text(path)
