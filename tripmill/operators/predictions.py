"""Prediction log: entries, latest per ride, look-up by id, daily report."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill import settings as S
from tripmill.functions import calendar
from tripmill.functions import wire


def prediction_log(scored: DataFrame) -> DataFrame:
    """Scored requests to log entries, with the UTC day of arrival as partition columns."""
    return scored.select(
        "ride_id", wire.iso_text(F.col("arrival_ts")).alias("timestamp"),
        F.struct("PULocationID", "DOLocationID", "trip_distance").alias("features"),
        "predicted_duration", "is_default", "sequence_number",
        *calendar.day_parts(F.col("arrival_ts")),
    )


def latest_predictions(entries: DataFrame) -> DataFrame:
    """The last entry per day and ride.

    A maximum per group is combined before the shuffle, so a ride id with very many entries sends
    one row per task; a window would bring all of them to one task.
    """
    keys = ["year", "month", "day", "ride_id"]
    rest = [c for c in entries.columns if c not in (*keys, "timestamp", "sequence_number")]
    newest = F.max_by(
        F.struct("timestamp", "sequence_number", *rest),
        F.struct(wire.iso_instant(F.col("timestamp")), F.col("sequence_number")),
    )
    return (
        entries.groupBy(*keys).agg(newest.alias("entry"))
        .select(*keys, "entry.*").select(*entries.columns)
    )


def ride_id_lookup(entries: DataFrame, part_of_id: str, year: int, month: int,
                   day: int) -> DataFrame:
    """Predictions of one day whose ride id contains a text; other days are pruned."""
    return entries.where(
        (F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day)
        & F.col("ride_id").contains(part_of_id)
    )


# ---- stored look-up ----------------------------------------------------------------------------------

ENTRIES, GRAMS = "entries", "grams"
GRAM = 3
DAYS = ("year", "month", "day")


def store_lookup(entries: DataFrame, path: str) -> None:
    """Lay entries out for look-ups by id: by day, in the order of ids, with a Bloom filter per row group;
    beside them which ids hold each run of ``GRAM`` characters.

    The runs at the end of an id are shorter, so every text within an id begins one of its runs. Long
    days are split over several files by the rebalance hint.
    """
    entries.hint("rebalance", *DAYS).sortWithinPartitions(*DAYS, "ride_id").write.mode(
        "overwrite").partitionBy(*DAYS).option("parquet.bloom.filter.enabled#ride_id", "true").option(
        "parquet.block.size", 1 << 20).parquet(f"{path}/{ENTRIES}")
    ids = entries.where(F.length("ride_id") > 0).select(*DAYS, "ride_id").distinct()
    runs = F.explode(F.transform(F.sequence(F.lit(1), F.length("ride_id")),
                                 lambda i: F.substring("ride_id", i, F.lit(GRAM))))
    ids.select(*DAYS, runs.alias("gram"), "ride_id").distinct().hint("rebalance", *DAYS) \
        .sortWithinPartitions(*DAYS, "gram", "ride_id").write.mode("overwrite").partitionBy(*DAYS).option(
        "parquet.block.size", 1 << 20).parquet(f"{path}/{GRAMS}")


def _of_day(df: DataFrame, year: int, month: int, day: int) -> DataFrame:
    return df.where((F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day))


def stored_id(entries: DataFrame, ride_id: str, year: int, month: int, day: int) -> DataFrame:
    """Entries of one whole id: row groups whose range or filter does not hold it are not read."""
    return _of_day(entries, year, month, day).where(F.col("ride_id") == ride_id)


def stored_ids_with(grams: DataFrame, part_of_id: str, year: int, month: int, day: int) -> DataFrame:
    """Ids of one day that contain a text: those that hold all its runs, of which only the row groups
    around these runs are read, and then the text itself."""
    of_day = _of_day(grams, year, month, day)
    if len(part_of_id) <= GRAM:
        return of_day.where(F.col("gram").startswith(part_of_id)).select("ride_id").distinct()
    asked = sorted({part_of_id[i:i + GRAM] for i in range(len(part_of_id) - GRAM + 1)})
    held = of_day.where(F.col("gram").isin(asked)).groupBy("ride_id").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") == len(asked))
    return held.where(F.col("ride_id").contains(part_of_id)).select("ride_id")


def stored_lookup(entries: DataFrame, grams: DataFrame, part_of_id: str, year: int, month: int,
                  day: int) -> DataFrame:
    """What ``ride_id_lookup`` gives, from the stored tables; an empty text is in every id."""
    of_day = _of_day(entries, year, month, day)
    if not part_of_id:
        return of_day.where(F.col("ride_id").isNotNull())
    return of_day.join(stored_ids_with(grams, part_of_id, year, month, day), "ride_id", "left_semi")


def since(entries: DataFrame, now: datetime, hours: int) -> DataFrame:
    """Predictions of the last hours, each once: a range on the time, with the days pruned."""
    start = now - timedelta(hours=hours)
    instant = wire.iso_instant(F.col("timestamp"))
    day = F.make_date("year", "month", "day")
    return entries.where(
        day.between(F.lit(start.date()), F.lit(now.date()))
        & (instant > F.lit(start).cast("timestamp_ntz"))
        & (instant <= F.lit(now).cast("timestamp_ntz"))
    )


def predictions_per_day(latest: DataFrame, shown: int = S.LISTED_PREDICTIONS) -> DataFrame:
    """Per day the number of predictions, the first few ride ids and how many more there are.

    The rank limit is applied in every task before the shuffle, so a day that holds most rows still
    sends only a few per task; the counts are partial sums. Both come together in a union of a few
    rows per day, which leaves the two branches alike, so the work below them is done once.
    """
    days = ["year", "month", "day"]
    rank = F.row_number().over(Window.partitionBy(*days).orderBy("ride_id"))
    first = (
        latest.select(*days, "ride_id").withColumn("position", rank)
        .where(F.col("position") <= shown)
        .select(*days, "ride_id", F.lit(0).cast("bigint").alias("n"))
    )
    totals = latest.groupBy(*days).agg(F.count(F.lit(1)).alias("n")).select(
        *days, F.lit(None).cast("string").alias("ride_id"), "n")
    report = totals.unionByName(first).groupBy(*days).agg(
        F.sum("n").alias("total"), F.array_sort(F.collect_list("ride_id")).alias("ids"))
    return report.select(
        *days, "total", F.array_join("ids", ",").alias("first_ride_ids"),
        F.greatest(F.col("total") - shown, F.lit(0).cast("bigint")).alias("more"),
    )
