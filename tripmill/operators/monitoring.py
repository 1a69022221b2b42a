"""Data quality, drift and model quality: published statistics, each from few aggregates.

Completeness is the share of non-null values. The fence of an outlier is 1.5 interquartile ranges
beyond the quartiles, where a quartile is the value at rank ``ceil(p * n)``. Drift is the population
stability index over fixed edges, ``sum((a - e) * ln(a / e))`` with the shares ``e`` of the reference
and ``a`` of the current rows; a share of zero counts as ``EMPTY_SHARE``. Model quality is RMSE, MAE
and ``1 - SSE / SST`` per group.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FENCE = 1.5
EMPTY_SHARE = 1e-6
DRIFT_LIMIT = 0.2
#: Values of a summary, and what its counts can be off by: 3.5 over the slots of its table, which are the
#: next power of two above 4 / 3 of the values.
TRACKED = 131_072
SUMMARY_ERROR = 3.5 / 262_144
HEAVY_SHARE = 1e-4
HISTOGRAM_BINS = 16_384


def completeness(df: DataFrame) -> DataFrame:
    """Per column how many values are there, of how many rows, as one aggregate of one scan."""
    counted = df.agg(F.count(F.lit(1)).alias("_rows"),
                     *[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(df.columns)])
    entries = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("present"))
        for i, c in enumerate(df.columns)]))
    return counted.select("_rows", entries.alias("_e")).select(
        "_e.column_name", "_e.present", F.col("_rows").alias("total"),
        F.when(F.col("_rows") > 0, F.col("_e.present") / F.col("_rows")).alias("completeness"))


def values_at_ranks(df: DataFrame, wanted: Mapping[str, Sequence[float]],
                    ) -> dict[str, tuple[list[float | None], int]]:
    """Per column the values at ranks ``ceil(share * n)`` of its non-null values, and n.

    The range of a rank is cut into ``HISTOGRAM_BINS`` bins, and the bin that holds it is cut again
    until it holds a single value. All ranks of all columns go together: each round is one aggregate
    over one scan, and a row per rank comes to the driver. The ranges of a column never overlap, so the
    one of a value is found by halving.
    """
    spark = df.sparkSession
    names = list(wanted)
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("column"), F.col(f"`{c}`").cast("double").alias("v"))
        for i, c in enumerate(names)])).alias("_e")).select("_e.*").where(
        F.col("v").isNotNull() & ~F.isnan("v"))
    whole = {r["column"]: r for r in long.groupBy("column").agg(
        F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()}
    # Per rank: column, place among the shares, bounds of the range that holds it, rank inside it.
    ranks = [[i, k, whole[i]["low"], whole[i]["high"], max(1, math.ceil(share * whole[i]["n"]))]
             for i, c in enumerate(names) if i in whole for k, share in enumerate(wanted[c])]
    while True:
        spans = {}
        for i, _, low, high, _ in ranks:
            if low < high:
                spans.setdefault((i, low, high), len(spans))
        if not spans:
            break
        asked = F.broadcast(spark.createDataFrame(
            [(r, spans[(i, low, high)], rank)
             for r, (i, _, low, high, rank) in enumerate(ranks) if low < high],
            "place int, span int, rank long"))
        inside = long.withColumn("_s", _span_of(F.col("v"), F.col("column"), spans)).select(
            "v", "_s.*").where(F.col("v") >= F.col("low"))
        bin_ = F.least(F.floor((F.col("v") - F.col("low")) / F.col("width")),
                       F.lit(HISTOGRAM_BINS - 1))
        counts = inside.groupBy("span", bin_.alias("bin")).agg(
            F.count("v").alias("n"), F.min("v").alias("from"), F.max("v").alias("to"))
        upto = F.sum("n").over(Window.partitionBy("span").orderBy("bin"))  # rows: bins of a span
        found = counts.withColumn("upto", upto).join(asked, "span").where(
            (F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n")))
        for r in found.select("place", "from", "to", "rank", "upto", "n").collect():
            ranks[r["place"]][2:] = [r["from"], r["to"], r["rank"] - (r["upto"] - r["n"])]
    out = {c: ([None] * len(wanted[c]), whole[i]["n"] if i in whole else 0)
           for i, c in enumerate(names)}
    for i, k, low, _, _ in ranks:
        out[names[i]][0][k] = low
    return out


def _span_of(value: Column, column: Column, spans: Mapping[tuple[int, float, float], int]) -> Column:
    """Number, low end and bin width of the first range of a column that does not end below a value."""
    found = F.lit(None)
    for i in sorted({i for i, _, _ in spans}):
        mine = sorted((low, high, s) for (c, low, high), s in spans.items() if c == i)
        ranges = F.array(*[F.struct(
            F.lit(s).alias("span"), F.lit(low).alias("low"),
            F.lit((high - low) / HISTOGRAM_BINS or high - low).alias("width")) for low, high, s in mine])
        place = binned(value, [high for _, high, _ in mine], len(mine))
        found = F.when(column == i, F.get(ranges, place)).otherwise(found)
    return found


def value_at_rank(df: DataFrame, column: str, share: float) -> tuple[float | None, int]:
    """The value at rank ``ceil(share * n)`` of the non-null values, and n."""
    (value,), n = values_at_ranks(df, {column: [share]})[column]
    return value, n


def outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column its quartiles, fence and how many values lie beyond it."""
    spark = df.sparkSession
    found = values_at_ranks(df, {c: (0.25, 0.75) for c in columns})
    fences = {c: (q1, q3, n) for c, ((q1, q3), n) in found.items()}
    beyond = [F.count_if((F.col(c) < q1 - FENCE * (q3 - q1)) | (F.col(c) > q3 + FENCE * (q3 - q1)))
              if n else F.lit(0).cast("bigint") for c, (q1, q3, n) in fences.items()]
    counts = df.agg(*[b.alias(c) for b, c in zip(beyond, columns)]).first()
    rows = [(c, q1, q3, q1 - FENCE * (q3 - q1), q3 + FENCE * (q3 - q1), n, counts[c])
            if n else (c, None, None, None, None, 0, 0) for c, (q1, q3, n) in fences.items()]
    return spark.createDataFrame(
        rows, "column_name string, q1 double, q3 double, low double, high double, total bigint, "
              "n_outliers bigint")


def bin_of(value: Column, low: float, high: float, bins: int) -> Column:
    """0 below the range, 1 to ``bins`` inside, one more above it."""
    inside = F.floor((value - F.lit(low)) / F.lit((high - low) / bins)) + 1
    return F.when(value < low, 0).when(value >= high, bins + 1).otherwise(inside).cast("int")


def binned(value: Column, edges: Sequence[float], missing: int) -> Column:
    """How many edges lie below a value, by halving; ``missing`` for null and NaN."""
    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value <= F.lit(edges[middle]), between(low, middle)).otherwise(
            between(middle + 1, high))
    found = between(0, len(edges))
    return F.when(value.isNull() | F.isnan(value), F.lit(missing)).otherwise(found).cast("int")


def edges_of(values: Sequence[float | None]) -> list[float]:
    """Distinct values in order, without those that are unknown."""
    return sorted({v for v in values if v is not None})


def quantile_edges(df: DataFrame, columns: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Edges that cut the rows into bins of equal size; equal ones are one."""
    shares = [i / bins for i in range(1, bins)]
    found = values_at_ranks(df, {c: shares for c in columns})
    return {c: edges_of(found[c][0]) for c in columns}


def feature_drift(df: DataFrame, is_current: Column,
                  edges: Mapping[str, tuple[float, float, int] | list[float]]) -> DataFrame:
    """The stability index of each feature between the reference rows and the current ones.

    ``edges`` names the features with the range and number of their bins, or with a list of edges. All
    are counted in one scan with one small shuffle.
    """
    def place(name: str, span: tuple | list) -> Column:
        value = F.col(name)
        if isinstance(span, tuple):
            return bin_of(value, *span)
        return F.when(value.isNotNull() & ~F.isnan(value), binned(value, span, -1))

    features = F.explode(F.array(*[
        F.struct(F.lit(name).alias("feature"), place(name, span).alias("bin"))
        for name, span in edges.items()]))
    counted = df.select(is_current.alias("_current"), features.alias("_f")).where(
        F.col("_f.bin").isNotNull()).groupBy("_f.feature", "_f.bin").agg(
        F.count_if(~F.col("_current")).alias("e"), F.count_if("_current").alias("a"))
    return stability(counted)


def stability(counted: DataFrame) -> DataFrame:
    """The stability index of each feature from the reference rows ``e`` and current rows ``a`` of its
    bins."""
    whole = Window.partitionBy("feature")  # as many rows as a feature has bins

    def share(n: str) -> Column:
        return F.greatest(F.col(n) / F.sum(n).over(whole), F.lit(EMPTY_SHARE))

    shares = counted.select("feature", share("e").alias("e"), share("a").alias("a"))
    return shares.groupBy("feature").agg(
        F.sum((F.col("a") - F.col("e")) * F.ln(F.col("a") / F.col("e"))).alias("psi"))


def heavy_summary(df: DataFrame, column: str, *parts: Column) -> DataFrame:
    """A summary of bounded size of the frequent values of each part, for example of each month.

    Summaries are merged by ``frequent_values``, so parts that have not changed need no new scan. A
    summary tracks ``TRACKED`` values; its counts are off by at most ``SUMMARY_ERROR`` of the rows.
    """
    return df.where(F.col(column).isNotNull()).groupBy(*parts).agg(
        F.call_function("approx_top_k_accumulate", F.col(column), F.lit(TRACKED)).alias("summary"))


def frequent_values(summaries: DataFrame, share: float) -> DataFrame:
    """All values that at least ``share`` of the rows have, and few others: at most
    ``1 / (share - SUMMARY_ERROR)``."""
    if share <= SUMMARY_ERROR:
        raise ValueError(f"a share must be above {SUMMARY_ERROR}")
    most = min(TRACKED, math.ceil(1 / (share - SUMMARY_ERROR)))
    merged = summaries.agg(
        F.call_function("approx_top_k_combine", "summary", F.lit(TRACKED)).alias("summary"))
    return merged.select(F.explode(F.call_function(
        "approx_top_k_estimate", "summary", F.lit(most))).alias("_e")).select(
        F.col("_e.item").alias("value"))


def value_drift(df: DataFrame, is_current: Column, column: str,
                share: float = HEAVY_SHARE) -> DataFrame:
    """The stability index of a column of many values, such as routes: each value that at least
    ``share`` of the reference rows have is a bin, all others are one.

    A summary proposes the values, at most ``1 / share`` about; one scan counts them exactly.
    """
    reference = df.where(~is_current)
    summaries = heavy_summary(reference, column, F.spark_partition_id().alias("part"))
    heavy = F.broadcast(frequent_values(summaries, share))
    counted = df.select(is_current.alias("_current"), F.col(column).alias("value")).join(
        heavy.withColumn("heavy", F.lit(True)), "value", "left").groupBy(
        F.when(F.col("heavy"), F.col("value")).alias("value")).agg(
        F.count_if(~F.col("_current")).alias("e"), F.count_if("_current").alias("a"))
    whole = Window.partitionBy(F.lit(column))  # the proposed values
    enough = F.col("value").isNotNull() & (F.col("e") >= F.lit(share) * F.col("total"))
    return stability(counted.withColumn("total", F.sum("e").over(whole)).groupBy(
        F.lit(column).alias("feature"), F.when(enough, F.col("value")).alias("bin")).agg(
        F.sum("e").alias("e"), F.sum("a").alias("a")))


def drift_alert(drift: DataFrame, limit: float = DRIFT_LIMIT) -> DataFrame:
    """Whether a feature has drifted beyond the limit; an unknown index is no alert."""
    return drift.withColumn("alert", F.coalesce(F.col("psi") > limit, F.lit(False)))


def model_quality(scored: DataFrame, *groups: Column, label: str = "duration",
                  prediction: str = "prediction") -> DataFrame:
    """RMSE, MAE and R2 per group over rows with label and prediction; R2 is null where all labels
    of a group are equal."""
    error = F.col(label) - F.col(prediction)
    spread = F.var_pop(label) * F.count(label)
    squares = F.sum(error * error)
    return scored.where(F.col(label).isNotNull() & F.col(prediction).isNotNull()).groupBy(
        *groups).agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.when(spread > 0, F.lit(1.0) - squares / spread).alias("r2"))


# ---- predictions against what came out ---------------------------------------------------------------

MATCHED, LATE, MISSING, PENDING = "matched", "late", "missing", "pending"


def seconds(n: int) -> Column:
    """A fixed span, as a literal that a stream's state can be bounded by."""
    return F.expr(f"INTERVAL '{int(n)}' SECOND")


def in_time(within_seconds: int) -> Column:
    """Whether an actual of ``a`` came in the time that a prediction of ``p`` waits for it."""
    return (F.col("p.ride_id") == F.col("a.ride_id")) & (
        F.col("a.actual_ts") >= F.col("p.predicted_ts")) & (
        F.col("a.actual_ts") <= F.col("p.predicted_ts") + seconds(within_seconds))


def first_actuals(actuals: DataFrame) -> DataFrame:
    """One actual per ride, the earliest; repeated ones are combined before the shuffle."""
    return actuals.where(F.col("ride_id").isNotNull()).groupBy("ride_id").agg(
        F.min(F.struct("actual_ts", "duration")).alias("_a")).select("ride_id", "_a.*")


def match_actuals(predictions: DataFrame, actuals: DataFrame, within_seconds: int,
                  watermark: Column | None = None) -> DataFrame:
    """Predictions (ride_id, predicted_ts, prediction) with the ``duration`` that came out and an
    ``outcome``: matched within the time; late, if the actual came after it; missing, if none came.

    With a ``watermark`` a prediction without an actual whose time has not run out by then is pending.
    Durations of late ones are left out, as a job that runs all the time would not see them.
    """
    found = predictions.alias("p").join(first_actuals(actuals).alias("a"),
                                        F.col("p.ride_id") == F.col("a.ride_id"), "left")
    matched = F.coalesce(in_time(within_seconds), F.lit(False))
    ends = F.col("p.predicted_ts") + seconds(within_seconds)
    open_ = F.lit(False) if watermark is None else F.coalesce(ends >= watermark, F.lit(True))
    outcome = F.when(matched, MATCHED).when(open_, PENDING).when(
        F.col("a.ride_id").isNotNull(), LATE).otherwise(MISSING)
    return found.select(
        "p.*", F.when(matched, F.col("a.actual_ts")).alias("actual_ts"),
        F.when(matched, F.col("a.duration")).alias("duration"), outcome.alias("outcome"))


def quality_over_time(matched: DataFrame, *groups: Column) -> DataFrame:
    """Per group the predictions by outcome, and the error over the matched ones."""
    error = F.col("duration") - F.col("prediction")
    spread = F.var_pop("duration") * F.count("duration")
    rated = F.when(F.col("outcome") == MATCHED, error)
    squares = F.sum(rated * rated)
    return matched.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col("outcome") == o).alias(f"n_{o}")
          for o in (MATCHED, LATE, MISSING, PENDING)],
        F.sqrt(F.avg(rated * rated)).alias("rmse"), F.avg(F.abs(rated)).alias("mae"),
        F.when(spread > 0, F.lit(1.0) - squares / spread).alias("r2"))
