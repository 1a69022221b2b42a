"""Duration model: training, scoring with a safe default, storage and run records."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, fields

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill import schemas
from tripmill import settings as S
from tripmill.operators import boosting
from tripmill.operators.features import (
    route_sums, smoothed_mean, with_other_trips_mean, with_route,
)
from tripmill.operators.monitoring import binned, edges_of, values_at_ranks
from tripmill.session import shared_root

SUMS, MEANS, CELLS, CHECKED, HEADER, ROUNDS = (
    "route_sums", "route_means", "cells", "validation_cells", "header", "rounds")


@dataclass(frozen=True)
class TrainingParams:
    """Boosting parameters.

    Two features of at most ``bins`` bins, one more each for missing values, make a grid of fixed size
    (16,641 cells); a tree has at most as many leaves however many rows there are, and this is all
    that the driver holds. The first tree counts whole, the others by the learning rate. ``partitions``
    is the most files that the table of cells is stored in.
    """

    rounds: int = S.BOOSTING_ROUNDS
    depth: int = S.TREE_DEPTH
    learning_rate: float = S.LEARNING_RATE
    child_weight: float = S.CHILD_WEIGHT
    l1: float = S.L1
    l2: float = S.L2
    bins: int = 128
    smoothing: float = 20.0
    seed: int = S.MODEL_SEED
    partitions: int = 64

    @property
    def side(self) -> int:
        """Bins of a feature, with the one for missing values."""
        return self.bins + 1

    def weight(self, round_: int) -> float:
        return 1.0 if round_ == 0 else self.learning_rate


@dataclass(frozen=True)
class DurationModel:
    """Bundled routes (each with its mean and bin), bin edges and the rounds; stored in one folder."""

    means: DataFrame
    rounds: DataFrame
    params: TrainingParams
    overall: float
    low: float
    high: float
    route_edges: Sequence[float]
    distance_edges: Sequence[float]
    path: str


# ---- bins --------------------------------------------------------------------------------------------

def cell_of(route_bin: Column, distance: Column, model: "DurationModel") -> Column:
    side = model.params.side
    return route_bin * F.lit(side) + binned(distance, model.distance_edges, side - 1)


def with_cell(df: DataFrame, model: DurationModel, name: str = "_cell") -> DataFrame:
    """Add the cell of each row; an unseen route gets the bin of the overall mean."""
    side = model.params.side
    unseen = binned(F.lit(model.overall), model.route_edges, side - 1)
    placed = with_route(df).join(
        model.means.select("PU_DO", F.col("route_bin").alias("_route_bin")), "PU_DO", "left")
    return placed.withColumn(name, cell_of(
        F.coalesce("_route_bin", unseen), F.col("trip_distance"), model)).drop("_route_bin")


def cell_sums(rows: DataFrame) -> DataFrame:
    """Rows, label sums and sums of squares per ``_cell``; exact, so the order of rows is all one."""
    y = F.col("duration")
    exact = y.cast("decimal(20,10)")
    return rows.where(y.isNotNull()).groupBy(F.col("_cell").alias("cell")).agg(
        F.count(y).alias("trips"), F.sum(exact).cast("double").alias("minutes"),
        F.sum((y * y).cast("decimal(24,10)")).cast("double").alias("squares"))


def routes_of_split(model: DurationModel, last_bin: int) -> DataFrame:
    """The routes that a split of the bundled route columns sends left."""
    return model.means.where(F.col("route_bin") <= last_bin).select("PU_DO")


# ---- training ----------------------------------------------------------------------------------------

def prepare_training(train: DataFrame, path: str, params: TrainingParams = TrainingParams(),
                     validation: DataFrame | None = None, patience: int | None = None,
                     ) -> DurationModel:
    """Everything that boosting needs, stored under ``path``: bundled routes, edges and cells.

    The one-hot columns of the routes exclude each other, so they are bundled: routes in the order of
    their smoothed mean, cut into bins that hold equally many training rows. A split at a bin divides
    the routes into two sets without a vector. One aggregate gives the routes' sums and through them
    the means; training rows are placed by the mean of the other trips of their route.
    """
    spark = train.sparkSession
    shared_root(spark)
    train = train.select("PU_DO", "trip_distance", "duration")
    route_sums(train).write.mode("overwrite").parquet(f"{path}/{SUMS}")
    sums = spark.read.schema(schemas.ROUTE_SUMS).parquet(f"{path}/{SUMS}")
    overall, low, high = sums.agg(
        F.sum(F.col("minutes").cast("decimal(30,10)")).cast("double") / F.sum("trips"),
        F.min("low"), F.max("high")).first()
    if overall is None:
        raise ValueError("there are no training rows")
    rows = with_other_trips_mean(train, sums, overall, params.smoothing)
    shares = [i / params.bins for i in range(1, params.bins)]
    found = values_at_ranks(rows, {"route_mean": shares, "trip_distance": shares})
    route_edges, distance_edges = (edges_of(found[c][0]) for c in ("route_mean", "trip_distance"))
    missing = params.side - 1
    mean = smoothed_mean(F.col("minutes"), F.col("trips"), overall, params.smoothing)
    sums.select("PU_DO", mean.alias("route_mean")).withColumn(
        "route_bin", binned(F.col("route_mean"), route_edges, missing)).write.mode(
        "overwrite").parquet(f"{path}/{MEANS}")
    header = (overall, low, high, route_edges, distance_edges, {k: repr(v) for k, v in asdict(params).items()},
              patience)
    spark.createDataFrame([header], schemas.MODEL_HEADER).coalesce(1).write.mode(
        "overwrite").parquet(f"{path}/{HEADER}")
    spark.createDataFrame([], schemas.ROUNDS).coalesce(1).write.mode("overwrite").parquet(
        f"{path}/{ROUNDS}")
    model = load_model(spark, path)
    placed = rows.withColumn("_cell", cell_of(
        binned(F.coalesce("route_mean", F.lit(overall)), route_edges, missing),
        F.col("trip_distance"), model))
    cell_sums(placed).coalesce(params.partitions).write.mode("overwrite").parquet(f"{path}/{CELLS}")
    checked = (cell_sums(with_cell(validation, model)) if validation is not None
               else spark.createDataFrame([], schemas.CELLS))
    checked.coalesce(params.partitions).write.mode("overwrite").parquet(f"{path}/{CHECKED}")
    return model


def _grid(spark: SparkSession, path: str, side: int) -> list[np.ndarray]:
    """Counts, sums and sums of squares of the cells, which number ``side`` squared at most."""
    out = [np.zeros(side * side) for _ in range(3)]
    for r in spark.read.schema(schemas.CELLS).parquet(path).collect():
        for column, x in zip(out, (r["trips"], r["minutes"], r["squares"])):
            column[r["cell"]] = x
    return [x.reshape(side, side) for x in out]


def continue_training(spark: SparkSession, path: str, at_most: int | None = None) -> DurationModel:
    """Boost from where the stored rounds end until all are there or patience has run out.

    Every round is stored with its tree and the margin of each cell, so a broken run goes on where it
    stopped. ``at_most`` bounds the rounds of this call.
    """
    model = load_model(spark, path)
    params = model.params
    patience = spark.read.schema(schemas.MODEL_HEADER).parquet(f"{path}/{HEADER}").first()["patience"]
    trips, minutes, squares = _grid(spark, f"{path}/{CELLS}", params.side)
    checked = _grid(spark, f"{path}/{CHECKED}", params.side)
    done = model.rounds.orderBy("round").select("round", "validation_rmse").collect()
    margins = np.zeros_like(trips)
    if done:
        last = model.rounds.where(F.col("round") == done[-1]["round"]).first()
        margins = np.array(last["margins"]).reshape(margins.shape)
    errors = [r["validation_rmse"] for r in done]
    for round_ in range(len(done), params.rounds):
        if at_most is not None and round_ >= len(done) + at_most or out_of_patience(errors, patience):
            break
        tree, values = boosting.grow(trips * margins - minutes, trips, params.depth,
                                     params.child_weight, params.l1, params.l2)
        margins = margins + params.weight(round_) * values
        served = margins.clip(model.low, model.high)
        errors.append(boosting.squared_error(*checked, served) ** 0.5 if checked[0].any() else None)
        row = (round_, params.weight(round_), tree.depth, len(tree.features), tree.features, tree.bins,
               tree.lefts, tree.rights, tree.values, tree.rows, margins.ravel().tolist(),
               boosting.squared_error(trips, minutes, squares, served) ** 0.5, errors[-1])
        spark.createDataFrame([row], schemas.ROUNDS).coalesce(1).write.mode("append").parquet(
            f"{path}/{ROUNDS}")
    return load_model(spark, path)


def out_of_patience(errors: Sequence[float | None], patience: int | None) -> bool:
    """Whether ``patience`` rounds have gone by since the lowest error."""
    known = [e for e in errors if e is not None]
    return bool(patience and known) and len(known) - 1 - known.index(min(known)) >= patience


def train_duration_model(train: DataFrame, path: str, params: TrainingParams = TrainingParams(),
                         validation: DataFrame | None = None,
                         patience: int | None = None) -> DurationModel:
    """Boosted trees on route and distance with squared error, L1 and L2, stored under ``path``.

    With validation rows the error of every round is stored, and with ``patience`` boosting ends when
    so many rounds have brought no lower one.
    """
    prepare_training(train, path, params, validation, patience)
    return continue_training(train.sparkSession, path)


def train_with_validation(train: DataFrame, validation: DataFrame, path: str,
                          params: TrainingParams = TrainingParams(),
                          patience: int = S.PATIENCE_ROUNDS) -> DurationModel:
    """Training that stops when the validation error has not fallen for ``patience`` rounds."""
    return train_duration_model(train, path, params, validation, patience)


def _told(spark: SparkSession, errors: Sequence[float], patience: int) -> DataFrame:
    out, best = [], 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        out.append((i, float(error), best, i - best >= patience))
    return spark.createDataFrame(
        out, "round int, rmse double, best_round int, out_of_patience boolean")


def training_errors(model: DurationModel, patience: int = S.PATIENCE_ROUNDS) -> DataFrame:
    """One row per stored round: its validation error as measured while training, the best round by
    then, and whether patience had run out."""
    errors = [r[0] for r in model.rounds.where(F.col("validation_rmse").isNotNull()).orderBy(
        "round").select("validation_rmse").collect()]
    return _told(model.rounds.sparkSession, errors, patience)


def validation_rounds(validation: DataFrame, model: DurationModel,
                      patience: int = S.PATIENCE_ROUNDS) -> DataFrame:
    """The same for any rows: the error of the rounds so far, which one is the best, and whether by
    then ``patience`` rounds have gone by without a lower one. One scan for all rounds."""
    cells = cell_sums(with_cell(validation, model))
    margins = model.rounds.select("round", F.posexplode("margins").alias("cell", "margin"))
    m, n = in_range(F.col("margin"), model), F.sum("trips")
    squared = F.sum(F.col("squares") - 2 * m * F.col("minutes") + F.col("trips") * m * m)
    errors = margins.join(cells, "cell").groupBy("round").agg(
        F.sqrt(F.greatest(squared / n, F.lit(0.0))).alias("rmse")).orderBy("round").collect()
    return _told(validation.sparkSession, [r["rmse"] for r in errors], patience)


# ---- scoring -----------------------------------------------------------------------------------------

def in_range(margin: Column, model: DurationModel) -> Column:
    """Margins within the labels trained on: where there were no rows, corrections can add up."""
    return F.least(F.greatest(margin, F.lit(model.low)), F.lit(model.high))


def predict(requests: DataFrame, model: DurationModel, rounds: int | None = None) -> DataFrame:
    """Requests with a ``prediction`` by all trees or the first ``rounds``; routes are derived as in
    training. The margins, one number per cell of the grid, are a constant of the plan."""
    chosen = model.rounds if rounds is None else model.rounds.where(F.col("round") < rounds)
    margins = chosen.agg(F.max_by("margins", "round")).first()[0]
    served = np.array(margins if margins is not None else []).clip(model.low, model.high)
    grid = F.split(F.lit(",".join(map(repr, served.tolist()))), ",").cast("array<double>")
    return with_cell(requests, model).withColumn("prediction", F.get(grid, F.col("_cell"))).drop(
        "_cell")


def with_default(predicted: DataFrame) -> DataFrame:
    """The prediction, or the default where there is none, and which of the two it is."""
    missing = F.col("prediction").isNull() | F.isnan("prediction")
    return predicted.withColumns({
        "predicted_duration": F.when(missing, S.DEFAULT_MINUTES).otherwise(F.col("prediction")),
        "is_default": missing,
    }).drop("prediction", "PU_DO")


def score_or_default(requests: DataFrame, model: DurationModel | None) -> DataFrame:
    """Score requests; without a model every row gets the default."""
    if model is None:
        return with_default(requests.withColumn("prediction", F.lit(None).cast("double")))
    return with_default(predict(requests, model))


def read_means(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ROUTE_MEANS).parquet(f"{path}/{MEANS}")


def load_model(spark: SparkSession, path: str) -> DurationModel:
    """A stored model as it is now."""
    header = spark.read.schema(schemas.MODEL_HEADER).parquet(f"{path}/{HEADER}").first()
    kinds = {f.name: type(f.default) for f in fields(TrainingParams)}
    params = TrainingParams(**{k: kinds[k](v) for k, v in header["params"].items()})
    return DurationModel(
        read_means(spark, path), spark.read.schema(schemas.ROUNDS).parquet(f"{path}/{ROUNDS}"), params,
        header["overall"], header["low"], header["high"], header["route_edges"],
        header["distance_edges"], path)


def record_run(spark: SparkSession, root: str, params: TrainingParams,
               metrics: dict[str, float], run_id: str | None = None) -> str:
    """Append one run to the table of runs."""
    run_id = run_id or uuid.uuid4().hex
    row = (run_id, {k: str(v) for k, v in asdict(params).items()}, metrics)
    one = spark.createDataFrame([row], schemas.TRAINING_RUN).coalesce(1)
    one.write.mode("append").parquet(root)
    return run_id


def training_runs(spark: SparkSession, root: str, run_id: str | None = None) -> DataFrame:
    runs = spark.read.schema(schemas.TRAINING_RUN).parquet(root)
    return runs.where(F.col("run_id") == run_id) if run_id else runs


def tree_summary(spark: SparkSession, model: DurationModel) -> DataFrame:
    """One row per boosting round: weight, depth and size of its tree."""
    return model.rounds.select("round", "weight", "depth", "nodes")
