import random

import pytest
from pyspark.sql import functions as F

from tripmill.operators import features, metrics, model
from tripmill.session import fresh_folder

TRIP = "PULocationID string, DOLocationID string, PU_DO string, trip_distance double, duration double"


@pytest.fixture(scope="module")
def train(spark):
    rng = random.Random(1)
    rows = []
    for i in range(600):
        pu, do, miles = str(i % 3 + 1), str(i % 2 + 10), rng.uniform(1, 10)
        rows.append((pu, do, f"{pu}_{do}", miles, 3.0 * miles + 4 * (i % 3) + rng.random()))
    return spark.createDataFrame(rows, TRIP)


@pytest.fixture(scope="module")
def fitted(train, spark):
    params = model.TrainingParams(rounds=3, depth=4, partitions=4)
    path = fresh_folder(spark, "model")
    return path, model.train_duration_model(train, path, params)


def test_one_hot_of_seen_and_unseen_routes(spark, train):
    fitted = features.fit_features(train, fresh_folder(spark, "features"))
    routes = ["1_10", "1_11", "2_10", "2_11", "3_10", "3_11"]
    assert [r.PU_DO for r in fitted.vocabulary.orderBy("route_index").collect()] == routes
    df = spark.createDataFrame([("2", "10", 2.5), ("9", "9", 1.5)],
                               "PULocationID string, DOLocationID string, trip_distance double")
    seen, unseen = features.transform_features(df, fitted).orderBy("PULocationID").collect()
    assert (seen.route_index, unseen.route_index) == (2, None)
    assert seen[features.FEATURES].toArray().tolist() == [0, 0, 1, 0, 0, 0, 2.5]
    assert unseen[features.FEATURES].toArray().tolist() == [0, 0, 0, 0, 0, 0, 1.5]
    names = [r.feature for r in features.vocabulary(fitted).orderBy("feature_index").collect()]
    assert names == [f"PU_DO={r}" for r in routes] + ["trip_distance"]


def test_route_means_are_drawn_towards_the_overall_mean(spark):
    df = spark.createDataFrame([("a", 10.0), ("a", 20.0), ("b", 40.0)],
                               "PU_DO string, duration double")
    mean = features.smoothed_mean(F.col("minutes"), F.col("trips"), 20.0, 2.0)
    got = {r.PU_DO: r.m for r in features.route_sums(df).select("PU_DO", mean.alias("m")).collect()}
    assert got == {"a": pytest.approx((30 + 40) / 4), "b": pytest.approx((40 + 40) / 3)}


def test_no_row_sees_its_own_duration(spark):
    df = spark.createDataFrame([("a", 10.0), ("a", 20.0), ("b", 40.0)],
                               "PU_DO string, duration double")
    sums = features.route_sums(df)
    got = {r.duration: r.route_mean
           for r in features.with_other_trips_mean(df, sums, 20.0, 2.0).collect()}
    assert got == {10.0: pytest.approx(20.0), 20.0: pytest.approx(50 / 3), 40.0: pytest.approx(20.0)}
    bare = features.with_other_trips_mean(df, sums, 20.0, 0.0).collect()
    assert {r.duration: r.route_mean for r in bare} == {10.0: 20.0, 20.0: 10.0, 40.0: None}


def test_partitions_of_the_input_do_not_matter(spark, train):
    params = model.TrainingParams(rounds=3, depth=30, partitions=4)
    answers = [
        sorted(r.prediction for r in model.predict(train, model.train_duration_model(
            train.repartition(n, "trip_distance"), fresh_folder(spark, "model"), params)).collect())
        for n in (4, 8)]
    assert answers[0] == answers[1]


def test_model_beats_the_mean(train, fitted):
    scored = model.predict(train, fitted[1])
    baseline = train.withColumn("prediction", F.lit(train.agg(F.avg("duration")).first()[0]))
    assert metrics.rmse(scored).first().rmse < 0.5 * metrics.rmse(baseline).first().rmse


def test_stored_model_gives_the_same_predictions(spark, train, fitted):
    path, original = fitted
    loaded = model.load_model(spark, path)
    ours = sorted(r.prediction for r in model.predict(train, original).collect())
    assert ours == sorted(r.prediction for r in model.predict(train, loaded).collect())


def test_zone_matters_in_serving(spark, fitted):
    df = spark.createDataFrame([("1", "10", 5.0), ("3", "10", 5.0), ("99", "10", 5.0)],
                               "PULocationID string, DOLocationID string, trip_distance double")
    low, high, unseen = [r.predicted_duration for r in model.score_or_default(df, fitted[1])
                         .orderBy(F.col("PULocationID").cast("int")).collect()]
    assert low < high and unseen != 15.0


def test_default_where_there_is_no_prediction(spark, fitted):
    df = spark.createDataFrame([("1", "10", 5.0)],
                               "PULocationID string, DOLocationID string, trip_distance double")
    got = model.score_or_default(df, None).first()
    assert (got.predicted_duration, got.is_default) == (15.0, True)
    nan = model.with_default(df.withColumn("prediction", F.lit(float("nan")))).first()
    assert (nan.predicted_duration, nan.is_default) == (15.0, True)
    assert model.score_or_default(df, fitted[1]).first().is_default is False


def test_every_round_is_measured_and_patience_is_told(spark, train, fitted):
    rows = model.validation_rounds(train, fitted[1], patience=1).orderBy("round").collect()
    assert [r["round"] for r in rows] == [0, 1, 2]
    errors = [r.rmse for r in rows]
    assert rows[-1].best_round == errors.index(min(errors))
    assert not any(r.out_of_patience for r in rows)  # on its own rows each round is better
    far = train.withColumn("duration", F.col("duration") - 50)
    worse = model.validation_rounds(far, fitted[1], patience=1).orderBy("round").collect()
    assert [r.out_of_patience for r in worse] == [r["round"] - r.best_round >= 1 for r in worse]


def test_no_rows_no_model(spark, train):
    with pytest.raises(ValueError):
        model.train_duration_model(train.limit(0), fresh_folder(spark, "model"))


def test_runs_are_appended_and_found_by_id(spark):
    root = fresh_folder(spark, "runs")
    first = model.record_run(spark, root, model.TrainingParams(), {"rmse": 9.0})
    second = model.record_run(spark, root, model.TrainingParams(depth=3), {"rmse": 8.0})
    assert model.training_runs(spark, root).count() == 2
    got = model.training_runs(spark, root, second).first()
    assert first != second and got.params["depth"] == "3" and got.metrics == {"rmse": 8.0}


def test_parameters_default_to_the_fixed_values():
    p = model.TrainingParams()
    assert (p.rounds, p.depth, p.learning_rate, p.seed) == (30, 30, 0.09585355369315604, 42)


def test_monthly_run_fills_the_cache_and_records_even_a_failed_gate(spark, sf_dir, monkeypatch):
    from datetime import date
    from tripmill.plans import flows
    from tripmill.sources import fixtures, trips as trip_source
    folders = [fresh_folder(spark, n) for n in ("cache", "model", "runs")]
    asked = []

    def origin(year, month):
        asked.append((year, month))
        return fixtures.trips(spark, sf_dir, year, month)

    def run(limit):
        monkeypatch.setattr(flows, "RMSE_LIMIT", limit)
        return flows.monthly_run(spark, date(1998, 7, 31), folders[0], origin, *folders[1:],
                                 model.TrainingParams(rounds=2, depth=2, partitions=4))

    trained = run(1000.0)
    assert asked == [(1998, 3), (1998, 4)]
    assert trip_source.month_exists(spark, folders[0], 1998, 3)
    assert not trip_source.month_exists(spark, folders[0], 1998, 5)
    with pytest.raises(ValueError):
        run(0.0)
    assert asked == [(1998, 3), (1998, 4)]
    assert model.training_runs(spark, folders[2]).count() == 2
    assert model.training_runs(spark, folders[2], trained.run_id).first().metrics["rmse"] == trained.rmse


# ---- boosting ------------------------------------------------------------------------------------

def plain_leaves(rows, tree):
    """Rows (route bin, distance bin, gradient) of every leaf."""
    found = {}
    for r, d, g in rows:
        node = 0
        while tree.features[node] != -1:
            go_left = (r, d)[tree.features[node]] <= tree.bins[node]
            node = tree.lefts[node] if go_left else tree.rights[node]
        found.setdefault(node, []).append(g)
    return found


@pytest.mark.parametrize("l1,l2,weight,depth", [(0.0, 0.0, 1.0, 3), (0.018, 0.0117, 1.06, 30),
                                                (5.0, 2.0, 3.0, 4)])
def test_leaf_values_are_those_of_the_rows(l1, l2, weight, depth):
    import numpy as np
    from tripmill.operators import boosting
    rng = random.Random(4)
    rows = [(r := rng.randrange(6), d := rng.randrange(5), 10 - 3.0 * r - d * d + rng.random())
            for _ in range(80)]
    grid, sums = np.zeros((6, 5)), np.zeros((6, 5))
    for r, d, g in rows:
        grid[r, d] += 1
        sums[r, d] += g
    tree, values = boosting.grow(sums, grid, depth, weight, l1, l2)
    leaves = plain_leaves(rows, tree)
    assert len(leaves) == sum(f == -1 for f in tree.features) and len(leaves) > 3
    for node, gradients in leaves.items():
        total = sum(gradients)
        drawn = max(abs(total) - l1, 0) * (1 if total > 0 else -1)
        assert tree.values[node] == pytest.approx(-drawn / (len(gradients) + l2))
        assert tree.rows[node] == len(gradients) >= weight
    for r, d, _ in rows:
        (node,) = plain_leaves([(r, d, 0)], tree)
        assert values[r, d] == tree.values[node]


def test_the_first_split_is_the_best_of_all():
    import numpy as np
    from tripmill.operators import boosting
    rng = np.random.default_rng(2)
    rows = rng.integers(0, 4, (5, 7)).astype(float)
    sums = rng.normal(0, 5, (5, 7)) * rows
    tree, _ = boosting.grow(sums, rows, 1, 1.06, 0.5, 0.3)

    def plain(g, h):
        return max(abs(g) - 0.5, 0) ** 2 / (h + 0.3)

    gains = {}
    for feature, n in ((0, 5), (1, 7)):
        for at in range(n - 1):
            cut = (slice(0, at + 1), slice(None)) if feature == 0 else (slice(None), slice(0, at + 1))
            g, h = sums[cut].sum(), rows[cut].sum()
            if h >= 1.06 and rows.sum() - h >= 1.06:
                gains[feature, at] = plain(g, h) + plain(sums.sum() - g, rows.sum() - h)
    assert (tree.features[0], tree.bins[0]) == max(gains, key=gains.get)


PARAMS = model.TrainingParams(rounds=12, depth=6, bins=16, smoothing=1.0)


@pytest.fixture(scope="module")
def halves(train):
    marked = train.withColumn("n", F.pmod(F.xxhash64("trip_distance", "PU_DO"), F.lit(3)))
    return marked.where("n > 0").drop("n"), marked.where("n = 0").drop("n")


def test_each_error_is_that_of_so_many_trees(spark, halves):
    got = model.train_with_validation(*halves, fresh_folder(spark, "model"), PARAMS)
    told = model.training_errors(got).orderBy("round").collect()
    assert [r["round"] for r in told] == list(range(12))
    for r in told:
        scored = model.predict(halves[1], got, rounds=r["round"] + 1)
        assert metrics.rmse(scored).first().rmse == pytest.approx(r.rmse, abs=1e-6)
    again = model.validation_rounds(halves[1], got).orderBy("round").collect()
    assert [r.rmse for r in again] == pytest.approx([r.rmse for r in told], abs=1e-6)
    assert told[-1].rmse < 2


def test_patience_ends_boosting(spark, halves):
    train, _ = halves
    # Labels that have nothing to do with the features: the error soon rises again.
    other = train.withColumn("duration", F.pmod(F.xxhash64("duration"), F.lit(50)).cast("double"))
    noise = other.withColumn("duration", F.pmod(F.xxhash64("duration", "PU_DO"), F.lit(50)).cast("double"))
    short = model.train_with_validation(other, noise, fresh_folder(spark, "model"), PARAMS, patience=3)
    full = model.train_with_validation(other, noise, fresh_folder(spark, "model"), PARAMS, patience=50)
    told = model.training_errors(short, 3).orderBy("round").collect()
    assert len(told) < 12 == full.rounds.count()
    assert told[-1].out_of_patience and not any(r.out_of_patience for r in told[:-1])
    assert len(told) - 1 - told[-1].best_round == 3
    all_errors = [r.rmse for r in model.training_errors(full).orderBy("round").collect()]
    assert all_errors[:len(told)] == [r.rmse for r in told]


def test_a_broken_run_goes_on_where_it_stopped(spark, halves):
    train, validation = halves
    whole = model.train_with_validation(train, validation, fresh_folder(spark, "model"), PARAMS)
    path = fresh_folder(spark, "model")
    model.prepare_training(train, path, PARAMS, validation, 50)
    assert model.continue_training(spark, path, at_most=5).rounds.count() == 5
    resumed = model.continue_training(spark, path)
    ours, theirs = ([r.asDict() for r in m.rounds.orderBy("round").collect()]
                    for m in (whole, resumed))
    assert ours == theirs
    assert model.continue_training(spark, path).rounds.count() == 12


def test_a_split_is_a_set_of_routes(spark, train):
    fitted = model.train_duration_model(train, fresh_folder(spark, "model"), PARAMS)
    means = {r.PU_DO: (r.route_mean, r.route_bin) for r in fitted.means.collect()}
    in_order = [b for _, b in sorted(means.values())]
    assert in_order == sorted(in_order) and len(set(in_order)) > 1
    middle = sorted(in_order)[2]
    left = {r.PU_DO for r in model.routes_of_split(fitted, middle).collect()}
    assert left == {k for k, (_, b) in means.items() if b <= middle} and 0 < len(left) < len(means)


def test_hand_made_model_with_two_leaves(spark):
    """Distance up to 2 gives 7 minutes, beyond it 11."""
    # A route of one trip has no other trips, so its place tells nothing.
    df = spark.createDataFrame([(str(i), "2", f"{i}_2", miles, minutes) for i, (miles, minutes) in
                                enumerate([(1.0, 7.0)] * 4 + [(3.0, 11.0)] * 4)], TRIP)
    params = model.TrainingParams(rounds=1, depth=1, bins=2, l1=0.0, l2=0.0)
    fitted = model.train_duration_model(df, fresh_folder(spark, "model"), params)
    asked = spark.createDataFrame(
        [("1", "2", 0.5), ("9", "9", 1.0), ("1", "2", 2.9), ("9", "9", 50.0), ("1", "2", None)],
        "PULocationID string, DOLocationID string, trip_distance double")
    got = {(r.PULocationID, r.trip_distance): r.predicted_duration
           for r in model.score_or_default(asked, fitted).collect()}
    assert got == {("1", 0.5): 7.0, ("9", 1.0): 7.0, ("1", 2.9): 11.0, ("9", 50.0): 11.0,
                   ("1", None): 11.0}


def test_values_at_edges_and_missing_ones(spark):
    df = spark.createDataFrame([(v,) for v in (None, float("nan"), 0.0, 1.0, 1.5, 2.0, 9.0)], "x double")
    got = [r.b for r in df.select(model.binned(F.col("x"), [1.0, 2.0], 7).alias("b")).collect()]
    assert got == [7, 7, 0, 0, 1, 1, 2]
    assert df.select(model.binned(F.col("x"), [], 3).alias("b")).agg(F.sum("b")).first()[0] == 6
