import hashlib

import pytest
from pyspark.sql import functions as F

from tripmill.operators import sampling
from tripmill.sources import fixtures


def digest(key):
    return hashlib.md5(f"{key}-42".encode()).hexdigest()


@pytest.fixture(scope="module")
def keys(spark):
    return spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"), "id")


ORDER = sorted((f"k{i}" for i in range(3000)), key=digest)


@pytest.mark.parametrize("start, stop", [
    (0, 0), (0, 1), (0, 3000), (17, 18), (5, 2990), (1234, 1700), (2999, 3000), (2990, 4000),
    (3000, 3001), (9000, 9001),
])
@pytest.mark.parametrize("few", [1, 10_000])
def test_slice_is_the_slice_of_the_sorted_keys(spark, keys, monkeypatch, start, stop, few):
    monkeypatch.setattr(sampling, "FEW", few)
    got = sampling.rank_slice(keys, "key", start, stop).collect()
    assert sorted(r.key for r in got) == sorted(ORDER[start:stop])


def test_one_prefix_may_hold_the_whole_slice(spark, monkeypatch, keys):
    monkeypatch.setattr(sampling, "PREFIX_CHARACTERS", 1)
    got = sampling.rank_slice(keys, "key", 3, 40).collect()
    assert sorted(r.key for r in got) == sorted(ORDER[3:40])


def test_a_slice_is_one_filtered_scan_at_any_size(spark, sf_dir):
    trips = fixtures.trips(spark, sf_dir)
    for stop in (10, 2000, 5000):
        text = sampling.rank_slice(trips, "trip_id", 0, stop)._jdf.queryExecution().executedPlan()
        assert text.toString().count("FileScan") == 1 and "Sort" not in text.toString()


@pytest.mark.parametrize("n, size", [(None, 3000), (0, 3000), (10, 10), (3000, 3000), (4000, 3000)])
def test_sample_size_is_exact(spark, keys, n, size):
    assert sampling.seeded_sample(keys, "key", n).count() == size


def test_another_seed_gives_another_sample(spark, keys):
    first = {r.key for r in sampling.seeded_sample(keys, "key", 50).collect()}
    other = {r.key for r in sampling.seeded_sample(keys, "key", 50, seed=7).collect()}
    assert first != other


def test_index_beyond_the_table_is_an_error(spark, keys):
    assert sampling.record_at_index(keys, "key", 2999).first().key == ORDER[2999]
    with pytest.raises(IndexError):
        sampling.record_at_index(keys, "key", 3000)


def test_replay_order_and_limit(spark, sf_dir):
    trips = fixtures.trips(spark, sf_dir)
    all_rides = [r.ride_id for r in sampling.shuffled_replay(trips, "trip_id").collect()]
    ids = [r.trip_id for r in trips.select("trip_id").collect()]
    assert all_rides == ["ride_" + k for k in sorted(ids, key=digest)]
    some = [r.ride_id for r in sampling.shuffled_replay(trips, "trip_id", 20).collect()]
    assert some == all_rides[:20]


@pytest.fixture(scope="module")
def ranked(spark, keys):
    from tripmill.session import fresh_folder
    return sampling.store_ranked(keys, "key", fresh_folder(spark, "ranked"), parts=5)


@pytest.mark.parametrize("start, stop", [
    (0, 0), (0, 1), (0, 3000), (17, 18), (5, 2990), (1234, 1700), (2999, 3000), (2990, 4000), (3000, 3001)])
def test_stored_slice_is_the_same_slice(spark, ranked, start, stop):
    got = sampling.stored_slice(spark, ranked, start, stop)
    assert got.columns == ["key", "id"]
    assert sorted(r.key for r in got.collect()) == sorted(ORDER[start:stop])


def test_stored_slice_inside_one_prefix(spark, keys, monkeypatch):
    from tripmill.session import fresh_folder
    monkeypatch.setattr(sampling, "PREFIX_CHARACTERS", 1)
    table = sampling.store_ranked(keys, "key", fresh_folder(spark, "ranked"))
    got = sampling.stored_slice(spark, table, 3, 40).collect()
    assert sorted(r.key for r in got) == sorted(ORDER[3:40])


def test_stored_slice_is_one_scan_with_the_hashes_pushed_down(spark, ranked):
    plan = sampling.stored_slice(spark, ranked, 1200, 1300)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Window" not in plan
    assert "GreaterThanOrEqual(_hash" in plan and "LessThanOrEqual(_hash" in plan
    files = {r.f for r in sampling.stored_slice(spark, ranked, 1200, 1300).select(
        F.input_file_name().alias("f")).distinct().collect()}
    assert len(files) <= 2


def test_stored_record_and_its_bounds(spark, ranked):
    assert sampling.stored_record(spark, ranked, 1234).first().key == ORDER[1234]
    for index in (-1, 3000):
        with pytest.raises(IndexError):
            sampling.stored_record(spark, ranked, index)
    with pytest.raises(ValueError):
        sampling.stored_slice(spark, ranked, 5, 4)


def test_stored_empty_table_and_a_clashing_column(spark, keys):
    from tripmill.session import fresh_folder
    table = sampling.store_ranked(keys.limit(0), "key", fresh_folder(spark, "ranked"))
    assert sampling.stored_slice(spark, table, 0, 10).count() == 0
    with pytest.raises(ValueError):
        sampling.store_ranked(keys.withColumn("_hash", F.lit(1)), "key", fresh_folder(spark, "ranked"))


def test_directory_counts_every_row(spark, ranked):
    counts = ranked.counts(spark)
    assert sum(n for _, n in counts) == 3000 and [p for p, _ in counts] == sorted(p for p, _ in counts)


def test_stored_order_has_more_files_for_more_rows(spark, keys, monkeypatch):
    from tripmill.session import fresh_folder
    monkeypatch.setattr(sampling, "PART_ROWS", 100)
    table = sampling.store_ranked(keys, "key", fresh_folder(spark, "ranked"))
    files = table.rows(spark).groupBy(F.input_file_name().alias("f")).agg(
        F.count(F.lit(1)).alias("n"), F.min("_hash").alias("low"), F.max("_hash").alias("high"),
    ).orderBy("low").collect()
    assert len(files) == 30 and sum(r.n for r in files) == 3000 and max(r.n for r in files) < 200
    assert all(a.high < b.low for a, b in zip(files, files[1:]))
    got = sampling.stored_slice(spark, table, 1234, 1700).collect()
    assert sorted(r.key for r in got) == sorted(ORDER[1234:1700])
