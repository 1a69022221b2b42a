import os

from tripmill.session import fresh_folder
from tripmill.sources import fixtures, trips as trip_source


def loader(spark, sf_dir, cache):
    calls = []

    def origin(year, month):
        calls.append((year, month))
        return fixtures.trips(spark, sf_dir, year, month)

    def load():
        return trip_source.load_month_with_backfill(spark, cache, 1998, 3, origin)
    return load, calls


def test_origin_is_read_once(spark, sf_dir):
    load, calls = loader(spark, sf_dir, fresh_folder(spark, "cache"))
    first, second = load(), load()
    assert calls == [(1998, 3)]
    assert first.count() == second.count() == fixtures.trips(spark, sf_dir, 1998, 3).count()


def test_unreadable_cache_is_replaced(spark, sf_dir):
    cache = fresh_folder(spark, "cache")
    folder = f"{cache}/year=1998/month=3"
    os.makedirs(f"{folder}/manifest")
    with open(f"{folder}/manifest/part-0.parquet", "w") as f:
        f.write("this is no parquet file")
    load, calls = loader(spark, sf_dir, cache)
    assert load().count() == fixtures.trips(spark, sf_dir, 1998, 3).count()
    load().count()
    assert calls == [(1998, 3)]


def test_cache_that_cannot_be_written_is_no_error(spark, sf_dir):
    cache = fresh_folder(spark, "cache")
    with open(cache, "w") as f:  # a file where a folder is needed
        f.write("x")
    load, calls = loader(spark, sf_dir, cache)
    assert load().count() == fixtures.trips(spark, sf_dir, 1998, 3).count()
    assert calls == [(1998, 3)]


def test_part_written_month_is_read_from_the_origin(spark, sf_dir):
    cache = fresh_folder(spark, "cache")
    folder = f"{cache}/year=1998/month=3"
    whole = fixtures.trips(spark, sf_dir, 1998, 3)
    whole.limit(10).write.parquet(f"{folder}/data-1")  # written, not published
    load, calls = loader(spark, sf_dir, cache)
    assert load().count() == whole.count()
    assert calls == [(1998, 3)]


def test_month_that_lost_a_file_is_read_again(spark, sf_dir):
    cache = fresh_folder(spark, "cache")
    load, calls = loader(spark, sf_dir, cache)
    n = load().count()
    folder = f"{cache}/year=1998/month=3"
    spark.createDataFrame([("data-x", n)], trip_source.MANIFEST_COLUMNS).coalesce(1).write.mode(
        "overwrite").parquet(f"{folder}/{trip_source.MANIFEST}")
    fixtures.trips(spark, sf_dir, 1998, 3).limit(n - 1).write.parquet(f"{folder}/data-x")
    assert load().count() == n
    assert calls == [(1998, 3)] * 2
