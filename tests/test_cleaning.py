from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripmill import schemas
from tripmill.operators import cleaning
from tripmill.plans import flows
from tripmill.session import fresh_folder
from tripmill.sources import fixtures, trips as trip_source

NOON = datetime(2024, 1, 31, 12, 0, 0)


def rows(spark, *minutes_and_zone):
    data = [
        (str(i), NOON, None if m is None else datetime.fromtimestamp(
            NOON.timestamp() + m * 60), zone, 7, 1, 1.0, 1.0, 1)
        for i, (m, zone) in enumerate(minutes_and_zone)
    ]
    return spark.createDataFrame(data, schemas.RAW_TRIP)


def test_bounds_are_inclusive_and_null_fails(spark):
    df = rows(spark, (1, 1), (60, 1), (0.999999, 1), (60.000001, 1), (-5, 1), (None, 1))
    kept = [r.trip_id for r in cleaning.clean_trips(df).orderBy("trip_id").collect()]
    assert kept == ["0", "1"]


def test_duration_keeps_the_sub_second_part(spark):
    minutes = cleaning.trip_duration(rows(spark, (1.00005, 1))).first().duration
    assert minutes == pytest.approx(1.00005, abs=1e-9) and minutes != 1.0


def test_supplied_duration_is_kept(spark):
    df = rows(spark, (5, 1), (6, 1)).withColumn(
        "duration", F.when(F.col("trip_id") == "0", F.lit(99.0)))
    got = cleaning.trip_duration_if_absent(df).orderBy("trip_id").collect()
    assert [r.duration for r in got] == [99.0, 6.0]


def test_zone_of_float_column_has_no_fraction(spark):
    df = rows(spark, (5, 161)).withColumn("PULocationID", F.col("PULocationID").cast("double"))
    assert cleaning.clean_trips(df).first().PU_DO == "161_7"


def test_null_zone_gives_null_route(spark):
    assert cleaning.clean_trips(rows(spark, (5, None))).first().PU_DO is None


def test_cleaning_is_idempotent(spark, sf_dir):
    once = cleaning.clean_trips(fixtures.trips(spark, sf_dir))
    twice = cleaning.clean_trips(once)
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()
    assert once.schema == twice.schema


def test_month_filter_is_half_open(spark):
    df = spark.createDataFrame(
        [(datetime(2023, 11, 30, 23, 59, 59, 999999),), (datetime(2023, 12, 1),),
         (datetime(2023, 12, 31, 23, 59, 59, 999999),), (datetime(2024, 1, 1),)],
        "tpep_pickup_datetime timestamp_ntz")
    kept = cleaning.pickup_month_filter(df, 2023, 12).collect()
    assert sorted(r[0].day for r in kept) == [1, 31]


def test_prepared_month_has_no_strays(spark, sf_dir):
    root = fresh_folder(spark, "clean")
    trips = fixtures.trips(spark, sf_dir)
    flows.prepare_month(trips, root, 1998, 3)
    stored = trip_source.scan_trips_month(spark, root, 1998, 3, schemas.CLEAN_MONTHS)
    expected = cleaning.clean_trips(trips).where("date_trunc('month', tpep_pickup_datetime) = "
                                                 "timestamp_ntz'1998-03-01 00:00:00'")
    assert stored.drop("year", "month").exceptAll(expected).isEmpty()
    assert stored.count() == expected.count() > 0


def test_writing_a_month_again_replaces_only_that_month(spark, sf_dir):
    from tripmill.sinks.tables import write_trips_month
    root = fresh_folder(spark, "months")
    trips = fixtures.trips(spark, sf_dir)
    write_trips_month(trips, root)
    march = fixtures.trips(spark, sf_dir, 1998, 3)
    write_trips_month(march.limit(3), root)
    assert trip_source.scan_trips_month(spark, root, 1998, 3).count() == 3
    total = spark.read.schema(schemas.TRIP_MONTHS).parquet(root).count()
    assert total == trips.count() - march.count() + 3


def test_month_without_files_is_an_error(spark, sf_dir):
    from pyspark.errors import AnalysisException
    root = fresh_folder(spark, "months")
    from tripmill.sinks.tables import write_trips_month
    write_trips_month(fixtures.trips(spark, sf_dir, 1998, 3), root)
    with pytest.raises(AnalysisException):
        trip_source.scan_trips_month(spark, root, 1990, 1)


def test_funnel_counts_strays(spark):
    df = rows(spark, (5, 1), (0.5, 1)).withColumn("file_month", F.lit(2))
    got = cleaning.cleaning_funnel(df, F.lit(2024), F.col("file_month")).first()
    assert (got.raw_rows, got.after_duration, got.after_month) == (2, 1, 0)
