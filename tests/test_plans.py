"""What the physical plans must and must not contain."""

import re

import pytest

from tripmill.operators import cleaning, predictions
from tripmill.plans import registry as R
from tripmill.session import fresh_folder
from tripmill.sources import fixtures
from tripmill.streaming import rides as streams

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(R.registered()))
def test_no_python_no_cross_join_no_global_window(spark, sf_dir, name):
    text = plan(R.registered()[name](spark, sf_dir))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct",
                 "BroadcastNestedLoopJoin"):
        assert node not in text
    for window in re.findall(r"windowspecdefinition\((.*?)(?:ASC|DESC)", text):
        assert "," in window  # a partition column stands before the order column


def test_month_range_is_pushed_to_the_scan(spark, sf_dir):
    text = plan(R.pickup_month_filter(spark, sf_dir))
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in text
    assert "LessThan(tpep_pickup_datetime" in text


def test_month_of_the_test_table_is_pushed_too(spark, sf_dir):
    assert "GreaterThanOrEqual(l_shipdate" in plan(fixtures.trips(spark, sf_dir, 1998, 3))


def test_only_needed_columns_are_read(spark, sf_dir):
    schema = re.search(r"ReadSchema: struct<(.*?)>",
                       plan(cleaning.training_columns(R._clean(spark, sf_dir)))).group(1)
    columns = {part.split(":")[0] for part in schema.split(",")}
    assert "l_extendedprice" not in columns and "l_returnflag" not in columns


def test_cleaning_has_no_shuffle(spark, sf_dir):
    assert "Exchange" not in plan(R.clean_trips(spark, sf_dir))


def test_requests_parse_once_and_do_not_shuffle(spark, sf_dir):
    accepted, _ = R.rides.quarantine_split(R._requests(spark, sf_dir))
    text = plan(accepted)
    assert text.count("from_json") == 1 and "Exchange" not in text


def test_a_month_scan_lists_only_its_folder(spark, sf_dir):
    text = plan(R.scan_trips_month(spark, sf_dir))
    assert re.search(r"Location: InMemoryFileIndex\(1 paths\)\[.*?/year=1998/month=3\]", text)


def test_day_lookup_prunes_partitions(spark, sf_dir):
    path = fresh_folder(spark, "entries")
    R.sinks.write_predictions(R._entries(spark, sf_dir), path)
    df = predictions.ride_id_lookup(streams.read_predictions(spark, path), "r", 2024, 1, 15)
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan(df)).group(1)
    assert "year" in filters and "month" in filters and "day" in filters


def test_daily_report_limits_before_the_shuffle(spark, sf_dir):
    assert "WindowGroupLimit" in plan(R.predictions_per_day(spark, sf_dir))


def test_daily_report_scans_once(spark, sf_dir):
    df = R.predictions_per_day(spark, sf_dir)
    df.collect()
    text = plan(df).split("Initial Plan")[0]
    assert text.count("FileScan") == 1 and "ReusedExchange" in text


def test_latest_is_combined_before_the_shuffle(spark, sf_dir):
    assert "partial_max_by" in plan(R.latest_predictions(spark, sf_dir))


def test_small_slices_are_top_k(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(R.recent_events(spark, sf_dir))
    assert "TakeOrderedAndProject" in plan(R.table_preview(spark, sf_dir))


def test_catalog_does_not_read_contents(spark, sf_dir):
    assert "content" not in plan(R.dataset_catalog(spark, sf_dir)).split("ReadSchema")[-1]


def test_no_join_side_is_forced_to_be_broadcast(spark, sf_dir):
    for query in (R.score_or_default, R.batch_score, R.transform_features):
        logical = query(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert "strategy=broadcast" not in logical
