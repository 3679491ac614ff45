"""The physical plans are the ones meant for large tables."""

import re

import pytest
from pyspark.sql import functions as F

from barloom.catalog import testbed
from barloom.catalog.queries import QUERIES
from barloom.operators import joins
from barloom.plans import prices
from barloom.sources import files
from barloom.sinks import tables

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """Price bars, securities and rates as stored tables."""
    base = str(tmp_path_factory.mktemp("landed"))
    for name, df in (("p", testbed.prices(spark, SMALL)), ("s", testbed.securities(spark, SMALL)),
                     ("x", testbed.fx(spark, SMALL))):
        tables.write_parquet(df, f"{base}/{name}")
    return [files.scan_parquet(spark, f"{base}/{n}") for n in "psx"]


@pytest.mark.parametrize("repeats", ["ordered", "stop", "trusted"])
def test_one_shuffle_and_one_sort_for_all_indicators(landed, repeats):
    text = plan(prices.price_metrics(*landed, repeats=repeats, broadcast=True))
    assert text.count("FileScan") == 3
    assert len(re.findall(r"\bExchange hashpartitioning\(run_year", text)) == 1
    assert len(re.findall(r"[-+:] ?Sort \[", text)) == 1
    assert len(re.findall(r"BroadcastHashJoin", text)) == 2


def test_stored_years_are_rebalanced_without_sampling_the_input(landed):
    text = plan(prices.price_metrics(*landed, by_year=True, repeats="stop", broadcast=True))
    assert "REBALANCE_PARTITIONS_BY_COL" in text and "rangepartitioning" not in text
    assert text.count("FileScan") == 3


def test_large_securities_join_by_a_shuffle_of_their_own(landed, spark):
    expected = prices.price_metrics(*landed, broadcast=True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = prices.price_metrics(*landed)
        text = plan(shuffled)
        # The windows keep the year in their key, and the join's exchanges are Spark's own, so that adaptive
        # execution may split a symbol that holds much of the table.
        assert re.search(r"Exchange hashpartitioning\(run_year#\d+, symbol#\d+, \d+\)", text)
        assert re.search(r"Exchange hashpartitioning\(symbol#\d+, \d+\), ENSURE_REQUIREMENTS", text)
        assert "SortMergeJoin [symbol" in text
        assert shuffled.exceptAll(expected).count() == 0 and shuffled.count() == expected.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_symbol_is_split_in_the_sector_join(spark, tmp_path):
    hot = spark.range(200_000).selectExpr(
        "date_add(date'2000-01-01', cast(id % 9000 as int)) date", "if(id % 10 < 8, 'HOT', concat('S', id % 500)) symbol",
        "1D open", "cast(id as double) close", "1D low", "1D high", "id volume")
    tables.write_parquet(hot, f"{tmp_path}/hot")
    listed = spark.range(500).selectExpr("concat('S', id) `Ticker symbol`", "'a' `GICS Sector`", "'b' `GICS Sub Industry`")
    rates = spark.createDataFrame([], "exchange_date date, exchange_rate double")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        found = prices.price_metrics(spark.read.parquet(f"{tmp_path}/hot"), listed, rates)
        found.collect()
        assert "skew=true" in plan(found)
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_planning_runs_and_writes_nothing(landed, spark, monkeypatch):
    monkeypatch.setattr(joins, "payload_bytes", None)
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    for options in ({}, {"block_rows": 10}, {"by_year": True, "continuous": True}):
        prices.price_metrics(*landed, **options)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before


def test_rates_are_broadcast_and_unique(landed):
    text = plan(joins.attach_rate(landed[0], landed[2]))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning(e_year" in text


def test_unused_indicators_cost_nothing(landed):
    text = plan(prices.price_metrics(*landed, repeats="trusted").select("symbol", "date", "sma10"))
    assert "lag(" not in text and "-49" not in text
    assert re.search(r"ReadSchema: struct<date:date,symbol:string,close:double>", text)


def test_year_filters_reach_the_scan(spark, landed):
    sliced = plan(QUERIES["slice_prices_year"](spark, SMALL))
    assert re.search(r"PushedFilters: \[[^]]*GreaterThanOrEqual\(l_shipdate", sliced)
    after = plan(prices.price_metrics(*landed).where(F.col("run_year") == 1998))
    assert after.index("Window") < after.index("(year(date") < after.index("FileScan")


def test_bars_combine_before_the_shuffle(spark):
    text = plan(testbed.prices(spark, SMALL))
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text and "partial_max" in text


def test_price_trend_reads_no_rates(spark):
    assert "orders.parquet" not in plan(QUERIES["price_trend"](spark, SMALL))


@pytest.mark.parametrize("name", ["price_metrics", "price_metrics_blocked", "fundamental_metrics", "price_trend"])
def test_no_python_in_the_plan(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "Python" not in text and "Pandas" not in text and "CartesianProduct" not in text
    assert "NestedLoop" not in text
