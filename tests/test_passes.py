"""How often rows are computed, landed and dealt out."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barloom.catalog import queries, testbed
from barloom.operators.series import in_blocks
from barloom.plans import prices
from barloom.schemas import RAW_FX, RAW_PRICES, RAW_SECURITIES
from barloom.sinks import ledger, tables
from barloom.streaming import carried


def bars(spark, years=(2012,), days=5):
    rows = [(date(y, 1, 1) + timedelta(days=d), "A", 1.0, 1.0 + d, 1.0, 1.0, d) for y in years for d in range(days)]
    return spark.createDataFrame(rows, RAW_PRICES)


@pytest.fixture
def lookups(spark):
    securities = spark.createDataFrame([("A", "Energy", "Drilling")], RAW_SECURITIES)
    return securities, spark.createDataFrame([(date(2012, 1, 1), "USD", 1, "THB", 31.5)], RAW_FX)


def test_bars_of_keys_and_values_of_any_size(spark, monkeypatch):
    lines = [
        (7, 1, 10.0, 1.0), (7, 1, 9.0, 1.0), (8, 1, 20.0, 2.0), (8, 1, 21.0, 2.0),
        (3, 2, 30.0, 1.0), (1 << 40, 2, 40.0, 1.0), ((1 << 40) + 1, 3, 50.0, 1.0), ((1 << 40) + 2, 3, 60.0, 1.0),
        (5, 4, 9e6, 1.0), (6, 4, 1.0, 1.0), (None, 4, 2.0, 1.0), (4, 5, None, 1.0),
    ]
    schema = "l_orderkey BIGINT, l_suppkey BIGINT, l_extendedprice DOUBLE, l_quantity DOUBLE, l_shipdate TIMESTAMP"
    table = spark.createDataFrame([(*line, datetime(1998, 3, 4)) for line in lines], schema)
    monkeypatch.setattr(testbed, "table", lambda *_: table)
    found = {r.symbol: (r.open, r.close, r.low, r.high) for r in testbed.prices(spark, "").collect()}
    assert found == {
        "1": (9.0, 21.0, 9.0, 21.0), "2": (30.0, 40.0, 30.0, 40.0), "3": (50.0, 60.0, 50.0, 60.0),
        "4": (9e6, 1.0, 1.0, 9e6), "5": (None, None, None, None)}


@pytest.mark.parametrize("name", ["incremental_corrections", "incremental_continuous_corrections"])
def test_bars_that_land_several_times_are_computed_once(spark, monkeypatch, name):
    kept = []
    monkeypatch.setattr(queries.testbed, "prices", lambda *_: bars(spark))
    monkeypatch.setattr(queries, "stored", lambda df: kept.append(df) or df)
    monkeypatch.setattr(queries, "_loaded", lambda *_, **options: None)
    queries.QUERIES[name](spark, "")
    assert len(kept) == 1


def test_tails_that_lead_on_are_not_computed_again(spark, tmp_path, monkeypatch):
    written = []
    monkeypatch.setattr(carried, "rebalanced", lambda df, by: written.append(df) or df)
    rows = bars(spark, (2012, 2013), 60).withColumn("run_year", F.year("date"))
    tails = carried.Tails(spark, str(tmp_path / "tails"))
    tails.store(rows.where("run_year = 2012"), [2012], 0)
    tails.store(rows, [2012, 2013], 0)
    assert [sorted({r.tail_year for r in df.select("tail_year").collect()}) for df in written] == [[2013], [2014]]
    last = {(r.date) for r in tails.before(2014, 0).collect()}
    assert last == {date(2013, 1, 1) + timedelta(days=d) for d in range(60 - carried.LOOKBACK, 60)}


def test_bars_that_several_runs_read_land_once(spark, lookups, tmp_path, monkeypatch):
    landed, write = [], tables.write_csv
    monkeypatch.setattr(queries, "lookups", lambda *_: lookups)
    monkeypatch.setattr(queries, "work_folder", lambda *_: str(tmp_path / "work"))
    monkeypatch.setattr(tables, "write_csv", lambda df, path: landed.append(path) or write(df, path))
    rows, asked = bars(spark), ["--first-year", "2012", "--mode", "append", "--run-id", "one"]
    assert queries._published_by_job(spark, "", (rows, asked), (rows, asked)).count() == 5
    assert len(landed) == 3


def test_a_run_in_the_ledger_is_not_computed_again(spark, tmp_path):
    rows = spark.range(3)
    ledger.append_once(rows, str(tmp_path / "t"), "one")
    ledger.append_once(rows.select(F.raise_error(F.lit("computed")).cast("bigint").alias("id")), str(tmp_path / "t"), "one")
    assert ledger.scan_ledger(spark, str(tmp_path / "t")).count() == 3


def test_blocks_read_and_deal_the_rows_less_often(spark):
    text = in_blocks(bars(spark), ["symbol"], ["date"], 9, 5)._jdf.queryExecution().executedPlan().toString()
    # Before branches are joined to one: two for the rows, and each once more for its cuts.
    assert text.count("Scan ExistingRDD") <= 4 and text.count("Exchange hashpartitioning") <= 13


def test_lookups_are_attached_after_the_exchange_by_year(spark, lookups):
    text = prices.price_metrics(bars(spark), *lookups, by_year=True, broadcast=True)._jdf.queryExecution().executedPlan().toString()
    assert text.rindex("BroadcastHashJoin") < text.index("REBALANCE_PARTITIONS_BY_COL")
