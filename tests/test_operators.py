from datetime import date, datetime

import pytest

from barloom.functions.calendar import month_spine, replay_calendar, replay_year, year_month
from barloom.operators import columns, joins, quality
from barloom.plans import fundamentals, prices
from barloom.plans.fx import fx_monthly
from barloom.plans.fundamentals import fundamental_metrics
from barloom.schemas import FUNDAMENTAL_NAMES, RAW_FUNDAMENTALS, RAW_FX, RAW_PRICES, RAW_SECURITIES
from barloom.sources.files import slice_range, slice_years


def test_rename_strict_and_lenient(spark):
    df = spark.createDataFrame([(1, 2)], "`TICKER symbol` int, extra int")
    assert columns.rename_columns(df, {"Ticker Symbol": "t"}, strict=False).columns == ["t", "extra"]
    with pytest.raises(KeyError):
        columns.rename_columns(df, {"Ticker Symbol": "t"})


def test_project_finds_columns_in_any_case(spark):
    df = spark.createDataFrame([(1, 2)], "`Ticker symbol` int, `a.b` int")
    assert columns.project(df, ["Ticker Symbol", "A.B"]).columns == ["Ticker Symbol", "A.B"]
    with pytest.raises(ValueError):
        columns.project(df, ["nothing"])
    assert columns.drop_columns(df, ["TICKER SYMBOL"]).columns == ["a.b"]


def test_dates_that_cannot_be_read_become_null(spark):
    texts = ["2012-01-03", "2012-01-03 00:00:00", "junk", None]
    df = spark.createDataFrame([(t,) for t in texts], "date string")
    rows = columns.clean_dates(df, "date", rejected="bad").collect()
    assert [(r.date, r.bad) for r in rows] == [
        (date(2012, 1, 3), False), (None, True), (None, True), (None, False)
    ]
    both = columns.clean_dates(df, "date", ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss")).collect()
    assert [r.date for r in both] == [date(2012, 1, 3)] * 2 + [None] * 2
    counted = quality.rejected_count(columns.clean_dates(df, "date", rejected="bad"), "bad").first()
    assert (counted.rows_read, counted.rows_rejected) == (4, 2)


def test_timestamps_become_dates(spark):
    df = spark.createDataFrame([(datetime(2012, 1, 3, 23, 59),)], "date timestamp")
    assert columns.clean_dates(df, "date").first().date == date(2012, 1, 3)


def test_slices_are_half_open(spark):
    days = [date(2011, 12, 31), date(2012, 1, 1), date(2012, 12, 31), date(2013, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "`Period Ending` date")
    assert [r[0] for r in slice_years(df, "Period ending", 2012).collect()] == days[1:3]
    assert slice_years(df, "Period Ending", 2012, 2013).count() == 3
    assert slice_range(df, "Period Ending", end=days[1]).count() == 1


def test_month_spine_has_thirteen_months(spark):
    one = month_spine(spark.createDataFrame([(2012,)], "run_year int")).orderBy("exchange_date").collect()
    assert len(one) == 13
    assert (one[0].request_date, one[-1].request_date) == ("2012-01-01", "2013-01-01")
    assert month_spine(spark.createDataFrame([(2012,), (2013,)], "run_year int")).count() == 25


def test_replay_counts_whole_days(spark):
    start = datetime(2025, 1, 18)
    instants = [start, datetime(2025, 1, 18, 23, 59, 59), datetime(2025, 1, 19), datetime(2025, 1, 17, 23, 59, 59)]
    runs = spark.createDataFrame([(i,) for i in instants], "at timestamp_ntz")
    got = replay_calendar(runs, "at", start).collect()
    assert [r.run_year for r in got] == [replay_year(i, start) for i in instants] == [2012, 2012, 2013, 2011]
    assert got[0].slice_start == date(2012, 1, 1) and got[0].slice_end == date(2013, 1, 1)
    assert got[1].run_date == date(2025, 1, 19)


def test_fx_skips_months_without_payload(spark):
    payloads = spark.createDataFrame(
        [("2012-01-01", '{"data": {"EUR": {"value": 0.9}, "THB": {"code": "THB", "value": 31.5}}}'),
         ("2012-02-01", "not json"), ("2019-01-01", '{"data": {"THB": {"value": 1.0}}}')],
        "request_date string, payload string",
    )
    rates = fx_monthly(payloads, spark.createDataFrame([(2012,)], "run_year int"))
    assert rates.schema.names == RAW_FX.names
    assert [tuple(r) for r in rates.orderBy("exchange_date").collect()] == [
        (date(2012, 1, 1), "USD", 1, "THB", 31.5), (date(2012, 2, 1), "USD", 1, "THB", None)
    ]


def test_duplicates_and_key_report(spark):
    df = spark.createDataFrame(
        [("A", date(2012, 1, 1)), ("A", date(2012, 1, 1)), ("B", None), ("B", None), ("C", date(2012, 1, 1))],
        "symbol string, date date",
    )
    dup = quality.duplicate_keys(df, ["symbol", "date"]).collect()
    assert {(r.symbol, r.copies) for r in dup} == {("A", 2), ("B", 2)}
    report = quality.key_report(df, ["symbol", "date"], "date").first()
    assert (report.rows, report.undated, report.repeated_keys) == (5, 2, 1)


def test_profiles_cover_dates(spark):
    df = spark.createDataFrame([("A", date(2012, 1, 1)), (None, None)], "symbol string, day date")
    assert [tuple(r) for r in quality.null_profile(df).collect()] == [("symbol", 1, 1), ("day", 1, 1)]
    assert sorted(map(tuple, quality.schema_profile(df).collect())) == [
        (1, "symbol", "string", True, 1), (2, "day", "date", True, 1)
    ]
    assert [tuple(r) for r in quality.schema_columns(df).collect()] == [
        (1, "symbol", "string", True), (2, "day", "date", True)
    ]


def test_fundamentals_keep_unmatched_rows(spark):
    rows = spark.createDataFrame(
        [("A", date(2012, 12, 31), 1.0, 2.0, 3.0, None), ("Z", date(2012, 12, 31), 1.0, 2.0, 3.0, 4.0)],
        RAW_FUNDAMENTALS,
    )
    securities = spark.createDataFrame([("A", "Energy", "Drilling")], RAW_SECURITIES)
    got = fundamental_metrics(rows, securities)
    assert got.columns == list(FUNDAMENTAL_NAMES.values())
    assert {(r.ticker_symbol_fund, r.gics_sector) for r in got.collect()} == {("A", "Energy"), ("Z", None)}
    assert fundamentals.with_run_year(got).first().run_year == 2012


def test_duplicate_security_fans_out_after_the_windows(spark):
    days = [(date(2012, 1, d), "A", 1.0 * d, 1.0 * d, 1.0, 1.0, 1) for d in range(1, 11)]
    securities = spark.createDataFrame([("A", "x", "x"), ("A", "y", "y")], RAW_SECURITIES)
    fx = spark.createDataFrame([], RAW_FX)
    got = prices.price_metrics(spark.createDataFrame(days, RAW_PRICES), securities, fx)
    assert got.count() == 20
    assert {r.sma10 for r in got.collect()} == {None, 5.5}


def test_rates_are_one_per_month(spark):
    day = date(2013, 1, 1)
    rows = [(day, "USD", 1, "THB", 31.5)] * 2 + [(day, "USD", 1, "EUR", 0.9), (date(2013, 2, 1), "USD", 1, "THB", None),
            (date(2013, 2, 1), "USD", 1, None, 30.0), (None, "USD", 1, "THB", 9.0), (date(2013, 3, 1), "USD", 1, "THB", None)]
    found = joins.monthly_rates(spark.createDataFrame(rows, RAW_FX)).collect()
    assert sorted(map(tuple, found)) == [(2013, 1, 31.5), (2013, 2, 30.0), (2013, 3, None)]
    bad = spark.createDataFrame([(day, "USD", 1, "THB", 31.5), (date(2013, 1, 2), "USD", 1, "THB", 31.6)], RAW_FX)
    with pytest.raises(Exception, match="differ in 2013-01"):
        joins.monthly_rates(bad).collect()


def test_repeated_dates_stop_where_asked(spark):
    days = [(date(2012, 1, d), "A", 1.0 * d, 1.0 * d, 1.0, 1.0, 1) for d in (1, 2, 2)]
    securities, fx = spark.createDataFrame([], RAW_SECURITIES), spark.createDataFrame([], RAW_FX)
    df = spark.createDataFrame(days, RAW_PRICES)
    with pytest.raises(Exception, match="A 2012-01-02"):
        prices.price_metrics(df, securities, fx, repeats="stop").collect()
    assert prices.price_metrics(df, securities, fx).count() == 3


def test_size_check_measures_text(spark):
    df = spark.createDataFrame([("x" * 1000,)] * 50, "t string")
    assert joins.payload_bytes(df) > 50_000
    assert joins.payload_bytes(df.limit(0)) == 0
    assert not joins.fits_broadcast(df, 10_000)


def test_year_month_keys(spark):
    df = spark.createDataFrame([(date(2012, 2, 29),)], "d date").select(
        *[c.alias(n) for n, c in year_month("d", "p").items()])
    assert tuple(df.first()) == (2012, 2)
