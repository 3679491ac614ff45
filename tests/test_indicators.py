"""Hand-made series for the cases that generated data lacks."""

from datetime import date, timedelta

import pytest

from barloom.plans.prices import add_indicators, price_metrics, with_run_year
from barloom.schemas import RAW_FX, RAW_PRICES, RAW_SECURITIES

FIRST = date(2012, 1, 2)


def bars(closes, symbol="A", first=FIRST):
    return [
        (first + timedelta(days=i), symbol, c, c, c, c, 1) for i, c in enumerate(closes)
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, RAW_PRICES)


def indicators(spark, rows, keys=("symbol", "run_year"), **options):
    found = add_indicators(with_run_year(frame(spark, rows)), list(keys), **options)
    return found.orderBy("symbol", "date").collect()


def floats(values):
    return [None if v is None else float(v) for v in values]


@pytest.mark.parametrize("closes, expected", [
    (range(1, 15), 100.0),
    (range(14, 0, -1), 0.0),
    ([5] * 14, None),
])
def test_strength_of_plain_series(spark, closes, expected):
    rows = indicators(spark, bars(floats(closes)))
    assert [r.rsi for r in rows] == [None] * 13 + [expected]


@pytest.mark.parametrize("rows_needed, name", [(10, "sma10"), (14, "sma14"), (50, "sma50")])
def test_mean_starts_at_a_full_frame(spark, rows_needed, name):
    short = indicators(spark, bars(floats(range(rows_needed - 1))))
    exact = indicators(spark, bars(floats(range(rows_needed))))
    assert all(r[name] is None for r in short)
    assert [r[name] is not None for r in exact] == [False] * (rows_needed - 1) + [True]
    assert exact[-1][name] == sum(range(rows_needed)) / rows_needed


def test_missing_close_blanks_its_frames(spark):
    closes = floats(range(1, 21))
    closes[4] = None
    rows = indicators(spark, bars(closes))
    assert [r.sma10 is not None for r in rows] == [False] * 14 + [True] * 6


def test_windows_restart_each_year(spark):
    rows = bars(floats(range(10)), first=date(2012, 12, 1)) + bars(floats(range(10)), first=date(2013, 1, 1))
    yearly = [r.sma10 is not None for r in indicators(spark, rows)]
    whole = [r.sma10 is not None for r in indicators(spark, rows, keys=["symbol"])]
    assert yearly == ([False] * 9 + [True]) * 2
    assert whole == [False] * 9 + [True] * 11


def test_first_change_counts_as_zero_unless_strict(spark):
    closes = floats([10, 12, 11, 13, 12, 14, 13, 15, 14, 16, 15, 17, 16, 18, 17])
    plain = indicators(spark, bars(closes))
    strict = indicators(spark, bars(closes), strict=True)
    assert plain[13].rsi is not None and strict[13].rsi is None
    assert strict[14].rsi == pytest.approx(100 * 14 / (14 + 7))
    assert plain[14].rsi == pytest.approx(strict[14].rsi)


def test_strict_leaves_unknown_changes_out(spark):
    closes = floats(range(1, 31))
    closes[15] = None
    rows = indicators(spark, bars(closes), strict=True)
    assert [r.rsi is not None for r in rows] == [i == 14 for i in range(30)]


def test_single_row(spark):
    (row,) = indicators(spark, bars([1.0]))
    assert (row.sma10, row.sma50, row.sma14, row.rsi) == (None,) * 4


@pytest.fixture
def lookups(spark):
    securities = spark.createDataFrame([("A", "Energy", "Drilling"), (None, "Ghost", "Ghost")], RAW_SECURITIES)
    fx = spark.createDataFrame([(date(2012, 1, 1), "USD", 1, "THB", 31.5)], RAW_FX)
    return securities, fx


def test_rows_without_match_are_kept(spark, lookups):
    rows = bars([2.0]) + bars([3.0], symbol="B") + bars([4.0], symbol=None) + bars([5.0], first=date(2012, 2, 1))
    found = price_metrics(frame(spark, rows), *lookups).collect()
    got = {(r.symbol, r.date.month): (r.gics_sector, r.close_price_thb) for r in found}
    assert got == {
        ("A", 1): ("Energy", 63.0), ("B", 1): (None, 94.5), (None, 1): (None, 126.0), ("A", 2): ("Energy", None),
    }


def test_published_columns(spark, lookups):
    names = [
        "date", "symbol", "open_price", "close_price", "low_price", "high_price", "volume", "gics_sector",
        "gics_sub_industry", "sma10", "sma50", "rsi", "close_price_thb",
    ]
    prices = frame(spark, bars(floats(range(1, 15))))
    full, literal = price_metrics(prices, *lookups), price_metrics(prices, *lookups, literal=True)
    assert full.columns == [*names, "sma14", "run_year"]
    assert literal.columns == [*names, "run_year"]
    assert max(r.rsi or 0 for r in literal.collect()) == 7.5
    assert max(r.rsi or 0 for r in full.collect()) == 100.0


def test_empty_slice_keeps_the_schema(spark, lookups):
    empty = price_metrics(frame(spark, []), *lookups)
    assert empty.count() == 0
    assert empty.schema == price_metrics(frame(spark, bars([1.0])), *lookups).schema


def test_text_dates_and_odd_case(spark, lookups):
    text = spark.createDataFrame(
        [("2012-01-02", "A", 1.0, 1.0, 1.0, 1.0, 1), ("junk", "A", 2.0, 2.0, 2.0, 2.0, 1)],
        "DATE string, Symbol string, OPEN double, Close double, low double, high double, Volume bigint",
    )
    got = {(r.date, r.close_price) for r in price_metrics(text, *lookups).collect()}
    assert got == {(FIRST, 1.0), (None, 2.0)}
