"""Blocked windows against a plain Python walk over each series."""

import random
from datetime import date, timedelta

import pytest

from barloom.functions.rolling import rolling_mean
from barloom.operators.series import in_blocks
from barloom.plans.prices import LOOKBACK, price_metrics
from barloom.schemas import RAW_FX, RAW_PRICES, RAW_SECURITIES

DAY = date(2012, 1, 1)


def blocked_means(df, rows, block_rows, lookback=None):
    keys = ["symbol", "_block"]
    blocks = in_blocks(df, ["symbol"], ["date"], rows - 1 if lookback is None else lookback, block_rows)
    mean = rolling_mean("close", rows, keys, ["_pos"])
    return blocks.withColumn("mean", mean).where("_own")


@pytest.mark.parametrize("block_rows", [1, 3, 7, 10, 1000])
@pytest.mark.parametrize("rows", [2, 10])
def test_unique_dates_match_plain_walk(spark, block_rows, rows):
    rng = random.Random(7)
    data = [(s, DAY + timedelta(days=d), float(rng.randrange(100)))
            for s, n in (("A", 200), ("B", 5), (None, 40)) for d in rng.sample(range(400), n)]
    df = spark.createDataFrame(data, "symbol string, date date, close double")
    got = {(r.symbol, r.date): (r._pos, r.mean) for r in blocked_means(df, rows, block_rows).collect()}
    assert len(got) == len(data)
    for symbol in ("A", "B", None):
        series = sorted((d, c) for s, d, c in data if s == symbol)
        for i, (d, _) in enumerate(series):
            window = [c for _, c in series[i - rows + 1:i + 1]] if i >= rows - 1 else None
            assert got[symbol, d] == (i, sum(window) / rows if window else None)


def test_repeated_dates_and_copies_are_all_kept_in_one_order(spark):
    rng = random.Random(3)
    data = [("HOT", DAY + timedelta(days=rng.randrange(3)), float(rng.randrange(4))) for _ in range(500)]
    data += [("HOT", DAY, 1.0)] * 300 + [("COLD", DAY, 2.0)] * 12
    df = spark.createDataFrame(data, "symbol string, date date, close double")
    found = blocked_means(df, 10, 16).collect()
    assert sorted((r.symbol, r.date, r.close) for r in found) == sorted(data)
    for symbol in ("HOT", "COLD"):
        series = sorted((r for r in found if r.symbol == symbol), key=lambda r: r._pos)
        assert [r._pos for r in series] == list(range(len(series)))
        assert [(r.date, r.close) for r in series] == sorted((r.date, r.close) for r in series)
        for i, row in enumerate(series):
            window = [r.close for r in series[i - 9:i + 1]] if i >= 9 else None
            assert row.mean == (sum(window) / 10 if window else None)


def test_no_block_exceeds_its_bound(spark):
    data = [("HOT", DAY + timedelta(days=i % 5), float(i % 3)) for i in range(4000)]
    df = spark.createDataFrame(data, "symbol string, date date, close double")
    sizes = in_blocks(df, ["symbol"], ["date"], 49, 100).groupBy("symbol", "_block").count()
    assert max(r["count"] for r in sizes.collect()) <= 149


def test_a_large_day_is_numbered_in_cells_that_follow_its_size(spark):
    data = [("HOT", DAY, float(i)) for i in range(5000)]
    df = spark.createDataFrame(data, "symbol string, date date, close double")
    found = in_blocks(df, ["symbol"], ["date"], 0, 50).where("_own").collect()
    assert sorted((r._pos, r.close) for r in found) == [(i, float(i)) for i in range(5000)]


@pytest.mark.parametrize("options", [{}, {"continuous": True}, {"strict": True}])
def test_plain_blocked_and_shuffled_input_agree_on_repeated_dates(spark, options):
    rng = random.Random(11)
    rows = []
    for symbol, count in (("A", 300), ("B", 40), (None, 60)):
        for _ in range(count):
            values = [rng.choice([None, 1.0, 2.0, 3.5]) for _ in range(4)]
            rows.append((DAY + timedelta(days=rng.randrange(700)) if rng.random() < .5 else DAY, symbol, *values, rng.randrange(3)))
    rows += rows[:25]
    securities = spark.createDataFrame([("A", "Energy", "Drilling")], RAW_SECURITIES)
    fx = spark.createDataFrame([(date(2012, 1, 1), "USD", 1, "THB", 31.5)], RAW_FX)
    answers = []
    for block_rows in (None, 7, 60, 100_000):
        rng.shuffle(rows)
        prices = spark.createDataFrame(rows, RAW_PRICES).repartition(5)
        found = price_metrics(prices, securities, fx, block_rows=block_rows, **options)
        answers.append(sorted(map(repr, found.collect())))
    assert all(a == answers[0] for a in answers) and len(answers[0]) == len(rows)


@pytest.mark.parametrize("options, block_rows", [
    ({}, 20), ({}, 170), ({"strict": True}, LOOKBACK + 1), ({"continuous": True}, 100), ({"continuous": True}, 1000),
])
def test_pipeline_is_the_same_in_blocks(spark, options, block_rows):
    rng = random.Random(5)
    rows = []
    for symbol, days in (("A", 260), ("B", 120)):
        for i in range(days):
            c = None if i == 100 else rng.randrange(1000) / 100
            rows.append((DAY + timedelta(days=2 * i), symbol, c, c, c, c, i))
    prices = spark.createDataFrame(rows, RAW_PRICES)
    securities = spark.createDataFrame([("A", "Energy", "Drilling")], RAW_SECURITIES)
    fx = spark.createDataFrame([(date(2012, 3, 1), "USD", 1, "THB", 31.5)], RAW_FX)
    plain = price_metrics(prices, securities, fx, block_rows=None, **options)
    blocked = price_metrics(prices, securities, fx, block_rows=block_rows, **options)
    assert sorted(map(repr, blocked.collect())) == sorted(map(repr, plain.collect()))
