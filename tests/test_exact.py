"""Means from exact running sums, and rates as of a day."""

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from barloom.operators import joins
from barloom.plans.prices import add_exact_indicators, price_metrics
from barloom.schemas import RAW_FX, RAW_PRICES, RAW_SECURITIES


def test_exact_means_do_not_depend_on_earlier_rows(spark):
    rng = random.Random(5)
    data = [(date(2012, 1, 1) + timedelta(days=i), s, None if rng.random() < 0.05 else rng.randrange(1, 10**8) / 100)
            for s, n in (("A", 300), ("B", 9), ("C", 60)) for i in range(n)]
    bars = spark.createDataFrame(
        [(d, s, 1.0, c, 1.0, 1.0, 1) for d, s, c in data], "date DATE, symbol STRING, open DOUBLE, close DOUBLE, low DOUBLE, high DOUBLE, volume BIGINT")
    found = {(r.symbol, r.date): r for r in add_exact_indicators(bars, ["symbol"]).collect()}
    for symbol in "ABC":
        series = sorted((d, c) for d, s, c in data if s == symbol)
        closes = [None if c is None else Decimal(str(c)) for _, c in series]
        changes = [None if i == 0 or None in (closes[i], closes[i - 1]) else closes[i] - closes[i - 1] for i in range(len(closes))]
        gains = [max(c, Decimal(0)) if c is not None else Decimal(0) for c in changes]
        losses = [max(-c, Decimal(0)) if c is not None else Decimal(0) for c in changes]
        for i, (day, _) in enumerate(series):
            row = found[symbol, day]
            for name, n in (("sma10", 10), ("sma50", 50), ("sma14", 14)):
                frame = [c for c in closes[max(0, i - n + 1):i + 1] if c is not None]
                assert getattr(row, name) == (float(sum(frame)) / n if len(frame) == n else None)
            frame = [c for c in closes[max(0, i - 13):i + 1] if c is not None]
            up, down = (float(sum(v[max(0, i - 13):i + 1])) / min(14, i + 1) for v in (gains, losses))
            assert row.rsi == (100 * up / (up + down) if len(frame) == 14 and up + down else None)


def test_exact_means_take_one_exchange_and_one_sort(spark):
    bars = spark.createDataFrame([], RAW_PRICES)
    plan = add_exact_indicators(bars, ["symbol"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1
    with pytest.raises(ValueError, match="whole series"):
        price_metrics(bars, spark.createDataFrame([], RAW_SECURITIES), spark.createDataFrame([], RAW_FX), exact=True, strict=True)


def test_asof_rates(spark):
    fx = spark.createDataFrame(
        [(date(2012, 1, 1), "USD", 1, "THB", 31.0), (date(2012, 1, 1), "USD", 1, "THB", 31.0), (date(2012, 4, 1), "USD", 1, "THB", 32.0),
         (date(2012, 2, 1), "USD", 1, "EUR", 0.9), (date(2012, 5, 1), "USD", 1, "THB", None), (None, "USD", 1, "THB", 9.0)], RAW_FX)
    days = [date(2011, 12, 31), date(2012, 1, 1), date(2012, 3, 31), date(2012, 4, 1), date(2012, 6, 1), None]
    df = spark.createDataFrame([(d, n, "x") for d in days for n in (1, 2)], "date DATE, n INT, rate_date STRING")
    found = joins.attach_rate_asof(df, fx)
    assert found.columns == ["date", "n", "rate_date", "exchange_rate"] and found.count() == 12
    assert {r.date: r.exchange_rate for r in found.collect()} == dict(zip(days, [None, 31.0, 31.0, 32.0, 32.0, None]))
    fresh = joins.attach_rate_asof(df, fx, max_days=60).collect()
    assert {r.date: r.exchange_rate for r in fresh} == dict(zip(days, [None, 31.0, None, 32.0, None, None]))
    timed = df.withColumn("date", F.col("date").cast("timestamp_ntz"))
    assert joins.attach_rate_asof(timed, fx).where("exchange_rate IS NOT NULL").count() == 8
    wrong = fx.union(spark.createDataFrame([(date(2012, 4, 1), "USD", 1, "THB", 33.0)], RAW_FX))
    with pytest.raises(Exception, match="differ on 2012-04-01"):
        joins.attach_rate_asof(df, wrong).collect()
    assert joins.attach_rate_asof(df, spark.createDataFrame([], RAW_FX)).where("exchange_rate IS NULL").count() == 12
