import re
from datetime import date, timedelta

import pytest

from barloom.plans.prices import price_metrics
from barloom.schemas import RAW_FX, RAW_PRICES, RAW_SECURITIES
from barloom.streaming import carried
from barloom.streaming.landing import publish_new_files


def bars(spark, year, days, close=1.0):
    first = date(year, 1, 1)
    return spark.createDataFrame(
        [(first + timedelta(days=d), "A", close, close + d, 1.0, 1.0, d) for d in days], RAW_PRICES)


def test_late_files_recompute_their_years_only(spark, tmp_path):
    securities = spark.createDataFrame([("A", "Energy", "Drilling")], RAW_SECURITIES)
    fx = spark.createDataFrame([(date(2012, 1, 1), "USD", 1, "THB", 31.5)], RAW_FX)
    landing, out = str(tmp_path / "landing"), str(tmp_path / "published")

    def load():
        publish_new_files(
            spark, landing, str(tmp_path / "history"), out, str(tmp_path / "progress"), securities, fx
        ).awaitTermination()

    def check(expected):
        got = spark.read.parquet(out)
        whole = price_metrics(expected, securities, fx)
        assert got.select(whole.columns).exceptAll(whole).count() == 0
        assert got.count() == expected.count()

    early, late = bars(spark, 2012, range(0, 30, 2)), bars(spark, 2012, range(1, 30, 2))
    other = bars(spark, 2013, range(20))
    early.unionByName(other).write.mode("append").parquet(landing)
    load()
    check(early.unionByName(other))
    before = {f for f in (tmp_path / "published" / "run_year=2013").iterdir()}

    late.write.mode("append").parquet(landing)
    load()
    check(early.unionByName(late).unionByName(other))
    assert before == {f for f in (tmp_path / "published" / "run_year=2013").iterdir()}

    load()
    check(early.unionByName(late).unionByName(other))


def test_corrections_replace_and_repeats_stop(spark, tmp_path):
    securities = spark.createDataFrame([("A", "Energy", "Drilling")], RAW_SECURITIES)
    fx = spark.createDataFrame([(date(2012, 1, 1), "USD", 1, "THB", 31.5)], RAW_FX)
    landing, out = str(tmp_path / "landing"), str(tmp_path / "published")

    def load(df, **options):
        df.write.mode("append").parquet(landing)
        publish_new_files(
            spark, landing, str(tmp_path / "history"), out, str(tmp_path / "progress"), securities, fx, **options
        ).awaitTermination()

    first, corrected = bars(spark, 2012, range(20)), bars(spark, 2012, range(20), close=7.0)
    undated = spark.createDataFrame([(None, "A", 1.0, 1.0, 1.0, 1.0, 1)], RAW_PRICES)
    load(first.unionByName(undated))
    load(corrected)
    whole = price_metrics(corrected, securities, fx)
    got = spark.read.parquet(out)
    assert got.count() == 20 and got.select(whole.columns).exceptAll(whole).count() == 0
    with pytest.raises(Exception, match="share"):
        load(first.union(first))


def test_continuous_windows_follow_late_rows(spark, tmp_path):
    securities, fx = spark.createDataFrame([], RAW_SECURITIES), spark.createDataFrame([], RAW_FX)
    landing, out = str(tmp_path / "landing"), str(tmp_path / "published")
    parts = [bars(spark, 2013, range(20)), bars(spark, 2012, range(20))]
    for part in parts:
        part.write.mode("append").parquet(landing)
        publish_new_files(
            spark, landing, str(tmp_path / "history"), out, str(tmp_path / "progress"), securities, fx, continuous=True
        ).awaitTermination()
    whole = price_metrics(parts[0].union(parts[1]), securities, fx, continuous=True)
    got = spark.read.parquet(out)
    assert got.count() == 40 and got.select(whole.columns).exceptAll(whole).count() == 0


def test_continuous_windows_read_the_years_touched_and_their_tails(spark, tmp_path, monkeypatch):
    securities, fx = spark.createDataFrame([], RAW_SECURITIES), spark.createDataFrame([], RAW_FX)
    landing, history, out = (str(tmp_path / n) for n in ("landing", "history", "published"))
    computed = []
    store = carried.Tails.store

    def spied(self, rows, years, batch):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        filters = re.findall(r"PartitionFilters: \[[^]]*?run_year#\d+ (?:IN \(|= )([\d,]+)", plan)
        computed.append((list(years), sorted({int(y) for f in filters for y in f.split(",")})))
        store(self, rows, years, batch)

    monkeypatch.setattr(carried.Tails, "store", spied)

    def load(df):
        computed.clear()
        df.write.mode("append").parquet(landing)
        publish_new_files(
            spark, landing, history, out, str(tmp_path / "progress"), securities, fx, continuous=True).awaitTermination()

    def sparse(days, close=1.0):
        return spark.createDataFrame(
            [(date(y, 1, 1) + timedelta(days=d), "B", close, close + d, 1.0, 1.0, d) for y in range(2010, 2019) for d in days], RAW_PRICES)

    dense = [bars(spark, y, range(0, 240, 3)) for y in (2011, 2012, 2013, 2015, 2016)]
    whole = dense[0]
    for more in dense[1:]:
        whole = whole.union(more)
    load(whole)
    assert computed[-1][0] == [2011, 2012, 2013, 2015, 2016]
    # A late year: the next one with rows has another tail, those after it have not.
    late = bars(spark, 2014, range(0, 240, 3))
    load(late)
    assert [y for y, _ in computed] == [[2014], [2014, 2015]] and all(r == y for y, r in computed)
    # A correction further from the year's end than any window looks back.
    corrected = bars(spark, 2012, range(0, 9, 3), close=5.0)
    load(corrected)
    assert computed == [([2012], [2012])]
    before = corrected.select("symbol", "date")
    whole = whole.join(before, ["symbol", "date"], "left_anti").select(RAW_PRICES.names).union(corrected).union(late)
    # A symbol of few rows a year, whose windows reach over several years.
    load(sparse(range(0, 30, 5)))
    load(sparse([100]).where("year(date) = 2011"))
    assert computed[-1][0] == list(range(2011, 2019))
    whole = whole.union(sparse(range(0, 30, 5))).union(sparse([100]).where("year(date) = 2011"))
    expected = price_metrics(whole, securities, fx, continuous=True)
    got = spark.read.parquet(out).select(expected.columns)
    assert got.exceptAll(expected).count() == 0 and got.count() == expected.count()


def test_a_repeated_batch_starts_from_the_tails_before_it(spark, tmp_path, monkeypatch):
    """A batch that is lost between its tails and its publication, and repeated."""
    securities, fx = spark.createDataFrame([], RAW_SECURITIES), spark.createDataFrame([], RAW_FX)
    landing, out = str(tmp_path / "landing"), str(tmp_path / "published")

    def load(df=None):
        if df is not None:
            df.write.mode("append").parquet(landing)
        publish_new_files(
            spark, landing, str(tmp_path / "history"), out, str(tmp_path / "progress"), securities, fx, continuous=True
        ).awaitTermination()

    first = bars(spark, 2012, range(0, 100, 2)).union(bars(spark, 2013, range(60))).union(bars(spark, 2014, range(9)))
    load(first)
    late = bars(spark, 2012, range(1, 100, 2))

    def lost(*args, **options):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(carried, "idempotent_load", lost)
        with pytest.raises(Exception, match="lost"):
            load(late)
    load()
    expected = price_metrics(first.union(late), securities, fx, continuous=True)
    got = spark.read.parquet(out).select(expected.columns)
    assert got.exceptAll(expected).count() == 0 and got.count() == expected.count()
