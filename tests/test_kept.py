"""Profiles and trends that are kept by year and merged, against the whole table."""

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from barloom.operators import profile, quality
from barloom.plans import trends
from barloom.sinks import commits


def published(spark, years, seed=1):
    rng = random.Random(seed)
    rows = [(date(y, 1, 1) + timedelta(days=rng.randrange(365)), rng.choice(["A", "B", None]), rng.choice([None, *range(1, 400)]),
             rng.choice([None, rng.randrange(10**6)]), y) for y in years for _ in range(800)]
    return spark.createDataFrame(
        [(d, s, c if c is None else c / 100, v, y) for d, s, c, v, y in rows],
        "date DATE, gics_sector STRING, close_price DOUBLE, volume BIGINT, run_year INT")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_kept_profile_equals_the_whole_one(spark, tmp_path):
    kept, table = str(tmp_path / "kept"), str(tmp_path / "table")
    published(spark, (2011, 2012, 2013)).write.partitionBy("run_year").parquet(table)
    rows = spark.read.parquet(table)
    profile.keep_profile(rows, kept, [2011, 2012, 2013])
    # One year changes and one goes: only that year is read.
    changed = published(spark, (2012,), seed=2)
    changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_year").parquet(table)
    rows = spark.read.parquet(table)
    read = plan(profile.partial_profile(rows.where(F.col("run_year").isin([2012])), "run_year"))
    assert "PartitionFilters: [isnotnull(run_year" in read and "= 2012)" in read
    profile.keep_profile(rows, kept, [2012])
    profile.keep_profile(rows.where("run_year < 2013"), kept, [2013])
    whole = rows.where("run_year < 2013").drop("run_year")
    got = profile.merged_profile(spark, kept, quantiles=(0.1, 0.5, 1.0)).orderBy("position").collect()
    exact = {r.column_name: (r.non_null, r.nulls) for r in quality.null_profile(whole).collect()}
    assert [r.column_name for r in got] == whole.columns and {r.column_name: (r.non_null, r.nulls) for r in got} == exact
    for r in got:
        distinct = whole.select(r.column_name).distinct().dropna().count()
        assert abs(r.distinct - distinct) <= max(2, 0.06 * distinct)
    values = sorted(v.volume for v in whole.select("volume").dropna().collect())
    found = next(r.quantiles for r in got if r.column_name == "volume")
    for asked, value in zip((0.1, 0.5, 1.0), found):
        rank = sum(v <= value for v in values) / len(values)
        assert abs(rank - asked) < 0.03
    assert next(r.quantiles for r in got if r.column_name == "date") is None


def test_columns_without_values(spark, tmp_path):
    kept = str(tmp_path / "kept")
    df = spark.createDataFrame([(None, 2012), (None, 2012)], "volume BIGINT, run_year INT")
    profile.keep_profile(df, kept, [2012])
    assert [tuple(r) for r in profile.merged_profile(spark, kept).collect()] == [(1, "volume", 0, 2, 0, None)]


def test_a_kept_trend_equals_the_whole_one(spark, tmp_path):
    kept = str(tmp_path / "kept")
    rows = published(spark, (2011, 2012, 2013))
    trends.keep_price_trend(rows, kept, (2011, 2012, 2013))
    corrected = rows.where("run_year <> 2012").union(published(spark, (2012,), seed=3).where("gics_sector = 'A'"))
    trends.keep_price_trend(corrected, kept, [2012])
    trends.keep_price_trend(corrected.where("run_year < 2013"), kept, [2013])
    whole = trends.price_trend(corrected.where("run_year < 2013"))
    got = trends.kept_price_trend(spark, kept)
    assert got.exceptAll(whole).count() == 0 and got.count() == whole.count() > 0
    assert commits.scan(spark, kept).count() <= 3 * 12 * 2
