"""Dashboard aggregations over the published tables.

Money is summed as DECIMAL, so the result does not depend on how rows are partitioned.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.sinks import commits


def _exact(name):
    return F.col(name).cast("decimal(28,4)")


def fundamental_trend(published: DataFrame) -> DataFrame:
    """Revenue, gross profit and margin by sector and year."""
    sums = published.groupBy("gics_sector", F.year("period_ending").alias("year")).agg(
        F.sum(_exact("total_revenue")).cast("double").alias("total_revenue"),
        F.sum(_exact("gross_profit")).cast("double").alias("gross_profit"),
    )
    margin = F.col("gross_profit") / F.nullif(F.col("total_revenue"), F.lit(0.0))
    return sums.withColumn("gross_margin", margin)


def price_trend(published: DataFrame) -> DataFrame:
    """Average close and volume by sector and month."""
    def mean(name):
        return F.sum(_exact(name)).cast("double") / F.nullif(F.count(name), F.lit(0))

    return published.groupBy(
        "gics_sector", F.trunc("date", "month").alias("month")
    ).agg(
        mean("close_price").alias("avg_close"),
        mean("volume").alias("avg_volume"),
        F.count("*").alias("bars"),
    )


def price_partials(published: DataFrame) -> DataFrame:
    """Exact sums by sector and month with their year, from which the trend follows: a few rows a month."""
    return published.groupBy("gics_sector", F.trunc("date", "month").alias("month")).agg(
        F.sum(_exact("close_price")).alias("close_sum"), F.count("close_price").alias("close_n"),
        F.sum(_exact("volume")).alias("volume_sum"), F.count("volume").alias("volume_n"), F.count("*").alias("bars"),
    ).withColumn("run_year", F.year("month"))


def keep_price_trend(published: DataFrame, kept, years):
    """Bring the stored sums up to date after the ``years`` of the published table have changed; only those are read."""
    years = sorted(set(years))
    rows = price_partials(published.where(F.col("run_year").isin(years)))
    spark = published.sparkSession
    commits.commit(spark, commits.stage(rows, kept), commits.REPLACE, years)


def kept_price_trend(spark: SparkSession, kept) -> DataFrame:
    """``price_trend`` of all years from the stored sums; the published table is not read."""
    def mean(name):
        return F.col(f"{name}_sum").cast("double") / F.nullif(F.col(f"{name}_n"), F.lit(0))

    return commits.scan(spark, kept).select(
        "gics_sector", "month", mean("close").alias("avg_close"), mean("volume").alias("avg_volume"), "bars")
