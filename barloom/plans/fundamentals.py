"""Yearly company fundamentals with sector."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators.columns import clean_dates, project, rename_columns
from barloom.operators.joins import attach_sector
from barloom.schemas import FUNDAMENTAL_NAMES, RAW_FUNDAMENTALS


def fundamental_metrics(fundamentals: DataFrame, securities: DataFrame, broadcast=False) -> DataFrame:
    """The published fundamentals table, every input row kept."""
    cleaned = clean_dates(project(fundamentals, RAW_FUNDAMENTALS.names), "Period Ending")
    sectored = attach_sector(cleaned, securities, "Ticker Symbol", broadcast)
    return rename_columns(sectored, FUNDAMENTAL_NAMES, strict=False)


def with_run_year(published: DataFrame) -> DataFrame:
    """Add the partition column under which the table is stored."""
    return published.withColumn("run_year", F.year("period_ending"))
