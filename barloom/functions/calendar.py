"""Calendar keys, the monthly request spine and the replay calendar."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.schemas import DATE_FORMAT, REPLAY_BASE_YEAR, REPORTING_ZONE


def year_month(column, prefix) -> dict[str, Column]:
    """INT year and month of a date column, as ``{prefix}_year`` and ``{prefix}_month``."""
    return {
        f"{prefix}_year": F.year(column),
        f"{prefix}_month": F.month(column),
    }


def month_spine(years: DataFrame, year="run_year") -> DataFrame:
    """Month starts from 1 January of each year to 1 January of the next, both included.

    One year gives 13 dates; a January shared by two neighbouring years appears once.
    """
    first = F.make_date(F.col(year), F.lit(1), F.lit(1))
    months = F.sequence(first, F.add_months(first, 12), F.expr("INTERVAL 1 MONTH"))
    return (
        years.select(F.explode(months).alias("exchange_date"))
        .distinct()
        .withColumn("request_date", F.date_format("exchange_date", DATE_FORMAT))
    )


def elapsed_days(start: Column, instant: Column) -> Column:
    """Whole 24-hour days from start to instant, rounded down (-1 for one second before)."""
    span = instant - start
    whole = F.extract(F.lit("DAY"), span)
    return whole - F.when(span < F.make_dt_interval(whole), 1).otherwise(0)


def replay_calendar(runs: DataFrame, run_at, start_at: datetime, base_year=REPLAY_BASE_YEAR,
                    zone=REPORTING_ZONE) -> DataFrame:
    """Add the data year that each run loads: ``base_year`` plus whole days since the start.

    The column ``run_at`` and the instant ``start_at`` are zone-less and in UTC. Adds ``run_date``
    (local date), ``run_count``, ``run_year`` and the half-open bounds ``slice_start`` and
    ``slice_end``.
    """
    # Through text, as a datetime literal would be shifted by the session's time zone.
    start = F.lit(start_at.isoformat(sep=" ")).cast("timestamp_ntz")
    return (
        runs.withColumns({
            "run_date": F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col(run_at)).cast("date"),
            "run_count": elapsed_days(start, F.col(run_at)).cast("int"),
        })
        .withColumn("run_year", F.lit(base_year) + F.col("run_count"))
        .withColumns({
            "slice_start": F.make_date("run_year", F.lit(1), F.lit(1)),
            "slice_end": F.make_date(F.col("run_year") + 1, F.lit(1), F.lit(1)),
        })
    )


def replay_year(run_at: datetime, start_at: datetime, base_year=REPLAY_BASE_YEAR) -> int:
    """The same rule for one run, as a job parameter."""
    return base_year + (run_at - start_at).days
