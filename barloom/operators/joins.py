"""Left joins that add sector and exchange rate to every row of the big side."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.calendar import year_month
from barloom.operators.columns import column
from barloom.schemas import SECTOR, TARGET_CURRENCY, TICKER

BROADCAST_BYTES = 64 << 20


def payload_bytes(df: DataFrame) -> int:
    """Size of all values, measured by one aggregation over the frame."""
    def width(field):
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(column(df, field.name)), F.lit(0)) + 16
        return F.lit(16)

    per_row = F.lit(16)
    for field in df.schema.fields:
        per_row = per_row + width(field)
    return df.agg(F.sum(per_row.cast("bigint"))).first()[0] or 0


def fits_broadcast(df: DataFrame, limit=BROADCAST_BYTES) -> bool:
    """Whether a lookup table is small enough to broadcast: one pass over it, now."""
    return payload_bytes(df) <= limit


def sectors(securities: DataFrame) -> DataFrame:
    """The columns of the securities that the sector join needs."""
    return securities.select(
        column(securities, TICKER).alias("_ticker"),
        *[column(securities, c).alias(c) for c in SECTOR],
    )


def attach_sector(df: DataFrame, securities: DataFrame, key: str, broadcast=False) -> DataFrame:
    """Add sector columns by ticker. Every row stays; unknown and NULL tickers get NULL.

    ``broadcast`` is for callers that have measured the securities. Without it Spark decides from
    its statistics, and adaptive execution splits skewed partitions of a shuffled join.
    """
    lookup = F.broadcast(sectors(securities)) if broadcast else sectors(securities)
    return df.join(lookup, column(df, key) == F.col("_ticker"), "left").drop("_ticker")


def monthly_rates(fx: DataFrame, date="exchange_date", rate="exchange_rate", target="curency_target") -> DataFrame:
    """One rate of the target currency per month: ``(e_year, e_month, exchange_rate)``.

    Rates of other currencies are left out where the table names a target. A month quoted
    several times at one rate, as by neighbouring years landed apart, counts once; differing rates stop
    the job with the month named. At most twelve rows a year, so it may always be broadcast.
    """
    if target.lower() in [c.lower() for c in fx.columns]:
        named = column(fx, target)
        fx = fx.where(named.isNull() | (named == TARGET_CURRENCY))
    months = {n: c for n, c in year_month(column(fx, date), "e").items()}
    quoted = fx.select(*[c.alias(n) for n, c in months.items()], column(fx, rate).alias("rate")).where("e_year IS NOT NULL")
    spread = quoted.groupBy("e_year", "e_month").agg(F.min("rate").alias("low"), F.max("rate").alias("high"))
    named = F.format_string("exchange rates differ in %04d-%02d", "e_year", "e_month")
    return spread.select(
        "e_year", "e_month", F.when(F.col("low") == F.col("high"), F.col("low"))
        .when(F.col("low").isNotNull(), F.raise_error(named)).alias("exchange_rate"))


def quoted_rates(fx: DataFrame, date="exchange_date", rate="exchange_rate", target="curency_target") -> DataFrame:
    """``(rate_date, exchange_rate)``: the target currency's rate of each day it is quoted for; differing ones stop the job."""
    if target.lower() in [c.lower() for c in fx.columns]:
        named = column(fx, target)
        fx = fx.where(named.isNull() | (named == TARGET_CURRENCY))
    quoted = fx.select(column(fx, date).cast("date").alias("rate_date"), column(fx, rate).alias("rate")).dropna()
    spread = quoted.groupBy("rate_date").agg(F.min("rate").alias("low"), F.max("rate").alias("high"))
    message = F.format_string("exchange rates differ on %s", F.col("rate_date").cast("string"))
    return spread.select("rate_date", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.raise_error(message)).alias("exchange_rate"))


def attach_rate_asof(df: DataFrame, fx: DataFrame, date="date", max_days=None) -> DataFrame:
    """Add the rate last quoted up to the row's date, else NULL; ``max_days`` limits its age. Every row stays one row.

    The days of both sides are united and one window carries the last rate over them. Days are few, at most 366 a
    year however many rows there are, so that table is ordered by one task and broadcast.
    """
    own = column(df, date).cast("date")
    asked = df.select(own.alias("_day")).distinct().where("_day IS NOT NULL")
    rates = quoted_rates(fx).select(F.col("rate_date").alias("_day"), "exchange_rate", F.col("rate_date").alias("rate_date"))
    both = asked.join(rates, "_day", "full")
    upto = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = both.select("_day", F.struct(
        F.last("rate_date", ignorenulls=True).over(upto).alias("day"), F.last("exchange_rate", ignorenulls=True).over(upto).alias("rate")).alias("_last"))
    fresh = F.lit(True) if max_days is None else F.date_diff("_day", F.col("_last.day")) <= max_days
    carried = last.select("_day", F.when(fresh, F.col("_last.rate")).alias("exchange_rate"))
    return df.join(F.broadcast(carried), own == F.col("_day"), "left").drop("_day")


def attach_rate(df: DataFrame, fx: DataFrame, date="date") -> DataFrame:
    """Add the rate quoted for the row's month, else NULL. Every row stays, and stays one row."""
    rates = F.broadcast(monthly_rates(fx))
    keyed = df.withColumns(year_month(date, "p"))
    same_month = (keyed.p_year == rates.e_year) & (keyed.p_month == rates.e_month)
    return keyed.join(rates, same_month, "left").drop("e_year", "e_month")
