"""Monthly exchange rates from raw API payloads."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.calendar import month_spine
from barloom.schemas import BASE_CURRENCY, BASE_UNITS, FX_PAYLOAD, TARGET_CURRENCY


def extract_rate(payloads: DataFrame, payload="payload") -> DataFrame:
    """Replace the JSON payload by ``exchange_rate``; unreadable payloads give NULL."""
    body = F.from_json(F.col(payload), FX_PAYLOAD)
    return payloads.withColumn("exchange_rate", body["data"][TARGET_CURRENCY]["value"]).drop(payload)


def fx_monthly(payloads: DataFrame, years: DataFrame) -> DataFrame:
    """One rate row per month start of the years for which a payload was received.

    ``payloads`` has ``request_date`` (text, yyyy-MM-dd) and ``payload`` (JSON text).
    """
    rates = extract_rate(payloads)
    return month_spine(years).join(rates, "request_date").select(
        "exchange_date",
        F.lit(BASE_CURRENCY).alias("curency_base"),
        F.lit(BASE_UNITS).alias("usd_value"),
        F.lit(TARGET_CURRENCY).alias("curency_target"),
        "exchange_rate",
    )
