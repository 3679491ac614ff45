"""Column contracts: what raw tables carry and what published tables are called."""

from pyspark.sql import types as T

# --- Fixed values: column names, spelling and types of the raw and published tables. ---

RAW_PRICES = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("volume", T.LongType()),
])

RAW_SECURITIES = T.StructType([
    T.StructField("Ticker symbol", T.StringType()),
    T.StructField("GICS Sector", T.StringType()),
    T.StructField("GICS Sub Industry", T.StringType()),
])

RAW_FX = T.StructType([
    T.StructField("exchange_date", T.DateType()),
    T.StructField("curency_base", T.StringType()),
    T.StructField("usd_value", T.IntegerType()),
    T.StructField("curency_target", T.StringType()),
    T.StructField("exchange_rate", T.DoubleType()),
])

RAW_FUNDAMENTALS = T.StructType([
    T.StructField("Ticker Symbol", T.StringType()),
    T.StructField("Period Ending", T.DateType()),
    T.StructField("Total Revenue", T.DoubleType()),
    T.StructField("Gross Profit", T.DoubleType()),
    T.StructField("Total Liabilities", T.DoubleType()),
    T.StructField("Long-Term Debt", T.DoubleType()),
])

FX_PAYLOAD = "data STRUCT<EUR: STRUCT<value: DOUBLE>, THB: STRUCT<value: DOUBLE>>"

PRICE_NAMES = {
    "date": "date",
    "symbol": "symbol",
    "open": "open_price",
    "close": "close_price",
    "low": "low_price",
    "high": "high_price",
    "volume": "volume",
    "GICS Sector": "gics_sector",
    "GICS Sub Industry": "gics_sub_industry",
    "sma10": "sma10",
    "sma50": "sma50",
    "rsi": "rsi",
    "close_thb": "close_price_thb",
}

FUNDAMENTAL_NAMES = {
    "Ticker Symbol": "ticker_symbol_fund",
    "Period Ending": "period_ending",
    "Total Revenue": "total_revenue",
    "Gross Profit": "gross_profit",
    "Total Liabilities": "total_liabilities",
    "Long-Term Debt": "long_term_debt",
    "GICS Sector": "gics_sector",
    "GICS Sub Industry": "gics_sub_industry",
}

BASE_CURRENCY = "USD"
BASE_UNITS = 1
TARGET_CURRENCY = "THB"
REPLAY_BASE_YEAR = 2012
REPORTING_ZONE = "Asia/Bangkok"
DATE_FORMAT = "yyyy-MM-dd"

# --- End of fixed values. ---

TICKER = "Ticker symbol"
SECTOR = ["GICS Sector", "GICS Sub Industry"]
