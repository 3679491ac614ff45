"""Equity tables derived from the order and supplier tables in the test folders.

Suppliers act as symbols and order lines as trades; see FIXTURES.md. Money is summed as
integer cents, so results do not depend on the order of summation.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.plans.fx import fx_monthly
from barloom.schemas import SECTOR, TICKER

#: More than any BIGINT: an order key and a trade value side by side in one DECIMAL.
SIDE_BY_SIDE = 10 ** 19
#: Bits of an order key and of a trade value that are side by side in one BIGINT.
KEY_BITS, VALUE_BITS = 35, 28
LISTING_BALANCE = 1000


def table(spark: SparkSession, folder, name) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cents(name):
    """Hundredths, of money or of a share, as a whole number."""
    return F.floor(F.col(name) * 100 + 0.5)


def prices(spark, folder) -> DataFrame:
    """One bar per symbol and ship date; opened by the first order, closed by the last.

    The order key and the trade value share one number, so that first and last come from plain MIN and MAX: a
    hash aggregation with map-side combine. That is a BIGINT where both are small enough for it,
    else a DECIMAL(38,0), which holds any two BIGINTs.
    """
    value, key = cents("l_extendedprice"), F.col("l_orderkey").cast("bigint")
    both = F.lit(str(SIDE_BY_SIDE)).cast("decimal(38,0)")
    small = key.between(0, (1 << KEY_BITS) - 1) & value.between(0, (1 << VALUE_BITS) - 1)
    sequence = key.cast("decimal(19,0)").cast("decimal(38,0)") * both + value
    trades = table(spark, folder, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"),
        "l_suppkey",
        value.alias("value"),
        F.when(small, F.shiftleft(key, VALUE_BITS) + value).alias("short"),
        F.when(~small, sequence.cast("decimal(38,0)")).alias("sequence"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )
    bars = trades.groupBy("l_suppkey", "date").agg(
        F.min("short").alias("first_short"),
        F.max("short").alias("last_short"),
        F.min("sequence").alias("first"),
        F.max("sequence").alias("last"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.sum("quantity").alias("volume"),
    )

    def traded(name):
        short, long = F.col(f"{name}_short"), F.col(name)
        from_short = F.pmod(short, F.lit(1 << VALUE_BITS))
        widened = F.shiftright(short, VALUE_BITS).cast("decimal(19,0)").cast("decimal(38,0)") * both + from_short
        picked = (F.least if name == "first" else F.greatest)(long, widened.cast("decimal(38,0)"))
        value = F.when(long.isNull(), from_short).otherwise((picked % both).cast("bigint"))
        return (value / F.lit(100.0)).alias("open" if name == "first" else "close")

    return bars.select(
        "date",
        F.col("l_suppkey").cast("string").alias("symbol"),
        traded("first"),
        traded("last"),
        (F.col("low") / F.lit(100.0)).alias("low"),
        (F.col("high") / F.lit(100.0)).alias("high"),
        "volume",
    )


def trades(spark, folder) -> DataFrame:
    """Every order line as a bar of its own, so that many bars share symbol and date."""
    value = (cents("l_extendedprice") / F.lit(100.0))
    return table(spark, folder, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"), F.col("l_suppkey").cast("string").alias("symbol"),
        *[value.alias(n) for n in ("open", "close", "low", "high")], F.col("l_quantity").cast("bigint").alias("volume"),
    )


def securities(spark, folder) -> DataFrame:
    """All suppliers; those of small standing under another ticker, so that the sector join misses."""
    places = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    key = F.col("s_suppkey").cast("string")
    ticker = F.when(F.col("s_acctbal") >= LISTING_BALANCE, key).otherwise(F.concat(F.lit("X"), key))
    suppliers = table(spark, folder, "supplier")
    return suppliers.join(places, F.col("s_nationkey") == F.col("n_nationkey")).select(
        ticker.alias(TICKER),
        F.col("r_name").alias(SECTOR[0]),
        F.col("n_name").alias(SECTOR[1]),
    )


def years(spark, folder) -> DataFrame:
    """Calendar years in which anything was ordered."""
    return table(spark, folder, "orders").select(F.year("o_orderdate").alias("run_year")).distinct()


def fx_payloads(spark, folder) -> DataFrame:
    """One API answer per month with orders; the rate follows the mean order value."""
    month = F.trunc(F.col("o_orderdate").cast("date"), "month")
    monthly = table(spark, folder, "orders").groupBy(month.alias("day")).agg(
        (F.sum(cents("o_totalprice")).cast("double") / F.count("*").cast("double") / F.lit(1e6)).alias("rate")
    )

    def quote(code, value):
        return F.struct(F.lit(code).alias("code"), value.alias("value")).alias(code)

    body = F.struct(F.struct(quote("EUR", F.lit(0.9)), quote("THB", F.col("rate"))).alias("data"))
    return monthly.select(
        F.date_format("day", "yyyy-MM-dd").alias("request_date"), F.to_json(body).alias("payload")
    )


def fx(spark, folder) -> DataFrame:
    """The monthly rates."""
    return fx_monthly(fx_payloads(spark, folder), years(spark, folder))


def fx_by_year(spark, folder) -> DataFrame:
    """The monthly rates landed year by year: both of two neighbouring years hold the January between."""
    spine = F.explode(F.sequence(F.make_date("run_year", F.lit(1), F.lit(1)),
                                 F.make_date(F.col("run_year") + 1, F.lit(1), F.lit(1)), F.expr("INTERVAL 1 MONTH")))
    months = years(spark, folder).select(spine.alias("exchange_date"))
    return months.join(fx(spark, folder), "exchange_date")


def fundamentals(spark, folder) -> DataFrame:
    """One row per symbol and year, with amounts summed in 1/10,000 units."""
    ext, disc, tax = cents("l_extendedprice"), cents("l_discount"), cents("l_tax")
    cost = F.col("l_quantity").cast("bigint") * cents("p_retailprice") * 60
    lines = table(spark, folder, "lineitem").join(
        table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    sums = lines.groupBy("l_suppkey", F.year("l_shipdate").alias("year")).agg(
        F.sum(ext * (100 - disc)).alias("revenue"),
        F.sum(cost).alias("cost"),
        F.sum(ext * tax).alias("liabilities"),
        F.sum(ext * disc).alias("debt"),
    )

    def units(amount, name):
        return (amount.cast("double") / F.lit(10000.0)).alias(name)

    return sums.select(
        F.col("l_suppkey").cast("string").alias("Ticker Symbol"),
        F.make_date("year", F.lit(12), F.lit(31)).alias("Period Ending"),
        units(F.col("revenue"), "Total Revenue"),
        units(F.col("revenue") - F.col("cost"), "Gross Profit"),
        units(F.col("liabilities"), "Total Liabilities"),
        units(F.col("debt"), "Long-Term Debt"),
    )
