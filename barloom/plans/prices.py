"""Daily prices with moving averages, strength index, sector and local-currency close."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import rolling
from barloom.operators.columns import clean_dates, project
from barloom.operators.joins import attach_rate, attach_sector
from barloom.operators.series import in_blocks
from barloom.schemas import PRICE_NAMES, RAW_PRICES
from barloom.sinks.tables import rebalanced

BLOCK_ROWS = 100_000
SHORT, LONG, STRENGTH = 10, 50, 14
LOOKBACK = max(SHORT, LONG, STRENGTH + 1) - 1
#: Rows of one symbol and date follow each other by their values, so that no answer depends on
#: the order in which they arrive.
ORDER = ("date", "open", "close", "low", "high", "volume")
REPEATED = "several rows share (symbol, date)"


def with_run_year(prices: DataFrame) -> DataFrame:
    """Typed price columns plus the calendar year in which windows restart."""
    bars = clean_dates(project(prices, RAW_PRICES.names), "date")
    return bars.withColumn("run_year", F.year("date"))


def add_indicators(bars: DataFrame, keys, order=("date",), strict=False) -> DataFrame:
    """Add sma10, sma50, sma14 and rsi of ``close``: one exchange and one sort on the keys.

    A row next to a missing close counts as no change, and rsi needs 14 closes. With
    ``strict`` an unknown change is left out instead, and rsi needs 14 known changes.
    """
    change = F.col("_change")
    observed = change if strict else F.col("close")
    moved = bars.withColumn("_change", rolling.price_change("close", keys, order))
    frame = rolling.trailing(STRENGTH, keys, order)
    means = moved.withColumns({
        "sma10": rolling.rolling_mean("close", SHORT, keys, order),
        "sma50": rolling.rolling_mean("close", LONG, keys, order),
        "sma14": rolling.rolling_mean("close", STRENGTH, keys, order),
        "_gain": F.avg(rolling.gain(change, strict)).over(frame),
        "_loss": F.avg(rolling.loss(change, strict)).over(frame),
        "_seen": F.count(observed).over(frame),
    })
    rsi = rolling.strength_index(F.col("_gain"), F.col("_loss"))
    return (
        means.withColumn("rsi", F.when(F.col("_seen") >= STRENGTH, rsi))
        .drop("_change", "_gain", "_loss", "_seen")
    )


def add_exact_indicators(bars: DataFrame, keys, order=("date",)) -> DataFrame:
    """The columns of ``add_indicators`` from exact running sums, at the same cost for frames of any length.

    Amounts count to four decimal places, sums without rounding; the last digits may differ from sums of
    floating-point numbers. One exchange and one sort on the keys.
    """
    moved = bars.withColumn("_change", rolling.price_change("close", keys, order))
    sources = {"close": F.col("close"), "gain": rolling.gain(F.col("_change")), "loss": rolling.loss(F.col("_change"))}
    upto = {}
    for name, value in sources.items():
        upto[f"_{name}_sum"], upto[f"_{name}_n"] = rolling.running(value, keys, order)
    summed = moved.withColumns(upto)

    def mean(name, rows, needed=None):
        return rolling.exact_mean(f"_{name}_sum", f"_{name}_n", rows, keys, order, needed)

    _, seen = rolling.framed("_close_sum", "_close_n", STRENGTH, keys, order)
    means = summed.withColumns({
        "sma10": mean("close", SHORT), "sma50": mean("close", LONG), "sma14": mean("close", STRENGTH),
        "_gain": mean("gain", STRENGTH, 1), "_loss": mean("loss", STRENGTH, 1), "_seen": seen,
    })
    rsi = rolling.strength_index(F.col("_gain"), F.col("_loss"))
    return means.withColumn("rsi", F.when(F.col("_seen") >= STRENGTH, rsi)).drop("_change", "_gain", "_loss", "_seen", *upto)


def stop_on_repeats(bars: DataFrame, keys, order) -> DataFrame:
    """Fail while computing if two rows of a series share a date: the windows have them adjacent."""
    previous = F.lag("date").over(Window.partitionBy(*keys).orderBy(*order))
    message = F.concat(F.lit(f"{REPEATED}: "), F.coalesce("symbol", F.lit("NULL")), F.lit(" "), F.col("date").cast("string"))
    return bars.withColumn("date", F.when(previous == F.col("date"), F.raise_error(message)).otherwise(F.col("date")))


def price_metrics(prices: DataFrame, securities: DataFrame, fx: DataFrame, *,
                  strict=False, continuous=False, literal=False, block_rows=None,
                  by_year=False, repeats="ordered", broadcast=False, exact=False) -> DataFrame:
    """The published price table, every input row kept. Nothing is run or written meanwhile.

    Windows restart each calendar year; ``continuous`` runs them over the whole history.
    ``literal`` publishes the 14-row mean of the close under the name ``rsi``.
    ``repeats`` tells what rows of one symbol and date mean: ``ordered`` by their values, ``stop``
    to fail on them inside the window stage, or ``trusted`` not to exist.
    ``block_rows`` cuts series into blocks of that many rows, for tables where one symbol and
    year may outgrow a task; it changes the plan, not the answers.
    ``exact`` takes all means from exact running sums, in whole series only and not ``strict``.
    ``by_year`` rebalances the result by year, ready to be stored. ``broadcast`` is for callers
    that have measured the securities.
    """
    bars = with_run_year(prices)
    if exact and (strict or block_rows is not None):
        raise ValueError("exact means are for whole series and unknown changes that count as none")
    keys = ["symbol"] if continuous else ["run_year", "symbol"]
    order = ORDER if repeats == "ordered" else ORDER[:1]
    if block_rows is None:
        measured = add_exact_indicators(bars, keys, order) if exact else add_indicators(bars, keys, order, strict)
        if repeats == "stop":
            measured = stop_on_repeats(measured, keys, order)
    else:
        if repeats == "stop":
            raise ValueError("repeated dates are looked for in whole series only")
        blocks = in_blocks(bars, keys, list(ORDER), LOOKBACK, block_rows)
        pieces = add_indicators(blocks, [*keys, "_block"], ["_pos"], strict).where("_own")
        measured = pieces.drop("_block", "_pos", "_own")

    if by_year and broadcast:
        # The lookups come after the exchange, which then carries the rows' own columns only.
        measured = rebalanced(measured)
    enriched = attach_rate(attach_sector(measured, securities, "symbol", broadcast=broadcast), fx)
    enriched = enriched.withColumn("close_thb", F.col("exchange_rate") * F.col("close"))
    if literal:
        enriched = enriched.withColumn("rsi", F.col("sma14"))
    extra = ["run_year"] if literal else ["sma14", "run_year"]
    published = enriched.select(*[F.col(old).alias(new) for old, new in PRICE_NAMES.items()], *extra)
    return rebalanced(published) if by_year and not broadcast else published
