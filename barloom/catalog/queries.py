"""Every operator and pipeline as a query over the test tables: (spark, folder) -> DataFrame."""

from datetime import date, datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom import jobs
from barloom.catalog import testbed
from barloom.functions import rolling
from barloom.functions.calendar import month_spine, replay_calendar, year_month
from barloom.operators import columns, duplicates, joins, profile, quality
from barloom.plans import fundamentals, fx, prices, trends
from barloom.schemas import (
    FUNDAMENTAL_NAMES, PRICE_NAMES, RAW_FUNDAMENTALS, RAW_FX, RAW_PRICES, RAW_SECURITIES, SECTOR,
)
from barloom.sinks import commits, ledger, tables
from barloom.sources import files, zones
from barloom.sources.workspace import work_folder
from barloom.streaming.landing import publish_new_files

QUERIES = {}
KEYS, ORDER = ["symbol", "run_year"], ["date"]
SPLIT = date(1998, 1, 1)
REPLAY_START = datetime(2024, 1, 10, 17, 0)


def query(build):
    QUERIES[build.__name__] = build
    return build


def snake(df: DataFrame) -> DataFrame:
    names = {**FUNDAMENTAL_NAMES, "Ticker symbol": "ticker_symbol"}
    return columns.rename_columns(df, names, strict=False)


def bars(spark, folder) -> DataFrame:
    return prices.with_run_year(testbed.prices(spark, folder))


def lookups(spark, folder):
    return testbed.securities(spark, folder), testbed.fx(spark, folder)


def small(securities) -> bool:
    """Whether the securities may be broadcast, measured as the jobs do."""
    return joins.fits_broadcast(joins.sectors(securities))


def stored(df: DataFrame) -> DataFrame:
    """The rows written once, for queries that read them several times."""
    path = work_folder(df.sparkSession)
    tables.write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def metrics(spark, folder, raw=None, rates=None, **options) -> DataFrame:
    securities, derived = lookups(spark, folder)
    rates = derived if rates is None else rates
    bars = testbed.prices(spark, folder) if raw is None else raw
    return prices.price_metrics(bars, securities, rates, broadcast=small(securities), **options)


def published_fundamentals(spark, folder) -> DataFrame:
    securities = testbed.securities(spark, folder)
    return fundamentals.fundamental_metrics(testbed.fundamentals(spark, folder), securities, small(securities))


def sectored(rows, securities, key) -> DataFrame:
    return joins.attach_sector(rows, securities, key, small(securities))


# Pipelines

@query
def price_metrics(spark, folder):
    return metrics(spark, folder)


@query
def price_metrics_strict(spark, folder):
    return metrics(spark, folder, strict=True)


@query
def price_metrics_continuous(spark, folder):
    return metrics(spark, folder, continuous=True)


@query
def price_metrics_as_published(spark, folder):
    return metrics(spark, folder, literal=True)


@query
def price_metrics_exact(spark, folder):
    """All means from exact running sums, over the whole history."""
    return metrics(spark, folder, continuous=True, exact=True)


@query
def price_metrics_blocked(spark, folder):
    return metrics(spark, folder, continuous=True, block_rows=533)


@query
def price_metrics_tied(spark, folder):
    """Several rows of one symbol and day, in the order of their values."""
    return metrics(spark, folder, testbed.trades(spark, folder))


@query
def price_metrics_tied_blocked(spark, folder):
    return metrics(spark, folder, testbed.trades(spark, folder), block_rows=53)


@query
def price_metrics_backfill(spark, folder):
    path = work_folder(spark)
    tables.idempotent_load(metrics(spark, folder, by_year=True, repeats="stop"), path, clustered=True)
    return files.scan_parquet(spark, path)


@query
def fundamental_metrics(spark, folder):
    return published_fundamentals(spark, folder)


@query
def fundamental_trend(spark, folder):
    return trends.fundamental_trend(published_fundamentals(spark, folder))


@query
def price_trend(spark, folder):
    rows = sectored(testbed.prices(spark, folder), testbed.securities(spark, folder), "symbol")
    return trends.price_trend(columns.rename_columns(rows, PRICE_NAMES, strict=False))


@query
def price_trend_kept(spark, folder):
    """The trend from stored sums: the first years are kept with wrong volumes, then the others, then the first again."""
    path = work_folder(spark)
    rows = sectored(testbed.prices(spark, folder), testbed.securities(spark, folder), "symbol")
    published = columns.rename_columns(rows, PRICE_NAMES, strict=False).withColumn("run_year", F.year("date"))
    wrong = published.withColumn("volume", F.col("volume") + 1)
    trends.keep_price_trend(wrong, path, range(1990, SPLIT.year))
    trends.keep_price_trend(published, path, range(SPLIT.year, 2010))
    trends.keep_price_trend(published, path, range(1990, SPLIT.year))
    return trends.kept_price_trend(spark, path)


# Sources

@query
def scan_csv_prices(spark, folder):
    path = work_folder(spark)
    landed = testbed.prices(spark, folder).select(F.concat("symbol", F.lit("/"), "date").alias("_id"), "*")
    tables.write_csv(landed, path)
    return files.scan_csv(spark, path, RAW_PRICES)


@query
def scan_csv_securities(spark, folder):
    path = work_folder(spark)
    tables.write_csv(testbed.securities(spark, folder), path)
    return snake(files.scan_csv(spark, path, RAW_SECURITIES))


@query
def scan_csv_fx(spark, folder):
    path = work_folder(spark)
    tables.write_csv(testbed.fx(spark, folder), path)
    return files.scan_csv(spark, path, RAW_FX)


@query
def scan_csv_fundamentals(spark, folder):
    path = work_folder(spark)
    tables.write_csv(testbed.fundamentals(spark, folder), path)
    return snake(files.scan_csv(spark, path, RAW_FUNDAMENTALS))


@query
def scan_csv_inferred(spark, folder):
    path = work_folder(spark)
    tables.write_csv(testbed.prices(spark, folder), path)
    inferred = files.scan_csv(spark, path, RAW_PRICES, infer=True)
    return inferred.withColumns({"symbol": F.col("symbol").cast("bigint"), "volume": F.col("volume").cast("bigint")})


@query
def scan_csv_mixed_headers(spark, folder):
    """Two parts whose headers differ in order."""
    path = work_folder(spark)
    everything = testbed.prices(spark, folder)
    turned = everything.select(F.lit("x").alias("note"), *reversed(everything.columns))
    tables.write_csv(files.slice_range(everything, "date", end=SPLIT), f"{path}/one")
    tables.write_csv(files.slice_range(turned, "date", start=SPLIT), f"{path}/two")
    return files.scan_csv_parts(spark, f"{path}/*", RAW_PRICES)


def _timed(spark, folder):
    """Bars whose dates have a time part, in the spellings of files and of exported documents."""
    day = F.date_format("date", "yyyy-MM-dd")
    spelled = F.when(F.col("volume") % 2 == 0, F.concat(day, F.lit(" 00:00:00"))).otherwise(
        F.concat(day, F.lit("T23:59:59.999Z")))
    return testbed.prices(spark, folder).withColumn("date", spelled)


@query
def scan_csv_timestamps(spark, folder):
    path = work_folder(spark)
    tables.write_csv(_timed(spark, folder), path)
    return files.scan_csv(spark, path, RAW_PRICES)


@query
def docs_timestamps(spark, folder):
    path = work_folder(spark)
    wrapped = F.struct(F.col("date").alias("$date"))
    _timed(spark, folder).withColumn("date", wrapped).write.json(path)
    return columns.conform(files.scan_documents(spark, path, files.text_schema(RAW_PRICES)), RAW_PRICES)


@query
def docs_to_table(spark, folder):
    path = work_folder(spark)
    documents = sectored(testbed.prices(spark, folder), testbed.securities(spark, folder), "symbol")
    documents.write.json(path)
    return snake(files.scan_documents(spark, path))


@query
def slice_prices_year(spark, folder):
    return files.slice_years(testbed.prices(spark, folder), "date", 1998)


@query
def slice_fundamentals_year(spark, folder):
    return snake(files.slice_years(testbed.fundamentals(spark, folder), "Period Ending", 1998))


def _landed_by_date(spark, rows, name, files_wanted=12):
    """A folder of documents of which each file holds a range of dates, and a folder for their zone map."""
    path = work_folder(spark)
    dealt = rows.repartitionByRange(files_wanted, f"`{name}`")
    dealt.withColumn(name, F.struct(F.date_format(f"`{name}`", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("$date"))).write.json(f"{path}/landed")
    return f"{path}/landed", f"{path}/zones"


@query
def slice_prices_zoned(spark, folder):
    """A year of landed documents, from the files that the zone map names."""
    path, kept = _landed_by_date(spark, testbed.prices(spark, folder), "date")
    zones.measure(spark, path, kept, RAW_PRICES, "date")
    return zones.slice_documents(spark, path, kept, RAW_PRICES, "date", date(1998, 1, 1), date(1999, 1, 1))


@query
def slice_fundamentals_zoned(spark, folder):
    path, kept = _landed_by_date(spark, testbed.fundamentals(spark, folder), "Period Ending")
    zones.measure(spark, path, kept, RAW_FUNDAMENTALS, "Period Ending")
    return snake(zones.slice_documents(
        spark, path, kept, RAW_FUNDAMENTALS, "Period Ending", date(1998, 1, 1), date(1999, 1, 1)))


# Sinks

@query
def csv_roundtrip(spark, folder):
    path = work_folder(spark)
    published = published_fundamentals(spark, folder)
    tables.write_csv(published, path)
    return files.scan_csv(spark, path, published.schema)


@query
def parquet_roundtrip(spark, folder):
    path = work_folder(spark)
    tables.write_parquet(published_fundamentals(spark, folder), path)
    return files.scan_parquet(spark, path)


@query
def append_load(spark, folder):
    path = work_folder(spark)
    everything, rates = stored(testbed.prices(spark, folder)), stored(testbed.fx(spark, folder))
    for start, end in ((None, SPLIT), (SPLIT, None)):
        part = files.slice_range(everything, "date", start, end)
        tables.append_load(metrics(spark, folder, part, rates, by_year=True, repeats="stop"), path, clustered=True)
    return files.scan_parquet(spark, path)


@query
def idempotent_load(spark, folder):
    path = work_folder(spark)
    everything, rates = stored(testbed.prices(spark, folder)), stored(testbed.fx(spark, folder))
    again = files.slice_range(everything, "date", start=SPLIT)
    for part in (everything, again):
        tables.idempotent_load(metrics(spark, folder, part, rates, by_year=True, repeats="stop"), path, clustered=True)
    return files.scan_parquet(spark, path)


def _published_by_job(spark, folder, *runs, below=""):
    """The price table after jobs over landed bars, one for each of (bars, arguments); refused ones change nothing.

    ``below`` is where under ``--out`` the table is published.
    """
    path = work_folder(spark)
    securities, rates = lookups(spark, folder)
    tables.write_csv(securities, f"{path}/securities")
    tables.write_csv(rates, f"{path}/fx")
    landed = {}
    for bars, arguments in runs:
        # Bars that several runs read land once.
        if id(bars) not in landed:
            landed[id(bars)] = f"{path}/prices{len(landed)}"
            tables.write_csv(bars, landed[id(bars)])
        args = jobs.parser().parse_args([
            "prices", "--prices", landed[id(bars)], "--securities", f"{path}/securities", "--fx", f"{path}/fx",
            "--out", f"{path}/published", *arguments])
        try:
            args.run(spark, args)
        except commits.Refused:
            continue
    return commits.scan(spark, f"{path}/published{below}")


YEARS = ["--first-year", str(SPLIT.year), "--last-year", "2100"]
EARLIER = ["--first-year", "1900", "--last-year", str(SPLIT.year - 1)]


@query
def refused_load(spark, folder):
    """The later years are published, then refused twice with every ninth date unreadable."""
    late = stored(_halves(spark, folder)[1])
    spoilt = late.withColumn("date", F.when(F.col("volume") % 9 == 0, F.lit("soon")).otherwise(F.col("date").cast("string")))
    return _published_by_job(spark, folder, (late, YEARS), (spoilt, YEARS), (spoilt, [*YEARS, "--mode", "append"]))


@query
def dated_load(spark, folder):
    """One year published under its dataset and the day of the run."""
    day = date(2025, 1, 18)
    asked = ["--first-year", str(SPLIT.year), "--dated", "--run-at", day.isoformat()]
    below = tables.dataset_path("", "published", "prices", day)
    return _published_by_job(spark, folder, (testbed.prices(spark, folder), asked), below=below)


@query
def repeated_append(spark, folder):
    """Both halves are appended, the second by a run that is repeated."""
    early, late = _halves(spark, folder)
    first, second = ([*EARLIER, "--mode", "append", "--run-id", "one"], [*YEARS, "--mode", "append", "--run-id", "two"])
    return _published_by_job(spark, folder, (early, first), (late, second), (late, second))


@query
def exactly_once_append(spark, folder):
    """Both halves through the ledger: the second fails on the way, is repeated, and repeated once more."""
    path = work_folder(spark)
    early, late = (metrics(spark, folder, part) for part in _halves(spark, folder))
    # Read by the run that fails and by its repetition.
    late = stored(late)
    failing = F.when(F.col("run_year") > SPLIT.year, F.raise_error(F.lit("lost"))).otherwise(F.col("run_year"))
    ledger.append_once(early, path, "early")
    try:
        ledger.append_once(late.withColumn("run_year", failing), path, "late")
    except PySparkException as failure:
        if "lost" not in str(failure):
            raise
    for _ in range(2):
        ledger.append_once(late, path, "late")
    return ledger.scan_ledger(spark, path)


def _loaded(spark, folder, *batches, **options):
    """The published table after landing the batches one by one."""
    path = work_folder(spark)
    landing, history, published = f"{path}/landing", f"{path}/history", f"{path}/published"
    securities, rates = lookups(spark, folder)
    rates = stored(rates)
    for batch in batches:
        batch.write.mode("append").parquet(landing)
        publish_new_files(
            spark, landing, history, published, f"{path}/progress", securities, rates,
            broadcast=small(securities), **options).awaitTermination()
    return files.scan_parquet(spark, published)


def _halves(spark, folder):
    everything = testbed.prices(spark, folder)
    return [files.slice_range(everything, "date", *ends) for ends in ((None, SPLIT), (SPLIT, None))]


@query
def incremental_load(spark, folder):
    return _loaded(spark, folder, *_halves(spark, folder))


@query
def incremental_corrections(spark, folder):
    """The first half lands with wrong closes and is corrected by a later batch."""
    early, late = _halves(spark, folder)
    early = stored(early)
    return _loaded(spark, folder, early.withColumn("close", F.col("close") + 1), late, early)


@query
def incremental_continuous(spark, folder):
    return _loaded(spark, folder, *reversed(_halves(spark, folder)), continuous=True)


@query
def incremental_continuous_corrections(spark, folder):
    """Whole-history windows while a year lands late, another is corrected, and one lands in two parts."""
    everything = stored(testbed.prices(spark, folder))

    def between(first, last):
        return files.slice_range(everything, "date", date(first, 1, 1), date(last, 1, 1))

    wrong = between(1900, 1998).withColumn("close", F.when(F.year("date") == 1996, F.col("close") + 1).otherwise(F.col("close")))
    odd = F.col("volume") % 2 == 1
    return _loaded(
        spark, folder, wrong, between(1999, 2100).where(odd), between(1998, 1999), between(1996, 1997),
        between(1999, 2100).where(~odd), continuous=True)


# Columns

@query
def project_prices(spark, folder):
    return columns.project(bars(spark, folder), RAW_PRICES.names)


@query
def project_fundamentals(spark, folder):
    return snake(columns.project(testbed.fundamentals(spark, folder), RAW_FUNDAMENTALS.names))


@query
def rename_columns_strict(spark, folder):
    return columns.rename_columns(testbed.prices(spark, folder), PRICE_NAMES)


@query
def rename_columns_lenient(spark, folder):
    yearly = testbed.fundamentals(spark, folder).withColumn("fiscal_year", F.year("Period Ending"))
    return columns.rename_columns(yearly, FUNDAMENTAL_NAMES, strict=False)


@query
def drop_columns(spark, folder):
    return columns.drop_columns(bars(spark, folder), ["open", "HIGH", "low"])


def _raw_dates(spark, folder):
    """Ship dates as text in three spellings, one of which is the expected one."""
    day = F.col("l_shipdate").cast("date")
    text = (
        F.when(F.col("l_returnflag") == "A", F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("l_returnflag") == "R", F.date_format(day, "yyyy/MM/dd"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    return testbed.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", text.alias("date"))


@query
def clean_dates(spark, folder):
    return columns.clean_dates(_raw_dates(spark, folder), "date", rejected="rejected")


@query
def rejected_dates(spark, folder):
    return quality.rejected_count(clean_dates(spark, folder), "rejected")


@query
def year_month_keys(spark, folder):
    return bars(spark, folder).select("symbol", "date", *[c.alias(n) for n, c in year_month("date", "p").items()])


# Joins

@query
def enrich_prices_sector(spark, folder):
    return snake(sectored(testbed.prices(spark, folder), testbed.securities(spark, folder), "symbol"))


@query
def enrich_fundamentals_sector(spark, folder):
    return snake(sectored(testbed.fundamentals(spark, folder), testbed.securities(spark, folder), "Ticker Symbol"))


@query
def fx_join_year_month(spark, folder):
    rated = joins.attach_rate(testbed.prices(spark, folder), testbed.fx(spark, folder))
    return rated.select("symbol", "date", "p_year", "p_month", "exchange_rate")


@query
def fx_join_years_landed_apart(spark, folder):
    """Rates of each year in a folder of its own: every January but the first and last is there twice."""
    path = work_folder(spark)
    tables.write_csv(testbed.fx_by_year(spark, folder), path)
    rated = joins.attach_rate(testbed.prices(spark, folder), files.scan_csv(spark, path, RAW_FX))
    return rated.select("symbol", "date", "p_year", "p_month", "exchange_rate")


@query
def close_thb(spark, folder):
    rated = joins.attach_rate(testbed.prices(spark, folder), testbed.fx(spark, folder))
    return rated.select("symbol", "date", "close", (F.col("exchange_rate") * F.col("close")).alias("close_thb"))


def _thinned(rates):
    """The monthly rates without two of the months."""
    return rates.where(~F.col("exchange_date").isin(date(1997, 3, 1), date(1998, 7, 1)))


@query
def fx_join_asof(spark, folder):
    """The rate last quoted up to a bar's day, two months being missing."""
    rated = joins.attach_rate_asof(testbed.prices(spark, folder), _thinned(testbed.fx(spark, folder)))
    return rated.select("symbol", "date", "close", "exchange_rate")


@query
def fx_join_asof_fresh(spark, folder):
    """The same with rates of up to 45 days."""
    rated = joins.attach_rate_asof(testbed.prices(spark, folder), _thinned(testbed.fx(spark, folder)), max_days=45)
    return rated.select("symbol", "date", "close", "exchange_rate")


# Exchange rates and calendar

@query
def fx_month_spine(spark, folder):
    return month_spine(testbed.years(spark, folder))


@query
def fx_json_extract(spark, folder):
    return fx.extract_rate(testbed.fx_payloads(spark, folder))


@query
def fx_rate_table(spark, folder):
    return fx.fx_monthly(testbed.fx_payloads(spark, folder), testbed.years(spark, folder))


@query
def replay_year_bounds(spark, folder):
    runs = testbed.table(spark, folder, "events").select("event_id", "ts")
    return replay_calendar(runs, "ts", REPLAY_START).drop("ts")


# Windows

def _over_bars(spark, folder, **computed):
    return bars(spark, folder).select("symbol", "date", *[c.alias(n) for n, c in computed.items()])


def _changes(spark, folder):
    return bars(spark, folder).withColumn("price_change", rolling.price_change("close", KEYS, ORDER))


def _indicators(spark, folder, *names, **options):
    return prices.add_indicators(bars(spark, folder), KEYS, **options).select("symbol", "date", *names)


@query
def sma10(spark, folder):
    return _over_bars(spark, folder, sma10=rolling.rolling_mean("close", 10, KEYS, ORDER))


@query
def rolling_count10(spark, folder):
    return _over_bars(spark, folder, row_count=rolling.rolling_count("close", 10, KEYS, ORDER))


@query
def sma50(spark, folder):
    return _over_bars(spark, folder, sma50=rolling.rolling_mean("close", 50, KEYS, ORDER))


@query
def sma14_as_published(spark, folder):
    return _over_bars(spark, folder, rsi=rolling.rolling_mean("close", 14, KEYS, ORDER))


@query
def price_change(spark, folder):
    return _changes(spark, folder).select("symbol", "date", "price_change")


@query
def gain_loss_split(spark, folder):
    change = F.col("price_change")
    return _changes(spark, folder).select(
        "symbol", "date", rolling.gain(change).alias("gain"), rolling.loss(change).alias("loss")
    )


@query
def avg_gain_loss14(spark, folder):
    change, frame = F.col("price_change"), rolling.trailing(14, KEYS, ORDER)
    return _changes(spark, folder).select(
        "symbol", "date",
        F.avg(rolling.gain(change)).over(frame).alias("avg_gain"),
        F.avg(rolling.loss(change)).over(frame).alias("avg_loss"),
    )


@query
def rsi14(spark, folder):
    return _indicators(spark, folder, "rsi")


@query
def rsi14_strict(spark, folder):
    return _indicators(spark, folder, "rsi", strict=True)


# Quality and previews

@query
def null_profile_prices(spark, folder):
    return quality.null_profile(enrich_prices_sector(spark, folder))


@query
def null_profile_kept(spark, folder):
    """Exact counts of all years from profiles kept by year, one of which is replaced."""
    path = work_folder(spark)
    rows = enrich_prices_sector(spark, folder).withColumn("run_year", F.year("date"))
    spoilt = rows.withColumn("gics_sector", F.lit(None).cast("string"))
    profile.keep_profile(spoilt, path, range(1990, 2010))
    profile.keep_profile(rows, path, [y for y in range(1990, 2010) if y != SPLIT.year])
    profile.keep_profile(rows, path, [SPLIT.year])
    return profile.merged_profile(spark, path).select("column_name", "non_null", "nulls")


@query
def null_profile_fundamentals(spark, folder):
    return quality.null_profile(project_fundamentals(spark, folder))


@query
def schema_profile(spark, folder):
    return quality.schema_profile(bars(spark, folder))


@query
def duplicate_keys(spark, folder):
    return quality.duplicate_keys(testbed.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def duplicate_keys_sketched(spark, folder):
    """Orders with several lines of one supplier, found by sketches of the keys."""
    return duplicates.repeated_keys(testbed.table(spark, folder, "lineitem"), ["l_orderkey", "l_suppkey"])


@query
def preview_prices(spark, folder):
    return quality.preview(metrics(spark, folder), ["symbol", "date"], 100)


@query
def preview_fundamentals(spark, folder):
    return quality.preview(published_fundamentals(spark, folder), ["ticker_symbol_fund", "period_ending"], 20)
