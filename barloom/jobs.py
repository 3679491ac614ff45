"""Parameterised jobs for spark-submit.

    spark-submit --py-files barloom.zip barloom/jobs.py prices \
        --prices raw/prices --securities raw/securities --fx raw/fx --out published/prices \
        --first-year 2012 --last-year 2016
    spark-submit ... barloom/jobs.py prices ... --run-at 2025-01-20T00:00:00 --start-at 2025-01-18T00:00:00

A run takes a year range, or a run and a start instant from which the replay year follows.
"""

import argparse
from datetime import date, datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barloom.functions.calendar import replay_year
from barloom.operators.columns import conform
from barloom.operators.joins import fits_broadcast, sectors
from barloom.operators.quality import duplicate_keys, nulls_observed
from barloom.plans import fundamentals, prices
from barloom.plans.fx import fx_monthly
from barloom.schemas import RAW_FUNDAMENTALS, RAW_FX, RAW_PRICES, RAW_SECURITIES
from barloom.sinks import commits, tables
from barloom.sources import files, zones
from barloom.sources.workspace import work_folder


def years_of(args) -> tuple[int, int]:
    """The inclusive year range asked for. Incomplete parameters stop the job before any work."""
    by_range = args.first_year is not None
    by_replay = args.run_at is not None and args.start_at is not None
    if by_range == by_replay:
        raise ValueError("give either --first-year [--last-year], or --run-at with --start-at")
    if by_replay:
        year = replay_year(args.run_at, args.start_at)
        return year, year
    last = args.first_year if args.last_year is None else args.last_year
    if last < args.first_year:
        raise ValueError(f"--last-year {last} is before --first-year {args.first_year}")
    return args.first_year, last


def read(spark: SparkSession, source, path, schema, formats=(), zoned=None, day=None, years=None) -> DataFrame:
    """A raw table in its contract's columns and types, from any of its sources.

    ``zoned`` names the zone map of landed documents: it is brought up to date, and only files with a ``day``
    in the ``years``, up to their end if the first is None, or without a readable one are opened.
    """
    if zoned and source != "json":
        raise ValueError("--zones is for landed documents, --source json")
    if source == "csv":
        return files.scan_csv(spark, path, schema, formats=formats)
    if source == "parquet":
        return conform(files.scan_parquet(spark, path), schema, formats)
    # Documents are read as text by the contract: no pass to infer types, absent fields are
    # NULL, and a slice without documents is an empty table.
    landed = files.text_schema(schema)
    if source == "json" and zoned:
        zones.measure(spark, path, zoned, schema, day, formats)
        first, last = years
        start = None if first is None else date(first, 1, 1)
        return conform(zones.scan(spark, path, zoned, schema, start, date(last + 1, 1, 1), undated=True), schema, formats)
    if source == "json":
        return conform(files.scan_documents(spark, path, landed), schema, formats)
    return conform(files.scan_collection(spark, landed, collection=path), schema, formats)


def target(args, name) -> str:
    """Where the job publishes: ``--out``, or its dataset's folder for the day of the run."""
    if not args.dated:
        return args.out
    run_date = (args.run_at or datetime.now(timezone.utc)).date()
    return tables.dataset_path(args.out, "published", name, run_date)


def done_before(spark, args, name) -> dict | None:
    """The report of an append of the same ``--run-id`` that is committed already."""
    if args.run_id is None or args.mode != "append" or args.sink != "parquet":
        return None
    return commits.committed(spark, target(args, name), args.run_id)


def save(df: DataFrame, args, name) -> commits.Staged:
    """Write the rows where no reader of the published table sees them."""
    path = target(args, name) if args.sink == "parquet" else work_folder(df.sparkSession)
    return commits.stage(df, path, clustered=True)


def publish(spark, staged: commits.Staged, args, years, report) -> dict:
    """Commit rows that passed their audit, with the report of the run. Replaced years without rows are emptied."""
    if args.sink != "parquet":
        tables.append_to_warehouse(staged.read(spark), args.sink, **dict(o.split("=", 1) for o in args.sink_option))
        return report
    return commits.commit(spark, staged, args.mode, years, args.run_id, report)


def observed(observation: Observation, **empty) -> dict:
    """What was observed. A result that turns out empty while running takes its observation along;
    ``empty`` names what then holds."""
    try:
        return observation.get
    except Py4JJavaError:
        return empty


def require_unique(df: DataFrame, keys):
    repeated = duplicate_keys(df, keys).limit(5).collect()
    if repeated:
        raise ValueError(f"rows share {keys}, for example {[tuple(r) for r in repeated]}")


def range_of(name, first, last, history=False):
    """The rows of the years asked for, or up to their end; undated rows come along to be counted."""
    day = F.col(f"`{name}`")
    within = day < F.lit(date(last + 1, 1, 1))
    return within if history else within & (day >= F.lit(date(first, 1, 1)))


def audit(report, staged: commits.Staged, args, rejected: DataFrame, name, recount):
    """Refuse a run that lost rows on the way, or more than the allowed share of them to unreadable dates; the lost
    ones are kept for a look.

    What is observed on the way counts rows of repeated tasks twice if an executor is lost. Where it does not agree with
    the stored rows, ``recount`` reads the input again.
    """
    if not report["rows"] == staged.total == report["read"] - report["undated"]:
        report.update(recount(), rows=staged.total)
    if report["undated"]:
        # Only now is the input read again, for the rows that were left out.
        tables.write_parquet(rejected, f"{target(args, name).rstrip('/')}_rejected")
    if report["undated"] > args.max_undated * report["read"]:
        raise commits.Refused(f"{report['undated']} of {report['read']} rows have no date that can be read")
    if staged.total != report["read"] - report["undated"]:
        raise commits.Refused(f"{staged.total} rows stored of {report['read']} read, {report['undated']} of them undated")


def run_prices(spark: SparkSession, args) -> dict:
    """Read once, with keys checked inside the window stage; a run that fails or is refused leaves the table as it was."""
    first, last = years_of(args)
    if (before := done_before(spark, args, "prices")) is not None:
        return before
    within = (None if args.continuous else first, last)
    raw = prices.with_run_year(read(
        spark, args.source, args.prices, RAW_PRICES, args.date_format, args.zones, "date", within))
    securities = read(spark, args.lookup_source, args.securities, RAW_SECURITIES)
    fx = read(spark, args.lookup_source, args.fx, RAW_FX)
    require_unique(securities, ["Ticker symbol"])

    asked, undated = range_of("date", first, last, args.continuous), F.col("date").isNull()
    arrived, seen = Observation("read"), Observation("prices")
    in_range = range_of("date", first, last)
    counts = F.count_if(in_range | undated).alias("read"), F.count_if(undated).alias("undated")
    taken = raw.where(asked | undated).observe(arrived, *counts)
    published = prices.price_metrics(
        taken.where(asked), securities, fx, strict=args.strict, continuous=args.continuous,
        literal=args.literal, by_year=True, broadcast=fits_broadcast(sectors(securities)),
        repeats="ordered" if args.allow_duplicates else "stop",
        block_rows=prices.BLOCK_ROWS if args.allow_duplicates else None,
    ).where(in_range)
    try:
        staged = save(published.observe(
            seen, F.count("*").alias("rows"),
            F.count_if(F.col("gics_sector").isNull()).alias("without_sector"),
            F.count_if(F.col("close_price_thb").isNull()).alias("without_rate"), *nulls_observed(published),
        ), args, "prices")
    except Exception as failure:
        if prices.REPEATED in str(failure):
            raise ValueError(f"{prices.REPEATED}; --allow-duplicates publishes them") from failure
        raise
    report = {**observed(arrived, read=0, undated=0), **observed(seen, rows=0)}
    audit(report, staged, args, raw.where(undated), "prices", lambda: raw.agg(*counts).first().asDict())
    return publish(spark, staged, args, range(first, last + 1), report)


def run_fundamentals(spark: SparkSession, args) -> dict:
    first, last = years_of(args)
    if (before := done_before(spark, args, "fundamentals")) is not None:
        return before
    raw = read(
        spark, args.source, args.fundamentals, RAW_FUNDAMENTALS, args.date_format, args.zones, "Period Ending", (first, last))
    securities = read(spark, args.lookup_source, args.securities, RAW_SECURITIES)
    require_unique(securities, ["Ticker symbol"])
    asked, undated = range_of("Period Ending", first, last), F.col("`Period Ending`").isNull()
    if not args.allow_duplicates:
        require_unique(raw.where(asked), ["Ticker Symbol", "Period Ending"])

    arrived, seen = Observation("read"), Observation("fundamentals")
    counts = F.count_if(asked | undated).alias("read"), F.count_if(undated).alias("undated")
    taken = raw.where(asked | undated).observe(arrived, *counts)
    small = fits_broadcast(sectors(securities))
    published = fundamentals.with_run_year(fundamentals.fundamental_metrics(taken.where(asked), securities, small))
    staged = save(tables.rebalanced(published.observe(
        seen, F.count("*").alias("rows"),
        F.count_if(F.col("gics_sector").isNull()).alias("without_sector"), *nulls_observed(published),
    )), args, "fundamentals")
    report = {**observed(arrived, read=0, undated=0), **observed(seen, rows=0)}
    audit(report, staged, args, raw.where(undated), "fundamentals", lambda: raw.agg(*counts).first().asDict())
    return publish(spark, staged, args, range(first, last + 1), report)


def run_fx(spark: SparkSession, args) -> dict:
    """Land the monthly rates of the years, from payloads landed as JSON lines or asked live.

    Months without an answer, or with one that holds no rate, are reported and stop the job
    unless ``--allow-missing`` is given.
    """
    first, last = years_of(args)
    asked = {"asked": 12 * (last - first + 1) + 1}
    years = spark.range(first, last + 1).select(F.col("id").cast("int").alias("run_year"))
    if args.url and args.landing:
        from barloom.streaming.rates import land_rates, landed_payloads

        landed = land_rates(
            spark, args.url, date(first, 1, 1), date(last + 1, 1, 1), f"{args.landing}/answers", f"{args.landing}/progress",
            parallel=str(args.parallel), pause=str(args.pause))
        asked["requested"] = landed["asked"]
        payloads = landed_payloads(spark, f"{args.landing}/answers").where("payload IS NOT NULL")
    elif args.url:
        from barloom.sources.fx_api import FxHistory

        spark.dataSource.register(FxHistory)
        payloads = spark.read.format("fx_history").options(
            url=args.url, first=date(first, 1, 1).isoformat(), last=date(last + 1, 1, 1).isoformat(),
            parallel=str(args.parallel), pause=str(args.pause),
        ).load()
    else:
        payloads = files.scan_documents(spark, args.payloads, "request_date STRING, payload STRING")
    seen = Observation("fx")
    rates = fx_monthly(payloads, years).observe(
        seen, F.count("*").alias("received"), F.count_if(F.col("exchange_rate").isNull()).alias("unreadable"))
    tables.write_csv(rates, args.out)
    report = {**asked, **observed(seen, received=0, unreadable=0)}
    if not args.allow_missing and (report["received"] < report["asked"] or report["unreadable"]):
        raise ValueError(f"rates are missing: {report}; the table in {args.out} is incomplete")
    return report


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = top.add_subparsers(required=True)

    def job(name, run):
        one = jobs.add_parser(name)
        one.set_defaults(run=run)
        one.add_argument("--out", required=True)
        one.add_argument("--first-year", type=int)
        one.add_argument("--last-year", type=int)
        one.add_argument("--run-at", type=datetime.fromisoformat)
        one.add_argument("--start-at", type=datetime.fromisoformat)
        return one

    def table_job(name, run):
        one = job(name, run)
        one.add_argument(f"--{name}", required=True)
        one.add_argument("--securities", required=True)
        one.add_argument("--source", choices=["csv", "parquet", "json", "collection"], default="csv")
        one.add_argument("--zones", help="folder of the zone map of landed documents, kept up to date and used to choose files")
        one.add_argument("--lookup-source", choices=["csv", "parquet", "json"], default="csv")
        one.add_argument("--mode", choices=["replace", "append"], default="replace")
        one.add_argument("--run-id", help="names the run; an append of a name that is committed already adds nothing")
        one.add_argument("--dated", action="store_true", help="publish under the dataset and the day of the run")
        one.add_argument("--sink", default="parquet", help="a warehouse's Spark format, to which rows are appended")
        one.add_argument("--sink-option", action="append", default=[], metavar="NAME=VALUE")
        one.add_argument("--date-format", action="append", default=[], help="tried before ISO dates")
        one.add_argument("--max-undated", type=float, default=0.05, help="share of rows that may lack a date")
        one.add_argument("--allow-duplicates", action="store_true")
        return one

    price = table_job("prices", run_prices)
    price.add_argument("--fx", required=True)
    for flag in ("strict", "continuous", "literal"):
        price.add_argument(f"--{flag}", action="store_true")
    table_job("fundamentals", run_fundamentals)

    rates = job("fx", run_fx)
    given = rates.add_mutually_exclusive_group(required=True)
    given.add_argument("--url")
    given.add_argument("--payloads")
    rates.add_argument("--landing", help="folder of answers so far; only months without a rate there are asked for")
    rates.add_argument("--parallel", type=int, default=4)
    rates.add_argument("--pause", type=float, default=2.0, help="seconds between requests, of all tasks together")
    rates.add_argument("--allow-missing", action="store_true")
    return top


def main(argv=None) -> dict:
    args = parser().parse_args(argv)
    years_of(args)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    return args.run(spark, args)


if __name__ == "__main__":
    print(main())
