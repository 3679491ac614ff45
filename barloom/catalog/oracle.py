"""The same answers as plain SQL over the test tables, for cross-checking."""

# Building blocks, in dependency order; a query names those it reads.

BLOCKS = {
    "trades": """
        SELECT cast(l_suppkey AS varchar) AS symbol, cast(l_shipdate AS date) AS date,
               l_orderkey AS k, cast(round(l_extendedprice * 100) AS bigint) AS v,
               cast(l_quantity AS bigint) AS q
        FROM lineitem""",
    "prices": """
        SELECT date, symbol,
               cast(min(struct_pack(k := k, v := v)).v AS double) / 100 AS open,
               cast(max(struct_pack(k := k, v := v)).v AS double) / 100 AS close,
               cast(min(v) AS double) / 100 AS low,
               cast(max(v) AS double) / 100 AS high,
               cast(sum(q) AS bigint) AS volume
        FROM trades GROUP BY date, symbol""",
    "bars": "SELECT *, cast(year(date) AS integer) AS run_year FROM prices",
    "tied": """
        SELECT date, symbol, v / 100::double AS open, v / 100::double AS close, v / 100::double AS low,
               v / 100::double AS high, q AS volume, cast(year(date) AS integer) AS run_year
        FROM trades""",
    "securities": """
        SELECT CASE WHEN s_acctbal >= 1000 THEN '' ELSE 'X' END || s_suppkey AS ticker_symbol,
               r_name AS gics_sector, n_name AS gics_sub_industry
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
                      JOIN region ON n_regionkey = r_regionkey""",
    "quotes": """
        SELECT cast(date_trunc('month', o_orderdate) AS date) AS day,
               cast(sum(cast(round(o_totalprice * 100) AS bigint)) AS double)
                   / cast(count(*) AS double) / 1000000::double AS rate
        FROM orders GROUP BY 1""",
    "spine": """
        SELECT DISTINCT cast(make_date(y, 1, 1) + to_months(cast(m AS integer)) AS date) AS exchange_date
        FROM (SELECT DISTINCT cast(year(o_orderdate) AS bigint) AS y FROM orders), range(13) months(m)""",
    "fx": """
        SELECT exchange_date, 'USD' AS curency_base, cast(1 AS integer) AS usd_value,
               'THB' AS curency_target, rate AS exchange_rate
        FROM spine JOIN quotes ON day = exchange_date""",
    "lines": """
        SELECT cast(l_suppkey AS varchar) AS ticker_symbol, cast(year(l_shipdate) AS bigint) AS y,
               cast(round(l_extendedprice * 100) AS bigint) AS ext,
               cast(round(l_discount * 100) AS bigint) AS disc,
               cast(round(l_tax * 100) AS bigint) AS tax,
               cast(l_quantity AS bigint) * cast(round(p_retailprice * 100) AS bigint) * 60 AS cost
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "fundamentals": """
        SELECT ticker_symbol, make_date(y, 12, 31) AS period_ending,
               cast(sum(ext * (100 - disc)) AS double) / 10000 AS total_revenue,
               cast(sum(ext * (100 - disc)) - sum(cost) AS double) / 10000 AS gross_profit,
               cast(sum(ext * tax) AS double) / 10000 AS total_liabilities,
               cast(sum(ext * disc) AS double) / 10000 AS long_term_debt
        FROM lines GROUP BY ticker_symbol, y""",
    "fund_published": """
        SELECT f.ticker_symbol AS ticker_symbol_fund, period_ending, total_revenue, gross_profit,
               total_liabilities, long_term_debt, gics_sector, gics_sub_industry
        FROM fundamentals f LEFT JOIN securities s ON f.ticker_symbol = s.ticker_symbol""",
}


def _moved(series, bars="bars", order="date"):
    return f"""
        SELECT *, close - lag(close) OVER (PARTITION BY {series} ORDER BY {order}) AS price_change
        FROM {bars}"""


SPLIT = """
        SELECT *, CASE WHEN price_change > 0 THEN price_change ELSE 0 END AS gain,
               CASE WHEN price_change < 0 THEN -price_change ELSE 0 END AS loss
        FROM moved"""

STRICT_SPLIT = """
        SELECT *, CASE WHEN price_change > 0 THEN price_change WHEN price_change <= 0 THEN 0 END AS gain,
               CASE WHEN price_change < 0 THEN -price_change WHEN price_change >= 0 THEN 0 END AS loss
        FROM moved"""


def _mean(value, rows):
    """Frame mean summed in row order, as floating-point sums depend on it."""
    return f"list_avg(list({value}) FILTER ({value} IS NOT NULL) OVER w{rows})"


def _measured(series, seen, order="date"):
    def guarded(value, needed, counted="close"):
        return f"CASE WHEN count({counted}) OVER w{needed} >= {needed} THEN {value} END"

    index = f"100 * {_mean('gain', 14)} / nullif({_mean('gain', 14)} + {_mean('loss', 14)}, 0)"
    frames = ", ".join(
        f"w{n} AS (PARTITION BY {series} ORDER BY {order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        for n in (10, 14, 50)
    )
    return f"""
        SELECT *, count(close) OVER w10 AS row_count,
               {_mean('gain', 14)} AS avg_gain, {_mean('loss', 14)} AS avg_loss,
               {guarded(_mean('close', 10), 10)} AS sma10,
               {guarded(_mean('close', 14), 14)} AS sma14,
               {guarded(_mean('close', 50), 50)} AS sma50,
               {guarded(index, 14, seen)} AS rsi
        FROM split WINDOW {frames}"""


def _measured_exact(series):
    """Means of whole sums in decimals, which no order of summation changes."""
    def mean(value, rows):
        return f"cast(sum(cast({value} AS decimal(28, 4))) OVER w{rows} AS double) / count({value}) OVER w{rows}"

    def guarded(value, needed):
        return f"CASE WHEN count(close) OVER w{needed} >= {needed} THEN {value} END"

    index = f"100 * ({mean('gain', 14)}) / nullif({mean('gain', 14)} + {mean('loss', 14)}, 0)"
    frames = ", ".join(
        f"w{n} AS (PARTITION BY {series} ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in (10, 14, 50))
    return f"""
        SELECT *, {guarded(mean('close', 10), 10)} AS sma10, {guarded(mean('close', 14), 14)} AS sma14,
               {guarded(mean('close', 50), 50)} AS sma50, {guarded(index, 14)} AS rsi
        FROM split WINDOW {frames}"""


def _published(rsi="rsi", extra="sma14, "):
    return f"""
        SELECT date, symbol, open AS open_price, close AS close_price, low AS low_price,
               high AS high_price, volume, gics_sector, gics_sub_industry, sma10, sma50,
               {rsi} AS rsi, exchange_rate * close AS close_price_thb, {extra}run_year
        FROM measured
        LEFT JOIN securities ON symbol = ticker_symbol
        LEFT JOIN fx ON year(date) = year(exchange_date) AND month(date) = month(exchange_date)"""


YEARLY = "symbol, run_year"
BARS = ["trades", "prices", "bars"]
LOOKUPS = ["securities", "quotes", "spine", "fx"]
FUND = ["lines", "fundamentals"]


def _with(blocks, select, **own):
    parts = {name: BLOCKS[name] for name in blocks} | own
    clauses = ",\n".join(f"    {name} AS ({body})" for name, body in parts.items())
    return f"WITH\n{clauses}\n{select}"


def _windows(select, series=YEARLY, strict=False, lookups=False, tied=False, **own):
    order = "date, open, close, low, high, volume" if tied else "date"
    return _with(
        (["trades", "tied"] if tied else BARS) + (LOOKUPS if lookups else []), select,
        moved=_moved(series, "tied" if tied else "bars", order),
        split=STRICT_SPLIT if strict else SPLIT,
        measured=_measured(series, "price_change" if strict else "close", order),
        **own,
    )


def _metrics(**options):
    return _windows(_published(), lookups=True, **options)


def _profile(blocks, columns, source, **own):
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS non_null, count(*) - count({c}) AS nulls FROM {source}"
        for c in columns
    )
    return _with(blocks, rows, **own)


PRICE_COLUMNS = "date, symbol, open, close, low, high, volume"
SECTORED = f"""
    SELECT {PRICE_COLUMNS}, gics_sector, gics_sub_industry
    FROM prices LEFT JOIN securities ON symbol = ticker_symbol"""
RATED = """
    FROM prices LEFT JOIN fx ON year(date) = year(exchange_date) AND month(date) = month(exchange_date)"""
RAW_DATES = """
    SELECT l_orderkey, l_linenumber, CASE l_returnflag
             WHEN 'A' THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')
             WHEN 'R' THEN strftime(l_shipdate, '%Y/%m/%d')
             ELSE strftime(l_shipdate, '%Y-%m-%d') END AS raw
    FROM lineitem"""
BAR_TYPES = {
    "date": "date", "symbol": "string", "open": "double", "close": "double", "low": "double",
    "high": "double", "volume": "bigint", "run_year": "int",
}

ALL_METRICS = _metrics()
ALL_PRICES = _with(["trades", "prices"], f"SELECT {PRICE_COLUMNS} FROM prices")
ALL_FUNDAMENTALS = _with(FUND, "SELECT * FROM fundamentals")
FUND_PUBLISHED = _with([*FUND, "securities", "fund_published"], "SELECT * FROM fund_published")
ALL_FX = _with(["quotes", "spine", "fx"], "SELECT * FROM fx")

PRICES_1998 = _with(
    ["trades", "prices"], "SELECT * FROM prices WHERE date >= DATE '1998-01-01' AND date < DATE '1999-01-01'")
FUNDAMENTALS_1998 = _with(
    FUND, "SELECT * FROM fundamentals WHERE period_ending >= DATE '1998-01-01' AND period_ending < DATE '1999-01-01'")
RATES_JOINED = _with(["trades", "prices", "quotes", "spine", "fx"], f"""
        SELECT symbol, date, cast(year(date) AS integer) AS p_year,
               cast(month(date) AS integer) AS p_month, exchange_rate {RATED}""")

ASOF = _with(["trades", "prices", "quotes", "spine", "fx"], """
        SELECT symbol, date, close, {rate}
        FROM prices ASOF LEFT JOIN thinned ON date >= exchange_date""", thinned="""
        SELECT * FROM fx WHERE exchange_date NOT IN (DATE '1997-03-01', DATE '1998-07-01')""")
PRICE_TREND = _with(["trades", "prices", "securities"], """
        SELECT gics_sector, cast(date_trunc('month', date) AS date) AS month,
               cast(sum(cast(close AS decimal(28, 4))) AS double) / count(close) AS avg_close,
               cast(sum(volume) AS double) / count(volume) AS avg_volume,
               count(*) AS bars
        FROM prices LEFT JOIN securities ON symbol = ticker_symbol GROUP BY 1, 2""")
SECTORED_NULLS = _profile(
    ["trades", "prices", "securities"],
    [*PRICE_COLUMNS.split(", "), "gics_sector", "gics_sub_industry"], "sectored", sectored=SECTORED)

ORACLE = {
    "price_metrics": ALL_METRICS,
    "price_metrics_strict": _metrics(strict=True),
    "price_metrics_continuous": _metrics(series="symbol"),
    "price_metrics_as_published": _windows(_published("sma14", ""), lookups=True),
    "price_metrics_blocked": _metrics(series="symbol"),
    "price_metrics_exact": _with(
        BARS + LOOKUPS, _published(), moved=_moved("symbol"), split=SPLIT, measured=_measured_exact("symbol")),
    "price_metrics_backfill": ALL_METRICS,
    "price_metrics_tied": _metrics(tied=True),
    "price_metrics_tied_blocked": _metrics(tied=True),
    "fundamental_metrics": FUND_PUBLISHED,
    "fundamental_trend": _with([*FUND, "securities", "fund_published"], """
        SELECT gics_sector, cast(year(period_ending) AS integer) AS year,
               cast(sum(cast(total_revenue AS decimal(28, 4))) AS double) AS total_revenue,
               cast(sum(cast(gross_profit AS decimal(28, 4))) AS double) AS gross_profit,
               cast(sum(cast(gross_profit AS decimal(28, 4))) AS double)
                   / cast(sum(cast(total_revenue AS decimal(28, 4))) AS double) AS gross_margin
        FROM fund_published GROUP BY 1, 2"""),
    "price_trend": PRICE_TREND,
    "price_trend_kept": PRICE_TREND,
    "scan_csv_prices": ALL_PRICES,
    "scan_csv_securities": _with(["securities"], "SELECT * FROM securities"),
    "scan_csv_fx": ALL_FX,
    "scan_csv_fundamentals": ALL_FUNDAMENTALS,
    "scan_csv_inferred": _with(
        ["trades", "prices"], "SELECT * REPLACE (cast(symbol AS bigint) AS symbol) FROM prices"),
    "scan_csv_mixed_headers": ALL_PRICES,
    "scan_csv_timestamps": ALL_PRICES,
    "docs_timestamps": ALL_PRICES,
    "docs_to_table": _with(
        ["trades", "prices", "securities"],
        f"SELECT * REPLACE (strftime(date, '%Y-%m-%d') AS date) FROM ({SECTORED})"),
    "slice_prices_year": PRICES_1998,
    "slice_prices_zoned": PRICES_1998,
    "slice_fundamentals_year": FUNDAMENTALS_1998,
    "slice_fundamentals_zoned": FUNDAMENTALS_1998,
    "csv_roundtrip": FUND_PUBLISHED,
    "parquet_roundtrip": FUND_PUBLISHED,
    "append_load": ALL_METRICS,
    "refused_load": ALL_METRICS + "\n WHERE date >= DATE '1998-01-01'",
    "dated_load": ALL_METRICS + "\n WHERE date >= DATE '1998-01-01' AND date < DATE '1999-01-01'",
    "repeated_append": ALL_METRICS,
    "exactly_once_append": ALL_METRICS,
    "idempotent_load": ALL_METRICS,
    "incremental_load": ALL_METRICS,
    "incremental_corrections": ALL_METRICS,
    "incremental_continuous": _metrics(series="symbol"),
    "incremental_continuous_corrections": _metrics(series="symbol"),
    "project_prices": ALL_PRICES,
    "project_fundamentals": ALL_FUNDAMENTALS,
    "rename_columns_strict": _with(["trades", "prices"], """
        SELECT date, symbol, open AS open_price, close AS close_price, low AS low_price,
               high AS high_price, volume FROM prices"""),
    "rename_columns_lenient": _with(FUND, """
        SELECT ticker_symbol AS ticker_symbol_fund, * EXCLUDE (ticker_symbol),
               cast(year(period_ending) AS integer) AS fiscal_year FROM fundamentals"""),
    "drop_columns": _with(BARS, "SELECT * EXCLUDE (open, high, low) FROM bars"),
    "clean_dates": f"""
        SELECT l_orderkey, l_linenumber, cast(try_strptime(raw, '%Y-%m-%d') AS date) AS date,
               raw IS NOT NULL AND try_strptime(raw, '%Y-%m-%d') IS NULL AS rejected
        FROM ({RAW_DATES})""",
    "rejected_dates": f"""
        SELECT count(*) AS rows_read,
               count(*) FILTER (try_strptime(raw, '%Y-%m-%d') IS NULL) AS rows_rejected
        FROM ({RAW_DATES})""",
    "year_month_keys": _with(["trades", "prices"], """
        SELECT symbol, date, cast(year(date) AS integer) AS p_year,
               cast(month(date) AS integer) AS p_month FROM prices"""),
    "enrich_prices_sector": _with(["trades", "prices", "securities"], SECTORED),
    "enrich_fundamentals_sector": _with([*FUND, "securities", "fund_published"], """
        SELECT ticker_symbol_fund AS ticker_symbol, * EXCLUDE (ticker_symbol_fund) FROM fund_published"""),
    "fx_join_year_month": RATES_JOINED,
    "fx_join_years_landed_apart": RATES_JOINED,
    "fx_join_asof": ASOF.format(rate="exchange_rate"),
    "fx_join_asof_fresh": ASOF.format(rate="CASE WHEN date - exchange_date <= 45 THEN exchange_rate END AS exchange_rate"),
    "close_thb": _with(["trades", "prices", "quotes", "spine", "fx"], f"""
        SELECT symbol, date, close, exchange_rate * close AS close_thb {RATED}"""),
    "fx_month_spine": _with(
        ["spine"], "SELECT exchange_date, strftime(exchange_date, '%Y-%m-%d') AS request_date FROM spine"),
    "fx_json_extract": _with(
        ["quotes"], "SELECT strftime(day, '%Y-%m-%d') AS request_date, rate AS exchange_rate FROM quotes"),
    "fx_rate_table": ALL_FX,
    "replay_year_bounds": """
        SELECT event_id, run_date, run_count, 2012 + run_count AS run_year,
               make_date(2012 + run_count, 1, 1) AS slice_start,
               make_date(2013 + run_count, 1, 1) AS slice_end
        FROM (SELECT event_id, cast(ts + INTERVAL 7 HOUR AS date) AS run_date,
                     cast(floor((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-10 17:00:00')) / 86400000000.0::double)
                          AS integer) AS run_count
              FROM events)""",
    "sma10": _windows("SELECT symbol, date, sma10 FROM measured"),
    "rolling_count10": _windows("SELECT symbol, date, row_count FROM measured"),
    "sma50": _windows("SELECT symbol, date, sma50 FROM measured"),
    "sma14_as_published": _windows("SELECT symbol, date, sma14 AS rsi FROM measured"),
    "price_change": _windows("SELECT symbol, date, price_change FROM moved"),
    "gain_loss_split": _windows("SELECT symbol, date, gain, loss FROM split"),
    "avg_gain_loss14": _windows("SELECT symbol, date, avg_gain, avg_loss FROM measured"),
    "rsi14": _windows("SELECT symbol, date, rsi FROM measured"),
    "rsi14_strict": _windows("SELECT symbol, date, rsi FROM measured", strict=True),
    "null_profile_prices": SECTORED_NULLS,
    "null_profile_kept": SECTORED_NULLS,
    "null_profile_fundamentals": _profile(
        FUND,
        ["ticker_symbol", "period_ending", "total_revenue", "gross_profit", "total_liabilities", "long_term_debt"],
        "fundamentals"),
    "schema_profile": _with(BARS, " UNION ALL ".join(
        f"SELECT cast({i} AS integer) AS position, '{c}' AS column_name, '{t}' AS data_type, "
        f"true AS nullable, count({c}) AS non_null FROM bars"
        for i, (c, t) in enumerate(BAR_TYPES.items(), 1))),
    "duplicate_keys": """
        SELECT l_orderkey, l_linenumber, count(*) AS copies
        FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "duplicate_keys_sketched": """
        SELECT l_orderkey, l_suppkey, count(*) AS copies
        FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "preview_prices": ALL_METRICS + "\n ORDER BY symbol, date LIMIT 100",
    "preview_fundamentals": FUND_PUBLISHED + "\n ORDER BY ticker_symbol_fund, period_ending LIMIT 20",
}
