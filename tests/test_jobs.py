from datetime import date, datetime

import pytest

from barloom import jobs
from barloom.sinks import commits, tables

SECURITIES = "Ticker symbol,Security,GICS Sector,GICS Sub Industry\nA,Acme,Energy,Drilling\n"
FX = "exchange_date,curency_base,usd_value,curency_target,exchange_rate\n" + "".join(
    f"2012-{m:02d}-01,USD,1,THB,{30 + m}\n" for m in range(1, 13)
)


@pytest.fixture
def raw(tmp_path):
    lines = ["date,symbol,open,close,low,high,volume"]
    for year in (2012, 2013):
        for day in range(1, 21):
            lines += [f"{year}-01-{day:02d},{s},1,{day},1,{day},{100 * day}" for s in "AB"]
    lines.append("someday,A,1,1,1,1,1")
    for name, text in (("prices", "\n".join(lines) + "\n"), ("securities", SECURITIES), ("fx", FX)):
        (tmp_path / f"{name}.csv").write_text(text)
    return tmp_path


def prices_args(raw, *more, out="out"):
    return [
        "prices", "--prices", f"{raw}/prices.csv", "--securities", f"{raw}/securities.csv",
        "--fx", f"{raw}/fx.csv", "--out", f"{raw}/{out}", *more,
    ]


def test_prices_by_range_and_replay(spark, raw):
    ranged = jobs.main(prices_args(raw, "--first-year", "2012", "--last-year", "2013"))
    counted = {k: v for k, v in ranged.items() if not k.startswith("null_")}
    assert counted == {"read": 81, "undated": 1, "rows": 80, "without_sector": 40, "without_rate": 40}
    assert ranged["null_sma10"] == 4 * 9 and ranged["null_close_price"] == 0
    assert [r.symbol for r in spark.read.parquet(f"{raw}/out_rejected").collect()] == ["A"]
    for run in ("2025-01-18T08:00:00", "2025-01-19T00:00:00"):
        jobs.main(prices_args(raw, "--run-at", run, "--start-at", "2025-01-18", out="replayed"))
    one, other = commits.scan(spark, f"{raw}/out"), commits.scan(spark, f"{raw}/replayed")
    assert one.exceptAll(other).count() == 0 and other.count() == 80
    again = jobs.main(prices_args(raw, "--first-year", "2012"))
    assert again["rows"] == 40 and commits.scan(spark, f"{raw}/out").count() == 80
    jobs.main(prices_args(raw, "--first-year", "2012", "--mode", "append"))
    assert commits.scan(spark, f"{raw}/out").count() == 120


def test_whole_history_windows(spark, raw):
    jobs.main(prices_args(raw, "--first-year", "2012", "--last-year", "2013", "--continuous"))
    seen = commits.scan(spark, f"{raw}/out").where("sma10 IS NOT NULL").count()
    assert seen == 2 * (40 - 9)
    before = sorted(map(repr, commits.scan(spark, f"{raw}/out").collect()))
    jobs.main(prices_args(raw, "--first-year", "2013", "--continuous"))
    assert sorted(map(repr, commits.scan(spark, f"{raw}/out").collect())) == before


def test_years_without_rows_are_emptied_when_replaced(spark, raw):
    jobs.main(prices_args(raw, "--first-year", "2012", "--last-year", "2013"))
    text = (raw / "prices.csv").read_text()
    (raw / "prices.csv").write_text("".join(line for line in text.splitlines(True) if not line.startswith("2013")))
    jobs.main(prices_args(raw, "--first-year", "2013"))
    assert {r.run_year for r in commits.scan(spark, f"{raw}/out").select("run_year").distinct().collect()} == {2012}


def test_dates_with_a_time_are_read_and_lost_ones_stop_the_job(spark, raw):
    lines = ["date,symbol,open,close,low,high,volume"]
    lines += [f"2012-01-{d:02d} 00:00:00,A,1,{d},1,1,1" for d in range(1, 11)]
    lines += [f"2012-02-{d:02d}T23:30:00.000Z,A,1,{d},1,1,1" for d in range(1, 11)]
    (raw / "prices.csv").write_text("\n".join(lines) + "\n")
    got = jobs.main(prices_args(raw, "--first-year", "2012"))
    assert (got["rows"], got["undated"]) == (20, 0)
    (raw / "prices.csv").write_text("\n".join([*lines, *["03/04/2012,A,1,1,1,1,1"] * 3]) + "\n")
    with pytest.raises(ValueError, match="3 of 23"):
        jobs.main(prices_args(raw, "--first-year", "2012"))
    (raw / "prices.csv").write_text("\n".join([*lines, "03/04/2012,A,1,1,1,1,1"]) + "\n")
    got = jobs.main(prices_args(raw, "--first-year", "2012", "--date-format", "MM/dd/yyyy"))
    assert (got["rows"], got["undated"]) == (21, 0)


def test_rates_landed_year_by_year_keep_the_rows(spark, raw):
    payload = '{"data": {"THB": {"value": 31.5}}}'
    for year in (2012, 2013):
        days = [date(year + m // 12, m % 12 + 1, 1) for m in range(13)]
        spark.createDataFrame([(str(d), payload) for d in days], "request_date string, payload string").write.json(f"{raw}/pay{year}")
        jobs.main(["fx", "--payloads", f"{raw}/pay{year}", "--out", f"{raw}/rates/{year}", "--first-year", str(year)])
    args = prices_args(raw, "--first-year", "2012", "--last-year", "2013")
    args[args.index("--fx") + 1] = f"{raw}/rates/*"
    got = jobs.main(args)
    assert (got["rows"], got["without_rate"]) == (80, 0)
    (raw / "rates" / "2014").mkdir()
    (raw / "rates" / "2014" / "more.csv").write_text(
        "exchange_date,curency_base,usd_value,curency_target,exchange_rate\n2013-01-01,USD,1,EUR,0.9\n2013-01-01,USD,1,THB,30.0\n")
    with pytest.raises(Exception, match="exchange rates differ in 2013-01"):
        jobs.main(args)


def test_the_price_job_reads_its_input_once(spark, raw, monkeypatch):
    asked = []
    scan = jobs.read
    monkeypatch.setattr(jobs, "read", lambda *a: asked.append(a[2]) or scan(*a))
    plans = []
    save = jobs.save
    monkeypatch.setattr(jobs, "save", lambda df, *a: plans.append(df._jdf.queryExecution().executedPlan().toString()) or save(df, *a))
    jobs.main(prices_args(raw, "--first-year", "2012"))
    assert sum(p.endswith("prices.csv") for p in asked) == 1 and plans[0].count("FileScan csv") == 3
    assert "rangepartitioning" not in plans[0]


def test_dated_folders_and_warehouse_appends(spark, raw, monkeypatch):
    jobs.main(prices_args(raw, "--run-at", "2025-01-18T08:00:00", "--start-at", "2025-01-18", "--dated"))
    assert commits.scan(spark, f"{raw}/out/published/prices/2025-01-18").count() == 40
    sent = []
    monkeypatch.setattr(tables, "append_to_warehouse", lambda df, source, **options: sent.append((df.count(), source, options)))
    jobs.main(prices_args(raw, "--first-year", "2012", "--sink", "bigquery", "--sink-option", "table=a.b"))
    assert sent == [(40, "bigquery", {"table": "a.b"})]


def test_empty_and_sparse_documents_give_typed_tables(spark, raw):
    (raw / "docs").mkdir()
    (raw / "docs" / "a.json").write_text("")
    args = prices_args(raw, "--source", "json", "--first-year", "2012", out="none")
    args[2] = f"{raw}/docs"
    assert jobs.main(args)["rows"] == 0
    (raw / "docs" / "a.json").write_text(
        '{"date": {"$date": "2012-01-03T00:00:00Z"}, "symbol": "A", "close": 1.5}\n'
        '{"date": {"$date": 1325635200000}, "symbol": "A", "close": 2.5, "volume": 7.0}\n'
        '{"date": {"$date": {"$numberLong": "1325721600000"}}, "symbol": "A"}\n')
    assert jobs.main(args)["rows"] == 3
    found = commits.scan(spark, f"{raw}/none").orderBy("date").collect()
    assert [(r.date, r.close_price, r.volume) for r in found] == [
        (date(2012, 1, 3), 1.5, None), (date(2012, 1, 4), 2.5, 7), (date(2012, 1, 5), None, None)]


def test_missing_parameters_stop_before_any_work(raw):
    for more in ((), ("--run-at", "2025-01-18"), ("--first-year", "2013", "--last-year", "2012")):
        with pytest.raises(ValueError):
            jobs.main(prices_args(raw, *more))


def test_repeated_keys_stop_the_job_unless_allowed(spark, raw, monkeypatch):
    with open(raw / "prices.csv", "a") as f:
        f.write("2012-01-05,A,1,5,1,5,500\n")
    with pytest.raises(ValueError, match="share"):
        jobs.main(prices_args(raw, "--first-year", "2012"))
    assert not (raw / "out" / "_commits").exists()
    monkeypatch.setattr(jobs.prices, "BLOCK_ROWS", 15)
    got = jobs.main(prices_args(raw, "--first-year", "2012", "--allow-duplicates"))
    assert got["rows"] == 41


def test_repeated_tickers_stop_the_job(raw):
    with open(raw / "securities.csv", "a") as f:
        f.write("A,Acme,Energy,Refining\n")
    with pytest.raises(ValueError, match="Ticker"):
        jobs.main(prices_args(raw, "--first-year", "2012"))


def test_fundamentals(spark, raw):
    (raw / "fund.csv").write_text(
        "Id,Ticker Symbol,Period Ending,Total Revenue,Gross Profit,Total Liabilities,Long-Term Debt\n"
        "0,A,2012-12-31,10,5,3,\n1,B,2013-12-31,10,5,3,1\n"
    )
    got = jobs.main([
        "fundamentals", "--fundamentals", f"{raw}/fund.csv", "--securities", f"{raw}/securities.csv",
        "--out", f"{raw}/f", "--first-year", "2012", "--last-year", "2013",
    ])
    assert {k: v for k, v in got.items() if not k.startswith("null_")} == {
        "read": 2, "undated": 0, "rows": 2, "without_sector": 1}
    assert got["null_long_term_debt"] == 1
    assert {(r.ticker_symbol_fund, r.run_year) for r in commits.scan(spark, f"{raw}/f").collect()} == {
        ("A", 2012), ("B", 2013)
    }


def test_fx_from_service_and_from_landed_payloads(spark, raw):
    days = [date(2012 + m // 12, m % 12 + 1, 1) for m in range(13)]
    payload = '{"data": {"EUR": {"value": 0.9}, "THB": {"value": 31.5}}}'
    for d in days:
        (raw / f"{d}.json").write_text(payload)
    landed = spark.createDataFrame([(str(d), payload) for d in days], "request_date string, payload string")
    landed.write.json(f"{raw}/payloads")
    asked = ["--first-year", "2012"]
    live = jobs.main(["fx", "--url", f"file://{raw}/{{date}}.json", "--out", f"{raw}/live", *asked])
    stored = jobs.main(["fx", "--payloads", f"{raw}/payloads", "--out", f"{raw}/stored", *asked])
    assert live == stored == {"asked": 13, "received": 13, "unreadable": 0}
    one, other = (spark.read.csv(f"{raw}/{n}", header=True) for n in ("live", "stored"))
    assert one.exceptAll(other).count() == 0 and one.first().curency_target == "THB"


def test_json_and_parquet_sources(spark, raw):
    rows = [(datetime(2012, 1, d), "A", 1.0, float(d), 1.0, 2.0, d) for d in range(1, 12)]
    df = spark.createDataFrame(rows, "date timestamp_ntz, symbol string, open double, close double, low double, high double, volume bigint")
    tables.write_parquet(df, f"{raw}/p")
    df.withColumn("date", df.date.cast("date").cast("string")).write.json(f"{raw}/j")
    for source, path in (("parquet", "p"), ("json", "j")):
        args = prices_args(raw, "--source", source, "--first-year", "2012", out=f"from_{source}")
        args[2] = f"{raw}/{path}"
        assert jobs.main(args)["rows"] == 11
    one, other = (commits.scan(spark, f"{raw}/from_{s}") for s in ("parquet", "json"))
    assert one.exceptAll(other).count() == 0


def test_fundamentals_count_undated_rows_and_check_keys(spark, raw):
    head = "Ticker Symbol,Period Ending,Total Revenue,Gross Profit,Total Liabilities,Long-Term Debt\n"
    args = ["fundamentals", "--fundamentals", f"{raw}/fund.csv", "--securities", f"{raw}/securities.csv",
            "--out", f"{raw}/f", "--first-year", "2012"]
    (raw / "fund.csv").write_text(head + "A,2012-12-31,10,5,3,1\nB,12/31/2012,10,5,3,1\n")
    with pytest.raises(ValueError, match="1 of 2"):
        jobs.main(args)
    assert jobs.main([*args, "--max-undated", "0.5"])["undated"] == 1
    (raw / "fund.csv").write_text(head + "A,2012-12-31,10,5,3,1\n" * 2)
    with pytest.raises(ValueError, match="Period Ending"):
        jobs.main(args)


def test_missing_and_unreadable_rates_stop_the_job_unless_allowed(spark, raw):
    rows = [("2012-01-01", '{"message": "rate limit"}'), ("2012-02-01", '{"data": {"THB": {"value": 31.5}}}')]
    spark.createDataFrame(rows, "request_date string, payload string").write.json(f"{raw}/payloads")
    args = ["fx", "--payloads", f"{raw}/payloads", "--out", f"{raw}/rates", "--first-year", "2012"]
    with pytest.raises(ValueError, match="rates are missing"):
        jobs.main(args)
    assert jobs.main([*args, "--allow-missing"]) == {"asked": 13, "received": 2, "unreadable": 1}


def test_refused_runs_leave_the_table_as_it_was(spark, raw):
    good = prices_args(raw, "--first-year", "2012", "--last-year", "2013")
    jobs.main(good)
    before = sorted(map(repr, commits.scan(spark, f"{raw}/out").collect()))
    text = (raw / "prices.csv").read_text()
    (raw / "prices.csv").write_text(text.replace("2013-01-1", "13.1.1"))
    for mode in ("replace", "append"):
        with pytest.raises(commits.Refused, match="20 of|21 of"):
            jobs.main([*good, "--mode", mode])
        assert sorted(map(repr, commits.scan(spark, f"{raw}/out").collect())) == before
    assert spark.read.parquet(f"{raw}/out_rejected").count() == 21
    assert commits.history(spark, f"{raw}/out").select("commit").distinct().count() == 1
    (raw / "prices.csv").write_text(text + "2013-01-05,A,1,5,1,5,500\n")
    with pytest.raises(ValueError, match="share"):
        jobs.main(good)
    assert sorted(map(repr, commits.scan(spark, f"{raw}/out").collect())) == before


def test_a_repeated_append_of_one_run_adds_nothing(spark, raw):
    args = prices_args(raw, "--first-year", "2012", "--mode", "append")
    first = jobs.main([*args, "--run-id", "monday"])
    again = jobs.main([*args, "--run-id", "monday"])
    assert again == first and commits.scan(spark, f"{raw}/out").count() == first["rows"] == 40
    jobs.main([*args, "--run-id", "tuesday"])
    assert commits.scan(spark, f"{raw}/out").count() == 80
    reports = commits.history(spark, f"{raw}/out").collect()
    assert {r.id for r in reports} == {"monday", "tuesday"} and all('"undated": 1' in r.report for r in reports)


def test_counts_of_repeated_tasks_are_taken_again(spark, raw, monkeypatch):
    seen = jobs.observed

    def twice(observation, **empty):
        found = dict(seen(observation, **empty))
        return {**found, "read": found["read"] + 40} if "read" in found else {**found, "rows": found["rows"] + 1}

    monkeypatch.setattr(jobs, "observed", twice)
    got = jobs.main(prices_args(raw, "--first-year", "2012", "--last-year", "2013"))
    assert (got["read"], got["undated"], got["rows"]) == (81, 1, 80)


def test_a_warehouse_gets_only_audited_rows(spark, raw, monkeypatch):
    sent = []
    monkeypatch.setattr(tables, "append_to_warehouse", lambda df, source, **options: sent.append(df.count()))
    (raw / "prices.csv").write_text((raw / "prices.csv").read_text().replace("2012-01-0", "12.1.0"))
    with pytest.raises(commits.Refused):
        jobs.main(prices_args(raw, "--first-year", "2012", "--sink", "bigquery"))
    assert not sent
