import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from barloom import jobs
from barloom.schemas import RAW_PRICES
from barloom.sinks import commits
from barloom.sources import zones


def landed(spark, folder, year, days, spelled=lambda d: {"$date": f"{d}T00:00:00Z"}):
    folder.mkdir(exist_ok=True)
    text = "".join(f'{{"date": {spelled(date(year, 1, 1) + timedelta(days=d))}, "symbol": "A", "close": {d}.5}}\n'.replace("'", '"') for d in days)
    (folder / f"{year} {min(days, default=0)}.json").write_text(text)


def sliced(spark, path, kept, start, end):
    return zones.slice_documents(spark, str(path), str(kept), RAW_PRICES, "date", start, end)


def opened(df):
    return {os.path.basename(r[0]).replace("%20", " ") for r in df.select(F.input_file_name()).distinct().collect()}


def test_a_slice_opens_only_files_that_overlap_it(spark, tmp_path):
    path, kept = tmp_path / "in put", tmp_path / "zones"
    for year in (2011, 2012, 2013):
        landed(spark, path, year, range(0, 300))
        landed(spark, path, year, range(300, 400))
    (path / "empty.json").write_text("")
    assert zones.measure(spark, str(path), str(kept), RAW_PRICES, "date") == 6
    assert zones.measure(spark, str(path), str(kept), RAW_PRICES, "date") == 0
    start, end = date(2012, 1, 1), date(2012, 3, 1)
    chosen = zones.choose(spark, str(path), str(kept), start, end)
    assert chosen.listed == 6 and chosen.unmeasured == 0
    assert {os.path.basename(f) for f in chosen.files} == {"2011 300.json", "2012 0.json"}
    found = sliced(spark, path, kept, start, end)
    whole = zones.slice_documents(spark, str(path), str(tmp_path / "no map"), RAW_PRICES, "date", start, end)
    assert opened(found) <= {"2011 300.json", "2012 0.json"}
    assert found.exceptAll(whole).count() == 0 and found.count() == whole.count() == 60 + 35
    assert sliced(spark, path, kept, date(1990, 1, 1), date(1991, 1, 1)).count() == 0
    assert len(zones.choose(spark, str(path), str(kept)).files) == 6


def test_stale_maps_are_noticed(spark, tmp_path):
    path, kept = tmp_path / "in", tmp_path / "zones"
    landed(spark, path, 2011, range(10))
    landed(spark, path, 2013, range(10))
    zones.measure(spark, str(path), str(kept), RAW_PRICES, "date")
    start, end = date(2012, 1, 1), date(2013, 1, 1)
    assert sliced(spark, path, kept, start, end).count() == 0
    # A file that is written again, and one that is new, are opened although the map says nothing of them.
    (path / "2011 0.json").write_text('{"date": "2012-05-05", "symbol": "B"}\n')
    landed(spark, path, 2012, range(3))
    chosen = zones.choose(spark, str(path), str(kept), start, end)
    assert chosen.unmeasured == 2 and len(chosen.files) == 2
    assert sliced(spark, path, kept, start, end).count() == 4
    (path / "2013 0.json").unlink()
    assert zones.measure(spark, str(path), str(kept), RAW_PRICES, "date") == 2
    chosen = zones.choose(spark, str(path), str(kept), start, end)
    assert (chosen.listed, chosen.unmeasured, len(chosen.files)) == (2, 0, 2)
    assert sliced(spark, path, kept, start, end).count() == 4


def test_dates_of_all_spellings_and_none(spark, tmp_path):
    path, kept = tmp_path / "in", tmp_path / "zones"
    landed(spark, path, 2012, range(5), lambda d: f"'{d} 10:00:00'")
    landed(spark, path, 2013, range(5), lambda d: "'soon'")
    zones.measure(spark, str(path), str(kept), RAW_PRICES, "date")
    found = {r.rows: r for r in zones.zones(spark, str(kept)).where("first IS NOT NULL").collect()}
    assert found[5].first == date(2012, 1, 1) and found[5].last == date(2012, 1, 5)
    assert len(zones.choose(spark, str(path), str(kept), date(2012, 1, 1)).files) == 1
    assert len(zones.choose(spark, str(path), str(kept), date(2012, 1, 1), undated=True).files) == 2


@pytest.mark.parametrize("more", [(), ("--continuous",)])
def test_the_job_answers_alike_with_a_map(spark, tmp_path, more):
    path = tmp_path / "in"
    for year in (2011, 2012, 2013):
        landed(spark, path, year, range(20))
    landed(spark, path, 2014, range(1), lambda d: "'soon'")
    (tmp_path / "s.csv").write_text("Ticker symbol,GICS Sector,GICS Sub Industry\nA,Energy,Drilling\n")
    (tmp_path / "fx.csv").write_text("exchange_date,curency_base,usd_value,curency_target,exchange_rate\n2012-01-01,USD,1,THB,31\n")

    def run(out, *given):
        return jobs.main(["prices", "--source", "json", "--prices", str(path), "--securities", f"{tmp_path}/s.csv", "--fx",
                          f"{tmp_path}/fx.csv", "--out", f"{tmp_path}/{out}", "--first-year", "2012", "--max-undated", "0.5", *more, *given])

    assert run("plain") == run("mapped", "--zones", f"{tmp_path}/zones")
    one, other = (commits.scan(spark, f"{tmp_path}/{n}") for n in ("plain", "mapped"))
    assert one.count() == 20 and one.exceptAll(other).count() == 0
