from datetime import date

import pytest

from barloom import jobs
from barloom.sources.fx_api import FxHistoryStream, dealt, month_starts
from barloom.streaming.rates import land_rates, landed_payloads, missing_months


def answer(folder, day, rate):
    (folder / f"{day}.json").write_text(f'{{"data": {{"THB": {{"value": {rate}}}}}}}')


@pytest.fixture
def service(tmp_path):
    folder = tmp_path / "service"
    folder.mkdir()
    for m in month_starts(date(2012, 1, 1), date(2013, 6, 1)):
        answer(folder, m, 30 + m.month / 4)
    return folder


def test_only_months_that_are_not_landed_are_asked_for(spark, tmp_path, service):
    landing, progress = str(tmp_path / "landing"), str(tmp_path / "progress")

    def run(last):
        return land_rates(spark, f"file://{service}/{{date}}.json", date(2012, 1, 1), last, landing, progress, parallel="3", retries="0")

    def rates():
        return dict(map(tuple, landed_payloads(spark, landing).collect()))

    (service / "2012-03-01.json").unlink()
    (service / "2012-05-01.json").write_text('{"message": "rate limit"}')
    assert run(date(2012, 6, 1)) == {"landed": 4, "asked": 6, "missing": ["2012-03-01", "2012-05-01"]}
    # What is landed is not asked for again, or the other rates would come.
    for m in month_starts(date(2012, 1, 1), date(2012, 6, 1)):
        answer(service, m, 99)
    assert run(date(2012, 6, 1)) == {"landed": 6, "asked": 2, "missing": []}
    assert {d for d, p in rates().items() if "99" in p} == {"2012-03-01", "2012-05-01"}
    for m in month_starts(date(2012, 1, 1), date(2012, 6, 1)):
        answer(service, m, 77)
    assert run(date(2012, 6, 1)) == {"landed": 6, "asked": 0, "missing": []} and not any("77" in p for p in rates().values())
    assert run(date(2012, 9, 1)) == {"landed": 9, "asked": 3, "missing": []}
    (service / "2012-11-01.json").unlink()
    assert run(date(2012, 12, 1)) == {"landed": 11, "asked": 3, "missing": ["2012-11-01"]}
    assert run(date(2012, 12, 1)) == {"landed": 11, "asked": 1, "missing": ["2012-11-01"]}
    assert missing_months(spark, landing) == ["2012-11-01"] and len(rates()) == 12


def test_offsets_repeat_a_batch_as_it_was():
    options = {"url": "x", "first": "2012-01-01", "last": "2012-06-01", "again": "2011-12-01", "round": "7", "parallel": "2"}
    stream = FxHistoryStream(options)
    start, end = {"upto": "2012-04-01", "again": [], "round": "6"}, stream.latestOffset()
    assert [p.days for p in stream.partitions(start, end)] == [["2011-12-01", "2012-06-01"], ["2012-05-01"]]
    assert stream.partitions(end, end) == []
    first = stream.partitions(stream.initialOffset(), end)
    assert sorted(d for p in first for d in p.days) == ["2011-12-01", *[f"2012-{m:02d}-01" for m in range(1, 7)]]
    later = FxHistoryStream({**options, "last": "2012-09-01", "again": "", "round": ""})
    assert [d for p in later.partitions(start, end) for d in p.days] == ["2011-12-01", "2012-06-01", "2012-05-01"]


def test_one_pace_for_all_tasks():
    parts = dealt([str(i) for i in range(7)], 3)
    turns = sorted((p.turn + at * p.turns, d) for p in parts for at, d in enumerate(p.days))
    assert [t for t, _ in turns] == list(range(7)) and [d for _, d in turns] == [str(i) for i in range(7)]
    assert dealt([], 3) == []


def test_the_job_lands_only_what_is_missing(spark, tmp_path, service):
    args = ["fx", "--url", f"file://{service}/{{date}}.json", "--landing", f"{tmp_path}/landing", "--out", f"{tmp_path}/rates",
            "--first-year", "2012", "--pause", "0"]
    (service / "2012-07-01.json").write_text("{}")
    with pytest.raises(ValueError, match="missing"):
        jobs.main(args)
    answer(service, "2012-07-01", 31)
    assert jobs.main(args) == {"asked": 13, "requested": 1, "received": 13, "unreadable": 0}
    assert jobs.main(args)["requested"] == 0
    assert spark.read.csv(f"{tmp_path}/rates", header=True).count() == 13
