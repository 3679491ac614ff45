import tempfile
from datetime import date, datetime

import pytest
from pyspark.sql import types as T

from barloom.operators import columns
from barloom.schemas import RAW_FX, RAW_PRICES
from barloom.sinks import tables
from barloom.sources import files
from barloom.sources.fx_api import FxHistory, month_starts
from barloom.sources.workspace import work_folder


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = write(tmp_path / "p.csv", (
        "_id,symbol,Date,volume,open,close,low,high,note\n"
        "1,A,2012-01-03,12,1.5,2.5,1.0,3.0,\"x, y\"\n"
        "2,B,2012-01-03 00:00:00,many,,2,1,3,\n"
        "3,C,2012-01-04,2163600.0,x,2,1,3,\n"
        "4,D,2012-01-05,0.5,1,2,1,3,\n"
    ))
    df = files.scan_csv(spark, path, RAW_PRICES)
    assert df.schema == RAW_PRICES
    assert [tuple(r) for r in df.collect()] == [
        (date(2012, 1, 3), "A", 1.5, 2.5, 1.0, 3.0, 12), (date(2012, 1, 3), "B", None, 2.0, 1.0, 3.0, None),
        (date(2012, 1, 4), "C", None, 2.0, 1.0, 3.0, 2163600), (date(2012, 1, 5), "D", 1.0, 2.0, 1.0, 3.0, None),
    ]


def test_csv_without_header_line_is_an_empty_table(spark, tmp_path):
    df = files.scan_csv(spark, write(tmp_path / "empty.csv", "\n"), RAW_PRICES)
    assert df.schema == RAW_PRICES and df.count() == 0


def test_empty_table_survives_csv(spark, tmp_path):
    path = str(tmp_path / "out")
    tables.write_csv(spark.createDataFrame([], RAW_FX), path)
    df = files.scan_csv(spark, path, RAW_FX)
    assert df.schema == RAW_FX and df.count() == 0


def test_inferred_types(spark, tmp_path):
    path = write(tmp_path / "p.csv", "date,symbol,open,close,low,high,volume\n2012-01-03,A,1,2.5,1,3,9999999999\n")
    df = files.scan_csv(spark, path, RAW_PRICES, infer=True)
    assert dict(df.dtypes)["date"] == "date" and dict(df.dtypes)["volume"] == "bigint"


def test_documents_give_the_union_of_their_fields(spark, tmp_path):
    path = write(tmp_path / "d.json", '{"a": 1, "b": "x"}\n{"a": 2, "c": 1.5}\n')
    df = files.scan_documents(spark, path)
    assert sorted(df.columns) == ["a", "b", "c"]
    assert {tuple(r[c] for c in "abc") for r in df.collect()} == {(1, "x", None), (2, None, 1.5)}


def test_append_doubles_and_replace_does_not(spark, tmp_path):
    def rows(year, value):
        return spark.createDataFrame([(year, value)], "run_year int, v int")

    appended, replaced = str(tmp_path / "a"), str(tmp_path / "r")
    for year, value in ((2012, 1), (2013, 2), (2013, 3)):
        tables.append_load(rows(year, value), appended)
        tables.idempotent_load(rows(year, value), replaced)

    def read(path):
        return sorted((r.run_year, r.v) for r in files.scan_parquet(spark, path).collect())

    assert read(appended) == [(2012, 1), (2013, 2), (2013, 3)]
    assert read(replaced) == [(2012, 1), (2013, 3)]


def test_dataset_path():
    assert tables.dataset_path("s3://b/", "raw", "prices", date(2025, 1, 18)) == "s3://b/raw/prices/2025-01-18"


def test_work_folder_is_new_and_shared_where_a_shared_one_is_named(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None) or tempfile.gettempdir()
    one, other = work_folder(spark), work_folder(spark)
    assert one.startswith(shared) and one != other


def test_month_starts_include_both_ends():
    assert len(month_starts(date(2012, 1, 1), date(2013, 1, 1))) == 13
    assert month_starts(date(2012, 12, 1), date(2013, 1, 1)) == [date(2012, 12, 1), date(2013, 1, 1)]


@pytest.fixture
def fx_files(tmp_path):
    for m in month_starts(date(2012, 1, 1), date(2013, 1, 1)):
        write(tmp_path / f"{m}.json", f'{{"data": {{"THB": {{"value": {30 + m.month / 4}}}}}}}')
    return f"file://{tmp_path}/{{date}}.json"


def test_csv_parts_with_other_headers(spark, tmp_path):
    (tmp_path / "p").mkdir()
    write(tmp_path / "p" / "a.csv", "date,symbol,open,close,low,high,volume\n2012-01-03,A,1,2,3,4,5\n")
    write(tmp_path / "p" / "b.csv", "date,symbol,close,open,low,high,volume,note\n2012-01-04,A,2,1,3,4,5,x\n")
    write(tmp_path / "p" / "c.csv", "")
    expected = [(date(2012, 1, d), "A", 1.0, 2.0, 3.0, 4.0, 5) for d in (3, 4)]
    assert sorted(map(tuple, files.scan_csv_parts(spark, f"{tmp_path}/p", RAW_PRICES).collect())) == expected
    with pytest.raises(Exception, match="(?i)header"):
        files.scan_csv(spark, f"{tmp_path}/p/[ab].csv", RAW_PRICES).collect()


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Bangkok"])
def test_days_do_not_depend_on_the_session(spark, zone):
    texts = ["2012-01-03", "2012-01-03 00:00:00", "2012-01-03T00:00:00.000Z", "2012-01-03T23:59:59Z", "2012-01-04T02:00:00+07:00",
             "2012", "10:30", "junk", "2012-13-01", None]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in texts], "date string")
        day = T.StructType([T.StructField("date", T.DateType())])
        assert [r.date for r in columns.conform(df, day).collect()] == [date(2012, 1, 3)] * 5 + [None] * 5
        instants = spark.sql("select timestamp_seconds(1325548800) date union all select timestamp_seconds(1325635199)")
        assert {r.date for r in columns.conform(instants, day).collect()} == {date(2012, 1, 3)}
        assert columns.conform(instants, day, zone="Asia/Bangkok").distinct().count() == 2
        assert files.slice_range(instants, "date", date(2012, 1, 3), date(2012, 1, 4)).count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_rate_service_asks_once_per_month(spark, fx_files):
    spark.dataSource.register(FxHistory)
    df = spark.read.format("fx_history").options(url=fx_files, first="2012-01-01", last="2013-01-01").load()
    rows = df.collect()
    assert df.rdd.getNumPartitions() == 4 and len(rows) == 13
    assert dict(rows)["2012-02-01"] == '{"data": {"THB": {"value": 30.5}}}'


def test_documents_with_timestamps_slice_by_date(spark):
    df = spark.createDataFrame([(datetime(2012, 12, 31, 23, 59),), (datetime(2013, 1, 1),)], "date timestamp_ntz")
    assert files.slice_years(df, "date", 2012).count() == 1


def test_headers_of_many_files_take_the_jobs_of_few(spark, tmp_path):
    folder = tmp_path / "many files"
    folder.mkdir()
    heads = ["date,symbol,open,close,low,high,volume", "symbol,date,close,open,low,high,volume,\"no,te\"", "﻿date;symbol"]
    for i in range(40):
        swapped = i % 2
        row = "A,2012-01-03,2,1,3,4,5,x" if swapped else "2012-01-03,A,1,2,3,4,5"
        write(folder / f"{i} é.csv", f"\n\n{heads[swapped]}\n{row}\n" if i % 3 else f"{heads[swapped]}\n{row}\n")
    write(folder / "blank.csv", "\n \n")

    def jobs(path):
        group = str(path)
        spark.sparkContext.setJobGroup(group, group)
        try:
            df = files.scan_csv_parts(spark, str(path), RAW_PRICES)
            return df, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    many, count = jobs(folder)
    few, least = jobs(folder / "[0-3] *.csv")
    assert {tuple(r) for r in many.collect()} == {(date(2012, 1, 3), "A", 1.0, 2.0, 3.0, 4.0, 5)} and many.count() == 40
    assert few.count() == 4 and count <= least + 4
    report = files.header_report(spark, str(folder), RAW_PRICES).orderBy("columns").collect()
    assert [(r.files, r.missing, r.further) for r in report] == [(20, [], []), (20, [], ["no,te"])]
    write(folder / "short.csv", "date,symbol\n2012-01-03,A\n")
    assert files.header_report(spark, str(folder), RAW_PRICES).where("size(missing) = 5").first().files == 1
    with pytest.raises(ValueError, match="open"):
        files.scan_csv_parts(spark, str(folder), RAW_PRICES)
