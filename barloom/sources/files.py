"""Readers for landed files and the document store."""

import csv
from datetime import date, datetime, timezone
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.columns import column, conform, project, resolve


def _landed(columns, schema: T.StructType) -> T.StructType:
    """The reading types of named columns: fractions as such; text where the schema wants a date or an
    integer, whose spelling may vary."""
    fractions = {f.name.lower() for f in schema.fields if isinstance(f.dataType, T.FractionalType)}
    return T.StructType([
        T.StructField(c, T.DoubleType() if c.lower() in fractions else T.StringType()) for c in columns
    ])


def scan_csv(spark: SparkSession, path, schema: T.StructType, infer=False, formats=(), zone="UTC",
             **options) -> DataFrame:
    """Read CSV with a header. Columns are found by name and given the schema's types.

    Files with other columns, or in another order, than the first stop the reading with an
    error; ``scan_csv_parts`` reads them. ``infer`` keeps the types Spark infers instead (one
    more pass over the file). ``formats`` and ``zone`` are those of ``conform``.
    """
    reader = spark.read.options(header=True, inferSchema=infer, enforceSchema=False, **options)
    raw = reader.csv(path)
    if not raw.columns:
        return spark.createDataFrame([], schema)
    if infer:
        return project(raw, schema.names)
    return conform(reader.schema(_landed(raw.columns, schema)).csv(path), schema, formats, zone)


def first_lines(spark: SparkSession, path) -> DataFrame:
    """``(file, line)``: the first line with text of every file that has one, by one job over the raw lines."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"))
    # Lines of a file's first block are in one task and numbered in their order.
    led = lines.where((F.col("block") == 0) & (F.trim("value") != ""))
    return led.groupBy("file").agg(F.min_by("value", "at").alias("line"))


def csv_headers(spark: SparkSession, path, sep=",", quote='"') -> dict[tuple, list[str]]:
    """The files of each header, as one row per file: lists that Spark's own file index holds too."""
    found = {}
    for r in sorted(first_lines(spark, path).collect()):
        names = tuple(next(csv.reader([r.line.removeprefix("\ufeff")], delimiter=sep, quotechar=quote)))
        found.setdefault(names, []).append(unquote(r.file))
    return found


def header_report(spark: SparkSession, path, schema: T.StructType, **options) -> DataFrame:
    """``(columns, files, missing, further)``: each header with the contract's columns it lacks and those beyond it."""
    wanted = {n.lower(): n for n in schema.names}
    rows = [
        (list(names), len(files), [n for low, n in wanted.items() if low not in {c.lower() for c in names}],
         [c for c in names if c.lower() not in wanted])
        for names, files in sorted(csv_headers(spark, path, **options).items())
    ]
    return spark.createDataFrame(rows, "columns ARRAY<STRING>, files INT, missing ARRAY<STRING>, further ARRAY<STRING>")


def scan_csv_parts(spark: SparkSession, path, schema: T.StructType, formats=(), zone="UTC", sep=",", quote='"',
                   **options) -> DataFrame:
    """Read CSV files whose headers differ in order or in further columns.

    The headers of all files are found first, by one job however many files there are; files of one header are read
    together and all are joined by column name. A missing column of the schema is an error.
    """
    reader = spark.read.options(header=True, enforceSchema=False, sep=sep, quote=quote, **options)
    parts = [
        conform(reader.schema(_landed(columns, schema)).csv(found), schema, formats, zone)
        for columns, found in sorted(csv_headers(spark, path, sep, quote).items())
    ]
    if not parts:
        return spark.createDataFrame([], schema)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def text_schema(schema: T.StructType) -> T.StructType:
    """The columns of a contract as text, for documents, whose values are spelled in many ways."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def scan_documents(spark: SparkSession, path, schema=None) -> DataFrame:
    """Read JSON documents as a table; without a schema, the columns of all documents."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(path)


def scan_collection(spark: SparkSession, schema=None, **options) -> DataFrame:
    """Read a document-store collection through its Spark connector, if on the classpath."""
    reader = spark.read.format("mongodb").options(**options)
    return (reader.schema(schema) if schema is not None else reader).load()


def scan_parquet(spark: SparkSession, path) -> DataFrame:
    return spark.read.parquet(path)


def slice_range(df: DataFrame, name, start=None, end=None) -> DataFrame:
    """Rows with ``start <= name < end``, a filter that sources can prune by; None is open.

    Bounds that are dates begin at midnight in UTC where the column is a TIMESTAMP, whatever the
    session's time zone is.
    """
    c = column(df, name)
    instants = isinstance(df.schema[resolve(df, name)].dataType, T.TimestampType)

    def bound(value):
        if instants and isinstance(value, date) and not isinstance(value, datetime):
            return F.lit(datetime(value.year, value.month, value.day, tzinfo=timezone.utc))
        return F.lit(value)

    if start is not None:
        df = df.where(c >= bound(start))
    return df if end is None else df.where(c < bound(end))


def slice_years(df: DataFrame, name, first_year, last_year=None) -> DataFrame:
    """Rows of the calendar years ``first_year`` to ``last_year``, both included."""
    last_year = first_year if last_year is None else last_year
    return slice_range(df, name, date(first_year, 1, 1), date(last_year + 1, 1, 1))
