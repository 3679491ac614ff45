"""Zone maps of landed documents: each file's first and last date, so that a slice opens only files it needs.

A map is a Parquet table that ``measure`` adds to. Its rows name a file with its size and time of change; a file
that was written again or is new finds no such row, and is opened by every slice until it is measured.
"""

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.columns import conform
from barloom.sources.files import scan_documents, slice_range, text_schema

ZONES = "uri STRING, bytes BIGINT, changed TIMESTAMP, first DATE, last DATE, rows BIGINT, undated BIGINT"
IDENTITY = ["uri", "bytes", "changed"]


@dataclass(frozen=True)
class Choice:
    """The files that a slice opens, how many the folder has, and how many of those opened are not measured."""

    files: list[str]
    listed: int
    unmeasured: int


def listing(spark: SparkSession, path) -> DataFrame:
    """``(file, uri, bytes, changed)`` of the files that are there now; none is opened."""
    found = spark.read.format("binaryFile").load(path)
    return found.select(
        F.col("path").alias("file"), F.col("_metadata.file_path").alias("uri"), F.col("length").alias("bytes"),
        F.col("modificationTime").alias("changed"))


def zones(spark: SparkSession, folder) -> DataFrame:
    """The stored map; none is an empty one. A measurement that was repeated counts once."""
    try:
        return spark.read.schema(ZONES).parquet(folder).distinct()
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ZONES)


def _matched(spark, path, folder) -> DataFrame:
    return listing(spark, path).join(zones(spark, folder), IDENTITY, "left")


def measure(spark: SparkSession, path, folder, schema: T.StructType, name, formats=(), zone="UTC") -> int:
    """Add the files of ``path`` that the map in ``folder`` does not know, as they are now; returns their number.

    Only those files are read, and of their documents only the date ``name``.
    """
    fresh = _matched(spark, path, folder).where("rows IS NULL").select("file", *IDENTITY).collect()
    if not fresh:
        return 0
    day = T.StructType([schema[name]])
    raw = scan_documents(spark, [r.file for r in fresh], text_schema(day)).select("*", F.col("_metadata.file_path").alias("_uri"))
    dated = conform(raw, T.StructType([*day.fields, T.StructField("_uri", T.StringType())]), formats, zone)
    value = F.col(f"`{name}`")
    found = dated.groupBy(F.col("_uri").alias("uri")).agg(
        F.min(value).alias("first"), F.max(value).alias("last"), F.count("*").alias("rows"),
        F.count_if(value.isNull()).alias("undated"))
    listed = spark.createDataFrame([(r.uri, r.bytes, r.changed) for r in fresh], "uri STRING, bytes BIGINT, changed TIMESTAMP")
    none = F.lit(0).cast("bigint")
    measured = listed.join(found, "uri", "left").select(
        *IDENTITY, "first", "last", F.coalesce("rows", none).alias("rows"), F.coalesce("undated", none).alias("undated"))
    measured.coalesce(1).write.mode("append").parquet(folder)
    return len(fresh)


def choose(spark: SparkSession, path, folder, start=None, end=None, undated=False) -> Choice:
    """The files that may hold a row with ``start <= date < end``, by the map; None is open.

    With ``undated``, also those that hold rows without a readable date.
    """
    known = _matched(spark, path, folder)
    overlaps = F.col("rows") > 0
    if start is not None:
        overlaps = overlaps & (F.col("last") >= F.lit(start))
    if end is not None:
        overlaps = overlaps & (F.col("first") < F.lit(end))
    unmeasured = F.col("rows").isNull()
    wanted = unmeasured | F.coalesce(overlaps, F.lit(False))
    if undated:
        wanted = wanted | (F.col("undated") > 0)
    # One row per file, as in Spark's own file index.
    rows = known.select("file", unmeasured.alias("unmeasured"), wanted.alias("wanted")).collect()
    return Choice(sorted(r.file for r in rows if r.wanted), len(rows), sum(r.unmeasured for r in rows))


def scan(spark: SparkSession, path, folder, schema: T.StructType, start=None, end=None, undated=False) -> DataFrame:
    """The documents of the chosen files, as text by the contract ``schema``."""
    landed = text_schema(schema)
    chosen = choose(spark, path, folder, start, end, undated).files
    return scan_documents(spark, chosen, landed) if chosen else spark.createDataFrame([], landed)


def slice_documents(spark: SparkSession, path, folder, schema: T.StructType, name, start=None, end=None, formats=(),
                    zone="UTC") -> DataFrame:
    """The rows with ``start <= name < end`` in the schema's columns and types, from the files that may hold any.

    ``folder`` holds the map. Its answers do not change the rows: what it does not know is opened.
    """
    rows = conform(scan(spark, path, folder, schema, start, end), schema, formats, zone)
    return slice_range(rows, name, start, end)
