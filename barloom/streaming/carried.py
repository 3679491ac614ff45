"""Windows over the whole history, carried on from stored tails.

The tail of a year holds, for each symbol, the last rows before it that its windows look back on. Years that a
batch touches are computed from the tail before them and their own rows; a later year follows only if its
tail has changed. So a batch costs the years it touches, however long the history is.
"""

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.plans.prices import LOOKBACK, ORDER, price_metrics
from barloom.schemas import RAW_PRICES
from barloom.sinks.tables import idempotent_load, rebalanced

FOLDERS = re.compile(r"tail_year=(-?\d+)/batch=(\d+)/")
YEAR_FOLDER = re.compile(r"run_year=(-?\d+)/")
ROW = T.StructType([*RAW_PRICES.fields, T.StructField("run_year", T.IntegerType())])


def years_stored(history: DataFrame) -> list[int]:
    """The years of a history by the names of its folders; no file is opened."""
    return sorted({int(y) for f in history.inputFiles() for y in YEAR_FOLDER.findall(f)})


class Tails:
    """The stored tails: one folder per year and the batch that computed it."""

    def __init__(self, spark: SparkSession, folder):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.done = None, []

    def _all(self) -> DataFrame:
        schema = T.StructType([*ROW.fields, T.StructField("tail_year", T.IntegerType()), T.StructField("batch", T.LongType())])
        return self.spark.read.schema(schema).parquet(self.folder)

    def before(self, year, batch) -> DataFrame:
        """The rows before a year: of the latest tail up to it that a batch up to ``batch`` has computed."""
        try:
            found = {tuple(map(int, f)) for file in self._all().inputFiles() for f in FOLDERS.findall(file)}
        except AnalysisException:
            found = set()
        held = [(y, b) for y, b in found if y <= year and b <= batch]
        if not held:
            return self.spark.createDataFrame([], ROW)
        latest = max(y for y, _ in held)
        newest = max(b for y, b in held if y == latest)
        return self._all().where((F.col("tail_year") == latest) & (F.col("batch") == newest)).select(*ROW.names)

    def store(self, rows: DataFrame, years, batch):
        """Keep the tails after each of the ``years``, which are all years of the rows but those of the tail before.

        Years that lead on from those of the last call are computed from the tail that it stored, and theirs not again.
        """
        before, known = self.done
        self.done = batch, list(years)
        if before == batch and known and known == years[:len(known)] and len(known) < len(years):
            years = years[len(known):]
            rows = rows.where(F.col("run_year").isin(years)).select(*ROW.names)
            rows = rows.unionByName(self.before(years[0], batch)).repartition("symbol")
        ahead = F.lead("run_year", LOOKBACK).over(Window.partitionBy("symbol").orderBy(*ORDER))
        after = F.array(*[F.lit(y + 1) for y in years])
        placed = rows.withColumn("_ahead", ahead)
        within = F.filter(after, lambda y: (y > F.col("run_year")) & (F.col("_ahead").isNull() | (F.col("_ahead") >= y)))
        tails = placed.select(*ROW.names, F.explode(within).alias("tail_year"), F.lit(batch).cast("bigint").alias("batch"))
        (
            rebalanced(tails, "tail_year").write.partitionBy("tail_year", "batch")
            .mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.folder)
        )


def _signature(rows: DataFrame):
    """Number and order-free hashes of the rows."""
    hashed = F.xxhash64(*ROW.names)
    return rows.agg(F.count("*"), F.bit_xor(hashed), F.sum(hashed.cast("decimal(38,0)"))).first()


def carry_on(history: DataFrame, tails: Tails, published, touched, batch, securities, fx, newest, **metrics):
    """Publish the ``touched`` years of a stored history again, and those after them that this changes.

    ``newest`` picks the rows that count among those of a symbol and date. A repeated batch starts from the tails
    of the batches before it, so it computes the same again.
    """
    known, todo = years_stored(history), sorted(touched)
    named = [*ROW.names, "batch"]

    def following(year):
        return next((y for y in known if y > year), None)

    while todo:
        years = [todo.pop(0)]
        while todo and following(years[-1]) == todo[0]:
            years.append(todo.pop(0))
        context = tails.before(years[0], batch).withColumn("batch", F.lit(-1).cast("bigint"))
        while True:
            own = history.where(F.col("run_year").isin(years)).select(*named)
            rows = newest(own.unionByName(context).repartition("symbol"), ["run_year"])
            tails.store(rows, years, batch)
            later = following(years[-1])
            if later is None or _signature(tails.before(later, batch)) == _signature(tails.before(later, batch - 1)):
                break
            years.append(later)
            todo = [y for y in todo if y > later]
            # Years that are touched anyway come along, for one pass over all of them.
            while todo and following(years[-1]) == todo[0]:
                years.append(todo.pop(0))
        whole = price_metrics(rows.select(*RAW_PRICES.names), securities, fx, by_year=True, continuous=True, **metrics)
        idempotent_load(whole.where(F.col("run_year").isin(years)), published, clustered=True)
