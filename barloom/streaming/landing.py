"""Incremental daily load: new price files in, affected years republished."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barloom.plans.prices import price_metrics, with_run_year
from barloom.schemas import RAW_PRICES
from barloom.sinks.tables import idempotent_load, rebalanced
from barloom.streaming.carried import Tails, carry_on


def _store(rows: DataFrame, batch_id, history):
    """Keep the batch under its own id, so that a repeated batch replaces itself."""
    (
        rebalanced(rows.withColumn("batch", F.lit(batch_id).cast("bigint")))
        .write.partitionBy("run_year", "batch")
        .mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(history)
    )


def _stored(spark: SparkSession, history) -> DataFrame:
    """The stored rows; filters on ``run_year`` and ``batch`` choose folders."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_PRICES.fields)
    return spark.read.schema(f"{fields}, run_year INT, batch BIGINT").parquet(history)


def newest(history: DataFrame, keys=()) -> DataFrame:
    """For each symbol and date, the rows of the newest batch that has any: later batches correct.

    ``keys`` follow from the date; naming those that the rows are dealt by saves an exchange.
    """
    series = Window.partitionBy(*keys, "symbol", "date")
    return history.withColumn("_newest", F.max("batch").over(series)).where("batch = _newest").drop("_newest")


def publish_new_files(spark: SparkSession, landing, history, published, checkpoint,
                      securities: DataFrame, fx: DataFrame, source="parquet",
                      reader=None, continuous=False, repeats="stop", **metrics) -> StreamingQuery:
    """Load every file not loaded before, then stop.

    Row windows need whole years, so each batch joins the stored history and the years it
    touches are computed anew and replaced. With ``continuous`` windows they start from tails stored beside the history
    (``<history>_tails``), the rows that windows look back on, and a later year follows only if its tail has changed. A row for a symbol and date that is already stored replaces the
    older one; rows that share both within a batch stop the load unless ``repeats`` is
    ``ordered``. Rows without a date stay in the history and are not published, as in the batch
    job. ``reader`` holds options of the file source.
    """
    arriving = spark.readStream.format(source).schema(RAW_PRICES).options(**(reader or {})).load(landing)

    def load(batch: DataFrame, batch_id: int):
        session = batch.sparkSession
        if batch.isEmpty():
            return
        _store(with_run_year(batch), batch_id, history)
        stored = _stored(session, history)
        # Partition values only: one row per calendar year of the batch.
        landed = stored.where((F.col("batch") == batch_id) & F.col("run_year").isNotNull())
        years = sorted(r[0] for r in landed.select("run_year").distinct().collect())
        if not years:
            return
        if continuous:
            tails = Tails(session, f"{history.rstrip('/')}_tails")
            carry_on(stored, tails, published, years, batch_id, securities, fx, newest, repeats=repeats, **metrics)
            return
        # One exchange for the choice of the newest rows and for the windows.
        dated = stored.where(F.col("run_year").isin(years)).repartition("run_year", "symbol")
        republished = price_metrics(newest(dated, ["run_year"]), securities, fx, by_year=True, repeats=repeats, **metrics)
        idempotent_load(republished, published, clustered=True)

    return (
        arriving.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(load)
        .start()
    )
