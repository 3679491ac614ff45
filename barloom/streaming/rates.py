"""Monthly rates landed bit by bit: a run asks the service only for months that are not there."""

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.plans.fx import extract_rate
from barloom.sources.fx_api import FxHistory

PAYLOADS = "request_date STRING, payload STRING"


def landed_payloads(spark: SparkSession, landing) -> DataFrame:
    """``(request_date, payload)``, one row per month that was asked for: an answer that holds a rate, if any does."""
    try:
        answers = spark.read.schema(PAYLOADS).parquet(landing)
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PAYLOADS)
    rate = extract_rate(answers.withColumn("answer", F.col("payload")), "answer")
    best = F.struct(F.col("exchange_rate").isNotNull(), F.col("payload").isNotNull(), "payload")
    return rate.groupBy("request_date").agg(F.max_by("payload", best).alias("payload"))


def missing_months(spark: SparkSession, landing) -> list[str]:
    """The months that were asked for and have no readable rate: at most twelve a year."""
    rates = extract_rate(landed_payloads(spark, landing))
    return sorted(r.request_date for r in rates.where("exchange_rate IS NULL").collect())


def land_rates(spark: SparkSession, url, first: date, last: date, landing, checkpoint, **options) -> dict:
    """Ask for the months from ``first`` to ``last`` that no run has asked for, and again for those without a rate.

    Answers are added to the files of ``landing``, each once however often a batch is repeated. ``last`` may grow from run
    to run; ``options`` are those of the service. Returns the numbers of months landed, asked for and still missing.
    """
    spark.dataSource.register(FxHistory)
    again = [d for d in missing_months(spark, landing) if d <= last.isoformat()]
    before = landed_payloads(spark, landing).count()
    stream = spark.readStream.format("fx_history").options(
        url=url, first=first.isoformat(), last=last.isoformat(), again=",".join(again),
        # A round of its own per set of answers, and none where nothing is missing.
        round=str(spark.read.schema(PAYLOADS).parquet(landing).count()) if again else "", **options,
    ).load()
    query = (
        stream.writeStream.format("parquet").option("path", landing).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    missing = missing_months(spark, landing)
    landed = landed_payloads(spark, landing).count()
    return {"landed": landed - len(missing), "asked": landed - before + len(again), "missing": missing}
