"""Writers: raw CSV, published Parquet, append and idempotent loads."""

from datetime import date

from pyspark.sql import DataFrame

PARTITION = "run_year"


def dataset_path(base, layer, dataset, run_date: date) -> str:
    """Folder of one dataset of one run: ``<base>/<layer>/<dataset>/<run date>``."""
    return f"{base.rstrip('/')}/{layer}/{dataset}/{run_date.isoformat()}"


def write_csv(df: DataFrame, path):
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path):
    df.write.mode("overwrite").parquet(path)


def rebalanced(df: DataFrame, by=PARTITION) -> DataFrame:
    """The rows of a year in few tasks, large years split by adaptive execution, so that files
    come out near the advisory size instead of one per task and year."""
    return df.hint("rebalance", by)


def append_load(df: DataFrame, path, by=PARTITION, clustered=False):
    """Add the rows to the table, creating it if missing. Loading twice doubles the rows.

    ``clustered`` tells that the rows of a year already are together.
    """
    rows = df if clustered else rebalanced(df, by)
    rows.write.partitionBy(by).mode("append").parquet(path)


def idempotent_load(df: DataFrame, path, by=PARTITION, clustered=False):
    """Replace the years present in the rows and leave all others. Loading twice is harmless."""
    rows = df if clustered else rebalanced(df, by)
    rows.write.partitionBy(by).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def append_to_warehouse(df: DataFrame, source, **options):
    """Append through a warehouse's Spark connector, such as ``bigquery`` or ``jdbc``."""
    df.write.format(source).options(**options).mode("append").save()
