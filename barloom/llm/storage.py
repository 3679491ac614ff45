"""Intermediate tables in the folder that the cluster shares."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.sources.workspace import work_folder

BROADCAST_BYTES = 64 << 20


def stored(df: DataFrame, **options) -> DataFrame:
    """The rows written once as Parquet and read back, which cuts the lineage."""
    path = work_folder(df.sparkSession)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lookup(df: DataFrame) -> DataFrame:
    """The rows stored, to be broadcast if they measure up to ``BROADCAST_BYTES`` as JSON text.

    Beyond that a join with them shuffles; the answer is the same.
    """
    rows = stored(df)
    size = rows.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))) + 64)).first()[0] or 0
    return F.broadcast(rows) if size <= BROADCAST_BYTES else rows
