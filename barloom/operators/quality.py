"""Data-quality reports, each one distributed aggregation."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators.columns import column


def null_profile(df: DataFrame) -> DataFrame:
    """Non-null and null count of every column: (column_name, non_null, nulls)."""
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count(column(df, c)).alias(f"_{i}") for i, c in enumerate(df.columns)],
    )
    lines = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"_{i}").alias("non_null"),
            (F.col("_rows") - F.col(f"_{i}")).alias("nulls"),
        )
        for i, c in enumerate(df.columns)
    ]
    return counts.select(F.inline(F.array(*lines)))


def schema_columns(df: DataFrame) -> DataFrame:
    """Position, name, type and nullability of every column; no row is read."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(
        rows, "position INT, column_name STRING, data_type STRING, nullable BOOLEAN")


def schema_profile(df: DataFrame) -> DataFrame:
    """The columns of the schema with the number of values seen in each: one pass over the rows."""
    counted = null_profile(df).select("column_name", "non_null")
    return counted.join(F.broadcast(schema_columns(df)), "column_name").select(
        "position", "column_name", "data_type", "nullable", "non_null")


def nulls_observed(df: DataFrame) -> list:
    """NULL counts of all columns as metrics to ``observe`` while the rows are written."""
    return [F.count_if(column(df, c).isNull()).alias(f"null_{c}") for c in df.columns]


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def key_report(df: DataFrame, keys, date) -> DataFrame:
    """One row: rows, rows without a date, and dated keys held by more than one row."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    undated = F.col(date).isNull()
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(undated, F.col("_n"))), F.lit(0)).alias("undated"),
        F.count_if((F.col("_n") > 1) & ~undated).alias("repeated_keys"),
    )


def rejected_count(df: DataFrame, flag) -> DataFrame:
    """Rows read and rows whose date could not be read."""
    return df.agg(
        F.count("*").alias("rows_read"),
        F.count_if(F.col(flag)).alias("rows_rejected"),
    )


def preview(df: DataFrame, order, rows) -> DataFrame:
    """The first rows in a stated order; each task keeps only that many."""
    return df.orderBy(*order).limit(rows)
