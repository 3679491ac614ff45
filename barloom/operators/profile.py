"""Column profiles kept by partition and merged for the whole table, so that a load profiles only what it changed."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.columns import column
from barloom.sinks import commits

#: Sizes of the sketches: 2^12 registers estimate distinct values within some 2 % (one standard error), 200 levels give
#: ranks of quantiles within some 1.5 %.
DISTINCT_BITS, QUANTILE_LEVELS = 12, 200


def partial_profile(df: DataFrame, by: str) -> DataFrame:
    """``(by, position, column_name, non_null, nulls, distinct, quantiles)``: one row per partition and other column.

    Counts are exact; the last two are sketches that can be merged, of hashed values and of numbers (NULL for other types).
    """
    fields = [f for f in df.schema.fields if f.name.lower() != by.lower()]
    measures = [F.count("*").alias("_rows")]
    for i, f in enumerate(fields):
        value = column(df, f.name)
        measures.append(F.count(value).alias(f"_n{i}"))
        measures.append(F.hll_sketch_agg(F.when(value.isNotNull(), F.xxhash64(value)), DISTINCT_BITS).alias(f"_d{i}"))
        if isinstance(f.dataType, T.NumericType):
            measures.append(F.kll_sketch_agg_double(value.cast("double"), QUANTILE_LEVELS).alias(f"_q{i}"))
    summed = df.groupBy(column(df, by).alias(by)).agg(*measures)
    return summed.select(by, F.inline(F.array(*_lines(fields))))


def _lines(fields):
    def sketch(i, f):
        return F.col(f"_q{i}") if isinstance(f.dataType, T.NumericType) else F.lit(None).cast("binary")

    return [
        F.struct(
            F.lit(i + 1).alias("position"), F.lit(f.name).alias("column_name"), F.col(f"_n{i}").alias("non_null"),
            (F.col("_rows") - F.col(f"_n{i}")).alias("nulls"), F.col(f"_d{i}").alias("distinct"), sketch(i, f).alias("quantiles"))
        for i, f in enumerate(fields)
    ]


def keep_profile(df: DataFrame, kept, parts, by="run_year"):
    """Bring the stored profile up to date after the partitions ``parts`` of a table have changed; only those are read."""
    parts = sorted(set(parts))
    rows = partial_profile(df.where(column(df, by).isin(parts)), by)
    commits.commit(df.sparkSession, commits.stage(rows, kept, by), commits.REPLACE, parts)


def merged_profile(spark: SparkSession, kept, by="run_year", quantiles=(0.5,)) -> DataFrame:
    """``(position, column_name, non_null, nulls, distinct, quantiles)`` of the whole table from the stored sketches.

    Counts are exact. ``distinct`` is an estimate, and ``quantiles`` are values of about the asked ranks (NULL where no number
    was seen); the table itself is not read.
    """
    merged = commits.scan(spark, kept, by).groupBy("position", "column_name").agg(
        F.sum("non_null").alias("non_null"), F.sum("nulls").alias("nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct"), F.kll_merge_agg_double("quantiles").alias("_q"))
    some = F.col("_q").isNotNull() & (F.kll_sketch_get_n_double("_q") > 0)
    values = F.array(*[F.kll_sketch_get_quantile_double("_q", F.lit(float(q))) for q in quantiles])
    return merged.select("position", "column_name", "non_null", "nulls", "distinct", F.when(some, values).alias("quantiles"))
