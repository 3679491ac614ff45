"""Row windows over series of any length, computed in blocks of bounded size.

A plain window puts one whole series into one task. That is fine while (key, date) is
unique, because the calendar then bounds a series-year to 366 rows. Where a series may be
far longer (repeated dates, one symbol holding much of the table), ``in_blocks`` numbers
its rows and cuts them into blocks, giving each block the rows before it that its
windows look back on.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def in_blocks(df: DataFrame, keys, order, lookback, block_rows) -> DataFrame:
    """Cut each series into blocks of ``block_rows`` rows, led by ``lookback`` earlier rows.

    Rows follow each other by ``order``, whose first column is the date, then by the remaining columns:
    the order of a plain window over all of them. Adds ``_block``, ``_pos`` (row number in the
    series) and ``_own``. Evaluate windows over ``keys + ["_block"]`` ordered by ``_pos``, then
    keep the rows with ``_own``. Equal rows are counted, not shuffled one by one, until their
    block is known. A day is cut at some of its own rows, one in about ``block_rows`` by a hash, so the
    number of its cells follows from its size. Rows are numbered inside their cell, and cells by their sizes. A
    task holds one block, one cell, or the cells of one series without their rows.
    """
    date, ties = order[0], [*order[1:], *[c for c in df.columns if c not in [*keys, *order]]]
    before = (Window.unboundedPreceding, -1)
    none_before = F.lit(0).cast("bigint")
    # A struct key compares NULL parts as equal, so series with a NULL key are joined too. Its parts are not
    # carried beside it, and every branch needs all columns, so that the branches share one exchange of the rows.
    day = [*keys, date]
    rest, tie = [c for c in df.columns if c not in day], F.struct(*ties)

    def whole(key):
        return [F.col(f"{key}.{c}").alias(c) if c in day else F.col(c) for c in df.columns]

    rows = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    rows = rows.select(F.struct(*day).alias("_day"), *rest, "_copies")
    picked = F.pmod(F.xxhash64(*whole("_day")), F.lit(block_rows)) == 0
    cuts = rows.where(picked).groupBy("_day").agg(F.sort_array(F.collect_list(tie)).alias("_cuts"))
    cell = F.when(F.col("_cuts").isNull(), 0).otherwise(F.size(F.filter("_cuts", lambda c: c <= tie)))
    unit = F.struct(*[F.col(f"_day.{c}").alias(c) for c in day], cell.alias("_cell"))
    rows = rows.join(cuts, "_day", "left").select(unit.alias("_unit"), *rest, "_copies")

    in_cell = Window.partitionBy("_unit").orderBy(*ties).rowsBetween(*before)
    numbered = rows.withColumn("_inside", F.coalesce(F.sum("_copies").over(in_cell), none_before))
    cells = numbered.groupBy("_unit").agg(F.max(F.col("_inside") + F.col("_copies")).alias("_size"))
    series = Window.partitionBy(*[f"_unit.{k}" for k in keys]).orderBy(f"_unit.{date}", "_unit._cell").rowsBetween(*before)
    starts = cells.select("_unit", F.coalesce(F.sum("_size").over(series), none_before).alias("_start"))
    placed = (
        numbered.join(starts, "_unit")
        .withColumn("_first", F.col("_start") + F.col("_inside"))
        .withColumn("_last", F.col("_first") + F.col("_copies") - 1)
    )

    block_start = F.col("_block") * block_rows
    blocks = F.expr(f"sequence(_first div {block_rows}, (_last + {lookback}) div {block_rows})")
    positions = F.sequence(
        F.greatest(F.col("_first"), block_start - lookback),
        F.least(F.col("_last"), block_start + block_rows - 1),
    )
    return (
        placed.select(*whole("_unit"), "_first", "_last", F.explode(blocks).alias("_block"))
        .repartition(*keys, "_block")
        .withColumn("_pos", F.explode(positions))
        .withColumn("_own", F.col("_pos") >= block_start)
        .select(*df.columns, "_block", "_pos", "_own")
    )
