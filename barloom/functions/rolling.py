"""Trailing row-window expressions: means with a minimum fill, changes, strength index.

Windows count rows (trading days), not calendar days. All expressions over the
same keys and order share one exchange and one sort.
"""

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def trailing(rows, keys, order):
    """The current row and the ``rows - 1`` before it."""
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(1 - rows, Window.currentRow)


def rolling_count(value, rows, keys, order) -> Column:
    return F.count(value).over(trailing(rows, keys, order))


def rolling_mean(value, rows, keys, order, min_periods=None) -> Column:
    """Mean over the last ``rows`` rows; NULL until ``min_periods`` of them are non-null."""
    needed = rows if min_periods is None else min_periods
    frame = trailing(rows, keys, order)
    return F.when(F.count(value).over(frame) >= needed, F.avg(value).over(frame))


def running(value, keys, order, scale=4):
    """Exact sum and number of the values up to the current row, as decimals of ``scale`` places.

    A frame's sum is the difference of two of them, whatever its length; see ``framed``.
    """
    upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    exact = value.cast(f"decimal(28,{scale})")
    return F.coalesce(F.sum(exact).over(upto), F.lit(0).cast(f"decimal(38,{scale})")), F.count(exact).over(upto)


def framed(total, count, rows, keys, order):
    """Sum and number of the values in the last ``rows`` rows, from columns of running ones."""
    series = Window.partitionBy(*keys).orderBy(*order)

    def inside(name):
        return F.col(name) - F.coalesce(F.lag(name, rows).over(series), F.lit(0))

    return inside(total), inside(count)


def exact_mean(total, count, rows, keys, order, min_periods=None) -> Column:
    """Mean of the last ``rows`` rows from columns of running sums; NULL until ``min_periods`` of them are non-null.

    The sum is exact, so neither the order of summation nor earlier rows leave a trace in the last digits.
    """
    needed = rows if min_periods is None else min_periods
    sums, number = framed(total, count, rows, keys, order)
    return F.when(number >= needed, sums.cast("double") / number.cast("double"))


def price_change(value, keys, order) -> Column:
    """Difference to the previous row; NULL on the first row."""
    previous = F.lag(value).over(Window.partitionBy(*keys).orderBy(*order))
    return F.col(value) - previous


def gain(change, strict=False) -> Column:
    """Upward part of a change. An unknown change counts as 0, or stays NULL if strict."""
    return _one_sided(change, change, strict)


def loss(change, strict=False) -> Column:
    """Downward part of a change, as a positive number."""
    return _one_sided(change, -change, strict)


def _one_sided(change, amount, strict):
    known = F.when(amount > 0, amount)
    return known.when(change.isNotNull(), F.lit(0)) if strict else known.otherwise(F.lit(0))


def strength_index(mean_gain, mean_loss) -> Column:
    """100 when only gains, 0 when only losses, NULL when the price did not move."""
    return 100 * mean_gain / F.nullif(mean_gain + mean_loss, F.lit(0))
