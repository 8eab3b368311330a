"""Push periods, feedback dates and training months.

*batch* is the date of the data; *react_delay* the days until its results are pushed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import ymd

DAILY_PUSHES = 30


def period_start(batch, react_delay: int) -> Column:
    """First batch whose push falls into the campaign month of `batch`."""
    return F.date_sub(F.trunc(F.date_add(batch, react_delay), "month"), react_delay)


def period_end(batch, react_delay: int) -> Column:
    """Last batch whose push falls into the campaign month of `batch`."""
    return F.date_sub(F.last_day(F.date_add(batch, react_delay)), react_delay)


def push_plan(batches: DataFrame, batch: str, max_push: str, react_delay: int) -> DataFrame:
    """Planned pushes so far, limits of the current period and days left in it.

    The month is cut into `max_push` periods of equal whole days, the last takes the rest.
    From 30 pushes on, every day is a period of its own.
    """
    day, pushes = F.col(batch), F.col(max_push)
    start, end = period_start(day, react_delay), period_end(day, react_delay)
    length = F.floor(F.datediff(end, start) / pushes).cast("int")
    passed = F.datediff(day, start)
    index = F.when(length > 0, F.least(F.floor(F.try_divide(passed, length)).cast("int"), pushes - 1)).otherwise(pushes - 1)
    first = F.date_add(start, (length * index).cast("int"))
    last = F.when(index == pushes - 1, end).otherwise(F.date_add(start, (length * (index + 1) - 1).cast("int")))
    daily = pushes >= DAILY_PUSHES
    until = F.when(daily, day).otherwise(last)
    return batches.select(
        *batches.columns,
        F.when(daily, passed + 1).otherwise(index + 1).cast("int").alias("plan_push"),
        F.when(daily, F.datediff(end, start) + 1).otherwise(pushes).cast("int").alias("month_push"),
        ymd(F.when(daily, day).otherwise(first)).alias("start_dt"),
        ymd(until).alias("end_dt"),
        (F.abs(F.datediff(day, until)) + 1).cast("int").alias("days_remain"),
    )


def package_day(batch, feedback_delay: int, react_delay: int, push_delay: int) -> Column:
    """Batch whose package the feedback known at `batch` belongs to."""
    return F.date_add(batch, 1 - (feedback_delay + react_delay + push_delay))


def feedback_day(batch, feedback_delay: int) -> Column:
    """Partition of the outside feedback to read at `batch`."""
    return F.date_add(batch, 1 - feedback_delay)


def blocked_from(batch, react_delay: int, feedback_delay: int, push_delay: int) -> Column:
    """First day whose pushes have no feedback yet at `batch`, not before the period."""
    return F.greatest(period_start(batch, react_delay), F.date_sub(batch, feedback_delay + push_delay + 1))


def sample_months(days: DataFrame, day: str, train: int, evaluate: int) -> DataFrame:
    """Training and evaluation months counted back from each day, with their feature partition.

    The newest `evaluate` months are kept for evaluation, the `train` months before train.
    """
    back = F.explode(F.sequence(F.lit(1), F.lit(train + evaluate))).alias("back")
    month = F.add_months(F.trunc(F.col(day), "month"), -F.col("back"))
    return days.select(day, back).select(
        day,
        F.date_format(month, "yyyyMM").alias("month"),
        F.when(F.col("back") <= evaluate, "eval").otherwise("train").alias("role"),
        ymd(F.date_sub(month, 1)).alias("feature_dt"),
        ymd(F.date_sub(F.add_months(month, -1), 1)).alias("early_feature_dt"),
    )
