"""Campaign evaluation: cohort, funnel and asset change at several levels."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import RATIO, at_levels, funnel_columns
from ..operators.filters import anti, union_all
from ..operators.sampling import pick_rows

BLANK_GROUP = "0"


def evaluation_cohort(delivered: DataFrame, holders: DataFrame, pushed: Sequence[DataFrame], blank_size: int,
                      blank_item: str, blank_dt: str, salt: str) -> DataFrame:
    """Delivered users of the tested groups, and a random blank group nobody pushed."""
    never = anti(holders.select("user_id").distinct(), union_all([p.select("user_id") for p in pushed]), "user_id")
    blank = pick_rows(never, blank_size, salt, "user_id").select(
        "user_id", F.lit(BLANK_GROUP).alias("user_type"), F.lit(blank_item).alias("prod_id"), F.lit(blank_dt).alias("dt")
    )
    return delivered.select("user_id", "user_type", "prod_id", "dt").unionByName(blank)


def step_counts(events: DataFrame, steps: Mapping[str, Column], key: str = "user_id") -> DataFrame:
    """All funnel steps per user from one scan of the event table."""
    counts = [F.count_if(test).alias(name) for name, test in steps.items()]
    any_step = None
    for test in steps.values():
        any_step = test if any_step is None else any_step | test
    return events.where(any_step).groupBy(key).agg(*counts)


def funnel(cohort: DataFrame, steps: Sequence[str], levels: Mapping[str, Sequence[str]], measures: Sequence[str] = (),
           applied: str | None = None) -> DataFrame:
    """Funnel, conversion and measure totals at all levels in one pass."""
    columns = funnel_columns(steps)
    if applied:
        total = F.coalesce(F.sum(applied), F.lit(0))
        columns += [total.alias("applied"), (total.cast("decimal(20,0)") / F.count("*")).cast(RATIO).alias("applied_rate")]
    columns += [F.sum(m).alias(m) for m in measures]
    return at_levels(cohort, levels, columns)
