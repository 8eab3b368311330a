"""Aggregates of the reports and feedback steps."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RATIO = "decimal(38,6)"


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def sum_where(condition: Column, value) -> Column:
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def days_with_any(df: DataFrame, keys: Sequence[str], day: str, flag: str, output: str) -> DataFrame:
    """Days per key on which the flag was positive at least once."""
    daily = df.groupBy(*keys, day).agg((F.sum(flag) > 0).cast("int").alias("_hit"))
    return daily.groupBy(*keys).agg(F.sum("_hit").alias(output))


def ratio(part, whole) -> Column:
    """part / whole with the divisor kept at one or more."""
    return part / F.greatest(whole, F.lit(1))


def funnel_columns(steps: Sequence[str]) -> list[Column]:
    """Per step: users that reached it, total steps taken, both per member of the group."""
    members = F.count("*")
    columns = [members.alias("members")]
    for step in steps:
        users, total = F.count_if(F.col(step) > 0), F.coalesce(F.sum(step), F.lit(0))
        columns += [
            users.alias(f"{step}_users"),
            total.alias(f"{step}_total"),
            (users.cast("decimal(20,0)") / members).cast(RATIO).alias(f"{step}_user_rate"),
            (total.cast("decimal(20,0)") / members).cast(RATIO).alias(f"{step}_rate"),
        ]
    return columns


def at_levels(df: DataFrame, levels: Mapping[str, Sequence[str]], columns: Sequence[Column],
              level: str = "level") -> DataFrame:
    """The same aggregates at several groupings in one pass over the data.

    `levels` maps a level name to its grouping columns; columns a level leaves out are null.
    """
    keys = list(dict.fromkeys(c for grouping in levels.values() for c in grouping))
    grouping_id = F.grouping_id()
    by_id = {}
    for name, grouping in levels.items():
        bits = 0
        for key in keys:
            bits = bits * 2 + (key not in grouping)
        by_id[bits] = name
    sets = [[F.col(c) for c in grouping] for grouping in levels.values()]
    result = df.groupingSets(sets, *keys).agg(grouping_id.alias("_level"), *columns)
    label = F.lit(None).cast("string")
    for bits, name in by_id.items():
        label = F.when(F.col("_level") == bits, F.lit(name)).otherwise(label)
    return result.withColumn(level, label).drop("_level")


def json_slots(df: DataFrame, keys: Sequence[str], position: str, code: str, kind: str, rank: str,
               output: str = "prod_info") -> DataFrame:
    """One JSON text per key with its products in rank order, in the shape of a banner slot.

    The input holds at most the channel's number of items per key.
    """
    ordered = F.sort_array(F.collect_list(F.struct(F.col(rank), F.col(code).alias("code"), F.col(kind).alias("type"))))
    products = F.transform(ordered, lambda p: F.struct(p["code"].alias("code"), p["type"].alias("type")))
    slot = F.struct(F.lit("0").alias("index"), products.alias("prdList"))
    body = F.array(F.struct(F.lit(position).alias("positionId"), F.array(slot).alias("slots")))
    return df.groupBy(*keys).agg(F.to_json(body).alias(output))
