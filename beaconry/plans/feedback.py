"""What happened to a package: sent, shown, clicked."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_ymd
from ..functions.scalars import lookup, split_part
from ..operators.ranking import top_k_by_limit

FEEDBACK = ["user_id", "user_type", "item_id", "channel_id", "banner_id", "send", "click"]


def message_feedback(package: DataFrame, deliveries: DataFrame, receipts: DataFrame, arrived: Column,
                     default_send: int = 0) -> DataFrame:
    """Package rows with send = 1 where a message reached the user's phone.

    Receipts are reduced to one row per phone and then per user before they meet the package.
    """
    by_phone = receipts.where(F.col("phone").isNotNull()).groupBy("phone").agg(F.count_if(arrived).alias("_arrived"))
    phones = deliveries.select("user_id", F.col("tel_number").alias("phone")).distinct()
    by_user = phones.join(by_phone, "phone").groupBy("user_id").agg(F.sum("_arrived").alias("_arrived"))
    send = F.when(F.col("_arrived") > 0, 1).otherwise(default_send).cast("int")
    return package.join(by_user, "user_id", "left").select(
        "user_id", "user_type", "item_id", "channel_id", F.coalesce("banner_id", F.lit("")).alias("banner_id"),
        send.alias("send"), F.lit(None).cast("int").alias("click"),
    )


def unpushed_groups(pool: DataFrame, limits: Mapping[str, int], item_id: str, channel_id: str, banner_id: str) -> DataFrame:
    """The users the groups without push would have had: best by score up to the limit."""
    limited = pool.withColumn("_limit", lookup(F.col("user_type"), limits)).where(F.col("_limit").isNotNull())
    best = top_k_by_limit(limited, ["user_type"], ["-score", "user_id"], "_limit")
    return best.select(
        "user_id", "user_type", F.lit(item_id).alias("item_id"), F.lit(channel_id).alias("channel_id"),
        F.lit(banner_id).alias("banner_id"), F.lit(0).alias("send"), F.lit(None).cast("int").alias("click"),
    )


def activity_code(activities: DataFrame, mark: str, day: Column, none: str = "NOPE") -> DataFrame:
    """Largest code of an activity whose name holds the mark and that runs on the day."""
    runs = (parse_ymd(F.col("start_dt")) <= day) & (parse_ymd(F.col("end_dt")) >= day)
    named = activities.where(F.contains(F.col("activity_name"), F.lit(mark)) & runs)
    return named.agg(F.coalesce(F.max("activity_code"), F.lit(none)).alias("activity_code"))


def exposures_and_clicks(exposures: DataFrame, clicks: DataFrame, resources: DataFrame, activity: Column) -> DataFrame:
    """One row per user and item shown for the activity, with click = 1 if any was clicked."""
    shown = exposures.where((F.col("strategy_category") == "engine") & (split_part("strategy_id", "--", 1) == activity))
    clicked = clicks.select(F.col("advice_id"), F.lit(1).alias("_hit")).distinct()
    per_item = shown.join(clicked, "advice_id", "left").join(resources, "resource_id", "left")
    return per_item.groupBy("user_id", "item_id").agg(
        F.lit(1).alias("expose"), F.max(F.coalesce("_hit", F.lit(0))).alias("click")
    )


def app_feedback(package: DataFrame, seen: DataFrame) -> DataFrame:
    """Package rows with send = shown and click = clicked."""
    return package.join(seen, ["user_id", "item_id"], "left").select(
        "user_id", "user_type", "item_id", "channel_id", F.coalesce("banner_id", F.lit("")).alias("banner_id"),
        F.coalesce("expose", F.lit(0)).alias("send"), F.coalesce("click", F.lit(0)).alias("click"),
    )
