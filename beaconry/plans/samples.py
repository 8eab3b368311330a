"""Training samples by month."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day_before_month
from ..functions.scalars import unit_hash
from ..operators.dimensions import with_each
from ..operators.filters import semi, union_all

UNKNOWN_YEAR = "1900"


def monthly_samples(base: DataFrame, target: DataFrame, mobile: DataFrame, months: Sequence[str], fraction: float,
                    salt: str, user_tag: str, item_tag: str) -> DataFrame:
    """Samples of all months in one pass: user_id, month, label, sample_dt, tag, dt.

    Base users hold the base card, first applied before the month, use the app and did not
    hold the target card before. Those that applied for it in the month are positives, the
    others with a known first date negatives, sampled. Item samples are the products the
    positives applied for.

    base, target: user_id, prod_id, apply_dt, hold ('1' or '0').
    """
    # What a month asks of a user are days that only get passed: one row per user, then the months.
    first_held = F.min(F.when(F.col("hold") == "1", F.col("apply_dt")))
    held = semi(base.groupBy("user_id").agg(F.min("apply_dt").alias("_since"), first_held.alias("_held")).where("_held is not null"), mobile, "user_id")
    held = held.join(target.groupBy("user_id").agg(first_held.alias("_had")), "user_id", "left")
    every = with_each(held, [{"month": m, "_first": f"{m}01"} for m in months])
    fresh = every.where((F.col("_held") < F.col("_first")) & (F.col("_had").isNull() | (F.col("_had") >= F.col("_first"))))

    wanted = target.withColumn("month", F.substring("apply_dt", 1, 6)).where(F.col("month").isin(list(months)))
    keys = ["user_id", "month"]
    joined = fresh.join(wanted.select(*keys, "apply_dt").distinct(), keys, "left")
    positive = joined.where(F.col("apply_dt").isNotNull())
    negative = joined.where(
        F.col("apply_dt").isNull() & ~F.startswith(F.col("_since"), F.lit(UNKNOWN_YEAR))
        & (unit_hash(salt, "user_id", "month") < fraction)
    )
    users = positive.select(*keys, F.lit("1").alias("label"), F.col("apply_dt").alias("sample_dt"), F.lit(user_tag).alias("tag"))
    others = negative.select(*keys, F.lit("0").alias("label"), F.col("month").alias("sample_dt"), F.lit(user_tag).alias("tag"))
    items = semi(wanted.select(*keys, "apply_dt", "prod_id").distinct(), positive, keys).select(
        *keys, F.col("prod_id").cast("string").alias("label"), F.col("apply_dt").alias("sample_dt"),
        F.lit(item_tag).alias("tag"),
    )
    return union_all([users, others, items]).withColumn("dt", day_before_month(F.col("month")))


def churn_samples(positives: Sequence[DataFrame], negatives: Mapping[str, tuple[DataFrame, float]], retainable: DataFrame,
                  month: str, salt: str) -> DataFrame:
    """Churned users and a sample of each kind of stayers, both retainable; any positive wins.

    Features come from two months back.
    """
    gone = union_all([p.select("user_id", F.lit(1).alias("label")) for p in positives])
    stayed = [
        df.select("user_id").distinct().where(unit_hash(f"{salt}|{kind}", "user_id") < fraction).withColumn("label", F.lit(0))
        for kind, (df, fraction) in negatives.items()
    ]
    known = semi(union_all([gone, *stayed]), retainable, "user_id")
    labels = known.groupBy("user_id").agg(F.max("label").alias("label"))
    return labels.select("user_id", "label", F.lit(f"{month}01").alias("sample_dt"),
                         day_before_month(F.lit(month), 1).alias("dt"))


def with_features(samples: DataFrame, features: DataFrame, tag: str) -> DataFrame:
    """Samples of a version with the features of the same user and partition."""
    chosen = samples.where(F.col("tag") == tag).select("user_id", "dt", "label")
    return chosen.join(features.select("user_id", "dt", "features"), ["user_id", "dt"])
