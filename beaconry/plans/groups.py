"""Experiment groups that stay the same from day to day."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import unit_hash
from ..operators.sampling import pick_group

MINIMUM_MARGIN = 1.1
RANDOM_SCORE_GROUPS = ("ctl", "noop")


@dataclass(frozen=True)
class GroupSize:
    """Users wanted in a group; `minimum` groups get just that, the others share the rest."""

    num: int
    minimum: bool = False


def group_weights(channels: Sequence[Mapping[str, GroupSize]], user_count: int) -> list[tuple[str, float]]:
    """Weight per group over all channels, from the largest number any channel wants."""
    sizes: dict[str, GroupSize] = {}
    for groups in channels:
        for name, size in groups.items():
            largest = max(size.num, sizes[name].num if name in sizes else 0)
            sizes[name] = GroupSize(largest, size.minimum)
    reserved = sum(MINIMUM_MARGIN * s.num for s in sizes.values() if s.minimum)
    shared = sum(s.num for s in sizes.values() if not s.minimum)
    weights = []
    for name, size in sizes.items():
        share = size.num / shared * (user_count - reserved) if not size.minimum else 0.0
        weights.append((name, MINIMUM_MARGIN * size.num if size.minimum else float(max(share, size.num))))
    return weights


def must_refresh(yesterday: DataFrame, group_count: int, push_day: int, refresh_days: Sequence[int]) -> bool:
    """Whether all users are split anew: on set days of the month, or when the number of
    groups is not what it was yesterday."""
    if push_day in refresh_days:
        return True
    return yesterday.select("user_type").distinct().count() != group_count


def assign_groups(today: DataFrame, yesterday: DataFrame | None, weights: Sequence[tuple[str, float]], salt: str,
                  random_score: Sequence[str] = RANDOM_SCORE_GROUPS) -> DataFrame:
    """Today's users with group and score.

    Users seen yesterday keep their group; in groups the model does not choose they also
    keep their score, so that the same people are picked every day. New users are split by
    weight; in those groups their score is random.
    """
    drawn = pick_group(weights, unit_hash(salt, "user_id"))
    random = unit_hash(f"{salt}|score", "user_id")
    users = today.groupBy("user_id").agg(F.max("score").alias("score"))
    if yesterday is None:
        users = users.withColumns({"_type": F.lit(None).cast("string"), "_score": F.lit(None).cast("double")})
    else:
        kept = yesterday.groupBy("user_id").agg(F.max(F.struct("user_type", "score")).alias("_old"))
        users = users.join(kept, "user_id", "left").select(
            "user_id", "score", F.col("_old.user_type").alias("_type"), F.col("_old.score").alias("_score")
        )
    seen = F.col("_type").isNotNull()
    group = F.coalesce("_type", drawn)
    old_or_random = F.when(seen, F.col("_score")).otherwise(random)
    score = F.when(group.isin(list(random_score)), old_or_random).otherwise(F.col("score"))
    return users.select("user_id", group.alias("user_type"), score.alias("score"))
