"""Which users are pushed on which day."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import ymd
from ..functions.scalars import case_of
from ..operators.aggregates import days_with_any
from ..operators.dimensions import rows_to_frame, with_each
from ..operators.filters import blank_keys
from ..operators.ranking import ranked, top_k_by_limit
from ..session import pin
from .calendar import DAILY_PUSHES, blocked_from, push_plan

SLOT = ["channel_id", "banner_id"]
USER_SLOT = ["user_id", *SLOT]
GROUP_SLOT = [*SLOT, "user_type"]


@dataclass(frozen=True)
class ChannelState:
    """A delivery slot on the day of the run."""

    channel_id: str
    banner_id: str
    max_push: int
    plan_push: int
    days_remain: int
    blocked_from: str
    daily: bool
    limits: Mapping[str, int] = field(default_factory=dict)  # users per group; absent: not pushed

    def row(self) -> dict:
        return {"channel_id": self.channel_id, "banner_id": self.banner_id, "max_push": self.max_push,
                "plan_push": self.plan_push, "_limits": dict(self.limits)}


def channel_states(spark: SparkSession, batch: str, react_delay: int, channels: Sequence[Mapping[str, object]]) -> list[ChannelState]:
    """Plan of every configured slot on the day of the batch (yyyyMMdd).

    channels: channel_id, banner_id, max_push, feedback_delay, push_delay, limits.
    """
    rows = [{k: v for k, v in c.items() if k != "limits"} for c in channels]
    schema = "channel_id string, banner_id string, max_push int, feedback_delay int, push_delay int"
    day = F.to_date(F.lit(batch), "yyyyMMdd")
    frame = rows_to_frame(spark, rows, schema).withColumn("batch", day)
    blocked = blocked_from(F.col("batch"), react_delay, F.col("feedback_delay"), F.col("push_delay"))
    plan = push_plan(frame, "batch", "max_push", react_delay).withColumn("blocked_from", ymd(blocked)).collect()
    limits = {(c["channel_id"], c["banner_id"]): c["limits"] for c in channels}
    return [
        ChannelState(r["channel_id"], r["banner_id"], r["month_push"], r["plan_push"], r["days_remain"], r["blocked_from"],
                     r["max_push"] >= DAILY_PUSHES, limits[(r["channel_id"], r["banner_id"])])
        for r in plan
    ]


def candidate_state(pool: DataFrame, channels: Sequence[ChannelState], pushes: DataFrame, sends: DataFrame,
                    start: str, end: str, delivered_rank: int = 0) -> DataFrame:
    """The best users of every group and slot up to its limit, with pushes tried and arrived.

    pool: user_id, user_type, score. pushes: user, slot, rank, dt. sends: user, slot, send, dt.
    Users are cut by score before they are ranked, and to the limit before the history is joined.
    """
    wide = with_each(pool.select("user_id", "user_type", "score").distinct(), [c.row() for c in channels])
    wide = wide.withColumn("max_user", F.try_element_at("_limits", F.col("user_type"))).drop("_limits")
    best = top_k_by_limit(wide, GROUP_SLOT, ["-score", "user_id"], "max_user")

    in_period = F.col("dt").between(start, end)
    tried = blank_keys(pushes.where(in_period & (F.col("rank") == delivered_rank)), "banner_id")
    tried = tried.groupBy(*USER_SLOT).agg(F.count("*").alias("try_push"))
    arrived = days_with_any(blank_keys(sends.where(in_period), "banner_id"), USER_SLOT, "dt", "send", "actual_push")
    state = best.join(tried, USER_SLOT, "left").join(arrived, USER_SLOT, "left")
    return state.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("int") for c in ("try_push", "actual_push")}).drop("max_user")


def open_pushes(channels: Sequence[ChannelState], pushes: DataFrame, end: str, delivered_rank: int = 0) -> DataFrame | None:
    """Users and slots whose last pushes may still be under way; none for slots pushed daily."""
    waiting = [c for c in channels if not c.daily]
    if not waiting:
        return None
    tests = [
        (F.col("channel_id") == c.channel_id) & (F.col("banner_id") == c.banner_id) & F.col("dt").between(c.blocked_from, end)
        for c in waiting
    ]
    recent = blank_keys(pushes.where(F.col("rank") == delivered_rank), "banner_id")
    return recent.where(reduce(lambda a, b: a | b, tests)).select(*USER_SLOT).distinct()


def daily_selection(state: DataFrame, channels: Sequence[ChannelState], pushes: DataFrame, end: str,
                    fail_rate: float = 0.0, delivered_rank: int = 0) -> DataFrame:
    """All candidates by tag: all, filtered (no push under way), done (plan met), ready
    (pushed today) and later. Today's share is what must go out per day to meet the plan.

    The state is pinned with a mark for pushes under way, then read for the first three tags
    and for the turns of the open users.
    """
    waiting = open_pushes(channels, pushes, end, delivered_rank)
    marks = state.withColumn("_waiting", F.lit(None).cast("boolean")) if waiting is None else state.join(
        waiting.withColumn("_waiting", F.lit(True)), USER_SLOT, "left")
    met = F.col("plan_push") <= F.col("actual_push")
    rows = pin(marks.select(*USER_SLOT, "user_type", "max_push", "plan_push", "try_push", "actual_push", "score",
                            F.col("_waiting").isNull().alias("_free"), met.alias("_met")))
    tags = F.array_compact(F.array(F.lit("all"), F.when(F.col("_free"), "filtered"), F.when(F.col("_free") & F.col("_met"), "done")))
    settled = rows.withColumn("tag", F.explode(tags))

    unmet = rows.where(F.col("_free") & ~F.col("_met"))
    turns = ranked(unmet, [F.col("try_push"), F.desc("score"), F.col("user_id")], GROUP_SLOT, rank="_turn", size="_open")
    days = case_of([
        ((F.col("channel_id") == c.channel_id) & (F.col("banner_id") == c.banner_id), F.lit(c.days_remain)) for c in channels
    ])
    share = (F.lit(1 / (1.0 - fail_rate)) * F.col("_open") / days).cast("int")
    turns = turns.withColumn("tag", F.when(F.col("_turn") <= share, "ready").otherwise("later"))
    columns = [*USER_SLOT, "user_type", "max_push", "plan_push", "try_push", "actual_push", "tag"]
    return settled.select(*columns).unionByName(turns.select(*columns))
