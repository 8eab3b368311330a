"""The day's package: ranked items of the ready users that were not delivered before."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import lookup
from ..operators.dimensions import rows_to_frame
from ..operators.filters import anti, blank_keys
from ..operators.rerank import ChannelItems, Item, rerank_users
from .push import USER_SLOT

_KEY_MARK = "\x01"


@dataclass(frozen=True)
class Slot:
    """How a delivery slot uses its items."""

    channel_id: str
    banner_id: str = ""
    num_items: int = 1
    allow_repeat: bool = True

    @property
    def key(self) -> str:
        return self.channel_id + _KEY_MARK + self.banner_id


def _slot_key():
    return F.concat(F.col("channel_id"), F.lit(_KEY_MARK), F.coalesce("banner_id", F.lit("")))


def forced_users(spark, users: Sequence[str], slots: Sequence[Slot]) -> DataFrame:
    """Test users that are ranked on every slot whatever the selection says."""
    rows = [{"user_id": u, "user_type": "exp", "channel_id": s.channel_id, "banner_id": s.banner_id}
            for u in users for s in slots]
    return rows_to_frame(spark, rows, "user_id string, user_type string, channel_id string, banner_id string")


def undelivered(ranked_items: DataFrame, delivered: DataFrame, slots: Sequence[Slot], start: str, end: str) -> DataFrame:
    """Drop user-item pairs already delivered in the period on slots that must not repeat.

    Missing banners count as equal."""
    once = [s.key for s in slots if not s.allow_repeat]
    if not once:
        return ranked_items
    history = delivered.where(F.col("dt").between(start, end) & _slot_key().isin(once))
    return anti(blank_keys(ranked_items, "banner_id"), blank_keys(history, "banner_id"), [*USER_SLOT, "item_id"])


def crowd_package(ranked_items: DataFrame, delivered: DataFrame, slots: Sequence[Slot], start: str, end: str,
                  constants: Mapping[str, str] | None = None) -> DataFrame:
    """Items ranked below the slot's number of items, without repeats, with run constants."""
    fresh = undelivered(ranked_items, delivered, slots, start, end)
    wanted = lookup(_slot_key(), {s.key: s.num_items for s in slots})
    kept = fresh.where(F.col("rank") < wanted)
    return kept.withColumns({k: F.lit(v) for k, v in (constants or {}).items()})


def ready_package(selection: DataFrame, forced: DataFrame, probabilities: DataFrame, items: Sequence[Item], channels: Sequence[ChannelItems],
                  delivered: DataFrame, slots: Sequence[Slot], start: str, end: str, constants: Mapping[str, str] | None = None) -> DataFrame:
    """The package of the users that the day's selection tags ready, and of the forced ones.

    User ids are texts here, as test users have no number. Only the first items of a slot are made rows."""
    def as_text(df: DataFrame) -> DataFrame:
        return df.withColumn("user_id", F.col("user_id").cast("string"))

    columns = ["user_id", "user_type", "channel_id", "banner_id"]
    users = as_text(selection.where(F.col("tag") == "ready").select(*columns)).unionByName(forced.select(*columns))
    ordered = rerank_users(users, as_text(probabilities), items, channels, {(s.channel_id, s.banner_id): s.num_items for s in slots})
    return crowd_package(ordered, as_text(delivered), slots, start, end, constants)
