"""Item order per user and channel from class probabilities."""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import accumulate
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import case_of, unit_hash

MODEL_GROUP = "exp"


@dataclass(frozen=True)
class Item:
    """A product: its ids (the first is the one put out), its class label (below 0: not
    modelled), the share of users it is forced on, and whether it may still be put out."""

    item_ids: tuple[str, ...]
    label: int
    prop: float = 0.0
    enable: bool = True

    @property
    def main_id(self) -> str:
        return self.item_ids[0]


@dataclass(frozen=True)
class ChannelItems:
    """Items a channel slot may show; empty means all."""

    channel_id: str
    banner_id: str = ""
    items: tuple[str, ...] = field(default_factory=tuple)


def _texts(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def _first_item(items: Sequence[Item], allowed: Sequence[str], draw: Column) -> Column:
    """Item the draw forces to the front; null for the users whose order stays."""
    forced = [i for i in items if i.prop > 0 and (not allowed or i.main_id in allowed)]
    if not forced:
        return F.lit(None).cast("string")
    bounds = accumulate(item.prop for item in forced)
    return case_of([(draw < bound, F.lit(item.main_id)) for item, bound in zip(forced, bounds)])


def _by_slot(channels: Sequence[ChannelItems], value, default: Column) -> Column:
    tests = [
        ((F.col("channel_id") == c.channel_id) & (F.col("banner_id") == c.banner_id), value(c))
        for c in channels
        if c.items
    ]
    return case_of(tests, default) if tests else default


SLOT_KEYS = ["user_id", "channel_id", "banner_id"]


def one_per_slot(df: DataFrame) -> DataFrame:
    """One row per user and slot (null banner as empty); of a slot listed twice the model's user stays."""
    first = Window.partitionBy(*SLOT_KEYS).orderBy((F.col("user_type") == MODEL_GROUP).desc_nulls_last(), "user_type")
    slots = df.withColumn("banner_id", F.coalesce("banner_id", F.lit("")))
    return slots.withColumn("_row", F.row_number().over(first)).where(F.col("_row") == 1).drop("_row")


def rerank_users(slots: DataFrame, probabilities: DataFrame, items: Sequence[Item], channels: Sequence[ChannelItems],
                 most: Mapping[tuple[str, str], int] | None = None, scores: str = "probability", salt: str = "rerank") -> DataFrame:
    """`rerank` of narrow slot rows: they are de-duplicated before they meet the users' probabilities
    (user_id and an array), so no array is sorted or shuffled once per slot. Users without have no scores."""
    known = probabilities.select("user_id", scores)
    return _in_order(one_per_slot(slots).join(known, "user_id", "left"), items, channels, scores, salt, most)


def rerank(df: DataFrame, items: Sequence[Item], channels: Sequence[ChannelItems], scores: str = "probability",
           salt: str = "rerank", most: Mapping[tuple[str, str], int] | None = None) -> DataFrame:
    """One row per user, channel slot and item with score and rank from 0.

    Scored items come in order of probability, restricted to those the slot allows; if none
    is left, the allowed list itself. Groups not chosen by the model get a shuffled list.
    With the configured share an item is put first, and only then disabled items go.
    `most` names how many items of a slot are wanted; the others never become rows.

    Works row by row on arrays as short as the item list; nothing is shuffled but the
    de-duplication of the slots.
    """
    return _in_order(one_per_slot(df), items, channels, scores, salt, most)


def _in_order(slots: DataFrame, items: Sequence[Item], channels: Sequence[ChannelItems], scores: str, salt: str,
              most: Mapping[tuple[str, str], int] | None) -> DataFrame:
    keys = SLOT_KEYS
    by_label = {item.label: item for item in items if item.label >= 0}
    known = {item_id: item.label for item in by_label.values() for item_id in item.item_ids}
    labels = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    enabled = _texts([item.main_id for item in items if item.enable])
    probability = F.col(scores)

    kept = [c for c in slots.columns if c != scores]
    slots = slots.withColumn("_allowed", _by_slot(channels, lambda c: _texts(c.items), _texts([])))

    candidates = F.array(*[
        F.struct(F.get(probability, label).isNull().alias("last"), (-F.get(probability, label)).alias("down"), F.lit(label).alias("label"), F.lit(item.main_id).alias("item_id"))
        for label, item in sorted(by_label.items())
    ])
    usable = F.filter(
        candidates,
        lambda p: (p["label"] < F.size(probability))
        & ((F.size("_allowed") == 0) | F.array_contains("_allowed", p["item_id"])),
    )
    slots = slots.withColumn("_scored", F.transform(F.array_sort(usable), lambda p: p["item_id"]))
    slots = slots.withColumn("_ids", F.when(F.size("_scored") > 0, F.col("_scored")).otherwise(F.col("_allowed")))

    drawn = F.transform("_ids", lambda i: F.struct(unit_hash(salt, *keys, i).alias("draw"), i.alias("item_id")))
    mixed = F.transform(F.array_sort(drawn), lambda p: p["item_id"])
    slots = slots.withColumn("_order", F.when(F.col("user_type") == MODEL_GROUP, F.col("_ids")).otherwise(mixed))

    if any(item.prop > 0 for item in items):
        slots = slots.withColumn("_draw", unit_hash(f"{salt}|first", *keys))
        draw = F.col("_draw")
        slots = slots.withColumn("_first", _by_slot(channels, lambda c: _first_item(items, c.items, draw), _first_item(items, (), draw)))
        front = F.concat(F.array("_first"), F.array_remove("_order", F.col("_first")))
        moved = F.filter(front, lambda i: F.array_contains(enabled, i))
        slots = slots.withColumn("_order", F.when(F.col("_first").isNull(), F.col("_order")).otherwise(moved))

    if most is not None:
        wanted = case_of([((F.col("channel_id") == c) & (F.col("banner_id") == b), F.lit(n)) for (c, b), n in most.items()], F.size("_order")) if most else F.size("_order")
        slots = slots.withColumn("_order", F.slice("_order", 1, wanted))

    def scored(item_id: Column, position: Column) -> Column:
        score = F.coalesce(F.get(probability, F.try_element_at(labels, item_id)), F.lit(0.0))
        return F.struct(item_id.alias("item_id"), score.cast("double").alias("score"), position.alias("rank"))

    ranked = slots.withColumn("_item", F.explode(F.transform("_order", scored)))
    return ranked.select(*kept, "_item.*").where(F.col("item_id").isNotNull())
