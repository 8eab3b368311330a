"""Packages in the form each channel takes them."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import lookup
from ..operators.aggregates import json_slots
from ..operators.dimensions import with_each
from ..operators.filters import select_by_tags
from ..operators.ranking import first_per_key
from ..operators.sampling import pick_per_group

PHONE_DIGITS = 11


def first_items(package: DataFrame, channel_id: str, banner_id: str, scene_id: str | None = None, first_rank: int = 0) -> DataFrame:
    """The item put out: first rank of one slot."""
    slot = (F.col("channel_id") == channel_id) & (F.coalesce("banner_id", F.lit("")) == banner_id)
    scene = F.lit(True) if scene_id is None else F.col("scene_id") == scene_id
    return package.where(slot & scene & (F.col("rank").cast("int") == first_rank))


def message_rows(items: DataFrame, phones: DataFrame, contents: Mapping[str, str], push: bool, actv_id: str,
                 digits: int = PHONE_DIGITS) -> DataFrame:
    """Text messages: one per user that has a full phone number and an item with a text."""
    reachable = phones.where(F.length("tel_number") == digits)
    texts = items.withColumn("content", lookup(F.col("item_id"), contents)).where(F.coalesce("content", F.lit("")) != "")
    rows = texts.join(reachable.select("user_id", "tel_number"), "user_id")
    one = first_per_key(rows, "user_id", [F.col("item_id"), F.col("tel_number")])
    return one.select("user_id", "item_id", "tel_number", "content", F.lit(actv_id).alias("actv_id"),
                      F.lit(int(push)).alias("do_push"))


def is_push_day(day_of_month: int, push_days: Sequence[int]) -> bool:
    return not push_days or day_of_month in push_days


def test_pairs(users: DataFrame, user_tags: Mapping[str, object], items: Sequence[Mapping[str, object]]) -> DataFrame:
    """Chosen test users next to each of the chosen items."""
    return with_each(select_by_tags(users, user_tags), items)


def select_rows(rows: Sequence[Mapping[str, object]], tags: Mapping[str, object]) -> list[Mapping[str, object]]:
    """Tag selection over configuration rows."""

    def fits(row: Mapping[str, object]) -> bool:
        return all(row[k] in v if isinstance(v, (list, tuple)) else row[k] == v for k, v in tags.items())

    return [row for row in rows if fits(row)]


def whitelist_rows(items: DataFrame) -> DataFrame:
    return items.select("user_id", "item_id", "model_version", "scene_id")


def random_test_items(pairs: DataFrame, num_items: int, salt: str) -> DataFrame:
    """Test users get `num_items` of their items in random order."""
    return pick_per_group(pairs, "user_id", "item_id", num_items, salt)


def app_rows(items: DataFrame, banner_id: str, prod_type: str, scene_id: str, actv_id: str, num_items: int) -> DataFrame:
    """One JSON slot per user and model version with the items the slot has room for."""
    typed = items.where(F.col("rank") < num_items).withColumn("_type", F.lit(prod_type))
    slots = json_slots(typed, ["user_id", "model_version"], banner_id, "item_id", "_type", "rank")
    return slots.withColumns({"scene_id": F.lit(scene_id), "actv_id": F.lit(actv_id), "banner_id": F.lit(banner_id)})
