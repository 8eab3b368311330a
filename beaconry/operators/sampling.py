"""Samples and splits drawn by hash: the same rows on every run and after every retry."""

from __future__ import annotations

from itertools import accumulate
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import case_of, unit_hash
from .ranking import first_n, top_k

_BANDS = 65_536


def sample_rows(df: DataFrame, fraction: float, salt: str, *keys: str) -> DataFrame:
    """About `fraction` of the rows."""
    return df.where(unit_hash(salt, *keys) < fraction)


def pick_group(weights: Sequence[tuple[str, float]], draw: Column) -> Column:
    """Label for a draw in [0, 1) by cumulative weights."""
    total = sum(weight for _, weight in weights)
    bounds = accumulate(weight / total for _, weight in weights)
    branches = [(draw < bound, F.lit(name)) for (name, _), bound in zip(weights, bounds)]
    return case_of(branches, F.lit(weights[-1][0]))


def weighted_split(df: DataFrame, weights: Sequence[tuple[str, float]], salt: str, key: str,
                   output: str = "user_type") -> DataFrame:
    """Label every row with a group; shares follow the weights."""
    return df.withColumn(output, pick_group(weights, unit_hash(salt, key)))


def random_split(df: DataFrame, weights: Sequence[tuple[str, float]], seed: int,
                 output: str = "user_type") -> DataFrame:
    """The same with Spark's own splitter, one pass over the data per group."""
    parts = df.randomSplit([weight for _, weight in weights], seed)
    labelled = [part.withColumn(output, F.lit(name)) for part, (name, _) in zip(parts, weights)]
    first, *rest = labelled
    for part in rest:
        first = first.unionByName(part)
    return first


def pick_rows(df: DataFrame, n: int, salt: str, key: str) -> DataFrame:
    """`n` rows drawn at random.

    The draws are counted in bands first; only the bands that hold the n smallest are put in
    order, so the sort sees little more than n rows.
    """
    draw = df.withColumn("_draw", unit_hash(salt, key))
    bands = draw.groupBy(F.floor(F.col("_draw") * _BANDS).alias("band")).count().collect()
    held, last = 0, _BANDS
    for band, count in sorted(tuple(row) for row in bands):
        held += count
        if held >= n:
            last = band + 1
            break
    low = draw.where(F.col("_draw") < last / _BANDS)
    return first_n(low, [F.col("_draw"), F.col(key)], n).drop("_draw")


def pick_per_group(df: DataFrame, group: str, item: str, k: int, salt: str, rank: str = "rank") -> DataFrame:
    """`k` rows per group drawn at random, with their drawn order."""
    draw = df.withColumn("_draw", unit_hash(salt, group, item))
    return top_k(draw, group, [F.col("_draw"), F.col(item)], k, rank).drop("_draw")
