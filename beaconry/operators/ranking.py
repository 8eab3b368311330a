"""Ranks, percentiles and top-k that hold when one group has most of the rows."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import pin
from .cutoff import order_column, within_limit

_POSITION_BITS = 33  # monotonically_increasing_id: task number above, row number below
_IN_TASK_LIMIT = 1_000
_BROADCAST_ROWS = 200_000


def _names(columns: Sequence[str] | str) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def _placed(df: DataFrame, order: Sequence[Column], groups: list[str]) -> DataFrame:
    """`df` sorted over all tasks, with the pinned position of each row and its task."""
    rows = pin(df.orderBy(*groups, *order).withColumn("_position", F.monotonically_increasing_id()))
    return rows.withColumn("_task", F.shiftrightunsigned("_position", _POSITION_BITS))


def _with_earlier(placed: DataFrame, groups: list[str], total: Column) -> DataFrame:
    """Add `_first` (first position of the group in the task), `_before` (its total in earlier
    tasks) and `_all`.

    There is one total per task and group in it. For the few groups this is meant for that is
    a small table: it is read to the driver, added up there and broadcast. If it is not
    small, the same sums are made by a window and an ordinary join.
    """
    spark = placed.sparkSession
    held = placed.groupBy("_task", *groups).agg(total.alias("_held"), F.min("_position").alias("_first"))
    rows = held.limit(_BROADCAST_ROWS + 1).collect()
    names = ["_o_task", *[f"_o_{g}" for g in groups], "_first", "_before", "_all"]
    if len(rows) <= _BROADCAST_ROWS:
        sums: dict[tuple, int] = {}
        table = []
        for row in sorted(rows, key=lambda r: r["_task"]):
            group = tuple(row[g] for g in groups)
            table.append([row["_task"], *group, row["_first"], sums.get(group, 0), group])
            sums[group] = sums.get(group, 0) + row["_held"]
        fields = [T.StructField("_o_task", T.LongType())]
        fields += [T.StructField(f"_o_{g}", placed.schema[g].dataType) for g in groups]
        fields += [T.StructField(n, T.LongType()) for n in ("_first", "_before", "_all")]
        offsets = F.broadcast(spark.createDataFrame([(*r[:-1], sums[r[-1]]) for r in table], T.StructType(fields)))
    else:
        earlier = Window.partitionBy(*groups).orderBy("_task")
        offsets = held.select(
            "_task", *groups, "_first", F.sum("_held").over(earlier) - F.col("_held"),
            F.sum("_held").over(Window.partitionBy(*groups)),
        ).toDF(*names)
    match = F.col("_task") == F.col("_o_task")
    for g in groups:
        match = match & F.col(g).eqNullSafe(F.col(f"_o_{g}"))
    return placed.join(offsets, match)


def ranked(df: DataFrame, order: Sequence[Column], groups: Sequence[str] = (), rank: str = "rank",
           size: str | None = None) -> DataFrame:
    """Add `row_number` over `order` within `groups`, without a task per group.

    A plain window sends a whole group to one task. Here one range-partitioned sort over
    groups and order spreads even a single huge group over all tasks; `order` must end in
    a unique column, which also splits ties. Positions inside the sorted tasks are pinned;
    adding the number of rows of the group in earlier tasks gives the rank. `size` names an
    optional column with the group's row count.
    """
    groups = _names(groups)
    rows = _with_earlier(_placed(df, order, groups), groups, F.count("*"))
    number = (F.col("_position") - F.col("_first") + F.col("_before") + 1).alias(rank)
    extra = [F.col("_all").alias(size)] if size else []
    return rows.select(*[F.col(c) for c in df.columns], number, *extra)


def total_before(df: DataFrame, order: Sequence[Column], value: str, groups: Sequence[str] = (),
                 output: str = "before") -> DataFrame:
    """Add the sum of `value` over the rows in front, within `groups`; `order` must be unique.

    Rows are summed inside each sorted task, the totals of earlier tasks are added.
    """
    groups = _names(groups)
    rows = _with_earlier(_placed(df, order, groups), groups, F.sum(value))
    inside = Window.partitionBy("_task", *groups).orderBy("_position")
    front = F.sum(value).over(inside) - F.col(value) + F.col("_before")
    return rows.select(*[F.col(c) for c in df.columns], front.alias(output))


def with_percentile(df: DataFrame, order: Sequence[Column], rank: str = "rank", size: str = "user_num",
                    percentile: str = "percentile") -> DataFrame:
    """Global rank, row count and rank divided by count."""
    return ranked(df, order, rank=rank, size=size).withColumn(percentile, F.col(rank) / F.col(size))


def top_k(df: DataFrame, groups: Sequence[str] | str, order: Sequence[Column], k: int,
          rank: str = "rank") -> DataFrame:
    """First `k` rows per group for a small fixed `k`.

    The limit on `row_number` lets Spark cut every group to k rows before the shuffle, so
    the size of a group does not matter.
    """
    window = Window.partitionBy(*_names(groups)).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def first_per_key(df: DataFrame, keys: Sequence[str] | str, order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in `order`: a de-duplication with a stable survivor."""
    return top_k(df, keys, order, 1, rank="_rank").drop("_rank")


def top_k_by_limit(df: DataFrame, groups: Sequence[str], by: Sequence[str], limit: str,
                   rank: str = "rank") -> DataFrame:
    """First rows per group where the number comes from a column; a null limit keeps none.

    `by`: names, `-` for falling; together unique. A cut-off from histograms goes before the
    sort, so that only about as many rows are sorted as are kept."""
    near = within_limit(df, groups, by, limit)
    return ranked(near, [order_column(n) for n in by], groups, rank).where(F.col(rank) <= F.col(limit))


def first_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first `n` rows of the whole table.

    Small n: each task keeps n rows and one task merges them. Large n: ranks by range.
    """
    if n <= _IN_TASK_LIMIT:
        return df.orderBy(*order).limit(n)
    return ranked(df, order, rank="_rank").where(F.col("_rank") <= n).drop("_rank")


def top_list(df: DataFrame, group: Sequence[str] | str, item: str, order: Sequence[Column], k: int,
             output: str) -> DataFrame:
    """Array of the first `k` items per group, cut before it is collected."""
    best = top_k(df, group, order, k, rank="_rank")
    pairs = F.sort_array(F.collect_list(F.struct("_rank", item)))
    return best.groupBy(*_names(group)).agg(F.transform(pairs, lambda p: p[item]).alias(output))
