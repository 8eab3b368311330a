"""Small configuration tables next to large ones."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

MAX_ROWS = 10_000
BROADCAST_ROWS = 100_000


def rows_to_frame(spark: SparkSession, rows: Sequence[Mapping[str, object]], schema: str) -> DataFrame:
    """Configuration rows as a table with a declared schema."""
    return spark.createDataFrame([Row(**row) for row in rows], schema)


def small_rows(df: DataFrame, limit: int = MAX_ROWS) -> list[dict]:
    """Rows of a table that must be small, with the check that it is."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows where a small dimension is expected")
    return [row.asDict() for row in rows]


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """`df` marked for broadcast if it has at most `limit` rows; else left to the planner."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def literal_row(row: Mapping[str, object]) -> Column:
    fields = []
    for name, value in row.items():
        if isinstance(value, Mapping):
            pairs = [F.lit(x) for pair in value.items() for x in pair]
            fields.append(F.create_map(*pairs).alias(name))
        else:
            fields.append(F.lit(value).alias(name))
    return F.struct(*fields)


def with_each(df: DataFrame, rows: Sequence[Mapping[str, object]]) -> DataFrame:
    """Every row of `df` next to every configuration row.

    The rows travel inside the plan as literals: no join and no shuffle.
    """
    choices = F.array(*[literal_row(row) for row in rows])
    return df.withColumn("_choice", F.explode(choices)).select(*df.columns, "_choice.*")
