"""Rows for a key-value store."""

from __future__ import annotations

from contextlib import closing
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def kv_rows(df: DataFrame, prefix: str, key: str, value: Column | Sequence[str], ttl: int) -> DataFrame:
    """key, JSON value and seconds to live, one row per input row."""
    body = value if isinstance(value, Column) else F.struct(*value)
    return df.select(
        F.concat(F.lit(prefix + "|"), F.col(key).cast("string")).alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("value"),
        F.lit(ttl).alias("ttl"),
    )


def put_rows(rows: DataFrame, connect: Callable[[], object]) -> None:
    """Send rows from the executors. `connect` opens a client with `put(key, value, ttl)` and
    `close()`; a repeated task writes the same keys again, so the store ends up the same."""

    def send(part) -> None:
        with closing(connect()) as client:
            for row in part:
                client.put(row["key"], row["value"], row["ttl"])

    rows.foreachPartition(send)
