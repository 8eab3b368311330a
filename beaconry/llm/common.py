"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconry.session import pin, scratch_path

#: Rows that a function looks at together; documents may be long.
BATCH_ROWS = 256
#: Bytes of an Arrow batch where the session does not say otherwise: it stands in the memory of the JVM and of the Python worker.
BATCH_BYTES = "8m"
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def arrow_map(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema) -> DataFrame:
    """`mapInArrow` that hands `work` few rows at a time.

    Plans read the byte limit when they run, so it is set for the session, but only if nobody has set it; row limits stay."""
    if df.sparkSession.conf.get(_BATCH_LIMIT, None) is None:
        df.sparkSession.conf.set(_BATCH_LIMIT, BATCH_BYTES)
    return df.mapInArrow(lambda batches: work(_sliced(batches)), schema)


def nested(df: DataFrame, *columns) -> DataFrame:
    """`row` (all columns of `df`, whatever their names) and the given columns."""
    return df.select(F.struct("*").alias("row"), *columns)


def unnested(schema, changed: dict | None = None) -> list:
    """The columns of `schema` out of `row`, some of them `changed`."""
    changed = changed or {}
    return [(changed[c] if c in changed else F.col("row").getField(c)).alias(c) for c in schema.names]


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written as a table in the shared folder and read back: cuts the lineage, keeps columns apart."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def default_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def partitions_for(spark: SparkSession, rows: int, rows_each: int) -> int:
    """Enough partitions for `rows_each` rows in each, never fewer than the session's."""
    return max(default_partitions(spark), -(-rows // rows_each))


def row_keys(id_col: str, text_col: str) -> list:
    """Two hashes that name a row: of its id (null has one too) and of its text.

    Rows that agree in both have the same text, so whatever is derived from the text is the same
    for each of them."""
    return [F.xxhash64(F.col(id_col)).alias("k1"), F.xxhash64(F.col(text_col)).alias("k2")]


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in `edges` (a, b): root is the smallest node of its component.

    Large-star and small-star rounds by turns until no edge changes. Each round is checkpointed,
    so its cost does not grow with the rounds before it. A star keeps one row per edge, so no
    task gathers the neighbours of a hub: minima are pre-aggregated and joined back."""
    def flat(df):
        return df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def mark(df):
        return df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()

    links = pin(flat(edges))
    before = mark(links)
    while before["n"]:
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = flat(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                     .union(least.select("a", F.col("m").alias("b"))))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        links = pin(flat(large.join(low, "a").select("b", F.col("m").alias("c")).select(F.col("b").alias("a"), F.col("c").alias("b"))
                         .union(low.select("a", F.col("m").alias("b")))))
        after = mark(links)
        if after == before:
            break
        before = after
    return links.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
