"""Feature vectors from wide attribute tables.

A column has one treatment. What depends on the row alone (plain numbers, fixed buckets, logarithms,
days) is an expression. What is learned from all rows comes from a few aggregations over all columns at once:
the number of a text is its rank by frequency, kept in a table that transforming joins, so a column may have any
number of texts; tenths are exact, from counts of equal values in one range-partitioned order; the driver
learns the limits of tenths, the spreads and how many texts there are.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import days_since, parse_ymd
from ..functions.scalars import safe_log1p
from ..operators.filters import fill_features
from ..operators.ranking import ranked, total_before
from ..session import pin

FEATURES = "features"
QUANTILES = 10
#: Texts of a column with a flag each: so many numbers stand in every vector.
MAX_FLAGS = 100_000


@dataclass(frozen=True)
class FeatureMap:
    """Which columns get which treatment; the vector follows this order."""

    plain: Sequence[str] = ()
    index: Sequence[str] = ()
    onehot: Sequence[str] = ()
    scale: Sequence[str] = ()
    quantile: Sequence[str] = ()
    bucket: Mapping[str, Sequence[float]] = field(default_factory=dict)
    log: Sequence[str] = ()
    days: Sequence[str] = ()

    @property
    def numeric(self) -> list[str]:
        return [*self.plain, *self.scale, *self.quantile, *self.bucket, *self.log]

    @property
    def text(self) -> list[str]:
        return [*self.index, *self.onehot]


@dataclass(frozen=True)
class FittedFeatures:
    """A version: the treatments, the day (yyyyMMdd) that date differences refer to, and what was learned.

    numbers: column, text, number (from 0, the most frequent text first). sizes: texts of a column."""

    columns: FeatureMap
    as_of: str
    numbers: DataFrame
    sizes: Mapping[str, int]
    spreads: Mapping[str, float]
    tenths: Mapping[str, Sequence[float]]


def bucket_of(value: Column, limits: Sequence[float]) -> Column:
    """Number of finite limits at or below the value, as a double; the outer buckets are open."""
    finite = [F.lit(float(x)) for x in limits if abs(x) != float("inf")]
    return F.size(F.filter(F.array(*finite), lambda limit: limit <= value)).cast("double") if finite else F.lit(0.0)


def _each(rows: DataFrame, names: Sequence[str], kind: str, value: str) -> DataFrame:
    """(column, value) of several columns of one kind."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias(value)) for c in names])
    return rows.select(F.explode(pairs).alias("p")).select("p.*")


def _text_numbers(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column, text, number): ranks by frequency, ties by text, without a task per column."""
    if not names:
        return rows.sparkSession.createDataFrame([], "column string, text string, number long")
    counts = _each(rows, names, "string", "text").groupBy("column", "text").agg(F.count("*").alias("_n"))
    return pin(ranked(counts, [F.desc("_n"), F.col("text")], ["column"], "_rank").select("column", "text", (F.col("_rank") - 1).alias("number")))


def _exact_tenths(rows: DataFrame, names: Sequence[str]) -> dict[str, list[float]]:
    """Limits of the tenths: the values at ranks n/10, 2n/10 and so on, rounded up; equal limits once."""
    if not names:
        return {}
    counts = pin(_each(rows, names, "double", "value").where("value is not null and not isnan(value)").groupBy("column", "value").agg(F.count("*").alias("_n")))
    sizes = {r["column"]: r["n"] for r in counts.groupBy("column").agg(F.sum("_n").alias("n")).collect()}
    wanted = F.create_map(*[F.lit(x) for c, n in sizes.items() for x in (c, n)]) if sizes else F.lit(None).cast("map<string,bigint>")
    placed = total_before(counts, [F.col("value")], "_n", ["column"], "_before").withColumn("_size", wanted[F.col("column")])
    reached = F.exists(F.sequence(F.lit(1), F.lit(QUANTILES - 1)), lambda i: (F.ceil(F.col("_size") * i / QUANTILES) > F.col("_before"))
                       & (F.ceil(F.col("_size") * i / QUANTILES) <= F.col("_before") + F.col("_n")))
    limits: dict[str, list[float]] = {c: [] for c in names}
    for r in placed.where(reached).select("column", "value").collect():   # nine a column at most
        limits[r["column"]].append(r["value"])
    return {c: sorted(v) for c, v in limits.items()}


def _filled(df: DataFrame, columns: FeatureMap) -> DataFrame:
    return fill_features(df, columns.numeric, columns.text)


def fit_features(df: DataFrame, columns: FeatureMap, as_of: str, max_flags: int = MAX_FLAGS) -> FittedFeatures:
    """Learn from all rows of `df`; the filled input is computed once and kept on the executors meanwhile."""
    texts, scale, quantile = list(dict.fromkeys(columns.text)), list(dict.fromkeys(columns.scale)), list(dict.fromkeys(columns.quantile))
    rows = _filled(df, columns).select(*dict.fromkeys([*texts, *scale, *quantile])).persist()
    try:
        numbers = _text_numbers(rows, texts)
        sizes = {c: 0 for c in texts} | {r["column"]: r["n"] for r in numbers.groupBy("column").agg(F.count("*").alias("n")).collect()}
        large = [c for c in columns.onehot if sizes[c] > max_flags]
        if large:
            raise ValueError(f"{', '.join(large)} have more than {max_flags} texts: too many for a flag each")
        found = rows.agg(*[F.stddev_samp(c).alias(c) for c in scale]).first().asDict() if scale else {}
        return FittedFeatures(columns, as_of, numbers, sizes, {c: found[c] or 0.0 for c in scale}, _exact_tenths(rows, quantile))
    finally:
        rows.unpersist()


def _flags(number: Column, size: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: (i == number).cast("double")) if size else F.array()


def _vector(fitted: FittedFeatures, number: Mapping[str, Column]) -> Column:
    """All treatments next to each other, in the order of `FeatureMap`; a day that is no date is NaN."""
    columns, day = fitted.columns, parse_ymd(F.lit(fitted.as_of))
    parts = [F.array(*[F.col(c) for c in columns.plain], *[number[c] for c in columns.index])]
    for c in columns.onehot:   # a text that was not there at fit time has no flag
        parts.append(_flags(number[c], fitted.sizes[c]))
    parts.append(F.array(
        *[F.col(c) / F.lit(fitted.spreads[c]) if fitted.spreads[c] else F.lit(0.0) for c in columns.scale],
        *[bucket_of(F.col(c), fitted.tenths[c]) for c in columns.quantile],
        *[bucket_of(F.col(c), limits) for c, limits in columns.bucket.items()],
        *[safe_log1p(F.col(c)) for c in columns.log],
        *[F.coalesce(days_since(F.col(c), day).cast("double"), F.lit(float("nan"))) for c in columns.days]))
    return F.concat(*[part.cast("array<double>") for part in parts])


def transform_features(df: DataFrame, fitted: FittedFeatures, key: str = "user_id") -> DataFrame:
    """key and features as an array of doubles. Texts meet their numbers by a join; new ones get the next number."""
    ready = _filled(df, fitted.columns)
    number: dict[str, Column] = {}
    for i, c in enumerate(dict.fromkeys(fitted.columns.text)):
        own = fitted.numbers.where(F.col("column") == c).select(F.col("text").alias(f"_text{i}"), F.col("number").alias(f"_number{i}"))
        ready = ready.join(own, F.col(c) == F.col(f"_text{i}"), "left").drop(f"_text{i}")
        number[c] = F.coalesce(F.col(f"_number{i}"), F.lit(fitted.sizes[c])).cast("double")
    return ready.select(key, _vector(fitted, number).alias(FEATURES))


def save_features(fitted: FittedFeatures, spark: SparkSession, path: str) -> None:
    """The table of numbers, and the rest as one line of JSON."""
    fitted.numbers.write.mode("overwrite").parquet(f"{path}/numbers")
    kept = {"as_of": fitted.as_of, "columns": asdict(fitted.columns), "sizes": fitted.sizes, "spreads": fitted.spreads, "tenths": fitted.tenths}
    spark.createDataFrame([(json.dumps(kept),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/learned")


def load_features(spark: SparkSession, path: str) -> FittedFeatures:
    kept = json.loads(spark.read.text(f"{path}/learned").first()["value"])
    numbers = spark.read.schema("column string, text string, number long").parquet(f"{path}/numbers")
    return FittedFeatures(FeatureMap(**kept["columns"]), kept["as_of"], numbers, kept["sizes"], kept["spreads"], kept["tenths"])


def attach_features(users: DataFrame, features: DataFrame, version: str, output: str = "user_features") -> DataFrame:
    """Users with the stored features of a version; null where there are none."""
    stored = features.where(F.col("tag") == version).groupBy("user_id").agg(F.max(FEATURES).alias(output))
    return users.join(stored, "user_id", "left")
