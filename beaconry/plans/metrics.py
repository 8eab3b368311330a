"""Model metrics, computed where the scores are."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import total_before


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall and F1 from one pass of counts."""
    hit = lambda y, p: F.count_if((F.col(label) == y) & (F.col(prediction) == p))
    counts = df.agg(hit(1, 1).alias("tp"), hit(0, 1).alias("fp"), hit(1, 0).alias("fn"), hit(0, 0).alias("tn"))
    safe = lambda a, b: F.when(b == 0, F.lit(0.0)).otherwise(a / b)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        "tp", "fp", "fn", "tn", safe(tp + tn, tp + fp + fn + tn).alias("accuracy"), safe(tp, tp + fp).alias("precision"),
        safe(tp, tp + fn).alias("recall"), safe(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def auc(df: DataFrame, groups: Sequence[str] = (), score: str = "score", positive: str = "positive") -> DataFrame:
    """Area under the ROC curve per group from the rank sum; equal scores share their mean
    rank. `positive` is 1 or 0. Null for a group with one class only.

    Equal scores are counted together first, so a score that most rows share is one row
    when the scores are put in order.
    """
    groups = list(groups)
    whole = "decimal(20,0)"
    hit = F.col(positive).cast("int")
    ties = df.groupBy(*groups, score).agg(F.sum(hit).alias("_p"), F.count("*").alias("_n"))
    placed = total_before(ties, [F.col(score)], "_n", groups, "_low")
    # twice the mean rank of a tie is 2 x rows in front + its rows + 1: whole numbers all along
    twice = (F.col("_low") * 2 + F.col("_n") + 1).cast(whole)
    sums = placed.groupBy(*groups).agg(
        F.sum(F.col("_p").cast(whole) * twice).alias("_twice"), F.sum("_p").alias("positives"),
        F.sum(F.col("_n") - F.col("_p")).alias("negatives"),
    )
    p, n = F.col("positives").cast(whole), F.col("negatives").cast(whole)
    area = F.try_divide((F.col("_twice") - p * (p + 1)).cast("double") / 2.0, (p * n).cast("double"))
    return sums.select(*groups, "positives", "negatives", area.alias("auc"))


def class_range(spark: SparkSession, classes: int, label: str) -> DataFrame:
    """The classes 0 to `classes` - 1."""
    return spark.range(classes).select(F.col("id").cast("int").alias(label))


def with_class_rows(df: DataFrame, classes: int, label: str = "label", probability: str = "probability") -> DataFrame:
    """Scores plus a certain row for every class 0 to `classes` - 1 without samples; other labels stay as they are."""
    rows = df.select(F.col(label).cast("int").alias(label), F.col(probability).cast("array<double>").alias(probability))
    sure = F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda i: (i == F.col(label)).cast("double"))
    missing = class_range(df.sparkSession, classes, label).join(rows.select(label).distinct(), label, "left_anti")
    return rows.unionByName(missing.select(label, sure.alias(probability)))


def one_vs_rest_auc(df: DataFrame, label: str = "label", probability: str = "probability") -> DataFrame:
    """AUC of every class against all others."""
    rows = df.select(F.col(label).alias("_y"), F.posexplode(probability).alias("class", "score"))
    return auc(rows.select("class", "score", (F.col("_y") == F.col("class")).alias("positive")), ["class"])


def one_vs_one_auc(df: DataFrame, classes: int, label: str = "label", probability: str = "probability") -> DataFrame:
    """AUC of every ordered pair of classes: scores of the first on rows of the two.

    A row takes part once as positive of its own class and once as negative against each
    other class, so it becomes 2 x (classes - 1) rows; no rows are paired up.
    """
    others = F.filter(F.sequence(F.lit(0), F.lit(classes - 1)), lambda c: c != F.col(label))

    def sides(c):
        own = F.struct(F.col(label).alias("class"), c.alias("other"), F.get(probability, F.col(label)).alias("score"), F.lit(1).alias("positive"))
        against = F.struct(c.alias("class"), F.col(label).alias("other"), F.get(probability, c).alias("score"), F.lit(0).alias("positive"))
        return F.array(own, against)

    rows = df.withColumn("_side", F.explode(F.flatten(F.transform(others, sides)))).select("_side.*")
    return auc(rows, ["class", "other"])


def macro_average(per_class: DataFrame, output: str) -> DataFrame:
    """Mean of the class values; also the mean over pairs, as every pair counts both ways."""
    return per_class.agg(F.avg("auc").alias(output))
