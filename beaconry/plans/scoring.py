"""Fitted trees and linear models as SQL expressions.

A model becomes one text of standard SQL over its feature columns: scores are worked out by generated code
in the scan of a pool, any client of the warehouse can repeat them, and no vector column is built.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence, Union

from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .models import FEATURES


def _number(value: float) -> str:
    return f"CAST('{float(value)!r}' AS DOUBLE)"


@dataclass(frozen=True)
class Split:
    """A node: rows go left if the feature is at most the limit or, where `values` are given, one of them."""

    feature: int
    limit: float
    left: "Node"
    right: "Node"
    values: tuple[float, ...] = ()

    def test(self, names: Sequence[str]) -> str:
        name = names[self.feature]
        return f"{name} IN ({', '.join(map(_number, self.values))})" if self.values else f"{name} <= {_number(self.limit)}"


Node = Union[Split, float]


def _node_sql(node: Node, names: Sequence[str]) -> str:
    if not isinstance(node, Split):
        return _number(node)
    return f"CASE WHEN {node.test(names)} THEN {_node_sql(node.left, names)} ELSE {_node_sql(node.right, names)} END"


@dataclass(frozen=True)
class TreeScore:
    """Weighted trees whose sum is half the log odds of class 1."""

    trees: tuple[tuple[float, Node], ...]

    def probabilities(self, names: Sequence[str]) -> list[str]:
        margin = " + ".join(f"{_number(weight)} * ({_node_sql(root, names)})" for weight, root in self.trees) or _number(0)
        one = f"(1 / (1 + exp(-2 * ({margin}))))"
        return [f"(1 - {one})", one]


@dataclass(frozen=True)
class LinearScore:
    """One row of weights and an intercept per class; a single row gives the log odds of class 1."""

    weights: tuple[tuple[float, ...], ...]
    intercepts: tuple[float, ...]

    def probabilities(self, names: Sequence[str]) -> list[str]:
        margins = [" + ".join([_number(b), *[f"{_number(w)} * {name}" for w, name in zip(row, names) if w]]) for row, b in zip(self.weights, self.intercepts)]
        if len(margins) == 1:
            one = f"(1 / (1 + exp(-({margins[0]}))))"
            return [f"(1 - {one})", one]
        # 1 / sum of ratios: no power overflows unless its class is out of the question.
        return ["(1 / (" + " + ".join("1" if i == j else f"exp(least(({other}) - ({own}), 700))" for j, other in enumerate(margins)) + "))" for i, own in enumerate(margins)]


def from_model(model) -> TreeScore | LinearScore:
    """The rules of a fitted model."""
    if isinstance(model, GBTClassificationModel):
        roots = [tree._call_java("rootNode") for tree in model.trees]
        return TreeScore(tuple(zip(map(float, model.treeWeights), map(_read_node, roots))))
    if isinstance(model, LogisticRegressionModel):
        return LinearScore(tuple(tuple(map(float, row)) for row in model.coefficientMatrix.toArray()), tuple(map(float, model.interceptVector.toArray())))
    raise ValueError(f"no SQL for {type(model).__name__}")


def _read_node(node) -> Node:
    if node.getClass().getSimpleName() == "LeafNode":
        return float(node.prediction())
    split = node.split()
    continuous = split.getClass().getSimpleName() == "ContinuousSplit"
    values = () if continuous else tuple(float(v) for v in split.leftCategories())
    return Split(int(split.featureIndex()), float(split.threshold()) if continuous else 0.0, _read_node(node.leftChild()), _read_node(node.rightChild()), values)


def score_columns(scorer: TreeScore | LinearScore, features: str = FEATURES, width: int = 0) -> list[Column]:
    """Probability of each class from a feature array; 0 for every class where there is none."""
    names = [f"get({features}, {i})" for i in range(width)]
    return [F.when(F.col(features).isNull(), 0.0).otherwise(F.expr(text)) for text in scorer.probabilities(names)]


def score_pool_by_rules(users: DataFrame, scorer: TreeScore | LinearScore, columns: Sequence[str]) -> DataFrame:
    """Users with the probability of class 1 as score; `columns` are the features by position, null as 0."""
    names = [f"coalesce(CAST({c} AS DOUBLE), CAST(0 AS DOUBLE))" for c in columns]
    kept = [c for c in users.columns if c not in columns]
    return users.select(*kept, F.expr(scorer.probabilities(names)[1]).alias("score"))
