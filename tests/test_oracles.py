"""Every query next to its SQL, on the smallest data."""

import decimal
import os

import duckdb
import numpy as np
import pytest

import __spark_entry__ as contract
from beaconry.bindings import all_oracles, all_queries

DATA = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
QUERIES, ORACLES = all_queries(), all_oracles()
NOT_DISTRIBUTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or isinstance(value, (bool, str)):
        return value
    if isinstance(value, (int, np.integer)):
        return int(value)
    if isinstance(value, (float, np.floating, decimal.Decimal)):
        return None if value != value else float(value)
    if isinstance(value, (list, tuple, np.ndarray)):
        return tuple(plain(v) for v in value)
    return str(value)


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [mark for mark in NOT_DISTRIBUTED if mark in plan]
    if name in ORACLES:
        result = duck.execute(ORACLES[name])
        assert table(df.columns, rows) == table([d[0] for d in result.description], result.fetchall())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["user_id", "user_type", "score", "rank", "try_push"]
    df.count()


def test_only_random_and_trained_results_have_no_sql():
    assert set(QUERIES) - set(ORACLES) == {
        "sample_random_split", "group_random_assignment", "feature_vectors_fitted",
        "model_propensity_scores", "model_product_scores", "model_saved_inference", "metric_model_evaluation"}
