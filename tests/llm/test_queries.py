"""Queries of the subpackage next to their SQL."""

import duckdb
import pytest

from beaconry.llm.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.01"
NATIVE = ("op1_url_filters", "op6_benchmark_decontamination", "op9_chat_formatting")


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = QUERIES[name](spark, DATA)
    python = ("Python", "InPandas", "InArrow") if name in NATIVE else ()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [mark for mark in ("CartesianProduct", "BroadcastNestedLoopJoin", *python) if mark in plan]
    rows, result = df.collect(), duck.execute(ORACLES[name])
    assert rows and table(df.columns, rows) == table([d[0] for d in result.description], result.fetchall())
