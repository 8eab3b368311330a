"""Registration of a query and its SQL under one name."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import read_table


class Tables:
    """The tables of a data folder by attribute."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory

    def __getattr__(self, name: str) -> DataFrame:
        return read_table(self.spark, self.directory, name)


def decimals_as_doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, which every client reads alike."""
    exact = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({name: F.col(name).cast("double") for name in exact})


def registrar(queries: dict, oracles: dict):
    """Decorator factory: `@query(sql)` above a function of `Tables`."""

    def query(sql: str | None = None, name: str | None = None):
        def register(build: Callable[[Tables], DataFrame]):
            key = name or build.__name__
            if key in queries:
                raise ValueError(f"{key} is registered twice")
            queries[key] = lambda spark, directory: build(Tables(spark, directory))
            if sql is not None:
                oracles[key] = sql
            return build

        return register

    return query
