"""Declared tables, drift checks, row inserts, wide feature loading and versioned logs."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranking import first_per_key


class SchemaDrift(ValueError):
    """The stored table no longer has the declared columns."""


@dataclass(frozen=True)
class TableSpec:
    """Name, columns and partition columns (text only) of a table."""

    name: str
    columns: T.StructType
    partitions: tuple[str, ...] = field(default_factory=tuple)

    @classmethod
    def parse(cls, name: str, columns: str, *partitions: str) -> "TableSpec":
        return cls(name, T.StructType.fromDDL(columns), partitions)

    @property
    def schema(self) -> T.StructType:
        keys = [T.StructField(p, T.StringType()) for p in self.partitions]
        return T.StructType(list(self.columns.fields) + keys)


def drift(stored: T.StructType, declared: T.StructType) -> list[str]:
    """Differences between stored and declared columns, in words."""
    have = {f.name: f.dataType for f in stored}
    want = {f.name: f.dataType for f in declared}
    found = [f"missing {n}" for n in want if n not in have]
    found += [f"unknown {n}" for n in have if n not in want]
    found += [f"{n} is {have[n].simpleString()}, not {t.simpleString()}" for n, t in want.items() if n in have and have[n] != t]
    return found


def create_table(spark: SparkSession, spec: TableSpec, location: str | None = None) -> None:
    """Create the table if it is not there; a stored table with other columns is an error,
    nothing is dropped silently."""
    if spark.catalog.tableExists(spec.name):
        found = drift(spark.table(spec.name).schema, spec.schema)
        if found:
            raise SchemaDrift(f"{spec.name}: {'; '.join(found)}")
        return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema)
    keys = f" PARTITIONED BY ({', '.join(spec.partitions)})" if spec.partitions else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE {spec.name} ({columns}) USING parquet{keys}{place}")


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Columns of `df` in declared order and type."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema])


def insert_rows(spark: SparkSession, spec: TableSpec, rows: Sequence[tuple], **partition: str) -> None:
    """Append literal rows to one partition."""
    df = spark.createDataFrame(list(rows), spec.columns)
    for key, value in partition.items():
        df = df.withColumn(key, F.lit(value))
    conform(df, spec).write.mode("append").insertInto(spec.name)


def load_features(users: DataFrame, tables: Sequence[DataFrame], wanted: Sequence[str], user_key: str = "user_id",
                  table_key: str = "cust_id") -> DataFrame:
    """Users with the wanted columns, each taken from the first table that has it.

    Every table is cut to its columns and reduced to a row per user before the join; all
    joins use the same key, so the users are shuffled once.
    """
    missing = list(wanted)
    for table in tables:
        columns = [c for c in missing if c in table.columns]
        if not columns:
            continue
        missing = [c for c in missing if c not in columns]
        rows = table.groupBy(F.col(table_key).alias(user_key)).agg(F.max(F.struct(*columns)).alias("_row"))
        users = users.join(rows, user_key, "left").select(*users.columns, "_row.*")
    return users


def load_feature_snapshots(users: DataFrame, paths: Sequence[str], wanted: Sequence[str], day: str, column: str = "dt",
                           not_after: bool = False, user_key: str = "user_id", table_key: str = "cust_id") -> tuple[DataFrame, dict[str, str]]:
    """`load_features` from stored tables, each read at `day` or, where it has no such partition, at the newest it has.

    Also returns the partition used of each path. Folders are listed; of the files only the chosen are opened."""
    from .partitions import snapshot_of_path

    found = {path: snapshot_of_path(users.sparkSession, path, column, day, not_after) for path in paths}
    tables = [df.drop(column) for df, _ in found.values()]
    return load_features(users, tables, wanted, user_key, table_key), {path: used for path, (_, used) in found.items()}


def append_version(df: DataFrame, path: str, version: str) -> None:
    """Add rows to a log under a version; nothing is overwritten."""
    df.withColumn("version", F.lit(version)).write.mode("append").parquet(path)


def latest_versions(log: DataFrame, keys: Sequence[str] | str, version: Sequence[str] | str) -> DataFrame:
    """Newest row per key of an append-only log; of rows equal in key and version the one that comes first by
    its other columns, so a retry finds the same."""
    names = [version] if isinstance(version, str) else list(version)
    known = {*names, *([keys] if isinstance(keys, str) else keys)}
    rest = [F.to_json(F.struct(F.col(f.name))) if isinstance(f.dataType, T.MapType) else F.col(f.name) for f in log.schema if f.name not in known]
    return first_per_key(log, keys, [*[F.desc(v) for v in names], *rest])
