"""Dated partitions: resolve, scan, write, retire."""

from __future__ import annotations

from typing import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import SchemaDrift, TableSpec


def resolve_partition(partitions: DataFrame, column: str, wanted: str, not_after: bool = False) -> str | None:
    """Partition to read for `wanted`: itself if present, else the largest one.

    `not_after` looks only at partitions up to `wanted`. A table without rows keeps `wanted`.
    """
    known = F.col(column) <= wanted if not_after else F.lit(True)
    row = partitions.where(known).agg(
        F.max(F.when(F.col(column) == wanted, F.col(column))).alias("same"), F.max(column).alias("last")
    ).first()
    return row["same"] or row["last"] or wanted


def snapshot(df: DataFrame, column: str, wanted: str | None, not_after: bool = False) -> tuple[DataFrame, str | None]:
    """Rows of one partition and the partition used; without a date the whole table."""
    if not wanted:
        return df, None
    used = resolve_partition(df.select(column), column, wanted, not_after)
    return df.where(F.col(column) == used), used


def newest(values: Sequence[str], wanted: str, not_after: bool = False) -> str:
    """The partition to read for `wanted` among `values`; `wanted` itself if there are none."""
    known = [v for v in values if not not_after or v <= wanted]
    return wanted if wanted in known or not known else max(known)


def partition_folders(spark: SparkSession, path: str, column: str) -> dict[str, list[str]]:
    """Folders by value of a partition column, from the listing of folder names alone: no file is
    opened. Columns above it are walked through."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    level = [jvm.org.apache.hadoop.fs.Path(path)]
    system = level[0].getFileSystem(conf)
    found: dict[str, list[str]] = {}
    while level and not found:
        folders = [status.getPath() for place in level if system.exists(place) for status in system.listStatus(place) if status.isDirectory()]
        level = [folder for folder in folders if "=" in folder.getName()]
        for folder in level:
            name, _, value = folder.getName().partition("=")
            if unquote(name) == column and value != "__HIVE_DEFAULT_PARTITION__":
                found.setdefault(unquote(value), []).append(folder.toString())
    return found


def snapshot_of_path(spark: SparkSession, path: str, column: str, wanted: str | None, not_after: bool = False) -> tuple[DataFrame, str | None]:
    """Rows of one partition of a stored table, found by its folder, and the partition used.

    Without a date, or where the table has no such partitions, the whole table; the date is kept."""
    folders = partition_folders(spark, path, column) if wanted else {}
    if not wanted or not folders:
        return spark.read.parquet(path), wanted or None
    used = newest(list(folders), wanted, not_after)
    if used not in folders:   # only later ones, and those are not wanted
        return spark.read.parquet(path).limit(0).withColumn(column, F.lit(used)), used
    return spark.read.option("basePath", path).parquet(*folders[used]).withColumn(column, F.lit(used)), used


def snapshot_of_table(spark: SparkSession, table: str, column: str, wanted: str | None, not_after: bool = False) -> tuple[DataFrame, str | None]:
    """The same for a catalog table, from the catalog's list of partitions."""
    if not wanted or column not in [c.name for c in spark.catalog.listColumns(table) if c.isPartition]:
        return spark.table(table), wanted or None
    keys = list_partitions(spark, table).select(F.explode(partition_keys(F.col("partition"))).alias("key")).where(F.col("key.name") == column)
    used = newest([r["value"] for r in keys.select("key.value").distinct().collect()], wanted, not_after)
    return spark.table(table).where(F.col(column) == used), used


def scan_range(df: DataFrame, column: str, start: str | None = None, end: str | None = None,
               values: Sequence[str] | None = None, prefix: str | None = None) -> DataFrame:
    """Partitions between two bounds (both inclusive), in a list, or with a prefix."""
    tests: list[Column] = []
    if start is not None:
        tests.append(F.col(column) >= start)
    if end is not None:
        tests.append(F.col(column) <= end)
    if values is not None:
        tests.append(F.col(column).isin(list(values)))
    if prefix is not None:
        tests.append(F.startswith(F.col(column), F.lit(prefix)))
    for test in tests:
        df = df.where(test)
    return df


def write_partition(df: DataFrame, path: str, fields: Sequence[str], overwrite: bool = True, **partition: str) -> Observation:
    """Write the declared columns into one partition; the others stay.

    The row count comes with the write (`.get["rows"]`), not from a second job.
    """
    if not partition:
        raise ValueError("name the partition to write")
    counted = Observation()
    rows = df.select(*fields, *[F.lit(v).alias(k) for k, v in partition.items()])
    _write(rows.observe(counted, F.count(F.lit(1)).alias("rows")), path, list(partition), overwrite)
    return counted


class PartitionMismatch(ValueError):
    """A write that does not name the partition keys as they are declared."""


def write_declared(df: DataFrame, path: str, spec: TableSpec, overwrite: bool = True, **partition: str) -> Observation:
    """Write one partition of a declared table. Keys, columns and types are checked before any file is touched.

    All partition keys must be named, no other, with text values; every declared column must be there and,
    where its type differs, be one that an ordinary cast turns into the declared one."""
    if list(partition) != list(spec.partitions):
        raise PartitionMismatch(f"{spec.name} has the keys ({', '.join(spec.partitions)}), not ({', '.join(partition)})")
    odd = [k for k, v in partition.items() if not isinstance(v, str) or not v]
    if odd:
        raise PartitionMismatch(f"{spec.name}: {', '.join(odd)} must be text")
    have = {f.name: f.dataType for f in df.schema}
    missing = [f.name for f in spec.columns if f.name not in have]
    if missing:
        raise SchemaDrift(f"{spec.name}: missing {', '.join(missing)}")
    nested = (T.ArrayType, T.MapType, T.StructType)
    wrong = [f"{f.name} is {have[f.name].simpleString()}, not {f.dataType.simpleString()}" for f in spec.columns
             if have[f.name] != f.dataType and (isinstance(f.dataType, nested) or isinstance(have[f.name], nested))]
    if wrong:
        raise SchemaDrift(f"{spec.name}: {'; '.join(wrong)}")
    rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.columns])
    return write_partition(rows, path, [f.name for f in spec.columns], overwrite, **partition)


def write_by_value(df: DataFrame, path: str, keys: Sequence[str], overwrite: bool = True) -> None:
    """Write with the partition taken from the data; only partitions met are replaced."""
    _write(df, path, keys, overwrite)


def _write(df: DataFrame, path: str, keys: Sequence[str], overwrite: bool) -> None:
    writer = df.write.partitionBy(*keys).mode("overwrite" if overwrite else "append")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def partition_keys(column: Column) -> Column:
    """Keys and values of a partition path such as `a=1/b=x%2Fy`, as an array of structs."""
    plain = lambda text: F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
    return F.transform(F.split(column, "/"), lambda part: F.struct(
        plain(F.substring_index(part, "=", 1)).alias("name"), plain(F.regexp_extract(part, "=(.*)$", 1)).alias("value")))


def expired_partitions(names: DataFrame, today, keep_days: int, column: str = "partition") -> DataFrame:
    """Keys of a partition path whose value is a date (yyyyMMdd) before the days kept, and how many partitions have it."""
    keys = names.select(F.explode(partition_keys(F.col(column))).alias("key")).select("key.name", F.col("key.value").alias("date"))
    return keys.where(_expired(F.col("date"), today, keep_days)).groupBy("name", "date").agg(F.count("*").alias("num"))


def _expired(value: Column, today, keep_days: int) -> Column:
    return (F.length(value) == 8) & F.coalesce(F.try_to_date(value, "yyyyMMdd") < F.date_sub(today, keep_days), F.lit(False))


def list_partitions(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {table}")


def has_partition(spark: SparkSession, table: str, **partition: str) -> bool:
    """Whether the table has this partition, in whichever order its keys are named."""
    wanted = F.array_sort(F.array(*[F.struct(F.lit(k).alias("name"), F.lit(str(v)).alias("value")) for k, v in partition.items()]))
    return not list_partitions(spark, table).where(F.array_sort(partition_keys(F.col("partition"))) == wanted).isEmpty()


def _spec(**partition: str) -> str:
    quoted = {k: str(v).replace("\\", "\\\\").replace("'", "\\'") for k, v in partition.items()}
    return "PARTITION (" + ", ".join(f"`{k}`='{v}'" for k, v in quoted.items()) + ")"


def drop_partition(spark: SparkSession, table: str, **partition: str) -> None:
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {_spec(**partition)}")


def retire(spark: SparkSession, table: str, today, keep_days: int) -> list[str]:
    """Drop the expired partitions of a catalog table in one statement; returns their dates."""
    keys = list_partitions(spark, table).select(partition_keys(F.col("partition")).alias("keys"))
    old = F.filter("keys", lambda k: _expired(k["value"], today, keep_days))
    rows = keys.select("keys", F.transform(old, lambda k: k["value"]).alias("dates")).where(F.size("dates") > 0).collect()
    if rows:
        specs = ", ".join(_spec(**{k["name"]: k["value"] for k in row["keys"]}) for row in rows)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    return sorted({date for row in rows for date in row["dates"]})
