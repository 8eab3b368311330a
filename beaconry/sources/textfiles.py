"""Delimited text in and out."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIELD_SEPARATOR = "\x01"
DELIVERY_SEPARATOR = "@!@"
NULL_TOKEN = "NULL_VALUE"
HEADER_SUFFIX = ".header"


def read_delimited(spark: SparkSession, path: str, schema: str, sep: str = FIELD_SEPARATOR,
                   header: bool = True) -> DataFrame:
    """Delimited text with a declared schema; rows that do not fit are dropped, whichever columns are used."""
    rows = (spark.read.schema(schema).option("sep", sep).option("header", header).option("mode", "DROPMALFORMED")
            .option("enforceSchema", "true").csv(path))
    # True of every row, but it makes the reader parse all columns, also where few are used.
    return rows.where(F.hash(*rows.columns) >= -2**31)


def write_delimited(df: DataFrame, path: str, sep: str = FIELD_SEPARATOR) -> None:
    """Rows without quotes at `path`, their column names next to it; empty text is written as nothing, like null."""
    df.write.mode("overwrite").option("sep", sep).option("quote", "").option("emptyValue", "").csv(path)
    names = df.sparkSession.createDataFrame([(sep.join(df.columns),)], "value string")
    names.coalesce(1).write.mode("overwrite").text(path + HEADER_SUFFIX)


def read_with_header(spark: SparkSession, path: str, sep: str = FIELD_SEPARATOR) -> DataFrame:
    """Text columns of an export, named by its header file."""
    names = spark.read.text(path + HEADER_SUFFIX).first()["value"].split(sep)
    schema = ", ".join(f"`{n}` string" for n in names)
    return spark.read.schema(schema).option("sep", sep).option("quote", "").csv(path)


def delivery_line(columns: Sequence[str], sep: str = DELIVERY_SEPARATOR, token: str = NULL_TOKEN) -> Column:
    """A delivery row as one line: null and the null token become blank, line breaks a space."""
    cells = [F.coalesce(F.nullif(F.col(c).cast("string"), F.lit(token)), F.lit("")) for c in columns]
    return F.regexp_replace(F.concat_ws(sep, *cells), r"[\r\n]+", " ")


def delivery_manifest(lines: DataFrame, name: str, header: str, column: str = "value") -> DataFrame:
    """File name, bytes (header and line ends included) and data rows."""
    start = len(header.encode()) + 1
    size = F.coalesce(F.sum(F.octet_length(column) + 1), F.lit(0)) + start
    return lines.agg(F.lit(name).alias("file_name"), size.cast("bigint").alias("bytes"), F.count("*").alias("rows"))


def write_delivery(df: DataFrame | None, spark: SparkSession, path: str, name: str, columns: Sequence[str],
                   sep: str = DELIVERY_SEPARATOR) -> DataFrame:
    """Write header, lines and manifest of a delivery; missing data gives an empty delivery."""
    header = sep.join(columns)
    if df is None:
        lines = spark.createDataFrame([], "value string")
    else:
        lines = df.select(delivery_line(columns, sep).alias("value"))
    target = f"{path}/{name}"
    spark.createDataFrame([(header,)], "value string").coalesce(1).write.mode("overwrite").text(target + HEADER_SUFFIX)
    lines.write.mode("overwrite").text(target)
    manifest = delivery_manifest(spark.read.text(target), name, header)
    manifest.coalesce(1).write.mode("overwrite").json(target + ".manifest")
    return manifest
