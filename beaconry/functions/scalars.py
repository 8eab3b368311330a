"""Scalar expressions shared by the campaign operators."""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_HASH_DIGITS = 12
_HASH_RANGE = float(16**_HASH_DIGITS)


def unit_hash(salt: str, *columns) -> Column:
    """Number in [0, 1) fixed by the salt and the columns.

    Stands in for `rand()` wherever a draw must survive retries and be repeatable.
    """
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    text = F.concat_ws("|", F.lit(salt), *parts)
    digits = F.substring(F.md5(text.cast("binary")), 1, _HASH_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(_HASH_RANGE)


def split_part(value, separator_pattern: str, index: int) -> Column:
    """Part `index` (from 0) of a split; null past the end."""
    return F.get(F.split(value, separator_pattern), index)


def trim_zeros(value) -> Column:
    """Decimal text without trailing zeros, keeping one digit after the point."""
    return F.regexp_replace(F.regexp_replace(value, r"(\.\d*?)0+$", "$1"), r"\.$", ".0")


def safe_log1p(value) -> Column:
    """log1p of the value with null and negatives taken as 0."""
    return F.log1p(F.greatest(F.coalesce(value.cast("double"), F.lit(0.0)), F.lit(0.0)))


def money(value) -> Column:
    """Exact two-digit amount, so that sums do not depend on the order of rows."""
    return value.cast("decimal(18,2)")


def in_home_currency(amount, currency, home: str = "CNY", rate: float = 6.7) -> Column:
    """Amount as is in the home currency, else times the rate; 0 stays 0."""
    factor = F.when(currency == home, F.lit(1).cast("decimal(5,2)")).otherwise(F.lit(rate).cast("decimal(5,2)"))
    return F.coalesce(amount * factor, F.lit(0))


def argmax(values) -> Column:
    """Position (from 0) of the first largest element."""
    return F.array_position(values, F.array_max(values)).cast("int") - 1


def cosine(left, right) -> Column:
    """Cosine similarity of two arrays; 0 for null, empty or zero vectors."""

    def dot(a, b):
        products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)

    norms = F.sqrt(dot(left, left)) * F.sqrt(dot(right, right))
    return F.coalesce(F.when(norms > 0, dot(left, right) / norms), F.lit(0.0))


def lookup(value, mapping: Mapping, default=None) -> Column:
    """Dictionary lookup for small fixed mappings."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), F.lit(default))


def case_of(branches: Sequence[tuple[Column, object]], default=None) -> Column:
    """Searched CASE built from (condition, value) pairs of the configuration."""
    first, *rest = branches
    start = F.when(first[0], first[1])
    return reduce(lambda acc, b: acc.when(b[0], b[1]), rest, start).otherwise(default)


# Patterns that define what counts as noise in a marketing text.
PLACEHOLDER = r"\$\{(.+?)\}"
URL = r"[-a-zA-Z0-9@:%._\+~#=]{1,256}\.[a-zA-Z0-9()]{1,6}\b([-a-zA-Z0-9()@:%_\+.~#?&//=]*)"
SALUTATION = r"(尊敬|亲爱)的.*(先生|女士)(：|，)"


def clean_ad(text) -> Column:
    """Marketing text without placeholders, addresses of web pages and salutations."""
    for pattern in (PLACEHOLDER, URL, SALUTATION):
        text = F.regexp_replace(text, pattern, "")
    return text


# Fixed value: mark of the organisation level behind a branch name.
BRANCH_SUFFIX = "(分行级)"


def branch_name(value, bank: str, suffix: str = BRANCH_SUFFIX) -> Column:
    """Branch name without the bank's name in front or the level mark behind."""
    return (
        F.when(F.startswith(value, F.lit(bank)), F.substr(value, F.lit(len(bank) + 1)))
        .when(F.contains(value, F.lit(suffix)), F.substring_index(value, suffix, 1))
        .otherwise(value)
    )


def json_field(text, name: str) -> Column:
    return F.get_json_object(text, f"$.{name}")


def register_sql_functions(spark: SparkSession) -> None:
    """The scalar functions by name for people who write SQL; bodies are plain SQL
    expressions, so calls are inlined by the optimiser."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION clean_ad(t STRING) RETURNS STRING RETURN "
        f"regexp_replace(regexp_replace(regexp_replace(t, r'{PLACEHOLDER}', ''), r'{URL}', ''), r'{SALUTATION}', '')"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION vector_sim(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>) RETURNS DOUBLE RETURN "
        "coalesce(try_divide(aggregate(zip_with(a, b, (x, y) -> x * y), 0D, (s, x) -> s + x), "
        "sqrt(aggregate(a, 0D, (s, x) -> s + x * x)) * sqrt(aggregate(b, 0D, (s, x) -> s + x * x))), 0D)"
    )
    # A value as JSON text, null as null; and an object from names and such values, in their order.
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION to_json_text(t STRING) RETURNS STRING RETURN "
        "coalesce(regexp_extract(to_json(array(t)), '(?s)^.(.*).$', 1), 'null')"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION build_json(names ARRAY<STRING>, texts ARRAY<STRING>) RETURNS STRING RETURN "
        "concat('{', array_join(zip_with(names, texts, (n, t) -> concat(coalesce(regexp_extract(to_json(array(n)), '(?s)^.(.*).$', 1), 'null'), ':', coalesce(t, 'null'))), ','), '}')"
    )
