"""Row filters and clean-up that come from configuration."""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def where_all(df: DataFrame, conditions: Mapping[str, str]) -> DataFrame:
    """All configured SQL conditions at once."""
    if not conditions:
        return df
    return df.where(reduce(Column.__and__, [F.expr(f"({c})") for c in conditions.values()]))


def keep_matching(users: DataFrame, attributes: DataFrame, conditions: Mapping[str, str], user_key: str,
                  attribute_key: str) -> DataFrame:
    """Users that have a row of attributes meeting every condition."""
    if not conditions:
        return users
    passing = where_all(attributes, conditions).select(F.col(attribute_key).alias(user_key))
    return semi(users, passing, user_key)


def select_by_tags(df: DataFrame, tags: Mapping[str, object]) -> DataFrame:
    """Rows whose columns equal a value or lie in a list, all tags together."""

    def test(name: str, wanted: object) -> Column:
        if isinstance(wanted, (str, int)):
            return F.col(name) == wanted
        if isinstance(wanted, (list, tuple)):
            return F.col(name).isin(list(wanted))
        raise ValueError(f"tag {name} takes text, int or a list, not {wanted!r}")

    return df.where(reduce(Column.__and__, [test(n, v) for n, v in tags.items()], F.lit(True)))


def semi(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of `left` with a partner. The right keys are made distinct first, so a key that
    repeats there is reduced before the shuffle."""
    keys = [on] if isinstance(on, str) else list(on)
    return left.join(right.select(*keys).distinct(), keys, "left_semi")


def anti(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of `left` without a partner, right keys made distinct first."""
    keys = [on] if isinstance(on, str) else list(on)
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


def blank_keys(df: DataFrame, *columns: str) -> DataFrame:
    """Null key parts as '' so that they meet in joins."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in columns})


def fill_features(df: DataFrame, numeric: Sequence[str], text: Sequence[str]) -> DataFrame:
    """Numbers to double with null, NaN and text that is no number as 0; null and empty text as NA."""
    df = df.withColumns({c: F.coalesce(F.nanvl(F.col(c).try_cast("double"), F.lit(0.0)), F.lit(0.0)) for c in numeric})
    return df.withColumns({c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("NA")) for c in text})


def fill_token(df: DataFrame, columns: Sequence[str], token: str = "NULL_VALUE") -> DataFrame:
    return df.fillna(token, subset=list(columns))


def with_constants(df: DataFrame, **values: object) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def with_reserves(df: DataFrame, count: int = 10, token: str = "NULL_VALUE", prefix: str = "rev") -> DataFrame:
    """Reserve columns rev1..revN."""
    return with_constants(df, **{f"{prefix}{i}": token for i in range(1, count + 1)})


def union_present(sources: Sequence[DataFrame | None]) -> DataFrame | None:
    """Union by name of the sources that exist; None when none does. Empty sources add
    nothing, so they are not looked for, which would cost a run of each."""
    present = [s for s in sources if s is not None]
    return reduce(DataFrame.unionByName, present) if present else None


def union_all(sources: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, sources)
