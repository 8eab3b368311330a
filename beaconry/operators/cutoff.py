"""The rows in front of a per-group limit, found by histograms before anything is sorted.

Every order column becomes a key of a class (where null and NaN go) and a number, so that keys compare
as the column sorts. One pass counts the rows of each group in bands of the first key; the counts
merge in any order, and the band in which the limit is reached is the cut-off. If more rows lie
in that band than were asked for, it is cut into finer bands, and a band of one key by the next order
column. What is left is all rows up to the cut-off: those within the limit and the rest of one band.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import pin

_FIRST_BANDS = 4096     # per unit of the logarithm, whatever the range of values
_FINE_BANDS = 16384
_RATIO_BANDS = 64
_ROUNDS = 24
_KEY = "struct<class:int,value:double>"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TEXT_BYTES, _TEXT_PARTS = 6, 3


def order_column(name: str) -> Column:
    """`-name` sorts falling, `name` rising."""
    return F.desc(name[1:]) if name.startswith("-") else F.col(name)


def _key(value: Column, falling: bool, known: Column, early: Column | None = None) -> Column:
    """Class and number; `known` is false for null, `early` marks NaN."""
    value = -value if falling else value
    null, nan = (2, 0) if falling else (0, 2)
    kind = F.when(~known, null)
    if early is not None:
        kind = kind.when(early, nan)
    kind = kind.otherwise(1)
    return F.struct(kind.cast("int").alias("class"), F.when(kind == 1, value).otherwise(0.0).cast("double").alias("value")).cast(_KEY)


def order_keys(schema: T.StructType, by: Sequence[str]) -> list[Column]:
    """Keys that compare as the order columns do, as far as they tell rows apart exactly.

    Whole numbers are two keys of 32 bits, dates and times whole numbers, texts their first bytes.
    Behind a key that may be equal for different values there is none, as rows must not be cut by it."""
    keys: list[Column] = []
    for name in by:
        falling, column = name.startswith("-"), F.col(name.lstrip("-"))
        kind = schema[name.lstrip("-")].dataType
        known = column.isNotNull()
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            keys.append(_key(column, falling, known, F.isnan(column)))
            continue
        if isinstance(kind, T.BooleanType):
            keys.append(_key(column.cast("int"), falling, known))
            continue
        if isinstance(kind, T.DateType):
            column = F.unix_date(column)
        elif isinstance(kind, T.TimestampType):
            column = F.unix_micros(column)
        if isinstance(kind, (*_WHOLE, T.DateType, T.TimestampType)):
            whole = column.cast("long")
            keys += [_key(F.shiftright(whole, 32), falling, known), _key(whole.bitwiseAND(0xFFFFFFFF), falling, known)]
            continue
        if isinstance(kind, T.StringType):
            raw = F.hex(F.encode(column, "UTF-8"))
            digits = 2 * _TEXT_BYTES
            keys += [_key(F.conv(F.rpad(F.substring(raw, 1 + i * digits, digits), digits, "0"), 16, 10).cast("long"), falling, known)
                     for i in range(_TEXT_PARTS)]
        else:
            keys.append(_key(column.cast("double"), falling, known))
        break
    return keys


def within_limit(df: DataFrame, groups: Sequence[str], by: Sequence[str], limit: str) -> DataFrame:
    """Rows of `df` up to the cut-off of their group: all of its first `limit` rows in the order `by` (names, `-` for
    falling) and at most as many more, unless whole runs of rows are equal in everything that can be told apart.

    `limit` is one number per group; groups without one, or with one below 1, have no rows."""
    keys = order_keys(df.schema, by)
    names = [f"_g{i}" for i in range(len(groups))]
    limited = df.where(F.col(limit) >= 1)
    rows = limited.select(*[F.col(g).alias(n) for g, n in zip(groups, names)], F.col(limit).cast("long").alias("_limit"), F.array(*keys).alias("_keys"))

    first = F.get("_keys", F.lit(0))
    found, state, open_rows = None, None, rows.select(*names, "_limit", _band(first, first["value"] * 1e6).alias("_band"), first.alias("_key"))
    for _ in range(_ROUNDS):
        state = pin(_crossing(open_rows, state, names, len(keys)))
        ready = state.where("_settled").select(*names, "_cut")
        found = ready if found is None else found.unionByName(ready)
        state = state.where(~F.col("_settled"))
        if state.isEmpty():
            break
        open_rows = _inside(rows, state, names)
    else:
        found = found.unionByName(state.select(*names, "_cut"))
    met = limited.withColumn("_keys", F.array(*keys)).join(found, _same(groups, names))
    return met.where(F.slice("_keys", 1, F.size("_cut")) <= F.col("_cut")).select(*df.columns)


def _same(left: Sequence[str], right: Sequence[str]) -> list[Column]:
    return [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)]


def _logs(value: Column) -> Column:
    """A rising function that is even near zero and logarithmic far from it, on both sides."""
    return F.signum(value) * F.log1p(F.abs(value))


def _band(key: Column, scaled: Column) -> Column:
    """Bands over all numbers: even steps near zero, even ratios far from it. No band holds two classes."""
    place = F.greatest(F.least(_logs(scaled), F.lit(1000.0)), F.lit(-1000.0))
    return key["class"] * F.lit(1 << 40).cast("long") + F.floor(place * _FIRST_BANDS)


def _marks(state: DataFrame, names: list[str]) -> DataFrame:
    return state.select(*[F.col(n).alias(f"_of{n}") for n in names], "_rest", "_prefix", "_low", "_high", "_single")


def _crossing(open_rows: DataFrame, state: DataFrame | None, names: list[str], depth: int) -> DataFrame:
    """Per group the band in which the limit is reached, and whether that is near enough."""
    bands = open_rows.groupBy(*names, "_band").agg(
        F.count("*").alias("_n"), F.max("_key.class").alias("_class"), F.min("_key.value").alias("_least"), F.max("_key.value").alias("_most"),
        F.max("_limit").alias("_limit"))
    upto = Window.partitionBy(*names).orderBy("_band")
    bands = bands.withColumns({"_upto": F.sum("_n").over(upto), "_last": F.lead("_band").over(upto).isNull()})
    if state is None:
        bands = bands.withColumns({"_rest": F.col("_limit"), "_prefix": F.array().cast(f"array<{_KEY}>")})
    else:
        held = state.select(*[F.col(n).alias(f"_of{n}") for n in names], "_rest", "_prefix")
        bands = bands.join(held, _same(names, [f"_of{n}" for n in names]))
    before = F.col("_upto") - F.col("_n")
    hit = bands.where((before < F.col("_rest")) & ((F.col("_upto") >= F.col("_rest")) | F.col("_last")))
    low, high = (F.struct(F.col("_class").alias("class"), F.col(v).alias("value")).cast(_KEY) for v in ("_least", "_most"))
    left, single = F.col("_rest") - before, F.col("_least") == F.col("_most")
    longer = F.concat("_prefix", F.array(high))
    near = (F.col("_n") <= F.col("_limit") + left) | (single & (F.size("_prefix") + 1 >= depth))
    return hit.select(*names, left.alias("_rest"), low.alias("_low"), high.alias("_high"), longer.alias("_cut"),
                      F.when(single, longer).otherwise(F.col("_prefix")).alias("_prefix"), single.alias("_single"), near.alias("_settled"))


def _inside(rows: DataFrame, state: DataFrame, names: list[str]) -> DataFrame:
    """Rows of the crossing bands, in finer bands; a band of one key goes by the next key."""
    met = rows.join(_marks(state, names), _same(names, [f"_of{n}" for n in names]))
    size = F.size("_prefix")
    met = met.where(F.slice("_keys", 1, size) == F.col("_prefix")).withColumn("_key", F.get("_keys", size))
    met = met.where(F.col("_single") | F.col("_key").between(F.col("_low"), F.col("_high")))
    low, high, place = F.col("_low.value"), F.col("_high.value"), F.col("_key.value")
    kind = F.col("_key.class") * F.lit(1 << 40).cast("long")
    # Within a factor of two bands are even, beyond that they go by ratio, 100 orders of magnitude at a time.
    most = F.greatest(F.abs(low), F.abs(high))
    even = F.floor((place - low) / (high - low) * _FINE_BANDS)
    ratio = F.floor(_logs(place / most * 1e100) * _RATIO_BANDS)
    span = (most < float("inf")) & (most > 0)
    band = (F.when(F.col("_single") | ~span, _band(F.col("_key"), place)).when((high - low) * 2 <= most, kind + even).otherwise(kind + ratio))
    return met.select(*names, "_limit", band.alias("_band"), "_key")
