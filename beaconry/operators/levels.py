"""Best products per customer under "product level <= customer level" rules.

The values of both sides go through one range-partitioned order, in which a running count of levels
gives every value its number. The best up to a level are merged from few blocks of levels: a product lies
in one block of each size 1, 2, 4, ..., a prefix of levels falls into at most one block of each
size, and the k best of a block are all it ever needs. So with L levels a product is copied about log L / 2
times, a list is merged from at most log L blocks, and neither customer x product pairs nor a grid
of all level combinations is built: only the combinations that customers have. Level values stay
in tables; what the driver learns is how many there are.

A null or NaN level or reach fits nothing.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin
from .ranking import top_k, total_before

_SIZE_BITS = 64  # a block is numbered by its place among those of its size, times this, plus its size


def level_value(column: Column) -> Column:
    """What levels are compared by: a number; NaN counts as null."""
    value = column.cast("double")
    return F.when(~F.isnan(value), value)


def _values(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Distinct (name, value) of several level columns."""
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), level_value(F.col(n)).alias("value")) for n in names])
    return df.select(F.explode(pairs).alias("p")).select("p.*").where("value is not null").distinct()


def level_numbers(products: DataFrame, reaches: DataFrame, names: Sequence[str]) -> DataFrame:
    """(name, value, number) of every value of the columns `names` on either side: how many distinct levels
    of `products` lie at or below it. One sort serves all columns."""
    known = _values(products, names).select("name", "value", F.lit(1).alias("_levels"), F.lit(0).alias("_side"))
    asked = _values(products, names).union(_values(reaches, names)).distinct()
    both = known.union(asked.select("name", "value", F.lit(0), F.lit(1)))
    placed = total_before(both, [F.col("value"), F.col("_side")], "_levels", ["name"], "number")
    return pin(placed.where("_side = 1").select("name", "value", F.col("number").cast("int").alias("number")))


def with_numbers(df: DataFrame, numbers: DataFrame, names: Sequence[str]) -> DataFrame:
    """`df` with its level columns replaced by their numbers (null: no level)."""
    for name in names:
        own = numbers.where(F.col("name") == name).select(F.col("value").alias("_value"), F.col("number").alias("_number"))
        joined = df.withColumn("_value", level_value(F.col(name))).join(own, "_value", "left")
        df = joined.withColumn(name, F.col("_number")).select(*df.columns)
    return df


def level_bits(numbers: DataFrame, names: Sequence[str]) -> dict[str, int]:
    """Binary digits of the number of levels of each column."""
    counts = {r["name"]: r["n"] for r in numbers.groupBy("name").agg(F.max("number").alias("n")).collect()}
    return {name: int(counts.get(name, 0)).bit_length() for name in names}


def blocks_with(number: str, bits: int) -> Column:
    """Blocks that hold a level and that prefixes may consist of: those at even places of each size."""
    return _blocks(f"`{number}` - 1", "0", "0", bits)


def blocks_upto(number: str, bits: int) -> Column:
    """Blocks that levels 1..number fall into: one for each binary one of the number."""
    return _blocks(f"`{number}`", "1", "1", bits)


def _blocks(value: str, wanted: str, back: str, bits: int) -> Column:
    if not bits:
        return F.array().cast("array<bigint>")
    place = f"shiftright(cast({value} as bigint), j)"
    return F.expr(f"transform(filter(sequence(0, {bits - 1}), j -> {place} % 2 = {wanted}), j -> ({place} - {back}) * {_SIZE_BITS} + j)")


def best_upto(products: DataFrame, wanted: DataFrame, bits: Mapping[str, int], order: Sequence[Column], k: int,
              groups: Sequence[str] = (), rank: str = "rank") -> DataFrame:
    """For every combination of level numbers in `wanted`, the k best products of each group that lie at or below
    it in all levels.

    Products are cut to k per combination first, then level after level is replaced by the blocks that
    hold it and cut to k again."""
    names = list(bits)
    best = top_k(products.where(" and ".join(f"`{n}` >= 1" for n in names)), [*groups, *names], order, k, rank).drop(rank)
    for name in names:
        best = top_k(best.withColumn(name, F.explode(blocks_with(name, bits[name]))), [*groups, *names], order, k, rank).drop(rank)
    asked = wanted.select(*names).distinct()
    for name in names:
        asked = asked.withColumn(f"_{name}", F.explode(blocks_upto(name, bits[name])))
    met = asked.join(best.withColumnsRenamed({n: f"_{n}" for n in names}), [f"_{n}" for n in names])
    return top_k(met.drop(*[f"_{n}" for n in names]), [*groups, *names], order, k, rank)


def sum_upto(products: DataFrame, reaches: DataFrame, level: str, amount: Column, output: str) -> DataFrame:
    """(value, output): for every value of `level` in `reaches`, the sum of `amount` over the products at or below it."""
    known = products.select(level_value(F.col(level)).alias("value"), amount.alias("_amount")).where("value is not null")
    known = known.groupBy("value").agg(F.sum("_amount").alias("_amount"))
    asked = _values(reaches, [level]).select("value", F.lit(0).cast(known.schema["_amount"].dataType))
    both = known.select("value", "_amount", F.lit(0).alias("_side")).union(asked.select("*", F.lit(1)))
    placed = total_before(both, [F.col("value"), F.col("_side")], "_amount", output=output)
    return placed.where("_side = 1").select("value", output)
