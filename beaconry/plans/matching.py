"""Products that fit a customer.

Every rule says that some product attribute must not exceed the customer's. The best products are worked out
once per combination of limits that customers have and met by an equi join; customer x product pairs are
never built and nothing is left out.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.product_text import advertised_yield, benchmark_number
from ..operators.levels import best_upto, level_bits, level_numbers, level_value, with_numbers
from ..operators.ranking import first_per_key, top_k
from ..session import pin

DIAMOND_LEVELS = (53, 54)
OLD_AGE = 75
OLD_MAX_RISK = 3
ANY_LEVEL = 1_000_000
PRIVATE_KIND = "2"


def product_rule(products: DataFrame) -> DataFrame:
    """Products with the one rule that applies to them: the first of whitelist, new client,
    diamond card, salary, pension; else the customer level."""
    flagged = lambda name: F.coalesce(F.col(name), F.lit("0")) == "1"
    rule = (
        F.when(flagged("list_type"), "whitelist")
        .when(flagged("is_new_client_prd"), "new")
        .when(flagged("diamond_card_flag"), "diamond")
        .when(flagged("salary_card_flags"), "salary")
        .when(flagged("pension_funds_flag"), "pension")
        .otherwise("level")
    )
    level = F.coalesce(F.trim(F.col("service_level").cast("string")).try_cast("int"), F.lit(0))
    return products.select(
        "prod_id", "benchmark", F.col("prd_time_limit").alias("term"), F.col("risk_level").try_cast("int").alias("risk"),
        rule.alias("rule"), F.when(rule == "level", level).otherwise(0).alias("level"),
        (F.coalesce(F.col("ipo_type"), F.lit("")) == PRIVATE_KIND).alias("private"),
    )


_LEVELS = ["level", "private", "risk", "term"]
_FLAGS = ["new", "diamond", "salary", "pension"]


def customer_profile(customers: DataFrame) -> DataFrame:
    """Customers with what the rules compare, every limit as a number that a product's must
    not exceed. Without a valid risk test every risk is open; certification opens private
    products; the average term counts as 1 when unknown."""
    flag = lambda name: F.coalesce(F.col(name), F.lit("0")) == "1"
    level = F.coalesce(F.col("service_level_cust").try_cast("int"), F.lit(0))
    risk = F.coalesce(F.col("risk_level_cust").try_cast("int"), F.lit(0))
    term = F.coalesce(F.col("avg_term"), F.lit(1.0)) if "avg_term" in customers.columns else F.lit(float(ANY_LEVEL))
    return customers.select(
        "cust_id", level.alias("level"), flag("auth_type").cast("int").alias("private"),
        F.when(flag("risk_fin_valid_ind"), risk).otherwise(ANY_LEVEL).alias("risk"), term.alias("term"),
        flag("is_new_client").alias("is_new"), level.isin(*DIAMOND_LEVELS).alias("is_diamond"),
        flag("salary_ind").alias("is_salary"), flag("pension_ind").alias("is_pension"),
    )


def rule_lists(customers: DataFrame, products: DataFrame, whitelist: DataFrame, k: int) -> DataFrame:
    """The k products with the highest benchmark each customer may buy; customers without
    any get a null list. The term rule applies when the customers have `avg_term`.

    customers: cust_id and rule attributes. products: on sale. whitelist: cust_id, prod_id.
    """
    with_term = "avg_term" in customers.columns
    names = _LEVELS if with_term else _LEVELS[:-1]   # a limit that is the same for all is no key to join by
    ruled = product_rule(products)
    # without a risk a product fits only customers whose risk is open, without a term nobody
    ruled = ruled.withColumns({
        "risk": F.coalesce("risk", F.lit(ANY_LEVEL)), "private": F.col("private").cast("int"),
        "term": F.col("term") if with_term else F.lit(0),
    }).where(F.col("term").isNotNull())
    order = [F.desc("benchmark"), F.col("prod_id")]

    profiles = pin(customer_profile(customers))   # narrow; read for its limits, its own lists and the result
    limits = profiles.select(*names).distinct()
    grid = ruled.where(F.col("rule") != "whitelist").select("rule", "prod_id", "benchmark", *names)
    numbers = level_numbers(grid, limits, names)
    numbered = with_numbers(limits.select(*names, *[F.col(n).alias(f"own_{n}") for n in names]), numbers, names)
    best = best_upto(with_numbers(grid, numbers, names), numbered, level_bits(numbers, names), order, k, ["rule"])

    last = F.lit(float("inf"))  # products without benchmark come last, as they do in `order`
    entry = F.struct(F.coalesce(-F.col("benchmark"), last).alias("down"), F.col("prod_id"))
    lists = best.groupBy(*names).agg(*[
        F.collect_list(F.when(F.col("rule") == rule, entry)).alias(f"_{rule}") for rule in ("level", *_FLAGS)
    ])
    shared = numbered.join(lists, names).drop(*names)   # one row per combination of limits, k products per rule
    shared = shared.withColumnsRenamed({f"own_{n}": n for n in names})

    special = ruled.where(F.col("rule") == "whitelist").select(
        "prod_id", "benchmark", *[F.col(n).alias(f"_{n}") for n in ("private", "risk", "term")])
    listed = whitelist.join(special, "prod_id").select("cust_id", *special.columns).distinct()
    own = listed.join(profiles, "cust_id").where(
        (F.col("_private") <= F.col("private")) & (F.col("_risk") <= F.col("risk")) & (F.col("_term") <= F.col("term")))
    own = top_k(own, "cust_id", order, k).groupBy("cust_id").agg(F.collect_list(entry).alias("_own"))

    nothing = F.array().cast("array<struct<down:double,prod_id:string>>")
    open_lists = [F.coalesce("_level", nothing)]
    open_lists += [F.when(F.col(f"is_{rule}"), F.coalesce(f"_{rule}", nothing)).otherwise(nothing) for rule in _FLAGS]
    merged = F.slice(F.array_sort(F.concat(*open_lists, F.coalesce("_own", nothing))), 1, k)
    ids = F.transform(merged, lambda p: p["prod_id"])
    return (
        profiles.join(shared, names, "left").join(own, "cust_id", "left")
        .select("cust_id", F.when(F.size(ids) > 0, ids).alias("prod_list"))
    )


def average_terms(subscriptions: DataFrame, products: DataFrame) -> DataFrame:
    """Average term of the products a customer subscribed; unknown products count as null."""
    terms = products.select("prod_id", F.coalesce("prd_time_limit", F.lit(0)).alias("_term"))
    return subscriptions.join(terms, "prod_id", "left").groupBy("cust_id").agg(F.avg("_term").alias("avg_term"))


def level_lists(customers: DataFrame, reach: str, products: DataFrame, level: str, order: Sequence[Column], k: int) -> DataFrame:
    """The k best products with `level` at or below the customer's `reach`; null list if none."""
    known = products.withColumn("_level", F.col(level))
    limits = customers.select(level_value(F.col(reach)).alias("_level")).where("_level is not null").distinct()
    numbers = level_numbers(known, limits, ["_level"])
    numbered = with_numbers(limits.withColumn("_reach", F.col("_level")), numbers, ["_level"])
    best = best_upto(with_numbers(known, numbers, ["_level"]), numbered, level_bits(numbers, ["_level"]), order, k, rank="_rank")
    pairs = F.sort_array(F.collect_list(F.struct("_rank", "prod_id")))
    lists = best.groupBy("_level").agg(F.transform(pairs, lambda p: p["prod_id"]).alias("prod_list"))
    shared = numbered.join(lists, "_level").select("_reach", "prod_list")
    return customers.withColumn("_reach", level_value(F.col(reach))).join(shared, "_reach", "left").select("cust_id", "prod_list")


def fund_risk(age: Column, risk: Column) -> Column:
    """Highest fund risk a customer may take: the tested one, for old customers at most 3."""
    return F.when(age < OLD_AGE, risk).when(age >= OLD_AGE, F.least(risk, F.lit(OLD_MAX_RISK)))


def with_contact(lists: DataFrame, contacts: DataFrame, digits: int = 11, label: Column | None = None) -> DataFrame:
    """Lists with name and phone of customers that have a full phone number."""
    known = contacts.where(F.col("cust_name").isNotNull() & (F.length("phone_number") == digits))
    if label is not None:
        known = known.where(label)
    one = known.groupBy("cust_id").agg(F.max(F.struct("cust_name", "phone_number")).alias("_c"))
    return lists.join(one, "cust_id", "left").select(*lists.columns, "_c.cust_name", "_c.phone_number")


def third_party_lists(results: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """One product per customer from an outside list, as a list of one, with its kind."""
    fitting = results.where(F.col("item_type").isin(list(kinds)))
    one = first_per_key(fitting, "cust_id", [F.col("item_type"), F.col("prod_id")])
    return one.select("cust_id", F.array("prod_id").alias("prod_list"), "item_type")


def product_info(wanted: DataFrame, default_product: str, info: DataFrame) -> DataFrame:
    """Attributes of the wanted products and of the default product, one row each.

    Where `info` has the kind of yield (guest_type), tb_reco_1 is the yield of that kind; where it has a
    benchmark, benchmark_f is its upper bound as a number."""
    spark = wanted.sparkSession
    default = spark.createDataFrame([(default_product,)], "prod_id string")
    ids = wanted.select(F.col("prod_id").cast("string")).unionByName(default).distinct()
    found = ids.join(first_per_key(info, "prod_id", [F.col(c) for c in info.columns if c != "prod_id"]), "prod_id", "left")
    extra = {}
    if "guest_type" in info.columns:
        extra["tb_reco_1"] = advertised_yield(F.col("guest_type"), info.columns)
    if "benchmark" in info.columns:
        extra["benchmark_f"] = benchmark_number(F.col("benchmark"))
    return found.withColumns(extra) if extra else found
