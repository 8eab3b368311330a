"""Who may be addressed."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.filters import anti, semi, union_all

USER = "user_id"


def feature_population(credit: DataFrame, debit: DataFrame, mobile: DataFrame, open_accounts: Sequence[DataFrame],
                       retainable: DataFrame) -> DataFrame:
    """Card holders that use the mobile app, and open accounts that can be retained online."""
    holders = semi(union_all([credit.select(USER), debit.select(USER)]), mobile, USER)
    accounts = semi(union_all([a.select(USER) for a in open_accounts]), retainable, USER)
    return holders.unionByName(accounts).distinct()


def one_card_pool(held: DataFrame, other: DataFrame, mobile: DataFrame) -> DataFrame:
    """Users of the app that hold one kind of card and not the other."""
    return anti(semi(held.select(USER).distinct(), mobile, USER), other, USER)


def campaign_pool(held: DataFrame, other: DataFrame, mobile: DataFrame, consents: DataFrame, phones: DataFrame,
                  phone: str = "phone_no", digits: int = 11) -> DataFrame:
    """One-card users that agreed to marketing and have a full phone number."""
    reachable = phones.where(F.length(phone) == digits)
    return semi(semi(one_card_pool(held, other, mobile), consents, USER), reachable, USER)


def eligible_customers(attributes: DataFrame, condition: Column, logins: DataFrame, login_day: str, login_from,
                       consents: DataFrame) -> DataFrame:
    """Customers with fitting attributes, a recent login and consent."""
    recent = logins.where(F.col(login_day) >= login_from)
    return semi(semi(attributes.where(condition).select(USER).distinct(), recent, USER), consents, USER)


def redeeming_customers(holdings: DataFrame, redeemed: str, consents: DataFrame, test_users: DataFrame | None = None) -> DataFrame:
    """Customers that took money out lately and agreed to marketing, plus test customers."""
    sold = holdings.where(F.col(redeemed) > 0).select(USER).distinct()
    customers = semi(sold, consents, USER)
    return customers if test_users is None else customers.unionByName(test_users.select(USER)).distinct()


# Codes of the sales channel, open states and series with a trading cycle.
SALES_CHANNEL = "7"
OPEN_STATES = ["0", "1", "6"]
CYCLE_SERIES = ["1301", "D321"]


def products_on_sale(products: DataFrame, sale_day: int) -> DataFrame:
    """Products a private customer can buy on `sale_day` (yyyyMMdd as a number, 0: no end)."""
    cycle_ok = ~F.col("reserve1").isin(CYCLE_SERIES) | (F.col("cycle_tradable") == "1")
    ends = F.coalesce(F.col("ipo_end_date_outer"), F.lit(0))
    return products.where(
        F.contains(F.col("channels"), F.lit(SALES_CHANNEL))
        & F.col("status").isin(OPEN_STATES)
        & cycle_ok
        & (F.col("per_allow") == "1")
        & ((ends == 0) | (ends >= sale_day))
    )


def funds_on_sale(funds: DataFrame, yields: DataFrame, themes: DataFrame, theme: str) -> DataFrame:
    """Funds of the sales channel in a theme with a positive one-year yield."""
    sold = funds.where(F.contains(F.col("channels"), F.lit(SALES_CHANNEL)))
    in_theme = semi(sold, themes.where(F.col("theme_id") == theme), "prod_id")
    rising = yields.where(F.col("rct1y_profit_rate") > 0).groupBy("prod_id").agg(F.max("rct1y_profit_rate").alias("rct1y_profit_rate"))
    return in_theme.join(rising, "prod_id")
