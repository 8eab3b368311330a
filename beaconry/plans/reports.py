"""Reports, extracts and the warehouse union."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import shift_ymd
from ..functions.scalars import in_home_currency, lookup
from ..operators.aggregates import ratio
from ..operators.dimensions import small_side
from ..operators.filters import fill_token, semi, with_reserves
from ..operators.ranking import first_per_key, with_percentile


def spending(transactions: DataFrame, codes: DataFrame, start: str, end: str, rate: float = 6.7) -> DataFrame:
    """Per customer amount in home currency and last day over the codes that count."""
    known = small_side(codes.select("code").distinct())
    counted = transactions.where(F.col("day").between(start, end)).join(known, "code", "left_semi")
    amount = in_home_currency(F.col("amount"), F.col("currency"), rate=rate)
    return counted.groupBy("user_id").agg(F.sum(amount).alias("year_amount"), F.max("day").alias("last_day"))


def retention_list(accounts: DataFrame, spent: DataFrame, retainable: DataFrame, instalments: DataFrame, half_year: str,
                   year: str, high_spend: int = 10_000) -> DataFrame:
    """Open accounts that can be kept online, with activity flags and a value score of 0 to 4:
    active in the half year, instalments, joined this year, high spending.

    accounts: user_id, user_type, joined. retainable: user_id, value_flag, other_flag.
    """
    flags = retainable.where((F.col("value_flag") == 1) | (F.col("other_flag") == 1)).groupBy("user_id").agg(
        F.max("value_flag").alias("value_flag"), F.max("other_flag").alias("other_flag")
    )
    own = accounts.groupBy("user_id", "user_type").agg(F.min("joined").alias("joined"))
    paid = instalments.select("user_id").distinct().withColumn("instalment", F.lit(1))
    rows = own.join(flags, "user_id").join(spent, "user_id", "left").join(paid, "user_id", "left")
    half = F.when(F.coalesce(F.col("last_day") >= half_year, F.lit(False)), 1).otherwise(0)
    any_year = F.when(F.col("last_day").isNull(), 0).otherwise(1)
    spend = F.coalesce("year_amount", F.lit(0))
    instalment = F.coalesce("instalment", F.lit(0))
    joined = F.when(F.substring("joined", 1, 4) == year, 1).otherwise(0)
    return rows.select(
        "user_id", "user_type", "joined", "value_flag", "other_flag", spend.alias("year_amount"), "last_day",
        half.alias("half_year_active"), any_year.alias("year_active"), instalment.alias("instalment"),
        (half + instalment + joined + F.when(spend > high_spend, 1).otherwise(0)).alias("value_score"),
    )


def one_row(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per key with the largest value of each column: attribute tables list a customer more than once."""
    return df.groupBy(F.col(key).alias("user_id")).agg(*[F.max(c).alias(c) for c in columns])


def retention_report(listed: DataFrame, scores: DataFrame, attributes: DataFrame, repayments: DataFrame, contacts: DataFrame, batch: str,
                     wallets: Sequence[str], key: str = "cust_id") -> DataFrame:
    """The retention list with the churn score, age, active card, first wallets, automatic repayment and phone.

    listed: see `retention_list`. scores: user_id, score (one per user). The other tables are reduced to a row per
    customer before they are joined, so the list keeps its rows; customers they do not know have nulls there."""
    sides = [
        scores.select("user_id", "score"), one_row(attributes, key, ["age", "activate_card_flag", *wallets]),
        one_row(repayments, key, ["auto_repay_cust_ind"]), one_row(contacts, key, ["mobile"]),
    ]
    for side in sides:
        listed = listed.join(side, "user_id", "left")
    return listed.withColumn("batch_id", F.lit(batch))


def pool_percentiles(pool: DataFrame) -> DataFrame:
    """Rank and percentile of every pool score, ties by user."""
    return with_percentile(pool, [F.col("score"), F.col("user_id")])


def prediction_extract(credit: DataFrame, debit: DataFrame, day: str) -> DataFrame:
    """Credit and debit percentiles side by side, one row per customer of either."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col("user_id").alias("cust_id"), F.lit(f"{name}_card").alias(f"_{name}"),
                         *[F.col(c).alias(f"{name}_{c}") for c in ("score", "rank", "percentile")],
                         F.lit(day).alias(f"{name}_date"))

    both = side(credit, "credit").join(side(debit, "debit"), "cust_id", "full")
    columns = [f"{n}_{c}" for n in ("debit", "credit") for c in ("score", "rank", "percentile", "date")]
    out = both.select("cust_id", F.coalesce("_credit", "_debit").alias("user_type"), *columns,
                      F.lit(day).alias("model_dt"), F.lit(day).alias("data_dt"))
    return with_reserves(fill_token(out, ["debit_date", "credit_date"]))


WAREHOUSE = ["cust_id", "user_type", "cust_name", "phone_number", "prod_type", "prod_id", "channel_id", "banner_id",
             "score", "rank", "scene_id", "pipeline_id", "version", "model_dt", "src_tbl"]


def to_warehouse(source: DataFrame, mapping: Mapping[str, Column | str | None], rank_as_text: bool = False) -> DataFrame:
    """A source in the warehouse columns, best row per customer, product and scene.

    `rank_as_text` compares ranks as text ('9' before '10'), as older extracts did.
    """

    def column(name: str) -> Column:
        value = mapping.get(name)
        value = F.lit(None) if value is None else F.col(value) if isinstance(value, str) else value
        return value.cast("string").alias(name)

    rows = source.select(*[column(c) for c in WAREHOUSE])
    order = F.desc("rank") if rank_as_text else F.desc(F.col("rank").try_cast("double"))
    rest = [F.desc(c) for c in WAREHOUSE if c not in ("cust_id", "prod_id", "scene_id", "rank")]
    return first_per_key(rows, ["cust_id", "prod_id", "scene_id"], [order, *rest])


def warehouse_extract(sources: DataFrame, day: str) -> DataFrame:
    """Nulls as tokens, data date and reserve columns."""
    tokens = fill_token(sources, [c for c in WAREHOUSE if c != "src_tbl"])
    return with_reserves(tokens.drop("src_tbl").withColumn("data_dt", F.lit(day)))


def touched_assets(feedback: DataFrame, balances: DataFrame, last_day: str, period_start: str, today: str,
                   no_push: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Last touch per user with balances before it and now.

    Pushed users count when a message reached them; groups without push count on the last
    day and are compared with the start of the period. The day before is worked out first,
    so both joins are equi joins on user and day.
    """
    pushed = F.col("dt").between(period_start, last_day) & (F.col("send") > 0) & ~F.col("user_type").isin(list(no_push))
    waiting = (F.col("dt") == last_day) & F.col("user_type").isin(list(no_push))
    touch = first_per_key(feedback.where(pushed | waiting), "user_id", [F.desc("dt"), F.col("item_id")])
    before = F.when(F.col("user_type").isin(list(no_push)), F.lit(period_start)).otherwise(shift_ymd(F.col("dt"), -1))
    touch = touch.select("user_id", "user_type", F.col("item_id").alias("prod_id"), before.alias("before_dt"))
    old = balances.select("user_id", F.col("dt").alias("before_dt"), *[F.col(m).alias(f"pre_{m}") for m in measures])
    new = balances.where(F.col("dt") == today).select("user_id", *measures)
    return touch.join(old, ["user_id", "before_dt"], "left").join(new, "user_id", "left")


def page_counters(pages: DataFrame, devices: DataFrame, users: DataFrame, customers: DataFrame, card: Column,
                  kinds: Sequence[str]) -> DataFrame:
    """Page events per customer and card: device -> user -> customer number -> customer.

    Events are counted per device and card before the chain of joins.
    """
    known = pages.where(F.col("device").isNotNull() & (F.col("device") != "") & F.col("kind").isin(list(kinds)))
    counts = known.groupBy("device", card.alias("card_type")).agg(
        *[F.count_if(F.col("kind") == k).alias(k) for k in kinds]
    )
    chain = counts.join(devices, "device").join(users, "user_seq").join(customers, "cif_seq")
    return chain.groupBy("user_id", "card_type").agg(*[F.sum(k).alias(k) for k in kinds])


def campaign_report(feedback: DataFrame, applications: DataFrame, group_sizes: Mapping[str, int], start: str, end: str,
                    applied_from: str, keys: Sequence[str] = ("user_type",)) -> DataFrame:
    """Sent, clicked and converted users per group over a period, next to the group's size."""
    touched = feedback.where(F.col("dt").between(start, end)).groupBy("user_id", "user_type").agg(
        F.max("send").alias("send"), F.max("click").alias("click")
    )
    applied = applications.where(F.col("apply_dt") >= applied_from).select("user_id").distinct().withColumn("_applied", F.lit(1))
    rows = touched.join(applied, "user_id", "left")
    sums = rows.groupBy(*keys).agg(
        F.sum("send").alias("send"), F.sum("click").alias("click"),
        F.sum(F.coalesce("_applied", F.lit(0))).alias("convert"),
    )
    return sums.withColumns({"operate": lookup(F.col("user_type"), group_sizes, 0), "during": F.lit(f"{start}-{end}")})


def message_report(feedback: DataFrame, push_days: DataFrame, applications: DataFrame, group_sizes: Mapping[str, int],
                   start: str, end: str, skipped: Sequence[str] = ("ctl1", "noop"), bounded: bool = True) -> DataFrame:
    """Per user: sent, clicked, converted since the first real push day of the period.

    push_days: dt, do_push. `bounded=False` also takes push days after the period.
    """
    real = push_days.where((F.col("do_push") == 1) & (F.col("dt") >= start) & (F.col("dt") <= end if bounded else F.lit(True)))
    first_day = real.agg(F.min("dt")).first()[0] or end
    per_user = semi(feedback, real, "dt").where(~F.col("user_type").isin(list(skipped))).groupBy("user_id", "user_type").agg(
        F.max("send").alias("send"), F.max("click").alias("click")
    )
    applied = applications.where(F.col("apply_dt") >= first_day).select("user_id").distinct().withColumn("_applied", F.lit(1))
    return per_user.join(applied, "user_id", "left").select(
        "user_id", "user_type", F.coalesce("send", F.lit(0)).alias("send"), F.coalesce("click", F.lit(0)).alias("click"),
        F.coalesce("_applied", F.lit(0)).alias("convert"), lookup(F.col("user_type"), group_sizes, 0).alias("operate"),
        F.lit(f"{start}-{end}").alias("during"),
    )


def synced_report(report: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with click and conversion rates per message sent."""
    rest = [c for c in report.columns if c not in keys]
    one = report.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_r")).select(*keys, "_r.*")
    filled = one.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("send", "click", "convert")})
    return filled.withColumns({
        "click_ratio": ratio(F.col("click"), F.col("send")), "convert_ratio": ratio(F.col("convert"), F.col("send")),
    })
