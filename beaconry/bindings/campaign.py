"""Pools, groups, push selection, packages, feedback, delivery and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.dates import on_days, ymd
from ..operators.dimensions import small_rows
from ..operators.filters import semi, union_all, union_present
from ..operators.ranking import first_per_key, top_k
from ..operators.rerank import ChannelItems, Item, rerank
from ..operators.sampling import random_split
from ..plans import calendar, cohort, delivery, evaluation, feedback, groups, package, push, reports
from .registry import Tables, decimals_as_doubles, registrar
from .relational import CENTS, _sql_funnel, sql_hash

QUERIES: dict = {}
ORACLES: dict = {}
query = registrar(QUERIES, ORACLES)

# --- stand-ins for the campaign tables ------------------------------------------------------
# Credit and debit cards are urgent and high orders that are closed; users of the app are the
# users of the event log; groups follow the market segment; scores the account balance.

GROUPS = {"BUILDING": "exp", "MACHINERY": "exp1", "AUTOMOBILE": "ctl1", "FURNITURE": "ctl", "HOUSEHOLD": "noop"}
CREDIT, DEBIT = "1-URGENT", "2-HIGH"


def holders(t: Tables, priority: str) -> DataFrame:
    kept = t.orders.where((F.col("o_orderpriority") == priority) & (F.col("o_orderstatus") == "F"))
    return kept.select(F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("prod_id"), ymd("o_orderdate").alias("apply_dt"))


def app_users(t: Tables) -> DataFrame:
    return t.events.select("user_id")


def group_of(segment):
    return S.lookup(segment, GROUPS)


def pool(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("user_id"), group_of(F.col("c_mktsegment")).alias("user_type"),
                             ((F.col("c_acctbal") + 1000) / 11000).alias("score"))


def event_item():
    return F.concat(F.lit("Brand#"), S.json_field(F.col("props"), "k"))


SQL_STANDINS = """
credit AS (SELECT o_custkey AS user_id, o_orderkey AS prod_id, strftime(o_orderdate, '%Y%m%d') AS apply_dt FROM orders
           WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'),
debit AS (SELECT o_custkey AS user_id, o_orderkey AS prod_id, strftime(o_orderdate, '%Y%m%d') AS apply_dt FROM orders
          WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'F'),
grp AS (SELECT * FROM (VALUES ('BUILDING', 'exp'), ('MACHINERY', 'exp1'), ('AUTOMOBILE', 'ctl1'), ('FURNITURE', 'ctl'), ('HOUSEHOLD', 'noop')) AS v(seg, user_type)),
pool AS (SELECT c_custkey AS user_id, user_type, (c_acctbal + 1000) / 11000 AS score FROM customer JOIN grp ON c_mktsegment = seg),
ev AS (SELECT *, strftime(ts, '%Y%m%d') AS dt, json_extract_string(props, '$.k') AS k, 'Brand#' || json_extract_string(props, '$.k') AS item FROM events)
"""

# --- cohorts ---------------------------------------------------------------------------------


@query(f"""
WITH {SQL_STANDINS}
SELECT user_id FROM (SELECT user_id FROM credit UNION ALL SELECT user_id FROM debit) WHERE user_id IN (SELECT user_id FROM events)
UNION SELECT o_custkey FROM orders WHERE o_orderstatus = 'O' AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 7000)
""")
def cohort_feature_population(t: Tables) -> DataFrame:
    open_orders = t.orders.where(F.col("o_orderstatus") == "O").select(F.col("o_custkey").alias("user_id"))
    retainable = t.customer.where(F.col("c_acctbal") > 7000).select(F.col("c_custkey").alias("user_id"))
    return cohort.feature_population(holders(t, CREDIT), holders(t, DEBIT), app_users(t), [open_orders], retainable)


_SQL_ONE_CARD = """
WITH {s} SELECT DISTINCT user_id FROM {a} WHERE user_id IN (SELECT user_id FROM events) AND user_id NOT IN (SELECT user_id FROM {b})
"""


@query(_SQL_ONE_CARD.format(s=SQL_STANDINS, a="credit", b="debit"))
def cohort_credit_only(t: Tables) -> DataFrame:
    return cohort.one_card_pool(holders(t, CREDIT), holders(t, DEBIT), app_users(t))


@query(_SQL_ONE_CARD.format(s=SQL_STANDINS, a="debit", b="credit"))
def cohort_debit_only(t: Tables) -> DataFrame:
    return cohort.one_card_pool(holders(t, DEBIT), holders(t, CREDIT), app_users(t))


@query(_SQL_ONE_CARD.format(s=SQL_STANDINS, a="credit", b="debit") + """
 AND user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'HOUSEHOLD') AND user_id IN (SELECT c_custkey FROM customer WHERE length(c_name) = 18)
""")
def cohort_campaign_credit_only(t: Tables) -> DataFrame:
    consents = t.customer.where(F.col("c_mktsegment") != "HOUSEHOLD").select(F.col("c_custkey").alias("user_id"))
    phones = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("phone_no"))
    return cohort.campaign_pool(holders(t, CREDIT), holders(t, DEBIT), app_users(t), consents, phones, digits=18)


@query("""
SELECT c_custkey AS user_id FROM customer WHERE c_acctbal > 1000 AND c_custkey IN (SELECT user_id FROM events WHERE strftime(ts, '%Y%m%d') >= '20240124')
  AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '3-MEDIUM')
""")
def cohort_eligible_customers(t: Tables) -> DataFrame:
    attributes = t.customer.select(F.col("c_custkey").alias("user_id"), "c_acctbal")
    logins = t.events.select("user_id", ymd("ts").alias("login_dt"))
    consents = t.orders.where(F.col("o_orderpriority") == "3-MEDIUM").select(F.col("o_custkey").alias("user_id"))
    return cohort.eligible_customers(attributes, F.col("c_acctbal") > 1000, logins, "login_dt", "20240124", consents)


@query("""
SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 50 AND user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'FURNITURE')
UNION SELECT c_custkey FROM customer WHERE c_nationkey = 3
""")
def cohort_redeeming_customers(t: Tables) -> DataFrame:
    sold = (F.col("event_type") == "purchase") & (F.col("value") > 50)
    holdings = t.events.select("user_id", F.when(sold, F.col("value")).otherwise(0.0).alias("redeemed"))
    consents = t.customer.where(F.col("c_mktsegment") != "FURNITURE").select(F.col("c_custkey").alias("user_id"))
    test_users = t.customer.where(F.col("c_nationkey") == 3).select(F.col("c_custkey").alias("user_id"))
    return cohort.redeeming_customers(holdings, "redeemed", consents, test_users)


# --- groups ----------------------------------------------------------------------------------

_SIZES = {"exp": groups.GroupSize(600), "exp1": groups.GroupSize(100), "ctl1": groups.GroupSize(100),
          "ctl": groups.GroupSize(60, True), "noop": groups.GroupSize(40, True)}
_SECOND = {"exp": groups.GroupSize(300), "ctl": groups.GroupSize(90, True)}
_SQL_WEIGHTS = """
n AS (SELECT COUNT(DISTINCT user_id) AS users FROM pool),
size AS (SELECT * FROM (VALUES (1, 'exp', 600, false), (2, 'exp1', 100, false), (3, 'ctl1', 100, false), (4, 'ctl', 90, true), (5, 'noop', 40, true)) AS v(pos, user_type, num, minimum)),
weight AS (SELECT pos, user_type, CASE WHEN minimum THEN 1.1::DOUBLE * num ELSE
   greatest(num::DOUBLE / 800 * (users - (1.1::DOUBLE * 90 + 1.1::DOUBLE * 40)), num::DOUBLE) END AS weight FROM size, n)
"""


@query(f"WITH {SQL_STANDINS}, {_SQL_WEIGHTS} SELECT user_type, weight FROM weight")
def group_weights(t: Tables) -> DataFrame:
    users = t.customer.select("c_custkey").distinct().count()
    weights = groups.group_weights([_SIZES, _SECOND], users)
    return t.spark.createDataFrame(weights, "user_type string, weight double")


def _yesterday(t: Tables) -> DataFrame:
    early = holders(t, CREDIT).where(F.col("apply_dt") < "20000101").select("user_id").distinct()
    return semi(pool(t), early, "user_id").withColumn("score", F.col("score") / 2)


@query(f"""
WITH {SQL_STANDINS}, {_SQL_WEIGHTS},
y AS (SELECT user_id, user_type, score / 2 AS score FROM pool WHERE user_id IN (SELECT user_id FROM credit WHERE apply_dt < '20000101')),
b AS (SELECT user_type, SUM(weight / (SELECT SUM(weight) FROM weight)) OVER (ORDER BY pos) AS bound, pos FROM weight),
d AS (SELECT p.user_id, p.score, {sql_hash('day', 'p.user_id')} AS u, {sql_hash('day|score', 'p.user_id')} AS r FROM pool p),
new AS (SELECT d.user_id, (SELECT user_type FROM b WHERE d.u < b.bound ORDER BY pos LIMIT 1) AS user_type FROM d)
SELECT d.user_id, COALESCE(y.user_type, new.user_type) AS user_type,
  CASE WHEN COALESCE(y.user_type, new.user_type) IN ('ctl', 'noop') THEN COALESCE(y.score, d.r) ELSE d.score END AS score
FROM d LEFT JOIN y ON d.user_id = y.user_id JOIN new ON d.user_id = new.user_id
""")
def group_sticky_assignment(t: Tables) -> DataFrame:
    today, yesterday = pool(t).select("user_id", "score"), _yesterday(t)
    refresh = groups.must_refresh(yesterday, len(_SIZES), 22, [1])
    weights = groups.group_weights([_SIZES, _SECOND], today.count())
    return groups.assign_groups(today, None if refresh else yesterday, weights, "day")


@query()
def group_random_assignment(t: Tables) -> DataFrame:
    weights = groups.group_weights([_SIZES, _SECOND], t.customer.count())
    return random_split(pool(t).select("user_id", "score"), weights, 5)


# --- calendar --------------------------------------------------------------------------------


@query("""
WITH b AS (SELECT DISTINCT CAST(ts AS DATE) AS batch FROM events), c AS (SELECT unnest([2, 4, 30]) AS max_push),
l AS (SELECT batch, max_push, CAST(date_trunc('month', batch + 2) AS DATE) - 2 AS s, last_day(batch + 2) - 2 AS e FROM b, c),
i AS (SELECT *, (e - s) // max_push AS len, least((batch - s) // greatest((e - s) // max_push, 1), max_push - 1) AS idx FROM l),
p AS (SELECT *, CASE WHEN max_push >= 30 THEN batch ELSE s + CAST(len * idx AS INTEGER) END AS f,
   CASE WHEN max_push >= 30 THEN batch WHEN idx = max_push - 1 THEN e ELSE s + CAST(len * (idx + 1) - 1 AS INTEGER) END AS u FROM i)
SELECT strftime(batch, '%Y%m%d') AS batch_id, max_push, CAST(CASE WHEN max_push >= 30 THEN batch - s + 1 ELSE idx + 1 END AS INTEGER) AS plan_push,
  CAST(CASE WHEN max_push >= 30 THEN e - s + 1 ELSE max_push END AS INTEGER) AS month_push, strftime(f, '%Y%m%d') AS start_dt, strftime(u, '%Y%m%d') AS end_dt,
  CAST(abs(batch - u) + 1 AS INTEGER) AS days_remain FROM p
""")
def calendar_push_plan(t: Tables) -> DataFrame:
    days = t.events.select(F.to_date("ts").alias("batch")).distinct()
    each = days.withColumn("max_push", F.explode(F.array(F.lit(2), F.lit(4), F.lit(30))))
    plan = calendar.push_plan(each, "batch", "max_push", 2)
    return plan.select(ymd("batch").alias("batch_id"), *[c for c in plan.columns if c != "batch"])


@query("""
WITH b AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)
SELECT strftime(d, '%Y%m%d') AS batch_id, strftime(d + 1 - (3 + 2 + 1), '%Y%m%d') AS package_dt, strftime(d + 1 - 3, '%Y%m%d') AS feedback_dt,
  strftime(greatest(CAST(date_trunc('month', d + 2) AS DATE) - 2, d - (3 + 1 + 1)), '%Y%m%d') AS blocked_from FROM b
""")
def calendar_feedback_days(t: Tables) -> DataFrame:
    d = F.col("d")
    return t.events.select(F.to_date("ts").alias("d")).distinct().select(
        ymd(d).alias("batch_id"), ymd(calendar.package_day(d, 3, 2, 1)).alias("package_dt"), ymd(calendar.feedback_day(d, 3)).alias("feedback_dt"),
        ymd(calendar.blocked_from(d, 2, 3, 1)).alias("blocked_from"))


@query("""
WITH b AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders), i AS (SELECT unnest(range(1, 8)) AS back)
SELECT strftime(m, '%Y%m%d') AS day, strftime(m - to_months(back::INTEGER), '%Y%m') AS month, CASE WHEN back <= 2 THEN 'eval' ELSE 'train' END AS role,
  strftime(m - to_months(back::INTEGER) - INTERVAL 1 DAY, '%Y%m%d') AS feature_dt, strftime(m - to_months(back::INTEGER + 1) - INTERVAL 1 DAY, '%Y%m%d') AS early_feature_dt
FROM b, i
""")
def calendar_sample_months(t: Tables) -> DataFrame:
    months = t.orders.select(F.trunc(F.to_date("o_orderdate"), "month").alias("d")).distinct()
    return calendar.sample_months(months, "d", 5, 2).withColumn("day", ymd("d")).drop("d")


# --- push selection ---------------------------------------------------------------------------

BATCH, LAST, START, REACT = "20240120", "20240119", "20231230", 2
LIMITS = {"exp": 120, "exp1": 40, "ctl": 100000}
CHANNELS = [
    {"channel_id": "APP", "banner_id": "popup", "max_push": 4, "feedback_delay": 2, "push_delay": 1, "limits": LIMITS},
    {"channel_id": "APP", "banner_id": "feed", "max_push": 30, "feedback_delay": 1, "push_delay": 0, "limits": LIMITS},
    {"channel_id": "SMS", "banner_id": "", "max_push": 2, "feedback_delay": 3, "push_delay": 0, "limits": LIMITS},
]


def pushes(t: Tables) -> DataFrame:
    slots = S.lookup(F.col("event_type"), {"view": "APP", "click": "APP", "signup": "SMS"})
    banner = S.lookup(F.col("event_type"), {"view": "popup", "click": "feed"})
    rows = t.events.where(F.col("event_type").isin("view", "click", "signup"))
    rows = rows.where(on_days("ts", START, LAST))
    return rows.select("user_id", slots.alias("channel_id"), banner.alias("banner_id"), event_item().alias("item_id"),
                       F.when(F.col("value") < 50, 0).otherwise(1).alias("rank"), ymd("ts").alias("dt"))


def sends(t: Tables) -> DataFrame:
    k = S.json_field(F.col("props"), "k").cast("int")
    rows = t.events.where(F.col("event_type").isin("purchase", "error") & on_days("ts", START, LAST))
    return rows.select("user_id", F.when(k < 67, "APP").otherwise("SMS").alias("channel_id"), F.when(k < 34, "popup").when(k < 67, "feed").alias("banner_id"),
                       (F.col("event_type") == "purchase").cast("int").alias("send"), ymd("ts").alias("dt"))


SQL_PUSH = f"""
{SQL_STANDINS},
ch AS (SELECT * FROM (VALUES ('APP', 'popup', 4, 4, 10, '20240116', false), ('APP', 'feed', 31, 22, 1, '20240118', true), ('SMS', '', 2, 2, 10, '20240116', false))
       AS v(channel_id, banner_id, max_push, plan_push, days_remain, blocked_from, daily)),
lim AS (SELECT * FROM (VALUES ('exp', 120), ('exp1', 40), ('ctl', 100000)) AS v(user_type, max_user)),
push AS (SELECT user_id, CASE WHEN event_type = 'signup' THEN 'SMS' ELSE 'APP' END AS channel_id,
   CASE event_type WHEN 'view' THEN 'popup' WHEN 'click' THEN 'feed' END AS banner_id, item AS item_id, CASE WHEN value < 50 THEN 0 ELSE 1 END AS rank, dt
   FROM ev WHERE event_type IN ('view', 'click', 'signup')),
sent AS (SELECT user_id, CASE WHEN k::INT < 67 THEN 'APP' ELSE 'SMS' END AS channel_id, CASE WHEN k::INT < 34 THEN 'popup' WHEN k::INT < 67 THEN 'feed' END AS banner_id,
   CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS send, dt FROM ev WHERE event_type IN ('purchase', 'error')),
r AS (SELECT p.*, ch.*, max_user, ROW_NUMBER() OVER (PARTITION BY channel_id, banner_id, p.user_type ORDER BY score DESC, user_id) AS rank
      FROM pool p CROSS JOIN ch JOIN lim ON p.user_type = lim.user_type),
tried AS (SELECT user_id, channel_id, COALESCE(banner_id, '') AS banner_id, COUNT(*) AS n FROM push WHERE rank = 0 AND dt BETWEEN '{START}' AND '{LAST}' GROUP BY 1, 2, 3),
days AS (SELECT user_id, channel_id, COALESCE(banner_id, '') AS banner_id, dt, CASE WHEN SUM(send) > 0 THEN 1 ELSE 0 END AS hit FROM sent
         WHERE dt BETWEEN '{START}' AND '{LAST}' GROUP BY 1, 2, 3, 4),
arrived AS (SELECT user_id, channel_id, banner_id, SUM(hit) AS n FROM days GROUP BY 1, 2, 3),
state AS (SELECT r.user_id, r.channel_id, r.banner_id, user_type, max_push, plan_push, days_remain, daily, blocked_from, score, rank,
   CAST(COALESCE(t.n, 0) AS INTEGER) AS try_push, CAST(COALESCE(a.n, 0) AS INTEGER) AS actual_push FROM r
   LEFT JOIN tried t ON r.user_id = t.user_id AND r.channel_id = t.channel_id AND r.banner_id = t.banner_id
   LEFT JOIN arrived a ON r.user_id = a.user_id AND r.channel_id = a.channel_id AND r.banner_id = a.banner_id WHERE rank <= max_user),
filtered AS (SELECT * FROM state s WHERE daily OR NOT EXISTS (SELECT 1 FROM push p WHERE p.user_id = s.user_id AND p.channel_id = s.channel_id
   AND COALESCE(p.banner_id, '') = s.banner_id AND p.rank = 0 AND p.dt BETWEEN s.blocked_from AND '{LAST}')),
turn AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY channel_id, banner_id, user_type ORDER BY try_push, score DESC, user_id) AS t,
   COUNT(*) OVER (PARTITION BY channel_id, banner_id, user_type) AS open FROM filtered WHERE plan_push > actual_push),
sel AS (SELECT *, 'all' AS tag FROM state UNION ALL SELECT *, 'filtered' FROM filtered UNION ALL SELECT *, 'done' FROM filtered WHERE plan_push <= actual_push
   UNION ALL SELECT * EXCLUDE (t, open), CASE WHEN t <= CAST(floor((1 / 0.9::DOUBLE) * open / days_remain) AS INTEGER) THEN 'ready' ELSE 'later' END FROM turn)
"""


def candidates(t: Tables) -> tuple[DataFrame, list]:
    channels = push.channel_states(t.spark, BATCH, REACT, CHANNELS)
    return push.candidate_state(pool(t), channels, pushes(t), sends(t), START, LAST), channels


@query(f"WITH {SQL_PUSH} SELECT user_id, channel_id, banner_id, user_type, max_push, plan_push, score, rank, try_push, actual_push FROM state")
def push_candidate_state(t: Tables) -> DataFrame:
    return candidates(t)[0]


@query(f"WITH {SQL_PUSH} SELECT user_id, channel_id, banner_id, user_type, max_push, plan_push, try_push, actual_push, tag FROM sel")
def push_daily_selection(t: Tables) -> DataFrame:
    state, channels = candidates(t)
    return push.daily_selection(state, channels, pushes(t), LAST, fail_rate=0.1)


@query(f"""
WITH {SQL_STANDINS}, one AS (SELECT DISTINCT user_id FROM credit WHERE user_id NOT IN (SELECT user_id FROM debit) AND user_id IN (SELECT user_id FROM events)),
tries AS (SELECT user_id, COUNT(*) AS n FROM ev WHERE event_type = 'view' GROUP BY 1),
r AS (SELECT p.user_id, user_type, score, ROW_NUMBER() OVER (PARTITION BY user_type ORDER BY score DESC, p.user_id) AS rank FROM pool p JOIN one ON p.user_id = one.user_id)
SELECT r.user_id, user_type, score, rank, COALESCE(n, 0) AS try_push FROM r LEFT JOIN tries ON r.user_id = tries.user_id WHERE rank <= 50
""")
def push_best_of_pool(t: Tables) -> DataFrame:
    """Flagship: one-card users of the app, the best 50 per group with their pushes so far."""
    one_card = cohort.one_card_pool(holders(t, CREDIT), holders(t, DEBIT), app_users(t))
    best = top_k(semi(pool(t), one_card, "user_id"), "user_type", [F.desc("score"), F.col("user_id")], 50)
    tries = t.events.where(F.col("event_type") == "view").groupBy("user_id").agg(F.count("*").alias("try_push"))
    rows = best.join(tries, "user_id", "left").fillna(0, subset=["try_push"])
    return rows.select("user_id", "user_type", "score", F.col("rank").cast("bigint").alias("rank"), "try_push")


# --- items ------------------------------------------------------------------------------------

BRANDS = 25
SLOT_ITEMS = [ChannelItems("APP", "popup", tuple(f"Brand#{i}" for i in (2, 3, 5, 7, 11))), ChannelItems("SMS", "", ("X1", "X2"))]


def brand_items(prop: float = 0.0) -> list[Item]:
    return [Item((f"Brand#{i}",), i - 1, prop if i == 7 else 0.0, enable=i != 3) for i in range(1, BRANDS + 1)]


def brand_scores(t: Tables) -> DataFrame:
    """Share of every brand in a customer's spending, as class probabilities."""
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"), S.money(F.col("l_extendedprice")).alias("amount"))
    spent = lines.join(t.orders.select("o_orderkey", F.col("o_custkey").alias("user_id")), "o_orderkey").join(t.part.select("p_partkey", "p_brand"), "p_partkey")
    brands = spent.groupBy("user_id", "p_brand").agg(F.sum("amount").alias("amount"))
    total = F.sum("amount").cast("double").alias("total")
    by_brand = F.map_from_entries(F.collect_list(F.struct("p_brand", F.col("amount").cast("double")))).alias("by_brand")
    users = brands.groupBy("user_id").agg(total, by_brand)  # one entry per class at most
    shares = [F.coalesce(F.try_element_at("by_brand", F.lit(f"Brand#{i}")), F.lit(0.0)) / F.col("total") for i in range(1, BRANDS + 1)]
    return users.select("user_id", F.array(*shares).alias("probability"))


def slot_users(t: Tables) -> DataFrame:
    slots = F.array(*[F.struct(F.lit(c).alias("channel_id"), F.lit(b).alias("banner_id")) for c, b in (("APP", "popup"), ("APP", "feed"), ("SMS", None))])
    users = pool(t).select("user_id", "user_type").join(brand_scores(t), "user_id")
    return users.withColumn("_slot", F.explode(slots)).select("user_id", "user_type", "probability", "_slot.*")


SQL_PROBABILITIES = f"""
brand AS (SELECT 'Brand#' || i AS item, i - 1 AS label, i <> 3 AS enabled FROM (SELECT unnest(range(1, 26)) AS i)),
line AS (SELECT o_custkey AS user_id, p_brand AS item, {CENTS.format('l_extendedprice')} AS amount FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
tot AS (SELECT user_id, CAST(SUM(amount) AS DOUBLE) AS total FROM line GROUP BY 1),
amt AS (SELECT user_id, item, CAST(SUM(amount) AS DOUBLE) AS amount FROM line GROUP BY 1, 2),
prob AS (SELECT tot.user_id, brand.item, label, COALESCE(amount, 0.0) / total AS p FROM tot CROSS JOIN brand LEFT JOIN amt ON amt.user_id = tot.user_id AND amt.item = brand.item)
"""

SQL_SCORES = f"""
{SQL_STANDINS},
{SQL_PROBABILITIES},
slot AS (SELECT * FROM (VALUES ('APP', 'popup'), ('APP', 'feed'), ('SMS', '')) AS v(channel_id, banner_id)),
usr AS (SELECT pool.user_id, user_type, channel_id, banner_id FROM pool JOIN tot ON pool.user_id = tot.user_id CROSS JOIN slot),
cand AS (SELECT usr.*, item, p, label FROM usr JOIN prob ON usr.user_id = prob.user_id
          WHERE (banner_id = 'popup' AND item IN ('Brand#2', 'Brand#3', 'Brand#5', 'Brand#7', 'Brand#11')) OR banner_id = 'feed'
         UNION ALL SELECT usr.*, x.item, 0.0, x.label FROM usr, (VALUES ('X1', 1), ('X2', 2)) AS x(item, label) WHERE channel_id = 'SMS'),
base AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, channel_id, banner_id ORDER BY CASE WHEN user_type = 'exp' THEN -p ELSE {sql_hash('rerank', 'user_id', 'channel_id', 'banner_id', 'item')} END, label) - 1 AS pos FROM cand)
"""


@query(f"WITH {SQL_SCORES} SELECT user_id, user_type, channel_id, banner_id, item AS item_id, p AS score, pos::INTEGER AS rank FROM base")
def rerank_items(t: Tables) -> DataFrame:
    return rerank(slot_users(t), brand_items(), SLOT_ITEMS)


@query(f"""
WITH {SQL_SCORES},
f AS (SELECT *, channel_id = 'APP' AND {sql_hash('rerank|first', 'user_id', 'channel_id', 'banner_id')} < 0.2 AS forced FROM base),
m AS (SELECT f.*, CASE WHEN forced AND item = 'Brand#7' THEN -1 ELSE pos END AS pos2 FROM f WHERE NOT (forced AND item = 'Brand#3'))
SELECT user_id, user_type, channel_id, banner_id, item AS item_id, p AS score,
  CAST(ROW_NUMBER() OVER (PARTITION BY user_id, channel_id, banner_id ORDER BY pos2) - 1 AS INTEGER) AS rank FROM m
""")
def rerank_forced_share(t: Tables) -> DataFrame:
    return rerank(slot_users(t), brand_items(0.2), SLOT_ITEMS)


_SLOTS = [package.Slot("APP", "popup", 2, False), package.Slot("APP", "feed", 3, True), package.Slot("SMS", "", 1, False)]


@query(f"""
WITH {SQL_SCORES},
old AS (SELECT DISTINCT user_id, item, CASE WHEN event_type = 'signup' THEN 'SMS' ELSE 'APP' END AS channel_id,
   CASE event_type WHEN 'view' THEN 'popup' WHEN 'click' THEN 'feed' ELSE '' END AS banner_id FROM ev
   WHERE event_type IN ('view', 'click', 'signup') AND dt BETWEEN '{START}' AND '{LAST}')
SELECT b.user_id, b.user_type, b.channel_id, b.banner_id, b.item AS item_id, p AS score, pos::INTEGER AS rank, 'scene1' AS scene_id, '{BATCH}' AS batch_id FROM base b
LEFT JOIN old ON b.user_id = old.user_id AND b.item = old.item AND b.channel_id = old.channel_id AND b.banner_id = old.banner_id
WHERE pos < CASE b.banner_id WHEN 'popup' THEN 2 WHEN 'feed' THEN 3 ELSE 1 END AND (b.banner_id = 'feed' OR old.item IS NULL)
""")
def crowd_package(t: Tables) -> DataFrame:
    items = rerank(slot_users(t), brand_items(), SLOT_ITEMS, most={(s.channel_id, s.banner_id): s.num_items for s in _SLOTS})
    return package.crowd_package(items, pushes(t), _SLOTS, START, LAST, {"scene_id": "scene1", "batch_id": BATCH})


@query(f"""
WITH {SQL_PUSH}, {SQL_PROBABILITIES},
rdy AS (SELECT CAST(user_id AS VARCHAR) AS user_id, user_type, channel_id, banner_id FROM sel WHERE tag = 'ready'
   UNION ALL SELECT u, 'exp', c, b FROM (VALUES ('T1'), ('7')) AS x(u), (VALUES ('APP', 'popup'), ('APP', 'feed'), ('SMS', '')) AS y(c, b)),
usr AS (SELECT user_id, channel_id, banner_id, CASE WHEN bool_or(user_type = 'exp') THEN 'exp' ELSE MIN(user_type) END AS user_type FROM rdy GROUP BY 1, 2, 3),
pr AS (SELECT CAST(user_id AS VARCHAR) AS user_id, item, p, label FROM prob),
allowed AS (SELECT 'Brand#' || i AS item, i - 1 AS label FROM (VALUES (2), (3), (5), (7), (11)) AS v(i)),
cand AS (SELECT usr.*, item, p, label FROM usr JOIN pr ON usr.user_id = pr.user_id WHERE (banner_id = 'popup' AND item IN (SELECT item FROM allowed)) OR banner_id = 'feed'
   UNION ALL SELECT usr.*, item, 0.0, label FROM usr, allowed WHERE banner_id = 'popup' AND user_id NOT IN (SELECT user_id FROM pr)
   UNION ALL SELECT usr.*, x.item, 0.0, x.label FROM usr, (VALUES ('X1', 1), ('X2', 2)) AS x(item, label) WHERE channel_id = 'SMS'),
base AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, channel_id, banner_id ORDER BY CASE WHEN user_type = 'exp' THEN -p ELSE {sql_hash('rerank', 'user_id', 'channel_id', 'banner_id', 'item')} END, label) - 1 AS pos FROM cand),
old AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id, item_id, channel_id, COALESCE(banner_id, '') AS banner_id FROM push WHERE dt BETWEEN '{START}' AND '{LAST}')
SELECT b.user_id, b.user_type, b.channel_id, b.banner_id, b.item AS item_id, p AS score, pos::INTEGER AS rank, '{BATCH}' AS batch_id FROM base b
LEFT JOIN old ON b.user_id = old.user_id AND b.item = old.item_id AND b.channel_id = old.channel_id AND b.banner_id = old.banner_id
WHERE pos < CASE b.banner_id WHEN 'popup' THEN 2 WHEN 'feed' THEN 3 ELSE 1 END AND (b.banner_id = 'feed' OR old.item_id IS NULL)
""")
def crowd_package_of_ready_users(t: Tables) -> DataFrame:
    """The day's ready users, a test user nobody knows and one that is a customer too."""
    state, channels = candidates(t)
    selection = push.daily_selection(state, channels, pushes(t), LAST, fail_rate=0.1)
    forced = package.forced_users(t.spark, ["T1", "7"], _SLOTS)
    return package.ready_package(selection, forced, brand_scores(t), brand_items(), SLOT_ITEMS, pushes(t), _SLOTS, START, LAST, {"batch_id": BATCH})


# --- feedback ---------------------------------------------------------------------------------


@query(f"""
WITH {SQL_STANDINS},
pack AS (SELECT DISTINCT ev.user_id, user_type, item FROM ev JOIN pool ON ev.user_id = pool.user_id WHERE event_type = 'signup' AND dt BETWEEN '20240105' AND '20240110'),
got AS (SELECT user_id, SUM(CASE WHEN value > 100 THEN 1 ELSE 0 END) AS n FROM ev WHERE event_type = 'purchase' AND dt = '20240113' GROUP BY 1),
lim AS (SELECT * FROM (VALUES ('ctl1', 30), ('noop', 100000)) AS v(user_type, max_user)),
np AS (SELECT user_id, pool.user_type, ROW_NUMBER() OVER (PARTITION BY pool.user_type ORDER BY score DESC, user_id) AS rank, max_user FROM pool JOIN lim ON pool.user_type = lim.user_type)
SELECT pack.user_id, user_type, item AS item_id, 'SMS' AS channel_id, '' AS banner_id, CASE WHEN n > 0 THEN 1 ELSE 0 END AS send
FROM pack LEFT JOIN got ON pack.user_id = got.user_id
UNION ALL SELECT user_id, user_type, 'CARD', 'SMS', '', 0 FROM np WHERE rank <= max_user
""")
def feedback_messages(t: Tables) -> DataFrame:
    events = t.events.withColumns({"dt": ymd("ts"), "item_id": event_item()})
    packed = events.where((F.col("event_type") == "signup") & on_days("ts", "20240105", "20240110")).select("user_id", "item_id").distinct()
    pack = packed.join(pool(t).select("user_id", "user_type"), "user_id").withColumns({"channel_id": F.lit("SMS"), "banner_id": F.lit(None).cast("string")})
    phones = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("tel_number"))
    log = events.where((F.col("event_type") == "purchase") & on_days("ts", "20240113", "20240113")).select(
        F.format_string("Customer#%09d", "user_id").alias("phone"), "value")
    sent = feedback.message_feedback(pack, phones, log, F.col("value") > 100)
    unpushed = feedback.unpushed_groups(pool(t), {"ctl1": 30, "noop": 100000}, "CARD", "SMS", "")
    return sent.unionByName(unpushed).drop("click")  # messages have no clicks


@query(f"""
WITH {SQL_STANDINS},
code AS (SELECT COALESCE(MAX(CAST(p_partkey AS VARCHAR)), 'NOPE') AS c FROM part WHERE p_name LIKE '%ring%' AND p_size <= 20),
shown AS (SELECT event_id, user_id, k FROM ev WHERE event_type = 'view' AND value < 200),
hit AS (SELECT DISTINCT event_id - 1 AS event_id FROM ev WHERE event_type = 'click'),
seen AS (SELECT user_id, p_brand AS item, MAX(CASE WHEN hit.event_id IS NULL THEN 0 ELSE 1 END) AS click FROM shown
  LEFT JOIN hit ON shown.event_id = hit.event_id LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = k GROUP BY 1, 2),
pack AS (SELECT DISTINCT ev.user_id, user_type, p_brand AS item FROM ev JOIN pool ON ev.user_id = pool.user_id JOIN part ON CAST(p_partkey AS VARCHAR) = k)
SELECT pack.user_id, user_type, pack.item AS item_id, 'APP' AS channel_id, '' AS banner_id, CASE WHEN seen.user_id IS NULL THEN 0 ELSE 1 END AS send,
  COALESCE(click, 0) AS click FROM pack LEFT JOIN seen ON pack.user_id = seen.user_id AND pack.item = seen.item
""")
def feedback_app(t: Tables) -> DataFrame:
    activities = t.part.select(F.col("p_partkey").cast("string").alias("activity_code"), F.col("p_name").alias("activity_name"),
                               ymd(F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size") - 20)).alias("start_dt"), F.lit("20240201").alias("end_dt"))
    code = feedback.activity_code(activities, "ring", F.lit("2024-01-01").cast("date")).first()["activity_code"]
    k = S.json_field(F.col("props"), "k")
    strategy = F.when(F.col("value") < 200, F.lit(f"s--{code}")).otherwise(F.lit("plain"))
    shown = t.events.where(F.col("event_type") == "view").select(F.col("event_id").alias("advice_id"), "user_id", k.alias("resource_id"),
                                                                strategy.alias("strategy_id"), F.lit("engine").alias("strategy_category"))
    clicks = t.events.where(F.col("event_type") == "click").select((F.col("event_id") - 1).alias("advice_id"))
    resources = t.part.select(F.col("p_partkey").cast("string").alias("resource_id"), F.col("p_brand").alias("item_id"))
    seen = feedback.exposures_and_clicks(shown, clicks, resources, F.lit(code))
    pairs = t.events.select("user_id", k.alias("resource_id")).distinct().join(resources, "resource_id").select("user_id", "item_id").distinct()
    pack = pairs.join(pool(t).select("user_id", "user_type"), "user_id").withColumns({"channel_id": F.lit("APP"), "banner_id": F.lit(None).cast("string")})
    return feedback.app_feedback(pack, seen)


@query("""
SELECT COALESCE(MAX(CAST(p_partkey AS VARCHAR)), 'NOPE') AS activity_code FROM part WHERE p_name LIKE '%bolt%' AND p_size <= 30
""")
def feedback_activity_code(t: Tables) -> DataFrame:
    activities = t.part.select(F.col("p_partkey").cast("string").alias("activity_code"), F.col("p_name").alias("activity_name"),
                               ymd(F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size"))).alias("start_dt"), F.lit("20250101").alias("end_dt"))
    return feedback.activity_code(activities, "bolt", F.lit("2024-01-31").cast("date"))


# --- delivery ---------------------------------------------------------------------------------


def delivered_package(t: Tables) -> DataFrame:
    """Brands per customer in order of spending, as a package of one slot."""
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"), S.money(F.col("l_extendedprice")).alias("amount"))
    spent = lines.join(t.orders.select("o_orderkey", F.col("o_custkey").alias("user_id")), "o_orderkey").join(t.part.select("p_partkey", "p_brand"), "p_partkey")
    brands = spent.groupBy("user_id", F.col("p_brand").alias("item_id")).agg(F.sum("amount").alias("amount"))
    best = top_k(brands, "user_id", [F.desc("amount"), F.col("item_id")], 3).withColumn("rank", F.col("rank") - 1)
    return best.withColumns({"channel_id": F.lit("SMS"), "banner_id": F.lit(None).cast("string"), "scene_id": F.lit("debit"), "model_version": F.lit("v1")})


SQL_PACKAGE = f"""
amt AS (SELECT o_custkey AS user_id, p_brand AS item_id, SUM({CENTS.format('l_extendedprice')}) AS amount
   FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
pk AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY amount DESC, item_id) - 1 AS rank FROM amt) WHERE rank < 3)
"""


@query(f"""
WITH {SQL_PACKAGE}
SELECT user_id, item_id, c_name AS tel_number, 'Try ' || item_id AS content, 'S1' AS actv_id, 1 AS do_push FROM pk JOIN customer ON user_id = c_custkey
WHERE rank = 0 AND c_mktsegment NOT IN ('FURNITURE', 'HOUSEHOLD') AND CAST(substr(item_id, 7) AS INTEGER) <= 20
""")
def delivery_messages(t: Tables) -> DataFrame:
    segment = F.col("c_mktsegment")
    phone = F.when(segment == "FURNITURE", F.lit(None)).when(segment == "HOUSEHOLD", F.lit("short")).otherwise(F.col("c_name"))
    phones = t.customer.select(F.col("c_custkey").alias("user_id"), phone.alias("tel_number"))
    contents = {f"Brand#{i}": f"Try Brand#{i}" if i <= 20 else "" for i in range(1, BRANDS + 1)}
    first = delivery.first_items(delivered_package(t), "SMS", "", "debit")
    return delivery.message_rows(first, phones, contents, delivery.is_push_day(22, [1, 22]), "S1", digits=18)


@query(f"WITH {SQL_PACKAGE} SELECT user_id, item_id, 'v1' AS model_version, 'debit' AS scene_id FROM pk WHERE rank = 0")
def delivery_whitelist(t: Tables) -> DataFrame:
    return delivery.whitelist_rows(delivery.first_items(delivered_package(t), "SMS", "", "debit"))


@query(f"""
WITH u AS (SELECT c_custkey AS user_id FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey IN (1, 2, 3)),
i AS (SELECT DISTINCT p_brand AS item_id, p_type AS type FROM part WHERE p_type = 'PROMO'),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY {sql_hash('test', 'user_id', 'item_id')}, item_id) AS rank FROM u, i)
SELECT user_id, item_id, type, rank::INTEGER AS rank FROM r WHERE rank <= 4
""")
def delivery_test_pairs(t: Tables) -> DataFrame:
    items = small_rows(t.part.select(F.col("p_brand").alias("item_id"), F.col("p_type").alias("type")).distinct())
    chosen = delivery.select_rows(items, {"type": "PROMO"})
    users = t.customer.select(F.col("c_custkey").alias("user_id"), "c_mktsegment", "c_nationkey")
    pairs = delivery.test_pairs(users, {"c_mktsegment": "BUILDING", "c_nationkey": [1, 2, 3]}, chosen)
    return delivery.random_test_items(pairs.select("user_id", "item_id", "type"), 4, "test")


@query(f"""
WITH {SQL_PACKAGE}
SELECT user_id, 'v1' AS model_version, '[{{"positionId":"B9","slots":[{{"index":"0","prdList":[' ||
  string_agg('{{"code":"' || item_id || '","type":"debitCard"}}', ',' ORDER BY rank) || ']}}]}}]' AS prod_info,
  'debit' AS scene_id, 'A1' AS actv_id, 'B9' AS banner_id FROM pk GROUP BY 1
""")
def delivery_app_slots(t: Tables) -> DataFrame:
    return delivery.app_rows(delivered_package(t).drop("scene_id", "banner_id"), "B9", "debitCard", "debit", "A1", 3)


# --- reports ----------------------------------------------------------------------------------


_SQL_RETENTION = f"""
acc AS (SELECT o_custkey AS user_id, 'hx' AS user_type, MIN(strftime(o_orderdate, '%Y%m%d')) AS joined FROM orders WHERE o_orderstatus = 'O' GROUP BY 1
   UNION ALL SELECT o_custkey, 'mt', MIN(strftime(o_orderdate, '%Y%m%d')) FROM orders WHERE o_orderstatus = 'P' GROUP BY 1),
tx AS (SELECT o_custkey AS user_id, strftime(l_shipdate, '%Y%m%d') AS day, {CENTS.format('l_extendedprice')} AS amount, l_returnflag AS cur, l_linestatus AS code
   FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
sp AS (SELECT user_id, SUM(CASE WHEN cur = 'N' THEN amount ELSE amount * 6.7 END) AS year_amount, MAX(day) AS last_day FROM tx
   WHERE day BETWEEN '20001104' AND '20011104' AND code = 'F' GROUP BY 1),
fl AS (SELECT c_custkey AS user_id, CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS value_flag, CASE WHEN c_nationkey < 10 THEN 1 ELSE 0 END AS other_flag FROM customer),
ins AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND value > 150),
lst AS (SELECT acc.user_id, user_type, joined, value_flag, other_flag, CAST(COALESCE(year_amount, 0) AS DOUBLE) AS year_amount, last_day,
  CASE WHEN last_day >= '20010505' THEN 1 ELSE 0 END AS half_year_active, CASE WHEN last_day IS NULL THEN 0 ELSE 1 END AS year_active,
  CASE WHEN ins.user_id IS NULL THEN 0 ELSE 1 END AS instalment,
  CASE WHEN last_day >= '20010505' THEN 1 ELSE 0 END + CASE WHEN ins.user_id IS NULL THEN 0 ELSE 1 END + CASE WHEN substr(joined, 1, 4) = '2001' THEN 1 ELSE 0 END
  + CASE WHEN COALESCE(year_amount, 0) > 10000 THEN 1 ELSE 0 END AS value_score
FROM acc JOIN fl ON acc.user_id = fl.user_id LEFT JOIN sp ON acc.user_id = sp.user_id LEFT JOIN ins ON acc.user_id = ins.user_id WHERE value_flag = 1 OR other_flag = 1)
"""


@query(f"WITH {_SQL_RETENTION} SELECT * FROM lst")
def report_retention_list(t: Tables) -> DataFrame:
    def accounts(status: str, kind: str) -> DataFrame:
        return t.orders.where(F.col("o_orderstatus") == status).select(
            F.col("o_custkey").alias("user_id"), F.lit(kind).alias("user_type"), ymd("o_orderdate").alias("joined"))

    shipped = t.lineitem.where(on_days("l_shipdate", "20001104", "20011104"))
    lines = shipped.select(F.col("l_orderkey").alias("o_orderkey"), ymd("l_shipdate").alias("day"), S.money(F.col("l_extendedprice")).alias("amount"),
                              F.col("l_returnflag").alias("currency"), F.col("l_linestatus").alias("code"))
    transactions = lines.join(t.orders.select("o_orderkey", F.col("o_custkey").alias("user_id")), "o_orderkey")
    codes = t.orders.where(F.col("o_orderstatus") == "F").select(F.col("o_orderstatus").alias("code"))
    spent = reports.spending(transactions.withColumn("currency", F.when(F.col("currency") == "N", "CNY").otherwise("USD")), codes, "20001104", "20011104")
    retainable = t.customer.select(F.col("c_custkey").alias("user_id"), (F.col("c_acctbal") > 5000).cast("int").alias("value_flag"),
                                   (F.col("c_nationkey") < 10).cast("int").alias("other_flag"))
    instalments = t.events.where((F.col("event_type") == "purchase") & (F.col("value") > 150)).select("user_id")
    rows = reports.retention_list(union_all([accounts("O", "hx"), accounts("P", "mt")]), spent, retainable, instalments, "20010505", "2001")
    return rows.withColumn("year_amount", F.col("year_amount").cast("double"))


@query(f"""
WITH {SQL_STANDINS}, {_SQL_RETENTION},
tops AS (SELECT user_id, MAX(value) AS top FROM events WHERE event_type = 'click' GROUP BY 1)
SELECT lst.*, pool.score, CASE WHEN c_nationkey <> 3 THEN c_nationkey * 3 + 20 END AS age, CASE WHEN c_nationkey <> 3 THEN CASE WHEN c_acctbal > 0 THEN 'Y' ELSE 'N' END END AS activate_card_flag,
  CASE WHEN c_nationkey <> 3 THEN (c_nationkey % 2)::INTEGER END AS first_bin_wx, CASE WHEN c_nationkey <> 3 THEN CASE WHEN c_nationkey % 5 = 0 THEN 1 END END AS first_bin_zfb,
  CASE WHEN top > 100 THEN '1' WHEN top IS NOT NULL THEN '0' END AS auto_repay_cust_ind, CASE WHEN c_nationkey < 12 THEN substr(c_name, 10) END AS mobile, '20011104' AS batch_id
FROM lst JOIN customer ON lst.user_id = c_custkey LEFT JOIN pool ON lst.user_id = pool.user_id LEFT JOIN tops ON lst.user_id = tops.user_id
""")
def report_retention_attributes(t: Tables) -> DataFrame:
    nation, wallets = F.col("c_nationkey"), ["first_bin_wx", "first_bin_zfb"]
    known = t.customer.where(nation != 3).select(
        F.col("c_custkey").alias("cust_id"), (nation * 3 + 20).alias("age"), F.when(F.col("c_acctbal") > 0, "Y").otherwise("N").alias("activate_card_flag"),
        (nation % 2).cast("int").alias("first_bin_wx"), F.when(nation % 5 == 0, 1).alias("first_bin_zfb"))
    older = known.select("cust_id", (F.col("age") - 1).alias("age"), F.lit("N").alias("activate_card_flag"), F.lit(0).alias("first_bin_wx"), F.lit(None).cast("int").alias("first_bin_zfb"))
    clicks = t.events.where(F.col("event_type") == "click").select(F.col("user_id").alias("cust_id"), F.when(F.col("value") > 100, "1").otherwise("0").alias("auto_repay_cust_ind"))
    contacts = t.customer.where(nation < 12).select(F.col("c_custkey").alias("cust_id"), F.substring("c_name", 10, 20).alias("mobile"))
    return reports.retention_report(report_retention_list(t), pool(t), known.unionByName(older), clicks, contacts, "20011104", wallets)


_SQL_PERCENTILE = """
pct AS (SELECT user_id, user_type, score, ROW_NUMBER() OVER (ORDER BY score, user_id) AS rank, COUNT(*) OVER () AS user_num FROM pool)
"""


@query(f"WITH {SQL_STANDINS}, {_SQL_PERCENTILE} SELECT *, rank::DOUBLE / user_num AS percentile FROM pct")
def report_pool_percentiles(t: Tables) -> DataFrame:
    return reports.pool_percentiles(pool(t))


def _sql_side(name: str) -> str:
    return f"""{name}_p AS (SELECT user_id, score, ROW_NUMBER() OVER (ORDER BY score, user_id) AS rank, COUNT(*) OVER () AS n FROM pool WHERE user_id IN (SELECT user_id FROM {name}))"""


@query(f"""
WITH {SQL_STANDINS}, {_sql_side('credit')}, {_sql_side('debit')}
SELECT COALESCE(c.user_id, d.user_id) AS cust_id, CASE WHEN c.user_id IS NULL THEN 'debit_card' ELSE 'credit_card' END AS user_type,
  d.score AS debit_score, d.rank::DOUBLE AS debit_rank, d.rank::DOUBLE / d.n AS debit_percentile, CASE WHEN d.user_id IS NULL THEN 'NULL_VALUE' ELSE '20240120' END AS debit_date,
  c.score AS credit_score, c.rank::DOUBLE AS credit_rank, c.rank::DOUBLE / c.n AS credit_percentile, CASE WHEN c.user_id IS NULL THEN 'NULL_VALUE' ELSE '20240120' END AS credit_date,
  '20240120' AS model_dt, '20240120' AS data_dt, {', '.join(f"'NULL_VALUE' AS rev{i}" for i in range(1, 11))}
FROM credit_p c FULL JOIN debit_p d ON c.user_id = d.user_id
""")
def report_prediction_extract(t: Tables) -> DataFrame:
    scored = pool(t)
    sides = [reports.pool_percentiles(semi(scored, holders(t, p), "user_id")) for p in (CREDIT, DEBIT)]
    extract = reports.prediction_extract(sides[0], sides[1], BATCH)
    return extract.withColumns({f"{side}_rank": F.col(f"{side}_rank").cast("double") for side in ("credit", "debit")})


_SQL_WAREHOUSE = """
src AS (
 SELECT CAST(o_custkey AS VARCHAR) AS cust_id, 'exp' AS user_type, NULL AS cust_name, NULL AS phone_number, CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'fund' WHEN '5-LOW' THEN 'finc' END AS prod_type,
   o_orderstatus AS prod_id, 'APP' AS channel_id, NULL AS banner_id, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS score, CAST(o_orderkey AS VARCHAR) AS rank, 'S1101' AS scene_id,
   'p1' AS pipeline_id, 'v1' AS version, '20240120' AS model_dt, 'orders' AS src_tbl FROM orders
 UNION ALL SELECT CAST(l_suppkey AS VARCHAR), CASE l_linestatus WHEN 'F' THEN 'ctl' WHEN 'O' THEN 'exp' END, NULL, NULL, 'finc', CAST(l_partkey AS VARCHAR), 'SMS', 'B1', NULL,
   CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), CASE l_returnflag WHEN 'A' THEN 'S1102' ELSE 'S1103' END, NULL, 'v2', '20240120', 'lineitem' FROM lineitem
 UNION ALL SELECT CAST(user_id AS VARCHAR), CASE WHEN value > 100 THEN 'exp' ELSE 'ctl' END, NULL, NULL, 'debitCard', json_extract_string(props, '$.k'), event_type, NULL, NULL, CAST(event_id AS VARCHAR),
   CASE event_type WHEN 'view' THEN 'S2011' WHEN 'click' THEN 'S2021' END, 'dag', 'v3', '20240119', 'events' FROM events
 UNION ALL SELECT CAST(o_custkey AS VARCHAR), 'exp', c_name, c_mktsegment, 'finc', CAST(part AS VARCHAR), 'SMS', NULL, NULL, CAST(rn AS VARCHAR), 'S1106', 'S1106', NULL, '20240119', 'lists'
   FROM (SELECT o_custkey, l_partkey AS part, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY l_partkey) AS rn FROM (SELECT DISTINCT o_custkey, l_partkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey))
   JOIN customer ON o_custkey = c_custkey),
best AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY src_tbl, cust_id, prod_id, scene_id ORDER BY TRY_CAST(rank AS DOUBLE) DESC, user_type DESC NULLS LAST, prod_type DESC NULLS LAST, score DESC NULLS LAST) AS rn FROM src) WHERE rn = 1)
"""


def _warehouse_sources(t: Tables) -> list[DataFrame]:
    order_type = S.lookup(F.col("o_orderpriority"), {"4-NOT SPECIFIED": "fund", "5-LOW": "finc"})
    first = reports.to_warehouse(t.orders, {
        "cust_id": "o_custkey", "user_type": F.lit("exp"), "prod_type": order_type, "prod_id": "o_orderstatus", "channel_id": F.lit("APP"),
        "score": S.money(F.col("o_totalprice")), "rank": "o_orderkey", "scene_id": F.lit("S1101"), "pipeline_id": F.lit("p1"), "version": F.lit("v1"),
        "model_dt": F.lit("20240120"), "src_tbl": F.lit("orders")})
    status = S.lookup(F.col("l_linestatus"), {"F": "ctl", "O": "exp"})
    second = reports.to_warehouse(t.lineitem, {
        "cust_id": "l_suppkey", "user_type": status, "prod_type": F.lit("finc"), "prod_id": "l_partkey", "channel_id": F.lit("SMS"), "banner_id": F.lit("B1"),
        "rank": F.col("l_quantity").cast("int"), "scene_id": F.when(F.col("l_returnflag") == "A", "S1102").otherwise("S1103"), "version": F.lit("v2"),
        "model_dt": F.lit("20240120"), "src_tbl": F.lit("lineitem")})
    third = reports.to_warehouse(t.events, {
        "cust_id": "user_id", "user_type": F.when(F.col("value") > 100, "exp").otherwise("ctl"), "prod_type": F.lit("debitCard"),
        "prod_id": S.json_field(F.col("props"), "k"), "channel_id": "event_type", "rank": "event_id",
        "scene_id": S.lookup(F.col("event_type"), {"view": "S2011", "click": "S2021"}), "pipeline_id": F.lit("dag"), "version": F.lit("v3"),
        "model_dt": F.lit("20240119"), "src_tbl": F.lit("events")})
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("part"))
    bought = lines.join(t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey")), "o_orderkey").select("c_custkey", "part").distinct()
    lists = bought.groupBy("c_custkey").agg(F.sort_array(F.collect_list("part")).alias("prods")).join(t.customer.select("c_custkey", "c_name", "c_mktsegment"), "c_custkey")
    exploded = lists.select("c_custkey", "c_name", "c_mktsegment", F.posexplode("prods").alias("pos", "part"))
    fourth = reports.to_warehouse(exploded, {
        "cust_id": "c_custkey", "user_type": F.lit("exp"), "cust_name": "c_name", "phone_number": "c_mktsegment", "prod_type": F.lit("finc"), "prod_id": "part",
        "channel_id": F.lit("SMS"), "rank": F.col("pos") + 1, "scene_id": F.lit("S1106"), "pipeline_id": F.lit("S1106"), "model_dt": F.lit("20240119"),
        "src_tbl": F.lit("lists")})
    return [first, second, third, fourth]


@query(f"""
WITH {_SQL_WAREHOUSE}
SELECT {', '.join(f"COALESCE({c}, 'NULL_VALUE') AS {c}" for c in reports.WAREHOUSE if c != 'src_tbl')}, '20240120' AS data_dt,
  {', '.join(f"'NULL_VALUE' AS rev{i}" for i in range(1, 11))} FROM best
""")
def report_warehouse_union(t: Tables) -> DataFrame:
    return reports.warehouse_extract(union_present([*_warehouse_sources(t), None]), BATCH)


def event_feedback(t: Tables, start: str = "20240105", end: str = "20240118") -> DataFrame:
    kind = F.col("event_type")
    seen = t.events.where(on_days("ts", start, end))
    rows = seen.select("user_id", event_item().alias("item_id"), ymd("ts").alias("dt"), kind.isin("view", "purchase").cast("int").alias("send"), (kind == "click").cast("int").alias("click"))
    return rows.join(pool(t).select("user_id", "user_type"), "user_id")


_SQL_FEEDBACK = """
fb AS (SELECT ev.user_id, item AS item_id, dt, CASE WHEN event_type IN ('view', 'purchase') THEN 1 ELSE 0 END AS send, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS click, user_type
       FROM ev JOIN pool ON ev.user_id = pool.user_id)
"""


@query(f"""
WITH {SQL_STANDINS}, {_SQL_FEEDBACK},
bal AS (SELECT user_id, dt, CAST(SUM({CENTS.format('value')}) AS DOUBLE) AS aum, COUNT(*)::DOUBLE AS moves FROM ev GROUP BY 1, 2),
touch AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY dt DESC, item_id) AS rn FROM fb
   WHERE (dt BETWEEN '20240105' AND '20240118' AND send > 0 AND user_type NOT IN ('ctl1', 'noop')) OR (dt = '20240118' AND user_type IN ('ctl1', 'noop'))) WHERE rn = 1),
b AS (SELECT user_id, user_type, item_id AS prod_id, CASE WHEN user_type IN ('ctl1', 'noop') THEN '20240105' ELSE strftime(strptime(dt, '%Y%m%d') - INTERVAL 1 DAY, '%Y%m%d') END AS before_dt FROM touch)
SELECT b.user_id, user_type, prod_id, before_dt, o.aum AS pre_aum, o.moves AS pre_moves, n.aum, n.moves FROM b
LEFT JOIN bal o ON b.user_id = o.user_id AND b.before_dt = o.dt LEFT JOIN bal n ON b.user_id = n.user_id AND n.dt = '20240125'
""")
def report_touched_assets(t: Tables) -> DataFrame:
    balances = t.events.groupBy("user_id", ymd("ts").alias("dt")).agg(F.sum(S.money(F.col("value"))).cast("double").alias("aum"), F.count("*").cast("double").alias("moves"))
    return reports.touched_assets(event_feedback(t), balances, "20240118", "20240105", "20240125", ["ctl1", "noop"], ["aum", "moves"])


@query(f"""
WITH {SQL_STANDINS}
SELECT n_name AS user_id, k AS card_type, SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END)::BIGINT AS view, SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END)::BIGINT AS click,
  SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END)::BIGINT AS purchase
FROM ev JOIN customer ON ev.user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE event_type IN ('view', 'click', 'purchase') GROUP BY 1, 2
""")
def report_page_counters(t: Tables) -> DataFrame:
    pages = t.events.select(F.format_string("Customer#%09d", "user_id").alias("device"), F.col("event_type").alias("kind"), "props")
    devices = t.customer.select(F.col("c_name").alias("device"), F.col("c_nationkey").alias("user_seq"))
    users = t.nation.select(F.col("n_nationkey").alias("user_seq"), F.col("n_nationkey").alias("cif_seq"))
    customers = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("cif_seq"), F.col("n_name").alias("user_id"))
    return reports.page_counters(pages, devices, users, customers, S.json_field(F.col("props"), "k"), ["view", "click", "purchase"])


_REPORT_SIZES = {"exp": 600, "ctl": 60, "noop": 40}
_SQL_REPORT = """
u AS (SELECT user_id, user_type, MAX(send) AS send, MAX(click) AS click FROM fb WHERE dt BETWEEN '20240105' AND '20240118' GROUP BY 1, 2),
app AS (SELECT DISTINCT user_id FROM credit WHERE apply_dt >= '20000101'),
rep AS (SELECT user_type, SUM(send)::BIGINT AS send, SUM(click)::BIGINT AS click, SUM(CASE WHEN app.user_id IS NULL THEN 0 ELSE 1 END)::BIGINT AS convert,
   CASE user_type WHEN 'exp' THEN 600 WHEN 'ctl' THEN 60 WHEN 'noop' THEN 40 ELSE 0 END AS operate, '20240105-20240118' AS during
   FROM u LEFT JOIN app ON u.user_id = app.user_id GROUP BY 1)
"""


@query(f"WITH {SQL_STANDINS}, {_SQL_FEEDBACK}, {_SQL_REPORT} SELECT * FROM rep")
def report_campaign(t: Tables) -> DataFrame:
    return reports.campaign_report(event_feedback(t), holders(t, CREDIT), _REPORT_SIZES, "20240105", "20240118", "20000101")


@query(f"""
WITH {SQL_STANDINS}, {_SQL_FEEDBACK},
pd AS (SELECT DISTINCT dt FROM ev WHERE event_type = 'signup' AND value > 250 AND dt BETWEEN '20240105' AND '20240118'),
f AS (SELECT COALESCE(MIN(dt), '20240118') AS d FROM pd),
u AS (SELECT user_id, user_type, MAX(send) AS send, MAX(click) AS click FROM fb WHERE dt IN (SELECT dt FROM pd) AND user_type NOT IN ('ctl1', 'noop') GROUP BY 1, 2),
app AS (SELECT DISTINCT user_id FROM debit WHERE apply_dt >= (SELECT replace(d, '2024', '1999') FROM f))
SELECT u.user_id, user_type, send, click, CASE WHEN app.user_id IS NULL THEN 0 ELSE 1 END AS convert,
  CASE user_type WHEN 'exp' THEN 600 WHEN 'ctl' THEN 60 WHEN 'noop' THEN 40 ELSE 0 END AS operate, '20240105-20240118' AS during
FROM u LEFT JOIN app ON u.user_id = app.user_id
""")
def report_messages(t: Tables) -> DataFrame:
    days = t.events.where(F.col("event_type") == "signup").select(ymd("ts").alias("dt"), (F.col("value") > 250).cast("int").alias("do_push"))
    applied = holders(t, DEBIT).withColumn("apply_dt", F.concat((F.substring("apply_dt", 1, 4).cast("int") + 25).cast("string"), F.substring("apply_dt", 5, 4)))
    return reports.message_report(event_feedback(t), days, applied, _REPORT_SIZES, "20240105", "20240118")


@query(f"""
WITH {SQL_STANDINS}, {_SQL_FEEDBACK}, {_SQL_REPORT}
SELECT *, click::DOUBLE / greatest(send, 1) AS click_ratio, convert::DOUBLE / greatest(send, 1) AS convert_ratio FROM rep
""")
def report_synced(t: Tables) -> DataFrame:
    report = reports.campaign_report(event_feedback(t), holders(t, CREDIT), _REPORT_SIZES, "20240105", "20240118", "20000101")
    return reports.synced_report(union_all([report, report]), ["user_type", "during"])


# --- evaluation -------------------------------------------------------------------------------

_SQL_COHORT = f"""
dl AS (SELECT DISTINCT user_id, user_type, item_id AS prod_id, dt FROM fb WHERE send > 0 AND user_type IN ('exp', 'ctl') AND dt BETWEEN '20240105' AND '20240106'),
never AS (SELECT DISTINCT user_id FROM credit WHERE user_id NOT IN (SELECT user_id FROM ev WHERE event_type = 'view' AND dt BETWEEN '20240101' AND '20240118')
   AND user_id NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey = 7)),
coh AS (SELECT * FROM dl UNION ALL SELECT user_id, '0', 'card9', '19000000' FROM (SELECT user_id FROM never ORDER BY {sql_hash('blank', 'user_id')}, user_id LIMIT 300))
"""


def _cohort(t: Tables) -> DataFrame:
    fb = event_feedback(t, "20240105", "20240106")
    kept = (F.col("send") > 0) & F.col("user_type").isin("exp", "ctl")
    delivered = fb.where(kept).select("user_id", "user_type", F.col("item_id").alias("prod_id"), "dt").distinct()
    seen = t.events.where((F.col("event_type") == "view") & on_days("ts", "20240101", "20240118")).select("user_id")
    patch = t.customer.where(F.col("c_nationkey") == 7).select(F.col("c_custkey").alias("user_id"))
    return evaluation.evaluation_cohort(delivered, holders(t, CREDIT), [seen, patch], 300, "card9", "19000000", "blank")


@query(f"WITH {SQL_STANDINS}, {_SQL_FEEDBACK}, {_SQL_COHORT} SELECT * FROM coh")
def evaluation_cohort(t: Tables) -> DataFrame:
    return _cohort(t)


_STEPS = ("view", "click", "buy")


def _sql_eval(level: str, group: str) -> str:
    keys = {"sum": "NULL::VARCHAR AS branch, user_type", "date": "branch, user_type", "all": "NULL AS branch, NULL AS user_type"}[level]
    return f"""SELECT '{level}' AS level, {keys}, {_sql_funnel(_STEPS)}, SUM(applied)::BIGINT AS applied,
      CAST(CAST(round(SUM(applied)::DECIMAL(28,10) / COUNT(*), 6) AS DECIMAL(38,6)) AS DOUBLE) AS applied_rate, CAST(SUM(balance) AS DOUBLE) AS balance FROM x {group}"""


@query(f"""
WITH {SQL_STANDINS}, {_SQL_FEEDBACK}, {_SQL_COHORT},
n AS (SELECT user_id, SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS view, SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS click,
   SUM(CASE WHEN event_type = 'purchase' AND value > 20 THEN 1 ELSE 0 END) AS buy FROM ev GROUP BY 1),
one AS (SELECT user_id, user_type FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY dt DESC, prod_id) AS rn FROM coh) WHERE rn = 1),
x AS (SELECT one.user_id, user_type, CAST(c_nationkey AS VARCHAR) AS branch, view, click, buy, CASE WHEN a.user_id IS NULL THEN 0 ELSE 1 END AS applied, CAST(c_acctbal AS DECIMAL(38,6)) AS balance
   FROM one JOIN customer ON one.user_id = c_custkey LEFT JOIN n ON one.user_id = n.user_id LEFT JOIN (SELECT DISTINCT user_id FROM debit WHERE apply_dt >= '20000101') a ON one.user_id = a.user_id)
{_sql_eval('sum', 'GROUP BY user_type')} UNION ALL {_sql_eval('date', 'GROUP BY branch, user_type')} UNION ALL {_sql_eval('all', '')}
""")
def evaluation_funnel(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    steps = {"view": kind == "view", "click": kind == "click", "buy": (kind == "purchase") & (F.col("value") > 20)}
    counts = evaluation.step_counts(t.events, steps)
    last = first_per_key(_cohort(t), "user_id", [F.desc("dt"), F.col("prod_id")]).select("user_id", "user_type")
    people = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").cast("string").alias("branch"), F.col("c_acctbal").cast("decimal(28,6)").alias("balance"))
    applied = holders(t, DEBIT).where(F.col("apply_dt") >= "20000101").select("user_id").distinct().withColumn("applied", F.lit(1))
    rows = last.join(people, "user_id").join(counts, "user_id", "left").join(applied, "user_id", "left")
    levels = {"sum": ["user_type"], "date": ["branch", "user_type"], "all": []}
    return decimals_as_doubles(evaluation.funnel(rows, list(steps), levels, ["balance"], "applied"))
