"""Scans, predicates, joins, aggregates, windows, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.dates import month_of, on_days, parse_ymd, reformat_date, shift_ymd, ymd
from ..functions.product_text import (
    benchmark_number,
    benchmark_text,
    date_text,
    fixed_text,
    invest_text,
    lock_text,
    percent_text,
    risk_text,
    template_id,
    term_text,
    yield_text,
)
from ..operators import aggregates as A
from ..operators import filters as P
from ..operators import levels as L
from ..operators import ranking as R
from ..operators import sampling
from ..operators.dimensions import small_rows, small_side, with_each
from ..session import scratch_path
from ..sources.partitions import scan_range, snapshot, snapshot_of_path, write_by_value, write_partition
from ..sources.tables import load_feature_snapshots, load_features
from .registry import Tables, decimals_as_doubles, registrar

QUERIES: dict = {}
ORACLES: dict = {}
query = registrar(QUERIES, ORACLES)

CENTS = "CAST({} AS DECIMAL(18,2))"


def sql_hash(salt: str, *columns: str) -> str:
    """The draw of `unit_hash` in SQL."""
    parts = ", ".join(f"CAST({c} AS VARCHAR)" for c in columns)
    return f"(CAST(('0x' || substr(md5(concat_ws('|', '{salt}', {parts})), 1, 12)) AS BIGINT) / 281474976710656.0)"


# --- scans -----------------------------------------------------------------------------


@query("""
WITH p AS (SELECT *, strftime(o_orderdate, '%Y%m') AS dt FROM orders),
     used AS (SELECT COALESCE(MAX(CASE WHEN dt = '203001' THEN dt END), MAX(dt)) AS dt FROM p)
SELECT o_orderkey, o_custkey, o_totalprice, p.dt FROM p JOIN used ON p.dt = used.dt
""")
def scan_snapshot_fallback(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "monthly")
    dated = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", month_of("o_orderdate").alias("dt"))
    write_by_value(dated.repartition("dt"), path, ["dt"])
    return snapshot_of_path(t.spark, path, "dt", "203001")[0]


@query("""
WITH p AS (SELECT *, strftime(o_orderdate, '%Y%m') AS dt FROM orders)
SELECT o_orderkey, o_custkey, o_totalprice, dt FROM p WHERE dt = '199706'
""")
def scan_snapshot_present(t: Tables) -> DataFrame:
    dated = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", month_of("o_orderdate").alias("dt"))
    return snapshot(dated, "dt", "199706", not_after=True)[0]


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, strftime(l_shipdate, '%Y%m%d') AS dt FROM lineitem
WHERE l_shipdate BETWEEN TIMESTAMP '1997-03-01' AND TIMESTAMP '1997-03-31'
""")
def scan_range_pushed(t: Tables) -> DataFrame:
    rows = t.lineitem.where(on_days("l_shipdate", "19970301", "19970331"))
    return rows.select("l_orderkey", "l_linenumber", "l_quantity", ymd("l_shipdate").alias("dt"))


@query("""
WITH p AS (SELECT l_orderkey, l_returnflag, strftime(l_shipdate, '%Y%m%d') AS dt FROM lineitem)
SELECT l_orderkey, l_returnflag, dt FROM p
WHERE (dt BETWEEN '19980101' AND '19981231') AND dt LIKE '199807%' AND l_returnflag IN ('A', 'R')
""")
def scan_range_text(t: Tables) -> DataFrame:
    dated = t.lineitem.select("l_orderkey", "l_returnflag", ymd("l_shipdate").alias("dt"))
    year = scan_range(dated, "dt", "19980101", "19981231", prefix="199807")
    return scan_range(year, "l_returnflag", values=["A", "R"])


@query(f"""
WITH o AS (SELECT o_custkey, COUNT(*) AS n_orders, MAX(strftime(o_orderdate, '%Y%m%d')) AS last_order,
                  CAST(SUM({CENTS.format('o_totalprice')}) AS DOUBLE) AS spent FROM orders GROUP BY 1),
     e AS (SELECT user_id, COUNT(*)::DOUBLE AS n_events FROM events GROUP BY 1)
SELECT c_custkey AS user_id, c_acctbal, c_mktsegment, n_orders, last_order, spent, n_events
FROM customer LEFT JOIN o ON c_custkey = o_custkey LEFT JOIN e ON c_custkey = user_id
""")
def scan_wide_features(t: Tables) -> DataFrame:
    profile = t.customer.select(F.col("c_custkey").alias("cust_id"), "c_acctbal", "c_mktsegment")
    orders = t.orders.groupBy(F.col("o_custkey").alias("cust_id")).agg(
        F.count("*").alias("n_orders"), F.max(ymd("o_orderdate")).alias("last_order"),
        F.sum(S.money(F.col("o_totalprice"))).cast("double").alias("spent"),
    )
    events = t.events.groupBy(F.col("user_id").alias("cust_id")).agg(F.count("*").cast("double").alias("n_events"), F.lit("x").alias("last_order"))
    users = t.customer.select(F.col("c_custkey").alias("user_id"))
    return load_features(users, [profile, orders, events],
                         ["c_acctbal", "n_orders", "c_mktsegment", "last_order", "spent", "n_events", "unknown"])


@query(f"""
WITH e AS (SELECT user_id, COUNT(*) AS n_events FROM events GROUP BY 1)
SELECT c_custkey AS user_id, c_acctbal * 2 AS balance, c_mktsegment AS segment, n_events FROM customer LEFT JOIN e ON c_custkey = user_id
""")
def scan_wide_snapshots(t: Tables) -> DataFrame:
    """Two stored feature tables that fall back to different days: one has the day asked for, the other only earlier ones."""
    profiles, activity = scratch_path(t.spark, "profiles"), scratch_path(t.spark, "activity")
    for day, factor in (("20240101", 1), ("20240103", 2)):
        rows = t.customer.select(F.col("c_custkey").alias("cust_id"), (F.col("c_acctbal") * factor).alias("balance"), F.col("c_mktsegment").alias("segment"))
        write_partition(rows, profiles, ["cust_id", "balance", "segment"], dt=day)
    for day, last in (("20240101", 0), ("20240102", 1)):
        rows = t.events.groupBy(F.col("user_id").alias("cust_id")).agg((F.count("*") * last).alias("n_events"), F.lit("x").alias("segment"))
        write_partition(rows, activity, ["cust_id", "n_events", "segment"], dt=day)
    users = t.customer.select(F.col("c_custkey").alias("user_id"))
    return load_feature_snapshots(users, [profiles, activity], ["balance", "segment", "n_events"], "20240103")[0]


# --- projections, filters, predicates -----------------------------------------------------


@query("""
SELECT DISTINCT o_custkey AS user_id FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000 AND c_mktsegment IN ('BUILDING', 'MACHINERY'))
""")
def filter_configured(t: Tables) -> DataFrame:
    users = t.orders.select(F.col("o_custkey").alias("user_id")).distinct()
    rules = {"balance": "c_acctbal > 5000", "segment": "c_mktsegment IN ('BUILDING', 'MACHINERY')"}
    return P.keep_matching(users, t.customer, rules, "user_id", "c_custkey")


@query("SELECT p_partkey, p_brand, p_size FROM part WHERE p_brand = 'Brand#3' AND p_size IN (1, 5, 10, 20, 40)")
def filter_by_tags(t: Tables) -> DataFrame:
    return P.select_by_tags(t.part, {"p_brand": "Brand#3", "p_size": [1, 5, 10, 20, 40]}).select("p_partkey", "p_brand", "p_size")


@query("""
SELECT p_partkey, p_name, p_type FROM part
WHERE p_name LIKE '%ring%' AND p_name NOT LIKE 'small%' AND regexp_matches(p_brand, 'Brand#1[0-9]$')
  AND p_type NOT IN ('PROMO') AND p_size BETWEEN 5 AND 45 AND p_size <> 20 AND p_retailprice IS NOT NULL
  AND length(p_brand) = 8
""")
def filter_predicates(t: Tables) -> DataFrame:
    name, size = F.col("p_name"), F.col("p_size")
    return t.part.where(
        name.like("%ring%") & ~name.like("small%") & F.col("p_brand").rlike("Brand#1[0-9]$")
        & ~F.col("p_type").isin("PROMO") & size.between(5, 45) & (size != 20) & F.col("p_retailprice").isNotNull()
        & (F.length("p_brand") == 8)
    ).select("p_partkey", "p_name", "p_type")


@query("""
SELECT o_orderkey,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high' ELSE 'other' END AS priority,
       CASE WHEN o_orderstatus = 'F' AND o_totalprice > 200000 THEN 'S1' WHEN o_orderstatus = 'O' THEN 'S2' END AS scene
FROM orders
""")
def project_case(t: Tables) -> DataFrame:
    names = S.lookup(F.col("o_orderpriority"), {"1-URGENT": "urgent", "2-HIGH": "high"}, "other")
    closed = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 200000)
    scene = S.case_of([(closed, "S1"), (F.col("o_orderstatus") == "O", "S2")])
    return t.orders.select("o_orderkey", names.alias("priority"), scene.alias("scene"))


@query("""
SELECT c_custkey, CASE WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN c_acctbal ELSE c_acctbal / 100 END AS score
FROM customer
""")
def project_override(t: Tables) -> DataFrame:
    kept = F.col("c_mktsegment").isin("FURNITURE", "HOUSEHOLD")
    return t.customer.select("c_custkey", F.when(kept, F.col("c_acctbal")).otherwise(F.col("c_acctbal") / 100).alias("score"))


@query("""
SELECT n_nationkey, n_name, '20240131' AS batch_id, 1 AS do_push, 'NULL_VALUE' AS rev1, 'NULL_VALUE' AS rev2,
       'NULL_VALUE' AS rev3, 'NULL_VALUE' AS rev4, 'NULL_VALUE' AS rev5, 'NULL_VALUE' AS rev6, 'NULL_VALUE' AS rev7,
       'NULL_VALUE' AS rev8, 'NULL_VALUE' AS rev9, 'NULL_VALUE' AS rev10
FROM nation
""")
def project_constants(t: Tables) -> DataFrame:
    rows = t.nation.select("n_nationkey", "n_name")
    return P.with_reserves(P.with_constants(rows, batch_id="20240131", do_push=1))


@query("""
WITH e AS (SELECT user_id, COUNT(*) AS n, MAX(CASE WHEN event_type = 'view' THEN '' ELSE event_type END) AS kind
           FROM events WHERE value > 100 GROUP BY 1)
SELECT c_custkey, CAST(COALESCE(n, 0) AS DOUBLE) AS n, COALESCE(NULLIF(kind, ''), 'NA') AS kind,
       COALESCE(kind, 'NULL_VALUE') AS export_kind
FROM customer LEFT JOIN e ON c_custkey = user_id
""")
def project_fill_nulls(t: Tables) -> DataFrame:
    kind = F.when(F.col("event_type") == "view", "").otherwise(F.col("event_type"))
    seen = t.events.where(F.col("value") > 100).groupBy(F.col("user_id").alias("c_custkey")).agg(
        F.count("*").alias("n"), F.max(kind).alias("kind")
    )
    rows = t.customer.select("c_custkey").join(seen, "c_custkey", "left").withColumn("export_kind", F.col("kind"))
    return P.fill_features(P.fill_token(rows, ["export_kind"]), ["n"], ["kind"])


@query("""
WITH u AS (SELECT o_custkey, MAX(o_totalprice) AS top FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
SELECT c_custkey, COALESCE(top, c_acctbal, 0.0) AS amount, CASE WHEN top IS NULL THEN 0 ELSE 1 END AS urgent,
       COALESCE(CASE WHEN top > 300000 THEN 'big' END, '') AS size
FROM customer LEFT JOIN u ON c_custkey = o_custkey
""")
def project_null_handling(t: Tables) -> DataFrame:
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_totalprice").alias("top"))
    top = F.col("top")
    return t.customer.join(urgent, "c_custkey", "left").select(
        "c_custkey", F.coalesce(top, F.col("c_acctbal"), F.lit(0.0)).alias("amount"),
        F.when(top.isNull(), 0).otherwise(1).alias("urgent"), F.ifnull(F.when(top > 300000, F.lit("big")), F.lit("")).alias("size"),
    )


@query("""
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1
""")
def project_dedupe(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return R.first_per_key(rows, "o_custkey", [F.desc("o_totalprice"), F.col("o_orderkey")])


@query("""
SELECT CAST(s_suppkey AS VARCHAR) AS item_id, CAST(trunc(s_acctbal) AS INTEGER) AS whole, s_name AS name,
       CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS balance FROM supplier
""")
def project_cast_rename(t: Tables) -> DataFrame:
    renamed = t.supplier.withColumnRenamed("s_name", "name")
    return decimals_as_doubles(renamed.select(F.col("s_suppkey").cast("string").alias("item_id"), F.col("s_acctbal").cast("int").alias("whole"),
                          "name", S.money(F.col("s_acctbal")).alias("balance")))


@query(f"SELECT o_orderkey, o_custkey FROM orders WHERE {sql_hash('neg', 'o_orderkey')} < 0.035")
def sample_by_hash(t: Tables) -> DataFrame:
    return sampling.sample_rows(t.orders.select("o_orderkey", "o_custkey"), 0.035, "neg", "o_orderkey")


_SPLIT = [("exp", 90.0), ("ctl", 5.0), ("noop", 5.0)]


@query(f"""
WITH d AS (SELECT c_custkey AS user_id, {sql_hash('split', 'c_custkey')} AS u FROM customer)
SELECT user_id, CASE WHEN u < 90.0/100 THEN 'exp' WHEN u < 90.0/100 + 5.0/100 THEN 'ctl' ELSE 'noop' END AS user_type FROM d
""")
def sample_weighted_split(t: Tables) -> DataFrame:
    return sampling.weighted_split(t.customer.select(F.col("c_custkey").alias("user_id")), _SPLIT, "split", "user_id")


@query()
def sample_random_split(t: Tables) -> DataFrame:
    return sampling.random_split(t.customer.select(F.col("c_custkey").alias("user_id")), _SPLIT, 11)


@query(f"SELECT c_custkey, c_name FROM customer ORDER BY {sql_hash('pick', 'c_custkey')}, c_custkey LIMIT 100")
def sample_pick_rows(t: Tables) -> DataFrame:
    return sampling.pick_rows(t.customer.select("c_custkey", "c_name"), 100, "pick", "c_custkey")


# --- joins ---------------------------------------------------------------------------------


@query("""
SELECT c_custkey, c_name, CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_totalprice FROM customer
LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT') ON c_custkey = o_custkey
""")
def join_left(t: Tables) -> DataFrame:
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_totalprice")
    return t.customer.select("c_custkey", "c_name").join(urgent, "c_custkey", "left")


@query("""
SELECT o_orderkey, o_custkey, l_linenumber, l_partkey, l_extendedprice FROM orders
JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F'
""")
def join_inner(t: Tables) -> DataFrame:
    orders = t.orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey")
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_extendedprice")
    return orders.join(lines, "o_orderkey")


@query("""
SELECT a.o_orderkey, a.o_custkey, n FROM orders a
JOIN (SELECT l_orderkey, MIN(l_shipdate) AS d, COUNT(*) AS n FROM lineitem GROUP BY 1) b
  ON a.o_orderkey = b.l_orderkey AND strftime(a.o_orderdate, '%Y%m') = strftime(b.d, '%Y%m')
""")
def join_inner_key_date(t: Tables) -> DataFrame:
    first = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        month_of(F.min("l_shipdate")).alias("month"), F.count("*").alias("n"))
    orders = t.orders.select("o_orderkey", "o_custkey", month_of("o_orderdate").alias("month"))
    return orders.join(first, ["o_orderkey", "month"]).drop("month")


@query("""
SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS
 (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')
""")
def join_anti(t: Tables) -> DataFrame:
    urgent = t.orders.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"))
    return P.anti(t.customer.select("c_custkey", "c_name"), urgent.select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("""
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 200)
""")
def join_semi(t: Tables) -> DataFrame:
    buyers = t.events.where((F.col("event_type") == "purchase") & (F.col("value") > 200))
    return P.semi(t.customer.select("c_custkey", "c_name"), buyers.select(F.col("user_id").alias("c_custkey")), "c_custkey")


@query("""
SELECT c_custkey FROM customer c ANTI JOIN (
  SELECT o_custkey AS k FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'
  UNION ALL SELECT user_id FROM events WHERE event_type = 'signup') d ON c.c_custkey = d.k
""")
def join_anti_union(t: Tables) -> DataFrame:
    late = t.orders.where(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")).select(F.col("o_custkey").alias("c_custkey"))
    joined = t.events.where(F.col("event_type") == "signup").select(F.col("user_id").alias("c_custkey"))
    return P.anti(t.customer.select("c_custkey"), P.union_all([late, joined]), "c_custkey")


@query("SELECT c_custkey, r_regionkey, r_name FROM customer CROSS JOIN region")
def join_each_channel(t: Tables) -> DataFrame:
    return with_each(t.customer.select("c_custkey"), small_rows(t.region.select("r_regionkey", "r_name")))


@query("""
WITH a AS (SELECT user_id, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS banner, COUNT(*) AS n
           FROM events WHERE value < 50 GROUP BY 1, 2),
     b AS (SELECT user_id, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS banner, COUNT(*) AS m
           FROM events WHERE value >= 50 GROUP BY 1, 2)
SELECT a.user_id, COALESCE(a.banner, '') AS banner, n, m FROM a
JOIN b ON a.user_id = b.user_id AND COALESCE(a.banner, '') = COALESCE(b.banner, '')
""")
def join_multi_key_null_safe(t: Tables) -> DataFrame:
    banner = F.when(F.col("event_type") != "error", F.col("event_type")).alias("banner")
    low = t.events.where(F.col("value") < 50).groupBy("user_id", banner).agg(F.count("*").alias("n"))
    high = t.events.where(F.col("value") >= 50).groupBy("user_id", banner).agg(F.count("*").alias("m"))
    return P.blank_keys(low, "banner").join(P.blank_keys(high, "banner"), ["user_id", "banner"])


@query("""
WITH a AS (SELECT o_custkey, MAX(o_totalprice) AS urgent FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' GROUP BY 1),
     b AS (SELECT o_custkey, MAX(o_totalprice) AS high FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'F' GROUP BY 1)
SELECT COALESCE(a.o_custkey, b.o_custkey) AS cust_id, urgent, high FROM a FULL JOIN b ON a.o_custkey = b.o_custkey
""")
def join_full_outer(t: Tables) -> DataFrame:
    def side(priority: str, name: str) -> DataFrame:
        kept = t.orders.where((F.col("o_orderpriority") == priority) & (F.col("o_orderstatus") == "F"))
        return kept.groupBy(F.col("o_custkey").alias("cust_id")).agg(F.max("o_totalprice").alias(name))

    return side("1-URGENT", "urgent").join(side("2-HIGH", "high"), "cust_id", "full")


@query("""
WITH v AS (SELECT user_id, COUNT(*) AS n FROM events WHERE event_type = 'view' GROUP BY 1),
     c AS (SELECT user_id, COUNT(*) AS n FROM events WHERE event_type = 'click' GROUP BY 1),
     p AS (SELECT user_id, COUNT(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY 1),
     o AS (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1)
SELECT c_custkey, COALESCE(v.n, 0) AS views, COALESCE(c.n, 0) AS clicks, COALESCE(p.n, 0) AS purchases, COALESCE(o.n, 0) AS orders
FROM customer LEFT JOIN v ON c_custkey = v.user_id LEFT JOIN c ON c_custkey = c.user_id
LEFT JOIN p ON c_custkey = p.user_id LEFT JOIN o ON c_custkey = o_custkey
""")
def join_star_facts(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    events = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(
        F.count_if(kind == "view").alias("views"), F.count_if(kind == "click").alias("clicks"),
        F.count_if(kind == "purchase").alias("purchases"))
    orders = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders"))
    rows = t.customer.select("c_custkey").join(events, "c_custkey", "left").join(orders, "c_custkey", "left")
    return rows.fillna(0, subset=["views", "clicks", "purchases", "orders"])


@query(f"""
WITH b AS (SELECT o_custkey, strftime(o_orderdate, '%Y%m%d') AS dt, CAST(SUM({CENTS.format('o_totalprice')}) AS DOUBLE) AS total
           FROM orders GROUP BY 1, 2)
SELECT now.o_custkey, now.dt, now.total AS now_total, prev.total AS before_total
FROM b now LEFT JOIN b prev ON now.o_custkey = prev.o_custkey
 AND prev.dt = strftime(strptime(now.dt, '%Y%m%d') - INTERVAL 1 DAY, '%Y%m%d')
""")
def join_point_in_time(t: Tables) -> DataFrame:
    balance = t.orders.groupBy("o_custkey", ymd("o_orderdate").alias("dt")).agg(
        F.sum(S.money(F.col("o_totalprice"))).cast("double").alias("total"))
    now = balance.select("o_custkey", "dt", F.col("total").alias("now_total"), shift_ymd(F.col("dt"), -1).alias("before_dt"))
    before = balance.select("o_custkey", F.col("dt").alias("before_dt"), F.col("total").alias("before_total"))
    return now.join(before, ["o_custkey", "before_dt"], "left").drop("before_dt")


@query("""
SELECT c_custkey, COUNT(p_partkey) AS affordable, MAX(p_retailprice) AS best_price FROM customer
LEFT JOIN part ON p_retailprice * 10 <= c_acctbal GROUP BY 1
""")
def join_theta_levels(t: Tables) -> DataFrame:
    parts = t.part.select((F.col("p_retailprice") * 10).alias("need"), "p_retailprice")
    customers = t.customer.select("c_custkey", F.col("c_acctbal").cast("double").alias("need"))
    counts = L.sum_upto(parts, customers, "need", F.lit(1), "affordable")
    numbers = L.level_numbers(parts, customers, ["need"])
    numbered = L.with_numbers(customers.select("need", F.col("need").alias("value")).distinct(), numbers, ["need"])
    best = L.best_upto(L.with_numbers(parts, numbers, ["need"]), numbered, L.level_bits(numbers, ["need"]), [F.desc("p_retailprice")], 1)
    reached = counts.join(numbered, "value").join(best.select("need", F.col("p_retailprice").alias("best_price")), "need", "left").drop("need")
    rows = customers.join(reached, customers["need"] == reached["value"], "left")
    return rows.select("c_custkey", F.coalesce("affordable", F.lit(0)).alias("affordable"), "best_price")


@query("""
SELECT n_name, COUNT(*) AS lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE l_returnflag <> '' AND o_orderstatus = 'F' GROUP BY 1
""")
def join_identity_chain(t: Tables) -> DataFrame:
    lines = t.lineitem.where(F.col("l_returnflag") != "").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("_n"))
    orders = t.orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    customers = t.customer.select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    chain = lines.join(orders, "o_orderkey").join(customers, "c_custkey").join(t.nation.select("n_nationkey", "n_name"), "n_nationkey")
    return chain.groupBy("n_name").agg(F.sum("_n").alias("lines"))


@query("""
WITH x AS (SELECT user_id, json_extract_string(props, '$.k') AS item, event_type FROM events),
     v AS (SELECT DISTINCT user_id, item FROM x WHERE event_type = 'view'),
     c AS (SELECT DISTINCT user_id, item FROM x WHERE event_type = 'click')
SELECT v.user_id, v.item, 1 AS expose, MAX(CASE WHEN c.item IS NULL THEN 0 ELSE 1 END) AS click
FROM v LEFT JOIN c ON v.user_id = c.user_id AND v.item = c.item GROUP BY 1, 2
""")
def join_exposure_click(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    per_pair = t.events.where(kind.isin("view", "click")).groupBy("user_id", S.json_field(F.col("props"), "k").alias("item")).agg(
        F.max((kind == "view").cast("int")).alias("expose"), F.max((kind == "click").cast("int")).alias("click"))
    return per_pair.where(F.col("expose") == 1)


@query("""
WITH s AS (SELECT user_id, SUM(CASE WHEN event_type = 'purchase' AND value > 10 THEN 1 ELSE 0 END) AS sent FROM events GROUP BY 1)
SELECT o_orderkey, o_custkey, CASE WHEN s.sent > 20 THEN 1 ELSE 0 END AS send FROM orders
LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN s ON s.user_id = c_custkey
""")
def join_send_log(t: Tables) -> DataFrame:
    sent = (F.col("event_type") == "purchase") & (F.col("value") > 10)
    log = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(F.count_if(sent).alias("sent"))
    keyed = t.customer.select("c_custkey").join(log, "c_custkey").select(F.col("c_custkey").alias("o_custkey"), "sent")
    return t.orders.select("o_orderkey", "o_custkey").join(keyed, "o_custkey", "left").select(
        "o_orderkey", "o_custkey", F.when(F.col("sent") > 20, 1).otherwise(0).alias("send"))


@query("""
WITH today AS (SELECT DISTINCT user_id, json_extract_string(props, '$.k') AS item, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-25'),
     past AS (SELECT DISTINCT user_id, json_extract_string(props, '$.k') AS item, event_type FROM events
              WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25')
SELECT today.* FROM today ANTI JOIN past ON today.user_id = past.user_id AND today.item = past.item AND today.event_type = past.event_type
""")
def join_not_delivered_before(t: Tables) -> DataFrame:
    keys = ["user_id", "item", "event_type"]
    pairs = t.events.withColumn("item", S.json_field(F.col("props"), "k"))
    today = pairs.where(on_days("ts", "20240125", "20991231")).select(*keys).distinct()
    return P.anti(today, pairs.where(on_days("ts", "20240105", "20240124")), keys)


# --- aggregations ----------------------------------------------------------------------------


@query(f"""
SELECT o_orderpriority, o_orderstatus, COUNT(*) AS n, CAST(SUM({CENTS.format('o_totalprice')}) AS DOUBLE) AS total,
       MIN(o_totalprice) AS low, MAX(o_totalprice) AS high,
       CAST(SUM({CENTS.format('o_totalprice')}) AS DOUBLE) / COUNT(*) AS mean
FROM orders GROUP BY 1, 2
""")
def agg_basic(t: Tables) -> DataFrame:
    total = F.sum(S.money(F.col("o_totalprice"))).cast("double")
    return t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(
        F.count("*").alias("n"), total.alias("total"), F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"),
        (total / F.count("*")).alias("mean"))


@query("SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def agg_distinct(t: Tables) -> DataFrame:
    return t.customer.select("c_nationkey", "c_mktsegment").distinct()


@query(f"""
SELECT user_id, SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END)::BIGINT AS views,
       SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END)::BIGINT AS clicks,
       CAST(SUM(CASE WHEN event_type = 'purchase' THEN {CENTS.format('value')} ELSE 0 END) AS DOUBLE) AS bought
FROM events GROUP BY 1
""")
def agg_conditional(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    return t.events.groupBy("user_id").agg(
        A.count_where(kind == "view").alias("views"), A.count_where(kind == "click").alias("clicks"),
        A.sum_where(kind == "purchase", S.money(F.col("value"))).cast("double").alias("bought"))


@query("""
SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1 HAVING SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) > 2
""")
def agg_having(t: Tables) -> DataFrame:
    grouped = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("_u"))
    return grouped.where(F.col("_u") > 2).drop("_u")


@query("""
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, CASE WHEN SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) > 0 THEN 1 ELSE 0 END AS hit
           FROM events GROUP BY 1, 2)
SELECT user_id, SUM(hit)::BIGINT AS buy_days FROM d GROUP BY 1
""")
def agg_two_level(t: Tables) -> DataFrame:
    flagged = t.events.select("user_id", F.to_date("ts").alias("day"), (F.col("event_type") == "purchase").cast("int").alias("bought"))
    return A.days_with_any(flagged, ["user_id"], "day", "bought", "buy_days")


@query(f"""
SELECT l_suppkey, CAST(SUM(CASE WHEN l_returnflag = 'N' THEN {CENTS.format('l_extendedprice')}
                                ELSE {CENTS.format('l_extendedprice')} * 6.7 END) AS DOUBLE) AS amount
FROM lineitem GROUP BY 1
""")
def agg_currency(t: Tables) -> DataFrame:
    amount = S.in_home_currency(S.money(F.col("l_extendedprice")), F.col("l_returnflag"), home="N")
    return t.lineitem.groupBy("l_suppkey").agg(F.sum(amount).cast("double").alias("amount"))


@query(f"""
WITH s AS (SELECT o_custkey, l_partkey, SUM({CENTS.format('l_extendedprice')}) AS spent
           FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2),
     r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY spent DESC, l_partkey) AS rn FROM s)
SELECT o_custkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY rn) AS parts FROM r WHERE rn <= 3 GROUP BY 1
""")
def agg_top_list(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_extendedprice")
    spent = lines.join(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey").groupBy("o_custkey", "l_partkey").agg(
        F.sum(S.money(F.col("l_extendedprice"))).alias("spent"))
    lists = R.top_list(spent, "o_custkey", "l_partkey", [F.desc("spent"), F.col("l_partkey")], 3, "parts")
    return lists.withColumn("parts", F.concat_ws(",", F.col("parts").cast("array<string>")))


_FUNNEL_STEPS = ("view", "click", "purchase")


def _sql_funnel(steps) -> str:
    parts = ["COUNT(*) AS members"]
    for s in steps:
        users, total = f"SUM(CASE WHEN {s} > 0 THEN 1 ELSE 0 END)", f"COALESCE(SUM({s}), 0)"
        parts += [f"CAST({users} AS BIGINT) AS {s}_users", f"CAST({total} AS BIGINT) AS {s}_total",
                  f"CAST(CAST(round({users}::DECIMAL(28,10) / COUNT(*), 6) AS DECIMAL(38,6)) AS DOUBLE) AS {s}_user_rate",
                  f"CAST(CAST(round({total}::DECIMAL(28,10) / COUNT(*), 6) AS DECIMAL(38,6)) AS DOUBLE) AS {s}_rate"]
    return ",\n".join(parts)


_SQL_COUNTS = """
WITH n AS (SELECT user_id, SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS view,
                  SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS click,
                  SUM(CASE WHEN event_type = 'purchase' AND value > 100 THEN 1 ELSE 0 END) AS purchase FROM events GROUP BY 1),
     u AS (SELECT c_custkey, c_mktsegment, CAST(c_nationkey AS VARCHAR) AS c_nationkey, view, click, purchase FROM customer LEFT JOIN n ON c_custkey = user_id)
"""


def _step_counts(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    counts = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(
        F.count_if(kind == "view").alias("view"), F.count_if(kind == "click").alias("click"),
        F.count_if((kind == "purchase") & (F.col("value") > 100)).alias("purchase"))
    return t.customer.select("c_custkey", "c_mktsegment", F.col("c_nationkey").cast("string").alias("c_nationkey")).join(counts, "c_custkey", "left")


@query(f"{_SQL_COUNTS} SELECT c_mktsegment, {_sql_funnel(_FUNNEL_STEPS)} FROM u GROUP BY 1")
def agg_funnel(t: Tables) -> DataFrame:
    return decimals_as_doubles(_step_counts(t).groupBy("c_mktsegment").agg(*A.funnel_columns(_FUNNEL_STEPS)))


@query(f"""{_SQL_COUNTS}
SELECT 'sum' AS level, NULL::VARCHAR AS c_nationkey, c_mktsegment, {_sql_funnel(_FUNNEL_STEPS)} FROM u GROUP BY c_mktsegment
UNION ALL SELECT 'branch', c_nationkey, c_mktsegment, {_sql_funnel(_FUNNEL_STEPS)} FROM u GROUP BY c_nationkey, c_mktsegment
UNION ALL SELECT 'all', NULL, NULL, {_sql_funnel(_FUNNEL_STEPS)} FROM u
""")
def agg_levels(t: Tables) -> DataFrame:
    levels = {"sum": ["c_mktsegment"], "branch": ["c_nationkey", "c_mktsegment"], "all": []}
    return decimals_as_doubles(A.at_levels(_step_counts(t), levels, A.funnel_columns(_FUNNEL_STEPS)))


@query("""
WITH r AS (SELECT l_orderkey, l_partkey, l_returnflag,
                  ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey, l_returnflag) AS rn FROM lineitem)
SELECT l_orderkey AS user_id, '[{"positionId":"B1","slots":[{"index":"0","prdList":[' ||
       string_agg('{"code":"' || l_partkey || '","type":"' || l_returnflag || '"}', ',' ORDER BY rn) || ']}]}]' AS prod_info
FROM r WHERE rn <= 3 GROUP BY 1
""")
def agg_json_slots(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("user_id"), F.col("l_partkey").cast("string").alias("code"),
                              F.col("l_returnflag").alias("kind"), "l_extendedprice", "l_partkey")
    best = R.top_k(lines, "user_id", [F.desc("l_extendedprice"), F.col("l_partkey"), F.col("kind")], 3)
    return A.json_slots(best, ["user_id"], "B1", "code", "kind", "rank")


@query("SELECT strftime(o_orderdate, '%Y%m') AS dt, o_orderpriority AS tag, COUNT(*) AS n FROM orders GROUP BY 1, 2 ORDER BY 1, 2")
def agg_partition_counts(t: Tables) -> DataFrame:
    return t.orders.groupBy(month_of("o_orderdate").alias("dt"), F.col("o_orderpriority").alias("tag")).agg(
        F.count("*").alias("n")).orderBy("dt", "tag")


@query("SELECT user_id, MAX(CASE WHEN event_type = 'error' AND value > 150 THEN 1 ELSE 0 END) AS label FROM events GROUP BY 1")
def agg_max_label(t: Tables) -> DataFrame:
    bad = (F.col("event_type") == "error") & (F.col("value") > 150)
    return t.events.groupBy("user_id").agg(F.max(bad.cast("int")).alias("label"))


@query("""
WITH c AS (SELECT json_extract_string(props, '$.k') AS item, SUM(CASE WHEN event_type = 'view' AND value > 100 THEN 1 ELSE 0 END)::BIGINT AS send,
                  SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END)::BIGINT AS click FROM events GROUP BY 1)
SELECT item, send, click, click::DOUBLE / GREATEST(send, 1) AS click_ratio FROM c
""")
def agg_guarded_ratio(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    counts = t.events.groupBy(S.json_field(F.col("props"), "k").alias("item")).agg(
        F.count_if((kind == "view") & (F.col("value") > 100)).alias("send"), F.count_if(kind == "click").alias("click"))
    return counts.withColumn("click_ratio", A.ratio(F.col("click"), F.col("send")))


# --- windows, top-k -------------------------------------------------------------------------------


@query("""
SELECT o_orderkey, o_orderstatus, o_orderpriority, ROW_NUMBER() OVER (PARTITION BY o_orderstatus, o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rank
FROM orders
""")
def window_group_rank(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return R.ranked(rows, [F.desc("o_totalprice"), F.col("o_orderkey")], ["o_orderstatus", "o_orderpriority"]).drop("o_totalprice")


@query("""
SELECT o_orderkey, o_orderstatus, ROW_NUMBER() OVER (PARTITION BY o_orderstatus ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey) AS rank FROM orders
""")
def window_two_key_rank(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    order = [F.col("o_orderpriority"), F.desc("o_totalprice"), F.col("o_orderkey")]
    return R.ranked(rows, order, ["o_orderstatus"]).select("o_orderkey", "o_orderstatus", "rank")


@query("""
SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y%m%d') AS dt FROM (
 SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1
""")
def window_latest_row(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    last = R.first_per_key(rows, "o_custkey", [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return last.select("o_custkey", "o_orderkey", ymd("o_orderdate").alias("dt"))


@query("""
SELECT c_custkey, c_acctbal, ROW_NUMBER() OVER (ORDER BY c_acctbal, c_custkey) AS rank, COUNT(*) OVER () AS user_num,
       ROW_NUMBER() OVER (ORDER BY c_acctbal, c_custkey)::DOUBLE / COUNT(*) OVER () AS percentile FROM customer
""")
def window_global_percentile(t: Tables) -> DataFrame:
    return R.with_percentile(t.customer.select("c_custkey", "c_acctbal"), [F.col("c_acctbal"), F.col("c_custkey")])


_SQL_BEST = """
WITH x AS (SELECT o_custkey AS cust_id, l_returnflag AS scene_id, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS rank, l_partkey AS prod_id
           FROM orders JOIN lineitem ON o_orderkey = l_orderkey)
SELECT cust_id, scene_id, rank, prod_id FROM (
 SELECT *, ROW_NUMBER() OVER (PARTITION BY cust_id, scene_id ORDER BY {} DESC, prod_id) AS rn FROM x) WHERE rn = 1
"""


def _best_source(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_returnflag").alias("scene_id"),
                              F.col("l_quantity").cast("int").cast("string").alias("rank"), F.col("l_partkey").alias("prod_id"))
    return t.orders.select("o_orderkey", F.col("o_custkey").alias("cust_id")).join(lines, "o_orderkey").drop("o_orderkey")


@query(_SQL_BEST.format("rank"))
def window_best_by_text_rank(t: Tables) -> DataFrame:
    return R.first_per_key(_best_source(t), ["cust_id", "scene_id"], [F.desc("rank"), F.col("prod_id")]).select("cust_id", "scene_id", "rank", "prod_id")


@query(_SQL_BEST.format("CAST(rank AS INTEGER)"))
def window_best_by_number_rank(t: Tables) -> DataFrame:
    order = [F.desc(F.col("rank").try_cast("int")), F.col("prod_id")]
    return R.first_per_key(_best_source(t), ["cust_id", "scene_id"], order).select("cust_id", "scene_id", "rank", "prod_id")


@query(f"""
WITH p AS (SELECT DISTINCT o_custkey AS user_id, l_partkey AS item_id FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
     r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY {sql_hash('w', 'user_id', 'item_id')}, item_id) AS rank FROM p)
SELECT user_id, item_id, rank::INTEGER AS rank FROM r WHERE rank <= 2
""")
def window_random_per_group(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("item_id"))
    pairs = lines.join(t.orders.select("o_orderkey", F.col("o_custkey").alias("user_id")), "o_orderkey").select("user_id", "item_id").distinct()
    return sampling.pick_per_group(pairs, "user_id", "item_id", 2, "w")


@query("""
WITH k AS (SELECT * FROM (VALUES ('BUILDING', 50), ('MACHINERY', 20), ('FURNITURE', 100000)) AS v(seg, k)),
     r AS (SELECT c_custkey, c_mktsegment, ROW_NUMBER() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer)
SELECT c_custkey, c_mktsegment, rank FROM r JOIN k ON c_mktsegment = seg WHERE rank <= k
""")
def window_top_k_by_limit(t: Tables) -> DataFrame:
    limits = S.lookup(F.col("c_mktsegment"), {"BUILDING": 50, "MACHINERY": 20, "FURNITURE": 100000})
    rows = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal", limits.alias("k"))
    best = R.top_k_by_limit(rows, ["c_mktsegment"], ["-c_acctbal", "c_custkey"], "k")
    return best.select("c_custkey", "c_mktsegment", "rank")


@query("SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def top_orders(t: Tables) -> DataFrame:
    return R.first_n(t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), [F.desc("o_totalprice"), F.col("o_orderkey")], 25)


@query("""
WITH r AS (SELECT o_orderkey, o_orderpriority, ROW_NUMBER() OVER (PARTITION BY o_orderpriority ORDER BY o_orderstatus, o_totalprice DESC, o_orderkey) AS turn,
                  COUNT(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)
SELECT o_orderkey, o_orderpriority, CASE WHEN turn <= CAST(floor(1.25::DOUBLE * n / 7) AS INTEGER) THEN 'ready' ELSE 'later' END AS tag FROM r
""")
def top_share_of_days_left(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    turns = R.ranked(rows, [F.col("o_orderstatus"), F.desc("o_totalprice"), F.col("o_orderkey")], ["o_orderpriority"], "turn", "n")
    share = (F.lit(1 / (1 - 0.2)) * F.col("n") / 7).cast("int")
    return turns.select("o_orderkey", "o_orderpriority", F.when(F.col("turn") <= share, "ready").otherwise("later").alias("tag"))


@query("""
WITH c AS (SELECT DISTINCT o_custkey, l_partkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
     x AS (SELECT o_custkey, p_partkey, p_retailprice FROM c JOIN part ON l_partkey = p_partkey WHERE p_size > 10),
     r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY p_retailprice DESC, p_partkey) AS rn FROM x),
     g AS (SELECT o_custkey, string_agg(CAST(p_partkey AS VARCHAR), ',' ORDER BY rn) AS prods FROM r WHERE rn <= 3 GROUP BY 1)
SELECT c_custkey, prods FROM customer LEFT JOIN g ON c_custkey = o_custkey
""")
def top_list_by_profit(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"))
    bought = lines.join(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey").select("o_custkey", "p_partkey").distinct()
    rates = t.part.select("p_partkey", F.when(F.col("p_size") > 10, F.col("p_retailprice")).alias("rate")).where(F.col("rate").isNotNull())
    lists = R.top_list(bought.join(rates, "p_partkey"), "o_custkey", "p_partkey", [F.desc("rate"), F.col("p_partkey")], 3, "prods")
    text = lists.select(F.col("o_custkey").alias("c_custkey"), F.concat_ws(",", F.col("prods").cast("array<string>")).alias("prods"))
    return t.customer.select("c_custkey").join(text, "c_custkey", "left")


# --- set operations ---------------------------------------------------------------------------


@query("""
SELECT o_orderkey AS id, o_custkey AS cust, 'early' AS half FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL SELECT o_orderkey, o_custkey, 'late' FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
""")
def set_union_all(t: Tables) -> DataFrame:
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    rows = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("cust"), "o_orderdate")
    early = rows.where(F.col("o_orderdate") < cut).withColumn("half", F.lit("early"))
    late = rows.where(F.col("o_orderdate") >= cut).select(F.lit("late").alias("half"), "cust", "id", "o_orderdate")
    return P.union_all([early, late]).drop("o_orderdate")


@query("""
SELECT o_custkey AS user_id FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 400000
UNION SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 400000
UNION SELECT user_id FROM events WHERE event_type = 'purchase'
UNION SELECT c_custkey FROM customer WHERE c_acctbal > 9000
""")
def set_union_distinct(t: Tables) -> DataFrame:
    big = t.orders.where(F.col("o_totalprice") > 400000)
    user = lambda df, c: df.select(F.col(c).alias("user_id"))
    parts = [
        user(big.where(F.col("o_orderstatus") == "F"), "o_custkey"), user(big.where(F.col("o_orderpriority") == "1-URGENT"), "o_custkey"),
        user(t.events.where(F.col("event_type") == "purchase"), "user_id"), user(t.customer.where(F.col("c_acctbal") > 9000), "c_custkey"),
    ]
    return P.union_all(parts).distinct()


@query("SELECT o_custkey AS id, 'order' AS src FROM orders WHERE o_totalprice > 450000 UNION ALL SELECT user_id, 'event' FROM events WHERE value > 300")
def set_union_present(t: Tables) -> DataFrame:
    orders = t.orders.where(F.col("o_totalprice") > 450000).select(F.col("o_custkey").alias("id"), F.lit("order").alias("src"))
    events = t.events.where(F.col("value") > 300).select(F.col("user_id").alias("id"), F.lit("event").alias("src"))
    none = t.supplier.where(F.col("s_acctbal") > 1e9).select(F.col("s_suppkey").alias("id"), F.lit("supplier").alias("src"))
    return P.union_present([orders, None, none, events])


@query("SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '5-LOW'")
def set_difference(t: Tables) -> DataFrame:
    low = t.orders.where((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW"))
    return P.anti(t.customer.select("c_custkey").distinct(), low.select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


# --- scalar functions ----------------------------------------------------------------------------


@query("""
SELECT c_custkey, concat(c_mktsegment, '|', c_name) AS joined, length(c_name) AS len, substr(c_name, 1, 4) AS head,
       split_part(c_name, '#', 2) AS tail, CASE WHEN contains(c_name, '--') THEN split_part(c_name, '--', 2) END AS missing,
       regexp_extract(c_name, '#0*([0-9]+)$', 1) AS number, upper(trim(concat(' ', lower(c_mktsegment), ' '))) AS up,
       replace(c_name, '#', '-') AS dashed, c_name LIKE '%99%' AS has99, regexp_matches(c_name, '0[1-3]$') AS ends
FROM customer
""")
def fn_text(t: Tables) -> DataFrame:
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    return t.customer.select(
        "c_custkey", F.concat(segment, F.lit("|"), name).alias("joined"), F.length(name).cast("bigint").alias("len"),
        F.substring(name, 1, 4).alias("head"), F.split_part(name, F.lit("#"), F.lit(2)).alias("tail"),
        S.split_part(name, "--", 1).alias("missing"), F.regexp_extract(name, "#0*([0-9]+)$", 1).alias("number"),
        F.upper(F.trim(F.concat(F.lit(" "), F.lower(segment), F.lit(" ")))).alias("up"),
        F.replace(name, F.lit("#"), F.lit("-")).alias("dashed"), name.like("%99%").alias("has99"), name.rlike("0[1-3]$").alias("ends"))


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS dt, strftime(o_orderdate - INTERVAL 1 DAY, '%Y%m%d') AS day_before,
       strftime(o_orderdate, '%Y-%m-%d') AS dashed, date_diff('day', TIMESTAMP '2001-01-01', o_orderdate)::INTEGER AS days,
       strftime(date_trunc('month', o_orderdate) - INTERVAL 1 DAY, '%Y%m%d') AS feature_dt,
       CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y/%m/%d') END AS parsed
FROM orders
""")
def fn_dates(t: Tables) -> DataFrame:
    dt = ymd("o_orderdate")
    maybe = F.when(F.col("o_orderstatus") == "F", dt).otherwise(F.lit("0"))
    return t.orders.select(
        "o_orderkey", dt.alias("dt"), shift_ymd(dt, -1).alias("day_before"), reformat_date(dt, "yyyyMMdd", "yyyy-MM-dd").alias("dashed"),
        F.datediff(parse_ymd(dt), F.lit("2001-01-01").cast("date")).alias("days"),
        ymd(F.date_sub(F.trunc(F.to_date("o_orderdate"), "month"), 1)).alias("feature_dt"),
        reformat_date(maybe, "yyyyMMdd", "yyyy/MM/dd").alias("parsed"))


@query("""
SELECT c_custkey, round(ln(1 + greatest(c_acctbal, 0)), 6) AS logged, c_acctbal / 7 AS divided,
       CAST(trunc(c_acctbal) AS INTEGER) AS whole, greatest(c_nationkey, 10) AS at_least,
       CAST(CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 3 AS DECIMAL(38,6)) AS DOUBLE) AS exact
FROM customer
""")
def fn_math(t: Tables) -> DataFrame:
    balance = F.col("c_acctbal")
    return t.customer.select(
        "c_custkey", F.round(S.safe_log1p(balance), 6).alias("logged"), (balance / 7).alias("divided"), balance.cast("int").alias("whole"),
        F.greatest("c_nationkey", F.lit(10)).alias("at_least"), (S.money(balance) * 3).cast("decimal(38,6)").cast("double").alias("exact"))


@query("""
WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
     c AS (SELECT vec_id AS cid, v AS w FROM e WHERE vec_id = 0)
SELECT vec_id, CAST(list_position(v, list_max(v)) - 1 AS INTEGER) AS best, v[2] AS second, len(v)::INTEGER AS size,
       round(list_sum(list_transform(list_zip(v, w), lambda p: p[1] * p[2])) / (sqrt(list_sum(list_transform(v, lambda x: x * x))) * sqrt(list_sum(list_transform(w, lambda x: x * x)))), 6) AS sim
FROM e CROSS JOIN c
""")
def fn_arrays(t: Tables) -> DataFrame:
    vectors = t.embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    probe = vectors.where(F.col("vec_id") == 0).first()["v"]
    v = F.col("v")
    return vectors.select("vec_id", S.argmax(v).alias("best"), F.element_at(v, 2).alias("second"), F.size(v).alias("size"),
                          F.round(S.cosine(v, F.array(*[F.lit(x) for x in probe])), 6).alias("sim"))


@query("""
SELECT vec_id, unnest(range(0, len(embedding)))::INTEGER AS pos, unnest(embedding)::DOUBLE AS value FROM embeddings
""")
def fn_posexplode(t: Tables) -> DataFrame:
    rows = t.embeddings.select("vec_id", F.posexplode("embedding").alias("pos", "value"))
    return rows.withColumn("value", F.col("value").cast("double"))


@query("""
SELECT event_id, json_extract_string(props, '$.k')::INTEGER AS k, '{"user":' || user_id || ',"type":"' || event_type || '"}' AS body FROM events
""")
def fn_json(t: Tables) -> DataFrame:
    body = F.to_json(F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("type")))
    return t.events.select("event_id", S.json_field(F.col("props"), "k").cast("int").alias("k"), body.alias("body"))


_SQL_RANGE_TEXT = "CASE WHEN p_size < 10 THEN p_size || '.0%~' || (p_size + 2) || '.5%' WHEN p_size < 20 THEN '0.0' || p_size WHEN p_size < 30 THEN p_size || '%' ELSE p_name END"


def _range_text():
    size = F.col("p_size")
    text = size.cast("string")
    return (F.when(size < 10, F.concat(text, F.lit(".0%~"), (size + 2).cast("string"), F.lit(".5%")))
            .when(size < 20, F.concat(F.lit("0.0"), text)).when(size < 30, F.concat(text, F.lit("%"))).otherwise(F.col("p_name")))


@query(f"""
WITH b AS (SELECT p_partkey, p_size, {_SQL_RANGE_TEXT} AS benchmark FROM part)
SELECT p_partkey, benchmark, CAST(CASE WHEN p_size < 10 THEN p_size + 2.5 WHEN p_size < 20 THEN CAST('0.0' || p_size AS DOUBLE) * 100
       WHEN p_size < 30 THEN p_size ELSE 0 END AS FLOAT) AS benchmark_f FROM b
""")
def fn_benchmark(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", _range_text().alias("benchmark"))
    return rows.withColumn("benchmark_f", benchmark_number(F.col("benchmark")))


@query(f"""
WITH b AS (SELECT *, {_SQL_RANGE_TEXT} AS benchmark, CAST(p_retailprice AS DECIMAL(16,4)) AS d FROM part)
SELECT p_partkey,
  '产品净值' || CASE WHEN d = trunc(d) THEN CAST(CAST(d AS INTEGER) AS VARCHAR) || '.0' ELSE rtrim(CAST(d AS VARCHAR), '0') END AS nav,
  '截至' || strftime(DATE '2023-01-01' + p_size, '%Y/%m/%d') AS nav_date,
  CASE p_size // 10 WHEN 1 THEN '风险等级极低风险' WHEN 2 THEN '风险等级低风险' WHEN 3 THEN '风险等级中等风险' WHEN 4 THEN '风险等级较高风险 ' WHEN 5 THEN '风险等级高风险' ELSE '' END AS risk,
  CASE WHEN benchmark = '' THEN '' ELSE '业绩比较基准：' || replace(benchmark, '~', '-') END AS benchmark,
  CASE WHEN p_size % 10 = 0 THEN '1.0%' ELSE '1.' || (p_size % 10) || '%' END AS ratio,
  CASE p_size % 10 WHEN 0 THEN '每日' WHEN 1 THEN '每周' WHEN 2 THEN '每月' WHEN 3 THEN '每季' WHEN 4 THEN '每半年' WHEN 5 THEN '每年' WHEN 6 THEN '每二年' WHEN 7 THEN '每三年' ELSE '' END AS term,
  CASE WHEN p_type = 'PROMO' THEN benchmark ELSE '成立以来年化收益率' END AS yield,
  CASE p_size % 10 WHEN 0 THEN '精选固收' WHEN 1 THEN '精选权益' WHEN 2 THEN '精选商品及金融衍生品' WHEN 3 THEN '精选混合' WHEN 4 THEN '精选货币' ELSE '' END AS invest,
  CASE WHEN p_size // 10 = 0 THEN '' ELSE CAST(p_size // 10 AS VARCHAR) END AS lock,
  CASE WHEN p_brand = 'Brand#1' THEN 'chrem_1301' WHEN p_brand = 'Brand#2' THEN 'chrem_5811221014' ELSE '' END AS template
FROM b
""")
def fn_product_text(t: Tables) -> DataFrame:
    size = F.col("p_size")
    tens, ones = F.floor(size / 10).cast("string"), F.pmod(size, F.lit(10))
    day = ymd(F.date_add(F.lit("2023-01-01").cast("date"), size))
    series = F.when(F.col("p_brand") == "Brand#1", "1301").otherwise(F.lit("other"))
    code = F.when(F.col("p_brand") == "Brand#2", "5811221014").otherwise(F.col("p_name"))
    kind = F.when(F.col("p_type") == "PROMO", "C").otherwise(F.lit("0"))
    return t.part.withColumn("bench", _range_text()).select(
        "p_partkey", fixed_text(F.col("p_retailprice").cast("decimal(16,4)"), "产品净值").alias("nav"), date_text(day, "截至").alias("nav_date"),
        risk_text(tens).alias("risk"), benchmark_text(F.col("bench")).alias("benchmark"),
        percent_text(F.concat(F.lit("0.01"), ones.cast("string"), F.lit("0"))).alias("ratio"), term_text(ones).alias("term"),
        yield_text(kind, F.col("bench")).alias("yield"), invest_text(ones).alias("invest"), lock_text(tens).alias("lock"),
        template_id(code, series).alias("template"))


_SQL_CLEAN = (
    r"regexp_replace(regexp_replace(regexp_replace({}, '\$\{{(.+?)\}}', '', 'g'), "
    r"'[-a-zA-Z0-9@:%._\+~#=]{{1,256}}\.[a-zA-Z0-9()]{{1,6}}\b([-a-zA-Z0-9()@:%_\+.~#?&//=]*)', '', 'g'), "
    r"'(尊敬|亲爱)的.*(先生|女士)(：|，)', '', 'g')"
)


@query(f"SELECT doc_id, {_SQL_CLEAN.format('text')} AS cleaned FROM documents")
def fn_clean_documents(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", S.clean_ad(F.col("text")).alias("cleaned"))


@query(f"SELECT page_id, {_SQL_CLEAN.format('url')} AS cleaned, length({_SQL_CLEAN.format('html')}) AS kept FROM pages")
def fn_clean_pages(t: Tables) -> DataFrame:
    return t.pages.select("page_id", S.clean_ad(F.col("url")).alias("cleaned"), F.length(S.clean_ad(F.col("html"))).cast("bigint").alias("kept"))


@query(f"""
SELECT doc_id, length({_SQL_CLEAN.format('text')}) AS kept FROM documents
""")
def fn_sql_registered(t: Tables) -> DataFrame:
    S.register_sql_functions(t.spark)
    return t.documents.selectExpr("doc_id", "CAST(length(clean_ad(text)) AS BIGINT) AS kept")


@query("""
WITH p AS (SELECT p_partkey, CASE WHEN p_size % 4 > 0 THEN p_brand END AS brand, p_size, CASE WHEN p_size % 3 = 0 THEN NULL ELSE 'say "' || p_type || '"' END AS kind FROM part)
SELECT p_partkey, '{"brand":' || COALESCE('"' || brand || '"', 'null') || ',"kind":' || COALESCE('"say \\"' || substr(kind, 6, length(kind) - 6) || '\\""', 'null') || ',"size":' || p_size || '}' AS body,
  round(CASE WHEN p_size % 5 = 0 THEN 0.0 ELSE (p_size * 1.0 + 2.0) / (sqrt(p_size * p_size + 4.0) * sqrt(2.0)) END, 9) AS sim FROM p
""")
def fn_sql_json_and_similarity(t: Tables) -> DataFrame:
    """Both functions called by name from SQL text."""
    S.register_sql_functions(t.spark)
    t.part.selectExpr("p_partkey", "p_size", "CASE WHEN p_size % 4 > 0 THEN p_brand END AS brand",
                      """CASE WHEN p_size % 3 = 0 THEN NULL ELSE concat('say "', p_type, '"') END AS kind""").createOrReplaceTempView("beaconry_parts")
    return t.spark.sql("""
        SELECT p_partkey, build_json(array('brand', 'kind', 'size'), array(to_json_text(brand), to_json_text(kind), CAST(p_size AS STRING))) AS body,
               round(vector_sim(CASE WHEN p_size % 5 = 0 THEN array(0D, 0D) ELSE array(CAST(p_size AS DOUBLE), 2D) END, array(1D, 1D)), 9) AS sim
        FROM beaconry_parts""")


@query("""
WITH c AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN '第一银行' || c_name WHEN c_mktsegment = 'MACHINERY' THEN c_name || '(分行级)' ELSE c_name END AS b FROM customer)
SELECT c_custkey, CASE WHEN starts_with(b, '第一银行') THEN substr(b, 5) WHEN contains(b, '(分行级)') THEN split_part(b, '(分行级)', 1) ELSE b END AS branch FROM c
""")
def fn_branch_name(t: Tables) -> DataFrame:
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    raw = F.when(segment == "BUILDING", F.concat(F.lit("第一银行"), name)).when(segment == "MACHINERY", F.concat(name, F.lit("(分行级)"))).otherwise(name)
    return t.customer.select("c_custkey", S.branch_name(raw, "第一银行").alias("branch"))
