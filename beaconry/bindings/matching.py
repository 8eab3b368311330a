"""Products on sale and the products that fit each customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.product_text import YIELD_COLUMNS, benchmark_number
from ..functions.scalars import case_of
from ..plans import cards, cohort, matching
from .registry import Tables, registrar

QUERIES: dict = {}
ORACLES: dict = {}
query = registrar(QUERIES, ORACLES)


def _flag(test):
    return F.when(test, "1").otherwise(F.lit("0"))


def products(t: Tables) -> DataFrame:
    """Parts as wealth products: brands carry the special rules, size is level and term,
    price the risk and the benchmark."""
    brand, size = F.col("p_brand"), F.col("p_size")
    return t.part.select(
        F.col("p_partkey").cast("string").alias("prod_id"), _flag(brand == "Brand#1").alias("list_type"),
        _flag(brand == "Brand#2").alias("is_new_client_prd"), _flag(brand == "Brand#3").alias("diamond_card_flag"),
        _flag(brand == "Brand#4").alias("salary_card_flags"), _flag(brand == "Brand#5").alias("pension_funds_flag"),
        (F.floor(size / 10) + 50).cast("string").alias("service_level"), F.when(F.col("p_type") == "PROMO", "2").alias("ipo_type"),
        (F.floor((F.col("p_retailprice") - 900) / 20) + 1).cast("string").alias("risk_level"), size.alias("prd_time_limit"),
        F.col("p_retailprice").alias("benchmark"),
    )


def customers(t: Tables) -> DataFrame:
    balance, segment = F.col("c_acctbal"), F.col("c_mktsegment")
    return t.customer.select(
        F.col("c_custkey").alias("cust_id"), _flag(segment == "HOUSEHOLD").alias("is_new_client"), _flag(segment == "MACHINERY").alias("salary_ind"),
        _flag(segment == "FURNITURE").alias("pension_ind"), (F.floor((balance + 1000) / 2000) + 50).cast("string").alias("service_level_cust"),
        _flag(balance > 8000).alias("auth_type"), _flag(F.col("c_nationkey") < 15).alias("risk_fin_valid_ind"),
        (F.floor((balance + 1000) / 2200) + 1).cast("string").alias("risk_level_cust"), (F.col("c_nationkey") * 3 + 20).alias("age"),
    )


def purchases(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").cast("string").alias("prod_id"))
    return lines.join(t.orders.select("o_orderkey", F.col("o_custkey").alias("cust_id")), "o_orderkey").select("cust_id", "prod_id")


def _text(lists: DataFrame) -> DataFrame:
    """Lists as comma text, which both engines compare alike."""
    return lists.withColumn("prod_list", F.when(F.col("prod_list").isNotNull(), F.array_join("prod_list", ",")))


SQL_MATCH = """
prod AS (SELECT CAST(p_partkey AS VARCHAR) AS prod_id, CASE p_brand WHEN 'Brand#1' THEN 'whitelist' WHEN 'Brand#2' THEN 'new' WHEN 'Brand#3' THEN 'diamond'
   WHEN 'Brand#4' THEN 'salary' WHEN 'Brand#5' THEN 'pension' ELSE 'level' END AS rule, 50 + p_size // 10 AS level, p_type = 'PROMO' AS private,
   CAST(floor((p_retailprice - 900) / 20) AS INTEGER) + 1 AS risk, p_size AS term, p_retailprice AS benchmark FROM part),
cust AS (SELECT c_custkey AS cust_id, c_mktsegment AS seg, CAST(floor((c_acctbal + 1000) / 2000) AS INTEGER) + 50 AS level, c_acctbal > 8000 AS auth, c_nationkey < 15 AS tested,
   CAST(floor((c_acctbal + 1000) / 2200) AS INTEGER) + 1 AS risk, c_nationkey * 3 + 20 AS age, c_name, c_acctbal, c_nationkey FROM customer),
buy AS (SELECT o_custkey AS cust_id, CAST(l_partkey AS VARCHAR) AS prod_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
wl AS (SELECT DISTINCT cust_id, prod_id FROM buy),
term AS (SELECT buy.cust_id, SUM(p_size)::DOUBLE / COUNT(p_size) AS avg_term FROM buy JOIN part ON CAST(p_partkey AS VARCHAR) = prod_id GROUP BY 1),
pair AS (SELECT c.cust_id, p.prod_id, p.benchmark, p.term FROM cust c CROSS JOIN prod p LEFT JOIN wl ON wl.cust_id = c.cust_id AND wl.prod_id = p.prod_id
   WHERE CASE p.rule WHEN 'whitelist' THEN wl.cust_id IS NOT NULL WHEN 'new' THEN seg = 'HOUSEHOLD' WHEN 'diamond' THEN c.level IN (53, 54)
     WHEN 'salary' THEN seg = 'MACHINERY' WHEN 'pension' THEN seg = 'FURNITURE' ELSE c.level >= p.level END
   AND (NOT p.private OR c.auth) AND (NOT c.tested OR c.risk >= p.risk))
"""

_SQL_LIST = """
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY cust_id ORDER BY benchmark DESC, prod_id) AS rn FROM {pair}),
lst AS (SELECT cust_id, string_agg(prod_id, ',' ORDER BY rn) AS prod_list FROM r WHERE rn <= 5 GROUP BY 1)
"""


@query(f"WITH {SQL_MATCH}, {_SQL_LIST.format(pair='pair')} SELECT cust.cust_id, prod_list FROM cust LEFT JOIN lst ON cust.cust_id = lst.cust_id")
def match_rules(t: Tables) -> DataFrame:
    return _text(matching.rule_lists(customers(t), products(t), purchases(t), 5))


@query(f"""
WITH {SQL_MATCH}, timed AS (SELECT pair.* FROM pair LEFT JOIN term ON pair.cust_id = term.cust_id WHERE pair.term <= COALESCE(avg_term, 1.0)),
{_SQL_LIST.format(pair='timed')} SELECT cust.cust_id, prod_list FROM cust LEFT JOIN lst ON cust.cust_id = lst.cust_id
""")
def match_rules_and_term(t: Tables) -> DataFrame:
    terms = matching.average_terms(purchases(t), products(t))
    people = customers(t).join(terms, "cust_id", "left")
    return _text(matching.rule_lists(people, products(t), purchases(t), 5))


@query(f"""
WITH {SQL_MATCH}, timed AS (SELECT cust.cust_id, prod.prod_id, benchmark FROM cust LEFT JOIN term ON cust.cust_id = term.cust_id JOIN prod ON prod.term <= COALESCE(avg_term, 1.0)),
{_SQL_LIST.format(pair='timed')} SELECT cust.cust_id, prod_list FROM cust LEFT JOIN lst ON cust.cust_id = lst.cust_id
""")
def match_term(t: Tables) -> DataFrame:
    terms = matching.average_terms(purchases(t), products(t))
    people = customers(t).join(terms, "cust_id", "left").withColumn("reach", F.coalesce("avg_term", F.lit(1.0)))
    return _text(matching.level_lists(people, "reach", products(t), "prd_time_limit", [F.desc("benchmark"), F.col("prod_id")], 5))


@query(f"""
WITH {SQL_MATCH}, fit AS (SELECT cust.cust_id, prod.prod_id, benchmark FROM cust JOIN prod ON prod.risk <= cust.risk AND (age < 75 OR (age >= 75 AND prod.risk < 4))),
{_SQL_LIST.format(pair='fit')} SELECT cust.cust_id, prod_list FROM cust LEFT JOIN lst ON cust.cust_id = lst.cust_id
""")
def match_fund_risk(t: Tables) -> DataFrame:
    funds = products(t).withColumn("risk", F.col("risk_level").cast("int"))
    people = customers(t).withColumn("reach", matching.fund_risk(F.col("age"), F.col("risk_level_cust").cast("int")))
    return _text(matching.level_lists(people, "reach", funds, "risk", [F.desc("benchmark"), F.col("prod_id")], 5))


@query(f"""
WITH {SQL_MATCH}, {_SQL_LIST.format(pair='pair')},
el AS (SELECT cust_id FROM cust WHERE c_acctbal > 1000)
SELECT el.cust_id, prod_list, CASE WHEN ok.cust_id IS NOT NULL THEN c_name END AS cust_name, CASE WHEN ok.cust_id IS NOT NULL THEN substr(c_name, 8) END AS phone_number
FROM el LEFT JOIN lst ON el.cust_id = lst.cust_id LEFT JOIN (SELECT * FROM cust WHERE c_nationkey > 4) ok ON el.cust_id = ok.cust_id
""")
def match_lists_with_contact(t: Tables) -> DataFrame:
    eligible = t.customer.where(F.col("c_acctbal") > 1000).select(F.col("c_custkey").alias("cust_id"))
    people = customers(t).join(eligible, "cust_id", "left_semi")
    lists = eligible.join(matching.rule_lists(people, products(t), purchases(t), 5), "cust_id", "left")
    phone = F.when(F.col("c_nationkey") > 4, F.substring("c_name", 8, 11)).otherwise(F.lit("none"))
    contacts = t.customer.select(F.col("c_custkey").alias("cust_id"), F.col("c_name").alias("cust_name"), phone.alias("phone_number"))
    return _text(matching.with_contact(lists, contacts, digits=11))


_SQL_SALE = """
p AS (SELECT p_partkey, CASE WHEN p_size < 40 THEN '17' ELSE '1' END AS channels, CAST(CAST(floor((p_retailprice - 900) / 15) AS INTEGER) AS VARCHAR) AS status,
   CASE p_brand WHEN 'Brand#1' THEN '1301' WHEN 'Brand#2' THEN 'D321' ELSE 'D309' END AS reserve1, CASE WHEN p_size > 20 THEN '1' ELSE '0' END AS cycle_tradable,
   CASE WHEN p_type = 'PROMO' THEN '0' ELSE '1' END AS per_allow, CASE WHEN p_size < 5 THEN NULL WHEN p_size < 15 THEN 0 ELSE 20240000 + p_size * 10 END AS ends FROM part)
"""


@query(f"""
WITH {_SQL_SALE} SELECT p_partkey AS prod_id, reserve1 FROM p
WHERE channels LIKE '%7%' AND status IN ('0', '1', '6') AND (reserve1 NOT IN ('1301', 'D321') OR (reserve1 IN ('1301', 'D321') AND cycle_tradable = '1'))
  AND per_allow = '1' AND (ends = 0 OR ends IS NULL OR ends >= 20240200)
""")
def products_on_sale(t: Tables) -> DataFrame:
    size, brand = F.col("p_size"), F.col("p_brand")
    ends = F.when(size < 5, F.lit(None)).when(size < 15, 0).otherwise(size * 10 + 20240000)
    rows = t.part.select(
        F.col("p_partkey").alias("prod_id"), F.when(size < 40, "17").otherwise("1").alias("channels"),
        F.floor((F.col("p_retailprice") - 900) / 15).cast("string").alias("status"),
        F.when(brand == "Brand#1", "1301").when(brand == "Brand#2", "D321").otherwise("D309").alias("reserve1"),
        _flag(size > 20).alias("cycle_tradable"), _flag(F.col("p_type") != "PROMO").alias("per_allow"), ends.alias("ipo_end_date_outer"))
    return cohort.products_on_sale(rows, 20240200).select("prod_id", "reserve1")


@query("""
WITH y AS (SELECT l_partkey, MAX(CASE WHEN l_discount > 0.02 THEN CAST(l_discount - 0.05 AS DECIMAL(18,4)) END) AS rate FROM lineitem GROUP BY 1),
th AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'R')
SELECT p_partkey AS prod_id, CAST(p_size AS VARCHAR) AS risk_level, CAST(rate AS DOUBLE) AS rct1y_profit_rate FROM part JOIN y ON p_partkey = y.l_partkey
WHERE p_size < 45 AND p_partkey IN (SELECT l_partkey FROM th) AND rate > 0
""")
def funds_on_sale(t: Tables) -> DataFrame:
    funds = t.part.select(F.col("p_partkey").alias("prod_id"), F.col("p_size").cast("string").alias("risk_level"),
                          F.when(F.col("p_size") < 45, "357").otherwise("35").alias("channels"))
    rate = F.when(F.col("l_discount") > 0.02, (F.col("l_discount") - 0.05).cast("decimal(18,4)"))
    yields = t.lineitem.select(F.col("l_partkey").alias("prod_id"), rate.alias("rct1y_profit_rate"))
    themes = t.lineitem.select(F.col("l_partkey").alias("prod_id"), F.col("l_returnflag").alias("theme_id"))
    rows = cohort.funds_on_sale(funds, yields, themes, "R")
    return rows.select("prod_id", "risk_level", F.col("rct1y_profit_rate").cast("double").alias("rct1y_profit_rate"))


@query("""
WITH z AS (SELECT o_custkey AS cust_id, CAST(l_partkey AS VARCHAR) AS prod_id, CASE l_returnflag WHEN 'A' THEN '04' WHEN 'R' THEN '05' ELSE '06' END AS item_type
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
one AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY cust_id ORDER BY item_type, prod_id) AS rn FROM z WHERE item_type IN ('04', '05')) WHERE rn = 1)
SELECT one.cust_id, prod_id AS prod_list, item_type, k.c_name AS cust_name, k.c_mktsegment AS phone_number FROM one
LEFT JOIN (SELECT * FROM customer WHERE length(c_mktsegment) = 9 AND c_nationkey = 5) k ON cust_id = c_custkey
""")
def third_party_lists(t: Tables) -> DataFrame:
    kind = case_of([(F.col("l_returnflag") == "A", "04"), (F.col("l_returnflag") == "R", "05")], "06")
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").cast("string").alias("prod_id"), kind.alias("item_type"))
    results = lines.join(t.orders.select("o_orderkey", F.col("o_custkey").alias("cust_id")), "o_orderkey")
    contacts = t.customer.select(F.col("c_custkey").alias("cust_id"), F.col("c_name").alias("cust_name"), F.col("c_mktsegment").alias("phone_number"), "c_nationkey")
    lists = matching.third_party_lists(results, ["04", "05"])
    return _text(matching.with_contact(lists, contacts, 9, F.col("c_nationkey") == 5))


@query("""
WITH ids AS (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS prod_id FROM lineitem WHERE l_quantity > 49 UNION SELECT 'DEFAULT1'),
info AS (SELECT CAST(p_partkey AS VARCHAR) AS prod_id, p_name, CASE p_type WHEN 'PROMO' THEN CAST(p_size AS VARCHAR) WHEN 'ECONOMY' THEN p_brand ELSE '' END AS tb_reco_1,
   CAST(CASE WHEN p_size < 25 THEN p_size ELSE 0 END AS FLOAT) AS benchmark_f FROM part)
SELECT ids.prod_id, p_name, tb_reco_1, benchmark_f FROM ids LEFT JOIN info ON ids.prod_id = info.prod_id
""")
def product_info_with_default(t: Tables) -> DataFrame:
    wanted = t.lineitem.where(F.col("l_quantity") > 49).select(F.col("l_partkey").alias("prod_id"))
    kind = F.col("p_type")
    shown = case_of([(kind == "PROMO", F.col("p_size").cast("string")), (kind == "ECONOMY", F.col("p_brand"))], "")
    bench = F.when(F.col("p_size") < 25, F.concat(F.lit("0.5%~"), F.col("p_size").cast("string"), F.lit("%"))).otherwise(F.lit("open"))
    info = t.part.select(F.col("p_partkey").cast("string").alias("prod_id"), "p_name", shown.alias("tb_reco_1"), benchmark_number(bench).alias("benchmark_f"))
    return matching.product_info(wanted, "DEFAULT1", info)


_RATES = list(YIELD_COLUMNS.values())


def _catalogue(t: Tables) -> DataFrame:
    """Parts as a product catalogue: every field has good, odd and missing values; every product is listed twice."""
    size, key = F.col("p_size"), F.col("p_partkey")
    choose = lambda n, *values: F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (n % len(values) + 1).cast("int"))
    rows = t.part.select(
        key.cast("string").alias("prod_id"), F.col("p_name").alias("prd_name"), F.col("p_brand").alias("ta_code"), choose(size, "1301", "x", None).alias("reserve1"),
        choose(size, "1.50", "0.98764", None, "abc", " 12 ").alias("nav"), choose(size, "20240105", "2024", None).alias("nav_date"),
        choose(key, "20240229", "20230229").alias("end_date"), choose(size, "1", " 2 ", "9", None).alias("risk_level"), choose(size, "1.0%~2.5%", "", None, "0.03").alias("benchmark"),
        choose(key, "0.0123", "0", None).alias("nav_ratio"), choose(size, *"0123456789ab", "C", "c", None).alias("guest_type"), choose(key, "3.5%", None).alias("benchmark_show"),
        choose(size, "0", "3", "99", "x").alias("prd_invest_type"), choose(key, "0", "90", None).alias("lock_days"), choose(size, "2", "9").alias("term_enjoy_type"),
        F.col("p_retailprice").alias("pfirst_amt"), size.alias("prd_time_limit"),
        *[choose(size + i, "0.0", "0.0325", None, "1e-25", "123456789012345678901234").alias(name) for i, name in enumerate(_RATES)])
    return rows.unionByName(rows)


def _sql_choose(number: str, *values: str | None) -> str:
    listed = ", ".join("NULL" if v is None else "'" + v + "'" for v in values)
    return f"([{listed}])[{number} % {len(values)} + 1]"


_RATE_TEXTS = ("", "3.25%", "", "", "1.235E+25%")
_SQL_CARD = {
    "kehuhao": "NULL", "kehuxingming": "NULL", "phoneNumber": "NULL", "scene_id": "'S1106'", "msgmodel_id": "CASE WHEN s % 3 = 0 THEN 'chrem_1301' ELSE '' END",
    "prd_code": "pr.id", "ta_code": "brand", "prd_name": "name", "prd_nametwo": "''", "nav": _sql_choose("s", "产品净值1.5", "产品净值0.9876", "", "", "产品净值12"),
    "nav_date": _sql_choose("s", "截至2024/01/05", "", ""), "ipo_start_date": "''", "ipo_end_date": "''", "estab_date": "''", "income_date": "''",
    "end_date": _sql_choose("k", "2024/02/29", ""), "risk_level": _sql_choose("s", "风险等级极低风险", "风险等级低风险", "", ""), "reserveone": _sql_choose("s", "1301", "x", ""),
    "ta_name": "''", "ta_shortname": "''", "benchmark": _sql_choose("s", "业绩比较基准：1.0%-2.5%", "", "", "业绩比较基准：0.03"), "modelcomment_desc": "''",
    "nav_ratio": _sql_choose("k", "上一投资周期年化收益率1.23%、", "", ""), "cycle_days": "''", "min_hold_days": "''", "term_enjoy_type": _sql_choose("s", "每月", ""),
    "guest_type": "CASE WHEN s % 15 IN (12, 13) THEN " + _sql_choose("k", "3.5%", "") + " ELSE " + _sql_choose("s", *[
        "成立以来年化收益率", "上日年化收益率", "近七日年化收益率", "近14日年化收益率", "近一月年化收益率", "近两月年化收益率", "近三月年化收益率", "近半年年化收益率",
        "上一年年化收益率", "上期年化收益率", "二年化收益率", "三年化收益率", "", "", ""]) + " END",
    **{{"rate1": "rateone"}.get(name, name): _sql_choose(f"(s + {i})", *_RATE_TEXTS) for i, name in enumerate(_RATES)},
    "benchmark_show": _sql_choose("k", "3.5%", ""),
    "tb_reco_one": "CASE WHEN s % 15 < 12 THEN " + _sql_choose("(s + s % 15)", *_RATE_TEXTS) + " ELSE '' END",
    "tb_reco_two": _sql_choose("s", "精选固收", "精选混合", "精选其他", ""), "tb_reco_three": _sql_choose("k", "", "90", ""),
    **{f"tb_reco_{n}": "NULL" for n in ("four", "five", "six", "seven", "eight", "nine", "ten")},
}
_SQL_PRODUCTS = """
w AS (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS id FROM lineitem WHERE l_quantity > 45 UNION SELECT 'DEFAULT1'),
pr AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_partkey AS k, p_size AS s, p_name AS name, p_brand AS brand, p_retailprice AS price FROM part)
"""


def _wanted_info(t: Tables) -> DataFrame:
    wanted = t.lineitem.where(F.col("l_quantity") > 45).select(F.col("l_partkey").alias("prod_id"))
    return matching.product_info(wanted, "DEFAULT1", _catalogue(t))


@query(f"""
WITH {_SQL_PRODUCTS}
SELECT w.id AS prod_id, {", ".join(f"CASE WHEN pr.id IS NULL THEN {text} ELSE {value} END AS {name}" for name, value in _SQL_CARD.items()
        for text in ["'DEFAULT1'" if name == "prd_code" else "'S1106'" if name == "scene_id" else "NULL" if value == "NULL" else "''"])},
  price AS pfirst_amt, s::DOUBLE AS prd_time_limit, TRY_CAST({_sql_choose("s", "1", "2", "9", None)} AS INTEGER) AS risk_number, {_sql_choose("s", "0", "3", "99", "x")} AS invest,
  CAST(COALESCE({_sql_choose("s", "2.5", "0", "0", "3")}, '0') AS FLOAT) AS benchmark_f
FROM w LEFT JOIN pr ON w.id = pr.id
""")
def product_card(t: Tables) -> DataFrame:
    info = _wanted_info(t)
    rows = cards.product_cards(info, "s1106").join(info.select("prod_id", "benchmark_f"), "prod_id")
    shown = [F.col(f"output_info.{name}").alias(name) for name in cards.CARD_FIELDS]
    return rows.select("prod_id", *shown, "filter_info.pfirst_amt", "filter_info.prd_time_limit", F.col("filter_info.risk_level").alias("risk_number"),
                       F.col("filter_info.prd_invest_type").alias("invest"), "benchmark_f")


@query(f"""
WITH {_SQL_PRODUCTS}
SELECT 'tr|s1106|prod_info|' || pr.id AS key, 3600 AS ttl,
  json_object({", ".join(f"'{name}', {value}" for name, value in _SQL_CARD.items())})::VARCHAR AS card
FROM w JOIN pr ON w.id = pr.id
""")
def keyvalue_products(t: Tables) -> DataFrame:
    rows = cards.product_entries(_wanted_info(t), "S1106", 3600).where(~F.endswith("key", F.lit("DEFAULT1")))
    return rows.select("key", "ttl", F.regexp_extract("value", r'^\{"output_info":(\{.*\}),"filter_info":\{.*\}\}$', 1).alias("card"))
