"""Sinks and sources: what is written must read back as the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.dates import month_of, ymd
from ..operators.dimensions import rows_to_frame
from ..session import scratch_path
from ..sources import keyvalue, partitions, tables, textfiles
from .registry import Tables, registrar

QUERIES: dict = {}
ORACLES: dict = {}
query = registrar(QUERIES, ORACLES)


@query("""
SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS c_nationkey, c_mktsegment FROM customer WHERE c_acctbal >= 0
""")
def text_source_drops_bad_rows(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "delimited")
    nation = F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey").cast("string")).otherwise(F.lit("n/a"))
    rows = t.customer.select(F.col("c_custkey").cast("string"), nation.alias("c_nationkey"), "c_mktsegment")
    rows.write.option("header", True).option("sep", textfiles.FIELD_SEPARATOR).csv(path)
    return textfiles.read_delimited(t.spark, path, "c_custkey bigint, c_nationkey int, c_mktsegment string")


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def parquet_round_trip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "parquet")
    t.part.write.parquet(path)
    return t.spark.read.parquet(path)


@query("""
SELECT o_orderkey, o_custkey, '20240101' AS dt, 'credit' AS dag_id FROM orders WHERE o_orderpriority = '1-URGENT'
UNION ALL SELECT o_orderkey, o_custkey, '20240101', 'credit' FROM orders WHERE o_orderpriority = '3-MEDIUM'
UNION ALL SELECT o_orderkey, o_custkey, '20240102', 'credit' FROM orders WHERE o_orderpriority = '2-HIGH'
""")
def static_partition_write(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "static")
    spec = tables.TableSpec.parse("packages", "o_orderkey bigint, o_custkey bigint", "dt", "dag_id")

    def put(priority: str, dt: str, overwrite: bool = True) -> None:
        rows = t.orders.where(F.col("o_orderpriority") == priority).withColumn("o_custkey", F.col("o_custkey").cast("string"))
        partitions.write_declared(rows, path, spec, overwrite, dt=dt, dag_id="credit")

    put("5-LOW", "20240101")
    put("2-HIGH", "20240102")
    put("1-URGENT", "20240101")
    put("3-MEDIUM", "20240101", overwrite=False)
    return t.spark.read.schema("o_orderkey bigint, o_custkey bigint, dt string, dag_id string").parquet(path)


@query("""
SELECT o_orderkey, o_totalprice, '1997' AS dt, CASE WHEN o_orderpriority = '1-URGENT' THEN 'first' ELSE 'second' END AS tag
FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
""")
def dynamic_partition_write(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "dynamic")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    rows = t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select(
        "o_orderkey", "o_totalprice", "o_orderstatus", F.lit("1997").alias("dt"), F.when(urgent, "first").otherwise("second").alias("tag"))
    for status in ("O", "F"):
        kept = rows.where(F.col("o_orderstatus") == status).drop("o_orderstatus")
        partitions.write_by_value(kept, path, ["dt", "tag"])
    return t.spark.read.schema("o_orderkey bigint, o_totalprice double, dt string, tag string").parquet(path)


def _table(t: Tables, columns: str, *keys: str) -> tuple[tables.TableSpec, str]:
    name = f"beaconry_{uuid.uuid4().hex}"
    location = scratch_path(t.spark, "table")
    spec = tables.TableSpec.parse(name, columns, *keys)
    tables.create_table(t.spark, spec, location)
    tables.create_table(t.spark, spec, location)  # a second run finds the same columns
    return spec, location


@query("""
SELECT CAST(n_nationkey AS VARCHAR) AS item_id, n_name AS label, 'base' AS dt FROM nation
UNION ALL SELECT 'X1', 'extra', 'more' UNION ALL SELECT 'X2', 'extra', 'more'
""")
def table_insert_rows(t: Tables) -> DataFrame:
    spec, _ = _table(t, "item_id string, label string", "dt")
    base = t.nation.select(F.col("n_nationkey").alias("item_id"), F.col("n_name").alias("label"), F.lit("base").alias("dt"))
    tables.conform(base, spec).write.mode("append").insertInto(spec.name)
    tables.insert_rows(t.spark, spec, [("X1", "extra"), ("X2", "extra")], dt="more")
    return t.spark.table(spec.name)


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS user_id, CAST(c_acctbal AS FLOAT) AS score, c_nationkey::BIGINT AS branch, 'p' AS dt FROM customer
""")
def table_declared_columns(t: Tables) -> DataFrame:
    spec = tables.TableSpec.parse("declared", "user_id string, score float, branch bigint", "dt")
    rows = t.customer.select(F.lit("p").alias("dt"), F.col("c_nationkey").alias("branch"), F.col("c_acctbal").alias("score"),
                             F.col("c_custkey").alias("user_id"), "c_name")
    return tables.conform(rows, spec)


@query("""
SELECT o_orderkey, o_orderpriority AS tag FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW')
""")
def table_drop_partition(t: Tables) -> DataFrame:
    spec, _ = _table(t, "o_orderkey bigint", "tag")
    rows = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("tag"))
    tables.conform(rows, spec).write.mode("overwrite").insertInto(spec.name)
    for tag in ("1-URGENT", "5-LOW", "absent"):
        if partitions.has_partition(t.spark, spec.name, tag=tag):
            partitions.drop_partition(t.spark, spec.name, tag=tag)
    return t.spark.table(spec.name)


@query("""
WITH p AS (SELECT strftime(o_orderdate, '%Y%m%d') AS d, o_orderpriority AS tag FROM orders GROUP BY 1, 2)
SELECT 'dt' AS name, d AS date, COUNT(*) AS num FROM p WHERE d < strftime(DATE '1999-01-01' - 90, '%Y%m%d') GROUP BY 2
""")
def retention_expired(t: Tables) -> DataFrame:
    path = F.concat(F.lit("dt="), ymd("o_orderdate"), F.lit("/tag="), F.col("o_orderpriority"))
    names = t.orders.select(path.alias("partition")).distinct()
    return partitions.expired_partitions(names, F.lit("1999-01-01").cast("date"), 90)


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y%m') || '01' AS dt FROM orders WHERE o_orderdate >= TIMESTAMP '2001-05-01'
""")
def retention_drops_partitions(t: Tables) -> DataFrame:
    spec, _ = _table(t, "o_orderkey bigint", "dt")
    rows = t.orders.select("o_orderkey", F.concat(month_of("o_orderdate"), F.lit("01")).alias("dt"))
    tables.conform(rows, spec).write.mode("overwrite").insertInto(spec.name)
    partitions.retire(t.spark, spec.name, F.lit("2001-08-01").cast("date"), 92)
    return t.spark.table(spec.name)


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer")
def text_export_round_trip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "export")
    textfiles.write_delimited(t.customer.select("c_custkey", "c_name", "c_mktsegment"), path)
    return textfiles.read_with_header(t.spark, path)


@query("""
WITH l AS (SELECT o_orderkey || '@!@' || o_custkey || '@!@' || CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END || '@!@' ||
                  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS value FROM orders)
SELECT 'RESULT_20240101' AS file_name, CAST(SUM(strlen(value) + 1) + strlen('o_orderkey@!@o_custkey@!@status@!@price') + 1 AS BIGINT) AS bytes,
       COUNT(*) AS rows FROM l
""")
def delivery_file(t: Tables) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "P", textfiles.NULL_TOKEN).when(F.col("o_orderstatus") == "O", "O").otherwise("F")
    rows = t.orders.select("o_orderkey", "o_custkey", status.alias("status"), S.money(F.col("o_totalprice")).alias("price"))
    path = scratch_path(t.spark, "delivery")
    return textfiles.write_delivery(rows, t.spark, path, "RESULT_20240101", ["o_orderkey", "o_custkey", "status", "price"])


@query("""
WITH c AS (SELECT DISTINCT o_custkey, l_partkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
     r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY l_partkey) AS rn FROM c),
     g AS (SELECT o_custkey, '["' || string_agg(CAST(l_partkey AS VARCHAR), '","' ORDER BY rn) || '"]' AS prods FROM r GROUP BY 1)
SELECT 's1106|cust|' || c_custkey AS key, '{"prod_list":' || COALESCE(prods, 'null') || ',"cust_name":' ||
       CASE WHEN c_acctbal < 0 THEN 'null' ELSE '"' || c_name || '"' END || '}' AS value, 86400 AS ttl
FROM customer LEFT JOIN g ON c_custkey = o_custkey
""")
def keyvalue_rows(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("part"))
    bought = lines.join(t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey")), "o_orderkey").select("c_custkey", "part").distinct()
    lists = bought.groupBy("c_custkey").agg(F.sort_array(F.collect_list("part")).alias("prods"))
    rows = t.customer.join(lists, "c_custkey", "left").select(
        "c_custkey", F.col("prods").cast("array<string>").alias("prod_list"), F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("cust_name"))
    return keyvalue.kv_rows(rows, "s1106|cust", "c_custkey", ["prod_list", "cust_name"], 86400)


@query("""
WITH l AS (SELECT o_custkey, o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'F' THEN 'v2' ELSE 'v1' END AS version FROM orders)
SELECT o_custkey, o_orderkey, o_totalprice, version FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY version DESC, o_orderkey DESC) AS rn FROM l) WHERE rn = 1
""")
def append_log_latest(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "log")
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")
    tables.append_version(rows.where(F.col("o_orderstatus") != "F").drop("o_orderstatus"), path, "v1")
    tables.append_version(rows.where(F.col("o_orderstatus") == "F").drop("o_orderstatus"), path, "v2")
    return tables.latest_versions(t.spark.read.parquet(path), "o_custkey", ["version", "o_orderkey"])


_CHANNELS = [
    {"channel_id": "view", "banner_id": "B1", "num_items": 2},
    {"channel_id": "click", "banner_id": "", "num_items": 1},
]


@query("""
WITH c AS (SELECT * FROM (VALUES ('view', 'B1', 2), ('click', '', 1)) AS v(channel_id, banner_id, num_items))
SELECT channel_id, banner_id, num_items, COUNT(*) AS n FROM events JOIN c ON event_type = channel_id GROUP BY 1, 2, 3
""")
def config_rows_joined(t: Tables) -> DataFrame:
    config = rows_to_frame(t.spark, _CHANNELS, "channel_id string, banner_id string, num_items int")
    counts = t.events.groupBy(F.col("event_type").alias("channel_id")).agg(F.count("*").alias("n"))
    return config.join(counts, "channel_id")
