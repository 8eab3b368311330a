"""Samples, features, models and metrics."""

from __future__ import annotations

from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.dates import days_since, ymd
from ..operators.filters import fill_features, union_all
from ..operators.sampling import sample_rows
from ..plans import features, metrics, models, samples, scoring
from ..session import scratch_path
from .campaign import CREDIT, DEBIT, SQL_STANDINS, app_users
from .registry import Tables, registrar
from .relational import CENTS, sql_hash

QUERIES: dict = {}
ORACLES: dict = {}
query = registrar(QUERIES, ORACLES)

# --- single feature stages ---------------------------------------------------------------------


@query("""
SELECT c_custkey, CAST(CASE WHEN c_acctbal < 0 THEN 0 WHEN c_acctbal < 1000 THEN 1 WHEN c_acctbal < 5000 THEN 2 ELSE 3 END AS DOUBLE) AS bucket FROM customer
""")
def feature_buckets(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", features.bucket_of(F.col("c_acctbal"), [0.0, 1000.0, 5000.0]).alias("bucket"))


@query("SELECT o_orderkey, round(ln(1 + CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_totalprice END), 6) AS logged FROM orders")
def feature_log(t: Tables) -> DataFrame:
    price = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return t.orders.select("o_orderkey", F.round(S.safe_log1p(price), 6).alias("logged"))


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN 0 ELSE CAST(date_diff('day', TIMESTAMP '2001-08-01', o_orderdate) AS INTEGER) END AS days FROM orders
""")
def feature_date_difference(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    day = F.when(status == "F", ymd("o_orderdate")).when(status == "O", "19000101")
    return t.orders.select("o_orderkey", days_since(day, F.lit("2001-08-01").cast("date")).alias("days"))


@query("""
WITH f AS (SELECT CASE WHEN o_orderstatus = 'P' THEN 'NA' ELSE o_orderpriority END AS v, COUNT(*) AS n FROM orders GROUP BY 1),
i AS (SELECT v, ROW_NUMBER() OVER (ORDER BY n DESC, v) - 1 AS idx FROM f)
SELECT o_orderkey, CAST(idx AS DOUBLE) AS idx FROM orders JOIN i ON v = CASE WHEN o_orderstatus = 'P' THEN 'NA' ELSE o_orderpriority END
""")
def feature_index(t: Tables) -> DataFrame:
    text = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).otherwise(F.lit(""))
    rows = fill_features(t.orders.select("o_orderkey", text.alias("v")), [], ["v"])
    return StringIndexer(inputCol="v", outputCol="idx", handleInvalid="keep").fit(rows).transform(rows).select("o_orderkey", "idx")


@query("SELECT c_custkey, round(c_acctbal / (SELECT stddev_samp(c_acctbal) FROM customer), 6) AS scaled FROM customer")
def feature_scale(t: Tables) -> DataFrame:
    rows = VectorAssembler(inputCols=["c_acctbal"], outputCol="v").transform(t.customer.select("c_custkey", "c_acctbal"))
    scaled = StandardScaler(inputCol="v", outputCol="s", withStd=True, withMean=False).fit(rows).transform(rows)
    return scaled.select("c_custkey", F.round(F.get(vector_to_array("s"), 0), 6).alias("scaled"))


# --- whole pipelines ---------------------------------------------------------------------------

_MAP = features.FeatureMap(
    plain=("n_orders",), index=("c_mktsegment",), onehot=("top_priority",), scale=("spent",), quantile=("c_acctbal",),
    bucket={"n_events": [1.0, 20.0, 60.0]}, log=("biggest",), days=("last_order",))


def wide_customers(t: Tables) -> DataFrame:
    orders = t.orders.groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.count("*").alias("n_orders"), F.sum(S.money(F.col("o_totalprice"))).cast("double").alias("spent"),
        F.max("o_totalprice").alias("biggest"), F.max(ymd("o_orderdate")).alias("last_order"), F.min("o_orderpriority").alias("top_priority"))
    events = t.events.groupBy("user_id").agg(F.count("*").alias("n_events"))
    people = t.customer.select(F.col("c_custkey").alias("user_id"), "c_mktsegment", "c_acctbal")
    return people.join(orders, "user_id", "left").join(events, "user_id", "left")


@query()
def feature_vectors_fitted(t: Tables) -> DataFrame:
    wide = wide_customers(t)
    return features.transform_features(wide, features.fit_features(wide, _MAP, "20240131"))


_SQL_WIDE = """
o AS (SELECT o_custkey AS user_id, COUNT(*) AS n_orders, SUM(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS spent, MAX(o_totalprice) AS biggest,
  MAX(CAST(o_orderdate AS DATE)) AS last_order, COALESCE(MIN(o_orderpriority), 'NA') AS top_priority FROM orders GROUP BY 1),
e AS (SELECT user_id, COUNT(*) AS n_events FROM events GROUP BY 1),
w AS (SELECT c_custkey AS user_id, c_mktsegment, c_acctbal, COALESCE(n_orders, 0) AS n_orders, COALESCE(spent, 0) AS spent, COALESCE(biggest, 0) AS biggest, last_order,
  COALESCE(top_priority, 'NA') AS top_priority, COALESCE(n_events, 0) AS n_events FROM customer LEFT JOIN o ON c_custkey = o.user_id LEFT JOIN e ON c_custkey = e.user_id),
seg AS (SELECT v, ROW_NUMBER() OVER (ORDER BY n DESC, v) - 1 AS i FROM (SELECT c_mktsegment AS v, COUNT(*) AS n FROM w GROUP BY 1)),
pri AS (SELECT v, ROW_NUMBER() OVER (ORDER BY n DESC, v) AS i FROM (SELECT top_priority AS v, COUNT(*) AS n FROM w GROUP BY 1)),
rk AS (SELECT c_acctbal AS v, ROW_NUMBER() OVER (ORDER BY c_acctbal) AS r, COUNT(*) OVER () AS n FROM w),
lim AS (SELECT DISTINCT v FROM rk, (SELECT unnest(range(1, 10)) AS i) WHERE r = ceil(n * i / 10))
"""


@query(f"""
WITH {_SQL_WIDE}
SELECT user_id, n_orders::DOUBLE AS n_orders, seg.i::DOUBLE AS segment, pri.i AS priority_flag, (SELECT COUNT(*) FROM pri) + 7 AS width,
  round(spent / (SELECT stddev_samp(spent) FROM w), 6) AS scaled,
  (SELECT COUNT(*) FROM lim WHERE lim.v <= w.c_acctbal)::DOUBLE AS tenth, CAST((n_events >= 1)::INT + (n_events >= 20)::INT + (n_events >= 60)::INT AS DOUBLE) AS bucket,
  round(ln(1 + greatest(biggest, 0)), 6) AS logged, COALESCE(date_diff('day', DATE '2024-01-31', last_order), 0)::DOUBLE AS days
FROM w JOIN seg ON seg.v = c_mktsegment JOIN pri ON pri.v = top_priority
""")
def feature_vector_slots(t: Tables) -> DataFrame:
    """Every slot of the fitted vector; flags as the place of the one that is set."""
    vector = F.col(features.FEATURES)
    back = lambda n: F.element_at(vector, -n)
    flags = F.slice(vector, F.lit(3), F.size(vector) - 7)
    return feature_vectors_fitted(t).select(
        "user_id", F.get(vector, 0).alias("n_orders"), F.get(vector, 1).alias("segment"), F.array_position(flags, 1.0).alias("priority_flag"),
        F.size(vector).cast("bigint").alias("width"), F.round(back(5), 6).alias("scaled"), back(4).alias("tenth"), back(3).alias("bucket"), F.round(back(2), 6).alias("logged"), back(1).alias("days"))


@query("SELECT c_custkey AS user_id, TRUE AS same FROM customer")
def feature_vectors_reloaded(t: Tables) -> DataFrame:
    """A saved and reloaded version makes the vectors of the fitted one."""
    wide = wide_customers(t)
    path = scratch_path(t.spark, "features")
    fitted = features.fit_features(wide, _MAP, "20240131")
    features.save_features(fitted, t.spark, path)
    first = features.transform_features(wide, fitted).withColumnRenamed(features.FEATURES, "first")
    again = features.transform_features(wide, features.load_features(t.spark, path))
    return first.join(again, "user_id").select("user_id", (F.col("first") == F.col(features.FEATURES)).alias("same"))


@query("""
SELECT c_custkey AS user_id, CAST(round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 6) AS DOUBLE) AS total, COALESCE(len(embedding), 0)::INTEGER AS size
FROM customer LEFT JOIN embeddings ON c_custkey = vec_id AND label < 5
""")
def feature_attach_stored(t: Tables) -> DataFrame:
    tag = F.when(F.col("label") < 5, "v1").otherwise("v2")
    stored = t.embeddings.select(F.col("vec_id").alias("user_id"), F.col("embedding").cast("array<double>").alias("features"), tag.alias("tag"))
    users = t.customer.select(F.col("c_custkey").alias("user_id"))
    rows = features.attach_features(users, stored, "v1")
    vector = F.col("user_features")
    total = F.round(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x), 6)
    return rows.select("user_id", total.alias("total"), F.when(vector.isNotNull(), F.size(vector)).otherwise(0).alias("size"))


# --- samples -----------------------------------------------------------------------------------

_MONTHS = ["199801", "199802", "199803"]


def _held(t: Tables, priority: str) -> DataFrame:
    rows = t.orders.where(F.col("o_orderpriority") == priority)
    return rows.select(F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("prod_id"), ymd("o_orderdate").alias("apply_dt"),
                       (F.col("o_orderstatus") == "F").cast("int").cast("string").alias("hold"))


SQL_SAMPLES = f"""
mon AS (SELECT * FROM (VALUES ('199801', '19971231'), ('199802', '19980131'), ('199803', '19980228')) AS v(month, dt)),
hold AS (SELECT o_custkey AS user_id, o_orderkey AS prod_id, strftime(o_orderdate, '%Y%m%d') AS apply_dt, CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '0' END AS hold, o_orderpriority AS kind FROM orders),
base AS (SELECT user_id, month, dt, MIN(apply_dt) AS since, MAX(hold) AS h FROM hold, mon WHERE kind = '1-URGENT' AND apply_dt < month || '01' GROUP BY 1, 2, 3),
had AS (SELECT DISTINCT user_id, month FROM hold, mon WHERE kind = '2-HIGH' AND hold = '1' AND apply_dt < month || '01'),
wanted AS (SELECT DISTINCT user_id, prod_id, apply_dt, substr(apply_dt, 1, 6) AS month FROM hold WHERE kind = '2-HIGH'),
fresh AS (SELECT base.* FROM base ANTI JOIN had ON base.user_id = had.user_id AND base.month = had.month WHERE h = '1' AND user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'HOUSEHOLD')),
pos AS (SELECT DISTINCT fresh.user_id, fresh.month, fresh.dt, apply_dt FROM fresh JOIN wanted ON fresh.user_id = wanted.user_id AND fresh.month = wanted.month),
neg AS (SELECT fresh.* FROM fresh ANTI JOIN wanted ON fresh.user_id = wanted.user_id AND fresh.month = wanted.month WHERE since NOT LIKE '1900%' AND {sql_hash('m4', 'user_id', 'fresh.month')} < 0.2),
smp AS (SELECT user_id, month, '1' AS label, apply_dt AS sample_dt, 'user_v1' AS tag, dt FROM pos
 UNION ALL SELECT user_id, month, '0', month, 'user_v1', dt FROM neg
 UNION ALL SELECT p.user_id, p.month, CAST(w.prod_id AS VARCHAR), w.apply_dt, 'item_v1', p.dt FROM (SELECT DISTINCT user_id, month, dt FROM pos) p JOIN wanted w ON p.user_id = w.user_id AND p.month = w.month)
"""


def month_samples(t: Tables) -> DataFrame:
    mobile = t.customer.where(F.col("c_mktsegment") != "HOUSEHOLD").select(F.col("c_custkey").alias("user_id"))
    return samples.monthly_samples(_held(t, CREDIT), _held(t, DEBIT), mobile, _MONTHS, 0.2, "m4", "user_v1", "item_v1")


@query(f"WITH {SQL_SAMPLES} SELECT user_id, month, label, sample_dt, tag, dt FROM smp")
def sample_monthly(t: Tables) -> DataFrame:
    return month_samples(t)


@query(f"""
WITH {SQL_SAMPLES}, ft AS (SELECT o_custkey AS user_id, dt, COUNT(*) AS n, CAST(SUM({CENTS.format('o_totalprice')}) AS DOUBLE) AS spent FROM orders, mon WHERE strftime(o_orderdate, '%Y%m%d') <= dt GROUP BY 1, 2)
SELECT smp.user_id, smp.dt, label, n::DOUBLE AS f0, spent AS f1 FROM smp JOIN ft ON smp.user_id = ft.user_id AND smp.dt = ft.dt WHERE tag = 'user_v1'
""")
def sample_with_features(t: Tables) -> DataFrame:
    rows = month_samples(t)
    cut = F.explode(F.array(F.lit("19971231"), F.lit("19980131"), F.lit("19980228"))).alias("dt")
    orders = t.orders.select(F.col("o_custkey").alias("user_id"), ymd("o_orderdate").alias("day"), "o_totalprice", cut).where(F.col("day") <= F.col("dt"))
    stored = orders.groupBy("user_id", "dt").agg(F.array(F.count("*").cast("double"), F.sum(S.money(F.col("o_totalprice"))).cast("double")).alias("features"))
    joined = samples.with_features(rows, stored, "user_v1")
    return joined.select("user_id", "dt", "label", F.get("features", 0).alias("f0"), F.get("features", 1).alias("f1"))


@query(f"""
WITH gone AS (SELECT o_custkey AS user_id FROM orders WHERE o_orderpriority = '5-LOW' AND strftime(o_orderdate, '%Y%m') = '199905'
   UNION SELECT o_custkey FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED' AND strftime(o_orderdate, '%Y%m') = '199905' AND o_orderstatus = 'F'),
hx AS (SELECT DISTINCT o_custkey AS user_id FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'O' AND o_orderdate < TIMESTAMP '1999-05-01'),
mt AS (SELECT DISTINCT o_custkey AS user_id FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O' AND o_orderdate < TIMESTAMP '1999-05-01'),
a AS (SELECT user_id, 1 AS label FROM gone UNION ALL SELECT user_id, 0 FROM hx WHERE {sql_hash('m5|hx', 'user_id')} < 0.42 UNION ALL SELECT user_id, 0 FROM mt WHERE {sql_hash('m5|mt', 'user_id')} < 0.28)
SELECT user_id, MAX(label) AS label, '19990501' AS sample_dt, '19990331' AS dt FROM a WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY 1
""")
def sample_churn(t: Tables) -> DataFrame:
    orders = t.orders.select(F.col("o_custkey").alias("user_id"), "o_orderpriority", "o_orderstatus", ymd("o_orderdate").alias("dt"))
    low, other = orders.where(F.col("o_orderpriority") == "5-LOW"), orders.where(F.col("o_orderpriority") == "4-NOT SPECIFIED")
    month = F.startswith(F.col("dt"), F.lit("199905"))
    gone = [low.where(month), other.where(month & (F.col("o_orderstatus") == "F"))]
    stays = (F.col("o_orderstatus") == "O") & (F.col("dt") < "19990501")
    retainable = t.customer.where(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("user_id"))
    return samples.churn_samples(gone, {"hx": (low.where(stays), 0.42), "mt": (other.where(stays), 0.28)}, retainable, "199905", "m5")


@query(f"WITH {SQL_STANDINS} SELECT DISTINCT user_id FROM credit WHERE {sql_hash('eval', 'user_id')} < 0.5 AND user_id IN (SELECT user_id FROM events)")
def sample_population(t: Tables) -> DataFrame:
    credit = _held(t, CREDIT).where(F.col("hold") == "1").select("user_id").distinct()
    return sample_rows(credit.join(app_users(t).distinct(), "user_id", "left_semi"), 0.5, "eval", "user_id")


# --- models ------------------------------------------------------------------------------------


def _vectors(t: Tables) -> DataFrame:
    """Small numeric features per customer and whether a closed urgent order exists."""
    urgent = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")
    orders = t.orders.groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.count("*").cast("double").alias("n"), F.max("o_totalprice").alias("top"), F.max(urgent.cast("int")).alias("label"))
    people = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("b"))
    rows = people.join(orders, "user_id", "left")
    return rows.select("user_id", F.when(F.col("n").isNotNull(), F.array("n", F.col("top") / 1e5, F.col("b") / 1e3)).alias("features"),
                       F.coalesce("label", F.lit(0)).alias("label"))


@query()
def model_propensity_scores(t: Tables) -> DataFrame:
    rows = _vectors(t)
    model = models.fit_propensity(rows.where(F.col("features").isNotNull()), maxIter=5, maxDepth=3)
    return models.score_pool(rows.withColumnRenamed("features", "user_features").select("user_id", "user_features"), model)


@query()
def model_product_scores(t: Tables) -> DataFrame:
    rows = _vectors(t).where(F.col("features").isNotNull())
    last = t.orders.groupBy(F.col("o_custkey").alias("user_id")).agg(F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("prod_id"))
    labels = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2, "4-NOT SPECIFIED": 3, "5-LOW": -1}
    train = models.with_labels(rows.drop("label").join(last, "user_id"), labels)
    model = models.fit_products(train, 5, max_iter=5)
    return models.score(rows.select("user_id", "features"), model).select("user_id", models.PREDICTION, *models.item_columns(range(5)))


@query()
def model_saved_inference(t: Tables) -> DataFrame:
    rows = _vectors(t)
    path = scratch_path(t.spark, "model")
    models.save_model(models.fit_propensity(rows.where(F.col("features").isNotNull()), maxIter=3, maxDepth=2), path, "20240131")
    return models.write_inference(rows, models.load_propensity(path), path + "-scores")


_SQL_TRUE_SCORES = "SELECT c_custkey AS user_id, TRUE AS whole, TRUE AS largest, TRUE AS same FROM customer"


def _score_facts(rows: DataFrame, model, reloaded) -> DataFrame:
    """Per user: probabilities lie in 0 to 1 and add up to 1 (all zero without features), the class is that of
    the largest, and the reloaded model gives the same."""
    values = F.col(models.PROBABILITY)
    total = F.when(F.col("features").isNull(), 0.0).otherwise(1.0)
    whole = F.forall(values, lambda p: p.between(0, 1)) & (F.abs(F.aggregate(values, F.lit(0.0), lambda a, p: a + p) - total) < 1e-9)
    first = models.score(rows.select("user_id", "features"), model)
    again = models.score(rows.select("user_id", "features"), reloaded).select("user_id", values.alias("again"))
    return first.join(again, "user_id").select("user_id", whole.alias("whole"), (F.get(values, F.col(models.PREDICTION)) == F.array_max(values)).alias("largest"),
                                               (values == F.col("again")).alias("same"))


@query(_SQL_TRUE_SCORES)
def model_propensity_facts(t: Tables) -> DataFrame:
    rows = _vectors(t)
    path = scratch_path(t.spark, "model")
    model = models.fit_propensity(rows.where(F.col("features").isNotNull()), maxIter=3, maxDepth=2)
    models.save_model(model, path, "20240131")
    return _score_facts(rows, model, models.load_propensity(path, "20240131"))


@query(_SQL_TRUE_SCORES)
def model_product_facts(t: Tables) -> DataFrame:
    rows = _vectors(t)
    path = scratch_path(t.spark, "model")
    model = models.fit_products(rows.where(F.col("features").isNotNull()), 3, max_iter=3)
    models.save_model(model, path, "20240131")
    return _score_facts(rows, model, models.load_products(path))


# A declared model of three trees and one of three classes: their texts are run by both engines.
_TREES = scoring.TreeScore((
    (1.0, scoring.Split(0, 3.5, scoring.Split(1, 0.0, -0.4, 0.1), scoring.Split(2, 12.0, 0.35, 0.8))),
    (0.1, scoring.Split(2, 0.0, scoring.Split(0, 0.0, -1.0, 0.25, values=(0.0, 1.0, 4.0)), 0.5)),
    (0.1, scoring.Split(1, 7.25, -0.125, 1e-05))))
_CLASSES = scoring.LinearScore(((0.2, -0.01, 0.0), (-0.3, 0.0, 0.02), (0.0, 0.05, -0.04)), (0.1, 1.0, -0.5))
_SQL_POOL = """
f AS (SELECT c_custkey AS user_id, n::DOUBLE AS f0, c_acctbal / 1000 AS f1, c_nationkey::DOUBLE AS f2
      FROM customer LEFT JOIN (SELECT o_custkey, COUNT(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON c_custkey = o_custkey)
"""
_ZEROED = [f"coalesce({c}, CAST(0 AS DOUBLE))" for c in ("f0", "f1", "f2")]


def _plain_features(t: Tables) -> DataFrame:
    orders = t.orders.where(F.col("o_orderstatus") == "F").groupBy(F.col("o_custkey").alias("user_id")).agg(F.count("*").cast("double").alias("f0"))
    people = t.customer.select(F.col("c_custkey").alias("user_id"), (F.col("c_acctbal") / 1000).alias("f1"), F.col("c_nationkey").cast("double").alias("f2"))
    return people.join(orders, "user_id", "left")


@query(f"WITH {_SQL_POOL} SELECT user_id, round({_TREES.probabilities(_ZEROED)[1]}, 9) AS score FROM f")
def model_pool_by_rules(t: Tables) -> DataFrame:
    scored = scoring.score_pool_by_rules(_plain_features(t), _TREES, ["f0", "f1", "f2"])
    return scored.select("user_id", F.round("score", 9).alias("score"))


@query(f"WITH {_SQL_POOL} SELECT user_id, " + ", ".join(f"CASE WHEN f0 IS NULL THEN 0.0 ELSE round({p}, 9) END AS p{i}" for i, p in enumerate(_CLASSES.probabilities(["f0", "f1", "f2"]))) + " FROM f")
def model_classes_by_rules(t: Tables) -> DataFrame:
    rows = _plain_features(t).select("user_id", F.when(F.col("f0").isNotNull(), F.array("f0", "f1", "f2")).alias("features"))
    return rows.select("user_id", *[F.round(p, 9).alias(f"p{i}") for i, p in enumerate(scoring.score_columns(_CLASSES, "features", 3))])


@query("SELECT c_custkey AS user_id, TRUE AS trees, TRUE AS classes FROM customer")
def model_saved_rules(t: Tables) -> DataFrame:
    """Saved models written out as SQL score every user as the models themselves do."""
    rows = _vectors(t)
    path, known = scratch_path(t.spark, "rules"), rows.where(F.col("features").isNotNull())
    models.save_model(models.fit_propensity(known, maxIter=4, maxDepth=3), f"{path}/trees", "20240131")
    models.save_model(models.fit_products(known, 3, max_iter=4), f"{path}/classes", "20240131")
    for name, model in (("trees", models.load_propensity(f"{path}/trees")), ("classes", models.load_products(f"{path}/classes"))):
        own = models.score(rows, model)
        ruled = F.array(*scoring.score_columns(scoring.from_model(model), "features", model.numFeatures))
        gaps = F.zip_with(models.PROBABILITY, ruled, lambda a, b: F.abs(a - b))
        rows = own.withColumn(name, F.array_max(gaps) < 1e-9).drop(models.PROBABILITY, models.PREDICTION)
    return rows.select("user_id", "trees", "classes")


# --- metrics -----------------------------------------------------------------------------------

_SQL_SCORED = """
s AS (SELECT quality AS label, n_chars // 100 AS score, CASE WHEN n_chars > 600 THEN 1 ELSE 0 END AS prediction FROM labels JOIN documents ON labels.doc_id = documents.doc_id)
"""


def _scored(t: Tables) -> DataFrame:
    n = F.col("n_chars")
    rows = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    return rows.select(F.col("quality").alias("label"), F.floor(n / 100).alias("score"), (n > 600).cast("int").alias("prediction"))


@query(f"""
WITH {_SQL_SCORED}, c AS (SELECT SUM(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END)::BIGINT AS tp, SUM(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END)::BIGINT AS fp,
  SUM(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END)::BIGINT AS fn, SUM(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END)::BIGINT AS tn FROM s)
SELECT tp, fp, fn, tn, (tp + tn)::DOUBLE / (tp + fp + fn + tn) AS accuracy, tp::DOUBLE / (tp + fp) AS precision, tp::DOUBLE / (tp + fn) AS recall, (2 * tp)::DOUBLE / (2 * tp + fp + fn) AS f1 FROM c
""")
def metric_binary(t: Tables) -> DataFrame:
    return metrics.binary_metrics(_scored(t))


@query(f"""
WITH {_SQL_SCORED}, p AS (SELECT COUNT(*) AS n, SUM(CASE WHEN a.score > b.score THEN 2 WHEN a.score = b.score THEN 1 ELSE 0 END) AS w FROM s a, s b WHERE a.label = 1 AND b.label = 0)
SELECT (SELECT COUNT(*) FROM s WHERE label = 1) AS positives, (SELECT COUNT(*) FROM s WHERE label = 0) AS negatives, w / 2.0::DOUBLE / n AS auc FROM p
""")
def metric_auc(t: Tables) -> DataFrame:
    return metrics.auc(_scored(t).withColumnRenamed("label", "positive"))


_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
_SQL_CLASSES = """
cl AS (SELECT type, ROW_NUMBER() OVER (ORDER BY type) - 1 AS class FROM (SELECT DISTINCT p_type AS type FROM part)),
rows AS (SELECT p_partkey, class AS y FROM part JOIN cl ON p_type = type),
sc AS (SELECT p_partkey, y, class, ((p_partkey * (class + 3) + class * 7) % 101) / 101.0::DOUBLE AS score FROM rows, cl)
"""


def _class_scores(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    label = case_of_types(F.col("p_type"))
    shares = [F.pmod(key * (c + 3) + c * 7, F.lit(101)) / 101.0 for c in range(len(_TYPES))]
    return t.part.select(label.alias("label"), F.array(*shares).alias("probability"))


def case_of_types(value):
    return S.lookup(value, {name: i for i, name in enumerate(_TYPES)})


_SQL_PAIRS = """
SELECT {keys}, SUM(pos)::BIGINT AS positives, SUM(1 - pos)::BIGINT AS negatives, CAST(SUM(pos * (low + (n + 1) / 2.0::DOUBLE)) - SUM(pos)::DOUBLE * (SUM(pos) + 1) / 2 AS DOUBLE) / (SUM(pos)::DOUBLE * SUM(1 - pos)) AS auc
FROM (SELECT *, COUNT(*) OVER (PARTITION BY {keys}, score) AS n, RANK() OVER (PARTITION BY {keys} ORDER BY score) - 1 AS low FROM {source}) GROUP BY {keys}
"""


@query(f"""WITH {_SQL_CLASSES}, o AS (SELECT class::INTEGER AS class, score, CASE WHEN y = class THEN 1 ELSE 0 END AS pos FROM sc) {_SQL_PAIRS.format(keys='class', source='o')}""")
def metric_one_vs_rest(t: Tables) -> DataFrame:
    return metrics.one_vs_rest_auc(_class_scores(t))


@query(f"""
WITH {_SQL_CLASSES}, o AS (SELECT a.class::INTEGER AS class, cl.class::INTEGER AS other, score, CASE WHEN y = a.class THEN 1 ELSE 0 END AS pos FROM sc a JOIN cl ON cl.class <> a.class WHERE y = a.class OR y = cl.class)
{_SQL_PAIRS.format(keys='class, other', source='o')}
""")
def metric_one_vs_one(t: Tables) -> DataFrame:
    return metrics.one_vs_one_auc(_class_scores(t), len(_TYPES))


@query(f"""
WITH {_SQL_CLASSES}, w AS (SELECT y - 1 AS label, list(score ORDER BY class) AS probability FROM sc GROUP BY p_partkey, y)
SELECT label::INTEGER AS label, count(*) AS n, sum(list_sum(probability)) > 0 AS scored FROM w GROUP BY 1
UNION ALL SELECT c::INTEGER, 1, true FROM (SELECT unnest(range(0, 7)) AS c) WHERE c NOT IN (SELECT label FROM w)
""")
def metric_padded_classes(t: Tables) -> DataFrame:
    """Labels from -1 on, of which classes 5 and 6 have no sample."""
    rows = _class_scores(t).withColumn("label", F.col("label") - 1)
    total = F.aggregate("probability", F.lit(0.0), lambda a, x: a + x)
    return metrics.with_class_rows(rows, 7).groupBy("label").agg(F.count("*").alias("n"), (F.sum(total) > 0).alias("scored"))


@query()
def metric_model_evaluation(t: Tables) -> DataFrame:
    rows = _vectors(t).where(F.col("features").isNotNull())
    model = models.fit_propensity(sample_rows(rows, 0.7, "train", "user_id"), maxIter=3, maxDepth=2)
    held_out = rows.where(S.unit_hash("train", "user_id") >= 0.7)
    scored = models.score(held_out, model)
    area = metrics.auc(scored.select(F.get("probability", 1).alias("score"), F.col("label").alias("positive")))
    counts = metrics.binary_metrics(scored)
    return union_all([
        counts.select(F.explode(F.create_map(*[x for c in ("accuracy", "precision", "recall", "f1") for x in (F.lit(c), F.col(c))])).alias("metric", "value")),
        area.select(F.explode(F.create_map(F.lit("auc"), F.col("auc"))).alias("metric", "value")),
    ])
