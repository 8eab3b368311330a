from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from beaconry.operators.dimensions import rows_to_frame
from beaconry.plans import calendar, features, groups, matching, metrics, models, package, push, reports


def plan(spark, day, max_push, delay=2):
    df = spark.createDataFrame([(date.fromisoformat(day), max_push)], "batch date, max_push int")
    return calendar.push_plan(df, "batch", "max_push", delay).first()


def test_push_plan_periods(spark):
    first, last, second = plan(spark, "2023-03-30", 2), plan(spark, "2023-04-13", 2), plan(spark, "2023-04-20", 2)
    assert (first["plan_push"], first["start_dt"], first["end_dt"]) == (1, "20230330", "20230412")
    assert (last["plan_push"], last["start_dt"], last["end_dt"]) == (2, "20230413", "20230428")
    assert second["days_remain"] == 9


def test_push_plan_daily(spark):
    row = plan(spark, "2023-04-13", 30)
    assert (row["plan_push"], row["month_push"], row["start_dt"], row["days_remain"]) == (15, 30, "20230413", 1)


def test_every_day_has_one_period(spark):
    days = [(date(2024, 1, 30) + timedelta(days=i),) for i in range(29)]
    df = spark.createDataFrame(days, "batch date").withColumn("max_push", F.explode(F.array(*[F.lit(n) for n in (1, 3, 7, 29)])))
    for row in calendar.push_plan(df, "batch", "max_push", 2).collect():
        assert row["start_dt"] <= row["batch"].strftime("%Y%m%d") <= row["end_dt"]
        assert 1 <= row["plan_push"] <= row["max_push"]


def test_sample_months(spark):
    rows = calendar.sample_months(spark.createDataFrame([(date(2023, 5, 17),)], "d date"), "d", 3, 1).collect()
    months = {r["month"]: (r["role"], r["feature_dt"], r["early_feature_dt"]) for r in rows}
    assert months["202304"] == ("eval", "20230331", "20230228")
    assert [m for m, v in sorted(months.items()) if v[0] == "train"] == ["202301", "202302", "202303"]


def test_group_weights():
    wanted = {"exp": groups.GroupSize(80), "exp1": groups.GroupSize(10), "ctl": groups.GroupSize(20, True), "noop": groups.GroupSize(20, True)}
    weights = dict(groups.group_weights([wanted, {"exp": groups.GroupSize(70)}], 10_000))
    assert weights["ctl"] == pytest.approx(22)
    assert weights["exp"] == pytest.approx(80 / 90 * (10_000 - 44))
    assert dict(groups.group_weights([wanted], 50))["exp"] == 80


def test_groups_are_sticky(spark):
    today = spark.createDataFrame([(f"{i:03d}", (300 - i) / 300) for i in range(300)], "user_id string, score double")
    kinds = lambda i: "exp" if i < 60 else "ctl" if i < 80 else "exp1"
    yesterday = spark.createDataFrame([(f"{i:03d}", kinds(i), i / 300) for i in range(100)], "user_id string, user_type string, score double")
    weights = [("exp", 0.8), ("ctl", 0.1), ("exp1", 0.1)]
    rows = {int(r["user_id"]): r for r in groups.assign_groups(today, yesterday, weights, "s").collect()}
    assert len(rows) == 300
    assert all(rows[i]["user_type"] == kinds(i) for i in range(100))
    assert all(rows[i]["score"] == i / 300 for i in range(60, 80))
    assert all(rows[i]["score"] == (300 - i) / 300 for i in range(60))
    new = [rows[i]["user_type"] for i in range(100, 300)]
    assert 135 <= new.count("exp") <= 180
    assert groups.must_refresh(yesterday, 4, 5, []) and groups.must_refresh(yesterday, 3, 5, [5])
    assert not groups.must_refresh(yesterday, 3, 5, [6])


SLOT = dict(channel_id="T", banner_id="", max_push=4, plan_push=1, days_remain=3, blocked_from="20230103", daily=False)


def history(spark, rows):
    return spark.createDataFrame(rows, "user_id string, channel_id string, banner_id string, rank int, send int, dt string")


def test_users_with_a_push_under_way_wait(spark):
    pool = spark.createDataFrame([("1", "exp", 0.9), ("2", "exp", 0.8), ("3", "noop", 0.7)], "user_id string, user_type string, score double")
    past = history(spark, [("1", "T", None, 0, 1, "20230104"), ("1", "T", None, 1, 1, "20230104")])
    channels = [push.ChannelState(**SLOT, limits={"exp": 10})]
    state = push.candidate_state(pool, channels, past, past, "20230101", "20230105")
    rows = {r["user_id"]: r for r in state.collect()}
    assert set(rows) == {"1", "2"}
    assert (rows["1"]["try_push"], rows["1"]["actual_push"]) == (1, 1)
    assert (rows["2"]["try_push"], rows["2"]["actual_push"]) == (0, 0)
    tags = {(r["user_id"], r["tag"]) for r in push.daily_selection(state, channels, past, "20230105").collect()}
    assert tags == {("1", "all"), ("2", "all"), ("2", "filtered"), ("2", "later")}


def test_seven_day_campaign_pushes_everyone_once(spark):
    """70 users, one push in 7 days: each day a seventh of the open users is ready."""
    pool = spark.createDataFrame([(f"{i:02d}", "exp", i / 70) for i in range(70)], "user_id string, user_type string, score double")
    past, pushed = [], set()
    for day in range(7):
        channels = [push.ChannelState(**{**SLOT, "max_push": 1, "days_remain": 7 - day, "blocked_from": "20230101"}, limits={"exp": 100})]
        log, end = history(spark, past), f"2023010{day}"
        state = push.candidate_state(pool, channels, log, log, "20230101", end)
        ready = {r["user_id"] for r in push.daily_selection(state, channels, log, end).where("tag = 'ready'").collect()}
        assert len(ready) == 10 and not ready & pushed
        pushed |= ready
        past += [(u, "T", "", 0, 1, f"2023010{day + 1}") for u in ready]
    assert len(pushed) == 70


def test_no_repeat_meets_missing_banners(spark):
    items = spark.createDataFrame([("u", "exp", "T", "", "i1", 0.5, 0), ("u", "exp", "T", "", "i2", 0.4, 1)],
                                  "user_id string, user_type string, channel_id string, banner_id string, item_id string, score double, rank int")
    past = spark.createDataFrame([("u", "i1", "T", None, "20230102")], "user_id string, item_id string, channel_id string, banner_id string, dt string")
    once = package.crowd_package(items, past, [package.Slot("T", "", 2, False)], "20230101", "20230103", {"scene_id": "s"})
    assert [(r["item_id"], r["scene_id"]) for r in once.collect()] == [("i2", "s")]
    again = package.crowd_package(items, past, [package.Slot("T", "", 1, True)], "20230101", "20230103")
    assert [r["item_id"] for r in again.collect()] == ["i1"]
    assert package.forced_users(spark, ["x"], [package.Slot("T"), package.Slot("T", "b")]).count() == 2


def test_message_report_bound_is_a_choice(spark):
    feedback = spark.createDataFrame([("u", "exp", "20230102", 1, 0), ("v", "exp", "20230109", 1, 1), ("w", "noop", "20230102", 1, 0)],
                                     "user_id string, user_type string, dt string, send int, click int")
    days = spark.createDataFrame([("20230102", 1), ("20230109", 1), ("20230103", 0)], "dt string, do_push int")
    applied = spark.createDataFrame([("u", "20230105")], "user_id string, apply_dt string")
    args = (feedback, days, applied, {"exp": 7}, "20230101", "20230105")
    assert [(r["user_id"], r["convert"], r["operate"]) for r in reports.message_report(*args).collect()] == [("u", 1, 7)]
    assert {r["user_id"] for r in reports.message_report(*args, bounded=False).collect()} == {"u", "v"}


def products(spark, rows):
    names = ["prod_id", "list_type", "is_new_client_prd", "diamond_card_flag", "salary_card_flags", "pension_funds_flag",
             "service_level", "ipo_type", "risk_level", "prd_time_limit", "benchmark"]
    schema = ", ".join(f"{n} {'double' if n == 'benchmark' else 'int' if n == 'prd_time_limit' else 'string'}" for n in names)
    defaults = dict(zip(names, ["", "0", "0", "0", "0", "0", "0", None, "1", 1, 1.0]))
    return rows_to_frame(spark, [{**defaults, **r} for r in rows], schema)


def customers(spark, rows):
    names = ["cust_id", "is_new_client", "salary_ind", "pension_ind", "service_level_cust", "auth_type", "risk_fin_valid_ind", "risk_level_cust"]
    defaults = dict(zip(names, ["", "0", "0", "0", "0", "0", "0", "0"]))
    return rows_to_frame(spark, [{**defaults, **r} for r in rows], ", ".join(f"{n} string" for n in names))


def test_rule_lists_numbers_not_text(spark):
    """Level 10 is above level 9, whatever the texts say."""
    prods = products(spark, [{"prod_id": "p9", "service_level": "9"}, {"prod_id": "p10", "service_level": "10"}])
    custs = customers(spark, [{"cust_id": "a", "service_level_cust": "9"}, {"cust_id": "b", "service_level_cust": "10"}, {"cust_id": "c"}])
    none = spark.createDataFrame([], "cust_id string, prod_id string")
    lists = {r["cust_id"]: r["prod_list"] for r in matching.rule_lists(custs, prods, none, 5).collect()}
    assert lists == {"a": ["p9"], "b": ["p10", "p9"], "c": None}


def test_rule_lists_risk_private_and_whitelist(spark):
    prods = products(spark, [
        {"prod_id": "risky", "risk_level": "5", "benchmark": 9.0}, {"prod_id": "private", "ipo_type": "2", "benchmark": 8.0},
        {"prod_id": "listed", "list_type": "1", "benchmark": 7.0}, {"prod_id": "plain", "benchmark": 1.0}, {"prod_id": "unrated", "risk_level": None}])
    custs = customers(spark, [
        {"cust_id": "untested"}, {"cust_id": "careful", "risk_fin_valid_ind": "1", "risk_level_cust": "2"},
        {"cust_id": "pro", "auth_type": "1", "risk_fin_valid_ind": "1", "risk_level_cust": "5"}])
    listed = spark.createDataFrame([("careful", "listed")], "cust_id string, prod_id string")
    lists = {r["cust_id"]: r["prod_list"] for r in matching.rule_lists(custs, prods, listed, 3).collect()}
    assert lists == {"untested": ["risky", "plain", "unrated"], "careful": ["listed", "plain"], "pro": ["risky", "private", "plain"]}


def test_top_products_by_rate_skip_unknown(spark):
    from beaconry.operators.ranking import top_list

    rows = spark.createDataFrame([("c", "p1", 0.1), ("c", "p2", 0.3), ("c", "p3", None), ("d", "p3", None)], "cust string, p string, rate double")
    got = top_list(rows.where("rate IS NOT NULL"), "cust", "p", [F.desc("rate"), F.col("p")], 1, "l").collect()
    assert [(r["cust"], r["l"]) for r in got] == [("c", ["p2"])]


def test_text_rank_is_a_choice(spark):
    rows = spark.createDataFrame([("c", "p", "9"), ("c", "p", "10")], "c string, p string, r string")
    mapping = {"cust_id": "c", "prod_id": "p", "rank": "r", "scene_id": F.lit("s")}
    assert reports.to_warehouse(rows, mapping).first()["rank"] == "10"
    assert reports.to_warehouse(rows, mapping, rank_as_text=True).first()["rank"] == "9"


def test_auc_by_hand(spark):
    rows = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1), (0.4, 1)], "score double, positive int")
    assert metrics.auc(rows).first()["auc"] == pytest.approx((1 + 2 + 1.5) / 6)
    one_class = spark.createDataFrame([(0.1, 1)], "score double, positive int")
    assert metrics.auc(one_class).first()["auc"] is None


def test_multiclass_auc_with_missing_class(spark):
    rows = spark.createDataFrame([(0, [0.8, 0.1, 0.1]), (1, [0.2, 0.7, 0.1]), (0, [0.4, 0.5, 0.1])], "label int, probability array<double>")
    padded = metrics.with_class_rows(rows, 3)
    assert padded.count() == 4
    rest = {r["class"]: r["auc"] for r in metrics.one_vs_rest_auc(padded).collect()}
    assert rest[2] == 1.0 and rest[1] == 1.0
    pairs = metrics.one_vs_one_auc(padded, 3)
    assert pairs.count() == 6 and 0.5 < metrics.macro_average(pairs, "auc").first()["auc"] <= 1.0


def test_binary_metrics_without_predictions(spark):
    row = metrics.binary_metrics(spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (0.5, 0.0, 0.0, 0.0)


def test_scores_of_rows_without_features(spark):
    rows = spark.createDataFrame([([float(i % 2), float(i)], i % 2) for i in range(60)], "features array<double>, label int")
    model = models.fit_propensity(rows, maxIter=2, maxDepth=2)
    scored = models.score(spark.createDataFrame([([1.0, 3.0],), (None,)], "features array<double>"), model).collect()
    assert 0.5 < scored[0]["probability"][1] <= 1.0
    assert scored[1]["probability"] == [0.0, 0.0]


def test_classes_without_samples_are_padded(spark):
    rows = spark.createDataFrame([([1.0, 2.0], 0), ([2.0, 1.0], 2)], "features array<double>, label int")
    padded = models.pad_classes(rows, 4, 2)
    assert sorted(r["label"] for r in padded.collect()) == [0, 1, 2, 3]
    assert models.fit_products(rows, 4, max_iter=2).numClasses == 4
    kept = models.with_labels(spark.createDataFrame([("a",), ("b",), ("z",)], "prod_id string"), {"a": 0, "b": -1})
    assert [r["prod_id"] for r in kept.collect()] == ["a"]


def test_buckets_are_open_at_both_ends(spark):
    rows = spark.createDataFrame([(-1.0,), (0.0,), (4.9,), (5.0,), (float("inf"),)], "v double")
    at = lambda limits: [r[0] for r in rows.select(features.bucket_of(rows.v, limits)).collect()]
    assert at([0.0, 5.0]) == at([-float("inf"), 0.0, 5.0, float("inf")]) == [0.0, 1.0, 1.0, 2.0, 2.0]
    assert at([]) == [0.0] * 5


def test_passes_do_not_grow_with_the_columns(spark):
    def jobs(width):
        names = {kind: [f"{kind}{i}" for i in range(width)] for kind in ("t", "s", "q")}
        rows = spark.range(40).select("id", *[(F.col("id") % 7).cast("string").alias(c) for c in names["t"]],
                                      *[F.col("id").cast("double").alias(c) for c in names["s"] + names["q"]])
        spark.sparkContext.setJobGroup(f"fit{width}", "")
        features.fit_features(rows, features.FeatureMap(onehot=names["t"], scale=names["s"], quantile=names["q"]), "20240110")
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"fit{width}"))

    assert jobs(1) == jobs(4) > 0


def test_too_many_texts_are_refused(spark):
    rows = spark.range(100).select(F.col("id").cast("string").alias("s"))
    with pytest.raises(ValueError, match="s have more than 50"):
        features.fit_features(rows, features.FeatureMap(onehot=("s",)), "20240110", max_flags=50)
    numbers = features.fit_features(rows, features.FeatureMap(index=("s",)), "20240110", max_flags=50)
    assert numbers.sizes == {"s": 100} and numbers.numbers.where("text = '7'").first().number == 67   # equal counts go by text


def test_tenths_are_exact_and_new_texts_known(spark, tmp_path):
    import random

    rnd = random.Random(1)
    values = [rnd.choice([None, float("nan"), 0.0, 1.5, rnd.gauss(0, 5)]) for _ in range(997)]
    rows = spark.createDataFrame([(i, v, rnd.choice("aab"), 3.0) for i, v in enumerate(values)], "user_id int, q double, t string, s double")
    which = features.FeatureMap(index=("t",), onehot=("t",), scale=("s",), quantile=("q",))
    fitted = features.fit_features(rows, which, "20240110")
    order = sorted(0.0 if v is None or v != v else v for v in values)
    assert list(fitted.tenths["q"]) == sorted({order[-(-len(order) * i // 10) - 1] for i in range(1, 10)})
    features.save_features(fitted, spark, str(tmp_path / "f"))
    again = features.load_features(spark, str(tmp_path / "f"))
    new = spark.createDataFrame([(1, -1e9, "b", 6.0), (2, 1e9, "zz", 0.0), (3, None, "a", 3.0)], "user_id int, q double, t string, s double")
    for model in (fitted, again):
        out = {r["user_id"]: r["features"] for r in features.transform_features(new, model).collect()}
        assert out[1] == [1.0, 0.0, 1.0, 0.0, 0.0] and out[2] == [2.0, 0.0, 0.0, 0.0, float(len(fitted.tenths["q"]))] and out[3][:3] == [0.0, 1.0, 0.0]


def test_feature_vector_order(spark):
    rows = spark.createDataFrame([(1, 4.0, "x", "20240105", -3.0), (2, None, "", None, 1.0), (3, 2.0, "x", "19000101", None)],
                                 "user_id int, a double, s string, d string, l double")
    which = features.FeatureMap(plain=("a",), index=("s",), bucket={"a": [3.0]}, log=("l",), days=("d",))
    model = features.fit_features(rows, which, "20240110")
    out = {r["user_id"]: r["features"] for r in features.transform_features(rows, model).collect()}
    assert out[1] == [4.0, 0.0, 1.0, 0.0, -5.0]
    assert out[2] == pytest.approx([0.0, 1.0, 0.0, 0.6931471805599453, 0.0])
    assert out[3] == [2.0, 0.0, 0.0, 0.0, 0.0]


def test_rules_of_fitted_models(spark):
    """SQL text against the model, with categories, NaN and far out values."""
    import random

    from pyspark.ml.classification import GBTClassifier, LogisticRegression
    from pyspark.ml.feature import VectorAssembler, VectorIndexer
    from pyspark.ml.functions import vector_to_array

    from beaconry.plans import scoring

    rnd = random.Random(2)
    rows = [(float(rnd.randint(0, 4)), rnd.uniform(-5, 5), rnd.choice([0.0, 1e9, -3.25])) for _ in range(400)]
    rows = [(*r, int(r[0] in (1.0, 3.0) or r[1] > 2)) for r in rows]
    df = spark.createDataFrame(rows, "a double, b double, c double, label int")
    vectors = VectorAssembler(inputCols=["a", "b", "c"], outputCol="raw").transform(df)
    vectors = VectorIndexer(inputCol="raw", outputCol="v", maxCategories=5).fit(vectors).transform(vectors).withColumn("features", vector_to_array("v"))
    trees = GBTClassifier(featuresCol="v", maxIter=5, maxDepth=3, seed=1).fit(vectors)
    binary = LogisticRegression(featuresCol="v", maxIter=5).fit(vectors)
    many = LogisticRegression(featuresCol="v", family="multinomial", maxIter=5).fit(vectors.withColumn("label", (F.col("a") % 3).cast("int")))
    assert any(node.values for _, root in scoring.from_model(trees).trees for node in _splits(root))
    for model in (trees, binary, many):
        scored = model.transform(vectors.drop("probability", "prediction", "rawPrediction"))
        texts = scoring.score_columns(scoring.from_model(model), "features", 3)
        for r in scored.select(vector_to_array("probability").alias("p"), F.array(*texts).alias("q")).collect():
            assert max(abs(x - y) for x, y in zip(r.p, r.q)) < 1e-9 and len(r.p) == len(r.q)
    missing = spark.createDataFrame([(None,)], "features array<double>")
    assert [missing.select(c.alias("x")).first().x for c in scoring.score_columns(scoring.from_model(binary), "features", 3)] == [0.0, 0.0]
    assert scoring.LinearScore(((1000.0,), (-1000.0,)), (0.0, 0.0)).probabilities(["1"])[0].startswith("(1 / (1 + ")
    with pytest.raises(ValueError):
        scoring.from_model(object())


def _splits(node):
    from beaconry.plans.scoring import Split

    return [node, *_splits(node.left), *_splits(node.right)] if isinstance(node, Split) else []
