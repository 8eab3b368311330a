import random

import pytest
from pyspark.sql import Row, Window
from pyspark.sql import functions as F

from beaconry.operators import aggregates, cutoff, filters, levels, ranking, sampling
from beaconry.operators.dimensions import small_rows, with_each
from beaconry.operators.rerank import ChannelItems, Item, rerank


NAN = float("nan")


@pytest.fixture(scope="module")
def skewed(spark):
    """30,000 rows; one group has two thirds of them and a third of those share a score."""
    rnd = random.Random(3)
    rows = [(i, "hot" if i % 3 else rnd.choice(["a", "b", None]), 0.5 if i % 2 else rnd.random()) for i in range(30000)]
    return spark.createDataFrame(rows, "id bigint, g string, score double")


def test_ranked_equals_window(skewed):
    order = [F.desc("score"), F.col("id")]
    expected = skewed.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    expected = expected.withColumn("n", F.count("*").over(Window.partitionBy("g")))
    got = ranking.ranked(skewed, order, ["g"], "r", "n")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)


def test_ranked_without_broadcast(skewed, monkeypatch):
    monkeypatch.setattr(ranking, "_BROADCAST_ROWS", 1)
    order = [F.col("score"), F.col("id")]
    got = ranking.ranked(skewed, order, ["g"], "r")
    expected = skewed.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)


def test_hot_group_is_spread_over_tasks(spark, skewed):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the rows are few here
    try:
        order = [F.desc("score"), F.col("id")]
        placed = ranking._placed(skewed, order, ["g"])
        sizes = [r["count"] for r in placed.groupBy("_task").count().collect()]
        assert len(sizes) == 4 and max(sizes) < 0.4 * sum(sizes)
        got = ranking.ranked(skewed, order, ["g"], "r")
        expected = skewed.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_total_before(skewed):
    rows = skewed.groupBy("g", "score").agg(F.count("*").alias("n"))
    got = ranking.total_before(rows, [F.col("score")], "n", ["g"])
    window = Window.partitionBy("g").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    expected = rows.withColumn("before", F.coalesce(F.sum("n").over(window), F.lit(0)))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)


def test_first_n_both_ways(skewed, monkeypatch):
    order = [F.col("score"), F.col("id")]
    small = {r["id"] for r in ranking.first_n(skewed, order, 500).collect()}
    monkeypatch.setattr(ranking, "_IN_TASK_LIMIT", 10)
    assert {r["id"] for r in ranking.first_n(skewed, order, 500).collect()} == small


SHAPES = {
    "even": lambda r: r.random(), "one score": lambda r: 0.5, "few scores": lambda r: r.choice([0.0, -0.0, 0.25, 0.5, None, NAN]),
    "wide": lambda r: r.choice([-1, 1]) * 10.0 ** r.randint(-300, 300), "tiny steps": lambda r: 1.0 + r.randint(0, 9000) * 2.0 ** -50,
    "ends": lambda r: r.choice([float("inf"), float("-inf"), NAN, None, 1e308, -1e308, 5e-324, r.random()])}


@pytest.mark.parametrize("shape", sorted(SHAPES))
def test_cut_off_before_the_sort(spark, shape):
    """All rows within the limit, and at most as many more."""
    rnd = random.Random(shape)
    limits = {"a": 40, "b": 300, "none": None, "zero": 0, "more": 10_000, None: 25}
    groups = ["a"] * 6 + list(limits)
    rows = [(i * 2**33 - 2**40, g, SHAPES[shape](rnd), limits[g]) for i in range(6000) for g in [rnd.choice(groups)]]
    df = spark.createDataFrame(rows, "id bigint, g string, score double, k int")
    for by in (["-score", "id"], ["score", "-id"]):
        order = [cutoff.order_column(n) for n in by]
        expected = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(*order))).where("r <= k")
        got = ranking.top_k_by_limit(df, ["g"], by, "k", "r")
        assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
        near = {r["g"]: r["count"] for r in cutoff.within_limit(df, ["g"], by, "k").groupBy("g").count().collect()}
        assert set(near) <= {"a", "b", "more", None} and all(n <= 2 * limits[g] for g, n in near.items())


def test_cut_off_by_other_types(spark):
    rnd = random.Random(8)
    rows = [(rnd.choice([None, True, False]), rnd.choice([None, "", "a", "ab", "é", "same long text, that goes on", "same long text, that goes off"]), i) for i in range(900)]
    df = spark.createDataFrame(rows, "flag boolean, name string, id int").withColumns({
        "day": F.expr("date_add(date'2024-01-01', cast(id % 40 - 20 as int))"), "at": F.expr("timestamp_seconds(id % 77 * 1000000 - 9000000)"),
        "price": F.expr("cast(id % 91 as decimal(20,4)) / 7"), "g": F.lit("x"), "k": F.lit(60)})
    for by in (["flag", "-name", "id"], ["-name", "-flag", "id"], ["-day", "at", "id"], ["at", "-id"], ["-price", "id"], ["-id"]):
        order = [cutoff.order_column(n) for n in by]
        expected = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(*order))).where("r <= k")
        got = ranking.top_k_by_limit(df, ["g"], by, "k", "r")
        assert sorted(r.id for r in got.collect()) == sorted(r.id for r in expected.collect()), by


def test_top_k_is_cut_before_the_shuffle(skewed):
    plan = ranking.top_k(skewed, "g", [F.col("id")], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_pick_rows_takes_the_smallest_draws(skewed):
    from beaconry.functions.scalars import unit_hash

    draws = sorted((r["u"], r["id"]) for r in skewed.select("id", unit_hash("s", "id").alias("u")).collect())
    for n in (1, 700, 29999, 40000):
        assert {r["id"] for r in sampling.pick_rows(skewed, n, "s", "id").collect()} == {i for _, i in draws[:n]}


def test_weighted_split(spark):
    users = spark.range(10000).select(F.col("id").alias("user_id"))
    rows = sampling.weighted_split(users, [("exp", 9.0), ("ctl", 1.0)], "s", "user_id")
    counts = {r["user_type"]: r["count"] for r in rows.groupBy("user_type").count().collect()}
    assert abs(counts["exp"] - 9000) < 150 and sum(counts.values()) == 10000
    assert sampling.random_split(users, [("a", 1.0), ("b", 1.0)], 1).count() == 10000


@pytest.mark.parametrize("count", [0, 1, 7, 16, 17, 90])
def test_best_upto_against_brute_force(spark, count):
    rnd = random.Random(count)
    pick = lambda: rnd.choice([None, NAN, *[x / 2 for x in range(-1, count)]])
    rows = [(f"p{i}", pick(), rnd.choice([None, NAN, 0.0, 1.0, 2.5]), rnd.choice("xy"), rnd.randint(0, 30)) for i in range(300)]
    products = spark.createDataFrame(rows, "id string, a double, b double, g string, v int")
    asked = [(rnd.choice([pick(), -9.0, 99.0, 0.3]), rnd.choice([None, NAN, -1.0, 0.0, 1.5, 3.0])) for _ in range(60)]
    reaches = spark.createDataFrame(asked, "a double, b double")
    numbers = levels.level_numbers(products, reaches, ["a", "b"])
    wanted = levels.with_numbers(reaches.selectExpr("a", "b", "a as own_a", "b as own_b"), numbers, ["a", "b"]).distinct()
    best = levels.best_upto(levels.with_numbers(products, numbers, ["a", "b"]), wanted, levels.level_bits(numbers, ["a", "b"]),
                            [F.desc("v"), F.col("id")], 3, ["g"])
    found = {}
    for r in wanted.join(best, ["a", "b"]).collect():
        found.setdefault((repr(r.own_a), repr(r.own_b), r.g), []).append((r["rank"], r["id"]))
    below = lambda x, y: x is not None and y is not None and x <= y  # noqa: E731  false for NaN too
    expected = {}
    for a, b in asked:
        for g in "xy":
            fitting = sorted((-v, i) for i, own_a, own_b, kind, v in rows if kind == g and below(own_a, a) and below(own_b, b))[:3]
            if fitting:
                expected[repr(a), repr(b), g] = [i for _, i in fitting]
    assert {key: [i for _, i in sorted(set(rows))] for key, rows in found.items()} == expected


def test_blocks_of_levels(spark):
    """Every prefix falls into blocks that hold each of its levels once and no other."""
    rows = spark.range(1, 71).select(F.col("id").alias("n"), levels.blocks_with("id", 7).alias("held"), levels.blocks_upto("id", 7).alias("upto")).collect()
    for r in rows:
        assert len(r.upto) <= 7
        for other in rows:
            assert len(set(r.upto) & set(other.held)) == (other.n <= r.n)


def test_sum_upto(spark):
    products = spark.createDataFrame([(1.0, 5), (2.0, 7), (2.0, 1), (NAN, 9), (None, 9)], "level double, n int")
    reaches = spark.createDataFrame([(0.5,), (1.0,), (2.9,), (NAN,), (None,)], "level double")
    got = levels.sum_upto(products, reaches, "level", F.col("n"), "total").collect()
    assert sorted(map(tuple, got)) == [(0.5, 0), (1.0, 5), (2.9, 13)]


def test_level_values_stay_in_tables(spark):
    """More levels than would be reasonable on the driver; the plan has no literal list of them."""
    products = spark.range(200_000).selectExpr("cast(id as double) as level", "id as prod_id", "id % 977 as v")
    reaches = spark.createDataFrame([(100.5,), (199_999.0,)], "level double")
    numbers = levels.level_numbers(products, reaches, ["level"])
    assert levels.level_bits(numbers, ["level"]) == {"level": 18}
    wanted = levels.with_numbers(reaches, numbers, ["level"])
    best = levels.best_upto(levels.with_numbers(products, numbers, ["level"]), wanted, {"level": 18}, [F.desc("v"), F.col("prod_id")], 2)
    assert sorted((r.level, r.prod_id) for r in best.collect()) == [(101, 99), (101, 100), (200_000, 976), (200_000, 1953)]


def test_semi_and_anti_keep_left_rows_once(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k int, v string")
    right = spark.createDataFrame([(2,), (2,), (None,)], "k int")
    assert sorted(r["v"] for r in filters.semi(left, right, "k").collect()) == ["b", "c"]
    assert [r["v"] for r in filters.anti(left, right, "k").collect()] == ["a"]


def test_tags_reject_other_types(spark):
    df = spark.range(3)
    assert filters.select_by_tags(df, {"id": [0, 2]}).count() == 2
    with pytest.raises(ValueError):
        filters.select_by_tags(df, {"id": 1.5})


def test_small_rows_checks(spark):
    assert len(small_rows(spark.range(3))) == 3
    with pytest.raises(ValueError):
        small_rows(spark.range(30), 10)
    assert with_each(spark.range(2), [{"c": "a", "m": {"x": 1}}, {"c": "b", "m": {"x": 2}}]).count() == 4


def test_levels_in_one_pass(spark):
    rows = spark.createDataFrame([("n", "a", 1), ("n", "b", 2), ("s", "a", 0)], "branch string, g string, x int")
    got = aggregates.at_levels(rows, {"sum": ["g"], "branch": ["branch", "g"], "all": []}, aggregates.funnel_columns(["x"]))
    out = {(r["level"], r["branch"], r["g"]): (r["members"], r["x_users"], r["x_total"], float(r["x_rate"])) for r in got.collect()}
    assert out[("all", None, None)] == (3, 2, 3, 1.0)
    assert out[("sum", None, "a")] == (2, 1, 1, 0.5)
    assert out[("branch", "s", "a")] == (1, 0, 0, 0.0)
    assert len(out) == 6


def test_json_slots_in_rank_order(spark):
    rows = spark.createDataFrame([("u", 1, "p1", "t"), ("u", 0, "p0", "t")], "user string, rank int, code string, kind string")
    text = aggregates.json_slots(rows, ["user"], "B", "code", "kind", "rank").first()["prod_info"]
    assert text == '[{"positionId":"B","slots":[{"index":"0","prdList":[{"code":"p0","type":"t"},{"code":"p1","type":"t"}]}]}]'


# --- item order --------------------------------------------------------------------------------


def order(spark, items, scores, allowed=(), group="exp", users=1):
    rows = [Row(user_id=i, user_type=group, channel_id="C", banner_id=None, probability=scores) for i in range(users)]
    df = spark.createDataFrame(rows, "user_id bigint, user_type string, channel_id string, banner_id string, probability array<double>")
    out = {}
    for r in rerank(df, items, [ChannelItems("C", "", tuple(allowed))]).orderBy("user_id", "rank").collect():
        out.setdefault(r["user_id"], []).append((r["item_id"], r["score"], r["rank"]))
    return out[0] if users == 1 else list(out.values())


A, B, C = Item(("a", "a2"), 0), Item(("b",), 1), Item(("c",), 2, prop=0.5)


def test_rerank_by_score(spark):
    assert order(spark, [A, B], [0.3, 0.6]) == [("b", 0.6, 0), ("a", 0.3, 1)]
    assert order(spark, [A, B], [0.3, 0.3]) == [("a", 0.3, 0), ("b", 0.3, 1)]


def test_rerank_uses_only_known_labels(spark):
    assert [i for i, *_ in order(spark, [A, B], [0.1, 0.2, 0.9])] == ["b", "a"]
    assert [i for i, *_ in order(spark, [A, B], [0.1])] == ["a"]
    assert [i for i, *_ in order(spark, [A, Item(("z",), -1)], [0.1, 0.4])] == ["a"]


def test_rerank_allowed_items(spark):
    assert [i for i, *_ in order(spark, [A, B], [0.1, 0.2], ["a", "x"])] == ["a"]
    assert order(spark, [A, B], [0.1, 0.2], ["x", "y"]) == [("x", 0.0, 0), ("y", 0.0, 1)]


def test_rerank_shuffles_other_groups(spark):
    orders = [tuple(i for i, *_ in o) for o in order(spark, [A, B], [0.1, 0.2], group="ctl", users=400)]
    share = orders.count(("a", "b")) / len(orders)
    assert set(orders) == {("a", "b"), ("b", "a")} and 0.4 < share < 0.6


def test_rerank_forced_share(spark):
    orders = [tuple(i for i, *_ in o) for o in order(spark, [A, B, C], [0.1, 0.2], users=400)]
    assert set(orders) == {("b", "a"), ("c", "b", "a")}
    assert 0.4 < orders.count(("b", "a")) / len(orders) < 0.6


def test_rerank_drops_disabled_only_with_a_forced_item(spark):
    off = Item(("b",), 1, enable=False)
    orders = {tuple(i for i, *_ in o) for o in order(spark, [A, off, C], [0.1, 0.2, 0.0], users=60)}
    assert orders == {("b", "a", "c"), ("c", "a")}


def test_features_that_are_no_numbers_become_zero(spark):
    from beaconry.operators.filters import fill_features
    df = spark.createDataFrame([("1.5", float("nan")), ("x1", 2.0), (None, None)], "a string, b double")
    assert [(r.a, r.b) for r in fill_features(df, ["a", "b"], []).collect()] == [(1.5, 0.0), (0.0, 2.0), (0.0, 0.0)]


def test_padding_looks_only_at_the_classes(spark):
    from beaconry.plans.metrics import with_class_rows
    from beaconry.plans.models import pad_classes
    df = spark.createDataFrame([(y, [0.5, 0.5]) for y in (-5, -4, -3, 0, 1, 7)], "label int, probability array<double>")
    assert with_class_rows(df, 2).count() == 6 and with_class_rows(df, 3).where("label = 2").first().probability == [0.0, 0.0, 1.0]
    rows = df.withColumnRenamed("probability", "features")
    assert pad_classes(rows, 2, 2).count() == 6 and pad_classes(rows, 3, 2).where("label = 2").first().features == [0.0, 0.0]
