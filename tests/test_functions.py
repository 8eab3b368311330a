from datetime import date

import pytest
from pyspark.sql import functions as F

from beaconry.functions import product_text as T
from beaconry.functions import scalars as S
from beaconry.functions.dates import day_before_month, days_since, on_days, parse_ymd, reformat_date, shift_ymd


def value(spark, column, schema="a string", row=(None,)):
    return spark.createDataFrame([row], schema).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("text, expected", [
    ("1.25", "N1.25"), ("3.070000 ", "N3.07"), ("2.0000", "N2.0"), (" ", ""), (None, ""), ("7", "N7"), ("soon", ""),
    ("1.23456", "N1.235"), ("0.0098765", "N0.009876"), ("-4.500", "N-4.5"),
])
def test_fixed_text(spark, text, expected):
    assert value(spark, T.fixed_text(F.col("a"), "N"), row=(text,)) == expected


@pytest.mark.parametrize("text, expected", [
    ("0.0231", "2.31%"), ("0.017000", "1.7%"), ("0", ""), ("0.000", ""), ("", ""), (None, ""), ("-3.2000", "-320.0%"), ("x", ""),
])
def test_percent_text(spark, text, expected):
    assert value(spark, T.percent_text(F.col("a")), row=(text,)) == expected


def test_percent_text_of_decimal(spark):
    assert value(spark, T.percent_text(F.col("a"), "p", "s"), "a decimal(16,4)", (__import__("decimal").Decimal("0.0250"),)) == "p2.5%s"
    assert value(spark, T.percent_text(F.col("a")), "a decimal(16,8)", (__import__("decimal").Decimal("0E-8"),)) == ""


@pytest.mark.parametrize("text, expected", [("20240229", "to 2024/02/29"), ("20230230", ""), ("2024/01/01", ""), (" ", ""), ("20220131 ", "to 2022/01/31")])
def test_date_text(spark, text, expected):
    assert value(spark, T.date_text(F.col("a"), "to "), row=(text,)) == expected


def test_names(spark):
    assert value(spark, T.risk_text(F.lit(" 2 "))) == T.RISK_NAMES["2"]
    assert value(spark, T.risk_text(F.lit("9"))) == ""
    assert value(spark, T.term_text(F.lit(3))) == T.TERM_NAMES["3"]
    assert value(spark, T.yield_text(F.lit("A"), F.lit("x"))) == T.YIELD_NAMES["a"]
    assert value(spark, T.yield_text(F.lit("C"), F.lit("2.2%"))) == "2.2%"
    assert value(spark, T.invest_text(F.lit("99"))) == T.INVEST_NAMES["99"]
    assert value(spark, T.invest_text(F.lit("none"))) == ""
    assert value(spark, T.benchmark_text(F.lit(" 3.0%~3.9% "))) == T.BENCHMARK_PREFIX + "3.0%-3.9%"
    assert [value(spark, T.lock_text(F.lit(x))) for x in ("0", "", "9")] == ["", "", "9"]
    assert value(spark, T.template_id(F.lit("5811221014"), F.lit(None))) == "chrem_5811221014"
    assert value(spark, T.template_id(F.lit("other"), F.lit("d309"))) == "chrem_D309"
    assert value(spark, T.template_id(F.lit("other"), F.lit("other"))) == ""


@pytest.mark.parametrize("text, expected", [("2.0%~3.5%", 3.5), ("0.041", 4.1), ("2.7%", 2.7), ("open", 0.0), ("", 0.0), (None, 0.0), ("abc%", 0.0)])
def test_benchmark_number(spark, text, expected):
    assert value(spark, T.benchmark_number(F.col("a")), row=(text,)) == pytest.approx(expected, rel=1e-6)


def test_clean_ad(spark):
    text = "${name} look at shop.example.com/a?b=1 today"
    assert value(spark, S.clean_ad(F.lit(text))) == " look at  today"
    assert value(spark, S.clean_ad(F.lit("尊敬的王女士，您好"))) == "您好"


def test_branch_name(spark):
    assert value(spark, S.branch_name(F.lit("第一银行东区"), "第一银行")) == "东区"
    assert value(spark, S.branch_name(F.lit("西区(分行级)"), "第一银行")) == "西区"
    assert value(spark, S.branch_name(F.lit("南区"), "第一银行")) == "南区"


def test_vectors(spark):
    a, b = F.array(F.lit(1.0), F.lit(3.0)), F.array(F.lit(3.0), F.lit(-1.0))
    assert value(spark, S.cosine(a, a)) == pytest.approx(1.0)
    assert value(spark, S.cosine(a, b)) == pytest.approx(0.0)
    assert value(spark, S.cosine(F.lit(None).cast("array<double>"), b)) == 0.0
    assert value(spark, S.argmax(F.array(F.lit(0.2), F.lit(0.5), F.lit(0.5)))) == 1
    S.register_sql_functions(spark)
    assert spark.sql("SELECT vector_sim(array(1D, 0D), array(0D, 0D)) AS v").first()["v"] == 0.0


def test_currency_keeps_zero_and_null(spark):
    money = lambda x: F.lit(x).cast("decimal(18,2)")
    assert float(value(spark, S.in_home_currency(money(10), F.lit("CNY")))) == 10
    assert float(value(spark, S.in_home_currency(money(10), F.lit("USD")))) == 67
    assert float(value(spark, S.in_home_currency(money(None), F.lit("USD")))) == 0


def test_split_part_past_the_end_is_null(spark):
    assert value(spark, S.split_part(F.lit("a--b"), "--", 1)) == "b"
    assert value(spark, S.split_part(F.lit("a"), "--", 1)) is None


def test_lookup_and_default(spark):
    assert value(spark, S.lookup(F.lit("x"), {"x": 3}, 0)) == 3
    assert value(spark, S.lookup(F.lit("y"), {"x": 3}, 0)) == 0
    assert value(spark, S.lookup(F.lit(None).cast("string"), {"x": 3}, 0)) == 0


def test_dates(spark):
    assert value(spark, shift_ymd(F.lit("20240301"), -1)) == "20240229"
    assert value(spark, parse_ymd(F.lit("0"))) is None
    assert value(spark, reformat_date(F.lit("2024-02-03"), "yyyy-MM-dd", "yyyyMMdd")) == "20240203"
    assert value(spark, day_before_month(F.lit("202403"))) == "20240229"
    assert value(spark, day_before_month(F.lit("202403"), 1)) == "20240131"
    day = F.lit(date(2024, 1, 10))
    assert [value(spark, days_since(F.lit(x), day)) for x in ("20240108", "19000101", None)] == [-2, 0, 0]


def test_day_range_reaches_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    rows = events.where(on_days("ts", "20240105", "20240106"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert {r["d"] for r in rows.select(F.date_format("ts", "yyyyMMdd").alias("d")).distinct().collect()} == {"20240105", "20240106"}


def test_unit_hash_is_even(spark):
    draws = [r["u"] for r in spark.range(20000).select(S.unit_hash("s", "id").alias("u")).collect()]
    assert 0 <= min(draws) and max(draws) < 1
    for bound in (0.1, 0.5, 0.9):
        assert abs(sum(d < bound for d in draws) / len(draws) - bound) < 0.02


def test_significant_digits_of_any_size(spark):
    """As the decimal library writes four digits, but round numbers and exponents keep their zeros."""
    import decimal
    import random

    from beaconry.functions.product_text import fixed_text, percent_text

    rnd = random.Random(6)
    texts = ["1e-25", "123456789012345678901234", "0.00000123456", "0.0000012345", "1e2", "99995", "99985", "9999.5", "0.5", "-12345.6", "100", "1000", "10000",
             "1.2345", "1.2355", "1.23450000001", "0", "0.000", "00012.50", ".5", "5.", "+7.10", "12345678901234567890.5", "1" + "0" * 40, "0." + "0" * 30 + "98765"]
    texts += [f"{rnd.choice(['', '-'])}{rnd.randint(0, 10 ** rnd.randint(0, 12))}.{rnd.randint(0, 10 ** rnd.randint(0, 12))}" for _ in range(300)]

    def shown(text, times=1):
        number = decimal.Decimal(text) * times
        out = f"{number:.4}"
        if "." in out and "E" not in out:
            out = out.rstrip("0")
            out += "0" if out.endswith(".") else ""
        return out

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: (r.a, r.b) for r in df.select("t", fixed_text(F.col("t")).alias("a"), percent_text(F.col("t")).alias("b")).collect()}
    for text in texts:
        assert got[text][0] == shown(text), text
        assert got[text][1] == ("" if abs(decimal.Decimal(text)) * 100 < decimal.Decimal("1e-6") else shown(text, 100) + "%"), text
    odd = spark.createDataFrame([("",), (None,), ("abc",), ("1.2.3",), ("--1",), ("1e",)], "t string")
    assert {r.a for r in odd.select(fixed_text(F.col("t"), "x").alias("a")).collect()} == {""}
