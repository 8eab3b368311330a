"""Product attributes as the text a message shows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import reformat_date
from .scalars import case_of, lookup

# Names and codes that messages must show literally.
RISK_NAMES = {
    "1": "风险等级极低风险",
    "2": "风险等级低风险",
    "3": "风险等级中等风险",
    "4": "风险等级较高风险 ",
    "5": "风险等级高风险",
}
TERM_NAMES = {
    "0": "每日",
    "1": "每周",
    "2": "每月",
    "3": "每季",
    "4": "每半年",
    "5": "每年",
    "6": "每二年",
    "7": "每三年",
}
YIELD_NAMES = {
    "0": "成立以来年化收益率",
    "1": "上日年化收益率",
    "2": "近七日年化收益率",
    "3": "近14日年化收益率",
    "4": "近一月年化收益率",
    "5": "近两月年化收益率",
    "6": "近三月年化收益率",
    "7": "近半年年化收益率",
    "8": "上一年年化收益率",
    "9": "上期年化收益率",
    "a": "二年化收益率",
    "b": "三年化收益率",
}
INVEST_NAMES = {
    "0": "精选固收",
    "1": "精选权益",
    "2": "精选商品及金融衍生品",
    "3": "精选混合",
    "4": "精选货币",
    "99": "精选其他",
}
TEMPLATE_PRODUCTS = ["J172411SA799", "5811221014", "5811222044", "9B310115"]
TEMPLATE_SERIES = ["1301", "D309", "D321", "D311", "1303"]
NAV_PREFIX = "产品净值"
NAV_DATE_PREFIX = "截至"
BENCHMARK_PREFIX = "业绩比较基准："
RATIO_PREFIX = "上一投资周期年化收益率"
RATIO_SUFFIX = "、"

_DIGITS = 4
_SMALLEST_PLAIN = -6   # zeros behind the point from which a number is written with an exponent
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d{1,9})?$"


def _text(value) -> Column:
    return F.trim(F.coalesce(value.cast("string"), F.lit("")))


def _let(value: Column, body) -> Column:
    """Work a value out once and use it several times in `body`."""
    return F.get(F.transform(F.array(value), body), 0)


def _significant(source: Column, times: str = "") -> Column:
    """Four significant digits, half to even, of a number given as text, however long it is; null for no number.

    Digits are moved as text and the exponent as a number, so neither size nor places are limited. `times` are
    zeros appended to the digits ("00": per cent). Trailing zeros behind the point go, but one digit
    stays there; numbers of more than four digits before it, or of six zeros behind it, have an exponent."""
    whole, fraction = F.regexp_extract(source, r"^[+-]?(\d*)", 1), F.regexp_extract(source, r"\.(\d*)", 1)
    power = F.coalesce(F.regexp_extract(source, r"[eE]([+-]?\d+)$", 1).try_cast("int"), F.lit(0))
    parts = F.struct(
        F.when(F.startswith(source, F.lit("-")), "-").otherwise("").alias("sign"),
        F.regexp_replace(F.concat(whole, fraction, F.lit(times)), r"^0+(?=\d)", "").alias("digits"), (power - F.length(fraction)).alias("power"))

    def cut(v):
        digits, rest = v["digits"], F.substring(v["digits"], _DIGITS + 1, 1_000_000_000)
        head = F.substring(digits, 1, _DIGITS)
        odd = F.substring(head, -1, 1).isin("1", "3", "5", "7", "9")
        above = F.rlike(rest, F.lit(r"^([6-9]|5\d*[1-9])"))
        up = F.when(above | (F.startswith(rest, F.lit("5")) & odd), 1).otherwise(0)   # where it starts with 5 and is not above, zeros follow
        grown = (head.cast("int") + up).cast("string")
        more = v["power"] + F.length(digits) - _DIGITS
        long = F.length(digits) > _DIGITS
        over = F.length(grown) > _DIGITS
        return F.struct(v["sign"].alias("sign"), F.when(~long, digits).otherwise(F.substring(grown, 1, _DIGITS)).alias("digits"),
                        F.when(~long, v["power"]).otherwise(more + over.cast("int")).alias("power"))

    def written(v):
        digits, before = v["digits"], v["power"] + F.length(v["digits"])
        small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -before), digits)
        split = F.concat(F.substr(digits, F.lit(1), before), F.lit("."), F.substr(digits, before + 1))
        plain = F.when(v["power"] == 0, digits).when(before <= 0, small).otherwise(split)
        short = F.when(F.contains(plain, F.lit(".")), F.regexp_replace(F.regexp_replace(plain, "0+$", ""), r"\.$", ".0")).otherwise(plain)
        tail = F.when(F.length(digits) > 1, F.concat(F.lit("."), F.substring(digits, 2, _DIGITS))).otherwise("")
        wide = F.concat(F.substring(digits, 1, 1), tail, F.when(before > 0, "E+").otherwise("E-"), F.abs(before - 1).cast("string"))
        return F.concat(v["sign"], F.when((v["power"] <= 0) & (before > _SMALLEST_PLAIN), short).otherwise(wide))

    return F.when(F.rlike(source, F.lit(_NUMBER)), _let(parts, lambda v: _let(cut(v), written)))


def fixed_text(value, prefix: str = "") -> Column:
    """Number with four significant digits behind a prefix; blank when it is no number."""
    return F.coalesce(F.concat(F.lit(prefix), _significant(_text(value))), F.lit(""))


def percent_text(value, prefix: str = "", suffix: str = "") -> Column:
    """Ratio as percent with four significant digits; blank for zero and for no number."""
    source = _text(value)
    shown = F.concat(F.lit(prefix), _significant(source, "00"), F.lit("%"), F.lit(suffix))
    return F.coalesce(F.when(F.abs(source.try_cast("double")) * 100 >= F.lit(0.000001), shown), F.lit(""))


def date_text(value, prefix: str = "") -> Column:
    """yyyyMMdd as yyyy/MM/dd; blank when it is no date."""
    shown = reformat_date(_text(value), "yyyyMMdd", "yyyy/MM/dd")
    return F.coalesce(F.concat(F.lit(prefix), shown), F.lit(""))


def risk_text(value) -> Column:
    return lookup(_text(value), RISK_NAMES, "")


def term_text(value) -> Column:
    return lookup(_text(value), TERM_NAMES, "")


def yield_text(kind, shown_benchmark) -> Column:
    """Name of the yield a product advertises; kind c shows its own benchmark text."""
    code = F.lower(_text(kind))
    return F.when(code == "c", F.coalesce(shown_benchmark.cast("string"), F.lit(""))).otherwise(
        lookup(code, YIELD_NAMES, "")
    )


def invest_text(value) -> Column:
    return lookup(_text(value).try_cast("int").cast("string"), INVEST_NAMES, "")


def lock_text(value) -> Column:
    return F.when(_text(value).isin("0", ""), F.lit("")).otherwise(value.cast("string"))


def benchmark_text(value) -> Column:
    text = _text(value)
    return F.when(text == "", F.lit("")).otherwise(
        F.concat(F.lit(BENCHMARK_PREFIX), F.replace(text, F.lit("~"), F.lit("-")))
    )


def template_id(product, series) -> Column:
    """Message template: products with their own one first, then those with one per series."""
    code, group = F.upper(_text(product)), F.upper(_text(series))
    return (
        F.when(code.isin(TEMPLATE_PRODUCTS), F.concat(F.lit("chrem_"), code))
        .when(group.isin(TEMPLATE_SERIES), F.concat(F.lit("chrem_"), group))
        .otherwise(F.lit(""))
    )


#: Column of the yield that a product advertises, by its kind.
YIELD_COLUMNS = {
    "0": "estab_ratio",
    "1": "day_yearrate",
    "2": "week_yearrate",
    "3": "two_week_yearrate",
    "4": "month_yearrate",
    "5": "two_month_yearrate",
    "6": "three_month_yearrate",
    "7": "half_year_yearrate",
    "8": "year_yearrate",
    "9": "rate1",
    "a": "twoyear_yearrate",
    "b": "threeyear_yearrate",
}


def advertised_yield(kind, columns) -> Column:
    """The yield that `kind` names, as text; blank for any other kind. Of `columns` those that are not there are blank."""
    present = set(columns)
    tests = [(kind == code, F.col(name).cast("string")) for code, name in YIELD_COLUMNS.items() if name in present]
    return case_of(tests, F.lit("")) if tests else F.lit("")


def benchmark_number(value) -> Column:
    """Upper bound of '1.0%~2.0%'; a bare number counts as a ratio; anything else is 0."""
    upper = F.substring_index(value, "~", -1)
    bare = upper.try_cast("double") * 100
    percent = F.when(F.endswith(upper, F.lit("%")), F.regexp_replace(upper, "%$", "").try_cast("double"))
    return F.coalesce(bare, percent, F.lit(0.0)).cast("float")
