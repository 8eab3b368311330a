"""Product cards: what a message shows of a product, and what a product is filtered by."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import product_text as P
from ..sources.keyvalue import kv_rows

#: Fields of a card in order, by the name they go out under; the names are fixed.
CARD_FIELDS = (
    "kehuhao", "kehuxingming", "phoneNumber", "scene_id", "msgmodel_id", "prd_code", "ta_code", "prd_name", "prd_nametwo", "nav", "nav_date",
    "ipo_start_date", "ipo_end_date", "estab_date", "income_date", "end_date", "risk_level", "reserveone", "ta_name", "ta_shortname", "benchmark",
    "modelcomment_desc", "nav_ratio", "cycle_days", "min_hold_days", "term_enjoy_type", "guest_type", "estab_ratio", "day_yearrate", "week_yearrate",
    "two_week_yearrate", "month_yearrate", "two_month_yearrate", "three_month_yearrate", "half_year_yearrate", "year_yearrate", "rateone",
    "twoyear_yearrate", "threeyear_yearrate", "benchmark_show", "tb_reco_one", "tb_reco_two", "tb_reco_three", "tb_reco_four", "tb_reco_five",
    "tb_reco_six", "tb_reco_seven", "tb_reco_eight", "tb_reco_nine", "tb_reco_ten",
)
#: Columns that go out under another name.
RENAMED = {"prd_name2": "prd_nametwo", "reserve1": "reserveone", "rate1": "rateone"}
_DATES = ("ipo_start_date", "ipo_end_date", "estab_date", "income_date", "end_date")
_AS_IS = ("ta_code", "prd_name", "prd_name2", "reserve1", "ta_name", "ta_shortname", "modelcomment_desc", "cycle_days", "benchmark_show")
_CARD_INPUT = (*_AS_IS, *_DATES, *P.YIELD_COLUMNS.values(), "nav", "nav_date", "risk_level", "benchmark", "nav_ratio", "term_enjoy_type", "guest_type",
               "prd_invest_type", "lock_days", "tb_reco_1")


def card_columns(scene: str, columns) -> dict[str, Column]:
    """Every field of a card from the columns of a product; columns that are not there count as empty.

    The customer's fields and the reserves are null: they are filled in when a message is made."""
    present = set(columns)
    col = {name: F.col(name) if name in present else F.lit(None).cast("string") for name in _CARD_INPUT}
    text = lambda name: F.coalesce(col[name].cast("string"), F.lit(""))
    shown: dict[str, Column] = {
        "scene_id": F.lit(scene.upper()), "msgmodel_id": P.template_id(F.col("prod_id"), col["reserve1"]), "prd_code": F.col("prod_id").cast("string"),
        "nav": P.fixed_text(col["nav"], P.NAV_PREFIX), "nav_date": P.date_text(col["nav_date"], P.NAV_DATE_PREFIX),
        "risk_level": P.risk_text(col["risk_level"]), "benchmark": P.benchmark_text(col["benchmark"]),
        "nav_ratio": P.percent_text(col["nav_ratio"], P.RATIO_PREFIX, P.RATIO_SUFFIX), "min_hold_days": F.lit(""),
        "term_enjoy_type": P.term_text(col["term_enjoy_type"]), "guest_type": P.yield_text(col["guest_type"], col["benchmark_show"]),
        "tb_reco_one": P.percent_text(col["tb_reco_1"]), "tb_reco_two": P.invest_text(col["prd_invest_type"]), "tb_reco_three": P.lock_text(text("lock_days")),
    }
    shown |= {RENAMED.get(name, name): text(name) for name in _AS_IS}
    shown |= {name: P.date_text(col[name]) for name in _DATES}
    shown |= {RENAMED.get(name, name): P.percent_text(col[name]) for name in P.YIELD_COLUMNS.values()}
    return {name: shown.get(name, F.lit(None).cast("string")) for name in CARD_FIELDS}


def filter_columns(columns) -> dict[str, Column]:
    """What products are filtered by, as numbers where they are numbers."""
    present = set(columns)
    bare = lambda name: F.trim(F.col(name).cast("string")) if name in present else F.lit(None).cast("string")
    return {"pfirst_amt": bare("pfirst_amt").try_cast("double"), "prd_time_limit": bare("prd_time_limit").try_cast("double"),
            "risk_level": bare("risk_level").try_cast("int"), "prd_invest_type": bare("prd_invest_type")}


def product_cards(info: DataFrame, scene: str) -> DataFrame:
    """prod_id with the structs output_info and filter_info, one row per product (info: see `matching.product_info`)."""
    def packed(fields: Mapping[str, Column]) -> Column:
        return F.struct(*[value.alias(name) for name, value in fields.items()])

    return info.select("prod_id", packed(card_columns(scene, info.columns)).alias("output_info"), packed(filter_columns(info.columns)).alias("filter_info"))


def product_entries(info: DataFrame, scene: str, ttl: int) -> DataFrame:
    """Key-value rows of the products: key, JSON of both structs, seconds to live."""
    return kv_rows(product_cards(info, scene), f"tr|{scene.lower()}|prod_info", "prod_id", ["output_info", "filter_info"], ttl)
