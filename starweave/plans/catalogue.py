"""The query catalogue: reports 1-8, cube queries 9-15, OLAP
operations 16-37, historical analysis 38-51, summaries 52-56, cards 57-61.

Each query is a parameterised call of the operators on a ``Star``.  Output
columns carry exact DECIMAL sums cast to DOUBLE at the edge; counts are
BIGINT.  Sort orders follow the reference, with explicit NULL placement
(T7) and a natural-key tie-breaker under LIMIT (T8).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import MONTH_NAMES
from ..functions.labels import weekend_label
from ..functions.measures import as_double, avg_line_value, margin_pct, ratio
from ..operators import history as H
from ..operators import olap as O
from .star import Star


@dataclass(frozen=True)
class CatalogueParams:
    """Literal values used by the catalogue queries.

    Fixed values: the defaults are the reference's own literals (year 2025,
    region Barat, province Jawa Barat, city Bandung, category Kitchenware,
    membership Platinum, ...); ``TESTDATA`` holds the equivalents present in
    the TPC-H-style test tables."""
    year: int = 2025
    quarter: int = 1
    month: int = 1
    drill_region: str = "Barat"
    drill_province: str = "Jawa Barat"
    drill_city: str = "Bandung"
    slice_category: str = "Kitchenware"
    slice_region: str = "Barat"
    slice_membership: str = "Platinum"
    dice_categories: tuple = ("Kitchenware", "Furniture")
    dice_region: str = "Barat"
    dice_quarters: tuple = (1, 2)
    dice_levels: tuple = ("Gold", "Platinum")
    dice_methods: tuple = ("E-Wallet", "Credit Card")
    dice_cities: tuple = ("Jakarta", "Surabaya", "Bandung")
    pivot_quarters: tuple = (1, 2, 3, 4)
    pivot_methods: tuple = ("Cash", "Debit Card", "Credit Card", "E-Wallet", "Bank Transfer")
    pivot_categories: tuple = ("Kitchenware", "Home Decor", "Cleaning Tools", "Furniture",
                               "Bathroom", "Electrical", "Storage")
    pivot_regions: tuple = ("Barat", "Tengah", "Timur")
    pivot_genders: tuple = ("Male", "Female")
    top_n: int = 10
    no_promo: str = "NO_PROMO"
    dense: bool = False          # T10: months without sales count as 0 in growth / moving averages
    week_basis: str = "calendar"  # T9: "calendar" (year, ISO week) as the reference, or "iso" (ISO year, week)
    by_key: bool = False         # T18: group stores / products by surrogate key, not by name
    reference_names: bool = False  # output the reference's own column aliases


RETAIL = CatalogueParams()
TESTDATA = CatalogueParams(
    year=1997, quarter=1, month=1,
    drill_region="ASIA", drill_province="NATION_7", drill_city="NATION_7_1",
    slice_category="MEDIUM", slice_region="ASIA", slice_membership="BUILDING",
    dice_categories=("MEDIUM", "LARGE"), dice_region="ASIA", dice_quarters=(1, 2),
    dice_levels=("AUTOMOBILE", "BUILDING"), dice_methods=("4-NOT SPECIFIED", "3-MEDIUM"),
    dice_cities=("NATION_7_1", "NATION_11_0", "NATION_9_1"),
    pivot_methods=("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"),
    pivot_categories=("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"),
    pivot_regions=("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"),
)


# Subtotal labels and report-type names of the reference's
# cube and OLAP queries, per query, top level first.
LABELS: dict[str, tuple[str, ...]] = {
    "rollup_time": ("*** GRAND TOTAL ***", "** Year Subtotal **", "* Quarter Subtotal *"),
    "rollup_geo": ("*** GRAND TOTAL ***", "** Region Subtotal **", "* Province Subtotal *", "City Subtotal"),
    "rollup_product": ("*** GRAND TOTAL ***", "** Category Subtotal **", "* Brand Subtotal *"),
    "cube_cat_region_q": ("(All Categories)", "(All Regions)", "(All Quarters)"),
    "cube_member_payment": ("(All Membership)", "(All Payment)"),
    "gsets_single": ("By Category", "By Region", "By Quarter", "Grand Total"),
    "gsets_pairs": ("Category × Region", "Category × Quarter", "Region × Quarter", "Unknown"),
    "rollup_geo3": (">> GRAND TOTAL", ">> Region Total", ">> Province Total"),
    "rollup_prod2": (">> GRAND TOTAL", ">> Category Total"),
}


def edge(df: DataFrame) -> DataFrame:
    """Output types: DECIMAL money -> DOUBLE (after exact summation)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _month_name(month: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in MONTH_NAMES]), month)


def _d(c: str) -> Column:
    return F.col(c).desc_nulls_first()


def _a(c: str) -> Column:
    return F.col(c).asc_nulls_last()


def _ordered_labels(df: DataFrame, keys: list[str], out: list[str], tail: list[str],
                    last_order: Column | None = None) -> DataFrame:
    """Sort subtotal-last by (GROUPING(k), k) pairs, then keep the labels."""
    order: list[Column] = []
    for i, k in enumerate(keys):
        order.append(F.col(f"g_{k}"))
        order.append(last_order if (last_order is not None and i == len(keys) - 1) else _a(k))
    df = df.orderBy(*order)
    return df.select(*[F.col(f"{k}_label").alias(o) for k, o in zip(keys, out)], *tail)


# ====================================================== ready-made reports 1-8
def monthly_recap(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.aggregate(s, ["year", "month", "month_name"], ["trx", "qty", "revenue", "profit"],
                     names={"trx": "total_trx", "qty": "total_qty", "revenue": "total_revenue",
                            "profit": "total_profit"})
    df = df.withColumn("margin_pct", margin_pct("total_profit", "total_revenue"))
    return edge(df.orderBy("year", "month"))


def top_products(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.aggregate(s, _ident(p, "product.product_key", ["product_name", "category", "brand"]),
                     ["qty", "revenue", "profit"],
                     names={"qty": "total_sold", "revenue": "total_revenue", "profit": "total_profit"})
    return edge(df.orderBy(_d("total_sold"), _a("product_name"), _a("category"), _a("brand")).limit(p.top_n))


def _ident(p: CatalogueParams, key: str, names: list[str]) -> list[str]:
    """Identity by name (reference) or by surrogate key."""
    return ([key] if p.by_key else []) + names


def store_revenue(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.aggregate(s, _ident(p, "store.store_key", ["store_name", "city", "province"]), ["trx", "revenue", "profit"],
                     names={"trx": "total_trx", "revenue": "total_revenue", "profit": "total_profit"})
    return edge(df.orderBy(_d("total_revenue")))


def campaign_effect(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.aggregate(s, ["campaign_name", "campaign_type", "channel"], ["trx", "discount", "revenue"],
                     where={"campaign_id": lambda c: c != F.lit(p.no_promo)},
                     names={"trx": "promo_trx", "discount": "total_discount", "revenue": "promo_revenue"})
    df = df.withColumn("roi_ratio", ratio("promo_revenue", "total_discount"))
    return edge(df.orderBy(_d("promo_revenue")))


def customer_segments(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.aggregate(s, ["membership_level", "age_group", "gender"], ["trx", "revenue", "lines"],
                     names={"trx": "total_trx", "revenue": "total_spent"})
    df = df.withColumn("avg_line_value", avg_line_value("total_spent", "lines")).drop("lines")
    return edge(df.orderBy(_d("total_spent")))


def payment_share(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.aggregate(s, ["payment_method", "payment_type"], ["trx", "revenue"],
                     names={"trx": "total_trx", "revenue": "total_revenue"})
    df = H.share_of_total(df, "total_revenue", "pct_share", groups_bound=s.bounds.get("payment"))
    return edge(df.orderBy(_d("total_revenue")))


def top_suppliers(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.aggregate(s, ["supplier_name", "supplier_city", "supplier_category"], ["qty", "revenue", "profit"],
                     names={"qty": "total_units", "revenue": "total_revenue", "profit": "total_profit"})
    return edge(df.orderBy(_d("total_revenue"), _a("supplier_name"), _a("supplier_city"),
                           _a("supplier_category")).limit(p.top_n))


def category_quarter(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.aggregate(s, ["year", "quarter", "category"], ["revenue", "profit"], names={})
    return edge(df.orderBy("year", "quarter", _d("revenue")))


# ====================================================== cube queries 9-15
def rollup_time(s: Star, p: CatalogueParams) -> DataFrame:
    # Roll up on the month number and look the name up afterwards.
    df = O.grouped(s, ["year", "quarter", "month"], ["trx", "qty", "revenue", "profit"], "rollup",
                   names={"trx": "total_trx", "qty": "total_qty", "revenue": "total_revenue",
                          "profit": "total_profit"})
    df = (df.withColumn("year_label", F.when(F.col("g_year") == 1, F.lit(LABELS["rollup_time"][0]))
                        .otherwise(F.col("year").cast("string")))
            .withColumn("quarter_label", F.when(F.col("g_quarter") == 1, F.lit(LABELS["rollup_time"][1]))
                        .otherwise(F.col("quarter").cast("string")))
            .withColumn("month_label", F.when(F.col("g_month") == 1, F.lit(LABELS["rollup_time"][2]))
                        .otherwise(_month_name(F.col("month"))))
            .withColumn("margin_pct", margin_pct("total_profit", "total_revenue")))
    df = _ordered_labels(df, ["year", "quarter", "month"], ["year", "quarter", "month_name"],
                         ["total_trx", "total_qty", "total_revenue", "total_profit", "margin_pct"])
    return edge(df)


def rollup_geo(s: Star, p: CatalogueParams) -> DataFrame:
    keys = ["region", "province", "city", "store_name"]
    df = O.roll_up(s, keys, ["trx", "revenue", "profit"],
                   LABELS["rollup_geo"],
                   names={"trx": "total_trx", "revenue": "total_revenue", "profit": "total_profit"})
    return edge(_ordered_labels(df, keys, keys, ["total_trx", "total_revenue", "total_profit"]))


def rollup_product(s: Star, p: CatalogueParams) -> DataFrame:
    keys = ["category", "brand", "product_name"]
    df = O.roll_up(s, keys, ["qty", "revenue", "profit"],
                   LABELS["rollup_product"],
                   names={"qty": "total_qty", "revenue": "total_revenue", "profit": "total_profit"})
    return edge(_ordered_labels(df, keys, keys, ["total_qty", "total_revenue", "total_profit"],
                                last_order=_d("total_revenue")))


def cube_cat_region_q(s: Star, p: CatalogueParams) -> DataFrame:
    keys = ["category", "region", "quarter"]
    df = O.cube_report(s, keys, ["trx", "qty", "revenue", "profit", "lines"],
                       LABELS["cube_cat_region_q"],
                       names={"trx": "total_trx", "qty": "total_qty", "revenue": "total_revenue",
                              "profit": "total_profit"})
    df = df.withColumn("avg_line_value", avg_line_value("total_revenue", "lines"))
    return edge(_ordered_labels(df, keys, keys, ["total_trx", "total_qty", "total_revenue",
                                                 "total_profit", "avg_line_value"]))


def cube_member_payment(s: Star, p: CatalogueParams) -> DataFrame:
    keys = ["membership_level", "payment_method"]
    df = O.cube_report(s, keys, ["trx", "revenue", "lines", "profit"], LABELS["cube_member_payment"],
                       names={"trx": "total_trx", "revenue": "total_revenue", "profit": "total_profit"})
    df = df.withColumn("avg_line_value", avg_line_value("total_revenue", "lines"))
    return edge(_ordered_labels(df, keys, keys, ["total_trx", "total_revenue", "avg_line_value",
                                                 "total_profit"]))


def gsets_single(s: Star, p: CatalogueParams) -> DataFrame:
    keys = ["category", "region", "quarter"]
    df = O.grouping_report(s, keys, [["category"], ["region"], ["quarter"], []], ["trx", "revenue", "profit"],
                           list(zip([["category"], ["region"], ["quarter"]], LABELS["gsets_single"])),
                           LABELS["gsets_single"][3], "report_type",
                           names={"trx": "total_trx", "revenue": "total_revenue", "profit": "total_profit"})
    df = df.orderBy("report_type", _d("total_revenue"))
    return edge(df.select("report_type", *[F.col(f"{k}_label").alias(k) for k in keys],
                          "total_trx", "total_revenue", "total_profit"))


def gsets_pairs(s: Star, p: CatalogueParams) -> DataFrame:
    keys = ["category", "region", "quarter"]
    df = O.grouping_report(s, keys, [["category", "region"], ["category", "quarter"], ["region", "quarter"]],
                           ["revenue", "profit"],
                           list(zip([["category", "region"], ["category", "quarter"], ["region", "quarter"]],
                                    LABELS["gsets_pairs"])), LABELS["gsets_pairs"][3], "analysis_type",
                           names={"revenue": "total_revenue", "profit": "total_profit"})
    df = df.orderBy("analysis_type", _d("total_revenue"))
    return edge(df.select("analysis_type", *[F.col(f"{k}_label").alias(k) for k in keys],
                          "total_revenue", "total_profit"))


# ====================================================== OLAP operations 16-37
_RPQ = {"revenue": "total_revenue", "profit": "total_profit", "qty": "total_qty"}
TIME = ("year", "quarter", "month", "full_date")
GEO = ("region", "province", "city", "store_name")


def drill_year(s: Star, p: CatalogueParams) -> DataFrame:
    return edge(O.drill_down(s, TIME, 0, None, ["revenue", "profit", "qty"], names=_RPQ).orderBy("year"))


def drill_quarter(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.drill_down(s, TIME, 1, {"year": p.year}, ["revenue", "profit", "qty"], names=_RPQ)
    return edge(df.orderBy("quarter"))


def drill_month(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.drill_down(s, TIME, 2, {"year": p.year, "quarter": p.quarter}, ["revenue", "profit", "qty"],
                      carry=["month_name"], names=_RPQ)
    return edge(df.select("year", "quarter", "month", "month_name", *_RPQ.values()).orderBy("month"))


def drill_day(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.aggregate(s, ["full_date", "day_name"], ["revenue", "profit", "qty"],
                     {"year": p.year, "month": p.month}, names=_RPQ)
    return edge(df.orderBy("full_date"))


def drill_region(s: Star, p: CatalogueParams) -> DataFrame:
    return edge(O.drill_down(s, GEO, 0, None, ["revenue"]).orderBy(_d("revenue")))


def drill_province(s: Star, p: CatalogueParams) -> DataFrame:
    return edge(O.drill_down(s, GEO, 1, {"region": p.drill_region}, ["revenue"]).orderBy(_d("revenue")))


def drill_city(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.aggregate(s, ["province", "city"], ["revenue"], {"province": p.drill_province})
    return edge(df.orderBy(_d("revenue")))


def drill_store(s: Star, p: CatalogueParams) -> DataFrame:
    # The reference drills to stores of a city without its province.
    df = O.aggregate(s, _ident(p, "store.store_key", ["city", "store_name"]), ["revenue"], {"city": p.drill_city})
    return edge(df.orderBy(_d("revenue")))


def rollup_geo3(s: Star, p: CatalogueParams) -> DataFrame:
    keys = ["region", "province", "city"]
    df = O.roll_up(s, keys, ["revenue", "profit", "trx"],
                   LABELS["rollup_geo3"],
                   names={"revenue": "total_revenue", "profit": "total_profit", "trx": "total_trx"})
    return edge(_ordered_labels(df, keys, keys, ["total_revenue", "total_profit", "total_trx"]))


def rollup_prod2(s: Star, p: CatalogueParams) -> DataFrame:
    keys = ["category", "brand"]
    df = O.roll_up(s, keys, ["qty", "revenue", "profit"], LABELS["rollup_prod2"],
                   names={"qty": "total_qty", "revenue": "total_revenue", "profit": "total_profit"})
    return edge(_ordered_labels(df, keys, keys, ["total_qty", "total_revenue", "total_profit"]))


def slice_quarter(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.slice_(s, "quarter", p.quarter, ["category", "region"], ["revenue", "profit", "qty"],
                  where={"year": p.year}, names=_RPQ)
    return edge(df.orderBy(_d("total_revenue")))


def slice_category(s: Star, p: CatalogueParams) -> DataFrame:
    # Month is a hidden grouping/sort key.
    df = O.slice_(s, "category", p.slice_category, ["month_name", "month", "region", "membership_level"],
                  ["revenue", "qty"], names=_RPQ)
    df = df.orderBy("month", _d("total_revenue"))
    return edge(df.select("month_name", "region", "membership_level", "total_revenue", "total_qty"))


def slice_region(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.slice_(s, "region", p.slice_region, ["quarter", "category"], ["revenue", "profit"], names=_RPQ)
    return edge(df.orderBy("quarter", _d("total_revenue")))


def slice_membership(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.slice_(s, "membership_level", p.slice_membership,
                  ["month_name", "month", "category", "payment_method"], ["revenue", "qty"], names=_RPQ)
    df = df.orderBy("month", _d("total_revenue"))
    return edge(df.select("month_name", "category", "payment_method", "total_revenue", "total_qty"))


def dice_cat_region_q(s: Star, p: CatalogueParams) -> DataFrame:
    # Quarters of every year, as the reference filters only quarters.
    df = O.dice(s, {"category": list(p.dice_categories), "region": p.dice_region,
                    "quarter": list(p.dice_quarters)},
                ["quarter", "category", "city"], ["revenue", "qty", "profit"], names=_RPQ)
    return edge(df.orderBy("quarter", "category", _d("total_revenue")))


def dice_member_payment(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.dice(s, {"membership_level": list(p.dice_levels), "payment_method": list(p.dice_methods)},
                ["membership_level", "payment_method", "category"], ["revenue", "trx", "lines"],
                names={"revenue": "total_revenue", "trx": "total_trx"})
    df = df.withColumn("avg_line_value", avg_line_value("total_revenue", "lines")).drop("lines")
    return edge(df.orderBy("membership_level", _d("total_revenue")))


def dice_weekend_city(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.dice(s, {"is_weekend": True, "city": list(p.dice_cities)},
                ["day_name", "day_of_week", "city", "category"], ["revenue", "qty"], names=_RPQ)
    df = df.orderBy("day_of_week", "city", _d("total_revenue"))
    return edge(df.select("day_name", "city", "category", "total_revenue", "total_qty"))


def pivot_cat_quarter(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.pivot(s, ["category"], "quarter", list(p.pivot_quarters), "revenue", {"year": p.year},
                 names=[f"Q{q}" for q in p.pivot_quarters])
    return edge(df.orderBy(_d("Total")))


def pivot_region_payment(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.pivot(s, ["region"], "payment_method", list(p.pivot_methods), "revenue")
    return edge(df.orderBy(_d("Total")))


def pivot_member_category(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.pivot(s, ["membership_level"], "category", list(p.pivot_categories), "qty")
    return edge(df.orderBy(_d("Total")))


def pivot_month_region(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.pivot(s, ["month_name"], "region", list(p.pivot_regions), "profit", {"year": p.year},
                 hidden=["month"])
    return edge(df.orderBy("month").drop("month"))


def pivot_age_gender(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.pivot(s, ["age_group"], "gender", list(p.pivot_genders), "trx")
    return edge(df.orderBy(_d("Total")))


# ====================================================== historical analysis 38-51
_YM = ["year", "month"]


def _monthly(s: Star, measures, where=None, names=None, dense: bool = False) -> DataFrame:
    df = O.aggregate(s, ["year", "month", "month_name"], measures, where, names)
    if dense:
        periods = s.dims["time"].select("year", "month", "month_name").distinct()
        fill = [(names or {}).get(m, m) for m in measures]
        df = H.densify(df, periods, ["year", "month", "month_name"], fill,
                       F.col("year") * 100 + F.col("month"))
    return df


def trend_ma3(s: Star, p: CatalogueParams) -> DataFrame:
    df = _monthly(s, ["revenue", "profit"], names={"revenue": "monthly_revenue", "profit": "monthly_profit"},
                  dense=p.dense)
    df = (df.withColumn("moving_avg_3m", H.moving_average("monthly_revenue", _YM))
            .withColumn("profit_moving_avg_3m", H.moving_average("monthly_profit", _YM)))
    return edge(df.select("year", "month", "month_name", "monthly_revenue", "moving_avg_3m",
                          "monthly_profit", "profit_moving_avg_3m").orderBy(*_YM))


def weekly_trend(s: Star, p: CatalogueParams) -> DataFrame:
    # (calendar year, ISO week); week_start is the first *sale* date.
    year = "iso_year" if p.week_basis == "iso" else "year"
    df = O.aggregate(s, [year, "week_of_year"], ["first_date", "revenue", "qty", "trx"],
                     names={"first_date": "week_start", "revenue": "weekly_revenue", "qty": "weekly_qty",
                            "trx": "weekly_trx"})
    return edge(df.withColumnRenamed(year, "year").orderBy("year", "week_of_year"))


def mom_growth(s: Star, p: CatalogueParams) -> DataFrame:
    df = _monthly(s, ["revenue"], names={"revenue": "current_revenue"}, dense=p.dense)
    df = H.with_growth(df, "current_revenue", _YM, "prev_month_revenue", "mom_growth_pct")
    return edge(df.orderBy(*_YM))


def qoq_growth(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.aggregate(s, ["year", "quarter"], ["revenue", "profit"],
                     names={"revenue": "current_revenue", "profit": "current_profit"})
    if p.dense:
        df = H.densify(df, s.dims["time"].select("year", "quarter").distinct(), ["year", "quarter"],
                       ["current_revenue", "current_profit"], F.col("year") * 10 + F.col("quarter"))
    df = H.with_growth(df, "current_revenue", ["year", "quarter"], "prev_quarter_revenue", "qoq_growth_pct")
    df = df.withColumn("prev_quarter_profit", H.previous("current_profit", ["year", "quarter"]))
    return edge(df.select("year", "quarter", "current_revenue", "prev_quarter_revenue", "qoq_growth_pct",
                          "current_profit", "prev_quarter_profit").orderBy("year", "quarter"))


def ytd_revenue(s: Star, p: CatalogueParams) -> DataFrame:
    df = _monthly(s, ["revenue", "profit"], names={"revenue": "monthly_revenue", "profit": "monthly_profit"},
                  dense=p.dense)
    df = (df.withColumn("ytd_revenue", H.running_total("monthly_revenue", ["year"], ["month"]))
            .withColumn("ytd_profit", H.running_total("monthly_profit", ["year"], ["month"])))
    return edge(df.select("year", "month", "month_name", "monthly_revenue", "ytd_revenue",
                          "monthly_profit", "ytd_profit").orderBy(*_YM))


def ytd_transactions(s: Star, p: CatalogueParams) -> DataFrame:
    # The YTD of monthly distinct counts equals the YTD distinct count
    # because a transaction has exactly one date.
    df = _monthly(s, ["trx", "qty"], names={"trx": "monthly_trx", "qty": "monthly_qty"}, dense=p.dense)
    df = (df.withColumn("ytd_trx", H.running_total("monthly_trx", ["year"], ["month"]))
            .withColumn("ytd_qty", H.running_total("monthly_qty", ["year"], ["month"])))
    return edge(df.select("year", "month", "month_name", "monthly_trx", "ytd_trx",
                          "monthly_qty", "ytd_qty").orderBy(*_YM))


def product_rank_quarter(s: Star, p: CatalogueParams) -> DataFrame:
    # Rank first, then LAG of the rank by product name (two steps). The
    # grain also has category, so category breaks ties in the LAG order.
    ident = ["product_key"] if p.by_key else ["product_name"]
    df = O.aggregate(s, ["year", "quarter"] + _ident(p, "product.product_key", ["product_name", "category"]),
                     ["revenue"])
    df = H.rank_desc(df, ["year", "quarter"], "revenue", "rank_in_quarter")
    df = df.withColumn("prev_quarter_rank",
                       H.previous("rank_in_quarter", ["year", "quarter", "category"], partition=ident))
    return edge(df.select("year", "quarter", *(["product_key"] if p.by_key else []), "product_name", "category",
                          "revenue", "rank_in_quarter", "prev_quarter_rank").orderBy("year", "quarter", _d("revenue")))


def store_rank_month(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.aggregate(s, ["year", "month", "month_name"] + _ident(p, "store.store_key", ["store_name", "city"]),
                     ["revenue"])
    df = H.rank_desc(df, ["year", "month"], "revenue", "monthly_rank")
    return edge(df.select("year", "month", "month_name", *(["store_key"] if p.by_key else []), "store_name",
                          "city", "revenue", "monthly_rank")
                .orderBy("year", "month", _d("revenue")))


def category_contribution(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.aggregate(s, ["year", "month", "month_name", "category"], ["revenue"],
                     names={"revenue": "category_revenue"})
    df = H.share_of_total(df, "category_revenue", "pct_contribution", partition=["year", "month"],
                          total_out="total_month_revenue", groups_bound=s.bounds.get("time"))
    return edge(df.select("year", "month", "month_name", "category", "category_revenue",
                          "total_month_revenue", "pct_contribution")
                .orderBy("year", "month", F.col("pct_contribution").desc_nulls_first()))


def weekday_pattern(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.aggregate(s, ["day_name", "day_of_week"], ["trx", "revenue", "qty", "lines"],
                     names={"trx": "total_trx", "revenue": "total_revenue", "qty": "total_qty"})
    df = df.withColumn("avg_line_value", avg_line_value("total_revenue", "lines"))
    return edge(df.select("day_name", "day_of_week", "total_trx", "avg_line_value", "total_revenue",
                          "total_qty").orderBy("day_of_week"))


def weekend_vs_weekday(s: Star, p: CatalogueParams) -> DataFrame:
    # A transaction has one date, so its day's distinct count adds up: one
    # distinct count instead of two over every fact row.
    days = O.aggregate(s, ["full_date", "is_weekend"], ["trx", "revenue"])
    df = days.groupBy("is_weekend").agg(F.count(F.lit(1)).alias("total_days"), F.sum("trx").alias("total_trx"),
                                        F.sum("revenue").alias("total_revenue"))
    df = (df.withColumn("day_type", weekend_label(F.col("is_weekend")))
            .withColumn("avg_trx_per_day", ratio("total_trx", "total_days"))
            .withColumn("avg_revenue_per_day", ratio("total_revenue", "total_days")))
    return edge(df.select("day_type", "total_days", "total_trx", "avg_trx_per_day", "total_revenue",
                          "avg_revenue_per_day"))


def seasonality_index(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.aggregate(s, ["month", "month_name"], ["revenue"], {"year": p.year},
                     names={"revenue": "monthly_revenue"})
    if p.dense:
        months = s.dims["time"].where(F.col("year") == p.year).select("month", "month_name").distinct()
        df = H.densify(df, months, ["month", "month_name"], ["monthly_revenue"], F.col("month"))
    df = H.ratio_to_mean(df, "monthly_revenue", "seasonality_index", mean_out="avg_monthly")
    return edge(df.select("month", "month_name", "monthly_revenue", "avg_monthly", "seasonality_index")
                .orderBy("month"))


def margin_trend(s: Star, p: CatalogueParams) -> DataFrame:
    df = _monthly(s, ["revenue", "cost", "profit"],
                  names={"revenue": "revenue", "cost": "total_cost", "profit": "gross_profit"}, dense=p.dense)
    df = (df.withColumn("gross_margin_pct", margin_pct("gross_profit", "revenue"))
            .withColumn("margin_moving_avg_3m", H.moving_average(
                as_double("gross_profit") / F.nullif(as_double("revenue"), F.lit(0.0)) * F.lit(100), _YM)))
    return edge(df.orderBy(*_YM))


def category_margin(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.aggregate(s, ["quarter", "category"], ["revenue", "profit", "qty"], {"year": p.year},
                     names={"qty": "qty_sold"})
    df = df.withColumn("margin_pct", margin_pct("profit", "revenue"))
    return edge(df.select("quarter", "category", "revenue", "profit", "margin_pct", "qty_sold")
                .orderBy("quarter", F.col("margin_pct").desc_nulls_first()))


# ====================================================== summaries 52-56
def mv_monthly_sales(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.aggregate(s, ["year", "month", "month_name", "quarter"],
                     ["trx", "qty", "revenue", "profit", "cost", "discount", "lines"],
                     names={"trx": "total_trx", "qty": "total_qty", "revenue": "total_revenue",
                            "profit": "total_profit", "cost": "total_cost", "discount": "total_discount"})
    df = (df.withColumn("margin_pct", margin_pct("total_profit", "total_revenue"))
            .withColumn("avg_line_value", avg_line_value("total_revenue", "lines")).drop("lines"))
    return edge(df.orderBy("year", "month"))


def mv_category_region(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.aggregate(s, ["category", "region", "year", "quarter"], ["qty", "revenue", "profit", "trx"],
                     names={"qty": "total_qty", "revenue": "total_revenue", "profit": "total_profit",
                            "trx": "total_trx"})
    return edge(df.orderBy("category", "region", "year", "quarter"))


def mv_customer_segment(s: Star, p: CatalogueParams) -> DataFrame:
    # A transaction has one customer and one date: counts by customer and
    # quarter add up, and the customers are the rows.
    keys = ["membership_level", "age_group", "gender", "year", "quarter"]
    each = O.aggregate(s, ["customer.customer_key", *keys], ["trx", "revenue", "lines", "profit"])
    df = each.groupBy(*keys).agg(F.count(F.lit(1)).alias("unique_customers"), F.sum("trx").alias("total_trx"),
                                 F.sum("revenue").alias("total_revenue"), F.sum("lines").alias("lines"),
                                 F.sum("profit").alias("total_profit"))
    df = df.withColumn("avg_line_value", avg_line_value("total_revenue", "lines")).drop("lines")
    return edge(df)


def mv_store_performance(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.aggregate(s, ["store.store_key", "store_name", "store_type", "city", "province", "region",
                         "year", "month"], ["trx", "qty", "revenue", "profit"],
                     names={"trx": "total_trx", "qty": "total_qty", "revenue": "total_revenue",
                            "profit": "total_profit"})
    df = df.withColumn("margin_pct", margin_pct("total_profit", "total_revenue"))
    return edge(df)


def mv_promotion_effectiveness(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.aggregate(s, ["campaign_id", "campaign_name", "campaign_type", "channel", "target_segment"],
                     ["trx", "discount", "revenue", "profit"],
                     where={"campaign_id": lambda c: c != F.lit(p.no_promo)},
                     names={"trx": "total_trx_with_promo", "discount": "total_discount_given",
                            "revenue": "revenue_from_promo", "profit": "profit_from_promo"})
    df = df.withColumn("roi_ratio", ratio("revenue_from_promo", "total_discount_given"))
    return edge(df)


# ====================================================== dashboard cards 57-61
def card_total_revenue(s: Star, p: CatalogueParams) -> DataFrame:
    return edge(O.aggregate(s, [], ["revenue"], {"year": p.year}, names={"revenue": "total_revenue"}))


def card_city_revenue(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.aggregate(s, ["city"], ["revenue"], names={"revenue": "total_revenue"})
    return edge(df.orderBy(_d("total_revenue")))


def card_product_qty(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.aggregate(s, ["product_name"], ["qty"], names={"qty": "total_qty"})
    return edge(df.orderBy(_d("total_qty"), _a("product_name")).limit(p.top_n))


def card_membership(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.aggregate(s, ["membership_level"], ["revenue"], names={"revenue": "total_revenue"})
    return edge(df.orderBy(_d("total_revenue")))


def card_campaign(s: Star, p: CatalogueParams) -> DataFrame:
    df = O.aggregate(s, ["campaign_name"], ["revenue"], names={"revenue": "total_revenue"})
    return edge(df.orderBy(_d("total_revenue")))


# ====================================================== audits on the star (Q1-Q3, Q5)
def audit_star_integrity(s: Star, p: CatalogueParams) -> DataFrame:
    """Q1 unique surrogate keys, Q2 NOT NULL full_date, Q3 fact keys present
    in their dimension, one current row per campaign: violations per check."""
    from ..operators.quality import star_audit_counts
    return star_audit_counts(s.tables())


def audit_product_hierarchy(s: Star, p: CatalogueParams) -> DataFrame:
    """Q5: brands that sit under more than one category (and product names
    under more than one brand, T18)."""
    from ..operators.quality import hierarchy_violations
    prod = s.dims["product"]
    a = hierarchy_violations(prod, "brand", "category").select(
        F.lit("brand->category").alias("level"), F.col("brand").alias("child"), "parents")
    b = hierarchy_violations(prod, "product_name", "brand").select(
        F.lit("product_name->brand").alias("level"), F.col("product_name").alias("child"), "parents")
    return a.unionByName(b)


def audit_geo_hierarchy(s: Star, p: CatalogueParams) -> DataFrame:
    """Q5 on the store geography, one row per level: children checked and
    children under more than one parent (city -> province -> region)."""
    st = s.dims["store"]
    out = None
    for child, parent in (("city", "province"), ("province", "region")):
        per_child = st.groupBy(child).agg(F.count_distinct(parent).alias("parents"))
        one = per_child.agg(F.count(F.lit(1)).alias("children"),
                            F.count(F.when(F.col("parents") > 1, True)).alias("violations"))
        one = one.select(F.lit(f"{child}->{parent}").alias("level"), "children", "violations")
        out = one if out is None else out.unionByName(one)
    return out


# The reference's column aliases where they differ from ours
# (``reference_names=True``), per query.
REFERENCE_NAMES: dict[str, dict[str, str]] = {
    "monthly_recap": {"total_trx": "total_transaksi"},
    "top_products": {"total_sold": "total_terjual"},
    "store_revenue": {"total_trx": "total_transaksi"},
    "campaign_effect": {"promo_trx": "pakai_promo", "total_discount": "total_diskon",
                        "promo_revenue": "revenue_dari_promo"},
    "customer_segments": {"total_trx": "jumlah_transaksi", "total_spent": "total_belanja",
                          "avg_line_value": "avg_per_transaksi"},
    "payment_share": {"total_trx": "jumlah_transaksi"},
    "top_suppliers": {"total_units": "total_unit_terjual"},
    "rollup_time": {"total_trx": "total_transaksi"},
    "rollup_geo": {"total_trx": "total_transaksi"},
    "cube_cat_region_q": {"total_trx": "total_transaksi", "avg_line_value": "avg_per_transaksi"},
    "cube_member_payment": {"total_trx": "total_transaksi", "avg_line_value": "avg_transaction"},
    "gsets_single": {"total_trx": "total_transaksi"},
    "dice_member_payment": {"avg_line_value": "avg_transaction"},
    "weekday_pattern": {"total_trx": "avg_daily_trx", "avg_line_value": "avg_transaction_value"},
    "mv_monthly_sales": {"total_trx": "total_transaksi", "avg_line_value": "avg_transaction"},
    "mv_customer_segment": {"avg_line_value": "avg_transaction"},
}


def _with_reference_names(fn: Callable[[Star, CatalogueParams], DataFrame]):
    names = REFERENCE_NAMES.get(fn.__name__)
    if not names:
        return fn

    def run(s: Star, p: CatalogueParams) -> DataFrame:
        df = fn(s, p)
        return df.withColumnsRenamed(names) if p.reference_names else df

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


CATALOGUE: dict[str, Callable[[Star, CatalogueParams], DataFrame]] = {f.__name__: _with_reference_names(f) for f in (
    monthly_recap, top_products, store_revenue, campaign_effect, customer_segments, payment_share,
    top_suppliers, category_quarter,
    rollup_time, rollup_geo, rollup_product, cube_cat_region_q, cube_member_payment, gsets_single,
    gsets_pairs,
    drill_year, drill_quarter, drill_month, drill_day, drill_region, drill_province, drill_city,
    drill_store, rollup_geo3, rollup_prod2, slice_quarter, slice_category, slice_region,
    slice_membership, dice_cat_region_q, dice_member_payment, dice_weekend_city, pivot_cat_quarter,
    pivot_region_payment, pivot_member_category, pivot_month_region, pivot_age_gender,
    trend_ma3, weekly_trend, mom_growth, qoq_growth, ytd_revenue, ytd_transactions,
    product_rank_quarter, store_rank_month, category_contribution, weekday_pattern,
    weekend_vs_weekday, seasonality_index, margin_trend, category_margin,
    mv_monthly_sales, mv_category_region, mv_customer_segment, mv_store_performance,
    mv_promotion_effectiveness,
    card_total_revenue, card_city_revenue, card_product_qty, card_membership, card_campaign,
    audit_star_integrity, audit_product_hierarchy, audit_geo_hierarchy,
)}


# Catalogue index: item number of SURVEY §2.10 (audits: A1-A3) and title.
TITLES: dict[str, str] = {
    "monthly_recap": "1. monthly sales recap",
    "top_products": "2. top 10 products by quantity",
    "store_revenue": "3. revenue and profit per store",
    "campaign_effect": "4. campaign effectiveness and ROI",
    "customer_segments": "5. customer segments",
    "payment_share": "6. payment methods and revenue share",
    "top_suppliers": "7. top 10 suppliers by revenue",
    "category_quarter": "8. category revenue per quarter",
    "rollup_time": "9. ROLLUP year > quarter > month",
    "rollup_geo": "10. ROLLUP region > province > city > store",
    "rollup_product": "11. ROLLUP category > brand > product",
    "cube_cat_region_q": "12. CUBE category x region x quarter",
    "cube_member_payment": "13. CUBE membership x payment",
    "gsets_single": "14. GROUPING SETS single dimensions + total",
    "gsets_pairs": "15. GROUPING SETS pairs",
    "drill_year": "16. drill-down: years",
    "drill_quarter": "17. drill-down: quarters of a year",
    "drill_month": "18. drill-down: months of a quarter",
    "drill_day": "19. drill-down: days of a month",
    "drill_region": "20. drill-down: regions",
    "drill_province": "21. drill-down: provinces of a region",
    "drill_city": "22. drill-down: cities of a province",
    "drill_store": "23. drill-down: stores of a city",
    "rollup_geo3": "24. roll-up region > province > city",
    "rollup_prod2": "25. roll-up category > brand",
    "slice_quarter": "26. slice: one quarter",
    "slice_category": "27. slice: one category",
    "slice_region": "28. slice: one region",
    "slice_membership": "29. slice: one membership level",
    "dice_cat_region_q": "30. dice: categories x region x quarters",
    "dice_member_payment": "31. dice: levels x payment methods",
    "dice_weekend_city": "32. dice: weekends x cities",
    "pivot_cat_quarter": "33. pivot: category x quarter",
    "pivot_region_payment": "34. pivot: region x payment method",
    "pivot_member_category": "35. pivot: membership x category",
    "pivot_month_region": "36. pivot: month x region",
    "pivot_age_gender": "37. pivot: age group x gender",
    "trend_ma3": "38. monthly trend with 3-month moving averages",
    "weekly_trend": "39. weekly trend",
    "mom_growth": "40. month-over-month growth",
    "qoq_growth": "41. quarter-over-quarter growth",
    "ytd_revenue": "42. year-to-date revenue and profit",
    "ytd_transactions": "43. year-to-date transactions and quantity",
    "product_rank_quarter": "44. product rank per quarter and previous rank",
    "store_rank_month": "45. store rank per month",
    "category_contribution": "46. category share of monthly revenue",
    "weekday_pattern": "47. weekday pattern",
    "weekend_vs_weekday": "48. weekend vs weekday",
    "seasonality_index": "49. monthly seasonality index",
    "margin_trend": "50. margin trend with moving average",
    "category_margin": "51. category profitability per quarter",
    "mv_monthly_sales": "52. summary: monthly sales",
    "mv_category_region": "53. summary: category x region",
    "mv_customer_segment": "54. summary: customer segments",
    "mv_store_performance": "55. summary: store performance",
    "mv_promotion_effectiveness": "56. summary: promotion effectiveness",
    "card_total_revenue": "57. card: total revenue of a year",
    "card_city_revenue": "58. card: revenue per city",
    "card_product_qty": "59. card: top 10 products by name",
    "card_membership": "60. card: revenue per membership level",
    "card_campaign": "61. card: revenue per campaign",
    "audit_star_integrity": "A1. audit Q1-Q3: keys, NOT NULL, fact keys in dimensions",
    "audit_product_hierarchy": "A2. audit Q5: brand -> category, name -> brand",
    "audit_geo_hierarchy": "A3. audit Q5: city -> province -> region",
}
