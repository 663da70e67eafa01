"""Build the star from the eleven raw retail tables.

Load order (S15) is carried by DataFrame dependencies: dimensions, then the
fact that looks them up, then (optionally) the summaries.  Nothing passes
through the driver; every step is a Spark join, filter or aggregate.

Promotion fan-out (trap T1): the reference joins lines to promotion usage
on the transaction only, so a transaction that used k campaigns has every
line k times.  ``promo_policy`` selects

* ``"fanout"``   the reference's behaviour (default),
* ``"allocate"`` one row per campaign with money and quantity split over
                 the k campaigns, remainders on the first one, so totals stay exact,
* ``"first"``    only the lowest campaign_id.
"""

from __future__ import annotations

import datetime as dt
from typing import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import calendar, calendar_rows, calendar_span
from ..functions.keys import surrogate_key
from ..functions.labels import age_group
from ..operators.asof import as_of_join, version_intervals
from ..operators.scd2 import scd2_merge
from ..sources.schemas import NO_PROMO, PAYMENT_TYPES
from .star import FACT_PARTITION, Star

MONEY = T.DecimalType(15, 2)
SUCCESS = "Success"
FEW_ROWS = 200_000       # rows of campaign versions by month that are broadcast
PART_TRX = 50_000        # transactions of a part of the join of headers, campaigns and lines
CAMPAIGN_TRACKED = ("campaign_name", "campaign_type", "channel", "target_segment")   # a change opens a version (S12)


# ------------------------------------------------------------------ dimensions
def dim_product(products: DataFrame) -> DataFrame:
    return products.select(surrogate_key(products, "product_id").alias("product_key"), "product_id",
                           "product_name", "category", "brand", "unit_price", "cost_price", "product_status")


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select(surrogate_key(customers, "customer_id").alias("customer_key"), "customer_id",
                            "customer_name", "gender", "age", age_group(F.col("age")).alias("age_group"),
                            "city", "membership_level", "registration_date")


def dim_store(stores: DataFrame) -> DataFrame:
    return stores.select(surrogate_key(stores, "store_id").alias("store_key"), "store_id", "store_name",
                         "store_type", "city", "province", "region")


def dim_supplier(suppliers: DataFrame) -> DataFrame:
    return suppliers.select(surrogate_key(suppliers, "supplier_id").alias("supplier_key"), "supplier_id",
                            "supplier_name", "supplier_city", "supplier_category", "supplier_status")


def sentinel_promotion(spark: SparkSession) -> DataFrame:
    s = NO_PROMO
    return spark.createDataFrame(
        [(s["campaign_id"], s["campaign_name"], s["campaign_type"], s["channel"], s["target_segment"],
          s["effective_date"], s["expiry_date"], s["is_current"])],
        "campaign_id string, campaign_name string, campaign_type string, channel string, "
        "target_segment string, effective_date string, expiry_date string, is_current boolean",
    ).select("campaign_id", "campaign_name", "campaign_type", "channel", "target_segment",
             F.col("effective_date").cast("date"), F.col("expiry_date").cast("date"), "is_current")


def dim_promotion(spark: SparkSession, campaigns: DataFrame) -> DataFrame:
    """P2/P3 + S10/S11: campaigns with start/end renamed, all current, plus
    exactly one 'No Promotion' sentinel (inserted only if absent, T4)."""
    c = (campaigns.withColumnsRenamed({"start_date": "effective_date", "end_date": "expiry_date"})
         .select("campaign_id", "campaign_name", "campaign_type", "channel", "target_segment",
                 "effective_date", "expiry_date", F.lit(True).alias("is_current")))
    sentinel = sentinel_promotion(spark).join(c.select("campaign_id"), "campaign_id", "left_anti")
    d = c.unionByName(sentinel)
    return d.select(F.xxhash64("campaign_id", "effective_date").alias("promotion_key"), *d.columns)


def next_promotions(current: DataFrame, campaigns: DataFrame, load_date) -> DataFrame:
    """The versioned promotion dimension after a further load: changed
    campaigns close their version and open one on the load date, new campaigns
    open theirs, others (the sentinel among them) stay as they are."""
    return scd2_merge(current, campaigns, "campaign_id", CAMPAIGN_TRACKED, load_date)


def dim_payment_method(spark: SparkSession) -> DataFrame:
    """The inline five-row payment map."""
    return spark.createDataFrame([(i + 1, m, t) for i, (m, t) in enumerate(PAYMENT_TYPES)],
                                 "payment_key int, payment_method string, payment_type string")


def dimensions(spark: SparkSession, src: Mapping[str, DataFrame], start="2025-01-01", days=730,
               end=None) -> dict[str, DataFrame]:
    return {
        "time": calendar(spark, start, days, end),
        "product": dim_product(src["products"]),
        "customer": dim_customer(src["customers"]),
        "store": dim_store(src["stores"]),
        "supplier": dim_supplier(src["suppliers"]),
        "promotion": dim_promotion(spark, src["marketing_campaigns"]),
        "payment": dim_payment_method(spark),
    }


# ------------------------------------------------------------------ fact
def headers(src: Mapping[str, DataFrame]) -> DataFrame:
    """The Success transactions."""
    return (src["sales_transactions"].filter(F.col("transaction_status") == SUCCESS)
            .select("transaction_id", F.to_date("transaction_date").alias("transaction_date"), "store_id",
                    "customer_id", "payment_method"))


def campaigns_used(src: Mapping[str, DataFrame], promo_policy: str = "fanout", trx: DataFrame | None = None) -> DataFrame:
    """(transaction_id, campaign_id) under the fan-out policy, of the
    transactions ``trx`` if given (the join by transaction comes first, so the
    rows are not shuffled again to drop repeated ones)."""
    promo = src["promotion_usage"].select("transaction_id", "campaign_id")
    if trx is not None:
        promo = promo.join(trx.select("transaction_id"), "transaction_id", "left_semi")
    promo = promo.distinct()
    if promo_policy == "first":
        return promo.groupBy("transaction_id").agg(F.min("campaign_id").alias("campaign_id"))
    if promo_policy == "allocate":
        # campaigns per transaction: a handful, so these windows stay small
        w = Window.partitionBy("transaction_id").orderBy("campaign_id")
        return (promo.withColumn("__k", F.count(F.lit(1)).over(Window.partitionBy("transaction_id")))
                     .withColumn("__i", F.row_number().over(w)))
    if promo_policy != "fanout":
        raise ValueError(f"promo_policy must be fanout, allocate or first, not {promo_policy!r}")
    return promo


def with_campaigns(df: DataFrame, promo: DataFrame) -> DataFrame:
    """A row for each campaign of the transaction, NO_PROMO when none."""
    df = df.join(promo, "transaction_id", "left")
    return df.withColumn("campaign_id", F.coalesce(F.col("campaign_id"), F.lit(NO_PROMO["campaign_id"])))


def success_lines(src: Mapping[str, DataFrame], promo_policy: str = "fanout") -> DataFrame:
    """J1 (detail x Success transaction), S4, J2 and P6: the campaign of
    each line under the chosen fan-out policy."""
    df = src["sales_transaction_details"].join(headers(src), "transaction_id", "inner")
    return with_campaigns(df, campaigns_used(src, promo_policy))


def costed_lines(src: Mapping[str, DataFrame], trx: DataFrame) -> DataFrame:
    """J1 continued: the lines of ``trx``, each once, with product cost and
    supplier (S3: three product columns)."""
    prods = src["products"].select("product_id", "cost_price", "supplier_id")
    lines = src["sales_transaction_details"].select(
        "transaction_id", "detail_id", "product_id", "quantity", "unit_price", "discount_per_item", "subtotal")
    return lines.join(trx.select("transaction_id"), "transaction_id", "left_semi").join(prods, "product_id", "inner")


def _split(x: DataFrame, col: str, scale: int) -> F.Column:
    """Share of ``col`` for campaign i of k; the first takes the remainder."""
    k, i = F.coalesce(F.col("__k"), F.lit(1)), F.coalesce(F.col("__i"), F.lit(1))
    if scale == 0:
        part = F.floor(F.col(col) / k).cast("int")
        return F.when(i == 1, F.col(col) - part * (k - 1)).otherwise(part)
    part = F.round(F.col(col) / k, scale).cast(MONEY)
    return F.when(i == 1, (F.col(col) - part * (k - 1)).cast(MONEY)).otherwise(part)


def fact(src: Mapping[str, DataFrame], dims: Mapping[str, DataFrame], promo_policy: str = "fanout",
         span: tuple | None = None, few_versions: bool = False, n_trx: int = 0) -> DataFrame:
    """J3 + P4: surrogate-key lookups (inner: unmatched lines are reported by
    ``quality.fact_orphans`` instead) and the five measures.  Date, payment,
    customer and store belong to the header and are looked up there.  The
    campaigns and their versions in force on the day of the sale (S5, S12) are
    the header's too: it is fanned out by them, and meets the lines, which have
    their cost and supplier by then, in one join by transaction at the end.  So
    no join but that one carries a line more than once, and its rows lie by
    transaction.  ``span`` are the first and last day of the calendar, read
    from it if not given; ``few_versions`` tells that the promotion dimension
    is proven small, and ``n_trx`` how many transactions there are: the join by
    transaction is cut into parts of ``PART_TRX``, since a part of the shuffle
    is multiplied there and its memory does not follow from its bytes."""
    first, last = span or dims["time"].agg(F.min("full_date"), F.max("full_date")).first()
    look = {
        "time": (dims["time"].select("time_key", F.col("full_date").alias("transaction_date")), "transaction_date"),
        "customer": (dims["customer"].select("customer_key", "customer_id"), "customer_id"),
        "store": (dims["store"].select("store_key", "store_id"), "store_id"),
        "supplier": (dims["supplier"].select("supplier_key", "supplier_id"), "supplier_id"),
        "payment": (dims["payment"].select("payment_key", "payment_method"), "payment_method"),
    }
    trx = headers(src)
    for name in ("payment", "time", "customer", "store"):
        lk, nk = look[name]
        # The calendar and the payment map have fixed sizes; other lookups
        # are left to AQE's runtime size check.
        trx = trx.join(F.broadcast(lk) if name in ("time", "payment") else lk, nk, "inner")
    if n_trx > PART_TRX:
        trx = trx.repartition(-(-n_trx // PART_TRX), "transaction_id")
    trx = with_campaigns(trx, campaigns_used(src, promo_policy, headers(src)))
    versions = dims["promotion"].select("promotion_key", "campaign_id", "effective_date")
    trx = as_of_join(trx, version_intervals(versions, "campaign_id", first=first, last=last),
                     "campaign_id", "transaction_date", ["promotion_key"], few=few_versions)
    df = costed_lines(src, headers(src))
    # The product key is a function of product_id and the lines were already
    # joined to the products table, so no second product lookup (no shuffle).
    df = df.withColumn("product_key", surrogate_key(df, "product_id"))
    df = df.join(look["supplier"][0], look["supplier"][1], "inner").join(trx, "transaction_id", "inner")

    qty = F.col("quantity")
    measures = {
        "cost_amount": (F.col("cost_price") * qty).cast(MONEY),
        "total_sales": (F.col("unit_price") * qty).cast(MONEY),
        "discount_amount": (F.col("discount_per_item") * qty).cast(MONEY),
        "final_sales": F.col("subtotal").cast(MONEY),
    }
    df = df.withColumns(measures)
    if promo_policy == "allocate":
        df = df.withColumns({c: _split(df, c, 2) for c in measures} | {"quantity": _split(df, "quantity", 0)})
    df = df.withColumn("gross_profit", (F.col("final_sales") - F.col("cost_amount")).cast(MONEY))
    return df.select(
        "time_key", "product_key", "customer_key", "store_key", "promotion_key", "supplier_key",
        "payment_key", "transaction_id", "detail_id", F.col("quantity").alias("quantity_sold"),
        F.col("unit_price").cast(MONEY).alias("unit_price"), "discount_amount", "total_sales",
        "final_sales", "cost_amount", "gross_profit",
        F.year("transaction_date").alias(FACT_PARTITION))


def sale_dates(src: Mapping[str, DataFrame]) -> tuple:
    """First and last date of the Success transactions, and how many these are (one row)."""
    return headers(src).agg(F.min("transaction_date"), F.max("transaction_date"), F.count(F.lit(1))).first()


def build_star(spark: SparkSession, src: Mapping[str, DataFrame], calendar_start=None,
               calendar_days: int | None = 730, calendar_end=None, promo_policy: str = "fanout",
               promotions: DataFrame | None = None) -> Star:
    """The whole load (lazy): dimensions, then the fact over them.

    ``promotions`` is a promotion dimension with history (``next_promotions``);
    without it every campaign has one version, the row of the source.

    The calendar covers all sales unless ``calendar_start`` is given; sales
    outside a given range are dropped and listed by ``quality.fact_orphans``."""
    lo, hi, n_trx = sale_dates(src)
    if calendar_start is None:
        if lo is not None:
            calendar_start, calendar_end = lo, calendar_end or hi
        else:
            calendar_start = "2025-01-01"
    dims = dimensions(spark, src, calendar_start, calendar_days, calendar_end)
    if promotions is not None:
        dims["promotion"] = promotions
    bounds = {"time": calendar_rows(calendar_start, calendar_days, calendar_end),
              "payment": len(PAYMENT_TYPES)}
    # date, store, customer and payment come from the transaction header; the
    # campaign is single-valued only when one campaign is kept per transaction
    trx_level = {"time", "customer", "store", "payment"} | ({"promotion"} if promo_policy == "first" else set())
    span = calendar_span(calendar_start, calendar_days, calendar_end)
    # versions are counted first: their join with the sales is then no shuffle of all sales
    bounds["promotion"] = dims["promotion"].count()
    return Star(fact(src, dims, promo_policy, span, few_versions(bounds["promotion"], span), n_trx), dims, bounds,
                trx_level=frozenset(trx_level))


def few_versions(n: int, span: tuple) -> bool:
    """Whether ``n`` versions, cut into the months of ``span``, stay a small table."""
    days = (dt.date.fromisoformat(str(span[1])[:10]) - dt.date.fromisoformat(str(span[0])[:10])).days
    return n * (days // 28 + 2) <= FEW_ROWS


def load_warehouse(spark: SparkSession, src: Mapping[str, DataFrame], out: str | None = None,
                   params=None, promo_policy: str = "fanout", publish: str | None = None,
                   previous: str | None = None, load_date=None, incremental: bool = True,
                   **calendar) -> tuple[Star, list, dict]:
    """The whole job of the reference's daily run (S15): build the star,
    write every table to a fresh folder (switch only when all are written,
    T15), refresh the five summaries with a status each (S14), optionally
    publish them as catalog tables of database ``publish``, and return the
    load counts (Q12).

    With ``previous``, the folder of the last load, the promotion dimension
    keeps its history: campaigns that changed since open a version on
    ``load_date`` (today if not given).  Where that load left its digests, only
    the transactions that changed are built again and the summaries take the
    difference; ``incremental=False`` builds everything anew."""
    from .catalogue import RETAIL
    from .incremental import advance, can_advance, write_digests
    from .materialize import load_manifest, read_star, write_star
    from .summaries import publish_summaries, refresh_summaries
    from .summary_state import advance_summaries, write_states

    params = params or RETAIL
    if previous and incremental and can_advance(spark, previous, promo_policy):
        step = advance(spark, src, previous, load_date, out, promo_policy, **calendar)
        star, path = step.star, step.star.location
        statuses = advance_summaries(step, spark, params)
    else:
        if previous:
            calendar["promotions"] = next_promotions(read_star(spark, previous).dims["promotion"],
                                                     src["marketing_campaigns"], day_of_load(load_date))
        path = write_star(build_star(spark, src, promo_policy=promo_policy, **calendar), spark, out, promo_policy)
        write_digests(spark, src, path)
        star = read_star(spark, path)
        statuses = refresh_summaries(star, spark, params, root=f"{path}/summaries")
        write_states(star, spark, params, path)
    if publish:  # switch the dashboard tables to this run's summaries
        publish_summaries(spark, statuses, publish)
    return star, statuses, load_manifest(spark, path)


def day_of_load(load_date=None) -> str:
    return str(load_date or dt.date.today())
