"""Q1-Q12: data-quality audits.  Each audit is a set-based Spark job that
returns the violating rows (empty = clean); none collects data to the driver
except ``load_counts``, which returns one number per table."""

from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import ALLOWED_VALUES, FOREIGN_KEYS, PRIMARY_KEYS

TOLERANCE = 0.005


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Q1: key values that occur more than once (with their count)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def nulls(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q2: rows with a NULL in any of ``cols``."""
    cond = None
    for c in cols:
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
    return df.filter(cond)


def orphans(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Q3: child rows whose (non-NULL) foreign key has no parent.  A NULL
    key is reported too: it never matches in SQL semantics (T16)."""
    keys = parent.select(F.col(parent_col).alias(child_col)).distinct()
    return child.join(keys, child_col, "left_anti")


def invalid_values(df: DataFrame, col: str, allowed: Iterable) -> DataFrame:
    """Q4: values outside the allowed list (NULL is not a violation)."""
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin(list(allowed)))


def hierarchy_violations(df: DataFrame, child: str, parent: str) -> DataFrame:
    """Q5: children that sit under more than one parent (e.g. a city in two
    provinces), with the number of parents."""
    return (df.groupBy(child).agg(F.count_distinct(parent).alias("parents"))
              .filter(F.col("parents") > 1))


def hierarchy_violation_pairs(df: DataFrame, child: str, parent: str) -> DataFrame:
    """Q5 detail: one row per (child, parent) of every violating child — rows,
    not a collected list, so a child with very many parents stays distributed."""
    bad = hierarchy_violations(df, child, parent).select(child)
    return df.select(child, parent).distinct().join(bad, child, "left_semi")


def line_arithmetic(details: DataFrame) -> DataFrame:
    """Q6: subtotal = (unit_price - discount_per_item) x quantity."""
    expected = (F.col("unit_price") - F.col("discount_per_item")) * F.col("quantity")
    return details.withColumn("expected_subtotal", expected).filter(
        F.abs(F.col("subtotal") - F.col("expected_subtotal")) > TOLERANCE)


def header_vs_lines(transactions: DataFrame, details: DataFrame) -> DataFrame:
    """Q7: header totals equal the sums of their lines."""
    lines = details.groupBy("transaction_id").agg(
        F.sum(F.col("unit_price") * F.col("quantity")).alias("lines_total"),
        F.sum(F.col("discount_per_item") * F.col("quantity")).alias("lines_discount"),
        F.sum("subtotal").alias("lines_final"))
    j = transactions.join(lines, "transaction_id", "left")
    bad = None
    for h, l in (("total_amount", "lines_total"), ("discount_amount", "lines_discount"),
                 ("final_amount", "lines_final")):
        c = F.abs(F.col(h) - F.coalesce(F.col(l), F.lit(0))) > TOLERANCE
        bad = c if bad is None else bad | c
    return j.filter(bad)


def stock_band(ending: Column, low: int = 20) -> Column:
    """Status of a stock: 0 -> Out of Stock, below ``low`` -> Low, else Safe."""
    return F.when(ending == 0, "Out of Stock").when(ending < low, "Low").otherwise("Safe")


def stock_violations(inventory: DataFrame, low: int = 20) -> DataFrame:
    """Q8: ending = max(0, beginning + in - out); 0 -> Out of Stock,
    below ``low`` -> Low, else Safe."""
    ending = F.greatest(F.lit(0), F.col("beginning_stock") + F.col("stock_in") - F.col("stock_out"))
    return (inventory.withColumn("expected_ending", ending)
            .withColumn("expected_status", stock_band(F.col("ending_stock"), low))
            .filter((F.col("ending_stock") != F.col("expected_ending"))
                    | (F.col("stock_status") != F.col("expected_status"))))


def rating_sentiment(feedback: DataFrame) -> DataFrame:
    """Q9: Positive 4-5, Neutral 3, Negative 1-2."""
    expected = (F.when(F.col("rating") >= 4, "Positive").when(F.col("rating") == 3, "Neutral")
                 .when(F.col("rating").between(1, 2), "Negative"))
    return feedback.withColumn("expected_sentiment", expected).filter(
        F.col("expected_sentiment").isNull() | (F.col("sentiment") != F.col("expected_sentiment")))


def promotion_usage_violations(usage: DataFrame, transactions: DataFrame, success: str = "Success") -> DataFrame:
    """Q10: a usage belongs to a Success transaction of the same customer and date."""
    t = transactions.select("transaction_id", F.col("customer_id").alias("trx_customer"),
                            F.col("transaction_date").alias("trx_date"), "transaction_status")
    j = usage.join(t, "transaction_id", "left")
    return j.filter(F.col("transaction_status").isNull() | (F.col("transaction_status") != success)
                    | ~F.col("customer_id").eqNullSafe(F.col("trx_customer"))
                    | ~F.col("usage_date").eqNullSafe(F.col("trx_date")))


def feedback_violations(feedback: DataFrame, transactions: DataFrame, details: DataFrame,
                        min_days: int = 1, max_days: int = 14) -> DataFrame:
    """Q11: feedback 1-14 days after the transaction, by its customer, on a
    product that is in the transaction."""
    t = transactions.select("transaction_id", F.col("customer_id").alias("trx_customer"),
                            F.col("transaction_date").alias("trx_date"))
    items = details.select("transaction_id", "product_id").distinct().withColumn("__in", F.lit(True))
    j = (feedback.join(t, "transaction_id", "left")
                 .join(items, ["transaction_id", "product_id"], "left"))
    days = F.datediff(F.col("feedback_date"), F.col("trx_date"))
    return j.filter(F.col("trx_date").isNull() | ~days.between(min_days, max_days)
                    | ~F.col("customer_id").eqNullSafe(F.col("trx_customer"))
                    | F.col("__in").isNull()).drop("__in")


def load_counts(tables: Mapping[str, DataFrame]) -> dict[str, int]:
    """Q12: row count per loaded table (logged by the reference)."""
    return {name: df.count() for name, df in tables.items()}


# ------------------------------------------------------------------ bundles
def source_audits(src: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Q1, Q3, Q4, Q5 (store geography) and Q6-Q11 over the raw tables."""
    out: dict[str, DataFrame] = {}
    for t, key in PRIMARY_KEYS.items():
        if t in src:
            out[f"Q1:{t}"] = duplicate_keys(src[t], key)
    for child, ccol, parent, pcol in FOREIGN_KEYS:
        if child in src and parent in src:
            out[f"Q3:{child}.{ccol}"] = orphans(src[child].filter(F.col(ccol).isNotNull()), ccol, src[parent], pcol)
    for (t, c), allowed in ALLOWED_VALUES.items():
        if t in src:
            out[f"Q4:{t}.{c}"] = invalid_values(src[t], c, allowed)
    if "stores" in src:
        out["Q5:stores.city->province"] = hierarchy_violations(src["stores"], "city", "province")
        out["Q5:stores.province->region"] = hierarchy_violations(src["stores"], "province", "region")
    if "sales_transaction_details" in src:
        out["Q6"] = line_arithmetic(src["sales_transaction_details"])
        if "sales_transactions" in src:
            out["Q7"] = header_vs_lines(src["sales_transactions"], src["sales_transaction_details"])
    if "inventory_stock" in src:
        out["Q8"] = stock_violations(src["inventory_stock"])
    if "customer_feedback" in src:
        out["Q9"] = rating_sentiment(src["customer_feedback"])
    if "promotion_usage" in src and "sales_transactions" in src:
        out["Q10"] = promotion_usage_violations(src["promotion_usage"], src["sales_transactions"])
    if {"customer_feedback", "sales_transactions", "sales_transaction_details"} <= set(src):
        out["Q11"] = feedback_violations(src["customer_feedback"], src["sales_transactions"],
                                         src["sales_transaction_details"])
    return out


def fact_orphans(src: Mapping[str, DataFrame], dims: Mapping[str, DataFrame], promo_policy: str = "fanout") -> DataFrame:
    """Q3 for the load: Success lines that the star lookups drop, with the
    reason (date outside the calendar, unknown product, customer, ...)."""
    from ..plans.etl import success_lines
    prods = src["products"].select("product_id", "supplier_id")
    lines = success_lines(src, promo_policy).join(prods, "product_id", "left")
    checks = [
        ("date outside calendar", "transaction_date", dims["time"].select(F.col("full_date").alias("transaction_date"))),
        ("unknown product", "product_id", src["products"].select("product_id")),
        ("unknown customer", "customer_id", dims["customer"].select("customer_id")),
        ("unknown store", "store_id", dims["store"].select("store_id")),
        ("unknown supplier", "supplier_id", dims["supplier"].select("supplier_id")),
        ("unknown campaign", "campaign_id", dims["promotion"].filter("is_current").select("campaign_id")),
        ("unknown payment method", "payment_method", dims["payment"].select("payment_method")),
    ]
    # One pass: a flag per lookup (left joins on distinct keys), then one row
    # per failed lookup.  The supplier comes from the product, so it is only
    # checked when the product is known.
    x = lines
    product_flag = f"__ok{[c[1] for c in checks].index('product_id')}"
    failed = []
    for i, (reason, col, keys) in enumerate(checks):
        flag = f"__ok{i}"
        x = x.join(keys.select(col).distinct().withColumn(flag, F.lit(True)), col, "left")
        miss = F.col(flag).isNull()
        if col == "supplier_id":
            miss = miss & F.col(product_flag).isNotNull()
        failed.append(F.when(miss, F.struct(F.lit(reason).alias("reason"),
                                            F.col(col).cast("string").alias("value"))))
    return (x.select("transaction_id", "detail_id", F.explode(F.filter(F.array(*failed), lambda c: c.isNotNull())).alias("f"))
             .select("transaction_id", "detail_id", "f.reason", "f.value"))


def star_audits(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Q1/Q2/Q3 on a built star: unique surrogate keys, NOT NULL full_date,
    fact keys present in their dimension, one current row per campaign."""
    from ..plans.star import DIMENSIONS
    out: dict[str, DataFrame] = {}
    fact = tables["fact_sales"]
    for dim, (table, key) in DIMENSIONS.items():
        out[f"Q1:{table}"] = duplicate_keys(tables[table], [key])
        out[f"Q3:fact_sales.{key}"] = orphans(fact.select(key), key, tables[table], key)
    out["Q2:dim_time.full_date"] = nulls(tables["dim_time"], ["full_date"])
    out["Q1:dim_promotion.current_campaign"] = duplicate_keys(
        tables["dim_promotion"].filter("is_current"), ["campaign_id"])
    return out


def star_audit_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(audit, violations) of ``star_audits`` from one scan of the fact: its
    keys are exploded and counted by (dimension, value) before the exchange,
    so a hot key is one row, and the counts are anti-joined with the keys held."""
    from ..plans.star import DIMENSIONS
    fact = tables["fact_sales"]
    keys = F.array(*[F.struct(F.lit(k).alias("k"), F.col(k).cast("long").alias("v")) for _, k in DIMENSIONS.values()])
    used = fact.select(F.explode(keys).alias("e")).groupBy("e.k", "e.v").agg(F.count(F.lit(1)).alias("n"))
    held = None
    for table, k in DIMENSIONS.values():
        one = tables[table].select(F.lit(table).alias("t"), F.lit(k).alias("k"), F.col(k).cast("long").alias("v"))
        held = one if held is None else held.unionByName(one)
    held = held.groupBy("t", "k", "v").agg(F.count(F.lit(1)).alias("m"))
    lost = (used.join(held.select("k", "v"), ["k", "v"], "left_anti").groupBy("k").agg(F.sum("n").alias("violations"))
            .select(F.concat(F.lit("Q3:fact_sales."), "k").alias("audit"), "violations"))
    twice = (held.where("m > 1").groupBy("t").agg(F.count(F.lit(1)).alias("violations"))
             .select(F.concat(F.lit("Q1:"), "t").alias("audit"), "violations"))
    undated = nulls(tables["dim_time"], ["full_date"])
    current = duplicate_keys(tables["dim_promotion"].filter("is_current"), ["campaign_id"])
    found = lost.unionByName(twice)
    rest = {"Q2:dim_time.full_date": undated, "Q1:dim_promotion.current_campaign": current}
    for name, df in rest.items():
        found = found.unionByName(df.agg(F.count(F.lit(1)).alias("violations"))
                                  .select(F.lit(name).alias("audit"), "violations"))
    names = [f"Q1:{t}" for t, _ in DIMENSIONS.values()] + [f"Q3:fact_sales.{k}" for _, k in DIMENSIONS.values()] + list(rest)
    every = fact.sparkSession.range(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias("audit"))
    return every.join(found, "audit", "left").select("audit", F.coalesce("violations", F.lit(0).cast("long")).alias("violations"))
