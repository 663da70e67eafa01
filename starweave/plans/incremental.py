"""A further load that builds only what changed.

Every load leaves a digest per Success transaction: an order-free hash of its
header, lines (with the cost and supplier of their products) and campaigns.
The next load compares digests with one full outer join, adds the transactions
that use a changed dimension row, and

* builds the fact of those transactions only (the three transaction tables are
  reduced to them before any other join),
* rewrites the years they were or are in: the old rows of the other
  transactions of those years, and the new rows,
* leaves all other years where they are: the manifest names the folder of each.

The star of the last load is never touched, so its readers and a retry of this
load are safe.  Delete and insert are by transaction because promotion usage
and status belong to the transaction.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.asof import as_of_join, version_intervals
from ..session import new_table_path
from .etl import build_star, day_of_load, fact, few_versions, headers, next_promotions
from .materialize import fact_parts, manifest_value, read_parts, read_star, write_dimensions, write_fact, write_manifest
from .star import DIMENSIONS, FACT_PARTITION, Star

DIGESTS = "_transaction_digests"     # another name than those hashed otherwise
MAX_PARTS = 12     # folders of a fact before a load writes all years again


@dataclass
class Step:
    """A load and the one before it; ``touched`` (transaction_id, kind) are
    the transactions that differ between them."""
    star: Star
    old: Star
    touched: DataFrame


# ------------------------------------------------------------------ change detection
def transaction_digests(src: Mapping[str, DataFrame]) -> DataFrame:
    """(transaction_id, sale_year, digest, n) of the Success transactions.
    Rows of three tables meet in one aggregation by transaction; sums of hashes
    are combined before the shuffle, so one transaction with very many lines
    sends few rows."""
    def hashed(df: DataFrame) -> Column:
        cols = [F.col(c) for c in sorted(df.columns) if c != "transaction_id"]
        return F.xxhash64(*[c.isNull() for c in cols], *cols)

    def rows(df: DataFrame, kind: str, h: Column, year=None) -> DataFrame:
        return df.select("transaction_id", (F.lit(None).cast("int") if year is None else year).alias(FACT_PARTITION),
                         F.lit(kind == "H").alias("header"), F.xxhash64(F.lit(kind), h).cast("decimal(20,0)").alias("h"))

    trx = headers(src)
    known = trx.select("transaction_id")
    # lines and products meet as hashes: the join by product carries two numbers and its key
    made_of = src["products"].select("product_id", "cost_price", "supplier_id")
    made_of = made_of.select("product_id", hashed(made_of).alias("__made_of"))
    lines = src["sales_transaction_details"].select(
        "transaction_id", "detail_id", "product_id", "quantity", "unit_price", "discount_per_item", "subtotal")
    lines = lines.select("transaction_id", "product_id", hashed(lines).alias("__line"))
    lines = lines.join(known, "transaction_id", "left_semi").join(made_of, "product_id", "left")
    # by transaction before repeated campaigns are dropped: no second shuffle for that
    usage = src["promotion_usage"].select("transaction_id", "campaign_id").join(known, "transaction_id", "left_semi").distinct()
    parts = (rows(trx, "H", hashed(trx), F.year("transaction_date"))
             .unionByName(rows(lines, "L", F.xxhash64("__line", "__made_of")))
             .unionByName(rows(usage, "U", hashed(usage))))
    return (parts.groupBy("transaction_id")
            .agg(F.max(FACT_PARTITION).alias(FACT_PARTITION), F.max("header").alias("header"),
                 F.sum("h").alias("digest"), F.count(F.lit(1)).alias("n"))
            .where("header").drop("header"))


def write_digests(spark: SparkSession, src: Mapping[str, DataFrame], path: str) -> DataFrame:
    transaction_digests(src).write.mode("overwrite").parquet(f"{path}/{DIGESTS}")
    return read_digests(spark, path)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{DIGESTS}")


def can_advance(spark: SparkSession, previous: str, promo_policy: str) -> bool:
    """Did the last load leave its digests, under the same promotion policy?"""
    try:
        read_digests(spark, previous)
    except AnalysisException:      # written by an earlier version or another builder
        return False
    return manifest_value(spark, previous, "promo_policy") == promo_policy


def changed_rows(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows (of both sides) whose key is on one side only or whose other
    columns differ."""
    cols = sorted(old.columns)
    h = F.xxhash64(*[F.col(c).isNull() for c in cols], *cols)
    a, b = old.select(key, h.alias("was")), new.select(key, h.alias("is"))
    keys = a.join(b, key, "full_outer").where(~F.col("was").eqNullSafe(F.col("is"))).select(key)
    return old.unionByName(new).join(keys, key, "left_semi")


def found(df: DataFrame, path: str) -> DataFrame:
    """``df`` as files: its size is then known to the joins that look it up, so
    a few changed rows are broadcast and the transactions not shuffled for them."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def touched_transactions(src: Mapping[str, DataFrame], old: Star, new: Star, before: DataFrame, after: DataFrame,
                         span: tuple, path: str) -> DataFrame:
    """(transaction_id, kind, sale_year, was_year): added, removed, changed,
    or 'dimension' where only a dimension row that it uses differs.  The
    differing rows of the dimensions are written below ``path``; transactions
    are looked through only for dimensions that have some."""
    was = before.select("transaction_id", F.col("digest").alias("was"), F.col("n").alias("was_n"),
                        F.col(FACT_PARTITION).alias("was_year"))
    both = after.join(was, "transaction_id", "full_outer")
    kind = (F.when(F.col("was_n").isNull(), "added").when(F.col("n").isNull(), "removed")
            .when((F.col("digest") != F.col("was")) | (F.col("n") != F.col("was_n")), "changed"))
    both = both.withColumn("kind", kind)

    trx, lines = headers(src), src["sales_transaction_details"].select("transaction_id", "product_id")
    ids = [both.where("false").select("transaction_id")]
    for dim, natural in (("store", "store_id"), ("customer", "customer_id")):
        rows = found(changed_rows(old.dims[dim], new.dims[dim], DIMENSIONS[dim][1]).select(natural).distinct(), f"{path}/{dim}")
        if not rows.isEmpty():
            ids.append(trx.join(rows, natural, "left_semi").select("transaction_id"))
    products = changed_rows(old.dims["product"], new.dims["product"], "product_key").select("product_id")
    suppliers = changed_rows(old.dims["supplier"], new.dims["supplier"], "supplier_key").select("supplier_id").distinct()
    suppliers = found(suppliers, f"{path}/supplier")
    supplied = src["products"].join(suppliers, "supplier_id", "left_semi").select("product_id")
    products = found(products.union(supplied).distinct(), f"{path}/product")
    if not products.isEmpty():
        ids.append(lines.join(products, "product_id", "left_semi").select("transaction_id"))
    # A version that closed still stands for the days before: what counts is a
    # version that is new, for the days on which it is in force.
    told = ["promotion_key", "campaign_id", "campaign_name", "campaign_type", "channel", "target_segment"]
    known = old.dims["promotion"].select(*told)
    in_force = version_intervals(new.dims["promotion"].select(*told, "effective_date"), "campaign_id", first=span[0], last=span[1])
    opened = found(in_force.join(known, [in_force[c].eqNullSafe(known[c]) for c in told], "left_anti"), f"{path}/promotion")
    lo, hi, n = opened.agg(F.min("in_force_from"), F.max("in_force_to"), F.count(F.lit(1))).first()
    if n:
        sold = trx.where(F.col("transaction_date").between(F.lit(lo), F.lit(hi))).select("transaction_id", "transaction_date")
        used = src["promotion_usage"].select("transaction_id", "campaign_id").join(sold, "transaction_id").distinct()
        used = as_of_join(used, opened, "campaign_id", "transaction_date", ["promotion_key"], few=few_versions(n, (lo, hi)))
        ids.append(used.select("transaction_id"))

    by_dimension = reduce(DataFrame.unionByName, ids).distinct().withColumn("dim", F.lit(True))
    return (both.join(by_dimension, "transaction_id", "left")
            .withColumn("kind", F.coalesce("kind", F.when(F.col("dim"), "dimension"))).where("kind is not null")
            .select("transaction_id", "kind", FACT_PARTITION, "was_year"))


# ------------------------------------------------------------------ load
def restrict(src: Mapping[str, DataFrame], ids: DataFrame) -> dict[str, DataFrame]:
    """The sources with the transactions ``ids`` only."""
    out = dict(src)
    for name in ("sales_transactions", "sales_transaction_details", "promotion_usage"):
        out[name] = src[name].join(ids, "transaction_id", "left_semi")
    return out


def advance(spark: SparkSession, src: Mapping[str, DataFrame], previous: str, load_date=None, out: str | None = None,
            promo_policy: str = "fanout", **calendar) -> Step:
    """The star of ``src`` from the one written at ``previous``: the same rows
    as a load of everything with the same promotion history."""
    path = out or new_table_path(spark, "star")
    old = read_star(spark, previous)
    promotions = next_promotions(old.dims["promotion"], src["marketing_campaigns"], day_of_load(load_date))
    plan = build_star(spark, src, promo_policy=promo_policy, promotions=promotions, **calendar)
    counts, sizes = write_dimensions(plan, path)
    dims = {dim: spark.read.parquet(f"{path}/{table}") for dim, (table, _) in DIMENSIONS.items()}
    new = Star(plan.fact, dims, trx_level=plan.trx_level)
    span = dims["time"].agg(F.min("full_date"), F.max("full_date")).first()

    after = write_digests(spark, src, path)
    touched_transactions(src, old, new, read_digests(spark, previous), after, span,
                         f"{path}/_changed").write.mode("overwrite").parquet(f"{path}/_touched")
    touched = spark.read.parquet(f"{path}/_touched")
    years = sorted({y for r in touched.select(FACT_PARTITION, "was_year").distinct().collect() for y in r if y is not None})

    parts = fact_parts(spark, previous)
    ids = touched.select("transaction_id")
    if len(parts) >= MAX_PARTS:        # compaction: all years go into this load's folder
        years = sorted({r[0] for r in old.fact.select(FACT_PARTITION).distinct().collect()} | set(years))
    schema = old.fact.schema
    held = {folder: [r[0] for r in read_parts(spark, [(folder, None)], schema).select(FACT_PARTITION).distinct().collect()]
            if own is None else own for folder, own in parts}
    left = [(folder, [y for y in own if y not in years]) for folder, own in held.items()]
    left = [(folder, own) for folder, own in left if own]

    kept = old.fact.where(F.col(FACT_PARTITION).isin(years)).join(ids, "transaction_id", "left_anti")
    fresh = fact(restrict(src, ids), dims, promo_policy, span, few_versions(counts["dim_promotion"], span), touched.count())
    rows = write_fact(kept.unionByName(fresh), path)
    rows += read_parts(spark, left, schema).count() if left else 0       # file footers
    values = {"trx_level": ",".join(sorted(plan.trx_level)), "promo_policy": promo_policy, "fact_schema": schema.json()}
    here = [(f"{path}/fact_sales", years)] if years else []
    for i, (folder, own) in enumerate(left + here):
        values[f"fact_part:{i:04d}"] = f"{','.join(map(str, own))}|{folder}"
    write_manifest(spark, path, counts | {"fact_sales": rows}, sizes, values)
    return Step(read_star(spark, path), old, touched)

