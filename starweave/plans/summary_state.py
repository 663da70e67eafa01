"""The five summaries kept up to date from the difference of two loads.

The state of a summary is its groups with additive columns: sums, how many
lines had a value, lines, and transactions.  A load replaces whole
transactions, so the number of distinct transactions of a group is additive
too: the touched transactions are taken away with their old lines and added
with their new ones.  Customers are counted as the rows of a state that is one
level finer.  ``new = old - state(old star, touched) + state(new star, touched)``
is one aggregation over three small tables; groups without lines go.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field, replace
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.measures import MEASURES, SUM, Measure, Part, avg_line_value, margin_pct, ratio
from ..operators import olap as O
from .catalogue import RETAIL, CatalogueParams, edge
from .incremental import Step
from .star import Star
from .summaries import SUMMARY_KEYS, RefreshStatus, duplicate_keys, log

STATE = "_state"


def _valued(name: str) -> Measure:
    """Lines on which the summed column of measure ``name`` has a value."""
    source = MEASURES[name].parts[0].source
    alias = f"{name}__v"
    return Measure(f"{name}_valued", (Part(alias, lambda: F.col(source).isNotNull().cast("long"), SUM, source),),
                   lambda cond: F.sum(F.col(alias)))


@dataclass(frozen=True)
class Summary:
    keys: tuple[str, ...]                       # attributes of the state
    sums: tuple[str, ...]
    finish: Callable[[DataFrame], DataFrame]    # state with plain measure names -> the summary
    where: Callable[[CatalogueParams], dict] = field(default=lambda p: {})


def _named(df: DataFrame, names: dict[str, str], **more: Column) -> DataFrame:
    return df.withColumnsRenamed(names).withColumns(more)


def _segments(df: DataFrame) -> DataFrame:
    keys = ["membership_level", "age_group", "gender", "year", "quarter"]
    df = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("unique_customers"), F.sum("trx").alias("total_trx"),
                               F.sum("revenue").alias("total_revenue"), F.sum("lines").alias("lines"),
                               F.sum("profit").alias("total_profit"))
    return df.withColumn("avg_line_value", avg_line_value("total_revenue", "lines")).drop("lines")


TOTALS = {"trx": "total_trx", "qty": "total_qty", "revenue": "total_revenue", "profit": "total_profit",
          "cost": "total_cost", "discount": "total_discount"}
PROMOTED = {"trx": "total_trx_with_promo", "discount": "total_discount_given", "revenue": "revenue_from_promo",
            "profit": "profit_from_promo"}
STATES: dict[str, Summary] = {
    "mv_monthly_sales": Summary(
        ("year", "month", "month_name", "quarter"), ("qty", "revenue", "profit", "cost", "discount"),
        lambda df: _named(df, TOTALS, margin_pct=margin_pct("total_profit", "total_revenue"),
                          avg_line_value=avg_line_value("total_revenue", "lines")).drop("lines")),
    "mv_category_region": Summary(
        ("category", "region", "year", "quarter"), ("qty", "revenue", "profit"),
        lambda df: _named(df, TOTALS).drop("lines")),
    "mv_customer_segment": Summary(
        ("customer.customer_key", "membership_level", "age_group", "gender", "year", "quarter"), ("revenue", "profit"), _segments),
    "mv_store_performance": Summary(
        ("store.store_key", "store_name", "store_type", "city", "province", "region", "year", "month"), ("qty", "revenue", "profit"),
        lambda df: _named(df, TOTALS, margin_pct=margin_pct("total_profit", "total_revenue")).drop("lines")),
    "mv_promotion_effectiveness": Summary(
        ("campaign_id", "campaign_name", "campaign_type", "channel", "target_segment"), ("discount", "revenue", "profit"),
        lambda df: _named(df, PROMOTED, roi_ratio=ratio("revenue_from_promo", "total_discount_given")).drop("lines"),
        lambda p: {"campaign_id": lambda c: c != F.lit(p.no_promo)}),
}


def _measures(s: Summary) -> list[str]:
    return ["trx", "lines", *s.sums, *[f"{m}_valued" for m in s.sums]]


def state(star: Star, name: str, params: CatalogueParams = RETAIL, only: DataFrame | None = None) -> DataFrame:
    """Groups of the summary over ``star``, or over the transactions ``only``."""
    s = STATES[name]
    if only is not None:
        star = replace(star, fact=star.fact.join(only, "transaction_id", "left_semi"))
    outs = [star.resolve(k).out for k in s.keys]
    ms = [MEASURES["trx"], MEASURES["lines"], *[MEASURES[m] for m in s.sums], *[_valued(m) for m in s.sums]]
    base = star.base(s.keys, ms, s.where(params))
    return base.groupBy(*outs).agg(*[m.agg() for m in ms])


def merge(old: DataFrame, minus: DataFrame, plus: DataFrame, s: Summary) -> DataFrame:
    """old - minus + plus, group by group; the columns keep their types."""
    added = _measures(s)
    keys = [c for c in old.columns if c not in added]

    def signed(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*keys, *[(F.col(c) * F.lit(sign)).cast(old.schema[c].dataType).alias(c) for c in added])

    rows = signed(old, 1).unionByName(signed(minus, -1)).unionByName(signed(plus, 1))
    out = rows.groupBy(*keys).agg(*[F.sum(c).cast(old.schema[c].dataType).alias(c) for c in added])
    return out.where(F.col("lines") > 0).select(*old.columns)


def finish(df: DataFrame, name: str) -> DataFrame:
    """The summary of a state; a sum without any value is NULL."""
    s = STATES[name]
    df = df.withColumns({m: F.when(F.col(f"{m}_valued") > 0, F.col(m)) for m in s.sums}).drop(*[f"{m}_valued" for m in s.sums])
    return edge(s.finish(df))


def write_states(star: Star, spark: SparkSession, params: CatalogueParams, path: str, names=tuple(STATES)) -> None:
    for name in names:
        state(star, name, params).write.mode("overwrite").parquet(f"{path}/{STATE}/{name}")


def advance_summaries(step: Step, spark: SparkSession, params: CatalogueParams = RETAIL,
                      names=tuple(STATES)) -> list[RefreshStatus]:
    """New states and summaries beside the new star, with a status each; a
    summary that fails does not stop the others (T14)."""
    out, ids = [], step.touched.select("transaction_id")
    for name in names:
        t0 = time.time()
        path = f"{step.star.location}/summaries/{name}"
        try:
            old = spark.read.parquet(f"{step.old.location}/{STATE}/{name}")
            merged = merge(old, state(step.old, name, params, ids), state(step.star, name, params, ids), STATES[name])
            where = f"{step.star.location}/{STATE}/{name}"
            merged.write.mode("overwrite").parquet(where)
            finish(spark.read.parquet(where), name).write.mode("overwrite").parquet(path)
            written = spark.read.parquet(path)
            dups = duplicate_keys(written, SUMMARY_KEYS[name]).count()
            out.append(RefreshStatus(name, dups == 0, path, written.count(), dups, time.time() - t0,
                                     None if dups == 0 else "duplicate summary keys"))
        except Exception as e:  # keep going: one summary must not block the others
            log.warning("summary %s skipped: %s", name, e)
            out.append(RefreshStatus(name, False, None, None, None, time.time() - t0, str(e)))
    return out
