"""Registered queries over two loads of the test tables, with their SQL.

The first load sees the tables as they stood on ``CHANGE``: later orders are
not there, orders not yet wholly shipped are pending, returned ones still
successful, and the campaign names carry the orders counted so far.  The second
load sees the tables as given; it keys sales to the campaign version of their
day, builds only the transactions that changed and refreshes a summary from the
difference.  Both loads are written once per application and folder.
"""

from __future__ import annotations

import os
import threading
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import olap as O
from ..session import app_id, fine_parts, new_table_path
from ..sources.retail_tpch import campaigns, discounts, retail_from_tpch
from ..sources.tpch import read_tpch
from .catalogue import TESTDATA, edge
from .etl import build_star
from .incremental import Step, advance, write_digests
from .load_checks import MEASURES, RAW
from .materialize import write_star
from .summaries import SUMMARY_KEYS, read_summary
from .summary_state import advance_summaries, write_states

CHANGE = "2000-01-01"
PENDING = "Pending"
POLICY = "fanout"
_DONE: dict[tuple[str, str], Step] = {}
_LOCK = threading.Lock()


def counted_campaigns(tables: dict[str, DataFrame], before: str | None = None) -> DataFrame:
    """The campaign table, with the number of orders that used the campaign
    (before a day) in its name."""
    return campaigns_by_use(discounts(tables).join(tables["orders"].select(
        F.col("o_orderkey").alias("transaction_id"), F.to_date("o_orderdate").alias("day")), "transaction_id"), before)


def campaigns_by_use(used: DataFrame, before: str | None = None) -> DataFrame:
    """The same from the uses (pct, day)."""
    if before:
        used = used.where(F.col("day") < F.lit(before).cast("date"))
    n = used.groupBy("pct").agg(F.count(F.lit(1)).alias("n"))       # the only pass over the orders
    named = F.concat_ws(" ", "campaign_name", F.col("n").cast("string"))
    return campaigns(n, "n").withColumn("campaign_name", named).drop("n")


def landed(spark: SparkSession, src: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The raw tables as files, as a load meets them."""
    out = {}
    for name, df in src.items():
        path = new_table_path(spark, f"raw-{name}")
        df.write.parquet(path)
        out[name] = spark.read.schema(df.schema).parquet(path)
    return out


def as_of_day(src: dict[str, DataFrame], day: str) -> dict[str, DataFrame]:
    """The two raw tables that stood differently on ``day``."""
    trx = src["sales_transactions"].where(F.col("transaction_date") < F.lit(day).cast("date"))
    status = F.when(F.col("transaction_status").isin("Success", "Returned"),
                    F.when(F.col("shipped") < F.lit(day).cast("date"), "Success").otherwise(PENDING)
                    ).otherwise(F.col("transaction_status"))
    return {"sales_transactions": trx.withColumn("transaction_status", status).drop("shipped"),
            "marketing_campaigns": campaigns_by_use(uses(src), day)}


def uses(src: dict[str, DataFrame]) -> DataFrame:
    """(pct, day) of the discounts of known orders."""
    return src["promotion_usage"].where("known").select("pct", F.col("usage_date").alias("day"))


def raw_tables(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The raw tables as of ``CHANGE`` and as given.  Those of the first load
    follow from the written ones, so lines are not grouped by order once more."""
    src = retail_from_tpch(spark, sf_dir, dated=True)
    del src["marketing_campaigns"]
    src = landed(spark, src)
    then = landed(spark, as_of_day(src, CHANGE))
    now = src | landed(spark, {"marketing_campaigns": campaigns_by_use(uses(src))})
    now["sales_transactions"] = now["sales_transactions"].drop("shipped")
    now["promotion_usage"] = now["promotion_usage"].drop("pct", "known")
    return now | then, now


def parts(spark: SparkSession, sf_dir: str):
    return fine_parts(spark, read_tpch(spark, sf_dir, ("lineitem",))["lineitem"].count())


def two_loads(spark: SparkSession, sf_dir: str) -> Step:
    """The star of the first load and the one advanced from it."""
    key = (app_id(spark), os.path.abspath(sf_dir))
    with _LOCK:
        if key not in _DONE:
            with parts(spark, sf_dir):
                then, now = raw_tables(spark, sf_dir)
                first = write_star(build_star(spark, then), spark, new_table_path(spark, "load-1"), POLICY)
                write_digests(spark, then, first)
                _DONE[key] = advance(spark, now, first, CHANGE, new_table_path(spark, "load-2"), POLICY)
    return _DONE[key]


def load_by_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures by the version of the campaign in force on the day of the sale."""
    star = two_loads(spark, sf_dir).star
    return edge(O.aggregate(star, ["campaign_id", "campaign_name", "effective_date", "is_current"], MEASURES))


def load_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of the star advanced by what changed."""
    star = two_loads(spark, sf_dir).star
    return edge(O.aggregate(star, ["campaign_id", "year", "quarter", "region", "payment_type", "supplier_category"], MEASURES))


def load_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions built again by the second load, by kind of change."""
    return two_loads(spark, sf_dir).touched.groupBy("kind").agg(F.count(F.lit(1)).alias("n_transactions"))


def _refreshed(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary written by the refresh from the difference: the
    state of the first load, moved by the transactions that changed."""
    step = two_loads(spark, sf_dir)
    with parts(spark, sf_dir):
        write_states(step.old, spark, TESTDATA, step.old.location, (name,))
        status, = advance_summaries(step, spark, TESTDATA, (name,))
    return read_summary(spark, status)


TWO_LOADS = {f.__name__: f for f in (load_by_version, load_increment, load_changes)}
TWO_LOADS |= {name.replace("mv_", "refreshed_"): partial(_refreshed, name) for name in SUMMARY_KEYS}


# ------------------------------------------------------------------ SQL
VERSIONED = RAW + f"""
, seen AS (
  SELECT pct, count(*) FILTER (WHERE d < DATE '{CHANGE}') AS a, count(*) AS b
  FROM used JOIN header ON l_orderkey = o_orderkey GROUP BY pct
), fv AS (
  SELECT fact.*, c_age, c_gender, p_type, CASE WHEN pct_used IS NULL THEN 'No Promotion'
           WHEN a > 0 AND (a = b OR d < DATE '{CHANGE}') THEN 'Campaign ' || CAST(pct_used AS VARCHAR) || ' ' || CAST(a AS VARCHAR)
           ELSE 'Campaign ' || CAST(pct_used AS VARCHAR) || ' ' || CAST(b AS VARCHAR) END AS campaign_name,
         CASE WHEN pct_used IS NULL THEN DATE '2000-01-01' WHEN a > 0 AND (a = b OR d < DATE '{CHANGE}') THEN DATE '1995-01-01'
           ELSE DATE '{CHANGE}' END AS effective_date,
         coalesce(a = 0 OR a = b OR d >= DATE '{CHANGE}', TRUE) AS is_current
  FROM (SELECT *, CASE WHEN campaign_id <> 'NO_PROMO' THEN CAST(substr(campaign_id, 4) AS BIGINT) END AS pct_used FROM fact) fact
  LEFT JOIN seen ON seen.pct = pct_used
  JOIN (SELECT c_custkey AS ck, 18 + c_custkey % 43 AS c_age, CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS c_gender
        FROM customer) cu ON ck = o_custkey
  JOIN (SELECT p_partkey AS pk, p_type FROM part) pa ON pk = l_partkey
)
"""
_SUMS = """CAST(count(*) AS BIGINT) AS lines, CAST(count(DISTINCT l_orderkey) AS BIGINT) AS trx,
  CAST(sum(quantity) AS BIGINT) AS qty, CAST(sum(sub) AS DOUBLE) / 100 AS revenue, CAST(sum(profit) AS DOUBLE) / 100 AS profit,
  CAST(sum(cost_all) AS DOUBLE) / 100 AS cost, CAST(sum(off * quantity) AS DOUBLE) / 100 AS discount"""


def _half_away(num: str, den: str, factor: int = 1) -> str:
    """ROUND(factor * num / den, 2) of whole numbers, half away from zero."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return (f"CAST(sign({n}) AS DOUBLE) * sign({d}) * CAST((abs({n}) * {200 * factor} + abs({d})) // nullif(abs({d}) * 2, 0) AS DOUBLE) / 100.0")


_TRX, _QTY, _LINES = "CAST(count(DISTINCT l_orderkey) AS BIGINT)", "CAST(sum(quantity) AS BIGINT)", "count(*)"
_REV, _PROFIT, _COST = ("CAST(sum(sub) AS DOUBLE) / 100", "CAST(sum(profit) AS DOUBLE) / 100", "CAST(sum(cost_all) AS DOUBLE) / 100")
_OFF = "CAST(sum(off * quantity) AS DOUBLE) / 100"
_AVG_LINE = _half_away("sum(sub)", "count(*) * 100")
_MARGIN = _half_away("sum(profit)", "sum(sub)", 100)
_MONTHS = ("['Januari','Februari','Maret','April','Mei','Juni','Juli','Agustus','September','Oktober','November','Desember']"
           "[CAST(month(d) AS INTEGER)]")
_AGE = ("CASE WHEN c_age < 26 THEN 'Youth (< 26)' WHEN c_age < 40 THEN 'Adult (26-39)' "
        "WHEN c_age < 55 THEN 'Middle (40-54)' ELSE 'Senior (55+)' END")

TWO_LOADS_SQL = {
    "load_by_version": VERSIONED + f"""
SELECT campaign_id, campaign_name, effective_date, is_current, {_SUMS} FROM fv GROUP BY ALL""",
    "load_increment": RAW + f"""
SELECT campaign_id, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, r_name AS region, payment_type,
  ['ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD'][CAST(source % 6 AS INTEGER) + 1] AS supplier_category, {_SUMS}
FROM fact GROUP BY ALL""",
    "load_changes": RAW + f"""
, shipped AS (
  SELECT l_orderkey, max(CAST(l_shipdate AS DATE)) AS last_day FROM lineitem GROUP BY 1
), then_ok AS (
  SELECT o_orderkey FROM header JOIN shipped ON l_orderkey = o_orderkey
  WHERE d < DATE '{CHANGE}' AND o_orderstatus IN ('F', 'P') AND last_day < DATE '{CHANGE}'
), now_ok AS (
  SELECT o_orderkey FROM header WHERE o_orderstatus = 'F'
)
SELECT 'added' AS kind, CAST(count(*) AS BIGINT) AS n_transactions FROM now_ok
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM then_ok) HAVING count(*) > 0
UNION ALL SELECT 'removed', count(*) FROM then_ok WHERE o_orderkey NOT IN (SELECT o_orderkey FROM now_ok) HAVING count(*) > 0""",
    "refreshed_monthly_sales": VERSIONED + f"""
SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, {_MONTHS} AS month_name, CAST(quarter(d) AS INTEGER) AS quarter,
  {_TRX} AS total_trx, {_QTY} AS total_qty, {_REV} AS total_revenue, {_PROFIT} AS total_profit, {_COST} AS total_cost,
  {_OFF} AS total_discount, {_MARGIN} AS margin_pct, {_AVG_LINE} AS avg_line_value
FROM fv GROUP BY 1, 2, 3, 4""",
    "refreshed_category_region": VERSIONED + f"""
SELECT p_type AS category, r_name AS region, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
  {_QTY} AS total_qty, {_REV} AS total_revenue, {_PROFIT} AS total_profit, {_TRX} AS total_trx FROM fv GROUP BY 1, 2, 3, 4""",
    "refreshed_customer_segment": VERSIONED + f"""
SELECT c_mktsegment AS membership_level, {_AGE} AS age_group, c_gender AS gender, CAST(year(d) AS INTEGER) AS year,
  CAST(quarter(d) AS INTEGER) AS quarter, CAST(count(DISTINCT o_custkey) AS BIGINT) AS unique_customers, {_TRX} AS total_trx,
  {_REV} AS total_revenue, {_PROFIT} AS total_profit, {_AVG_LINE} AS avg_line_value FROM fv GROUP BY 1, 2, 3, 4, 5""",
    "refreshed_store_performance": VERSIONED + f"""
SELECT s_suppkey AS store_key, s_name AS store_name, CASE WHEN s_suppkey % 2 = 0 THEN 'Mall Store' ELSE 'Standalone Store' END AS store_type,
  n_name || '_' || CAST(s_suppkey % 3 AS VARCHAR) AS city, n_name AS province, region, CAST(year(d) AS INTEGER) AS year,
  CAST(month(d) AS INTEGER) AS month, {_TRX} AS total_trx, {_QTY} AS total_qty, {_REV} AS total_revenue, {_PROFIT} AS total_profit,
  {_MARGIN} AS margin_pct
FROM fv JOIN (SELECT s_suppkey, s_name, n_name, r_name AS region FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey) st ON st.s_suppkey = fv.store GROUP BY ALL""",
    "refreshed_promotion_effectiveness": VERSIONED + f"""
SELECT campaign_id, campaign_name, ['Discount','Bundle','Cashback','Loyalty'][CAST((pct_used - 1) % 4 AS INTEGER) + 1] AS campaign_type,
  ['Store','Instagram','Website','Email'][CAST((pct_used - 1) % 4 AS INTEGER) + 1] AS channel, 'All' AS target_segment,
  {_TRX} AS total_trx_with_promo, {_OFF} AS total_discount_given, {_REV} AS revenue_from_promo, {_PROFIT} AS profit_from_promo,
  {_half_away("sum(sub)", "sum(off * quantity)")} AS roi_ratio
FROM fv WHERE pct_used IS NOT NULL GROUP BY 1, 2, 3, 4, 5""",
}
