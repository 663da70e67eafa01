"""Pre-aggregated summary tables and their refresh.

Each summary is written to its own fresh folder (T15: a reader never sees
a half-written table) and checked against its declared unique key (the
unique index of the reference).  One failing summary does not stop the
others (T14): the refresh returns a status per table.
"""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_table_path, shared_dir
from .catalogue import CATALOGUE, RETAIL, CatalogueParams
from .star import Star

log = logging.getLogger(__name__)

# Summary name -> unique key (the reference's unique indexes).
SUMMARY_KEYS: dict[str, tuple[str, ...]] = {
    "mv_monthly_sales": ("year", "month"),
    "mv_category_region": ("category", "region", "year", "quarter"),
    "mv_customer_segment": ("membership_level", "age_group", "gender", "year", "quarter"),
    "mv_store_performance": ("store_key", "year", "month"),
    # one row per version of a campaign whose attributes differ
    "mv_promotion_effectiveness": ("campaign_id", "campaign_name", "campaign_type", "channel", "target_segment"),
}


@dataclass
class RefreshStatus:
    name: str
    ok: bool
    path: str | None
    rows: int | None
    duplicate_keys: int | None
    seconds: float
    error: str | None = None


def duplicate_keys(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Key groups that occur more than once (audit Q1 on a summary)."""
    return df.groupBy(*key).count().filter(F.col("count") > 1)


def refresh_summaries(star: Star, spark: SparkSession, params: CatalogueParams = RETAIL,
                      names=tuple(SUMMARY_KEYS), root: str | None = None) -> list[RefreshStatus]:
    out = []
    for name in names:
        t0 = time.time()
        path = f"{root.rstrip('/')}/{name}" if root else new_table_path(spark, name)
        try:
            df = CATALOGUE[name](star, params)
            df.write.mode("overwrite").parquet(path)
            written = spark.read.parquet(path)
            rows = written.count()
            dups = duplicate_keys(written, SUMMARY_KEYS[name]).count()
            out.append(RefreshStatus(name, dups == 0, path, rows, dups, time.time() - t0,
                                     None if dups == 0 else "duplicate summary keys"))
            log.info("summary %s refreshed: %d rows", name, rows)
        except Exception as e:  # keep going: one summary must not block the others
            log.warning("summary %s skipped: %s", name, e)
            out.append(RefreshStatus(name, False, None, None, None, time.time() - t0, str(e)))
    return out


def read_summary(spark: SparkSession, status: RefreshStatus) -> DataFrame:
    if not status.ok or not status.path:
        raise ValueError(f"summary {status.name} is not available: {status.error}")
    return spark.read.parquet(status.path)


def register_summary_views(spark: SparkSession, statuses: list[RefreshStatus]) -> list[str]:
    """Temp views named like the summaries (``mv_monthly_sales`` ...) over the
    latest successful refresh, for SQL dashboards."""
    names = []
    for st in statuses:
        if st.ok:
            read_summary(spark, st).createOrReplaceTempView(st.name)
            names.append(st.name)
    return names


def publish_summaries(spark: SparkSession, statuses: list[RefreshStatus], database: str) -> list[str]:
    """Point one catalog table per summary (``database.mv_monthly_sales`` ...)
    at its latest successful refresh.  The switch is a metadata change
    (``ALTER TABLE ... SET LOCATION``), so a dashboard reading the table sees
    either the old or the new version, never a half-written one (T15); a
    failed refresh leaves the previous version published (T14)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} "
              f"LOCATION '{shared_dir(spark)}/starweave/catalog/{database}.db'")
    published = []
    for st in statuses:
        if not st.ok:
            continue
        table = f"{database}.{st.name}"
        if spark.catalog.tableExists(table):
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{st.path}'")
            spark.sql(f"REFRESH TABLE {table}")
        else:
            spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{st.path}'")
        published.append(table)
    return published
