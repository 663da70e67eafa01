"""Writing the star and reading it back.

Every build goes to a fresh folder under the cluster-shared directory (T15:
readers of an older build never see a half-written table; the caller
switches to the new ``Star`` once every table is written).  The fact is
partitioned by ``sale_year`` and sorted by ``time_key`` inside each file,
so a time filter prunes directories and row groups.

Row counts are observed while the tables are written (``Observation``, no
extra pass; Q12) and kept in a small ``_manifest`` table.  The dimension
counts are the proven bounds ``Star.base`` uses to decide on broadcasting.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import new_table_path
from .star import DIMENSIONS, FACT_PARTITION, Star

# Dimensions whose size is fixed by construction are written as one file.
SINGLE_FILE = {"time", "payment"}
MANIFEST = "_manifest"
MANIFEST_SCHEMA = "table string, rows long, bytes long, value string"


FIXED_WIDTH = {T.IntegerType: 4, T.LongType: 8, T.DoubleType: 8, T.DateType: 4, T.BooleanType: 1,
               T.DecimalType: 16, T.TimestampType: 8, T.ShortType: 2, T.ByteType: 1, T.FloatType: 4}


def _size_metrics(df: DataFrame) -> list:
    """Row count and an upper bound of the in-memory bytes of all columns
    (fixed widths + actual string lengths), observed while writing."""
    fixed = sum(FIXED_WIDTH.get(type(f.dataType), 16) for f in df.schema.fields
                if not isinstance(f.dataType, T.StringType))
    strings = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields
               if isinstance(f.dataType, T.StringType)]
    text = sum(strings[1:], strings[0]) if strings else F.lit(0)
    return [F.count(F.lit(1)).alias("rows"),
            (F.count(F.lit(1)) * (fixed + 8) + F.coalesce(F.sum(text), F.lit(0))).alias("bytes")]


def write_dimensions(star: Star, path: str) -> tuple[dict[str, int], dict[str, int]]:
    """Write the seven dimensions; their row counts and byte bounds."""
    counts: dict[str, int] = {}
    sizes: dict[str, int] = {}
    for dim, (table, _) in DIMENSIONS.items():
        df = star.dims[dim]
        if dim in SINGLE_FILE:
            df = df.coalesce(1)
        obs = Observation(table)
        df.observe(obs, *_size_metrics(df)).write.mode("overwrite").parquet(f"{path}/{table}")
        counts[table], sizes[table] = obs.get["rows"], obs.get["bytes"]
    return counts, sizes


def write_fact(fact: DataFrame, path: str) -> int:
    """Write the fact below ``path``; its row count."""
    obs = Observation("fact_sales")
    # REBALANCE by year before writing: each task then holds one year's rows
    # and writes one file (not one file per year per task); AQE splits a hot
    # year over several tasks and coalesces small ones to the advisory size,
    # without the sampling pass of a range repartition (which would run the
    # whole fact-building join twice).  Sorting by time_key inside each task
    # keeps row groups narrow for min/max skipping.  The row count is
    # observed above the exchange.
    partitioned = FACT_PARTITION in fact.columns
    f = fact
    if partitioned:
        f = f.hint("rebalance", FACT_PARTITION).sortWithinPartitions(FACT_PARTITION, "time_key")
    w = f.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if partitioned:
        w = w.partitionBy(FACT_PARTITION)
    w.parquet(f"{path}/fact_sales")
    return obs.get["rows"]


def write_manifest(spark: SparkSession, path: str, counts: dict[str, int], sizes: dict[str, int],
                   values: dict[str, str]) -> None:
    rows = [(t, n, sizes.get(t), None) for t, n in sorted(counts.items())]
    rows += [(k, None, None, v) for k, v in sorted(values.items())]
    (spark.createDataFrame(rows, MANIFEST_SCHEMA)
          .coalesce(1).write.mode("overwrite").parquet(f"{path}/{MANIFEST}"))


def write_star(star: Star, spark: SparkSession, path: str | None = None, promo_policy: str | None = None) -> str:
    path = path or new_table_path(spark, "star")
    counts, sizes = write_dimensions(star, path)
    counts["fact_sales"] = write_fact(star.fact, path)
    values = {"trx_level": ",".join(sorted(star.trx_level)), "fact_schema": star.fact.schema.json()}
    if promo_policy:
        values["promo_policy"] = promo_policy
    write_manifest(spark, path, counts, sizes, values)
    return path


# A fact that was advanced lies in several folders: each holds the years that
# were last written there.  One manifest value per folder: "years|folder".
PART = "fact_part:"


def fact_parts(spark: SparkSession, path: str, rows: list | None = None) -> list[tuple[str, list[int] | None]]:
    """(folder, years read from it); None: all years."""
    rows = manifest_rows(spark, path) if rows is None else rows
    parts = []
    for r in sorted((r for r in rows if r["table"].startswith(PART)), key=lambda r: r["table"]):
        years, folder = r["value"].split("|", 1)
        parts.append((folder, [int(y) for y in years.split(",")]))
    return parts or [(f"{path}/fact_sales", None)]


def read_parts(spark: SparkSession, parts: list[tuple[str, list[int] | None]], schema: T.StructType | None = None) -> DataFrame:
    """The fact of these folders; year filters prune in each of them."""
    out = None
    for folder, years in parts:
        reader = spark.read if schema is None else spark.read.schema(schema)
        df = reader.parquet(folder)
        df = df if years is None else df.where(F.col(FACT_PARTITION).isin(years))
        out = df if out is None else out.unionByName(df)
    return out


def manifest_rows(spark: SparkSession, path: str) -> list:
    """The manifest, a few dozen rows; empty where a star has none."""
    try:
        return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{path}/{MANIFEST}").collect()
    except AnalysisException:  # no manifest there; anything else raises
        return []


def manifest_value(spark: SparkSession, path: str, key: str) -> str | None:
    return next((r["value"] for r in manifest_rows(spark, path) if r["table"] == key), None)


def load_manifest(spark: SparkSession, path: str, what: str = "rows", rows: list | None = None) -> dict[str, int]:
    rows = manifest_rows(spark, path) if rows is None else rows
    if rows:
        return {r["table"]: r[what] for r in rows if r[what] is not None}
    if what != "rows":  # a star written without manifest: count the dimensions
        return {}
    return {t: spark.read.parquet(f"{path}/{t}").count() for t, _ in DIMENSIONS.values()}


def read_star(spark: SparkSession, path: str, broadcast_rows: int | None = None) -> Star:
    rows = manifest_rows(spark, path)
    values = {r["table"]: r["value"] for r in rows if r["value"] is not None}
    dims = {dim: spark.read.parquet(f"{path}/{table}") for dim, (table, _) in DIMENSIONS.items()}
    counts = load_manifest(spark, path, "rows", rows)
    sizes = load_manifest(spark, path, "bytes", rows)
    bounds = {dim: counts.get(table) for dim, (table, _) in DIMENSIONS.items()}
    byte_bounds = {dim: sizes.get(table) for dim, (table, _) in DIMENSIONS.items()}
    # a fact without rows has no file to read its schema from
    schema = T.StructType.fromJson(json.loads(values["fact_schema"])) if "fact_schema" in values else None
    star = Star(read_parts(spark, fact_parts(spark, path, rows), schema), dims, bounds, location=path, byte_bounds=byte_bounds,
                trx_level=frozenset(t for t in values.get("trx_level", "").split(",") if t))
    if broadcast_rows is not None:
        star.broadcast_rows = broadcast_rows
    return star


def materialize(star: Star, spark: SparkSession, path: str | None = None) -> Star:
    return read_star(spark, write_star(star, spark, path), star.broadcast_rows)


# ---------------------------------------------------------------- catalog layout
def write_star_tables(star: Star, spark: SparkSession, database: str, path: str | None = None,
                      colocate: str = "product", buckets: int | None = None) -> str:
    """The star as catalog tables in ``database`` (external, under the shared
    folder), with the fact and the ``colocate`` dimension bucketed by that
    dimension's key into the same number of buckets.

    For that dimension the fact's pre-aggregation by key and the join then
    run without any exchange (the bucketed scan already provides the hash
    partitioning); the largest dimension is the one to pick.  The fact stays
    partitioned by ``sale_year`` and sorted by ``time_key`` in each file."""
    path = path or new_table_path(spark, f"star-{database}")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = DIMENSIONS[colocate][1]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{path}/_db'")
    counts: dict[str, int] = {}
    sizes: dict[str, int] = {}

    def save(df, table, bucket=False, partition=None, sort=None):
        obs = Observation(f"{database}.{table}")
        w = df.observe(obs, *_size_metrics(df)).write.mode("overwrite")
        if partition:
            w = w.partitionBy(partition)
        if bucket:
            w = w.bucketBy(buckets, key)
            if sort:
                w = w.sortBy(*sort)
        w.option("path", f"{path}/{table}").saveAsTable(f"{database}.{table}")
        counts[table], sizes[table] = obs.get["rows"], obs.get["bytes"]

    for dim, (table, _) in DIMENSIONS.items():
        df = star.dims[dim].coalesce(1) if dim in SINGLE_FILE else star.dims[dim]
        save(df, table, bucket=dim == colocate, sort=[key])
    part = FACT_PARTITION if FACT_PARTITION in star.fact.columns else None
    # one task per bucket: one file per bucket and year instead of one per task
    save(star.fact.repartition(buckets, key), "fact_sales", bucket=True, partition=part, sort=["time_key"])
    rows = [(t, n, sizes[t], None) for t, n in sorted(counts.items())] + [
        ("colocated", None, None, colocate), ("trx_level", None, None, ",".join(sorted(star.trx_level)))]
    (spark.createDataFrame(rows, "table string, rows long, bytes long, value string").coalesce(1)
          .write.mode("overwrite").option("path", f"{path}/{MANIFEST}")
          .saveAsTable(f"{database}.star_manifest"))
    return path


def read_star_tables(spark: SparkSession, database: str) -> Star:
    meta = spark.table(f"{database}.star_manifest").collect()
    counts = {r["table"]: r["rows"] for r in meta if r["rows"] is not None}
    colocated = next((r["value"] for r in meta if r["table"] == "colocated"), None)
    trx = next((r["value"] for r in meta if r["table"] == "trx_level"), None) or ""
    dims = {dim: spark.table(f"{database}.{table}") for dim, (table, _) in DIMENSIONS.items()}
    sizes = {r["table"]: r["bytes"] for r in meta if r["bytes"] is not None}
    bounds = {dim: counts.get(table) for dim, (table, _) in DIMENSIONS.items()}
    byte_bounds = {dim: sizes.get(table) for dim, (table, _) in DIMENSIONS.items()}
    return Star(spark.table(f"{database}.fact_sales"), dims, bounds, colocated=colocated,
                byte_bounds=byte_bounds, trx_level=frozenset(t for t in trx.split(",") if t))
