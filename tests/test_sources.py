"""The raw tables round-trip through files and build the same star."""

import os
import tempfile
from datetime import date

import pytest

from starweave.plans.etl import build_star
from starweave.sources import readers
from starweave.sources.readers import read_sources, write_table
from starweave.sources.schemas import SOURCE_SCHEMAS
from starweave.sources.tpch import TpchMapping, star_from_tpch


def test_sources_round_trip(spark, retail):
    root = tempfile.mkdtemp(prefix="sw-src-")
    for fmt in ("parquet", "csv"):
        for t, df in retail.items():
            ext = f".{fmt}"
            opts = {"header": "true"} if fmt == "csv" else {}
            w = df.write.mode("overwrite").format(fmt).options(**opts)
            w.save(os.path.join(root, fmt, t + ext))
        src = read_sources(spark, os.path.join(root, fmt), fmt)
        a = sorted(map(tuple, build_star(spark, src, "2025-01-01").table("fact_sales").collect()), key=str)
        b = sorted(map(tuple, build_star(spark, retail, "2025-01-01").table("fact_sales").collect()), key=str)
        assert a == b, fmt


def test_write_table_append_and_overwrite(spark):
    p = os.path.join(tempfile.mkdtemp(prefix="sw-sink-"), "t")
    df = spark.range(5)
    write_table(df, p, "overwrite")
    write_table(df, p, "append")
    assert spark.read.parquet(p).count() == 10
    write_table(df, p, "overwrite")
    assert spark.read.parquet(p).count() == 5


def test_tpch_without_fk_checks_same_when_clean(spark):
    a = star_from_tpch(spark, "/root/testdata/sf0.001").fact.count()
    b = star_from_tpch(spark, "/root/testdata/sf0.001", TpchMapping(enforce_fk=False)).fact.count()
    assert a == b


@pytest.mark.parametrize("column, predicates", [
    ("d", readers.date_slices("d", date(2024, 12, 30), date(2025, 1, 8), 4)),
    ("d", readers.date_slices("d", date(2025, 1, 1), date(2025, 1, 1), 9)),
    ("s", readers.range_slices("s", ["m", "c", "it's"])),
    ("s", readers.range_slices("s", [])),
    ("s", readers.hash_slices("s", 5))])
def test_every_row_fits_one_slice(spark, column, predicates):
    """The predicates are plain SQL, so Spark can say which rows they take."""
    rows = [(i, None if i % 11 == 0 else date(2024, 12, 20 + i % 12) if i % 2 else date(2025, 1, 1 + i % 12),
             None if i % 13 == 0 else ["", "c", "it's", "zebra", "ä", "m"][i % 6] + "x" * (i % 3)) for i in range(120)]
    df = spark.createDataFrame(rows, "id int, d date, s string")
    got = sorted(r.id for p in predicates for r in df.where(p).collect())
    assert got == list(range(120))
    assert len(predicates) == len(set(predicates))


def test_jdbc_reads_are_sliced_and_complete(spark, retail, monkeypatch):
    """No database is started: the planned reads are recorded instead."""
    plans = {}

    def load(self, session):
        plans[self.options["dbtable"]] = self
        return retail[self.options["dbtable"].split(".")[-1]]

    monkeypatch.setattr(readers.JdbcRead, "load", load)
    days = readers.date_slices("transaction_date", date(2025, 1, 1), date(2025, 12, 31), 12)
    src = read_sources(spark, "shop", "jdbc", options={"url": "jdbc:db://host/shop", "user": "u"},
                       slices={"sales_transactions": days})
    assert set(src) == set(SOURCE_SCHEMAS) and set(plans) == {f"shop.{t}" for t in SOURCE_SCHEMAS}
    assert len(days) == 12 and list(plans["shop.sales_transactions"].predicates) == days
    assert plans["shop.products"].predicates == () and plans["shop.products"].options == {
        "url": "jdbc:db://host/shop", "dbtable": "shop.products", "user": "u", "fetchsize": "10000"}
    a = sorted(map(tuple, build_star(spark, src, "2025-01-01").table("fact_sales").collect()), key=str)
    assert a == sorted(map(tuple, build_star(spark, retail, "2025-01-01").table("fact_sales").collect()), key=str)


def test_jdbc_plans_that_cannot_be_read(spark):
    with pytest.raises(ValueError, match="needs the option url"):
        read_sources(spark, "shop", "jdbc")
    with pytest.raises(ValueError, match="bounds"):
        readers.jdbc_read("jdbc:db://h", "t", partition_column="id")
    with pytest.raises(ValueError, match="not both"):
        readers.jdbc_read("jdbc:db://h", "t", partition_column="id", lower=0, upper=9, predicates=["a = 1"])
    got = readers.jdbc_read("jdbc:db://h", "t", {"url": "other"}, partition_column="id", lower=0, upper=9, num_partitions=3)
    assert got.options["url"] == "jdbc:db://h" and got.options["numPartitions"] == "3"


def test_parquet_gets_the_declared_columns_and_types(spark):
    p = os.path.join(tempfile.mkdtemp(prefix="sw-types-"), "t")
    spark.sql("SELECT 7L AS id, '2025-03-01' AS day, 1 AS more").write.parquet(p)
    got = readers.read_table(spark, p, schema="day date, id int")
    assert got.dtypes == [("day", "date"), ("id", "int")] and got.first() == (date(2025, 3, 1), 7)
    with pytest.raises(ValueError, match="no column price"):
        readers.read_table(spark, p, schema="id int, price double")
