"""Ratios are rounded on whole numbers; SCD2 replaces a same-day version."""

from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from starweave.functions.measures import exact_ratio
from starweave.operators.scd2 import scd2_merge
from starweave.plans.oracle_sql import exact

CASES = [("2.01", "2", 1), ("201.00", "20000.00", 100), ("-2.01", "2", 1), ("0.00", "-3", 1), ("1.00", "3", 100),
         ("1.005", "1", 1), ("123456789012345.67", "7.00", 100), ("5.00", "0", 1), (None, "3", 1), ("-1.00", "-8", 1)]


def _want(n, d, f):
    if n is None or not Decimal(d):
        return None
    n = Decimal(n).quantize(Decimal("0.01"), ROUND_HALF_UP)
    return float((f * n / Decimal(d)).quantize(Decimal("0.01"), ROUND_HALF_UP))


def test_exact_ratio(spark, duck):
    for n, d, f in CASES:
        num = F.lit(n).cast("decimal(25,3)") if n else F.lit(None).cast("decimal(25,3)")
        got = spark.range(1).select(exact_ratio(num, F.lit(d).cast("decimal(25,2)"), factor=f).alias("x")).first()["x"]
        sql = duck.cursor().execute(f"SELECT {exact('a', 'b', factor=f)} FROM (SELECT CAST(? AS DECIMAL(30,3)) a, CAST(? AS DECIMAL(30,2)) b)",
                           [n, d]).fetchall()[0][0]
        assert got == _want(n, d, f) == sql, (n, d, f, got, sql)


def test_scd2_same_day_and_duplicates(spark):
    cols = "promotion_key long, campaign_id string, channel string, effective_date date, expiry_date date, is_current boolean"
    cur = spark.createDataFrame([], cols)
    day = lambda ch: spark.createDataFrame([("C1", ch)], "campaign_id string, channel string")
    one = scd2_merge(cur, day("Store"), "campaign_id", ["channel"], "2025-06-01")
    two = scd2_merge(one, day("Email"), "campaign_id", ["channel"], "2025-06-01")
    rows = two.collect()
    assert [(r["channel"], r["is_current"]) for r in rows] == [("Email", True)]
    with pytest.raises(ValueError):
        scd2_merge(two, day("A").union(day("B")), "campaign_id", ["channel"], "2025-06-02")
