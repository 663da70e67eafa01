import datetime as dt

from pyspark.sql import functions as F

from starweave.operators.scd2 import as_of, scd2_merge
from starweave.plans.etl import dim_promotion


def test_scd2_merge_closes_and_opens_versions(spark, retail):
    cur = dim_promotion(spark, retail["marketing_campaigns"])
    inc = spark.createDataFrame(
        [("CAM001", "Promo Satu v2", "Discount", "Website", "Gold"),       # changed channel + name
         ("CAM002", "Promo Dua", "Cashback", "Email", "All"),             # unchanged
         ("CAM003", "Promo Tiga", "Bundle", "Store", "Silver")],           # new
        "campaign_id string, campaign_name string, campaign_type string, channel string, target_segment string")
    merged = scd2_merge(cur, inc, "campaign_id",
                        ["campaign_name", "campaign_type", "channel", "target_segment"], "2025-06-01")
    rows = {(r.campaign_id, r.is_current): r for r in merged.collect()}
    assert rows[("CAM001", False)].expiry_date == dt.date(2025, 5, 31)
    assert rows[("CAM001", True)].channel == "Website"
    assert rows[("CAM001", True)].effective_date == dt.date(2025, 6, 1)
    assert rows[("CAM002", True)].effective_date == dt.date(2025, 1, 1)
    assert ("CAM003", True) in rows and ("NO_PROMO", True) in rows
    # one current row per campaign, distinct keys
    assert merged.filter("is_current").groupBy("campaign_id").count().filter("count > 1").count() == 0
    assert merged.select("promotion_key").distinct().count() == merged.count()
    assert {r.channel for r in as_of(merged, "2025-03-01").filter("campaign_id='CAM001'").collect()} == {"Store"}
