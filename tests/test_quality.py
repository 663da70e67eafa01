"""Q1-Q11: zero rows on clean fixtures, exactly the planted row on dirty ones."""

from pyspark.sql import functions as F

from starweave.operators import quality as Q


def _nonempty(audits):
    return {k: v.count() for k, v in audits.items() if v.count() > 0}


def test_clean_sources_have_no_violations(retail):
    assert _nonempty(Q.source_audits(retail)) == {}


def test_planted_violations_are_found(retail_dirty):
    got = _nonempty(Q.source_audits(retail_dirty))
    assert got == {
        "Q1:customers": 1,                    # C1 twice
        "Q4:stores.store_type": 1,            # 'Kiosk'
        "Q5:stores.city->province": 1,        # Bandung in two provinces
        "Q6": 1,                              # D12 subtotal
        "Q7": 1,                              # T2 header vs lines
        "Q8": 1,                              # K4 ending stock
        "Q9": 1,                              # F3 rating 1 'Positive'
        "Q10": 1,                             # usage on a Cancelled transaction
        "Q11": 1,                             # F4 product not in T5, 58 days later
    }


def test_q5_lists_parents(retail_dirty):
    r = Q.hierarchy_violations(retail_dirty["stores"], "city", "province").first()
    assert (r.city, r.parents) == ("Bandung", 2)
    pairs = sorted(tuple(x) for x in Q.hierarchy_violation_pairs(retail_dirty["stores"], "city", "province").collect())
    assert pairs == [("Bandung", "Banten"), ("Bandung", "Jawa Barat")]


def test_orphans_and_nulls(spark):
    child = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    parent = spark.createDataFrame([("a",)], "k string")
    assert sorted(r.id for r in Q.orphans(child, "k", parent, "k").collect()) == [2, 3]
    assert [r.id for r in Q.nulls(child, ["k"]).collect()] == [3]


def test_load_counts(spark, retail):
    from starweave.plans.etl import build_star
    counts = Q.load_counts(build_star(spark, retail, "2025-01-01").tables())
    assert counts["dim_time"] == 730 and counts["dim_payment_method"] == 5
    assert counts["dim_promotion"] == 3 and counts["fact_sales"] == 9
