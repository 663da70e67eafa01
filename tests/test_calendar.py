import datetime as dt

from starweave.functions.calendar import calendar


def test_calendar_edges(spark):
    cal = calendar(spark, "2025-01-01", 730)
    assert cal.count() == 730
    rows = {r.full_date: r for r in cal.filter(
        "full_date in (date'2025-01-01', date'2025-12-28', date'2025-12-29', date'2026-12-31')").collect()}
    got = [(rows[d].day_of_week, rows[d].week_of_year, rows[d].is_weekend) for d in sorted(rows)]
    assert got == [(2, 1, False), (6, 52, True), (0, 1, False), (3, 53, False)]
    r = rows[dt.date(2025, 1, 1)]
    assert (r.time_key, r.month_name, r.day_name, r.quarter) == (20250101, "Januari", "Rabu", 1)


def test_calendar_end_parameter(spark):
    assert calendar(spark, "1995-01-01", end="2001-12-31").count() == 2557


def test_time_dimension_schema_is_the_reference_one(spark):
    from starweave.sources.schemas import STAR_SCHEMAS
    assert tuple(calendar(spark, "2025-01-01", 3).columns) == STAR_SCHEMAS["dim_time"]
