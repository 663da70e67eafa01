"""The calendar (time dimension) generator and date attribute columns.

The calendar is produced by ``spark.range`` so its size is known to the
optimizer (an exact row bound), it is generated on the executors, and the
range is a parameter rather than a fixed two-year span.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Month and day names of the time dimension, as the reference
# stores them (Indonesian), month 1..12 and weekday Monday..Sunday.
MONTH_NAMES = ("Januari", "Februari", "Maret", "April", "Mei", "Juni",
               "Juli", "Agustus", "September", "Oktober", "November", "Desember")
DAY_NAMES = ("Senin", "Selasa", "Rabu", "Kamis", "Jumat", "Sabtu", "Minggu")


def _name_at(names, one_based_index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), one_based_index)


def time_key(date_col: Column) -> Column:
    """Smart date key yyyymmdd (int). Deterministic, so the fact can carry it
    without a lookup join, and time ranges become key ranges."""
    return (F.year(date_col) * 10000 + F.month(date_col) * 100
            + F.dayofmonth(date_col)).cast("int")


def date_attributes(d: Column, month_names=MONTH_NAMES, day_names=DAY_NAMES) -> dict[str, Column]:
    """The ten calendar attributes of one date (weekday Monday=0, ISO week)."""
    wd = F.weekday(d)  # Monday=0 .. Sunday=6
    return {
        "time_key": time_key(d),
        "full_date": d,
        "day": F.dayofmonth(d),
        "month": F.month(d),
        "month_name": _name_at(month_names, F.month(d)),
        "quarter": F.quarter(d),
        "year": F.year(d),
        "week_of_year": F.weekofyear(d),
        "day_of_week": wd,
        "day_name": _name_at(day_names, wd + 1),
        "is_weekend": wd >= 5,
    }


def iso_year(d: Column) -> Column:
    """Year of the ISO week (T9: 2025-12-29 is week 1 of 2026)."""
    return F.extract(F.lit("YEAROFWEEK"), d).cast("int")


def _as_date(x) -> dt.date:
    return x if isinstance(x, dt.date) else dt.date.fromisoformat(str(x))


def calendar(spark: SparkSession, start="2025-01-01", days: int | None = 730,
             end=None, month_names=MONTH_NAMES, day_names=DAY_NAMES) -> DataFrame:
    """One row per day from ``start`` for ``days`` days (or through ``end``)."""
    s = _as_date(start)
    n = days if end is None else (_as_date(end) - s).days + 1
    if n is None or n <= 0:
        raise ValueError("calendar needs a positive number of days")
    d = F.date_add(F.lit(s), F.col("id").cast("int"))
    cols = date_attributes(d, month_names, day_names)
    out = spark.range(n).select(*[c.alias(k) for k, c in cols.items()])
    return out.withColumn("full_date", F.col("full_date").cast("date"))


def calendar_span(start="2025-01-01", days: int | None = 730, end=None) -> tuple[dt.date, dt.date]:
    """First and last day of ``calendar(...)``."""
    s = _as_date(start)
    return s, s + dt.timedelta(calendar_rows(start, days, end) - 1)


def calendar_rows(start="2025-01-01", days: int | None = 730, end=None) -> int:
    """Exact row count of ``calendar(...)``: the proven size bound."""
    s = _as_date(start)
    return days if end is None else (_as_date(end) - s).days + 1
