"""As-of join: a dated row meets the version of its key that was in effect.

The versions of a key are cut into calendar months, so that the join is an
equi-join on (key, month) with the interval as a remaining condition: a key with
a third of all rows is spread over the months it was sold in, and a version
table of any size can be shuffled or broadcast by the usual size rule.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _date(x) -> Column:
    return x if isinstance(x, Column) else F.lit(str(x)).cast("date")


def version_intervals(versions: DataFrame, key: str, effective: str = "effective_date",
                      first: dt.date | str = "0001-01-01", last: dt.date | str = "9999-12-31") -> DataFrame:
    """``versions`` with ``in_force_from`` and ``in_force_to`` (both included):
    a version lasts until the day before the next one of its key opens; the
    first one also covers the time before it, the last one all time after it.
    The intervals are clipped to [first, last] and those outside left out.

    Versions of a key that open on the same day: the one with the smallest
    remaining columns covers no day but the first interval's past."""
    rest = sorted(c for c in versions.columns if c not in (key, effective))
    order = Window.partitionBy(key).orderBy(F.col(effective).asc_nulls_first(), *rest)
    opens = F.when(F.lag(F.lit(1)).over(order).isNull(), _date(first)).otherwise(F.greatest(F.col(effective), _date(first)))
    closes = F.when(F.lead(F.lit(1)).over(order).isNull(), _date(last)).otherwise(
        F.least(F.date_sub(F.lead(effective).over(order), 1), _date(last)))
    return (versions.withColumns({"in_force_from": opens, "in_force_to": closes})
            .where("in_force_from <= in_force_to"))


def as_of_join(rows: DataFrame, intervals: DataFrame, key: str, when: str, columns: list[str],
               how: str = "inner", few: bool = False) -> DataFrame:
    """``rows`` with ``columns`` (of other names than its own) of the version
    of ``key`` in force on the day ``when``.  ``intervals`` come from ``version_intervals``, clipped to the
    days that occur (one row a month is made of each); ``few`` broadcasts them."""
    months = F.sequence(F.trunc("in_force_from", "month"), F.trunc("in_force_to", "month"), F.expr("INTERVAL 1 MONTH"))
    side = intervals.select(F.col(key).alias("__key"), *columns, F.col("in_force_from").alias("__from"),
                            F.col("in_force_to").alias("__to"), F.explode(months).alias("__month"))
    side = F.broadcast(side) if few else side
    match = ((F.col(key) == F.col("__key")) & (F.trunc(when, "month") == F.col("__month"))
             & F.col(when).between(F.col("__from"), F.col("__to")))
    return rows.join(side, match, how).drop("__key", "__from", "__to", "__month")
