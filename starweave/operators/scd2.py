"""Slowly changing dimension, type 2, for the promotion dimension.

The reference declares effective/expiry/is_current columns but reloads the
table.  ``scd2_merge`` keeps history instead: a changed campaign closes its
current version (expiry = the load date - 1 day, is_current = false) and a
new current version opens on the load date.  Change detection compares a
hash of the tracked attributes; the merge is one full outer join on the
natural key, so it scales with the dimension, not with its history depth.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN_END = "2099-12-31"


def scd2_merge(current: DataFrame, incoming: DataFrame, key: str, tracked: Sequence[str],
               load_date, key_col: str = "promotion_key", open_end: str = OPEN_END) -> DataFrame:
    """Merge ``incoming`` (one row per natural key; a second one raises) into
    the versioned ``current`` dimension (effective_date, expiry_date,
    is_current).  A version opened on the load date is replaced, not closed."""
    twice = incoming.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(3).collect()
    if twice:
        raise ValueError(f"incoming rows repeat {key}: {[r[key] for r in twice]}")
    load = F.lit(str(load_date)).cast("date")
    tracked = list(tracked)
    h = lambda cols: F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in cols])

    history = current.filter(~F.col("is_current"))
    live = current.filter(F.col("is_current"))
    cur = live.select(key, h(tracked).alias("__h_old"))
    new = incoming.select(key, *tracked, h(tracked).alias("__h_new"))
    cmp = cur.join(new, key, "full_outer")

    changed = cmp.filter(F.col("__h_old").isNotNull() & F.col("__h_new").isNotNull()
                         & (F.col("__h_old") != F.col("__h_new"))).select(key)
    added = cmp.filter(F.col("__h_old").isNull()).select(key)

    # Close changed current versions; keep unchanged or vanished ones as they are.
    closed = (live.join(changed, key, "left_semi").where(F.col("effective_date") < load)
                  .withColumn("expiry_date", F.date_sub(load, 1))
                  .withColumn("is_current", F.lit(False)))
    kept = live.join(changed, key, "left_anti")
    opened = (incoming.join(changed.unionByName(added), key, "left_semi")
                      .select(key, *tracked)
                      .withColumn("effective_date", load)
                      .withColumn("expiry_date", F.lit(open_end).cast("date"))
                      .withColumn("is_current", F.lit(True)))
    opened = opened.withColumn(key_col, F.xxhash64(key, "effective_date"))
    cols = current.columns
    return (history.select(*cols).unionByName(kept.select(*cols)).unionByName(closed.select(*cols))
                   .unionByName(opened.select(*cols)))


def as_of(dim: DataFrame, date) -> DataFrame:
    """The version of each key valid on ``date``."""
    d = F.lit(str(date)).cast("date")
    return dim.filter((F.col("effective_date") <= d) & (F.col("expiry_date") >= d))
