"""URL lists as of the time of a fetch.

List entries are dated events (add, remove) on a pattern.  A window turns them
into validity intervals; every capture is joined, by equality on its possible
patterns, with the intervals open at its fetch time.  All of it is DataFrame
operations.  A capture has one key for each suffix of its host ('domain') and
one for each leading part of its path ('prefix'), so a host held by a third of
all captures stays an ordinary equi-join that AQE can split, or a broadcast
join when the counted intervals are few.

The verdict of a capture is the longest open pattern's; at equal length an
allow list wins, then the list and kind that sort first.

Defined results: a null url or one without a host matches nothing and is not
blocked; a null fetch time matches nothing; null patterns, dates or actions
are ignored; of entries with one date a removal is applied last; repeated
captures are judged one by one; empty lists block nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import persist, small_side, table

INTERVALS_BROADCAST = 50_000
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"
YEAR_SECONDS = 365 * 86400


def with_address(captures: DataFrame) -> DataFrame:
    """Adds host (lower case) and path of the url; '' where there is none."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    return captures.withColumns({"host": F.lower(F.regexp_extract(url, HOST, 1)), "path": F.regexp_extract(url, PATH, 1)})


def intervals(entries: DataFrame) -> DataFrame:
    """(list, verdict, kind, pattern, valid_from, valid_to) from dated entries
    (list, verdict, kind, pattern, ts, action); valid_to is null while open."""
    w = Window.partitionBy("list", "kind", "pattern").orderBy("ts", F.col("action"))
    rows = (entries.where("list is not null and kind is not null and pattern is not null and ts is not null "
                          "and action in ('add', 'remove')").distinct())
    return (rows.withColumn("valid_to", F.lead("ts").over(w)).where("action = 'add'")
            .select("list", "verdict", "kind", "pattern", F.col("ts").alias("valid_from"), "valid_to")
            .where("valid_to is null or valid_to > valid_from"))


def keys(captures: DataFrame) -> DataFrame:
    """One row for each pattern a capture can match: kind and pattern."""
    labels = F.split("host", r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.struct(F.lit("domain").alias("kind"),
                                             F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("pattern")))
    parts = F.filter(F.split("path", "/"), lambda x: x != "")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)),
                           lambda i: F.struct(F.lit("prefix").alias("kind"),
                                              F.concat_ws("/", F.col("host"), F.array_join(F.slice(parts, 1, i), "/")).alias("pattern")))
    both = F.concat(domains, F.when(F.size(parts) > 0, prefixes).otherwise(F.slice(domains, 1, 0)))
    return captures.where("host <> '' and fetch_ts is not null").withColumn("key", F.explode(both)).select(
        "*", "key.kind", "key.pattern").drop("key")


def evaluate(captures: DataFrame, valid: DataFrame) -> DataFrame:
    """``captures`` (page_id, url, fetch_ts) with host, n_active, blocked and
    the deciding rule, against the intervals open at fetch time."""
    rows = with_address(captures.select("page_id", "url", "fetch_ts"))
    k = keys(rows.select("page_id", "url", "host", "path", "fetch_ts").distinct())
    hit = k.join(valid, ["kind", "pattern"]).where(
        (F.col("valid_from") <= F.col("fetch_ts")) & (F.col("valid_to").isNull() | (F.col("fetch_ts") < F.col("valid_to"))))
    rule = F.concat_ws(":", "list", "kind", "pattern")
    best = F.struct((-F.length("pattern")).alias("l"), F.when(F.col("verdict") == "allow", 0).otherwise(1).alias("v"),
                    F.col("list").alias("n"), F.col("kind").alias("k"), rule.alias("rule"))
    told = (hit.groupBy("page_id", "url", "fetch_ts").agg(F.count(F.lit(1)).alias("n"), F.min(best).alias("b"))
            .select(F.col("page_id").alias("p"), F.col("url").alias("u"), F.col("fetch_ts").alias("t"), "n", "b"))
    same = F.col("page_id").eqNullSafe(F.col("p")) & (F.col("url") == F.col("u")) & (F.col("fetch_ts") == F.col("t"))
    return rows.join(told, same, "left").select(
        "page_id", "host", "fetch_ts", F.coalesce("n", F.lit(0)).alias("n_active"),
        F.coalesce(F.col("b.v") == 1, F.lit(False)).alias("blocked"), F.col("b.rule").alias("rule"))


def _draw(column) -> F.Column:
    """A number below 2^24 from the md5 of a string: the same in any engine."""
    return F.conv(F.substring(F.md5(F.encode(column, "UTF-8")), 1, 6), 16, 10).cast("long")


def page_captures(pages: DataFrame) -> DataFrame:
    """Pages as captures: the fetch second of 2024 follows from the id."""
    at = F.lit(1704067200) + F.pmod(F.col("page_id") * 7919, F.lit(YEAR_SECONDS))
    return pages.select("page_id", "url", F.timestamp_seconds(at).alias("fetch_ts"))


def derived_entries(pages: DataFrame) -> DataFrame:
    """A dated block list and allow list drawn from the addresses in the
    pages: parent domains, hosts and first path parts, added, partly removed
    and partly added again during 2024."""
    a = with_address(pages).where("host <> ''")
    parent = F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)
    first = F.concat(F.col("host"), F.lit("/"), F.regexp_extract("path", r"^/*([^/]+)", 1))
    found = (a.select(F.explode(F.array(
        F.struct(F.lit("domain").alias("kind"), parent.alias("pattern")),
        F.struct(F.lit("domain").alias("kind"), F.col("host").alias("pattern")),
        F.struct(F.lit("prefix").alias("kind"), first.alias("pattern")))).alias("e")).select("e.*")
        .where("pattern <> '' and pattern not like '%/'").distinct()
        .withColumn("x", _draw(F.concat_ws("|", "kind", "pattern"))).where("x % 5 < 2"))
    day = lambda d: F.timestamp_seconds(F.lit(1704067200) + (d) * 86400)
    x = F.col("x")
    events = F.array(
        F.struct(day(x % 200).alias("ts"), F.lit("add").alias("action"), F.lit(True).alias("kept")),
        F.struct(day(x % 200 + 60).alias("ts"), F.lit("remove").alias("action"), (x % 3 < 2).alias("kept")),
        F.struct(day(x % 200 + 110).alias("ts"), F.lit("add").alias("action"), (x % 3 == 0).alias("kept")))
    return (found.withColumn("ev", F.explode(events)).where("ev.kept")
            .select(F.when(x % 5 == 0, "blocklist").otherwise("allowlist").alias("list"),
                    F.when(x % 5 == 0, "block").otherwise("allow").alias("verdict"),
                    "kind", "pattern", "ev.ts", "ev.action"))


def op2_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    valid = persist(spark, intervals(derived_entries(pages)), "list-intervals")
    out = evaluate(page_captures(pages), small_side(valid, INTERVALS_BROADCAST))
    return out.withColumn("fetch_ts", F.unix_timestamp("fetch_ts"))


OP2_SQL = r"""
WITH a AS (
  SELECT page_id, url, 1704067200 + (page_id * 7919) % 31536000 AS fetch_ts,
    lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
    regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), patterns AS (
  SELECT 'domain' AS kind, regexp_extract(host, '([^.]+\.[^.]+)$', 1) AS pattern FROM a
  UNION SELECT 'domain', host FROM a
  UNION SELECT 'prefix', host || '/' || regexp_extract(path, '^/*([^/]+)', 1) FROM a WHERE host <> ''
), drawn AS (
  SELECT kind, pattern, ('0x' || substr(md5(kind || '|' || pattern), 1, 6))::BIGINT AS x
  FROM patterns WHERE pattern <> '' AND right(pattern, 1) <> '/'
), valid AS (
  SELECT *, 1704067200 + (x % 200) * 86400 AS f,
    CASE WHEN x % 3 < 2 THEN 1704067200 + (x % 200 + 60) * 86400
         ELSE 9999999999 END AS t
  FROM drawn WHERE x % 5 < 2
  UNION ALL
  SELECT *, 1704067200 + (x % 200 + 110) * 86400, 9999999999 FROM drawn WHERE x % 5 < 2 AND x % 3 = 0
), hit AS (
  SELECT a.page_id, a.url, v.x, v.kind, v.pattern,
    CASE WHEN v.x % 5 = 0 THEN 'blocklist' ELSE 'allowlist' END AS list
  FROM a JOIN valid v ON a.fetch_ts >= v.f AND a.fetch_ts < v.t AND (
    (v.kind = 'domain' AND (a.host = v.pattern OR ends_with(a.host, '.' || v.pattern)))
    OR (v.kind = 'prefix' AND starts_with(a.host || regexp_replace(a.path, '/+', '/', 'g') || '/', v.pattern || '/')))
), best AS (
  SELECT page_id, url, count(*) OVER (PARTITION BY page_id, url) AS n, list, kind, pattern,
    row_number() OVER (PARTITION BY page_id, url ORDER BY length(pattern) DESC, list, kind) AS r
  FROM (SELECT DISTINCT * FROM hit)
)
SELECT a.page_id, a.host, CAST(a.fetch_ts AS BIGINT) AS fetch_ts, CAST(coalesce(b.n, 0) AS BIGINT) AS n_active,
  coalesce(b.list = 'blocklist', false) AS blocked, b.list || ':' || b.kind || ':' || b.pattern AS rule
FROM a LEFT JOIN best b ON a.page_id = b.page_id AND a.url = b.url AND b.r = 1
"""
