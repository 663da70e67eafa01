"""How the word use of each source of a language departs from the others'.

Terms are counted in one pass over whole texts.  Each (lang, source) group is a
segment tree over the term ids of its language whose leaves are counts.  The
trees are hash-consed: equal count subtrees are one node, shared by all groups.
Two trees are traversed together, level by level; equal pairs of nodes meet in
the memo of the level and are expanded, and at the leaves priced, once, with
the number of places they stand for.

The ids of a language are dealt over shards (top-level subtrees) of about
``SHARD_TERMS`` terms and its sources over blocks of about ``BLOCK_SOURCES``;
a task holds one shard of one or two blocks, so neither a hot source nor a
large vocabulary meets in one task, and partial prices are added by Spark.

A pair of groups a, b is priced as the sum over all kept terms of
f = floor((p - q)^2 / q), p = 1 + floor(10^9 (count + 1) / (N + V)) for a and q
the same for b.  The ``term`` part compares a group with its whole language and
keeps its ``TOP`` terms.

Defined results: null text, lang and source are empty strings; a group without
terms takes part with count 0; a language without kept terms gives pairs of
value 0; very long texts are counted whole, in windows; equal values are ranked
by item; repeated rows count as documents of their own, whatever their ids; an
empty table gives no rows; further columns are left out, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import persist, table

MIN_DOCS = 3
SCALE = 10 ** 9
TOP = 200
SHARD_TERMS = 8192
BLOCK_SOURCES = 64
HELD = 150_000          # distinct (group, term) counters of a task before they are sent on
TEXT_WINDOW = 1 << 20
FRONTIER = 1 << 20      # node pairs that a traversal may hold at its widest level
COUNTS = "lang string, source string, term string, n long, docs long"
PRICES = "lang string, source string, part string, item string, value long"
# Bytes that belong to a term, folded; the others become spaces.
FOLD = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


# ------------------------------------------------------------------ counting
def term_windows(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a bounded piece at a time."""
    folded = text.translate(FOLD)
    at = 0
    while at < len(folded):
        end = at + TEXT_WINDOW
        if end < len(folded):
            cut = folded.find(b" ", end)
            end = cut if cut >= 0 else len(folded)
        yield folded[at:end].split()
        at = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in groups.items():
            k = len(n) + 1      # the null term says that the group occurs
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * k), pa.array([source] * k), pa.array([None, *(t.decode() for t in n)], pa.string()),
                 pa.array([0, *n.values()], pa.int64()), pa.array([0, *(docs[t] for t in n)], pa.int64())],
                names=["lang", "source", "term", "n", "docs"])
        groups.clear()

    held = 0
    for batch in batches:
        for lang, source, text in zip(*batch.columns):
            n, docs = groups.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
            before, seen = len(n), set()
            for words in term_windows(text.as_py()):
                n.update(words)
                seen.update(words)
            docs.update(seen)
            held += len(n) - before
            if held > HELD:
                yield from out()
                held = 0
    yield from out()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of every group; the row with a null term
    is there for every group."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(text("lang").alias("lang"), text("source").alias("source"), text("text").cast("binary").alias("text"))
    return (rows.mapInArrow(_count, COUNTS).groupBy("lang", "source", "term")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


# ------------------------------------------------------------------ trees
def hash_cons(counts: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Segment trees over the rows of ``counts`` (sources x terms, -1 where a
    place has no term): (leaf values, (left, right) children of the nodes of
    each level from the leaves up, root of each row).  The nodes of a level are
    the distinct pairs of nodes below, whatever row they come from."""
    width = 1 << max(0, counts.shape[1] - 1).bit_length()
    full = np.full((counts.shape[0], width), -1, np.int64)
    full[:, :counts.shape[1]] = counts
    values, ids = np.unique(full, return_inverse=True)
    ids = ids.reshape(full.shape)
    levels, size = [], len(values)
    while ids.shape[1] > 1:
        nodes, above = np.unique(ids[:, ::2] * size + ids[:, 1::2], return_inverse=True)
        levels.append((nodes // size, nodes % size))
        ids, size = above.reshape(ids.shape[0], -1), len(nodes)
    return values, levels, ids[:, 0]


def leaf_pairs(levels, roots: np.ndarray, a: np.ndarray, b: np.ndarray):
    """Simultaneous traversal of the trees ``a[i]`` and ``b[i]`` for all i:
    (i, leaf of a, leaf of b, number of places), each distinct pair of leaves
    once for every i.  Equal node pairs of a level are merged before they are
    expanded."""
    pair, x, y = np.arange(len(a)), roots[a], roots[b]
    times = np.ones(len(a), np.int64)
    for left, right in reversed(levels):
        pair = np.concatenate([pair, pair])
        x, y = np.concatenate([left[x], right[x]]), np.concatenate([left[y], right[y]])
        times = np.concatenate([times, times])
        size = int(max(x.max(), y.max())) + 1
        if len(a) * size * size < 1 << 62:
            key, first, where = np.unique((pair * size + x) * size + y, return_index=True, return_inverse=True)
        else:
            key, first, where = np.unique(np.stack([pair, x, y]), axis=1, return_index=True, return_inverse=True)
        merged = np.zeros(len(first), np.int64)
        np.add.at(merged, where.ravel(), times)
        pair, x, y, times = pair[first], x[first], y[first], merged
    return pair, x, y, times


def shares(values: np.ndarray, total: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """p of every leaf value (columns) for every source (rows), exactly; the
    place without a term has p = 1 everywhere, so it is priced 0."""
    over = total + kept
    if not len(values) or int(values[-1]) < 9_000_000_000:
        p = 1 + (SCALE * (values + 1))[None, :] // np.maximum(over, 1)[:, None]
    else:
        p = np.array([[1 + SCALE * (v + 1) // max(o, 1) for v in values.tolist()] for o in over.tolist()], np.int64)
    p[:, values < 0] = 1
    return p


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def price_pairs(counts: np.ndarray, total: np.ndarray, kept: np.ndarray, a: np.ndarray, b: np.ndarray):
    """Prices of the pairs (a[i], b[i]) and (b[i], a[i]) of rows of ``counts``."""
    values, levels, roots = hash_cons(counts)
    p = shares(values, total, kept)
    there, back = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    slab = max(1, FRONTIER // max(1, counts.shape[1]))
    for lo in range(0, len(a), slab):
        i, j = a[lo:lo + slab], b[lo:lo + slab]
        pair, x, y, times = leaf_pairs(levels, roots, i, j)
        pa_, pb = p[i[pair], x], p[j[pair], y]
        np.add.at(there, lo + pair, price(pa_, pb) * times)
        np.add.at(back, lo + pair, price(pb, pa_) * times)
    return there, back


def top_terms(counts: np.ndarray, p: np.ndarray, q: np.ndarray, top: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(source, terms, values): its best terms with a count and p > q, terms in
    ascending order of their ids among equal values."""
    for s in range(counts.shape[0]):
        at = np.flatnonzero((counts[s] > 0) & (p[s] > q))
        value = price(p[s, at], q[at])
        best = np.lexsort((at, -value))[:top]
        yield s, at[best], value[best]


def _price_block(top: int):
    def run(key, rows):
        lang, _, a_block, b_block = [k.as_py() for k in key]
        no_term = pc.is_null(rows.column("term"))
        heads = rows.filter(no_term).select(["source", "blk", "total", "kept", "lang_total", "here"])
        heads = heads.sort_by("source").to_pydict()
        names = heads["source"]
        total, kept = np.array(heads["total"], np.int64), np.array(heads["kept"], np.int64)
        body = rows.filter(pc.invert(no_term))
        terms = sorted(set(body.column("term").unique().to_pylist()))       # code points: UTF-8 order
        term_at = {t: i for i, t in enumerate(terms)}
        source_at = {s: i for i, s in enumerate(names)}
        t = np.array([term_at[x] for x in body.column("term").to_pylist()], np.int64)
        s = np.array([source_at[x] for x in body.column("source").to_pylist()], np.int64)
        places = max(heads["here"])          # kept terms of the shard, those of other blocks too
        counts = np.zeros((len(names), places), np.int64)
        counts[s, t] = body.column("n").to_numpy()
        lang_n = np.zeros(places, np.int64)
        lang_n[t] = body.column("all_n").to_numpy()
        out = {"source": [], "part": [], "item": [], "value": []}

        blk = np.array(heads["blk"], np.int64)
        if a_block == b_block:
            a, b = np.triu_indices(len(names), 1)
        else:
            left, right = np.flatnonzero(blk == a_block), np.flatnonzero(blk == b_block)
            a, b = np.repeat(left, len(right)), np.tile(right, len(left))
        if len(a):
            order = np.argsort(-lang_n, kind="stable")       # rare terms side by side share their subtrees
            there, back = price_pairs(counts[:, order], total, kept, a, b)
            for i, j, x, y in zip(a.tolist(), b.tolist(), there.tolist(), back.tolist()):
                out["source"] += [names[i], names[j]]
                out["item"] += [names[j], names[i]]
                out["value"] += [x, y]
            out["part"] = ["pair"] * len(out["source"])
        if a_block == b_block and terms:
            values, ids = np.unique(np.concatenate([counts.ravel(), lang_n]), return_inverse=True)
            ids = ids.ravel()
            p = np.take_along_axis(shares(values, total, kept), ids[:counts.size].reshape(counts.shape), 1)
            q = shares(values, np.array(heads["lang_total"][:1], np.int64), kept[:1])[0, ids[counts.size:]]
            for i, at, value in top_terms(counts, p, q, top):
                out["source"] += [names[i]] * len(at)
                out["part"] += ["term"] * len(at)
                out["item"] += [terms[k] for k in at.tolist()]
                out["value"] += value.tolist()
        k = len(out["source"])
        return pa.table({"lang": pa.array([lang] * k, pa.string()), "source": pa.array(out["source"], pa.string()),
                         "part": pa.array(out["part"], pa.string()), "item": pa.array(out["item"], pa.string()),
                         "value": pa.array(out["value"], pa.int64())})

    return run


# ------------------------------------------------------------------ Spark
def _pieces(n: Column, each: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(n / F.lit(each))).cast("int")


def divergence(spark: SparkSession, docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP,
               shard_terms: int = SHARD_TERMS, block_sources: int = BLOCK_SOURCES) -> DataFrame:
    """(lang, source, part, item, value, rank) as described above."""
    counted = persist(spark, term_counts(docs), "term-counts")
    vocabulary = persist(spark, (counted.where("term is not null").groupBy("lang", "term")
                                 .agg(F.sum("n").alias("all_n"), F.sum("docs").alias("docs"))
                                 .where(F.col("docs") >= min_docs).drop("docs")), "vocabulary")
    kept = persist(spark, counted.join(vocabulary, ["lang", "term"]).select("lang", "source", "term", "n", "all_n"), "kept-terms")
    langs = (counted.where("term is null").groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
             .join(vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("all_n").alias("lang_total")),
                   "lang", "left").na.fill(0, ["kept", "lang_total"])
             .withColumn("shards", _pieces(F.col("kept"), shard_terms))
             .withColumn("blocks", _pieces(F.col("sources"), block_sources)))
    langs = persist(spark, langs, "langs")
    groups = (counted.where("term is null").select("lang", "source")
              .join(kept.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
              .na.fill(0, ["total"]).join(langs, "lang")
              .withColumn("blk", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int")))
    every = F.explode(F.sequence(F.lit(0), F.col("shards") - 1))
    shard = F.pmod(F.xxhash64("term"), F.col("shards")).cast("int").alias("shard")
    filled = (vocabulary.join(langs.select("lang", "shards"), "lang").groupBy("lang", shard)
              .agg(F.count(F.lit(1)).alias("here")))
    heads = groups.withColumn("shard", every).join(filled, ["lang", "shard"], "left").na.fill(0, ["here"]).select(
        "lang", "shard", "blk", "blocks", "source", F.lit(None).cast("string").alias("term"),
        F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("all_n"), "total", "kept", "lang_total", "here")
    rows = kept.join(langs.select("lang", "shards", "blocks"), "lang").select(
        "lang", shard, F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int").alias("blk"), "blocks", "source", "term",
        "n", "all_n", *[F.lit(0).cast("long").alias(c) for c in ("total", "kept", "lang_total", "here")])
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (heads.unionByName(rows).withColumn("other", other)
             .withColumn("a_blk", F.least("blk", "other")).withColumn("b_blk", F.greatest("blk", "other"))
             .drop("blocks", "other"))
    prices = persist(spark, dealt.groupBy("lang", "shard", "a_blk", "b_blk").applyInArrow(_price_block(top), PRICES), "prices")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = (prices.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
             .withColumn("rank", F.row_number().over(order)))
    terms = prices.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.unionByName(terms)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(spark, table(spark, sf_dir, "documents"))


OP13_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), w AS (
  SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d
), v AS (
  SELECT lang, term, count(*) AS all_n FROM w GROUP BY ALL HAVING count(DISTINCT id) >= 3
), l AS (
  SELECT lang, count(*) AS kept, sum(all_n) AS total FROM v GROUP BY lang
), g AS (
  SELECT DISTINCT lang, source FROM d
), c AS (
  SELECT w.lang, source, w.term, count(*) AS n FROM w JOIN v ON v.lang = w.lang AND v.term = w.term GROUP BY ALL
), t AS (
  SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL
), p AS (
  SELECT g.lang, g.source, v.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(t.total, 0) + l.kept) AS p,
         1 + (1000000000::HUGEINT * (v.all_n + 1)) // (l.total + l.kept) AS q
  FROM g JOIN v ON v.lang = g.lang JOIN l ON l.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term
  LEFT JOIN t ON t.lang = g.lang AND t.source = g.source
), pairs AS (
  SELECT g.lang, g.source, o.source AS item, coalesce(s.value, 0) AS value
  FROM g JOIN g o ON o.lang = g.lang AND o.source <> g.source
  LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
             FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) s
  ON s.lang = g.lang AND s.source = g.source AND s.item = o.source
), terms AS (
  SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL SELECT * FROM (
  SELECT lang, source, 'term' AS part, item, CAST(value AS BIGINT) AS value,
    CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM terms)
WHERE rank <= 200
"""
