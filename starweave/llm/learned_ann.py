"""Approximate nearest neighbours by learned partitions.

A bounded sample of the vectors gives a neighbour graph, which is cut into
parts of equal size by recursive bisection (a spectral split, then swaps that
lower the number of cut edges).  A small network learns from the sample which
parts the neighbours of a vector lie in.  Every vector is indexed in its most
probable part; a query is sent to its most probable parts, and all vectors
there are ranked exactly, in double precision.

Equal vectors are indexed once, with the smallest ids needed for a full
answer, so a vector held by a third of all rows costs one entry.  Large parts
are searched in blocks of candidates and of queries.

Defined results: rows whose vector is null, zero, of another length than most
or holds null or non-finite components, and rows with a null id, take no
part; repeated rows are entries of their own; fewer than ``k`` candidates give
all of them; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import persist, table

NEIGHBOURS = 20
SAMPLE = 8192               # vectors that reach the driver to learn the parts
GRAPH_DEGREE = 50
PART_ROWS = 8_000           # entries aimed at in a part
MIN_PARTS = 8               # of tables whose sample has 64 rows for each of them
MAX_PARTS = 256             # bounded by the sample, which must fill every part
TARGET_RECALL = 0.93        # of held-back sample rows; sets the number of probed parts
HELD_BACK = 8               # every eighth sampled row
HIDDEN = 64
EPOCHS = 12
BLOCK = 16_384              # entries or queries of one search block; each returns a query's k best


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Ids of the k rows with the largest inner product, per row."""
    k = min(k, len(x) - 1)
    out = np.zeros((len(x), k), np.int64)
    for a in range(0, len(x), 1024):
        s = x[a:a + 1024] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a:a + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def bisect(graph: np.ndarray, nodes: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Side (0 or 1) of every node: a smoothed random vector split at its
    median, then balanced swaps of the nodes that gain most by moving."""
    local = np.full(len(graph), -1, np.int64)
    local[nodes] = np.arange(len(nodes))
    nb = local[graph[nodes]]
    ok = nb >= 0
    nb = np.where(ok, nb, 0)
    deg = np.maximum(ok.sum(1), 1)
    n = len(nodes)
    src = np.repeat(np.arange(n), ok.sum(1))
    dst = nb[ok]
    both = np.bincount(src, minlength=n) + np.bincount(dst, minlength=n) + 1e-9
    v = rng.normal(size=n)
    for _ in range(60):
        v = v - (v * both).sum() / both.sum()
        v = v / (np.abs(v).max() + 1e-12)
        v = 0.5 * v + 0.5 * (np.bincount(src, v[dst], n) + np.bincount(dst, v[src], n)) / both
    side = np.zeros(n, np.int64)
    side[np.argsort(v, kind="stable")[n // 2:]] = 1
    for _ in range(12):
        sign = 2.0 * side - 1
        pull = np.bincount(src, sign[dst], n) + np.bincount(dst, sign[src], n)
        gain = -sign * pull
        a = np.flatnonzero(side == 0)
        b = np.flatnonzero(side == 1)
        a, b = a[np.argsort(-gain[a], kind="stable")], b[np.argsort(-gain[b], kind="stable")]
        m = min(len(a), len(b))
        swap = int(((gain[a[:m]] + gain[b[:m]]) > 0).sum()) // 2
        if not swap:
            break
        side[a[:swap]], side[b[:swap]] = 1, 0
    return side


def balanced_parts(graph: np.ndarray, parts: int, seed: int = 11) -> np.ndarray:
    rng, out = np.random.default_rng(seed), np.zeros(len(graph), np.int64)
    size = 1
    while size < parts:
        for p in range(size):
            nodes = np.flatnonzero(out == p)
            if len(nodes) > 1:
                side = bisect(graph, nodes, rng)
                out[nodes[side == 1]] = p + size
        size *= 2
    return out


class Router:
    """One hidden layer; probabilities over the parts."""

    def __init__(self, dim: int, parts: int, seed: int = 5):
        r = np.random.default_rng(seed)
        self.w1 = r.normal(0, np.sqrt(2 / dim), (dim, HIDDEN))
        self.b1 = np.zeros(HIDDEN)
        self.w2 = r.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts))
        self.b2 = np.zeros(parts)
        self.scale = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x * self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def fit(self, x: np.ndarray, target: np.ndarray, seed: int = 5) -> None:
        """Adam on the cross entropy with the share of a row's neighbours in
        each part."""
        self.scale = 1 / max(np.sqrt((x ** 2).mean()), 1e-12)
        r, t = np.random.default_rng(seed), 0
        names = ("w1", "b1", "w2", "b2")
        mom = {k: (np.zeros_like(getattr(self, k)), np.zeros_like(getattr(self, k))) for k in names}
        for _ in range(EPOCHS):
            order = r.permutation(len(x))
            for a in range(0, len(x), 128):
                rows = order[a:a + 128]
                xs = x[rows] * self.scale
                h = np.maximum(xs @ self.w1 + self.b1, 0)
                z = h @ self.w2 + self.b2
                p = np.exp(z - z.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                g = (p - target[rows]) / len(rows)
                gh = (g @ self.w2.T) * (h > 0)
                t += 1
                for k, grad in zip(names, (xs.T @ gh, gh.sum(0), h.T @ g, g.sum(0))):
                    m, v = mom[k]
                    m *= 0.9
                    m += 0.1 * grad
                    v *= 0.999
                    v += 0.001 * grad ** 2
                    step = 0.003 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
                    setattr(self, k, getattr(self, k) - step)


def learn(x: np.ndarray, entries: int) -> tuple[Router, int]:
    """The router for about ``entries`` indexed vectors from a sample x, and
    the number of parts to probe: the least that finds ``TARGET_RECALL`` of
    the nearest rows of sampled vectors held back from the training."""
    parts = 1
    while parts < MIN_PARTS and parts * 128 <= len(x):    # 64 sampled rows a part
        parts *= 2
    while parts * PART_ROWS < entries and parts < MAX_PARTS and parts * 64 <= len(x):
        parts *= 2
    if parts == 1:
        return Router(x.shape[1] if x.ndim == 2 else 1, 1), 1
    held = np.arange(len(x)) % HELD_BACK == HELD_BACK - 1
    x, asked = x[~held], x[held]
    graph = neighbour_graph(x, GRAPH_DEGREE)
    part = balanced_parts(graph, parts)
    target = np.zeros((len(x), parts))
    for c in range(graph.shape[1]):
        np.add.at(target, (np.arange(len(x)), part[graph[:, c]]), 1.0)
    router = Router(x.shape[1], parts)
    router.fit(x, target / target.sum(1, keepdims=True))
    own = router.logits(x).argmax(1)
    near = np.argsort(-(asked @ x.T), axis=1, kind="stable")[:, :NEIGHBOURS]
    place = np.argsort(np.argsort(-router.logits(asked), axis=1, kind="stable"), axis=1)
    needed = np.take_along_axis(place, own[near], 1)
    recall = np.array([(needed < m).mean() for m in range(1, parts + 1)])
    return router, int(np.flatnonzero(recall >= min(TARGET_RECALL, recall.max()))[0]) + 1


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _route(shared, probes: int, id_column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        router = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            z = router.logits(matrix(b.column("embedding")))
            top = np.argsort(-z, axis=1, kind="stable")[:, :probes]
            take = pa.array(np.repeat(np.arange(b.num_rows), top.shape[1]))
            rows = b.take(take)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(top.ravel().astype(np.int32))],
                                             names=[*b.schema.names, "part"])

    return run


def _search(k: int):
    """Best k (query, vector) pairs of a block of queries and one of entries."""
    def run(key, queries, entries):
        found = []
        if queries.num_rows and entries.num_rows:
            q, c = matrix(queries.column("embedding").combine_chunks()), matrix(entries.column("embedding").combine_chunks())
            ids = entries.column("ids").combine_chunks()
            offsets, flat = ids.offsets.to_numpy(), ids.flatten().to_numpy()
            offsets = offsets - offsets[0]
            need = min(k + 1, len(c))
            qid = queries.column("vec_id").to_numpy()
            for a in range(0, len(q), 256):
                s = q[a:a + 256] @ c.T
                floor = np.partition(s, len(c) - need, axis=1)[:, len(c) - need]
                for i in range(len(s)):
                    # every entry at the k-th best score, so ties are settled by id
                    at = np.flatnonzero(s[i] >= floor[i] - 1e-12 * max(1.0, abs(floor[i])))
                    exact = (c[at] * q[a + i]).sum(1)
                    who = np.concatenate([flat[offsets[j]:offsets[j + 1]] for j in at])
                    val = np.repeat(exact, [offsets[j + 1] - offsets[j] for j in at])
                    keep = who != qid[a + i]
                    who, val = who[keep], val[keep]
                    best = np.lexsort((who, -val))[:k]
                    found.append((np.full(len(best), qid[a + i]), who[best], val[best]))
        cols = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()),
                         "score": pa.array(cols[2], pa.float64())})

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite
                      & F.exists("embedding", lambda x: x != 0))
    usual = (rows.groupBy(F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("n"), "dim").limit(1))
    return rows.join(F.broadcast(usual), F.size("embedding") == F.col("dim")).select("vec_id", "embedding")


def nearest(spark: SparkSession, vectors: DataFrame, k: int = NEIGHBOURS, is_query=None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every query
    row (a condition on vec_id), by inner product."""
    rows = persist(spark, usable(vectors), "vectors")
    # Of equal vectors the k + 1 smallest ids can occur in an answer.
    w = Window.partitionBy("embedding").orderBy("vec_id")
    entries = persist(spark, rows.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1)
                      .groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
                      .withColumn("h", F.xxhash64("embedding")), "entries")
    n = entries.count()
    sample = [r["embedding"] for r in entries.orderBy("h", F.col("ids")[0]).limit(SAMPLE).select("embedding").collect()]
    router, probes = learn(np.array(sample, np.float64), n)
    shared = spark.sparkContext.broadcast(router)   # dim x HIDDEN + HIDDEN x MAX_PARTS numbers at most
    index = persist(spark, entries.select("embedding", "ids", "h").mapInArrow(
        _route(shared, 1, "h"), "embedding array<double>, ids array<long>, h long, part int"), "index")
    asked = rows.where(is_query if is_query is not None else F.lit(True))
    routed = persist(spark, asked.mapInArrow(
        _route(shared, probes, "vec_id"), "vec_id long, embedding array<double>, part int"), "routed-queries")
    # Blocks per part, from at most MAX_PARTS counts: a hot part is searched by many tasks.
    blocks = (index.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("nc"))
              .join(routed.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("nq")), "part"))
    blocks = F.broadcast(persist(spark, blocks, "blocks"))
    c = (index.join(blocks, "part").withColumn("cb", F.pmod(F.col("h"), F.col("nc")).cast("long"))
         .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nq").cast("long") - 1)))
         .select("part", "cb", "qb", "embedding", "ids"))
    q = (routed.join(blocks, "part").withColumn("qb", F.pmod(F.xxhash64("vec_id", "embedding"), F.col("nq")).cast("long"))
         .withColumn("cb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nc").cast("long") - 1)))
         .select("part", "cb", "qb", "vec_id", "embedding"))
    found = (q.groupBy("part", "cb", "qb").cogroup(c.groupBy("part", "cb", "qb"))
             .applyInArrow(_search(k), "query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op7_learned_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark, table(spark, sf_dir, "embeddings"), is_query=F.col("vec_id") % 20 == 0)
