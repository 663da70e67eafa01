"""SimHash near duplicates by the generalised pigeonhole principle.

A text's fingerprint has a bit set when over half of its shingle hashes have
it.  Two fingerprints within ``max_bits`` differing bits agree within t_i bits
on at least one of m bit groups, whenever the thresholds t_i add up to
``max_bits - m + 1`` (t_i = -1: the group is not probed).  Correlated bits are
put into one group, and a dynamic program spreads the thresholds so that the
number of candidates, estimated from the counts of group values over all
fingerprints, is smallest.  Fingerprints that meet under a probed value are
compared bit for bit, and only a spanning forest of the links found there is
kept, so a group of copies costs edges in proportion to its size.

A value shared by more than ``GROUP_LIMIT`` distinct fingerprints is not
compared all against all: those fingerprints are linked through the points
within max_bits/2 bits of each (two fingerprints are within max_bits bits
exactly when their balls of that radius meet), which stays linear and spreads
over tasks.

Defined results: a null or empty text has fingerprint zero and is linked like
any other; rows with a null doc_id keep a fingerprint and take their class's
component, null if no row of the class has an id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions_for, persist, table
from .components import components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
GROUP_LIMIT = 20_000
HIST_BITS = 16          # value counts of a group are kept for at most so many of its bits
PROBE_COST = 4.0        # one probe row, in units of one compared candidate


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter([h(line[a:b], SEED) for a, b in
                          zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())], np.uint64)
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(b.num_columns - 1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fps.view(np.int64))], names=[*b.schema.names[:-1], "fp"])

    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_fingerprints(shingle), "doc_id long, fp long")


# -- bit groups and thresholds ------------------------------------------------

def _bit_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    both = np.zeros((64, 64), np.float64)
    n = 0
    for b in batches:
        fp = b.column(0).to_numpy().astype("<i8")
        for at in range(0, len(fp), 1 << 15):
            bits = np.unpackbits(fp[at:at + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            bits = bits.astype(np.float64)
            both += bits.T @ bits
            n += len(bits)
    cells = both.ravel().astype(np.int64).tolist() + [n]
    yield pa.RecordBatch.from_pydict({"cell": pa.array(range(4097), pa.int64()), "n": pa.array(cells, pa.int64())})


def bit_correlation(fps: DataFrame) -> np.ndarray:
    """|correlation| of the 64 bits over all fingerprints (64 x 64 sums reach
    the driver, whatever the input)."""
    rows = fps.mapInArrow(_bit_pairs, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    cells = np.zeros(4097)
    for r in rows:
        cells[r["cell"]] = r["n"]
    n = max(cells[-1], 1)
    joint = cells[:-1].reshape(64, 64) / n
    p = np.diag(joint)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    return np.abs((joint - np.outer(p, p)) / np.outer(sd, sd))


def bit_groups(corr: np.ndarray, m: int) -> list[list[int]]:
    """m groups of near-equal size; each is grown from a free bit by the bit
    most correlated with the group, so groups are as independent as possible."""
    free, groups = set(range(64)), []
    for g in range(m):
        size = 64 // m + (g < 64 % m)
        left = sorted(free)
        group = [max(left, key=lambda b: (corr[b, left].sum(), -b))]
        free.discard(group[0])
        while len(group) < size:
            left = sorted(free)
            best = left[int(np.argmax(corr[np.ix_(left, group)].sum(1)))]
            group.append(best)
            free.discard(best)
        groups.append(sorted(group))
    return groups


def group_value(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(fp), np.uint64)
    for k, b in enumerate(bits):
        out |= ((fp >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)
    return out


def flips(width: int, radius: int) -> np.ndarray:
    """All masks of ``width`` bits with at most ``radius`` set."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(width), r)],
                    np.uint64)


def _value_counts(groups: list[list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(1 << min(len(g), HIST_BITS), np.int64) for g in groups]
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            for t, g in zip(totals, groups):
                t += np.bincount(group_value(fp, g[:HIST_BITS]).astype(np.int64), minlength=len(t))
        for i, t in enumerate(totals):
            at = np.flatnonzero(t)
            yield pa.RecordBatch.from_pydict({"g": pa.array(np.full(len(at), i), pa.int32()),
                                              "v": pa.array(at, pa.int64()), "n": pa.array(t[at], pa.int64())})

    return run


def candidate_cost(counts: np.ndarray, width: int, radius: int) -> float:
    """Estimated (query, candidate) meetings of a group probed within
    ``radius`` bits, plus the cost of its probe rows."""
    if radius < 0:
        return 0.0
    kept = min(width, HIST_BITS)
    at = np.arange(len(counts), dtype=np.int64)
    per_radius = [0.0] * (kept + 1)
    for r in range(min(radius, kept) + 1):
        for c in combinations(range(kept), r):
            per_radius[r] += float(counts @ counts[at ^ sum(1 << b for b in c)])
    extra = width - kept
    from math import comb
    met = sum(per_radius[r] * sum(comb(extra, q) for q in range(radius - r + 1)) / 2.0 ** extra
              for r in range(min(radius, kept) + 1))
    probes = sum(comb(width, r) for r in range(radius + 1))
    return met + PROBE_COST * probes * float(counts.sum())


def allocate(cost: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds per group with the given sum and least cost; cost[i][t + 1]
    is the cost of threshold t (from -1)."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in cost:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for s, (c, ts) in best.items():
            for t, x in enumerate(row, -1):
                if s + t not in nxt or c + x < nxt[s + t][0]:
                    nxt[s + t] = (c + x, [*ts, t])
        best = nxt
    return best[total]


def choose_plan(spark: SparkSession, fps: DataFrame, max_bits: int = MAX_BITS) -> list[tuple[list[int], int]]:
    """The (bits, threshold) groups with the least estimated cost; every count
    is over all fingerprints.  There are ``max_bits`` groups whatever the size
    of the table, so the thresholds add up to one and a fingerprint makes the
    same number of probes in a small table and a large one; the dynamic
    program says which groups may differ."""
    m = min(max(1, max_bits), 16)
    groups = bit_groups(bit_correlation(fps), m)
    rows = fps.mapInArrow(_value_counts(groups), "g int, v long, n long").groupBy("g", "v").agg(F.sum("n").alias("n"))
    counts = [np.zeros(1 << min(len(g), HIST_BITS)) for g in groups]
    for r in rows.toLocalIterator():  # at most 2^16 counters a group
        counts[r["g"]][r["v"]] = r["n"]
    total = max_bits - m + 1
    cost = [[float("inf"), *(candidate_cost(c, len(g), t) for t in range(total + 1))] for c, g in zip(counts, groups)]
    return list(zip(groups, allocate(cost, total)[1]))


# -- probe and verify -----------------------------------------------------------

def _probes(plan: list[tuple[list[int], int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                fp, node = part.column(0).to_numpy().view(np.uint64), part.column(1).to_numpy()
                for g, (bits, radius) in enumerate(plan):
                    masks = flips(len(bits), radius)
                    keys = (group_value(fp, bits)[:, None] ^ masks[None, :]).ravel()
                    own = np.tile(masks == 0, len(fp))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((keys * np.uint64(len(plan)) + np.uint64(g)).view(np.int64)), pa.array(own),
                         pa.array(np.repeat(fp, len(masks)).view(np.int64)), pa.array(np.repeat(node, len(masks)))],
                        names=["key", "own", "fp", "node"])

    return run


def forest(fp: np.ndarray, own: np.ndarray, node: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Spanning links of the fingerprints that meet under one value: those
    holding the value itself (own) against all, breadth first."""
    links = []
    if len(fp) <= 256:
        near = np.bitwise_count(fp[own][:, None] ^ fp[None, :]) <= max_bits
        if int(near.sum()) == int(own.sum()):
            return links
    free = np.ones(len(fp), bool)
    for seed in np.flatnonzero(own):
        if not free[seed]:
            continue
        free[seed] = False
        queue = [int(seed)]
        while queue:
            i = queue.pop()
            rest = np.flatnonzero(free if own[i] else free & own)
            near = rest[np.bitwise_count(fp[rest] ^ fp[i]) <= max_bits]
            if len(near):
                free[near] = False
                links += [(int(node[i]), int(node[j])) for j in near]
                queue += near.tolist()
    return links


def _verify(max_bits: int, limit: int):
    """Links (kind 0: u, v) of sorted probe rows; fingerprints under a value
    with over ``limit`` rows come out as kind 1 (u = fp, v = node)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(kind, u, v):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(u), kind), pa.int32()), pa.array(np.asarray(u, np.int64)),
                 pa.array(np.asarray(v, np.int64))], names=["kind", "u", "v"])

        held: list[tuple[np.ndarray, ...]] = []
        key, n, hot, links = None, 0, False, []

        def close():
            nonlocal held, n, links
            if held and not hot and n > 1:
                fp, own, node = (np.concatenate(c) for c in zip(*held))
                if own.any():
                    links += forest(fp, own, node, max_bits)
            held, n = [], 0

        for b in batches:
            keys = b.column(0).to_numpy()
            own = b.column(1).to_numpy(zero_copy_only=False)
            fp, node = b.column(2).to_numpy().view(np.uint64), b.column(3).to_numpy()
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]))
            for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if s == e:
                    continue
                if keys[s] != key:
                    close()
                    key, hot = keys[s], False
                held.append((fp[s:e], own[s:e], node[s:e]))
                n += e - s
                if n > limit:
                    hot = True
                if hot:
                    for f, _, d in held:
                        yield out(1, f.view(np.int64), d)
                    held = []
            if links:
                yield out(0, *zip(*links))
                links = []
        close()
        if links:
            yield out(0, *zip(*links))

    return run


def _ball(max_bits: int):
    """Points around a fingerprint: two balls of radii floor and ceil of
    max_bits/2 meet exactly when the fingerprints are within max_bits bits."""
    masks = flips(64, (max_bits + 1) // 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 64):
                fp = b.column(0).to_numpy()[at:at + 64].view(np.uint64)
                node = b.column(1).to_numpy()[at:at + 64]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((fp[:, None] ^ masks[None, :]).ravel().view(np.int64)),
                     pa.array(np.repeat(fp, len(masks)).view(np.int64)), pa.array(np.repeat(node, len(masks)))],
                    names=["point", "fp", "node"])

    return run


def keyed_fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, th, fp) of (doc_id, th, text): rows told apart by the hash of their text."""
    return docs.select("doc_id", "th", "text").mapInArrow(_fingerprints(shingle), "doc_id long, th long, fp long")


def links(spark: SparkSession, classes: DataFrame, max_bits: int = MAX_BITS,
          group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Edges (u, v) between class representatives, spanning the components of
    all pairs of distinct fingerprints (fp, node) within ``max_bits`` bits."""
    plan = choose_plan(spark, classes.select("fp"), max_bits)
    n = partitions_for(spark, classes.count() * 24 * sum(len(flips(len(g), t)) for g, t in plan))
    probes = (classes.select("fp", "node").mapInArrow(_probes(plan), "key long, own boolean, fp long, node long")
              .repartition(n, "key").sortWithinPartitions("key"))
    found = persist(spark, probes.mapInArrow(_verify(max_bits, group_limit), "kind int, u long, v long"), "links")
    edges = found.where("kind = 0").select("u", "v")
    hot = persist(spark, found.where("kind = 1").select(F.col("u").alias("fp"), F.col("v").alias("node"))
                  .distinct(), "hot-fingerprints")
    if max_bits % 2:
        raise ValueError("max_bits must be even")
    if not hot.isEmpty():
        points = hot.mapInArrow(_ball(max_bits), "point long, fp long, node long")
        # The smallest node at a point stands for the point.
        least = points.groupBy("point").agg(F.min("node").alias("u"))
        edges = edges.union(points.join(least, "point").where("u <> node")
                            .select("u", F.col("node").alias("v")).distinct())
    return edges


def near_duplicates(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) of every document."""
    fps = persist(spark, fingerprints(docs, shingle), "fingerprints")
    classes = persist(spark, fps.groupBy("fp").agg(F.min("doc_id").alias("node")).where("node is not null"),
                      "classes")
    roots = components(spark, links(spark, classes, max_bits))
    label = classes.join(roots, "node", "left").select(
        F.col("fp"), F.coalesce("root", "node").alias("component_id"))
    return fps.join(label, "fp", "left").select("doc_id", "fp", "component_id")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(spark, table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
