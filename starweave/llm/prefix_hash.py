"""Document fingerprints from prefix polynomial hashes.

``PrefixHash`` keeps, for two prime moduli, the sums S[i] = sum_{j<i} c_j B^j
of a text's code points.  Any span's hash is one subtraction and one
multiplication, so spans of any two texts compare in constant time, the
longest common extension of two positions follows by binary search, and the
hash of a spliced text follows from the arrays of its parts.

A document fingerprint is the length and hash of the whole text and a
minimum sketch of the hashes of its ``SPAN``-long spans (64 bins of 16 bits);
``likeness`` of two fingerprints is the share of agreeing bins, 1 for equal
fingerprints.

Defined results: null text is empty; an empty text has an empty sketch; a
single document is its own next document; rows with a null doc_id come last
in the descending order; rows with the same doc_id follow each other, ordered
by text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import persist, table

PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_000_003, 1_299_721)
SPAN = 16
BINS = 64
MIX = np.uint64(0x9E3779B97F4A7C15)
EMPTY_BIN = 0xFFFF

_POWERS: dict[tuple[int, int], np.ndarray] = {}


def powers(base: int, prime: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo the prime, grown by doubling."""
    have = _POWERS.get((base, prime))
    if have is None:
        have = np.ones(1, np.uint64)
    while len(have) < n:
        step = np.uint64(pow(base, len(have), prime))
        have = np.concatenate((have, have * step % np.uint64(prime)))
    _POWERS[base, prime] = have
    return have[:n]


class PrefixHash:
    """Prefix arrays of one text under both moduli."""

    def __init__(self, text: str):
        self.text, self.n = text, len(text)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
        self.sums = []
        for b, p in zip(BASES, PRIMES):
            terms = codes * powers(b, p, self.n) % np.uint64(p)
            s = np.zeros(self.n + 1, np.uint64)
            np.cumsum(terms, out=s[1:])     # below 2^31 each: no overflow up to 2^33 code points
            self.sums.append(s % np.uint64(p))

    def span(self, i: int, j: int) -> tuple[int, int]:
        """Position-free hash of text[i:j] under both moduli."""
        return tuple((int(s[j]) - int(s[i])) * pow(b, -i, p) % p for s, b, p in zip(self.sums, BASES, PRIMES))

    def equal(self, i: int, other: PrefixHash, j: int, length: int) -> bool:
        return self.span(i, i + length) == other.span(j, j + length)

    def common_extension(self, i: int, other: PrefixHash, j: int) -> int:
        """Length of the longest common prefix of text[i:] and other[j:]."""
        lo, hi = 0, min(self.n - i, other.n - j)
        while lo < hi:
            mid = (lo + hi + 1) // 2
            if self.equal(i, other, j, mid):
                lo = mid
            else:
                hi = mid - 1
        return lo

    def all_spans(self, length: int, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """Mixed 64-bit hashes of the spans starting in [lo, hi)."""
        last = self.n - length + 1
        hi = last if hi is None else min(hi, last)
        if hi <= lo:
            return np.zeros(0, np.uint64)
        out = np.zeros(hi - lo, np.uint64)
        for s, b, p in zip(self.sums, BASES, PRIMES):
            q = np.uint64(p)
            diff = s[lo + length:hi + length] + q - s[lo:hi]
            v = diff % q * powers(pow(b, -1, p), p, hi)[lo:] % q
            out = (out << np.uint64(31)) | v
        out *= MIX
        return out ^ (out >> np.uint64(29))


def sketch(hashes: list[np.ndarray]) -> np.ndarray:
    """Per bin (top 6 bits) the smallest next 16 bits; empty bins are 0xFFFF."""
    bins = np.full(BINS, EMPTY_BIN, np.int64)
    total = sum(map(len, hashes))
    # Only the low end of the value range can hold a minimum when there are many spans.
    top = 1 << 16 if total < 4096 else max(16, (1 << 16) * BINS * 24 // total)
    for limit in dict.fromkeys((top, 1 << 16)):
        for h in hashes:
            v = ((h >> np.uint64(42)) & np.uint64(0xFFFF)).astype(np.int64)
            keep = v < limit
            np.minimum.at(bins, (h[keep] >> np.uint64(58)).astype(np.int64), np.minimum(v[keep], EMPTY_BIN - 1))
        if (bins != EMPTY_BIN).all():
            break
    return bins


def fingerprint(n: int, whole: tuple[int, int], bins: np.ndarray) -> str:
    return f"{n:x}-{whole[0]:08x}{whole[1]:08x}-" + bins.astype(">u2").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Share of agreeing bins among those either text fills; 1 if equal."""
    if a == b:
        return 1.0
    x, y = (np.frombuffer(bytes.fromhex(f.rpartition("-")[2]), ">u2") for f in (a, b))
    filled = (x != EMPTY_BIN) | (y != EMPTY_BIN)
    return float(((x == y) & filled).sum() / filled.sum()) if filled.any() else 0.0


class Document:
    """Prefix arrays, span hashes and fingerprint of one text."""

    def __init__(self, text: str):
        self.hash = PrefixHash(text)
        n = self.hash.n
        self.spans = self.hash.all_spans(SPAN) if n >= SPAN else (self.hash.all_spans(n) if n else np.zeros(0, np.uint64))
        self.print = fingerprint(n, self.hash.span(0, n), sketch([self.spans]))


def compare(doc: Document, nxt: Document) -> tuple:
    """The edited text (last third replaced by the start of the next text)
    against the document: every span hash comes from the parts' arrays, only
    the spans across the seam are hashed anew."""
    text, n = doc.hash.text, doc.hash.n
    k = n // 3
    cut, k = n - k, min(k, nxt.hash.n)
    edited = text[:cut] + nxt.hash.text[:k]
    m = cut + k
    whole = tuple((int(s[cut]) + pow(b, cut, p) * int(t[k])) % p
                  for s, t, b, p in zip(doc.hash.sums, nxt.hash.sums, BASES, PRIMES))
    if m >= SPAN and n >= SPAN:
        seam = PrefixHash(edited[max(0, cut - SPAN + 1):cut + SPAN - 1])
        own = doc.spans[:max(0, cut - SPAN + 1)]
        new = nxt.spans[:max(0, k - SPAN + 1)] if nxt.hash.n >= SPAN else nxt.spans[:0]
        parts = [own, seam.all_spans(SPAN), new]
    else:
        h = PrefixHash(edited)
        parts = [h.all_spans(min(m, SPAN))] if m else []
    edited_print = fingerprint(m, whole, sketch(parts))
    same = doc.hash.common_extension(cut, nxt.hash, 0) if k else 0
    return (n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), doc.print, edited_print,
            likeness(doc.print, edited_print), likeness(doc.print, nxt.print), cut + min(same, k))


NAMES = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "common_prefix"]
TYPES = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, common_prefix long")
DONE, HEAD, TAIL = 0, 1, 2


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of one range: each row against the next one; the first and
    the last text of the range come out as HEAD and TAIL."""
    pid = TaskContext.get().partitionId()

    def emit(rows):
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int32()), pa.array([pid] * len(rows), pa.int32()), pa.array(cols[1], pa.int64()),
             pa.array(cols[2], pa.string())] + [pa.array(c, t) for c, t in zip(cols[3:], TYPES)],
            names=["kind", "pid", "doc_id", "text", *NAMES])

    blank = (None,) * len(NAMES)
    before = None
    for b in batches:
        out = []
        for i in range(b.num_rows):
            doc_id, text = b.column(0)[i].as_py(), b.column(1)[i].as_py()
            here = Document(text)
            if before is None:
                out.append((HEAD, doc_id, text, *blank))
            else:
                out.append((DONE, before[0], None, *compare(before[1], here)))
            before = (doc_id, here)
        if out:
            yield emit(out)
    if before is not None:
        yield emit([(TAIL, before[0], before[1].hash.text, *blank)])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = b.column(0)
        for i in range(b.num_rows):
            row = compare(Document(b.column(1)[i].as_py()), Document(b.column(2)[i].as_py()))
            yield pa.RecordBatch.from_arrays([ids.slice(i, 1)] + [pa.array([v], t) for v, t in zip(row, TYPES)],
                                             names=["doc_id", *NAMES])


def fingerprint_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, and both likenesses.
    One range shuffle of the texts puts neighbours together; only the first
    and last text of a range meet across ranges."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("text")]
    schema = ("kind int, pid int, doc_id long, text string, " + RESULT.split(", ", 1)[1])
    walked = persist(spark, rows.repartitionByRange(order[0]).sortWithinPartitions(*order)
                     .mapInArrow(_walk, schema), "prefix-walk")
    heads = walked.where(F.col("kind") == HEAD)
    pids = sorted(r["pid"] for r in heads.select("pid").collect())   # one number per range
    done = walked.where(F.col("kind") == DONE).select("doc_id", *NAMES)
    if not pids:
        return done
    after = spark.createDataFrame(list(zip(pids, pids[1:] + pids[:1])), "pid int, next_pid int")
    ends = (walked.where(F.col("kind") == TAIL).select("pid", "doc_id", "text").join(F.broadcast(after), "pid")
            .join(heads.select(F.col("pid").alias("next_pid"), F.col("text").alias("next_text")), "next_pid")
            .select("doc_id", "text", "next_text"))
    return done.unionByName(ends.mapInArrow(_pairs, RESULT))


def op5_prefix_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(spark, table(spark, sf_dir, "documents"))
