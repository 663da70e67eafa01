"""Best-fit packing of token sequences.

``token_pieces`` cuts every document into pieces of at most ``capacity``
tokens, ``pack`` places the pieces by best-fit decreasing.  Pieces of one
length are interchangeable, so the global order is decided from the histogram
of lengths (at most ``capacity`` counters, whatever the size of the corpus):
lengths are taken in falling order, a segment tree over remaining capacities
finds the tightest open bin, and a run of equal pieces fills the bins of that
capacity together.  The result is a short list of runs (bounded by the square
of the capacity); each piece finds its bin from its length and its rank among
the pieces of that length, both computed by Spark.

Defined results: a null or empty text is one piece holding the end token; a
null doc_id is kept; repeated rows are packed as rows of their own; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import persist, sizes, table

CAPACITY = 1024
END_ID = 2
BLOCK_ROWS = 20_000
TEXTS_ROWS, TEXTS_BYTES = 64, 1 << 18   # texts encoded at once; a longer one is alone
CACHE_ENTRIES = 700_000     # chunk -> ids, per Python worker: about 150 MB
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
RESULT = PIECES + ", sequence_id long, offset long"

_ENCODERS: dict[str, tuple] = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class TextEncoder:
    """Ids of texts as little-endian uint32 bytes.  In this vocabulary a
    blank or line break before a non-space starts a new pre-token, so a text
    is encoded chunk by chunk and the ids of chunks are kept in a bounded
    cache."""

    _cut = re.compile(r"(?=[ \n]\S)")

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()     # byte-level: a character of a token is a byte of the text
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.token_bytes[i] = len(token)

    @staticmethod
    def chunks(text: str) -> list[str]:
        """The text cut before each blank and line break."""
        return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")

    @staticmethod
    def odd(chunks: set[str]) -> set[str]:
        """The chunks with a blank or line break that no non-space follows.
        They are never kept, so they are found among the new ones; their texts
        are cut before non-spaces only."""
        return {c for c in chunks if c[1:2].isspace()} | chunks & {" ", "\n"}

    def encode_chunks(self, chunks: set[str], odd: set[str]) -> dict[str, bytes]:
        """Ids of distinct chunks.  Those that start at a blank or line break
        before a non-space are encoded as one string, which pre-tokenization
        cuts where it would cut their text; the bytes of its tokens say which
        chunk each belongs to."""
        joined = [c for c in chunks - odd if c[:1] in " \n"]
        alone = list(chunks.difference(joined))
        got = self.tokenizer.encode_batch_fast([*alone, "".join(joined)], add_special_tokens=False)
        ids = np.concatenate([np.array(x.ids, "<u4") for x in got])
        token_ends = np.cumsum(self.token_bytes[ids])
        alone += joined
        sizes = np.fromiter(map(len, map(str.encode, alone)), np.int64, len(alone))
        ends = (4 * np.searchsorted(token_ends, np.cumsum(sizes), side="right")).tolist()
        raw = ids.tobytes()
        return dict(zip(alone, [raw[a:b] for a, b in zip([0, *ends], ends)]))

    def new_chunks(self, cut: list[list[str]]) -> set[str]:
        """Chunks without ids; those of the older half of the cache that occur
        again move to the younger one, so frequent chunks are kept."""
        new = set().union(*cut).difference(self.cache)
        older = self.older
        again = {c: older[c] for c in new if c in older}
        self.cache.update(again)
        return new.difference(again)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of some texts; their new chunks are encoded together."""
        cut = [self._cut.split(t) if "\0" in t else self.chunks(t) for t in texts]
        new = self.new_chunks(cut)
        if odd := self.odd(new):
            cut = [c if odd.isdisjoint(c) else self._cut.split(t) for c, t in zip(cut, texts)]
            new = self.new_chunks(cut)
        if len(self.cache) + len(new) > CACHE_ENTRIES // 2:
            self.older, self.cache = self.cache, {}
            new = self.new_chunks(cut)
        odd, cache = self.odd(new), self.cache
        if new:
            cache.update(self.encode_chunks(new, odd))
        out = [b"".join(map(cache.__getitem__, c)) for c in cut]
        for c in odd.union([c for c in new if len(c) > 64]):
            del cache[c]
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


def encoder(path: str) -> TextEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: only the first is shorter."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def _pieces(path: str, capacity: int, end_id: int, with_ids: bool):
    end = int(end_id).to_bytes(4, "little")
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int32())] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            for at, n in sizes(batch.column(1), TEXTS_ROWS, TEXTS_BYTES):
                part = batch.slice(at, n)
                out = []
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc, ids in zip(part.column(0).to_pylist(), enc.encode_all(texts)):
                    ids += end
                    for k, (s, n) in enumerate(piece_bounds(len(ids) // 4, capacity)):
                        raw = ids[4 * s:4 * (s + n)]
                        out.append((doc, k, s, n, zlib.crc32(raw), *([np.frombuffer(raw, "<i4")] * with_ids)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(zip(*out), types)], names=names)

    return run


def token_pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY,
                 end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of every document; ``with_ids`` adds their token ids."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_pieces(vocabulary or default_vocabulary(), capacity, end_id, with_ids),
                           PIECES + (", ids array<int>" if with_ids else ""))


class CapacityTree:
    """Segment tree over remaining capacities 0..capacity: a node says how
    many open bins lie below it; ``tightest(n)`` descends to the smallest
    capacity >= n that has one."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, capacity: int, bins: int) -> None:
        i = capacity + self.size
        while i:
            self.count[i] += bins
            i >>= 1

    def tightest(self, need: int) -> int | None:
        i = need + self.size
        if self.count[i]:
            return need
        while i > 1:  # climb until a right sibling holds a bin, then take its leftmost leaf
            if i % 2 == 0 and self.count[i + 1]:
                i += 1
                break
            i >>= 1
        else:
            return None
        while i < self.size:
            i = 2 * i if self.count[2 * i] else 2 * i + 1
        return i - self.size


def best_fit_decreasing(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, first bin, pieces per bin, offset): piece r
    of a run goes to bin first + r // per_bin at offset + (r % per_bin) *
    length.  Same bins as best fit one piece at a time: the tightest open bin
    stays the tightest until the length no longer fits into it."""
    tree, open_bins, runs, bins = CapacityTree(capacity), {}, [], 0

    def put(left: int, first: int, count: int) -> None:
        if count and left:
            open_bins.setdefault(left, deque()).append((first, count))
            tree.add(left, count)

    for length in sorted(histogram, reverse=True):
        todo, rank = histogram[length], 0
        while todo:
            room = tree.tightest(length)
            if room is None:
                per, room = capacity // length, capacity
                first, count = bins, -(-todo // per)
                bins += count
            else:
                per = room // length
                first, count = open_bins[room].popleft()
                tree.add(room, -count)
            used = min(count, -(-todo // per))
            put(room, first + used, count - used)
            placed = min(todo, used * per)
            runs.append((length, rank, first, per, capacity - room))
            last = placed - (used - 1) * per     # pieces in the last bin of the run
            full = used if last == per else used - 1
            put(room - per * length, first, full)
            if full < used:
                put(room - last * length, first + full, 1)
            rank, todo = rank + placed, todo - placed
    return runs


def _place(runs: list[tuple[int, int, int, int, int]]):
    runs = sorted(runs)
    keys = [(r[0], r[1]) for r in runs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seq, off = [], []
            for n, r in zip(b.column("length").to_pylist(), b.column("rank").to_pylist()):
                length, rank, first, per, base = runs[bisect_right(keys, (n, r)) - 1]
                seq.append(first + (r - rank) // per)
                off.append(base + (r - rank) % per * length)
            cols = [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                cols + [pa.array(seq, pa.int64()), pa.array(off, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack(spark: SparkSession, pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Sequence and offset of every piece (columns of ``PIECES``)."""
    pieces = persist(spark, pieces, "pieces")
    histogram = {r["length"]: r["n"] for r in
                 pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= capacity rows
    runs = best_fit_decreasing(histogram, capacity)
    blocks = max(16, sum(histogram.values()) // BLOCK_ROWS)
    rows = pieces.withColumn("blk", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(blocks)))
    before = (rows.groupBy("length", "blk").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("blk")) - F.col("n"))
              .drop("n"))
    order = Window.partitionBy("length", "blk").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (rows.withColumn("in_blk", F.row_number().over(order) - 1).join(before, ["length", "blk"])
              .withColumn("rank", F.col("before") + F.col("in_blk")))
    return ranked.mapInArrow(_place(runs), RESULT)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, token_pieces(table(spark, sf_dir, "documents")))
