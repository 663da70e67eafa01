"""Toxicity: a convolutional text classifier in numpy.

Words are the sum of hashed embeddings (the word and its first 3, 4 and 5
letters); filters of widths 1, 2 and 3 slide over them, each is max-pooled
over the whole text, and a logistic layer scores the pooled values.  A filter
response is a sum of per-word parts, so scoring a text gathers one row per
word from a table of responses.

It is trained on every usable labelled row, whatever the length of its text.
The rows are spread over shards by a hash; in each round every shard runs through its rows from the same parameters, and the
changes are averaged, a parameter row over the shards that used it.  Changes
are summed as integers, so the order of tasks does not matter.  A task runs
through some shards one after the other and sends the sum of their changes in compressed blocks, as
every shard changes most parameters; the rows lie on disk in such blocks too.  Every fourth
row (by a hash of its doc_id) does not fit but calibrates: a threshold is set
for each language from counts of all their scores, and scores are mapped
piecewise linearly so that every language's threshold falls on ``DECISION``.
The language is read from the letters of the text itself; the columns lang,
source, doc_id and the labels are never inputs of a score.

Defined results: null and empty texts get the score of a text without words;
repeated rows are scored alike; with no usable labels every score is 0; a
null doc_id is not held out and never used in training.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import frugal, persist, releasing, sizes, small_side, table

SHARD_ROWS = 8192           # labelled rows to a shard, at least
TASK_SHARDS = 4             # shards that a task runs through
ROWS_TOGETHER = 1024        # parameter rows whose changes travel in one block
CHUNK_ROWS, CHUNK_BYTES = 2048, 4 << 20   # rows of a shard held at once
BUCKETS = 1 << 16
DIM = 12
FILTERS = 12                # of each width
WIDTHS = (1, 2, 3)
ROUNDS, PASSES = (3, 6), 2  # rounds over all rows (least, most), passes over a chunk in each
VISITS = 6 * SHARD_ROWS     # texts to go through in a shard; a small table takes more rounds for it
BATCH = 48
VALIDATION = 4              # every fourth labelled row calibrates
BINS = 1 << 16              # of scores, counted for the thresholds
FIXED = 1 << 32             # changes are summed in units of 1 / FIXED
DECISION = 0.3
HELD_OUT = 2                # remainder of crc32(doc_id) modulo 4
CACHE_WORDS = 150_000
BATCH_WORDS = 50_000        # a longer text is a mini-batch alone
LABELS_BROADCAST = 500_000
SLICE_ROWS, SLICE_BYTES = 64, 1 << 18   # texts scored at once
STRIP = "\"'.,;:!?()[]{}<>*&%$#-_…«»„“”¿¡"
LETTERS = {"fr": "èêçàù", "de": "äöüß", "es": "ñóíáú"}
SLOTS = sum(WIDTHS)         # one response block per (width, offset)
BLOCKS = [(w, o, b) for b, (w, o) in enumerate((w, o) for w in WIDTHS for o in range(w))]
_ENDS = np.cumsum([0, DIM * SLOTS * FILTERS, len(WIDTHS) * FILTERS, len(WIDTHS) * FILTERS, 1]).tolist()
TAIL = {k: slice(*_ENDS[i:i + 2]) for i, k in enumerate(("conv", "bias", "out", "out_bias"))}
PARAMETERS = BUCKETS + -(-_ENDS[-1] // DIM)


def words_of(text: str | None) -> list[str]:
    return [w for x in (text or "").lower().split() if (w := x.strip(STRIP))]


def language_of(text: str | None) -> str:
    """By letters that only one of the languages uses; 'en' without them."""
    text = text or ""
    counts = {k: sum(map(text.count, v)) for k, v in LETTERS.items()}
    best = max(counts, key=counts.get)
    return best if counts[best] * 200 > len(text) else "en"


def word_features(word: str) -> list[int]:
    parts = (word, "3" + word[:3], "4" + word[:4], "5" + word[:5])
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) % BUCKETS for p in parts]


class Vocabulary:
    """Word -> row number, with the hashed features of every row; row 0 is
    the padding between texts.  Cleared when it reaches its bound."""

    def __init__(self, limit: int | None = None):
        self.limit = limit
        self.clear()

    def clear(self):
        self.rows: dict[str, int] = {}
        self.features = np.zeros((1024, 4), np.int64)

    def ids(self, words: list[str]) -> np.ndarray:
        got = list(map(self.rows.get, words))
        if None in got:
            for i, v in enumerate(got):
                if v is None:
                    w = words[i]
                    n = self.rows.get(w)
                    if n is None:
                        n = self.rows[w] = len(self.rows) + 1
                        if n >= len(self.features):
                            self.features = np.concatenate((self.features, np.zeros_like(self.features)))
                        self.features[n] = word_features(w)
                    got[i] = n
        return np.array(got, np.int64)

    def full(self) -> bool:
        return self.limit is not None and len(self.rows) > self.limit


def lay_out(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Word rows of all texts with two padding rows after each, and starts."""
    pad = np.zeros(2, np.int64)
    flat = np.concatenate([x for t in texts for x in (t, pad)] + [pad])
    starts = np.concatenate(([0], np.cumsum([len(t) + 2 for t in texts])[:-1])).astype(np.int64)
    return flat, starts


def convolve(resp: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """(positions, widths * filters) responses; resp has a row per word and a
    block of FILTERS per (width, offset)."""
    n, out, at = len(flat) - 2, [], 0
    for w in WIDTHS:
        total = resp[flat[:n], at * FILTERS:(at + 1) * FILTERS]
        for o in range(1, w):
            total = total + resp[flat[o:n + o], (at + o) * FILTERS:(at + o + 1) * FILTERS]
        out.append(total)
        at += w
    return np.concatenate(out, axis=1)


class Model:
    """All parameters are rows of DIM numbers: the embeddings, then ``TAIL``."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.params = np.zeros((PARAMETERS, DIM), np.float32)
        self.emb[:] = r.normal(0, 0.3, (BUCKETS, DIM))
        self.conv[:] = r.normal(0, 0.4, (DIM, SLOTS * FILTERS))
        self.out[:] = r.normal(0, 0.2, len(WIDTHS) * FILTERS)
        self.thresholds: dict[str, float] = {}

    @property
    def emb(self) -> np.ndarray:
        return self.params[:BUCKETS]

    @property
    def conv(self) -> np.ndarray:
        return self.tail("conv").reshape(DIM, SLOTS * FILTERS)

    @property
    def bias(self) -> np.ndarray:
        return self.tail("bias")

    @property
    def out(self) -> np.ndarray:
        return self.tail("out")

    @property
    def out_bias(self) -> np.float32:
        return self.tail("out_bias")[0]

    def tail(self, name: str) -> np.ndarray:
        return self.params[BUCKETS:].reshape(-1)[TAIL[name]]

    def responses(self, features: np.ndarray) -> np.ndarray:
        """Responses of words given by their features; row 0 is padding."""
        words = self.emb[features].sum(1)
        words[0] = 0
        return words @ self.conv

    def pooled(self, resp: np.ndarray, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        top = np.maximum.reduceat(convolve(resp, flat), starts, axis=0)
        return np.maximum(top + self.bias, 0)

    def probability(self, pooled: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(pooled @ self.out + self.out_bias, -30, 30)))

    def score(self, p: np.ndarray, languages: list[str]) -> np.ndarray:
        t = np.array([self.thresholds.get(x, 0.5) for x in languages])
        return np.where(p < t, DECISION * p / t, DECISION + (1 - DECISION) * (p - t) / (1 - t))


class Fitter:
    """Adagrad on mini-batches; only the winning positions of the max pooling
    carry gradients.  ``used`` marks the parameter rows that were changed."""

    def __init__(self, model: Model, acc: np.ndarray, weights: tuple[float, float], r: np.random.Generator):
        self.model, self.acc, self.weights, self.r = model, acc, np.array(weights), r
        self.used = np.zeros(PARAMETERS, bool)

    def chunk(self, vocab: Vocabulary, docs: list[np.ndarray], labels: np.ndarray, rates: list[float]) -> None:
        for rate in rates:
            order = self.r.permutation(len(docs))
            a = total = 0
            for z, i in enumerate(order):
                if z > a and (z - a >= BATCH or total + len(docs[i]) > BATCH_WORDS):
                    self.batch(vocab, [docs[j] for j in order[a:z]], labels[order[a:z]], rate)
                    a, total = z, 0
                total += len(docs[i])
            if a < len(order):
                self.batch(vocab, [docs[j] for j in order[a:]], labels[order[a:]], rate)

    def batch(self, vocab: Vocabulary, docs: list[np.ndarray], y: np.ndarray, rate: float) -> None:
        model = self.model
        flat, starts = lay_out(docs)
        used, local = np.unique(flat, return_inverse=True)
        f = vocab.features[used]
        words = model.emb[f].sum(1)
        words[0] = 0
        act = convolve(words @ model.conv, local)
        ends = np.append(starts[1:], len(act))
        win = np.stack([s + act[s:e].argmax(0) for s, e in zip(starts, ends)])
        raw = np.take_along_axis(act, win.reshape(-1, act.shape[1]), 0) + model.bias
        keep = self.r.random(raw.shape) > 0.2
        pool = np.maximum(raw, 0) * keep / 0.8
        g = (model.probability(pool) - y) * self.weights[y.astype(int)] / len(docs)
        g_pool = g[:, None] * model.out[None, :] * (raw > 0) * keep / 0.8
        g_words = np.zeros_like(words)
        g_conv = np.zeros_like(model.conv)
        for w, o, b in BLOCKS:
            k = WIDTHS.index(w)
            pos = local[win[:, k * FILTERS:(k + 1) * FILTERS] + o]          # (texts, filters) word rows
            gp = g_pool[:, k * FILTERS:(k + 1) * FILTERS]
            cols = slice(b * FILTERS, (b + 1) * FILTERS)
            g_conv[:, cols] += np.einsum("tfd,tf->df", words[pos], gp)
            np.add.at(g_words, pos, gp[:, :, None] * model.conv[:, cols].T[None, :, :])
        g_words[0] = 0
        hit = np.flatnonzero(np.abs(g_words).sum(1))
        rows, inv = np.unique(f[hit], return_inverse=True)
        grad = np.zeros((len(rows) + PARAMETERS - BUCKETS, DIM), np.float32)
        np.add.at(grad[:len(rows)], inv.ravel(), np.repeat(g_words[hit], f.shape[1], axis=0))
        tail = grad[len(rows):].reshape(-1)
        for name, value in (("conv", g_conv.ravel()), ("bias", g_pool.sum(0)), ("out", pool.T @ g), ("out_bias", g.sum())):
            tail[TAIL[name]] = value
        rows = np.concatenate((rows, np.arange(BUCKETS, PARAMETERS)))
        self.acc[rows] += grad ** 2
        model.params[rows] -= rate * grad / np.sqrt(self.acc[rows])
        self.used[rows] = True


def predict(model: Model, vocab: Vocabulary, docs: list[np.ndarray]) -> np.ndarray:
    flat, starts = lay_out(docs)
    used, local = np.unique(flat, return_inverse=True)
    return model.probability(model.pooled(model.responses(vocab.features[used]), local, starts))


def best_threshold(p: np.ndarray, y: np.ndarray, n: np.ndarray) -> float:
    """The middle of the best-F1 cuts of the scores, of which each stands for
    n rows; kept off 0 and 1."""
    cuts = np.unique(np.concatenate(([0.0], p, [1.0])))
    mids = (cuts[1:] + cuts[:-1]) / 2
    at = np.searchsorted(mids, p, "right")       # cuts at or below the score
    above = [np.bincount(at, w, len(mids) + 1)[::-1].cumsum()[::-1][1:] for w in (n * (y == 1), n)]
    f1 = 2 * above[0] / np.maximum((n * (y == 1)).sum() + above[1], 1)
    top = mids[f1 >= f1.max() - 1e-9]
    return float(np.clip((top.min() + top.max()) / 2, 0.05, 0.95))


def calibrate(p: np.ndarray, y: np.ndarray, n: np.ndarray, languages: list[str]) -> dict[str, float]:
    overall = best_threshold(p, y, n)
    langs = np.array(languages)
    out = {}
    for x in ("en", *LETTERS):
        own = langs == x
        enough = n[own & (y == 1)].sum() >= 8 and n[own & (y == 0)].sum() >= 8
        out[x] = best_threshold(p[own], y[own], n[own]) if enough else overall
    return out


BLOCKS_OF_ROWS = "shard int, n00 long, n01 long, n10 long, n11 long, blob binary"     # n: rows by held and toxic


@frugal
def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compressed blocks of consecutive rows (text, toxic, held) of a shard."""
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(shard)) + 1, [batch.num_rows]))
        for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            for at, n in sizes(batch.column("text").slice(a, z - a), CHUNK_ROWS, CHUNK_BYTES):
                rows = batch.select(["text", "toxic", "held"]).slice(a + at, n)
                kinds = np.bincount(2 * rows.column("held").to_numpy(False).astype(int) + rows.column("toxic").to_numpy(), minlength=4)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                    w.write_batch(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard[a]], pa.int32()), *(pa.array([k], pa.int64()) for k in kinds.tolist()),
                     pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["shard", "n00", "n01", "n10", "n11", "blob"])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[pa.Scalar]]]:
    """The blocks of each shard, which lie together."""
    rows = ((i, blob) for b in batches for i, blob in zip(b.column("shard").to_pylist(), b.column("blob")))
    for shard, own in groupby(rows, key=lambda x: x[0]):
        yield shard, (blob for _, blob in own)


def _slices(blobs: Iterator[pa.Scalar], held: bool | None) -> Iterator[tuple[list[str], list[int]]]:
    """(texts, labels) of the rows that are ``held`` or not (None: of all),
    at most SLICE_ROWS and about SLICE_BYTES of them; a longer text is alone."""
    texts, labels, total = [], [], 0
    for blob in blobs:
        for rows in pa.ipc.open_stream(blob.as_buffer()):
            if held is not None:
                rows = rows.filter(pc.equal(rows.column("held"), held))
            size = pc.binary_length(rows.column("text")).to_pylist()
            for t, y, n in zip(rows.column("text").to_pylist(), rows.column("toxic").to_pylist(), size):
                if texts and (len(texts) >= SLICE_ROWS or total + n > SLICE_BYTES):
                    yield texts, labels
                    texts, labels, total = [], [], 0
                texts.append(t)
                labels.append(y)
                total += n
    if texts:
        yield texts, labels


def _chunks(slices: Iterator[tuple[list[str], list[int]]]) -> Iterator[tuple[list[str], list[int]]]:
    """(texts, labels) of at most CHUNK_ROWS rows and about CHUNK_BYTES."""
    texts, labels, total = [], [], 0
    for part, own in slices:
        texts += part
        labels += own
        total += sum(map(len, part))
        if len(texts) >= CHUNK_ROWS - SLICE_ROWS or total >= CHUNK_BYTES:
            yield texts, labels
            texts, labels, total = [], [], 0
    if texts:
        yield texts, labels


VALUES = [f"{kind}{i}" for kind in "pa" for i in range(DIM)]     # of a parameter row and of its accumulator


def _packed(rows: np.ndarray, n: np.ndarray, values: np.ndarray) -> bytes:
    """Whole numbers by column, their lowest bytes first, then the next ones;
    the upper bytes of small numbers are all zero."""
    table = np.concatenate((rows[:, None], n[:, None], values), axis=1)
    table = (table << 1) ^ (table >> 63)        # the sign becomes the lowest bit
    return zlib.compress(np.ascontiguousarray(table.T.reshape(-1, 1).astype("<i8").view(np.uint8).T).tobytes(), 1)


def _unpacked(blob: bytes) -> np.ndarray:
    flat = np.ascontiguousarray(np.frombuffer(zlib.decompress(blob), np.uint8).reshape(8, -1).T).view("<i8")
    table = flat.reshape(2 + len(VALUES), -1).T
    return (table.view("<u8") >> np.uint64(1)).astype(np.int64) ^ -(table & 1)


def _together(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The changes of ``run`` in blocks of parameter rows."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            rows, n = batch.column("row").to_numpy().astype(np.int64), batch.column("n").to_numpy()
            values = np.stack([batch.column(c).to_numpy() for c in VALUES], axis=1)
            cuts = [0, *(np.flatnonzero(np.diff(rows // ROWS_TOGETHER)) + 1).tolist(), len(rows)]
            for a, z in zip(cuts, cuts[1:]):
                yield pa.RecordBatch.from_arrays([pa.array([rows[a] // ROWS_TOGETHER], pa.int32()),
                                                  pa.array([_packed(rows[a:z], n[a:z], values[a:z])], pa.binary())], names=["block", "blob"])

    return task


def _summed(blocks: pa.Table) -> pa.Table:
    """The changes of the parameter rows of one block, summed over the tasks."""
    first = blocks["block"][0].as_py() * ROWS_TOGETHER
    total = np.zeros((ROWS_TOGETHER, 1 + len(VALUES)), np.int64)
    for blob in blocks["blob"]:
        table = _unpacked(blob.as_py())
        total[table[:, 0] - first] += table[:, 1:]
    rows = np.flatnonzero(total[:, 0])
    return pa.Table.from_arrays([pa.array(first + rows, pa.int32()), *[pa.array(c) for c in total[rows].T]], names=["row", "n", *VALUES])


def _shard(shared, weights: tuple[float, float], turn: int, rounds: int, seed: int, held: bool | None):
    """(row, n, values): the summed changes of the task's shards, n of which
    changed the parameter row."""
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, acc = shared.value
        rates = [0.08 * (1 - (turn * PASSES + k) / (rounds * PASSES)) + 0.01 for k in range(PASSES)]
        vocab = Vocabulary(CACHE_WORDS)
        n, total = np.zeros(PARAMETERS, np.int64), np.zeros((PARAMETERS, 2 * DIM), np.int64)
        for shard, blobs in _shards(batches):
            model = Model.__new__(Model)
            model.params = start.copy()
            fitter = Fitter(model, acc.copy(), weights, np.random.default_rng((seed, turn, shard)))
            vocab.clear()
            for texts, labels in _chunks(_slices(blobs, held)):
                if vocab.full():
                    vocab.clear()
                fitter.chunk(vocab, [vocab.ids(words_of(t)) for t in texts], np.array(labels, np.float64), rates)
            rows = np.flatnonzero(fitter.used)
            change = np.concatenate((model.params[rows] - start[rows].astype(np.float64),
                                     fitter.acc[rows] - acc[rows].astype(np.float64)), axis=1)
            n[rows] += 1
            total[rows] += np.rint(change * FIXED).astype(np.int64)
        rows = np.flatnonzero(n)
        if len(rows):
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array(n[rows]), *[pa.array(c) for c in total[rows].T]],
                                             names=["row", "n", *VALUES])

    return run


def fit(spark: SparkSession, rows: DataFrame, weights: tuple[float, float], rounds: int, held: bool | None = None,
        seed: int = 7) -> Model:
    """The parameters after ``rounds`` rounds over all shards of the blocks
    ``rows``; a fixed number of parameter rows reaches the driver."""
    model = Model(seed)
    acc = np.full_like(model.params, 1e-6)
    schema = T.StructType([T.StructField("row", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in ("n", *VALUES)]])
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast((model.params, acc))
        with releasing(spark):
            got = (rows.select("shard", "blob").mapInArrow(_together(_shard(shared, weights, turn, rounds, seed, held)), "block int, blob binary")
                   .groupBy("block").applyInArrow(_summed, schema).toArrow())
        at = got["row"].to_numpy()
        mean = np.stack([got[c].to_numpy() for c in VALUES], axis=1) / (got["n"].to_numpy()[:, None] * float(FIXED))
        model.params, acc = model.params.copy(), acc.copy()
        model.params[at] += mean[:, :DIM].astype(np.float32)
        acc[at] += mean[:, DIM:].astype(np.float32)
        shared.destroy()
    return model


def _prober(shared, held: bool | None):
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, vocab = shared.value, Vocabulary(CACHE_WORDS)
        for _, blobs in _shards(batches):
            for texts, labels in _slices(blobs, held):
                if vocab.full():
                    vocab.clear()
                p = predict(model, vocab, [vocab.ids(words_of(t)) for t in texts])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(map(language_of, texts), pa.string()), pa.array(labels, pa.int32()),
                     pa.array(np.rint(p * BINS).astype(np.int32))], names=["language", "toxic", "bin"])

    return run


def train_on(spark: SparkSession, docs: DataFrame, labels: DataFrame,
             shard_rows: int = SHARD_ROWS) -> Model | None:
    """The model of a table of labels (doc_id, toxic), or None without both
    classes.  All rows of documents with a usable label fit or calibrate."""
    use = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
           .where("doc_id is not null and toxic in (0, 1)").where(~held_out("doc_id"))
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    use = persist(spark, use, "usable-labels")
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
             .where(F.col("text").isNotNull()))
    order = F.xxhash64("doc_id", "text")
    calibrates = F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(VALIDATION)) == VALIDATION - 1
    usable = use.count()
    shards = max(1, usable // shard_rows)
    rounds = min(max(-(-VISITS * shards // max(usable * PASSES, 1)), ROUNDS[0]), ROUNDS[1])
    tasks = -(-shards // TASK_SHARDS)
    rows = (texts.join(small_side(use, LABELS_BROADCAST), "doc_id")
            .select("doc_id", "text", "toxic", calibrates.alias("held"), order.alias("order"))
            .withColumn("shard", F.pmod(F.hash("order"), F.lit(shards)))
            .repartitionById(tasks, F.pmod("shard", F.lit(tasks))).sortWithinPartitions("shard", "order", "doc_id", "text")
            .select("shard", "text", "toxic", "held").mapInArrow(_blocked, BLOCKS_OF_ROWS)
            .persist(StorageLevel.DISK_ONLY))
    try:
        got = rows.agg(*[F.sum(f"n{h}{y}").alias(f"n{h}{y}") for h in (0, 1) for y in (0, 1)]).first()
        n = {(bool(h), y): got[f"n{h}{y}"] for h in (0, 1) for y in (0, 1) if got[f"n{h}{y}"]}
        if len({toxic for _, toxic in n}) < 2:
            return None
        fits, check = False, True
        if not n.get((False, 0)) or not n.get((False, 1)) or not n.get((True, 1)):
            fits = check = None
            n = {(False, y): n.get((False, y), 0) + n.get((True, y), 0) for y in (0, 1)}
        share = n[False, 1] / (n[False, 0] + n[False, 1])
        model = fit(spark, rows, (0.5 / max(1 - share, 1e-3), 0.5 / max(share, 1e-3)), rounds, fits)
        shared = spark.sparkContext.broadcast(model)
        got = (rows.select("shard", "blob").mapInArrow(_prober(shared, check), "language string, toxic int, bin int")
               .groupBy("language", "toxic", "bin").agg(F.count(F.lit(1)).alias("n")).toArrow())
        model.thresholds = calibrate(got["bin"].to_numpy() / BINS, got["toxic"].to_numpy(), got["n"].to_numpy(),
                                     got["language"].to_pylist())
        return model
    finally:
        rows.unpersist()


def held_out(doc_id: str):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


class ResponseTable:
    """Responses of every word of a vocabulary, extended as it grows."""

    def __init__(self, model: Model | None):
        self.model, self.n = model, 1
        self.rows = np.zeros((1024, SLOTS * FILTERS), np.float32)   # row 0 is the padding

    def upto(self, vocab: Vocabulary) -> np.ndarray:
        n = len(vocab.rows) + 1
        if n > self.n:
            if n > len(self.rows):
                self.rows = np.concatenate((self.rows, np.zeros((max(n, len(self.rows)), self.rows.shape[1]), np.float32)))
            self.rows[self.n:n] = self.model.emb[vocab.features[self.n:n]].sum(1) @ self.model.conv
            self.n = n
        return self.rows


def in_slices(texts: pa.Array) -> Iterator[list[str | None]]:
    """Whole texts, SLICE_ROWS and SLICE_BYTES of them at most scored at once."""
    for a, n in sizes(texts, SLICE_ROWS, SLICE_BYTES):
        yield texts.slice(a, n).to_pylist()


def _scorer(model, name: str):
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value if hasattr(model, "value") else model
        vocab, table_ = Vocabulary(CACHE_WORDS), ResponseTable(m)
        for b in batches:
            out = []
            for part in in_slices(b.column("text")):
                if m is None:
                    out.append(np.zeros(len(part)))
                    continue
                if vocab.full():
                    vocab.clear()
                    table_ = ResponseTable(m)
                docs = [vocab.ids(words_of(t)) for t in part]
                resp = table_.upto(vocab)
                flat, starts = lay_out(docs)
                p = m.probability(m.pooled(resp, flat, starts))
                out.append(m.score(p, [language_of(t) for t in part]))
            score = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score, pa.float64())],
                                             names=[*b.schema.names, name])

    return run


def score(spark: SparkSession, docs: DataFrame, model: Model | None, name: str = "score") -> DataFrame:
    """``docs`` (text, ...) with the score as a last column ``name``."""
    shared = spark.sparkContext.broadcast(model)  # a few MB, fixed by BUCKETS and DIM
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return docs.mapInArrow(_scorer(shared, name), schema)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = train_on(spark, docs, table(spark, sf_dir, "labels"))
    return score(spark, docs, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= DECISION).cast("int").alias("predicted"))
